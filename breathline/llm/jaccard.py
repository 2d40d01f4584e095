"""N-gram Jaccard join by a size-aware heavy-light split.

A document's set holds the 64-bit hashes of its distinct shingles. Documents with the same
set are one class from the start, and only classes are joined. Sets a and b link when
``100 * |a & b| >= percent * |a | b|``, that is when they share ``needed(a, b)`` elements,
which depends on their sizes alone.

- **Light** sets, up to a boundary size, list their subsets of exactly ``needed`` elements
  for every partner size. Sharing one is the same as linking, so a star replaces pairs.
- **Heavy** sets are looked up in inverted lists, in two steps. In an order by hash, two
  linked sets share many of their first elements. A set too many of whose first elements no
  other set has among its own is out; texts that share a line or passage with very many others
  go here, and what is left is near copies. These are read whole and put in an order by
  frequency. Of the first ``s - ceil(percent s / 100) + 1`` elements in that order linked sets
  have one in common, so only these, the rarest, make the lists.
- **The boundary** is the size at which subsets and list entries cost least together, by
  the counts of classes of each size.

A list is walked twice. First its members meet the one that shares most of its elements with
others, likely the original, which settles groups of near copies in a linear number of pairs.
Then only members outside of a list's main component meet the rest of it. A pair must share
as many lists as the bound for its sizes asks for, and what passes is verified on all elements
of both texts, in cells of bounded size. Members that meet must also be alike in ``BITS``
bits, the parities of their elements dealt to as many places: two sets differ in no more of
these than in elements, so this drops no link, and members of a list that share a passage and
little else make no row. Only sets near the bound that stay unlinked cost pairs.

Defined results
- No words (null, empty or white space): size 0, linked with nothing, its own component.
- Fewer words than a shingle: the whole sequence is the one element.
- Very long texts are cut into shingles by offsets, never into a list of words.
- A null id sorts after all others; a component of null ids only has a null component_id.
- Rows that repeat an id stand for themselves; equal texts always link if they have words.
- An empty table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.common import discarded, fixed, id_or_last, last_to_null, settled, written
from breathline.llm.components import connected
from breathline.llm.wordhash import chunks

SHINGLE_WORDS = 4
PERCENT = 85
#: Sets up to this size keep all their elements at hand, so that the boundary may lie here.
WHOLE = 40
#: Sets of a list that are compared at a time with as many others.
TILE = 64
#: Parities kept of a set; sets that differ in more elements than half of these are told apart by the lists alone.
BITS = 512
#: An element more is looked at, and asked for, for so many that two sets need in common.
MORE = 50
#: What a list entry costs in rows moved, beside one row for a subset.
ENTRY_COST = 4
#: So many ids of texts to verify are broadcast (counted first); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def elements(text: bytes, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The set of a UTF-8 text in the common order; bytes.lower means A-Z."""
    joined = text.lower().translate(SPACES)
    while b"  " in joined:
        joined = joined.replace(b"  ", b" ")
    joined = joined.strip(b" ")
    if not joined:
        return np.zeros(0, dtype=np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 0x20)
    if len(gaps) + 1 <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        starts = np.concatenate([[0], gaps[:len(gaps) + 1 - shingle] + 1]).tolist()
        ends = np.concatenate([gaps[shingle - 1:], [len(joined)]]).tolist()
    hashes = (xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(starts, ends, strict=True))
    return np.unique(np.fromiter(hashes, dtype=np.uint64, count=len(starts)).view(np.int64))


def needed(a, b, percent: int = PERCENT):
    """Common elements that make sets of sizes a and b link."""
    return -(-percent * (a + b) // (100 + percent))


def reach(n, percent: int = PERCENT):
    """Elements of a set of size n, or of sizes n, that are looked at in the first step."""
    return np.minimum(n, (n - -(-percent * n // 100)) * 5 // 3 + 24)


def _ints(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _sets(shingle: int, percent: int):
    """(id, n, key of the set, the elements looked at)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in chunks(batch):
                sets = [elements(t, shingle) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    piece.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    _ints([s if len(s) <= WHOLE else s[:reach(len(s), percent)] for s in sets])],
                    names=["id", "n", "key", "seen"])
    return run


def parities(elements: np.ndarray) -> np.ndarray:
    """Whether the number of a set's elements at each of ``BITS`` places is odd, in words of 64 bits."""
    odd = np.bincount(elements & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _alike(na: Column, nb: Column, percent: int) -> Column:
    """Whether sets with parities bits_a and bits_b may differ in as few elements as linked sets of their sizes do."""
    apart = sum((F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
    return apart <= na + nb - 2 * _needed(na, nb, percent)


def _whole_sets(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch):
                sets = [elements(t, shingle) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), _ints(sets), _ints([parities(s) for s in sets])],
                    names=["key", "set", "bits"])
    return run


def partner_sizes(n: int, most: int, percent: int = PERCENT) -> range:
    """Sizes from n's smallest partner to its largest, or to ``most``."""
    return range(-(-percent * n // 100), min(100 * n // percent, most) + 1)


def subset_count(n: int, most: int, percent: int = PERCENT) -> int:
    return sum(comb(n, needed(n, t, percent)) for t in partner_sizes(n, most, percent))


def boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The largest light size, at which both parts cost least. ``sizes``: classes of each size up to ``WHOLE``."""
    def cost(most: int) -> int:
        light = sum(k * subset_count(n, most, percent) for n, k in sizes.items() if n <= most)
        return light + sum(k * ENTRY_COST * reach(n, percent) for n, k in sizes.items() if 100 * n > percent * most)
    return min(range(WHOLE + 1), key=cost)


def _subsets(most: int, percent: int):
    """(lo, hi, key of the subset, c, n) of light sets, a subset for each partner size."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, n, seen in zip(*(batch.column(x).to_pylist() for x in ("c", "n", "seen")), strict=True):
                for t in partner_sizes(n, most, percent):
                    keys = [xxhash.xxh3_128_digest(np.array(s, dtype=np.int64).tobytes())
                            for s in combinations(seen, needed(n, t, percent))]
                    k = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([min(n, t)] * k, pa.int64()), pa.array([max(n, t)] * k, pa.int64()),
                         pa.array(keys, pa.binary()), pa.array([c] * k, pa.int64()), pa.array([n] * k, pa.int64())],
                        names=["lo", "hi", "part", "c", "n"])
    return run


def _light_links(classes: DataFrame, most: int, percent: int) -> DataFrame:
    light = classes.where(F.col("n").between(1, most)).select("c", "n", "seen")
    parts = light.mapInArrow(_subsets(most, percent), "lo long, hi long, part binary, c long, n long")
    at = ["lo", "hi", "part"]
    # two sets of the smaller size that share a subset link as well, so one of them is a centre
    centres = parts.groupBy(*at).agg(F.min(F.when(F.col("n") == F.col("lo"), F.col("c"))).alias("a"), F.count("*").alias("k"))
    return parts.join(centres.where("a is not null and k > 1").drop("k"), at).where("c <> a").select("a", F.col("c").alias("b"))


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def _needed(a: Column, b: Column, percent: int) -> Column:
    return _ceil_div(percent * (a + b), 100 + percent)


def _first(n: Column, percent: int) -> Column:
    return n - _ceil_div(percent * n, 100) + 1


def _likely(shared: DataFrame, most: int, percent: int) -> DataFrame:
    """``shared`` (e, a, b, na, nb, pa, pb), a row per common list e -> pairs that share enough lists, with one of these.

    Of the first n - needed + 1 elements of both sets, by their places pa and pb, one is
    common; of ``more`` elements more, ``more`` others are. Rare elements have early places,
    so a frequent one brings two sets together only where they have little else.
    """
    na, nb = F.col("na"), F.col("nb")
    need = _needed(na, nb, percent)
    more = F.least(F.floor(need / MORE), need - _ceil_div(percent * F.greatest(na, nb), 100)).cast("long")
    sizes_fit = (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (F.greatest(na, nb) > most)
    early = (F.col("pa") <= na - need + more) & (F.col("pb") <= nb - need + more)
    counted = shared.where(sizes_fit & early).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("m"), F.min("e").alias("e"))
    return counted.where(F.col("m") > more).select("e", "a", "b", "na", "nb")


def _compared(cell: pa.Table) -> pa.Table:
    """The sets of a cell and whom each is compared with -> pairs that share as much as they need."""
    cell = cell.combine_chunks()
    c, (sets, others, need) = cell.column("c").to_pylist(), (cell.column(x).combine_chunks() for x in ("set", "b", "need"))
    row = {x: i for i, x in enumerate(c)}
    elements_of = [np.sort(sets[i].values.to_numpy()) for i in range(len(c))]
    a, b = [], []
    for i, mine in enumerate(elements_of):
        for other, least in zip(others[i].as_py(), need[i].as_py(), strict=True):
            theirs = elements_of[row[other]]
            few, many = (mine, theirs) if len(mine) < len(theirs) else (theirs, mine)
            at = np.minimum(np.searchsorted(many, few), len(many) - 1)
            if (many[at] == few).sum() >= least:
                a.append(c[i])
                b.append(other)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets (c, set) share as much as they need."""
    # pairs of one list meet in cells of two tiles of its sets, so a set moves once a cell, not once a pair
    members = pairs.select("e", F.col("a").alias("c")).unionByName(pairs.select("e", F.col("b").alias("c"))).distinct()
    tiles = members.groupBy("e").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tile_a, tile_b = (F.pmod(F.xxhash64(x), "tiles") for x in "ab")
    cells = pairs.join(tiles, "e").select("e", F.least(tile_a, tile_b).alias("t"), F.greatest(tile_a, tile_b).alias("u"), "a", "b",
                                          _needed(F.col("na"), F.col("nb"), percent).alias("need"))
    ends = cells.select("e", "t", "u", F.explode(F.array(
        F.struct(F.col("a").alias("c"), F.struct("b", "need").alias("other")), F.struct(F.col("b").alias("c"), F.lit(None).alias("other")))).alias("x"))
    at = ends.groupBy("e", "t", "u", "x.c").agg(F.collect_list("x.other").alias("other"))
    placed = at.select("e", "t", "u", "c", F.col("other.b").alias("b"), F.col("other.need").alias("need")).join(sets.select("c", "set"), "c")
    return placed.groupBy("e", "t", "u").applyInArrow(_compared, "a long, b long")


def may_link(n: int, places: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether a set of size n, whose shared elements have these (rising) places, can have a partner of any size.

    What a partner of size t looks at reaches to at least the r-th element of this set,
    r = reach(t) - t + needed(n, t); of these it lacks at most n - needed(n, t).
    """
    t = np.arange(-(-percent * n // 100), 100 * n // percent + 1)
    common = needed(n, t, percent)
    r = np.minimum(reach(t, percent) - t + common, reach(n, percent))
    return bool((np.searchsorted(places, r) >= r - n + common).any())


def _near(percent: int):
    """(c, n, places of shared elements) -> c of the sets that may link."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, n = batch.column("pos").flatten().to_numpy(), batch.column("n").to_numpy()
            ends = np.cumsum(np.diff(batch.column("pos").offsets.to_numpy()))
            stay = [may_link(int(size), np.sort(at), percent) for size, at in zip(n, np.split(places, ends[:-1]), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("c").filter(pa.array(stay, pa.bool_()))], names=["c"])
    return run


def _shared(dealt: DataFrame) -> DataFrame:
    """``dealt`` (c, n, pos, e) by e -> the same rows with k, the number of sets that have e, where it is above 1."""
    # the counts name all columns, as only then both sides read the same shuffle
    common = dealt.groupBy("e").agg(
        F.count("*").alias("k"), F.max("c").alias("last_c"), F.max("n").alias("last_n"), F.max("pos").alias("last_pos")).where(
        "k > 1 and last_c >= 0 and last_n >= 0 and last_pos >= 0")
    return dealt.join(common.select("e", "k").hint("merge"), "e")


def _candidates(classes: DataFrame, most: int, percent: int) -> DataFrame:
    """c of the sets that may link with a heavy one."""
    n = F.col("n")
    seen = classes.where(100 * n > percent * most).select("c", "n", F.posexplode(
        F.slice("seen", F.lit(1), F.least(n, F.floor((n - _ceil_div(percent * n, 100)) * 5 / 3) + 24).cast("int"))).alias("pos", "e"))
    # one shuffle serves the counts and the join. A set has an element once, so the longest
    # list is one part in hundreds of all entries, and both sides of the join stream it.
    by_set = _shared(seen.repartition("e")).groupBy("c", "n").agg(F.collect_list("pos").alias("pos"))
    return by_set.mapInArrow(_near(percent), "c long")


def _whole(classes: DataFrame, candidates: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(c, n, set, bits) of the candidates; only their texts are read again."""
    named = fixed(classes.join(candidates, "c", "left_semi").select("c", "n", "key", "least"))
    ids = named.select(F.col("least").alias("id")).distinct()
    texts = docs.join(F.broadcast(ids) if named.count() <= BROADCAST_IDS else ids, "id", "left_semi").select("text")
    sets = texts.mapInArrow(_whole_sets(shingle), "key binary, set array<long>, bits array<long>")
    # rows that repeat an id bring other texts, or one text again: one set for each key
    return sets.join(named, "key").groupBy("c", "n").agg(F.first("set").alias("set"), F.first("bits").alias("bits"))


def _lists(sets: DataFrame, percent: int) -> DataFrame:
    """(e, c, n, place, shared): inverted lists of the rarest elements, with their places in the sets' order.

    ``shared`` counts, in millionths, what of a set others have too.
    """
    n = F.col("n")
    dealt = sets.select("c", "n", F.posexplode("set").alias("pos", "e")).repartition("e")
    by_set = _shared(dealt).groupBy("c", "n").agg(F.array_sort(F.collect_list(F.struct("k", "e"))).alias("at"))
    # elements that no other set has come first in the order
    alone = n - F.size("at")
    stay = F.greatest(F.lit(0), _first(n, percent) - alone).cast("int")
    shared = F.floor(1e6 * F.size("at") / n).cast("long")
    listed = by_set.select("c", "n", shared.alias("shared"), alone.alias("alone"), F.posexplode(F.slice("at", F.lit(1), stay)).alias("i", "x"))
    return listed.select("x.e", "c", "n", (F.col("alone") + F.col("i")).alias("place"), "shared")


def _heavy_links(classes: DataFrame, docs: DataFrame, most: int, shingle: int, percent: int) -> DataFrame:
    candidates = settled(lambda: _candidates(classes, most, percent))
    sets = settled(lambda: _whole(classes, candidates, docs, shingle))
    lists = settled(lambda: _lists(sets, percent))
    heads = lists.groupBy("e").agg(F.max(F.struct("shared", "c", "n", "place")).alias("head"), F.count("*").alias("k")).where("k > 1")
    # the original shares more than its edited copies do
    met = lists.join(heads, "e").where("c <> head.c").select(
        "e", F.col("head.c").alias("a"), F.col("c").alias("b"), F.col("head.n").alias("na"), F.col("n").alias("nb"),
        F.col("head.place").alias("pa"), F.col("place").alias("pb"))
    first = fixed(_verified(fixed(_likely(met, most, percent)), sets, percent))
    groups = connected(first)
    placed = lists.join(groups.withColumnRenamed("node", "c"), "c", "left").select("e", "c", "n", "place", F.coalesce("root", "c").alias("g"))
    parts = placed.groupBy("e", "g").agg(F.count("*").alias("k"))
    main = parts.groupBy("e").agg(F.max(F.struct("k", "g")).alias("top"), F.count("*").alias("groups")).where("groups > 1")
    open_lists = fixed(placed.join(main.select("e", F.col("top.g").alias("main")), "e").join(sets.select("c", "bits"), "c"))
    few = open_lists.where("g <> main").select(
        "e", F.col("c").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("g").alias("ga"), F.col("bits").alias("bits_a"))
    rest = open_lists.select("e", F.col("c").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("g").alias("gb"), "main", F.col("bits").alias("bits_b"))
    # two sets outside of the main component meet once
    met = few.join(rest, "e").where((F.col("ga") != F.col("gb")) & ((F.col("gb") == F.col("main")) | (F.col("a") < F.col("b")))
                                   & _alike(F.col("na"), F.col("nb"), percent))
    second = _verified(fixed(_likely(met, most, percent)), sets, percent)
    return first.unionByName(second)


def _classes(rows: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows as (id, n, key), and different sets as (c, key, n, least id, elements looked at)."""
    seen, path = written(rows.mapInArrow(_sets(shingle, percent), "id long, n long, key binary, seen array<long>"), "jaccard-sets")
    sets = fixed(seen.select("id", "n", "key"))
    classes = settled(lambda: seen.where("n > 0").groupBy("key", "n").agg(F.min("id").alias("least"), F.first("seen").alias("seen")).select(
        F.monotonically_increasing_id().alias("c"), "key", "n", "least", "seen"))
    discarded(rows.sparkSession, path)
    return sets, classes


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles and component_id, the smallest id reachable by links."""
    if not 50 < percent <= 100:
        raise ValueError("percent is above 50 and at most 100")
    rows = docs.select(id_or_last(id).alias("id"), F.col(text).alias("text"))
    sets, classes = _classes(rows, shingle, percent)
    sizes = dict(classes.where(F.col("n") <= WHOLE).groupBy("n").count().collect())
    most = boundary(sizes, percent)
    links = _light_links(classes, most, percent).unionByName(_heavy_links(classes, rows, most, shingle, percent))
    groups = connected(links)
    placed = classes.join(groups.withColumnRenamed("node", "c"), "c", "left").select("key", "least", F.coalesce("root", "c").alias("g"))
    least = placed.groupBy("g").agg(F.min("least").alias("component"))
    component = placed.join(least, "g").select("key", "component")
    return sets.select("id", "n", "key").join(component, "key", "left").select(
        last_to_null(F.col("id")).alias(id), F.col("n").alias("n_shingles"),
        last_to_null(F.coalesce("component", "id")).alias("component_id"))
