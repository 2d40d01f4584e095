"""Ordered operators without one task per key.

A device may hold a third of all rows, so nothing here sorts or collects a whole
device. Rows are cut into chunks of the order column (``pos // width``); a chunk
holds at most ``width`` rows per key because ``pos`` is unique within the key. What
crosses a chunk border is a small summary per chunk.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

LAG_WIDTH = 1 << 20
FOLD_WIDTH = 1 << 11


def _chunk(pos: str, width: int) -> Column:
    return F.expr(f"`{pos}` div {width}L")


def with_lags(
    df: DataFrame, keys: list[str], pos: str, value: Column, n: int = 1,
    prefix: str = "lag_", width: int = LAG_WIDTH,
) -> DataFrame:
    """Add ``lag_1`` .. ``lag_n`` of ``value`` per key in ``pos`` order."""
    chunked = df.withColumn("_chunk", _chunk(pos, width)).withColumn("_value", value)
    cell = [*keys, "_chunk"]
    tails = _last_rows(chunked.select(*cell, pos, "_value"), cell, pos, n)
    # Every chunk in ``tails`` has a row, so n chunks hold the n rows before this one.
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-n, -1)
    carried = tails.select(*cell, F.flatten(F.collect_list("_tail").over(before)).alias("_carried"))

    # Windows first: their sort then serves the join as well.
    inside = Window.partitionBy(*cell).orderBy(pos)
    reach = range(1, n + 1)
    windowed = chunked.withColumns({
        "_row": F.row_number().over(inside), **{f"_in{k}": F.lag("_value", k).over(inside) for k in reach},
    })
    joined = windowed.join(carried, cell)
    for k in reach:
        from_before = F.try_element_at("_carried", F.col("_row") - F.lit(k + 1))["_value"]
        joined = joined.withColumn(f"{prefix}{k}", F.when(F.col("_row") > k, F.col(f"_in{k}")).otherwise(from_before))
    return joined.drop("_chunk", "_value", "_row", "_carried", *[f"_in{k}" for k in reach])


def _last_rows(rows: DataFrame, cell: list[str], pos: str, n: int) -> DataFrame:
    """The last ``n`` values of each cell in ``pos`` order, as the array ``_tail``."""
    if n == 1:  # fixed-width buffers: aggregates by hash, without a sort
        last = rows.groupBy(*cell).agg(F.max(pos).alias(pos), F.max_by("_value", pos).alias("_value"))
        return last.select(*cell, F.array(F.struct(pos, "_value")).alias("_tail"))
    backwards = Window.partitionBy(*cell).orderBy(F.desc(pos))
    return (
        rows.withColumn("_rank", F.row_number().over(backwards)).filter(F.col("_rank") <= n)
        .groupBy(*cell).agg(F.sort_array(F.collect_list(F.struct(pos, "_value"))).alias("_tail"))
    )


def with_ordinal(
    df: DataFrame, keys: list[str], chunk: Column, order: list[str], name: str
) -> DataFrame:
    """Number the rows of each key from 1 in ``order``. ``chunk`` must not fall along ``order``."""
    chunked = df.withColumn("_chunk", chunk)
    cell = [*keys, "_chunk"]
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
        .select(*cell, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*cell).orderBy(*order)
    return (
        chunked.withColumn("_row", F.row_number().over(inside)).join(offsets, cell)
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_chunk", "_before", "_row")
    )


def id_chunk(width: int = LAG_WIDTH) -> Column:
    return _chunk("id", width)


def with_states(
    df: DataFrame, keys: list[str], pos: str, code: str, n_states: int,
    step: Callable[[Column, Column], Column], carry: list[str] | None = None,
    width: int = FOLD_WIDTH, levels: int = 2,
) -> DataFrame:
    """Run a small state machine over each key in ``pos`` order, starting in state 0.

    Returns ``keys, pos, code, state`` and the ``carry`` columns, with the state *before*
    each row. A chunk of rows acts as a map from start state to end state, and maps
    compose, so chunks are folded apart, level by level, and replayed once their start
    state is known. The arrays hold at most ``width`` entries, those of the top level
    ``max(pos) / width**levels``.
    """
    carry = carry or []
    rows = (
        df.select(*keys, F.col(pos).alias("_pos"), F.col(code).cast("int").alias("_code"), *carry)
        .groupBy(*keys, F.expr(f"_pos div {width}L").alias("_c1"))
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "_code", *carry))).alias("_items"))
    )
    identity = F.array(*[F.lit(s) for s in range(n_states)])

    def through_codes(ends: Column, item: Column) -> Column:
        return F.transform(ends, lambda s: step(s, item["_code"]))

    def through_maps(ends: Column, item: Column) -> Column:
        return F.transform(ends, lambda s: F.get(item["_map"], s))

    tiers = [rows]
    maps = rows.select(*keys, "_c1", F.aggregate("_items", identity, through_codes).alias("_map"))
    for level in range(2, levels + 1):
        child, parent = f"_c{level - 1}", f"_c{level}"
        tier = (
            maps.groupBy(*keys, F.expr(f"{child} div {width}L").alias(parent))
            .agg(F.sort_array(F.collect_list(F.struct(child, "_map"))).alias("_items"))
        )
        tiers.append(tier)
        maps = tier.select(*keys, parent, F.aggregate("_items", identity, through_maps).alias("_map"))
    top = f"_c{levels}"
    roots = maps.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(top, "_map"))).alias("_items"))

    def starts(state: Column, follow: Callable[[Column, Column], Column]) -> Column:
        """The state before each item, folded from ``state``."""
        seed = F.struct(state.alias("s"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate("_items", seed, lambda acc, item: F.struct(
            follow(acc["s"], item).alias("s"), F.concat(acc["seen"], F.array(acc["s"])).alias("seen")
        ))["seen"]

    def by_map(state: Column, item: Column) -> Column:
        return F.get(item["_map"], state)

    known = roots.withColumn("_start", F.lit(0))
    for level in range(levels, 0, -1):
        child = f"_c{level}"
        known = (
            known.select(*[k for k in known.columns if k in keys], F.explode(
                F.arrays_zip(F.col("_items"), starts(F.col("_start"), by_map).alias("_from"))
            ).alias("_x"))
            .select(*keys, F.col(f"_x._items.{child}").alias(child), F.col("_x._from").alias("_start"))
            .join(tiers[level - 1], [*keys, child])
        )
    return known.select(*keys, F.explode(F.arrays_zip(
        F.col("_items"), starts(F.col("_start"), lambda s, item: step(s, item["_code"])).alias("_from")
    )).alias("_x")).select(
        *keys, F.col("_x._items._pos").alias(pos), F.col("_x._items._code").alias(code),
        F.col("_x._from").alias("state"), *[F.col(f"_x._items.{c}").alias(c) for c in carry],
    )


def with_time_buckets(df: DataFrame, us: str, window_us: int, bucket_us: int) -> DataFrame:
    """Cut time into ``_bucket``s and copy the last ``window_us`` of each into the next.

    The copies carry ``_halo``: they complete the frames of the next bucket's first rows.
    """
    if bucket_us < window_us:
        raise ValueError("a bucket must be at least as long as the window")
    own = F.expr(f"{us} div {bucket_us}L")
    near_end = F.col(us) + F.lit(window_us) >= (own + 1) * F.lit(bucket_us)
    homes = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_bucket", F.explode(homes)).withColumn("_halo", F.col("_bucket") != own)
