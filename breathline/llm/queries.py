"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.llm import debruijn, divergence, jaccard, kneser_ney, langid, lines, maincontent, pseudonyms, qgram_filter, refine, sampling, simhash, vectorcode
from breathline.llm.common import table


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", F.col("clean_text").alias("text"), "n_replaced")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "n", F.round("perplexity", 6).alias("perplexity"), F.round("threshold", 6).alias("threshold"), "kept")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item found in it."""
    return qgram_filter.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = debruijn.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = sampling.sample_mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(langid.learnable(docs)))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = refine.refine(table(spark, sf_dir, "documents"), digest_all=True)
    return found.withColumnRenamed("content_sha256", "text_sha256")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maincontent.extract(table(spark, sf_dir, "pages"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcode.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_pseudonyms, op2_quality, op3_decontaminate, op4_substring_dedup, op5_simhash, op6_mix_sources, op7_line_dedup, op8_language, op9_exact_dedup,
    op10_main_text, op11_jaccard_join, op12_source_divergence, op13_vector_codes,
)}

_OP4 = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS pos,
         unnest(list_transform(range(1, len(words) - 11), lambda i: array_to_string(words[i:i + 12], ' '))) AS edge
  FROM d),
f AS (SELECT edge, min(doc_id) AS first FROM w GROUP BY edge HAVING min(doc_id) < max(doc_id)),
m AS (SELECT w.doc_id, w.pos FROM w JOIN f USING (edge) WHERE f.first < w.doc_id),
g AS (SELECT DISTINCT doc_id, pos + i AS pos FROM m, (SELECT unnest(range(0, 13)) AS i)),
a AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
k AS (
  SELECT a.doc_id, count(g.pos) AS n_removed,
         string_agg(a.word, ' ' ORDER BY a.pos) FILTER (g.pos IS NULL) AS kept
  FROM a LEFT JOIN g USING (doc_id, pos) GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_OP6 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src, coalesce(CAST(doc_id AS VARCHAR), '') AS name,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
t AS (SELECT source, src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source, src),
w AS (SELECT *, 2 * source_size AS stop, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM t),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
             - coalesce(CAST(sum(stop) OVER (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
            / CAST(sum(weight) OVER (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w),
g AS (SELECT src, source_size, least(CAST(stop AS DOUBLE), coalesce(max(CASE WHEN level * weight <= stop THEN level END) OVER () * weight, CAST(stop AS DOUBLE))) AS target FROM l),
r AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix' || src), 1, 5) AS BIGINT) AS DOUBLE) / 1048576 AS o,
         row_number() OVER (PARTITION BY src ORDER BY CAST(floor(ln(size + 1) * 8) AS INT), md5(name), name, size) - 1 AS k
  FROM d JOIN g USING (src))
SELECT doc_id, size, source_size, target,
       CAST(floor(rate * (k + 1) + o) - floor(rate * k + o) AS BIGINT) * size AS taken
FROM r
"""

_OP7 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > r.first, false) AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT *, first(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

_OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
                        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents),
t AS (SELECT lang, source, row, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (s.n + 5 * v.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (k.n + 5) // (v.n + 5 * v.v) AS q
  FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""


def _op13_round(n: int) -> str:
    """One round: each part's nearest entry, and the entries moved to the floor of their parts' mean."""
    return rf"""
a{n} AS (SELECT DISTINCT ON (v.row, v.part) v.row, v.part, b.entry, v.p,
                list_sum(list_transform(range(1, len(v.p) + 1), lambda i: (v.p[i] - b.p[i]) * (v.p[i] - b.p[i]))) AS d
         FROM v JOIN b{n} AS b USING (part) ORDER BY v.row, v.part, d, b.entry),
b{n + 1} AS (
  SELECT b.part, b.entry, coalesce(m.p, b.p) AS p
  FROM b{n} AS b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % k) + k) % k) / k AS BIGINT) ORDER BY i) AS p
    FROM (SELECT part, entry, i, CAST(sum(p[i]) AS DOUBLE) AS s, count(*) AS k
          FROM (SELECT part, entry, p, unnest(range(1, len(p) + 1)) AS i FROM a{n}) GROUP BY part, entry, i)
    GROUP BY part, entry) AS m USING (part, entry)),"""


_OP13 = rf"""
WITH e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT row, part, x[part * (len(x) // 16) + 1:(part + 1) * (len(x) // 16)] AS p FROM e, (SELECT unnest(range(0, 16)) AS part)),
b0 AS (SELECT part, row AS entry, p FROM v WHERE row < 64),
{_op13_round(0)}
{_op13_round(1)}
a AS (SELECT DISTINCT ON (v.row, v.part) v.row, v.part, b.entry,
             list_sum(list_transform(range(1, len(v.p) + 1), lambda i: (v.p[i] - b.p[i]) * (v.p[i] - b.p[i]))) AS d
      FROM v JOIN b2 AS b USING (part) ORDER BY v.row, v.part, d, b.entry),
c AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM e JOIN c USING (row)
"""

ORACLE = {"op4_substring_dedup": _OP4, "op6_mix_sources": _OP6, "op7_line_dedup": _OP7, "op9_exact_dedup": _OP9, "op12_source_divergence": _OP12, "op13_vector_codes": _OP13}
