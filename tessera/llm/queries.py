"""Queries p8_ to p10_ and the SQL their results are checked with."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import contamination, mixture, shared_spans
from tessera.session import cut


def _read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# 8 ---------------------------------------------------------------------------------------------


def _leaks(spark, folder):
    return contamination.matches(_read(spark, folder, "documents"), _read(spark, folder, "eval_item"))


def p8_found(spark, folder):
    return _leaks(spark, folder).select("doc_id", "item_id")


def p8_items(spark, folder):
    """Per leaked item: the documents that hold a passage of it and the longest passage."""
    return _leaks(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("n_words").alias("longest_words"))


def p8_clean(spark, folder):
    """The corpus without the documents concerned, all columns."""
    return contamination.clean(_read(spark, folder, "documents"), _leaks(spark, folder))


_GRAM_SQL = """
WITH t AS (SELECT 'd' k, doc_id i, text FROM documents UNION ALL SELECT 'e', item_id, text FROM eval_item),
w AS (SELECT k, i, list_filter(regexp_split_to_array(strip_accents(lower(regexp_replace(text, '\\p{Cf}', '', 'g'))), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') w FROM t),
g AS (SELECT DISTINCT k, i, array_to_string(w[p:p + 12], ' ') g FROM (SELECT k, i, w, unnest(range(1, len(w) - 11)) p FROM w)),
m AS (SELECT DISTINCT d.i doc_id, e.i item_id FROM g d JOIN g e ON d.g = e.g WHERE d.k = 'd' AND e.k = 'e')
"""

_PLACE_SQL = _GRAM_SQL.rstrip() + """,
gp AS (SELECT k, i, p, array_to_string(w[p:p + 12], ' ') g FROM (SELECT k, i, w, unnest(range(1, len(w) - 11)) p FROM w)),
hits AS (SELECT d.i doc_id, e.i item_id, d.p dp, e.p ip FROM gp d JOIN gp e ON d.g = e.g WHERE d.k = 'd' AND e.k = 'e'),
islands AS (SELECT *, dp - row_number() OVER (PARTITION BY doc_id, item_id, dp - ip ORDER BY dp) b FROM hits),
runs AS (SELECT doc_id, item_id, count(*) + 12 n FROM islands GROUP BY doc_id, item_id, dp - ip, b)
"""

# 9 ---------------------------------------------------------------------------------------------


#: The vocabulary file of a public tokenizer; the session's setting ``tessera.tokenizer`` names another.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def _mixed(spark, folder, tokenizer=None):
    wanted = _read(spark, folder, "mixture_target")
    chosen = mixture.targeted(_read(spark, folder, "documents"), wanted)
    sizes = cut(mixture.token_counts(chosen, tokenizer or spark.conf.get("tessera.tokenizer", TOKENIZER)), "tokens")
    planned = mixture.rates(sizes, wanted)
    return planned, mixture.copies(sizes, planned)


def p9_shares(spark, folder):
    """Per target: what there is, what was aimed at and what came out."""
    planned, counted = _mixed(spark, folder)
    return mixture.report(counted, planned)


def p9_mixture(spark, folder):
    """The mixture itself, one row per copy."""
    return mixture.mixture(_mixed(spark, folder)[1])


def _rounded(report):
    return report.select(*[F.round(c, 9).alias(c) if kind == "double" else c for c, kind in report.dtypes])


def p9_byte_shares(spark, folder):
    """``p9_shares`` in tokens of the byte tokenizer, which SQL can count too."""
    planned, counted = _mixed(spark, folder, mixture.BYTES)
    return _rounded(mixture.report(counted, planned))


def p9_byte_mixture(spark, folder):
    """``p9_mixture`` in tokens of the byte tokenizer."""
    return mixture.mixture(_mixed(spark, folder, mixture.BYTES)[1])


_MIX_SQL = """
WITH t AS (SELECT source, min((target_share, max_repeats)) m FROM mixture_target WHERE source IS NOT NULL AND target_share > 0 AND max_repeats > 0 GROUP BY 1),
d AS (SELECT doc_id, source, coalesce(strlen(text), 0) n FROM documents),
j AS (SELECT t.source, struct_extract_at(m, 1) ts, struct_extract_at(m, 2) mr, coalesce(n, 0) n, coalesce(k, 0) k
  FROM t LEFT JOIN (SELECT source, CAST(sum(n) AS BIGINT) n, count(*) k FROM d GROUP BY 1) s USING (source)),
x AS (SELECT sum(ts) FILTER (n > 0) p, min(n * mr / ts) FILTER (n > 0) r FROM j),
r AS (SELECT j.*, CASE WHEN n > 0 THEN ts / p END aim, CASE WHEN n > 0 THEN least(mr, ts / p * (r * p) / n) END rate FROM j, x),
c AS (SELECT doc_id, source, d.n, CAST(floor(rate) + CASE WHEN CAST('0x' || md5('0:' || doc_id)[:13] AS BIGINT) / 4503599627370496 < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) q
  FROM d JOIN r USING (source) WHERE rate IS NOT NULL)
"""

# 10 --------------------------------------------------------------------------------------------


def p10_found(spark, folder):
    return shared_spans.SharedSpans(_read(spark, folder, "documents")).pairs()


def p10_shares(spark, folder):
    """How much of each document also stands in others."""
    return shared_spans.SharedSpans(_read(spark, folder, "documents")).shares()


_WINDOW_SQL = """
WITH w AS (SELECT doc_id, p, substring(text, p, 100) s FROM (SELECT doc_id, text, unnest(range(1, length(text) - 98)) p FROM documents WHERE length(text) >= 100))
"""

QUERIES = {f.__name__: f for f in (p8_found, p8_items, p8_clean, p9_shares, p9_mixture, p9_byte_shares, p9_byte_mixture, p10_found, p10_shares)}
ORACLES = {
    "p8_found": _GRAM_SQL + "SELECT doc_id, item_id FROM m",
    "p8_items": _PLACE_SQL + "SELECT item_id, count(DISTINCT doc_id) AS n_documents, max(n) AS longest_words FROM runs GROUP BY 1",
    "p8_clean": _GRAM_SQL + "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM m)",
    "p9_byte_shares": _MIX_SQL + """, o AS (SELECT source, CAST(sum(n * q) AS BIGINT) mt, max(q) mc FROM c GROUP BY 1)
SELECT source, ts AS target_share, mr AS max_repeats, k AS n_documents, n AS n_tokens, round(aim, 9) AS aimed_share, round(rate, 9) AS rate, coalesce(mt, 0) AS mixed_tokens,
  coalesce(mc, 0) AS most_copies, coalesce(round(mt / (SELECT sum(mt) FROM o), 9), 0) AS actual_share FROM r LEFT JOIN o USING (source)""",
    "p9_byte_mixture": _MIX_SQL + "SELECT doc_id, source, n AS n_tokens, unnest(range(1, q + 1)) AS copy_no FROM c WHERE q > 0",
    "p10_found": _WINDOW_SQL + "SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM w a JOIN w b ON a.s = b.s AND a.doc_id < b.doc_id",
    "p10_shares": _WINDOW_SQL + """, h AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT doc_id, count(DISTINCT q) n FROM (SELECT doc_id, unnest(range(p, p + 100)) q FROM w SEMI JOIN h USING (s)) GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN d.doc_id ELSE min(d.doc_id) OVER (PARTITION BY d.text) END AS class_id, length(d.text) AS n_chars,
  coalesce(c.n, 0) AS shared_chars, CASE WHEN length(d.text) > 0 THEN round(coalesce(c.n, 0) / length(d.text), 6) END AS shared_share FROM documents d LEFT JOIN c USING (doc_id)""",
}
