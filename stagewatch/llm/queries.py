"""Registered queries of the subpackage, one per operator, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stagewatch.llm import (
    alignment, conversations, decontaminate, html_extract, licenses, mixing, neardup, packing, quality, sharding, substring,
    token_counts, token_files,
)

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers  # where the vocabulary files are is known to the environment, not to this library

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", neardup.fingerprint_text().alias("fingerprint"), "component_id")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents")).drop("detections")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(_table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_MODEL))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(_table(spark, sf_dir, "conversations"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_report(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_simhash, op3_shards, op4_substring_dedup, op5_licenses, op6_decontaminate, op7_main_text,
        op8_token_counts, op9_quality, op10_token_files, op11_alignment, op12_conversation_repair, op13_packing,
    )
}

ORACLE = {
    "op1_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source
), prefix AS (
  SELECT (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER earlier, 0)) / sum(w) OVER later AS level
  FROM sources
  WINDOW earlier AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         later AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT source, source_size, least(2.0 * source_size, (SELECT max(level) FROM prefix) * w)::DOUBLE AS target FROM sources
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END * source_size AS rest
  FROM targets
), running AS (
  SELECT s.*, r.source_size, r.target, r.copies, r.rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h)::BIGINT AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h)::BIGINT AS tied
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= rest OR (upto - tied <= rest AND upto - rest < rest - (upto - tied)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
""",
    "op6_decontaminate": r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), doc_windows AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
  SELECT d.r, d.n, d.i, t.item_id FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.win = t.win
), covered AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.r = c.r LEFT JOIN items i ON d.r = i.r
""",
    "op4_substring_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
), firsts AS (
  SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win
), gone AS (
  SELECT r, list(DISTINCT pos) AS gone
  FROM (SELECT r, unnest(range(i, i + 50)) AS pos FROM windows JOIN firsts USING (win) WHERE first_id < coalesce(doc_id, 9223372036854775807))
  GROUP BY r
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(g.gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN g.gone IS NULL THEN d.w
              ELSE list_transform(list_sort(list_filter(range(1, len(d.w) + 1), lambda k: NOT list_contains(g.gone, k))), lambda k: d.w[k]) END,
         ' '), '')) AS kept_sha256
FROM docs d LEFT JOIN gone g ON d.r = g.r
""",
    "op9_quality": r"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s0 AS (SELECT *, array_to_string(w, '') AS a FROM raw),
s1 AS (SELECT *, regexp_replace(a, '[a-zß-öø-ÿ]+', '', 'g') AS b FROM s0),
s2 AS (SELECT *, regexp_replace(b, '[#*$%&|<>]+', '', 'g') AS c FROM s1),
s3 AS (SELECT *, regexp_replace(c, '[A-ZÀ-ÖØ-Þ]+', '', 'g') AS d FROM s2),
s4 AS (SELECT *, regexp_replace(d, '[.,;:!?''"()\-]+', '', 'g') AS e FROM s3),
s5 AS (SELECT *, regexp_replace(e, '[0-9]+', '', 'g') AS f FROM s4),
measured AS (
  SELECT r, doc_id, lang, t, w, len(w) AS n, length(a) AS word_chars, length(b) - length(c) AS n_symbols,
         [length(t) - length(a), length(a) - length(b), length(b) - length(c), length(c) - length(d), length(d) - length(e),
          length(e) - length(f), length(f)] AS classes,
         list_transform(COMMON, lambda k: len(list_filter(w, lambda x: x = k))) AS common,
         list_transform(['#', '*', '$', '%', '&', '|', '<', '>'], lambda k: length(t) - length(replace(t, k, ''))) AS symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM s5
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT r, w, unnest(range(1, n - 1)) AS i FROM measured WHERE n >= 3)
), repeated AS (
  SELECT r, count(DISTINCT pos) AS n_repeat FROM (SELECT r, unnest([i, i + 1, i + 2]) AS pos FROM windows WHERE times > 1) GROUP BY r
), cells AS (
  SELECT r, lang, 'class' AS kind, unnest(classes) AS v, generate_subscripts(classes, 1) AS k, length(t) AS total FROM measured
  UNION ALL
  SELECT r, lang, 'symbol', unnest(list_append(symbols, length(t) - list_sum(symbols))), generate_subscripts(list_append(symbols, 0), 1), length(t) FROM measured
  UNION ALL
  SELECT r, lang, 'word', unnest(list_append(common, n - list_sum(common))), generate_subscripts(list_append(common, 0), 1), n FROM measured
), langs AS (
  SELECT lang, sum(n) >= 2000 AS enough FROM measured GROUP BY lang
), refs AS (
  SELECT lang, kind, k, sum(v) / greatest(sum(sum(v)) OVER (PARTITION BY lang, kind), 1)::DOUBLE AS q FROM cells GROUP BY lang, kind, k
), pool AS (
  SELECT kind, k, sum(v) / greatest(sum(sum(v)) OVER (PARTITION BY kind), 1)::DOUBLE AS q FROM cells GROUP BY kind, k
), compared AS (
  SELECT c.r, c.kind, c.k, l.enough, c.v / greatest(c.total, 1)::DOUBLE AS p, CASE WHEN l.enough THEN f.q ELSE o.q END AS q
  FROM cells c JOIN langs l ON l.lang = c.lang JOIN refs f ON f.lang = c.lang AND f.kind = c.kind AND f.k = c.k
  JOIN pool o ON o.kind = c.kind AND o.k = c.k
), distances AS (
  SELECT r, kind, any_value(enough) AS own, bool_or(k = 9 AND p < q) AS more, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM compared GROUP BY r, kind
), judged AS (
  SELECT m.doc_id, m.n, m.word_chars, m.n_symbols, len(m.lines) - len(list_distinct(m.lines)) AS n_dup, coalesce(p.n_repeat, 0) AS n_repeat,
         m.n < 50 OR 100 * coalesce(p.n_repeat, 0) > 50 * m.n AS base_failed,
         c.d AS class_d, x.d AS word_d, x.own, CASE WHEN y.more THEN y.d ELSE 0 END AS symbol_d, 1 / sqrt(greatest(m.n, 1)::DOUBLE) AS s
  FROM measured m LEFT JOIN repeated p ON p.r = m.r JOIN distances c ON c.r = m.r AND c.kind = 'class'
  JOIN distances x ON x.r = m.r AND x.kind = 'word' JOIN distances y ON y.r = m.r AND y.kind = 'symbol'
)
SELECT doc_id, n::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup::BIGINT AS n_dup_lines,
       n_repeat::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (class_d > 0.13 + 2.0 * s OR symbol_d > 0.10 + 0.5 * s OR own AND word_d > 0.15 + 2.5 * s) AS kept
FROM judged
""".replace("COMMON", "['the', 'of', 'and', 'to', 'in', 'der', 'die', 'und', 'den', 'nicht', 'de', 'la', 'le', 'les', 'et', 'el', 'los', 'y', 'se', 'por']"),
}
