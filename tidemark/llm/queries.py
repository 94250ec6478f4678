"""The operators applied to whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    alignment,
    chat,
    collocations,
    mixing,
    ngram_join,
    packing,
    privacy,
    rules,
    shards,
    substrings,
    warc,
    weak_labels,
    winnowing,
)
from tidemark.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents"))


@query()
def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def _broken_sql(rules_) -> str:
    known = f" AND list_contains({rules.LANGUAGES}, lang)"
    return " OR ".join(f"COALESCE({m} {c} {t} AND n_words >= {w}{known * one}, FALSE)" for m, c, t, w, one in rules_)


RULES_SQL = f"""
WITH split AS (
    SELECT doc_id, lang, COALESCE(text, '') AS t,
           regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
           list_filter(string_split(COALESCE(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents),
runs AS (
    SELECT doc_id, i, list_aggregate(words[i:i + {rules.WINDOW - 1}], 'string_agg', ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {rules.WINDOW - 2})) AS i FROM split)),
twice AS (SELECT doc_id, run FROM runs GROUP BY ALL HAVING count(*) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n
    FROM (SELECT doc_id, i, unnest(range(0, {rules.WINDOW})) AS j FROM runs JOIN twice USING (doc_id, run))
    GROUP BY doc_id),
measured AS (
    SELECT s.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
           CAST(COALESCE(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
           len(list_filter(words, lambda w: list_contains({rules.STOP_WORDS}, lower(w)))) AS n_stops,
           len(lines) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(COALESCE(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
ratios AS (
    SELECT *, 100 * n_repeat_words / NULLIF(n_words, 0) AS repeat_percent,
           word_chars / NULLIF(n_words, 0) AS mean_word_chars,
           n_symbols / NULLIF(n_words, 0) AS symbol_ratio,
           n_capitals / NULLIF(word_chars, 0) AS capital_ratio,
           n_stops / NULLIF(n_words, 0) AS stop_word_ratio,
           n_dup_lines / NULLIF(n_lines, 0) AS dup_line_ratio
    FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_broken_sql(rules.BASE_RULES)} AS base_failed,
       NOT ({_broken_sql(rules.BASE_RULES + rules.RULES)}) AS kept
FROM ratios"""


@query(RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


CAPITALS_SQL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ITEM_WORDS = (
    f"regexp_extract_all(translate(COALESCE(text, ''), {CAPITALS_SQL}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
WINNOWING_SQL = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
wanted AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS run
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
          FROM (SELECT *, least(len(w), {winnowing.WINDOW}) AS k FROM b WHERE len(w) > 0))),
found AS (
    SELECT doc_id, i, k, item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS run
          FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
                FROM d, (SELECT DISTINCT k FROM wanted) WHERE len(w) >= k)) JOIN wanted USING (k, run)),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n
        FROM (SELECT doc_id, i, unnest(range(0, k)) AS j FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
         FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(item.n, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
       COALESCE(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN item ON d.doc_id = item.doc_id"""


@query(WINNOWING_SQL)
def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


WARC_SQL = f"""
WITH p AS (SELECT page_id, CAST(strlen(COALESCE(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(COALESCE(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {warc.REVISIT_BYTES}
                     THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f"""


@query(WARC_SQL)
def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.histories(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


NGRAM_SQL = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), {CAPITALS_SQL}), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT d.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id
JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) m ON d.doc_id = m.doc_id"""


@query(NGRAM_SQL)
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {substrings.WINDOW - 1}], ' ') AS run
      FROM (SELECT *, unnest(range(1, len(w) - {substrings.WINDOW - 2})) AS i FROM d)),
f AS (SELECT run, min(doc_id) AS first FROM g GROUP BY run),
gone AS (SELECT DISTINCT doc_id, i + j AS at
         FROM (SELECT doc_id, i, unnest(range(0, {substrings.WINDOW})) AS j
               FROM g JOIN f USING (run) WHERE doc_id > first)),
kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.at) AS t, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d) p
         ANTI JOIN gone ON p.doc_id = gone.doc_id AND p.at = gone.at GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed,
       sha256(COALESCE(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""


@query(SUBSTRING_SQL)
def op3_suffix_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


@query()
def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms are looked for in whole texts, however far from the entity."""
    return privacy.sanitise(table(spark, sf_dir, "documents"), context=None)


@query()
def op6_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_roles(table(spark, sf_dir, "conversations"))


@query()
def op7_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(table(spark, sf_dir, "documents"))


@query()
def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents")).documents


PHRASES = collocations.Spec()
PHRASES_SQL = f"""
WITH d AS (SELECT COALESCE(lang, 'und') AS lang, row_number() OVER () AS row,
                  regexp_split_to_array(translate(COALESCE(text, ''), {CAPITALS_SQL}), '[.,;:!?\x0A-\x0D]') AS pieces
           FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)
      GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= {PHRASES.threshold}),
cut AS (
    SELECT c.lang, c.phrase, c.k, c.f AS a, l.f AS l, r.f AS r, j,
           (CAST(c.f AS HUGEINT) * c.f * 1000000) // (CAST(l.f AS HUGEINT) * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
    JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:j], ' ')
    JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM c x WHERE x.lang = b.lang AND x.k = 3 AND b.k = 2
                          AND b.phrase IN (array_to_string(x.w[1:2], ' '), array_to_string(x.w[2:3], ' '))
                          AND 100 * x.f >= {PHRASES.covered_percent} * b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= {PHRASES.top}"""


@query(PHRASES_SQL)
def op12_phrase_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), PHRASES)


@query()
def op13_length_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))
