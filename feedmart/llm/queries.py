"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.llm import (
    cotraining,
    decontaminate,
    exact_dedup,
    filter_audit,
    html_main,
    license_scan,
    lm,
    mixing,
    quality_rules,
    simhash,
    toxicity,
    vector_codes,
    warc,
)
from feedmart.llm.common import crc_bucket, ship
from feedmart.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = lambda spark, sf_dir: run(ship(pin(spark)), sf_dir)
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), p AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS k FROM w WHERE len(words) > 2
), t AS (
  SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, words[k], words[k + 1], words[k + 2]) AS n FROM p
), r AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS j FROM t WHERE n > 1) GROUP BY doc_id
), l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), f AS (
  SELECT doc_id, max(n) AS most
  FROM (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM w) GROUP BY ALL)
  GROUP BY doc_id
), c AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(most, 0) AS most,
    length(regexp_replace(text, '[^!]', '', 'g')) AS bangs,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_n,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN f USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 20 * n_words
    OR 100 * bangs > 50 * n_words OR 100 * upper_n > 60 * letters OR word_chars > 15 * n_words
    OR 10 * word_chars < 25 * n_words OR 100 * n_dup_lines > 50 * n_lines OR 100 * most > 40 * n_words) AS kept
FROM c
"""


@query(RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.counts(table(spark, sf_dir, "documents"))
    return found.drop("failed_rule")  # which rule came first depends on the measured order


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), k AS (
  SELECT doc_id, source, size, -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496.0::DOUBLE)
    / greatest(0.1::DOUBLE, CASE WHEN length(text) > 0
        THEN length(regexp_replace(text, '[#*$%&|<>!]', '', 'g'))::DOUBLE / length(text) ELSE 0.0::DOUBLE END
      * least(1.0::DOUBLE, size / 50.0::DOUBLE)) AS key
  FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, source_size * 3.0::DOUBLE / weight AS ratio,
    ((sum(source_size) OVER () - 3 * (sum(source_size) OVER w - source_size))::DOUBLE
      / (sum(weight) OVER () - sum(weight) OVER w + weight)) AS level
  FROM s WINDOW w AS (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT source, source_size,
    least(3.0::DOUBLE * source_size, weight * (SELECT level FROM f WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1)) AS target FROM f
), r AS (
  SELECT d.*, source_size, target, floor(target / nullif(source_size, 0)) AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM k AS d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * (coalesce(epochs, 0)
  + CASE WHEN start + size / 2.0::DOUBLE <= target - coalesce(epochs, 0) * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


@query(MIX_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.scored(docs, toxicity.learn(docs, toxicity.learning_fold(labels)))


@query()
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark passage, with the item; documents without one have no row."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least=0).drop("url", "body")


@query()
def op9_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


@query()
def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.scored(table(spark, sf_dir, "documents"), lm.learning_fold())
    return found.withColumn("held_out", F.coalesce(crc_bucket(F.col("doc_id"), 10) == 0, F.lit(True)))


@query()
def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query(EXACT_SQL)
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


AUDIT_SQL = r"""
WITH l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id
), w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), f AS (
  SELECT w.doc_id, part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'),
     coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), m AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad
  FROM f GROUP BY part, fails
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order
  FROM letter AS a, letter AS b, letter AS d, letter AS e, letter AS g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5
), first AS (
  SELECT part, fails, n, n_good, n_bad, filter_order, list_min([CASE
      WHEN fails[ascii(substr(filter_order, CAST(k AS INT), 1)) - 64] THEN k ELSE 6 END FOR k IN range(1, 6)]) AS hit
  FROM m, orders
), step AS (
  SELECT *, ascii(substr(filter_order, CAST(step AS INT), 1)) - 64 AS own FROM first, (SELECT unnest(range(1, 6)) AS step)
), s AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, own,
    sum(CASE WHEN hit > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails[own] AND hit < step THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[own] AND len([x FOR x IN fails IF x]) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit = step THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit = step THEN n_bad ELSE 0 END) AS toxic_lost
  FROM step GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM s
"""


@query(AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd's rounds, unrolled. Doubles hold the whole numbers exactly."""
    assign = """
a{k} AS MATERIALIZED (
  SELECT vec_id, j, any_value(x) AS x, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (
    SELECT vec_id, j, x, e, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d
    FROM p JOIN b{k} USING (j)) GROUP BY vec_id, j)"""
    update = """
b{n} AS MATERIALIZED (
  SELECT b{k}.j, b{k}.e, coalesce(m.c, b{k}.c) AS c FROM b{k} LEFT JOIN (
    SELECT j, e, list(s ORDER BY i) AS c FROM (
      SELECT j, e, i, floor(sum(x[i]) / count(*)) AS s
      FROM (SELECT j, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY j, e, i) GROUP BY j, e
  ) AS m ON m.j = b{k}.j AND m.e = b{k}.e)"""
    steps = [(assign + "," + update).format(k=k, n=k + 1) for k in range(rounds)] + [assign.format(k=rounds)]
    return f"""
WITH k AS (
  SELECT vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS MATERIALIZED (
  SELECT vec_id, j, v[CAST(j * len(v) // 4 + 1 AS INT) : CAST((j + 1) * len(v) // 4 AS INT)] AS x
  FROM k, (SELECT unnest(range(4)) AS j)
), b0 AS MATERIALIZED (
  SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e, x AS c
  FROM p QUALIFY row_number() OVER (PARTITION BY j ORDER BY vec_id) <= 256
), {",".join(steps)}, books AS (
  SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY j, e, i)) AS digest
  FROM (SELECT j, e, unnest(c) AS y, unnest(range(len(c))) AS i FROM b{rounds})
), r AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY j) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM r JOIN k USING (vec_id), books
"""


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))
