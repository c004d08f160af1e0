"""The registered queries of this subpackage, with their SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import (
    centroids,
    decontamination,
    fingerprints,
    html_extraction,
    language_id,
    line_templates,
    mixing,
    ngram_join,
    pseudonyms,
    simhash_trie,
    spelling,
    url_filter,
    warc,
)
from tenura.llm.storage import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extract(table(spark, sf_dir, "pages"), keep=("page_id", "url"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op2_ngram_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


PSEUDONYM_KEY = b"an example key; give your own"


@query("op3_pseudonyms")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY).select(
        "doc_id", "text", F.size("spans").cast("bigint").alias("n_found"),
        F.array_join(F.sort_array(F.array_distinct("spans.kind")), ",").alias("kinds"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out(F.col("doc_id"))
    dictionaries = language_id.learn(docs.where(~out))
    found = language_id.identify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                        "margin", "rejected")


@query("op5_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw(table(spark, sf_dir, "documents"), carry=("doc_id",))
    taken = F.aggregate("draws", F.lit(0).cast("bigint"), lambda total, d: total + d["n_words"])
    return drawn.select("row.doc_id", "size", "source_size", "target", taken.alias("taken"))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

OP6_SQL = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fitting AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM urls JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fitting f USING (page_id)
"""


@query("op6_url_filter", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).drop("url")


@query("op7_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edited(table(spark, sf_dir, "documents"))


@query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.read(spark, path, with_payload=False)
    return found.select(F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


@query("op9_line_templates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs, long_tokens=50)


OP10_SQL = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s
        FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), places AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s
        FROM doc_words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT p.doc_id, p.s, p.size, v.item FROM places p JOIN windows v ON p.win = v.win AND p.size = v.size
), hit_words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(generate_series(s, s + size - 1)) AS pos FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""


@query("op10_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op11_simhash")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_trie.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op12_spelling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"), slip_every=97)


def op13_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Rounds of assigning and moving, one after another as common table expressions."""
    text = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), embedding) AS no, vec_id,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS (SELECT no - 1 AS cluster, v AS c FROM kept WHERE no <= {k})"""
    assigned = """, a{0} AS (
  SELECT no, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'cluster': cluster}}) AS best
  FROM (SELECT no, vec_id, v, cluster, list_sum([(v[i] - c[i]) * (v[i] - c[i]) for i in range(1, {1})]) AS d
        FROM kept, c{0}) GROUP BY no
)"""
    moved = """, s{0} AS (
  SELECT best.cluster AS cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{0}, range(1, {2}) AS r(i) GROUP BY ALL
), m{0} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{0} GROUP BY cluster
), c{1} AS (SELECT old.cluster, coalesce(m.c, old.c) AS c FROM c{0} AS old LEFT JOIN m{0} AS m USING (cluster))"""
    for r in range(rounds):
        text += assigned.format(r, dims + 1) + moved.format(r, r + 1, dims + 1)
    return text + assigned.format(rounds, dims + 1) + f"""
SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON cluster = best.cluster
"""


@query("op13_centroids", op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))[0]


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
