"""The subpackage's registered queries, on whole tables with production
parameters, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann_forest, bpe, chosen_path, divergence, html_extract, mixing, secret_scan, simhash, site_quality, suffix_dedup, toxicity, url_filter
from .tables import stored

#: The rank file of the public vocabulary; a parameter of the operators.
RANKS = "byte_bpe_50k.tiktoken"
#: The two vocabularies that are aligned.
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM u),
r(h, s, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (
  SELECT p.page_id, p.host, p.path, arg_max(h || s, length(h || s)) AS rule, arg_max(action, length(h || s)) AS action
  FROM (SELECT DISTINCT * FROM p) p JOIN r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, s)
  GROUP BY p.page_id, p.host, p.path)
SELECT p.page_id, p.host, p.path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict
FROM p LEFT JOIN best ON best.page_id IS NOT DISTINCT FROM p.page_id AND best.host = p.host AND best.path = p.path
"""


def op2_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs)).drop("text")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(secret_scan.written(F.col("spans"), *secret_scan.KINDS), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extract(read(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no url: their source stands for the host, their language
    for the section (path) of it."""
    return site_quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    encoded = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), ranks).select("doc_id", "ids")
    table = spark.sparkContext.broadcast(bpe.Tokens(ranks))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            flat, off = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            each = [(sha(t.decimal(x).encode()), sha(t.decode(x))) for x in (flat[a:b].tolist() for a, b in zip(off, off[1:]))]
            yield pa.record_batch([batch.column(0), pa.array(np.diff(off).astype(np.int64)), pa.array([x for x, _ in each], pa.string()),
                                   pa.array([x for _, x in each], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_and_next(read(spark, sf_dir, "documents"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, weight) of the labelled documents, for the mix's keys."""
    return read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 0, mixing.LOW_QUALITY).otherwise(1.0).alias("weight"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "keep")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels)
    scores = stored(toxicity.scored(docs, model).select("doc_id", "lang", "score"), "scores")
    cuts = toxicity.thresholds(scores, labels).withColumnRenamed("lang", "cut_lang")
    flagged = scores.join(F.broadcast(cuts), F.coalesce("lang", F.lit("")) == F.col("cut_lang"))   # one row per language
    return flagged.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                          (F.col("score") >= 0.3).cast("int").alias("predicted"), (F.col("score") >= F.col("threshold")).alias("flagged"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = alignment.read_files(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    return (alignment.align(read(spark, sf_dir, "documents").select("doc_id", "text"), *files, digest=True)
            .withColumnRenamed("groups", "groups_sha256"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies go, the first one, too."""
    found = suffix_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")), keep=None)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans = batch.columns
            rows = []
            for text, found in zip(texts, spans):
                cut = [(x["start"], x["end"]) for x in found.as_py()]
                body = text.as_buffer().to_pybytes()
                kept = suffix_dedup.kept_bytes(body, cut)
                rows.append((len(body), len(body) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([ids, *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.mapInArrow(digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT r, j, substr(h, 1000 * j + 1, 1398) AS p FROM (SELECT r, h, unnest(range(0, (length(h) // 2 + 300) // 500)) AS j FROM d)),
k AS (SELECT r, 500 * j + t AS s, md5(substr(p, 2 * t + 1, 400)) AS k
      FROM (SELECT r, j, p, unnest(range(0, greatest(least(500, length(p) // 2 - 199), 0))) AS t FROM parts)),
twice AS (SELECT k FROM k GROUP BY k HAVING count(*) > 1),
gone AS (SELECT r, s FROM k SEMI JOIN twice USING (k)),
runs AS (
  SELECT r, s, sum(CASE WHEN s <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY s) AS run
  FROM (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS before FROM gone)),
spans AS (SELECT r, run, min(s) AS a, max(s) + 200 AS b FROM runs GROUP BY r, run),
pieces AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT d.r, coalesce(max(spans.b), 0), any_value(length(h) // 2) FROM d LEFT JOIN spans USING (r) GROUP BY d.r),
kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, ((length(h) - length(kept)) // 2)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(kept)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM spans GROUP BY r) USING (r)
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
o AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
occ AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM o SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n FROM g LEFT JOIN occ USING (lang, source) GROUP BY g.lang, g.source),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(occ.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(occ.c, 0) + 1)) // (gn.n + l.v) AS p,
         1 + (1000000000::HUGEINT * (kept.c + 1)) // (l.n + l.v) AS q
  FROM gn JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN occ ON occ.lang = gn.lang AND occ.source = gn.source AND occ.term = kept.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
every AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 200
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_ann_forest, op3_secret_scan, op4_html_extract, op5_site_quality,
        op6_byte_bpe, op7_simhash, op8_source_mix, op9_ngram_jaccard, op10_toxicity, op11_token_alignment, op12_suffix_dedup, op13_source_divergence)
}
#: Of the others: a trained model, a hash-keyed sample, or an algorithm that SQL cannot say.
SQL: dict[str, str] = {"op1_url_filter": OP1_SQL, "op12_suffix_dedup": OP12_SQL, "op13_source_divergence": OP13_SQL}
