"""A corpus pipeline of five stages over ``documents``: toxic documents go,
one document of each group of near copies stays, secrets are blanked, sources
are mixed to target weights, and the mix is encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is
written as Parquet and read again as the next one's docs.  All but the last
return the columns that they were given.  Empty tables pass every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, chosen_path, mixing, queries, secret_scan, toxicity
from headway.llm.tables import stored
from headway.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose score is below their language's threshold."""
    configure(spark)
    labels = queries.read(spark, sf_dir, "labels")
    scored = stored(toxicity.scored(docs, toxicity.train(docs, labels), out="__score"), "scored")
    cuts = toxicity.thresholds(scored.select("doc_id", "lang", F.col("__score").alias("score")), labels)
    cuts = stored(cuts.select(F.col("lang").alias("__lang"), F.col("threshold").alias("__cut")), "thresholds")
    judged = scored.join(cuts, F.coalesce("lang", F.lit("")) == F.col("__lang"), "left")
    return judged.where(F.coalesce(F.col("__score") < F.col("__cut"), F.lit(True))).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest doc_id of each group of near copies."""
    configure(spark)
    return chosen_path.keep_one(docs, chosen_path.join(docs))


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret found; all documents stay."""
    configure(spark)
    found = secret_scan.scan(docs, secret_scan.train(docs), out="__spans")
    return secret_scan.redact(found, spans="__spans").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    configure(spark)
    return mixing.repeat(docs, mixing.mix(docs, queries.quality_weights(spark, sf_dir)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; that they decode to its text is checked."""
    configure(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    decoded = bpe.decode(bpe.encode(docs.select("doc_id", "source", "text"), ranks), ranks)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), exact.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scan", blank_secrets),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]
#: Trained models and hash-keyed samples can't be said in SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
