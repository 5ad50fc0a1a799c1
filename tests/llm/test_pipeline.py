"""The pipeline's stages against plain versions of their decisions."""

import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from headway.llm import bpe, mixing, queries, secret_scan, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "secret_scan", "source_mix", "byte_bpe"]


def test_stages(spark, docs, labels):
    from .test_operators import plain_join

    names = docs.columns
    safe = corpus_pipeline.drop_toxic(spark, docs, SF).checkpoint()
    assert safe.columns == names and safe.exceptAll(docs).count() == 0
    clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()} & {r["doc_id"] for r in docs.collect()}
    assert len(clean - {r["doc_id"] for r in safe.collect()}) <= 0.03 * len(clean)

    single = corpus_pipeline.drop_near_copies(spark, safe, SF).checkpoint()
    texts = safe.orderBy("doc_id").collect()
    _, root = plain_join([r["text"] for r in texts])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({texts[i]["doc_id"] for i in root}) and single.columns == names

    blank = corpus_pipeline.blank_secrets(spark, single, SF).checkpoint()
    assert blank.columns == names and blank.count() == single.count()
    assert all(not secret_scan.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in blank.collect())

    mixed = corpus_pipeline.mix_sources(spark, blank, SF).checkpoint()
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(blank, queries.quality_weights(spark, SF)).collect()}
    assert mixed.columns == names and {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {k: v for k, v in taken.items() if v}

    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = corpus_pipeline.encode(spark, mixed, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(coded) == mixed.count() and all(r["round_trip"] and list(r["ids"]) == enc.encode_ordinary(texts[r["doc_id"]]) for r in coded)


def test_odd_and_empty_rows_pass(spark, odd):
    for df in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF).checkpoint()
        assert df.where("NOT round_trip").count() == 0


def test_digests(spark):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in queries.op6_byte_bpe(spark, SF).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(texts[r["doc_id"]].encode()))
    for r in queries.op3_secret_scan(spark, SF).collect():
        base = secret_scan.base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == sha(",".join(f"{s.kind}:{s.start}:{s.end}" for s in base).encode())
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s.kind == k for s in base) for k in secret_scan.KINDS)
    held = queries.op10_toxicity(spark, SF)
    assert held.where(F.col("held_out") != toxicity.held_out(F.col("doc_id"))).count() == 0 and held.where("predicted != int(score >= 0.3)").count() == 0
