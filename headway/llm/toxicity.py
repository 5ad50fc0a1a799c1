"""Toxicity: a convolutional text classifier in numpy.

Words are embedded as sums of hashed features (the whole word and its first
four, five and six letters), filters of one to three words run over the whole
text, each filter's largest response is kept, and a logistic layer gives the
score.  The classifier is fitted on a bounded sample of labelled rows; class
shares and the thresholds by language come from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops
from .textops import U64

PREFIXES = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 8          # of each width
DIM = 8
ROWS = 1 << 16       # of the hashed embedding; row 0 is "no feature"
#: Labelled rows that the fit may use: of label 1 and of label 0.
SAMPLE_ROWS = (2500, 4000)
SCORE_BINS = 1000


class Model(NamedTuple):
    embedding: np.ndarray     # ROWS x DIM
    filters: list             # per width: width x DIM x FILTERS
    bias: np.ndarray          # of the filters
    out: np.ndarray           # of the logistic layer
    out_bias: float


def features(w: textops.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the distinct words (n x 4 embedding rows) and every
    word's number among them."""
    number, rep = textops.numbered(textops.word_hashes(w))
    n = len(rep)
    start, end = w.start[rep], w.end[rep]
    cols = []
    for k in (0, *PREFIXES):
        stop = end if not k else np.minimum(start + k, end)
        h = textops.mix(textops.span_hashes(w.lower, start, stop) + U64(k))
        row = (h % U64(ROWS - 1)).astype(np.int64) + 1
        cols.append(np.where(end - start > k if k else True, row, 0))
    return np.stack(cols, axis=1) if n else np.zeros((0, 1 + len(PREFIXES)), dtype=np.int64), number


def _pool(model: Model, feats: np.ndarray, number: np.ndarray, first: np.ndarray, where: bool = False):
    """Largest response of every filter in every text (n x filters), before
    the bias; with ``where`` also the word positions it was found at.  Words
    beyond a text's end and all of a wordless text respond with zero."""
    e = model.embedding[feats].sum(axis=1)          # distinct words x DIM
    n, doc = len(first) - 1, np.repeat(np.arange(len(first) - 1), np.diff(first))
    full = np.flatnonzero(np.diff(first) > 0)
    tops, ats = [], []
    for f in model.filters:
        z = (e @ f[0])[number]
        for o in range(1, len(f)):
            ok = np.zeros(len(number), dtype=bool)
            ok[:-o or None] = doc[o:] == doc[:-o] if o < len(doc) else False
            r = (e @ f[o])[number[np.minimum(np.arange(len(number)) + o, max(len(number) - 1, 0))]]
            z = z + r * ok[:, None]
        top = np.zeros((n, FILTERS), dtype=np.float32)
        at = np.zeros((n, FILTERS), dtype=np.int64)
        if len(full):
            top[full] = np.maximum.reduceat(z, first[full], axis=0)
            if where:
                hit = z == top[doc]
                for k in range(FILTERS):
                    p = np.flatnonzero(hit[:, k])[::-1]
                    at[doc[p], k] = p
        tops.append(top)
        ats.append(at)
    return (np.concatenate(tops, axis=1), np.concatenate(ats, axis=1)) if where else np.concatenate(tops, axis=1)


def predict(model: Model, texts: list[str | None]) -> np.ndarray:
    """Scores between 0 and 1; null, empty and wordless texts get the score of
    a text in which no filter responds."""
    w = textops.words(textops.codes(texts))
    feats, number = features(w)
    hidden = np.maximum(_pool(model, feats, number, w.first) + model.bias, 0)
    return 1 / (1 + np.exp(-(hidden @ model.out + model.out_bias).astype(np.float64)))


def packed(text: str) -> tuple[bytes, bytes]:
    """What a fit reads of a text: the feature rows of its distinct words
    (16 bits each) and every word's number among these (16 or 32 bits)."""
    f, k = features(textops.words(textops.codes([text])))
    return f.astype(np.uint16).tobytes(), k.astype(np.uint16 if len(f) <= 1 << 16 else np.uint32).tobytes()


def unpacked(feats: bytes, number: bytes) -> tuple[np.ndarray, np.ndarray]:
    f = np.frombuffer(feats, dtype=np.uint16).reshape(-1, 1 + len(PREFIXES))
    return f, np.frombuffer(number, dtype=np.uint16 if len(f) <= 1 << 16 else np.uint32)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float, epochs: int = 6, batch: int = 64, seed: int = 7) -> Model:
    """Trains on the sample's unpacked texts; ``share`` is the share of label 1
    among all labelled rows, to which the scores are set back."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, dtype=np.float32)
    n = len(docs)
    filters = [rng.normal(0, 0.1, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    emb = rng.normal(0, 0.05, (ROWS, DIM)).astype(np.float32)
    # warm start: the first dimension holds each feature's log odds over the sample's texts, shrunk where it is rare
    seen = np.zeros((2, ROWS))
    for (f, _), lab in zip(docs, y):
        seen[int(lab), np.unique(f)] += 1
    tot = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())])
    odds = np.log((seen[1] + 0.5) / (tot[1] + 1)) - np.log((seen[0] + 0.5) / (tot[0] + 1))
    emb[:, 0] = odds * np.minimum(1, seen.sum(axis=0) / 10) / 4
    emb[seen.sum(axis=0) < 2] = 0
    emb[0] = 0
    for f in filters:
        f[0, 0, :2] = 1
    bias = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
    out = rng.normal(0, 0.1, len(bias)).astype(np.float32)
    for k in range(len(WIDTHS)):
        out[k * FILTERS:k * FILTERS + 2] = 1
        bias[k * FILTERS:k * FILTERS + 2] = -1
    params = {"bias": bias, "out": out, "ob": np.zeros(1, dtype=np.float32), **{f"f{i}": f for i, f in enumerate(filters)}}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    squares = np.zeros((ROWS, 1), dtype=np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, batch):
            pick = order[i:i + batch]
            step += 1
            first = np.zeros(len(pick) + 1, dtype=np.int64)
            np.cumsum([len(docs[j][1]) for j in pick], out=first[1:])
            base = np.cumsum([0] + [len(docs[j][0]) for j in pick])
            feats = np.concatenate([docs[j][0] for j in pick]).astype(np.int32)
            number = np.concatenate([docs[j][1].astype(np.int64) + b for j, b in zip(pick, base)])
            m = Model(emb, [params[f"f{k}"] for k in range(len(WIDTHS))], params["bias"], params["out"], float(params["ob"][0]))
            top, at = _pool(m, feats, number, first, where=True)
            z = top + m.bias
            hidden = np.maximum(z, 0)
            p = 1 / (1 + np.exp(-(hidden @ m.out + m.out_bias)))
            d = (p - y[pick]) / len(pick)
            back = (d[:, None] * m.out) * (z > 0) * (np.diff(first) > 0)[:, None]
            grads = {"out": hidden.T @ d + 1e-4 * m.out, "ob": np.array([d.sum()], dtype=np.float32), "bias": back.sum(axis=0)}
            for k, f in enumerate(m.filters):
                g = np.zeros_like(f)
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                r, c = np.nonzero(back[:, own])
                pos, val = at[:, own][r, c], back[:, own][r, c]
                for o in range(len(f)):
                    ok = pos + o < first[r + 1]
                    rows = feats[number[pos[ok] + o]]
                    e = emb[rows].sum(axis=1)
                    np.add.at(g[o].T, c[ok], e * val[ok][:, None])
                    de = val[ok][:, None] * f[o].T[c[ok]]
                    for col in range(rows.shape[1]):
                        np.add.at(squares, rows[:, col], (de ** 2).mean(axis=1, keepdims=True))
                    for col in range(rows.shape[1]):
                        np.add.at(emb, rows[:, col], -0.02 * de / (np.sqrt(squares[rows[:, col]]) + 1e-4))
                grads[f"f{k}"] = g
            emb[0] = 0
            for k, g in grads.items():
                a, b = moments[k]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                params[k] -= 0.01 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    own = min(max(y.mean() if n else 0.5, 1e-4), 1 - 1e-4)
    share = min(max(share, 1e-4), 1 - 1e-4)
    shift = np.log(share / (1 - share)) - np.log(own / (1 - own))
    return Model(emb, [params[f"f{k}"] for k in range(len(WIDTHS))], params["bias"], params["out"], float(params["ob"][0] + shift))


# ---- on Spark -------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows that no fit and no threshold learns from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the labelled rows that may be learned from; several
    labels of one id count as their largest."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))


@F.arrow_udf(T.StructType([T.StructField("feats", T.BinaryType()), T.StructField("number", T.BinaryType())]))
def _packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        got = [packed(t.as_py()) for t in texts]
        yield pa.StructArray.from_arrays([pa.array([x[i] for x in got], pa.binary()) for i in (0, 1)], names=["feats", "number"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: tuple[int, int] = SAMPLE_ROWS) -> Model:
    """Fits on at most sample[0] rows of label 1 and sample[1] of label 0, the
    first by a hash of doc_id (of several texts of an id, the smallest).  The
    sampled texts are packed on the executors; only feature numbers come to
    the driver.  No labelled rows: a model that gives every text the same
    score of nearly zero."""
    known = learnable(labels, label)
    share = known.agg(F.avg("label")).first()[0] or 0.0
    by_hash = F.xxhash64(F.lit(11), F.col("doc_id"))
    ids = [known.where(F.col("label") == v).orderBy(by_hash, "doc_id").limit(n) for v, n in ((1, sample[0]), (0, sample[1]))]
    picked = ids[0].unionByName(ids[1])
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # sum(sample) rows
            .groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("label").alias("label"))
            .select("doc_id", "label", _packed("text").alias("x")).select("doc_id", "label", "x.*").collect())
    rows.sort(key=lambda r: r["doc_id"])
    return fit([unpacked(r["feats"], r["number"]) for r in rows], np.array([r["label"] for r in rows]), float(share))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds ``out``: the score of the whole text, which depends on nothing else.

    Null, empty and wordless texts get the score of a text in which no filter
    responds.  Repeated rows are scored alike; an input column called ``out``
    is replaced; no rows give no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)   # fixed size

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = held.value
        for texts in batches:
            batch = pa.record_batch([texts], names=["t"])
            got = [predict(m, s.column(0).to_pylist()) for s in textops.slices(batch, "t")]
            yield pa.array(np.concatenate(got) if got else np.zeros(0))

    return docs.withColumn(out, score(F.col(f"`{text}`")))


def thresholds(scores: DataFrame, labels: DataFrame, label: str = "toxic", least: int = 20) -> DataFrame:
    """(lang, threshold) from all labelled rows that may be learned from: the
    score, in steps of 1 / SCORE_BINS, of the best F1 in that language; where
    it has under ``least`` rows of label 1, of the best F1 over all languages.
    Only counts by (lang, bin, label) are shuffled.  Without any row of label
    1 the threshold is above every score."""
    known = learnable(labels, label)
    bins = (scores.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.floor(F.col("score") * SCORE_BINS).alias("bin"))
            .join(known, "doc_id").groupBy("lang", "bin").agg(F.sum("label").alias("pos"), F.count("*").alias("n")))

    def best(df: DataFrame, keys: list[str]) -> DataFrame:
        from pyspark.sql import Window
        down = Window.partitionBy(*keys).orderBy(F.col("bin").desc())    # at most SCORE_BINS + 1 rows of a language
        f1 = df.withColumn("tp", F.sum("pos").over(down)).withColumn("taken", F.sum("n").over(down))
        all_pos = Window.partitionBy(*keys)
        f1 = f1.withColumn("all_pos", F.sum("pos").over(all_pos)).withColumn("f1", 2 * F.col("tp") / (F.col("taken") + F.col("all_pos")))
        # of equal scores the middle of the gap: the lowest bin of the best F1 and the next occupied one below it
        below = F.coalesce(F.lead("bin").over(down), F.lit(0))
        f1 = f1.withColumn("cut", (F.col("bin") + below + 1) / 2 / SCORE_BINS)
        return f1.groupBy(*keys).agg(F.max("all_pos").alias("positives"), F.max_by("cut", F.struct("f1", "bin")).alias("threshold"))

    whole = best(bins.groupBy(F.lit(0).alias("one"), "bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")), ["one"])
    langs = scores.select(F.coalesce("lang", F.lit("")).alias("lang")).distinct()
    own = langs.join(best(bins, ["lang"]), "lang", "left")
    usual = whole.select("one", F.col("positives").alias("all_positives"), F.col("threshold").alias("usual"))
    return (own.withColumn("one", F.lit(0)).join(F.broadcast(usual), "one", "left")   # one row
            .select("lang", F.when(F.col("positives") >= least, F.col("threshold"))
                    .when(F.col("all_positives") > 0, F.col("usual")).otherwise(F.lit(1.1)).alias("threshold")))
