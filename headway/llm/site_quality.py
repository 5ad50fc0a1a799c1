"""Quality by hierarchical empirical Bayes.

A document classifier (logistic, over measures of the whole text) gives each
document's evidence.  Grouped sums of it give a posterior quality for every
host, shrunk towards the global prior, and for every path of a host, shrunk
towards the host's.  How strongly is estimated from the data: by how much
group means differ beyond what chance explains.  A document's score joins the
prior odds of its path (without its own part in them) and its evidence.
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
from .tables import stored

#: Labelled rows that the fit may use, of each label.
SAMPLE_ROWS = 3000
#: Parts that a group's rows are joined in, so that a hot host is no single task's.
SALTS = 64
KEEP = 0.5


def _segment(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def measures(texts: list[str | None]) -> np.ndarray:
    """Measures of each text (rows x measures); an empty text's are zero."""
    c = textops.codes(texts)
    n = np.diff(c.bounds).astype(float)
    w = textops.words(c)
    count = np.diff(w.first).astype(float)
    per_char, per_word = 1 / np.maximum(n, 1), 1 / np.maximum(count, 1)
    cp = c.cp
    upper = cp != w.lower
    word = textops.word_table()[cp]
    space = (cp == 32) | (cp == 10)
    stop = np.isin(cp, [ord(x) for x in ".,;:"])
    loud = np.isin(cp, [ord(x) for x in "!?"])
    digit = (cp >= 48) & (cp <= 57)
    other = ~(word | space | stop | loud)
    length = (w.end - w.start).astype(float)
    h = textops.word_hashes(w)
    doc = np.repeat(np.arange(len(n)), np.diff(w.first))
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((h, doc))
    new = np.append(True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])) if len(h) else np.zeros(0, bool)
    distinct = np.bincount(doc[order][new], minlength=len(n)).astype(float)
    return np.stack([
        _segment(upper, c.bounds) * per_char, _segment(space, c.bounds) * per_char, _segment(stop, c.bounds) * per_word,
        _segment(loud, c.bounds) * per_word, _segment(digit, c.bounds) * per_char, _segment(other, c.bounds) * per_word,
        _segment(length, w.first) * per_word / 10, _segment(again, w.first) * per_word,
        distinct * per_word, distinct / np.maximum(np.sqrt(count), 1) / 10, np.log1p(count) / 10, np.log1p(n) / 10,
        _segment(cp == 10, c.bounds) * per_word, (count == 0).astype(float),
    ], axis=1)


class Classifier(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float      # share of label 1 among all labelled rows


def _expand(x: np.ndarray) -> np.ndarray:
    """Measures, clipped, and their squares: a band of usual values is good."""
    x = np.clip(x, -6, 6)
    return np.concatenate([x, x * x - 1], axis=1)


def fit(measured: np.ndarray, labels: np.ndarray, prior: float) -> Classifier:
    """Logistic regression on the measures (rows x measures) of a sample."""
    x, y = np.asarray(measured, dtype=float), np.asarray(labels, dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = _expand((x - mean) / scale)
    z1 = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    b = np.zeros(z1.shape[1])
    ridge = np.full(len(b), 1.0)
    ridge[-1] = 1e-6
    for _ in range(30):     # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z1 @ b, -30, 30)))
        g = z1.T @ (p - y) + ridge * b
        hess = (z1 * (p * (1 - p) + 1e-9)[:, None]).T @ z1 + np.diag(ridge)
        step = np.linalg.solve(hess, g)
        b -= step * min(1.0, 3 / (np.abs(step).max() + 1e-9))
    own, share = np.clip([y.mean(), prior], 1e-4, 1 - 1e-4)
    shift = np.log(share / (1 - share)) - np.log(own / (1 - own))
    return Classifier(mean, scale, b[:-1], float(b[-1] + shift), float(share))


def predict(m: Classifier, texts: list[str | None]) -> np.ndarray:
    z = _expand((measures(texts) - m.mean) / m.scale) @ m.weights + m.bias
    return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        batch = pa.record_batch([texts], names=["t"])
        got = [measures(s.column(0).to_pylist()) for s in textops.slices(batch, "t")]
        yield pa.array([r for m in got for r in m.tolist()], pa.list_(pa.float64()))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", sample: int = SAMPLE_ROWS) -> Classifier | None:
    """Fits on at most ``sample`` labelled rows of each label, the first by a
    hash of doc_id (several labels of an id count as their smallest, several
    texts as the one of the smallest measures); only their measures come to
    the driver.  The prior comes from all labelled rows.  None where
    only one label, or none, is there."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    prior = known.agg(F.avg("label")).first()[0]
    by_hash = F.xxhash64(F.lit(23), F.col("doc_id"))
    ids = [known.where(F.col("label") == v).orderBy(by_hash, "doc_id").limit(sample) for v in (0, 1)]
    rows = (docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")   # 2 x sample rows
            .select("doc_id", "label", _measures("text").alias("x")).groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")).collect())
    rows = sorted(rows, key=lambda r: r["doc_id"])
    if len({r["label"] for r in rows}) < 2:
        return None
    return fit(np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]), float(prior))


def evidence(docs: DataFrame, model: Classifier, text: str = "text", out: str = "evidence") -> DataFrame:
    """Adds ``out``: the classifier's probability of quality 1 for the whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)   # fixed size

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            batch = pa.record_batch([texts], names=["t"])
            got = [predict(held.value, s.column(0).to_pylist()) for s in textops.slices(batch, "t")]
            yield pa.array(np.concatenate(got) if got else np.zeros(0))

    return docs.withColumn(out, score(F.col(f"`{text}`")))


def strength(groups: DataFrame, mean: str, n: str, inside: str, towards: Column) -> float:
    """Pseudo-count of the prior, by moments: the variance of group means
    about what they shrink towards, less its expected sampling part (the mean
    variance within groups over their size), against the prior's variance."""
    g = groups.where(F.col(n) > 1).select(F.col(n).alias("n"), (F.col(inside) / F.col(n)).alias("noise"),
                                          ((F.col(mean) - towards) ** 2).alias("spread"), (towards * (1 - towards)).alias("base"))
    r = g.agg(F.count("*").alias("k"), F.avg("spread").alias("spread"), F.avg("noise").alias("noise"), F.avg("base").alias("base")).first()
    if not r["k"] or r["base"] is None or r["base"] <= 0:
        return 10.0
    between = max(r["spread"] - r["noise"], 1e-6)
    return float(min(max(r["base"] / between - 1, 1.0), 1e6))


def posteriors(scored: DataFrame, prior: float, host: str = "host", path: str = "path", p: str = "evidence", salt: Column | None = None) -> DataFrame:
    """Adds host_posterior, path_posterior (both without the row's own part)
    and score to rows with evidence.

    Sums of the evidence are made by (host, path) and from these by host, so a
    hot host is summed where its rows lie; the sums come back in SALTS parts
    by a join.  Null hosts and paths are groups of their own (as ''); a host or
    path with this row alone has the prior above it.
    """
    rows = scored.withColumn("__h", F.coalesce(F.col(host).cast("string"), F.lit(""))).withColumn("__p", F.coalesce(F.col(path).cast("string"), F.lit("")))
    paths = rows.groupBy("__h", "__p").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(F.col(p) ** 2).alias("s2"))
    paths = stored(paths, "paths")
    hosts = paths.groupBy("__h").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("s2").alias("hs2"))
    var = lambda n, s, s2: F.greatest(F.col(s2) / F.col(n) - (F.col(s) / F.col(n)) ** 2, F.lit(0.0))
    k_host = strength(hosts.withColumn("m", F.col("hs") / F.col("hn")).withColumn("v", var("hn", "hs", "hs2")), "m", "hn", "v", F.lit(prior))
    both = paths.join(hosts, "__h").withColumn("hp", (F.col("hs") + k_host * prior) / (F.col("hn") + k_host))
    k_path = strength(both.withColumn("m", F.col("s") / F.col("n")).withColumn("v", var("n", "s", "s2")), "m", "n", "v", F.col("hp"))
    salted = both.select("__h", "__p", "n", "s", "hn", "hs").withColumn("__salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
    rows = rows.withColumn("__salt", F.pmod(salt if salt is not None else F.xxhash64(p), F.lit(SALTS)).cast("int"))
    e = F.col(p)
    odds = lambda x: F.log(x / (1 - x))
    host_post = (F.col("hs") - e + k_host * prior) / (F.col("hn") - 1 + k_host)
    path_post = (F.col("s") - e + k_path * F.col("host_posterior")) / (F.col("n") - 1 + k_path)
    clip = lambda x: F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    z = odds(clip(F.col("path_posterior"))) + odds(clip(e)) - odds(clip(F.lit(prior)))
    return (rows.join(salted, ["__h", "__p", "__salt"]).withColumn("host_posterior", host_post).withColumn("path_posterior", path_post)
            .withColumn("score", 1 / (1 + F.exp(-z))).drop("__h", "__p", "__salt", "n", "s", "hn", "hs"))


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", text: str = "text", keep: float = KEEP) -> DataFrame:
    """(doc_id, host, path, evidence, host_posterior, path_posterior, score,
    keep) of every row of ``docs``.

    Null, empty and wordless texts are judged by their (zero) measures.
    Repeated rows each count as evidence and get equal scores.  Without labels
    of both kinds nothing can be learned: the evidence is null and every row
    is kept.  Other columns are ignored; no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{host}`").cast("string").alias("host"),
                       F.col(f"`{path}`").cast("string").alias("path"), F.col(f"`{text}`").alias("text"))
    model = train(rows, labels)
    if model is None:
        return rows.select("doc_id", "host", "path", *[F.lit(None).cast("double").alias(c) for c in ("evidence", "host_posterior", "path_posterior", "score")],
                           F.lit(True).alias("keep"))
    found = stored(evidence(rows, model).drop("text"), "evidence")
    return (posteriors(found, model.prior, salt=F.xxhash64("doc_id", "evidence"))
            .select("doc_id", "host", "path", "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= keep).alias("keep")))
