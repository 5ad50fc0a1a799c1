"""Secret scans: patterns, and a character convolutional network over every
candidate and its surroundings.

Candidates are all runs of 16 and more token characters with a digit among
them.  The network (character embeddings, filters of three and five
characters, max pooling, a logistic layer, in numpy) sees 24 characters
before a candidate, the whole candidate (padded to 48) and 16 after it.  It learns from
findings: candidates that a pattern confirms against those that none does.
Its scores are calibrated and its threshold set over the findings of all
texts, so that a stated share of the confirmed ones lies above it.  Pattern
findings stay whatever the network says; it adds candidates above the
threshold that no pattern finds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


KINDS = ("assign", "access", "hex")
ADDED = "learned"
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
BEFORE, INSIDE, AFTER = 24, 48, 16
WIDE = BEFORE + INSIDE + AFTER
CHARS, DIM, WIDTHS, FILTERS = 130, 8, (3, 5), 16
#: Candidates that the fit may use: confirmed ones and others.
SAMPLE_ROWS = (2000, 4000)
RECALL = 0.99
SCORE_BINS = 1000


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def base_spans(text: str) -> list[Span]:
    """The patterns' findings, leftmost and non-overlapping for each kind,
    by start and then kind in the order of KINDS."""
    out = [Span(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [Span(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [Span(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


#: Runs are maximal, so "24 and more" is the same as dropping shorter runs.
HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")


def candidates(text: str) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in CANDIDATE.finditer(text) if DIGIT.search(m[0])]


DIGIT = re.compile(r"[0-9]")


def window(text: str, start: int, end: int) -> bytes:
    """The characters that the network sees, WIDE or, of a candidate longer
    than INSIDE, more: one byte each, 128 for what is not ASCII, 129 for
    padding."""
    a = text[max(0, start - BEFORE):start]
    b = text[start:end]
    c = text[end:end + AFTER]
    code = lambda s: bytes(min(ord(x), 128) for x in s)
    pad = b"\x81"
    return code(a).rjust(BEFORE, pad) + code(b).ljust(INSIDE, pad) + code(c).ljust(AFTER, pad)


class Model(NamedTuple):
    embedding: np.ndarray   # CHARS x DIM
    filters: list           # per width: width * DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float            # calibration of the logits
    shift: float


def pieces(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows cut into pieces of WIDE characters (p x WIDE) that overlap
    so far that every place of every filter lies in one, and each window's
    first piece.  Pooled over its pieces, a window is seen whole."""
    step = WIDE - max(WIDTHS) + 1
    starts = [[*range(0, len(w) - WIDE, step), len(w) - WIDE] for w in windows]
    first = np.zeros(len(windows), dtype=np.int64)
    np.cumsum([len(s) for s in starts[:-1]], out=first[1:])
    x = np.frombuffer(b"".join(w[a:a + WIDE] for w, s in zip(windows, starts) for a in s), dtype=np.uint8)
    return x.reshape(-1, WIDE), first


def _forward(m: Model, x: np.ndarray, first: np.ndarray, where: bool = False):
    """Pooled responses and logits of the windows that begin at ``first``
    among the pieces; with ``where`` also, by width, the characters (n x
    FILTERS x width) that each filter responded to most."""
    tops, ats = [[] for _ in WIDTHS], [[] for _ in WIDTHS]
    for i in range(0, len(x), 2048):                      # pieces at a time
        e = m.embedding[x[i:i + 2048]]                    # pieces x WIDE x DIM
        for k, (f, w) in enumerate(zip(m.filters, WIDTHS)):
            r = np.concatenate([e[:, o:WIDE - w + 1 + o] for o in range(w)], axis=2) @ f      # pieces x places x FILTERS
            at = r.argmax(axis=1)
            tops[k].append(np.take_along_axis(r, at[:, None], axis=1)[:, 0])
            ats[k].append(at)
    tops = [np.concatenate(t) for t in tops]
    best = [np.maximum.reduceat(t, first, axis=0) for t in tops]
    hidden = np.maximum(np.concatenate(best, axis=1) + m.bias, 0)
    logit = hidden @ m.out + m.out_bias
    if not where:
        return hidden, logit
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    chars = []
    for w, t, b, at in zip(WIDTHS, tops, best, ats):
        piece = np.zeros((len(first), FILTERS), dtype=np.int64)
        r, c = np.nonzero(t == b[owner])
        piece[owner[r[::-1]], c[::-1]] = r[::-1]          # the first piece of the largest response
        place = np.take_along_axis(np.concatenate(at), piece, axis=0)
        chars.append(x[piece[:, :, None], place[:, :, None] + np.arange(w)])
    return hidden, logit, chars


def predict(m: Model, windows: list[bytes]) -> np.ndarray:
    z = _forward(m, *pieces(windows))[1].astype(np.float64) if windows else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(m.slope * z + m.shift, -50, 50)))


def fit(windows: list[bytes], labels: np.ndarray, epochs: int = 20, batch: int = 64, seed: int = 5) -> Model:
    """Trains on four fifths of the sample and calibrates (Platt) on the rest."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, dtype=np.float32)
    p = {"embedding": rng.normal(0, 0.3, (CHARS, DIM)), "bias": np.zeros(FILTERS * len(WIDTHS)),
         "out": rng.normal(0, 0.2, FILTERS * len(WIDTHS)), "ob": np.zeros(1),
         **{f"f{i}": rng.normal(0, 0.3, (w * DIM, FILTERS)) for i, w in enumerate(WIDTHS)}}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    made = lambda: Model(p["embedding"], [p[f"f{i}"] for i in range(len(WIDTHS))], p["bias"], p["out"], float(p["ob"][0]), 1.0, 0.0)
    order = rng.permutation(len(windows))
    kept, learn = order[:len(order) // 5], order[len(order) // 5:]
    step = 0
    for _ in range(epochs):
        for i in range(0, len(learn), batch):
            pick = rng.permutation(learn)[:batch] if i == 0 else learn[i:i + batch]
            step += 1
            m = made()
            hidden, logit, chars = _forward(m, *pieces([windows[j] for j in pick]), where=True)
            d = (1 / (1 + np.exp(-logit)) - y[pick]) / len(pick)
            back = d[:, None] * m.out * (hidden > 0)
            g = {"out": hidden.T @ d + 1e-4 * m.out, "ob": np.array([d.sum()], dtype=np.float32), "bias": back.sum(axis=0),
                 "embedding": np.zeros_like(m.embedding)}
            for k, (w, seen) in enumerate(zip(WIDTHS, chars)):
                own = back[:, k * FILTERS:(k + 1) * FILTERS]
                gf = np.zeros_like(m.filters[k])
                for j in range(FILTERS):
                    gf[:, j] = own[:, j] @ m.embedding[seen[:, j]].reshape(len(pick), w * DIM)
                    de = (own[:, j, None] * m.filters[k][:, j]).reshape(len(pick), w, DIM)
                    for o in range(w):
                        np.add.at(g["embedding"], seen[:, j, o], de[:, o])
                g[f"f{k}"] = gf
            for k in p:
                a, b = moments[k]
                a += 0.1 * (g[k] - a)
                b += 0.001 * (g[k] * g[k] - b)
                p[k] -= 0.005 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        learn = rng.permutation(learn)
    m = made()
    z = _forward(m, *pieces([windows[j] for j in kept]))[1].astype(np.float64) if len(kept) else np.zeros(0)
    # Platt's targets keep the calibration finite on separable findings
    pos, neg = y[kept].sum() if len(kept) else 0, (len(kept) - y[kept].sum()) if len(kept) else 0
    t = np.where(y[kept] > 0, (pos + 1) / (pos + 2), 1 / (neg + 2)) if len(kept) else z
    a, b = 1.0, 0.0
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        w = q * (1 - q) + 1e-6
        if not len(z):
            break
        h = np.array([[np.sum(w * z * z) + 1e-3, np.sum(w * z)], [np.sum(w * z), np.sum(w) + 1e-3]])
        move = np.linalg.solve(h, np.array([np.sum((q - t) * z), np.sum(q - t)]))
        a, b = a - 0.5 * move[0], b - 0.5 * move[1]
    return m._replace(slope=float(max(a, 1e-3)), shift=float(b))


def confirmed(runs: list[tuple[int, int]], base: list[Span]) -> list[bool]:
    """Does a span overlap each run?  Both by start, in one pass over them."""
    out, i, reach = [], 0, 0
    for a, b in runs:
        while i < len(base) and base[i].start < b:
            reach = max(reach, base[i].end)
            i += 1
        out.append(reach > a)
    return out


def findings(text: str) -> list[tuple[bytes, bool]]:
    """Every candidate's window, and whether a pattern confirms it."""
    runs = candidates(text)
    return [(window(text, a, b), hit) for (a, b), hit in zip(runs, confirmed(runs, base_spans(text)))]


class Scanner(NamedTuple):
    model: Model | None     # None where there was nothing to learn from
    threshold: float


# ---- on Spark ----------------------------------------------------------------------------


def _windows(docs: DataFrame, text: str) -> DataFrame:
    """(window, label) of every candidate of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [f for t in batch.column(0).to_pylist() if t for f in findings(t)]
            if got:
                w, y = zip(*got)
                yield pa.record_batch([pa.array(w, pa.binary()), pa.array(y, pa.bool_())], names=["window", "label"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, "window binary, label boolean")


def train(docs: DataFrame, text: str = "text", recall: float = RECALL, sample: tuple[int, int] = SAMPLE_ROWS) -> Scanner:
    """Fits the network on a bounded sample of the findings (the first by a
    hash of their windows, equal windows once) and sets its threshold over all
    findings: the highest score, in steps of 1 / SCORE_BINS, that keeps
    ``recall`` of the confirmed ones, however low that is.  Without confirmed
    findings, or without others, nothing is learned or added."""
    from .tables import stored

    spark = docs.sparkSession
    found = stored(_windows(docs, text).groupBy("window").agg(F.max("label").alias("label"), F.count("*").alias("n")), "windows")
    by_hash = F.xxhash64(F.lit(13), F.col("window"))
    parts = [found.where(F.col("label") == v).orderBy(by_hash, "window").limit(n).select("window", "label").collect() for v, n in ((True, sample[0]), (False, sample[1]))]
    if not all(parts):
        return Scanner(None, 2.0)
    rows = parts[0] + parts[1]
    model = fit([bytes(r["window"]) for r in rows], np.array([r["label"] for r in rows]))
    held = spark.sparkContext.broadcast(model)   # fixed size

    @F.arrow_udf(T.DoubleType())
    def score(windows: pa.Array) -> pa.Array:
        return pa.array(predict(held.value, windows.to_pylist()))

    bins = (found.where("label").select(F.floor(score(F.col("window")) * SCORE_BINS).alias("bin"), "n")
            .groupBy("bin").agg(F.sum("n").alias("n")).orderBy(F.col("bin").desc()).collect())      # at most SCORE_BINS + 1 rows
    total, above, cut = sum(r["n"] for r in bins), 0, 1.0
    for r in bins:
        above += r["n"]
        cut = r["bin"] / SCORE_BINS
        if above >= recall * total:
            break
    return Scanner(model, cut)


def spans_of(scanner: Scanner, texts: list[str | None]) -> list[list[Span]]:
    """All spans of each text: the patterns' and the network's added ones,
    which overlap none of these; by start, then kind (added ones last)."""
    texts = [t or "" for t in texts]
    base = [base_spans(t) for t in texts]
    todo = []
    for i, (t, own) in enumerate(zip(texts, base)):
        runs = candidates(t)
        todo += [(i, a, b) for (a, b), hit in zip(runs, confirmed(runs, own)) if not hit]
    out = [list(b) for b in base]
    if todo and scanner.model is not None:
        for at in range(0, len(todo), 4096):
            part = todo[at:at + 4096]
            for (i, a, b), p in zip(part, predict(scanner.model, [window(texts[i], a, b) for i, a, b in part])):
                if p >= scanner.threshold:
                    out[i].append(Span(a, b, ADDED))
    order = (*KINDS, ADDED)
    return [sorted(x, key=lambda s: (s.start, order.index(s.kind))) for x in out]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds ``out``: the secrets of the whole text as (start, end, kind), in
    code points, end exclusive.

    Null and empty texts have none (an empty array, never null); repeated rows
    have the same ones; an input column called ``out``, in any case, is
    replaced; no rows give no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(scanner)   # fixed size

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for texts in batches:
            got = spans_of(held.value, texts.to_pylist())
            yield pa.array([[{"start": s.start, "end": s.end, "kind": s.kind} for s in x] for x in got], kind)

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*kept, spans(F.col(f"`{text}`")).alias(out))


@F.arrow_udf(T.StringType())
def _redacted(texts: pa.Array, spans: pa.Array, marks: pa.Array) -> pa.Array:
    out = []
    for t, x, mark in zip(texts.to_pylist(), spans.to_pylist(), marks.to_pylist()):
        if t and x:
            parts, at = [], 0
            for s in x:
                if s["end"] <= at:
                    continue
                if s["start"] >= at:
                    parts += [t[at:s["start"]], mark]
                at = s["end"]
            t = "".join([*parts, t[at:]])
        out.append(t)
    return pa.array(out, pa.string())


def redact(docs: DataFrame, spans: str = "spans", text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Replaces the spans of ``text`` (overlapping ones together) by ``mark``."""
    return docs.withColumn(text, _redacted(F.col(f"`{text}`"), F.col(f"`{spans}`"), F.lit(mark)))


def written(spans: Column, *kinds: str) -> Column:
    """``kind:start:end`` of the spans (of these kinds, if given), comma-joined."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
