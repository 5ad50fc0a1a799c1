"""Removal of passages that occur elsewhere, by longest previous factors.

Every window of ``length`` bytes has one anchor: its least gram of ``GRAM``
bytes by hash.  Equal windows have equal anchors at equal places, so only
windows around one anchor have to be compared.

1. Tasks find the anchors of their texts; neighbouring windows of one anchor
   form a context, the bytes they cover.  Anchors that occur once in the corpus
   end here, and contexts that occur more than once are copies as a whole.
2. Where an anchor has different contexts, one occurrence of each goes to the
   anchor's task.  The suffixes that start at the anchors are sorted; from
   their order, that of the suffixes one byte further left follows by one
   stable sort on that byte, and so on up to the farthest window.  In every
   such piece of the suffix array, the previous and next smaller positions give
   each window's longest previous factor: one of ``length`` bytes or more marks
   a later copy, and its source.
3. Anchors with very many different contexts (a passage's edge in a large part
   of all documents) don't fit one task: their windows are compared as
   fingerprints, counted in the tasks and shuffled by (anchor, distance,
   fingerprint), so nothing is gathered.
4. The windows found are joined to their documents.

Two occurrences count as equal contexts (1) or windows (3) by 128 bits of
hash, contexts of one anchor (2) by their bytes.  What is broadcast are two
bitmaps of a fixed number of bits; an accidental bit lets an occurrence
through that the next step finds to be single.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bitmap, stored
from .textops import BASE_1, BASE_2, U64, mix, powers, slices

#: Bytes of a repeated string that is removed.
LENGTH = 200
#: Bytes of an anchor.
GRAM = 24
#: Bytes of text that a task holds as arrays at once; longer texts are cut into
#: overlapping pieces, which share no window and leave none out.
PIECE = 1 << 20
#: Bits of each of the bitmaps that are broadcast (8 MB).
BITMAP_BITS = 1 << 26
#: Different contexts of an anchor up to which one task sorts them.
SORTED_CONTEXTS = 8192
#: Contexts that a task sorts at once (whole anchors).
BATCH_CONTEXTS = 8192
#: A position among rows without an id: after all others.
LAST = (1 << 63) - 1

OCCURRENCES = "anchor long, context long, doc long, k long, start int, windows int, lead int, runs int"
CONTEXTS = OCCURRENCES + ", bytes binary"
WINDOWS = "doc long, k long, start int, windows int, later boolean"


# ---- anchors ------------------------------------------------------------------------


@functools.cache
def byte_hashes() -> np.ndarray:
    """Two 64-bit numbers for every byte value."""
    return mix(np.arange(1, 513, dtype=U64) * U64(BASE_2)).reshape(2, 256)


class Anchors(NamedTuple):
    part: np.ndarray      # which of the pieces
    start: np.ndarray     # first window, from the start of the piece
    windows: np.ndarray   # how many windows, one after another
    lead: np.ndarray      # bytes from the first window to the anchor
    anchor: np.ndarray    # hash of the anchor's bytes
    context: np.ndarray   # hash of the bytes that the windows cover


def anchors(pieces: list[bytes], length: int = LENGTH) -> Anchors:
    """The contexts of pieces of at least ``length`` bytes, in order.  The
    anchor is the gram of the least hash, the rightmost of equal ones."""
    buf = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    n, wide = len(buf), length - GRAM + 1
    off = np.zeros(len(pieces) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in pieces], out=off[1:])
    tables = byte_hashes()
    sums = []
    for table, base in zip(tables, (BASE_1, BASE_2)):
        acc = np.zeros(n + 1, dtype=U64)
        np.cumsum(table[buf] * powers(base, n + 1)[0][:-1], out=acc[1:])
        sums.append(acc)
    inverse = powers(BASE_1, n + 1)[1]
    gram = mix((sums[0][GRAM:] - sums[0][:-GRAM]) * inverse[:n - GRAM + 1])
    low = U64((1 << 24) - 1)        # pieces together are shorter than that
    m = (gram & ~low) | (low - np.arange(len(gram), dtype=U64))
    span = 1
    while 2 * span <= wide:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < wide:
        m = np.minimum(m[:len(m) - (wide - span)], m[wide - span:])
    at = (low - (m & low)).astype(np.int64)      # of every window's anchor
    size = np.diff(off) - length + 1             # windows of each piece
    first = np.cumsum(size) - size
    w = np.repeat(off[:-1] - first, size) + np.arange(size.sum())
    a = at[w]
    new = np.empty(len(w), dtype=bool)
    new[0] = True
    new[1:] = a[1:] != a[:-1]
    new[first] = True
    s = np.flatnonzero(new)
    windows = np.diff(np.append(s, len(w)))
    part = np.searchsorted(first, s, side="right") - 1
    start, place = w[s], a[s]
    end = start + windows + length - 1
    context = mix((sums[1][end] - sums[1][start]) * powers(BASE_2, n + 1)[1][start] + windows.astype(U64))
    return Anchors(part, start - off[part], windows, place - start, gram[place], context)


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Lists of (doc, k, offset, bytes) of PIECE bytes together at most; the
    windows of a longer text are dealt to pieces of it."""
    held, size = [], 0
    for part in slices(batch, "text", PIECE):
        for doc, k, text in zip(*(c.to_pylist() for c in part.columns)):
            for at in range(0, max(0, len(text) - length + 1), PIECE - length + 1):
                piece = text[at:at + PIECE]
                if len(piece) < length:
                    break
                if held and size + len(piece) > PIECE:
                    yield held
                    held, size = [], 0
                held.append((doc, k, at, piece))
                size += len(piece)
    if held:
        yield held


def _occurrences(length: int, wanted=None, with_bytes=None):
    """Task: the contexts of documents (doc, k, text).  Neighbouring equal
    ones (periodic text) are one row with their number in ``runs``.  Only
    those whose anchor has its bit in ``wanted`` pass; with ``with_bytes``,
    those whose own bit is in it, and their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted and np.frombuffer(wanted.value, dtype=np.uint8)
        own = with_bytes and np.frombuffer(with_bytes.value, dtype=np.uint8)
        for batch in batches:
            for pieces in _pieces(batch, length):
                x = anchors([p[3] for p in pieces], length)
                new = np.ones(len(x.part), dtype=bool)
                new[1:] = (x.part[1:] != x.part[:-1]) | (x.anchor[1:] != x.anchor[:-1]) | (x.context[1:] != x.context[:-1])
                at = np.flatnonzero(new)
                runs = np.diff(np.append(at, len(new)))
                doc, k, base = (np.array([p[i] for p in pieces], dtype=np.int64)[x.part[at]] for i in range(3))
                start = base + x.start[at]
                pick = np.ones(len(at), dtype=bool)
                if bits is not None:
                    pick &= _has(bits, x.anchor[at].view(np.int64))
                if own is not None:
                    pick &= _has(own, x.context[at].view(np.int64) ^ (start * START_STEP) ^ ((doc & DOC_BITS) * DOC_STEP))
                at, runs, doc, k, start = at[pick], runs[pick], doc[pick], k[pick], start[pick]
                if not len(at):
                    continue
                cols = [x.anchor[at].view(np.int64), x.context[at].view(np.int64), doc, k, *(c.astype(np.int32) for c in (start, x.windows[at], x.lead[at], runs))]
                names = ["anchor", "context", "doc", "k", "start", "windows", "lead", "runs"]
                if own is not None:
                    ends = x.start[at] + x.windows[at] + length - 1
                    cols.append(pa.array([pieces[p][3][a:b] for p, a, b in zip(x.part[at].tolist(), x.start[at].tolist(), ends.tolist())], pa.binary()))
                    names = [*names, "bytes"]
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)

    return run


#: Fixed odd steps that spread an occurrence's place over the bitmap; products stay in 63 bits.
START_STEP, DOC_STEP, DOC_BITS = 1_000_003, 2_654_435_761, 0x7FFFFFFF


def _occurrence_bit() -> F.Column:
    return F.expr(f"context ^ (cast(start as long) * {START_STEP}) ^ ((doc & {DOC_BITS}) * {DOC_STEP})")


def _has(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = x & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# ---- suffix order -------------------------------------------------------------------


def nearest_smaller(v: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For every place the nearest place before it with a smaller value, not
    beyond ``left`` of the place; -1 where there is none.  Places jump over
    what the places they point to have skipped."""
    p = np.arange(len(v)) - 1
    p[p < left] = -1
    todo = np.flatnonzero(p >= 0)
    todo = todo[v[p[todo]] >= v[todo]]
    while len(todo):
        p[todo] = p[p[todo]]
        todo = todo[p[todo] >= 0]
        todo = todo[v[p[todo]] >= v[todo]]
    return p


def previous_factors(position: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes in suffix order with their text positions, where ``joined``
    says whether a suffix and the next have ``length`` bytes in common: the
    place (in that order) of the previous and of the next smaller position
    that is as near, or -1.  A suffix has a previous factor of that length
    where one of them is there."""
    n = len(position)
    i = np.arange(n)
    cut = np.ones(n + 1, dtype=bool)
    cut[1:n] = ~joined
    left = np.maximum.accumulate(np.where(cut[:n], i, 0))
    right = n - 1 - np.maximum.accumulate(np.where(cut[1:][::-1], i, 0))[::-1]
    psv = nearest_smaller(position, left)
    nsv = nearest_smaller(position[::-1], n - 1 - right[::-1])[::-1]
    return psv, np.where(nsv >= 0, n - 1 - nsv, -1)


def range_minima(x: np.ndarray) -> list[np.ndarray]:
    """Minima of x over 1, 2, 4, ... places from each."""
    out, span = [x], 1
    while 2 * span <= len(x):
        out.append(np.minimum(out[-1][:-span], out[-1][span:]))
        span *= 2
    return out


def range_min(table: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of places a to b - 1, for a < b."""
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    out = np.zeros(len(a), dtype=table[0].dtype)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << k)])
    return out


def repeated_windows(group: np.ndarray, position: np.ndarray, lead: np.ndarray, windows: np.ndarray, raw: list[bytes],
                     length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of anchors (``group``): whether window j of a context has an
    equal one at a smaller position, and whether it is the source of another."""
    n, wide = len(raw), length - GRAM + 1
    later, source = np.zeros((2, n, wide), dtype=bool)
    buf = np.frombuffer(b"".join(raw) + b"\0" * length, dtype=np.uint8)
    size = np.array([len(r) for r in raw])
    anchor = np.cumsum(size) - size + lead
    tail = np.arange(-(-length // 8) * 8)
    right = np.where(tail < (size - lead)[:, None], buf[np.minimum(anchor[:, None] + tail, len(buf) - 1)], 0).astype(np.uint8)
    words = right.view(">u8")
    order = np.lexsort((*words.T[::-1], group))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    same = right[order[1:]] == right[order[:-1]]
    common = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1)).astype(np.int16) if n > 1 else np.zeros(0, dtype=np.int16)
    common[group[order[1:]] != group[order[:-1]]] = -1
    minima = range_minima(common)
    nearest = lead - windows + 1
    cls = group[order]
    for d in range(int(lead.max()) + 1):
        if d:       # the suffixes one byte further left
            stay = lead[order] >= d
            order, cls = order[stay], cls[stay]
            key = cls * 256 + buf[anchor[order] - d]
            by = np.argsort(key, kind="stable")
            order, key = order[by], key[by]
            cls = np.cumsum(np.append(False, key[1:] != key[:-1]))
        on = nearest[order] <= d
        x, c = order[on], cls[on]
        if len(x) < 2:
            continue
        joined = c[1:] == c[:-1]
        at = np.flatnonzero(joined)
        joined[at] = range_min(minima, rank[x[at]], rank[x[at + 1]]) >= length - d
        if not joined.any():
            continue
        psv, nsv = previous_factors(position[x], joined)
        j = lead[x] - d
        found = np.flatnonzero((psv >= 0) | (nsv >= 0))
        later[x[found], j[found]] = True
        for near in (psv[psv >= 0], nsv[nsv >= 0]):
            source[x[near], j[near]] = True
    return later, source


def _span_rows(doc, k, start, later: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    """Runs of consecutive flagged windows of each context."""
    edge = np.zeros((len(flags), flags.shape[1] + 2), dtype=np.int8)
    edge[:, 1:-1] = flags
    step = np.diff(edge, axis=1)
    who, a = np.nonzero(step == 1)
    b = np.nonzero(step == -1)[1]
    return pa.record_batch([pa.array(doc[who]), pa.array(k[who]), pa.array((start[who] + a).astype(np.int32)), pa.array((b - a).astype(np.int32)),
                            pa.array(np.full(len(who), later))], names=["doc", "k", "start", "windows", "later"])


def _sorted_contexts(length: int):
    """Task: rows of CONTEXTS sorted by anchor -> WINDOWS."""

    def solve(rows: list) -> Iterator[pa.RecordBatch]:
        anchor, _, doc, k, start, windows, lead, _ = (np.array(c, dtype=np.int64) for c in list(zip(*rows))[:8])
        group = np.cumsum(np.append(False, anchor[1:] != anchor[:-1]))
        position = np.empty(len(rows), dtype=np.int64)
        position[np.lexsort((start + lead, k, doc))] = np.arange(len(rows))
        later, source = repeated_windows(group, position, lead, windows, [r[8] for r in rows], length)
        yield _span_rows(doc, k, start, True, later)
        yield _span_rows(doc, k, start, False, source & ~later)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= BATCH_CONTEXTS and row[0] != held[-1][0]:
                    yield from solve(held)
                    held = []
                held.append(row)
        if held:
            yield from solve(held)

    return run


def _window_prints(length: int):
    """Task: rows of CONTEXTS -> a fingerprint of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cols = {name: part.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(part.schema.names[:8])}
                raw = part.column(8).to_pylist()
                buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
                size = np.array([len(r) for r in raw])
                off = np.cumsum(size) - size
                count = cols["windows"].astype(np.int64)
                j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row = np.repeat(np.arange(len(raw)), count)
                s = off[row] + j
                acc = np.zeros(len(buf) + 1, dtype=U64)
                power, inverse = powers(BASE_1, len(buf) + 1)
                np.cumsum(byte_hashes()[1][buf] * power[:-1], out=acc[1:])
                h = mix((acc[s + length] - acc[s]) * inverse[s])
                yield pa.record_batch([pa.array(c) for c in (cols["anchor"][row], (cols["lead"][row] - j).astype(np.int32), h.view(np.int64), cols["doc"][row], cols["k"][row],
                                                             (cols["start"][row] + j).astype(np.int32))], names=["anchor", "distance", "print", "doc", "k", "start"])

    return run


# ---- the operator -------------------------------------------------------------------


def _keyed(docs: DataFrame, text: str, order: str) -> DataFrame:
    """(doc, k, text): the row's place, a hash of its text, and its bytes."""
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.coalesce(F.col(f"`{order}`").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(body).alias("k"), body.alias("text"))


def windows(docs: DataFrame, length: int = LENGTH, keep: str | None = "first", text: str = "text", order: str = "doc_id",
            bits: int = BITMAP_BITS, sorted_contexts: int = SORTED_CONTEXTS) -> DataFrame:
    """(doc, k, start, windows): starts of strings of ``length`` bytes to
    remove, as runs of consecutive ones.  With ``keep="first"`` these are the
    strings with an earlier copy, by (order, text hash, position); with None
    the first ones go, too."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _keyed(docs, text, order).where(F.octet_length("text") >= length)
    broadcast = spark.sparkContext.broadcast

    seen = texts.mapInArrow(_occurrences(length), OCCURRENCES).groupBy("anchor").agg(F.sum("runs").alias("n"))
    repeated = broadcast(bitmap(seen.where("n > 1"), F.col("anchor"), bits))
    found = stored(texts.mapInArrow(_occurrences(length, repeated), OCCURRENCES), "occurrences")
    place = F.struct("doc", "k", "start")
    kinds = stored(found.groupBy("anchor", "context").agg(F.sum("runs").alias("n"), F.min(place).alias("first")), "contexts")
    copies = found.join(kinds.where("n > 1"), ["anchor", "context"])
    whole = copies.select("doc", "k", "start", (F.col("windows") * F.col("runs")).alias("windows"), (place != F.col("first")).alias("later"))
    if keep == "first":     # the first of a run of equal contexts stays
        whole = copies.select("doc", "k", F.when(place == F.col("first"), F.col("start") + F.col("windows")).otherwise(F.col("start")).alias("start"),
                              F.when(place == F.col("first"), F.col("windows") * (F.col("runs") - 1)).otherwise(F.col("windows") * F.col("runs")).alias("windows"),
                              F.lit(True).alias("later")).where("windows > 0")

    many = stored(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "anchors")
    wanted = kinds.join(many, "anchor").select("context", "first.*")
    chosen = broadcast(bitmap(wanted, _occurrence_bit(), bits))
    several = broadcast(bitmap(many, F.col("anchor"), bits))
    contexts = stored(texts.mapInArrow(_occurrences(length, several, chosen), CONTEXTS), "bytes")
    large = stored(many.where(F.col("kinds") > sorted_contexts).select("anchor"), "large")
    few = contexts.join(large, "anchor", "left_anti")
    # dealt by a hash of the anchor, not the anchor: the planner would drop that
    # after a join dealt by it, and may split the join's tasks, and anchors with them
    by_order = few.repartition(n, F.xxhash64("anchor")).sortWithinPartitions("anchor").mapInArrow(_sorted_contexts(length), WINDOWS)

    prints = contexts.join(large, "anchor", "left_semi").mapInArrow(_window_prints(length), "anchor long, distance int, print long, doc long, k long, start int")
    key = ["anchor", "distance", "print"]
    equal = prints.groupBy(*key).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    by_print = prints.join(equal, key).select("doc", "k", "start", F.lit(1).alias("windows"), (place != F.col("first")).alias("later"))
    out = whole.unionByName(by_order).unionByName(by_print)
    return (out.where("later") if keep == "first" else out).select("doc", "k", "start", "windows")


def _merged(length: int):
    @F.arrow_udf("array<struct<start:int,end:int>>")
    def merged(found: pa.Array) -> pa.Array:
        starts, ends, off = [], [], [0]
        for x in found:
            if x.is_valid:
                at = x.values
                s, w = (at.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                by = np.argsort(s, kind="stable")
                s, e = s[by], np.maximum.accumulate((s + w + length - 1)[by])
                new = np.append(True, s[1:] > e[:-1])
                starts.append(s[new])
                ends.append(e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)])
                off.append(off[-1] + int(new.sum()))
            else:
                off.append(off[-1])
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0), pa.int32())
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.StructArray.from_arrays([cat(starts), cat(ends)], ["start", "end"]))
    return merged


def dedup(docs: DataFrame, length: int = LENGTH, keep: str | None = "first", text: str = "text", order: str = "doc_id", out: str = "spans", **search) -> DataFrame:
    """Adds ``out`` (array of start and end): the byte ranges of the text, in
    UTF-8, that are to be removed, disjoint and in order.

    A byte goes if a string of ``length`` bytes that covers it also starts
    elsewhere, in the same text or another one (overlapping itself counts);
    with ``keep="first"`` only if it starts earlier elsewhere: by ``order``
    (null last), then by the text's hash and the position.  Matches never
    cross rows and are judged on the input.

    Null texts are empty; empty and shorter ones keep all bytes; repeated rows
    are copies of each other (rows of one id and text get one answer); texts of
    any length are searched whole; an empty table gives an empty one; an input
    column called like ``out``, in any case, is replaced, others pass through.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()]
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.coalesce(F.col(f"`{order}`").cast("long"), F.lit(LAST)).alias("__doc"), F.xxhash64(body).alias("__k"), F.struct(*kept).alias("__row"))
    found = windows(docs, length, keep, text, order, **search)
    found = (found.groupBy(F.col("doc").alias("__doc"), F.col("k").alias("__k"))
             .agg(F.collect_list(F.struct("start", "windows")).alias("__found")))
    joined = rows.join(found, ["__doc", "__k"], "left").select("__row", _merged(length)("__found").alias("__spans"))
    return joined.select(*[F.col("__row")[c].alias(c) for c in docs.columns if c.lower() != out.lower()], F.col("__spans").alias(out))


def kept_bytes(text: bytes, spans: list) -> bytes:
    """The text without the spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])
