"""Byte-level BPE: global distinct-word shuffle, and decoding.

1. Documents are packed into portions of about three megabytes (one
   row: the portion's rows as a compressed Arrow batch, under a key made of
   its content) and dealt by that key.
2. Every portion is split into pre-tokens with their positions; its distinct
   words go, bucketed by word hash, to the bucket's partition.  There every
   distinct word of the corpus is merged once per partition stream, however
   often and in however many portions it occurs.
3. The ids come back by portion and are put at the words' positions.

A word met in every document costs one entry per portion, so no key grows
with the number of its occurrences.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textops
from .textops import U64

#: Bytes of text in one portion (one longer text is a portion of its own).
PORTION_CHARS = 3 << 20
#: Distinct words whose ids a task remembers.
KNOWN_WORDS = 500_000
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: White space as the pattern's \s has it (Unicode White_Space). Fixed values.
WHITE_SPACE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one ``base64(token) rank`` a line (a fixed vocabulary)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


# ---- pre-tokens ---------------------------------------------------------------------


@functools.cache
def class_table() -> np.ndarray:
    t = np.full(textops.N_CODES, OTHER, dtype=np.uint8)
    for i in range(textops.N_CODES):
        k = unicodedata.category(chr(i))[0]
        if k == "L":
            t[i] = LETTER
        elif k == "N":
            t[i] = NUMBER
    t[list(WHITE_SPACE)] = SPACE
    return t


def pre_tokens(c: textops.Codes) -> np.ndarray:
    """Start positions of the matches of the split pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^sLN]+|s+(?!S)|s+`` in all texts;
    the matches cover the texts, so each ends where the next one starts.

    Runs of one class are the matches, with these exceptions: one space before
    a run belongs to it; white space before a run leaves its last character
    to stand alone or join that run; and an apostrophe that starts a match
    takes the letters of a contraction from the run after it.
    """
    cp, n = c.cp, len(c.cp)
    if not n:
        return np.zeros(0, dtype=np.int64)
    cls = class_table()[cp]
    head = np.zeros(n + 3, dtype=bool)      # first character of a text
    head[c.bounds] = True
    head[n:] = True
    run = np.empty(n, dtype=bool)
    run[0] = True
    run[1:] = cls[1:] != cls[:-1]
    run |= head[:n]
    ends = np.empty(n, dtype=bool)          # last character of a run
    ends[:-1] = run[1:]
    ends[-1] = True
    space = cls == SPACE
    start = run & space
    # the last white space before a run of the same text
    start |= space & ends & ~head[1:n + 1]
    joined = np.zeros(n, dtype=bool)        # the run takes the space before it
    joined[1:] = run[1:] & ~head[1:n] & (cp[:-1] == 0x20) & ~space[1:]
    start |= run & ~space & ~joined
    at = np.flatnonzero((cp == 0x27) & start)
    if len(at):
        wide = np.concatenate([cp, np.zeros(3, dtype=cp.dtype)])
        wcls = np.concatenate([cls, np.full(3, SPACE, dtype=cls.dtype)])
        a, b = wide[at + 1], wide[at + 2]
        in1, in2 = ~head[at + 1], ~head[at + 1] & ~head[at + 2]
        one = in1 & np.isin(a, [ord(x) for x in "stmd"])
        two = in2 & np.logical_or.reduce([(a == ord(x)) & (b == ord(y)) for x, y in ("re", "ve", "ll")])
        for hit, k in ((at[one], 2), (at[two], 3)):
            start[hit + 1] = False
            rest = hit + k
            rest = rest[~head[rest] & (wcls[rest] == LETTER)]
            start[rest] = True
    return np.flatnonzero(start)


class Distinct(NamedTuple):
    words: pa.Array      # binary, the distinct pre-tokens by ascending hash
    hashes: np.ndarray   # of each of them
    number: np.ndarray   # of every pre-token: its place in words
    first: np.ndarray    # pre-tokens of text i are first[i]:first[i + 1]


def distinct_words(texts: list[str | None]) -> Distinct:
    hashes, checks, counts, tokens = [], [], [np.zeros(1, dtype=np.int64)], []
    at = 0
    while at < len(texts):      # hashed in slices, so that memory is bounded by these
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars + len(texts[stop] or "") <= textops.SLICE_CHARS):
            chars += len(texts[stop] or "")
            stop += 1
        c = textops.codes(texts[at:stop])
        start = pre_tokens(c)
        counts.append(np.diff(np.searchsorted(start, c.bounds)))
        if len(start):
            end = np.append(start[1:], len(c.cp))
            hashes.append(textops.span_hashes(c.cp, start, end))
            checks.append(textops.span_hashes(c.cp, start, end, textops.BASE_2))
            place = np.zeros(len(c.cp) + 1, dtype=np.int32 if len(c.cp) < 1 << 29 else np.int64)
            np.cumsum(1 + (c.cp > 0x7F) + (c.cp > 0x7FF) + (c.cp > 0xFFFF).view(np.uint8), out=place[1:])
            raw = c.cp.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            offsets = np.append(place[start], place[-1]).astype(np.int64)
            tokens.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)]))
        at = stop
    first = np.cumsum(np.concatenate(counts))
    if not hashes:
        return Distinct(pa.array([], pa.large_binary()), np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64), first)
    h, check = np.concatenate(hashes), np.concatenate(checks)
    number, rep = textops.numbered(h)
    if not (check == check[rep][number]).all():   # different words of one hash: tell them apart by the second
        _, rep, number = np.unique(np.stack([h, check], axis=1), axis=0, return_index=True, return_inverse=True)
    order = np.lexsort((check[rep], h[rep]))
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    rep = rep[order]
    return Distinct(pa.chunked_array(tokens).take(pa.array(rep)).combine_chunks(), h[rep], place[number], first)


# ---- merges -------------------------------------------------------------------------


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: of all adjacent pairs the one of the lowest rank
    (the leftmost of these) is merged until none has a rank.  A heap of pairs
    over a linked list, so long words take n log n steps."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    parts = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        if parts[i] is None:
            continue
        j = after[i]
        if j >= n or len(parts[i]) + len(parts[j]) != size:
            continue  # one of the two has grown meanwhile
        parts[i] += parts[j]
        parts[j] = None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(parts[i] + parts[k])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[k])))
        if (k := before[i]) >= 0 and (r := ranks.get(parts[k] + parts[i])) is not None:
            heapq.heappush(heap, (r, k, len(parts[k]) + len(parts[i])))
    return [ranks[p] for p in parts if p is not None]


# ---- portions -----------------------------------------------------------------------

PACKED = "portion long, rows binary"
WORDS = "bucket long, portion long, words binary"
IDS = "bucket long, portion long, ids binary"


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _read(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


ZSTD = pa.Codec("zstd", 3)


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers by byte planes: the high ones are mostly zero."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(raw: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8, count=4 * n).reshape(4, n).T).view("<u4").ravel()


def pack_lists(sizes: np.ndarray, body: bytes) -> bytes:
    """Sizes of lists and their content end to end, compressed."""
    raw = _planes(sizes) + body
    return np.array([len(sizes), len(raw)], dtype="<u4").tobytes() + ZSTD.compress(raw, asbytes=True)


def unpack_lists(blob: bytes) -> tuple[np.ndarray, bytes]:
    n, size = np.frombuffer(blob, dtype="<u4", count=2).tolist()
    raw = ZSTD.decompress(blob[8:], size, asbytes=True)
    return _numbers(raw, n).astype(np.int64), raw[4 * n:]


def pack(df: DataFrame, column: str, chars: int = PORTION_CHARS) -> DataFrame:
    """Rows of about ``chars`` characters of text together, as (portion, rows).
    The portion's key is a hash of its content, the same however often and
    wherever the portion is made."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, column, chars):
                blob = _ipc(part)
                c = np.frombuffer(blob + b"\0" * (-len(blob) % 8), dtype=U64)
                key = textops.span_hashes(c, np.array([0]), np.array([len(c)])).view(np.int64)
                yield pa.record_batch([pa.array(key), pa.array([blob], pa.binary())], names=["portion", "rows"])

    return df.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, PACKED)


def _cuts(hashes: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets (top bits of the hash) of words by ascending hash: number,
    first word and end of each."""
    b = (hashes >> shift).astype(np.int64)
    start = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    return b[start], start, np.append(start[1:], len(b))


def encode(df: DataFrame, ranks: dict[bytes, int], column: str = "text", out: str = "ids",
           buckets: int | None = None) -> DataFrame:
    """Adds ``out`` (array<int>): the token ids of the whole text.

    Null and empty texts get an empty array; repeated rows stay and are
    encoded alike; a text of any length is encoded whole (texts without white
    space in n log n steps); an empty table gives an empty table; an input
    column called ``out``, in any case, is replaced, others pass through.  A word
    goes to one of ``buckets`` buckets by its hash: set it above the number
    of tasks of the cluster.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * n
    table = spark.sparkContext.broadcast(ranks)   # a fixed vocabulary
    docs = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)
    shift = U64(64 - max(1, (buckets - 1).bit_length()))
    packed = pack(docs, column).repartition(n, "portion")

    def to_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                d = distinct_words(_read(blob).column(column).to_pylist())
                if not len(d.words):
                    continue
                b, start, end = _cuts(d.hashes, shift)
                off = np.frombuffer(d.words.buffers()[1], dtype=np.int64)[:len(d.words) + 1]
                body = d.words.buffers()[2].to_pybytes()
                blobs = [pack_lists(np.diff(off[i:j + 1]), body[off[i]:off[j]]) for i, j in zip(start, end)]
                yield pa.record_batch([pa.array(b), pa.array([portion] * len(b), pa.int64()), pa.array(blobs, pa.binary())],
                                      names=["bucket", "portion", "words"])

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, known = table.value, {}
        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known.clear()
            out_blobs = []
            for blob in batch.column(2).to_pylist():
                size, body = unpack_lists(blob)
                end = np.cumsum(size).tolist()
                got, at = [], 0
                for e in end:
                    w = body[at:e]
                    at = e
                    x = known.get(w)
                    if x is None:
                        x = known[w] = merge(w, r)
                    got.append(x)
                flat = np.fromiter(chain.from_iterable(got), dtype=np.uint32)
                out_blobs.append(pack_lists(np.fromiter(map(len, got), dtype=np.uint32, count=len(got)), _planes(flat)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out_blobs, pa.binary())],
                                  names=["bucket", "portion", "ids"])

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        by_bucket = dict(zip(right.column("bucket").to_pylist(), right.column("ids").to_pylist()))
        found = []
        for blob in left.column("rows").to_pylist():
            rows = _read(blob)
            d = distinct_words(rows.column(column).to_pylist())
            ids, bounds = np.zeros(0, dtype=np.int32), np.zeros(rows.num_rows + 1, dtype=np.int64)
            if len(d.words):
                lists = [unpack_lists(by_bucket[b]) for b in _cuts(d.hashes, shift)[0].tolist()]
                each = np.concatenate([s for s, _ in lists])
                if len(each) != len(d.words):
                    raise RuntimeError("a portion's words differ from those that were encoded")
                flat = np.concatenate([_numbers(x, len(x) // 4) for _, x in lists])
                off = np.cumsum(each) - each
                size = each[d.number]
                total = np.zeros(len(size) + 1, dtype=np.int64)
                np.cumsum(size, out=total[1:])
                ids = np.empty(total[-1], dtype=np.int32)
                for i in range(0, len(size), 1 << 16):      # pre-tokens at a time
                    j = min(i + (1 << 16), len(size))
                    k = size[i:j]
                    ids[total[i]:total[j]] = flat[np.repeat(off[d.number[i:j]] - total[i:j], k) + np.arange(total[i], total[j])]
                bounds = total[d.first]
            col = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            cols = [rows.column(f.name).combine_chunks() for f in arrow if f.name != out]
            found.append(pa.Table.from_arrays([*cols, col], names=arrow.names).cast(arrow))
        return pa.concat_tables(found) if found else arrow.empty_table()

    words = packed.mapInArrow(to_words, WORDS).repartition(n, "bucket")
    ids = words.mapInArrow(to_ids, IDS)
    return (packed.groupBy("portion").cogroup(ids.groupBy("portion")).applyInArrow(assemble, schema))


class Tokens:
    """The token-byte table laid out for array lookups."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = {i: b for b, i in ranks.items()}
        n = max(by_id, default=-1) + 1
        self.bytes = [by_id.get(i) for i in range(n)]
        self.text = [str(i) for i in range(n)]

    def decode(self, ids) -> bytes:
        """The bytes of the ids; an id outside the vocabulary raises."""
        return b"".join(map(self.bytes.__getitem__, ids))

    def decimal(self, ids) -> str:
        return " ".join(map(self.text.__getitem__, ids))


def decode(df: DataFrame, ranks: dict[bytes, int], column: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out`` (binary): the ids' bytes end to end.  The token-byte table
    is a fixed vocabulary, so a lookup in its broadcast list stands for the
    join; positions stay as they are and nothing is shuffled.

    Null ids give null, no ids give no bytes; an unknown id raises.
    """
    table = df.sparkSession.sparkContext.broadcast(Tokens(ranks))

    @F.arrow_udf(T.BinaryType())
    def to_bytes(ids: pa.Array) -> pa.Array:
        t = table.value
        return pa.array([t.decode(x.as_py()) if x.is_valid else None for x in ids], pa.binary())

    return df.withColumn(out, to_bytes(F.col(f"`{column}`")))
