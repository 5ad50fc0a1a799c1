"""Alignment of the tokens of two tokenizers, and statistics of linked ids.

1. Documents are tokenised whole by both.  No token of either kind spans a
   space after anything but white space (this is checked), so the ids are those of the
   stretches of text between such places, one after another; a task tokenises
   each distinct stretch once.
2. Where a token of each ends at the same byte and the next token of each starts
   with a space, the ids are split; what lies between two such places is a
   window, known by its token ids alone.  A window is aligned once and
   remembered by its two id tuples.
3. Documents are packed into portions of about three megabytes.  A portion's
   row has its documents, with the numbers of their linked id pairs, and the
   portion's distinct pairs with the number of documents that hold each.
4. The pairs' counts are summed over all portions, joined back by pair and
   portion, and meet the documents there.  A pair in every document is one row
   per portion, so no key grows with the number of its occurrences.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
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
from .tables import stored

#: Bytes of text in one portion (one longer text is a portion of its own).
PORTION_CHARS = 3 << 20
#: Characters tokenised in one call (one longer stretch is a call of its own).
CALL_CHARS = 1 << 15
#: Bytes, about, of remembered stretches and windows (ids and results) that a task holds.
MEMO_BYTES = 192 << 20
#: Where a text may be cut, if no token contains it.
SEAM = re.compile(r"\S ")
PORTIONS = "portion long, rows binary, pairs array<long>, docs array<int>"
#: What the alignment adds to each row.
FIELDS = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()), ("n_best", T.LongType()),
          ("count_sum", T.LongType()), ("groups", T.StringType())]


# ---- tokenizers ---------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable
    ones of Latin-1 stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary(NamedTuple):
    bytes: list[bytes]      # of every id
    size: np.ndarray        # their lengths
    spaced: np.ndarray      # do they start with a space


def vocabulary(tokens: list[bytes]) -> Vocabulary:
    return Vocabulary(tokens, np.array([len(t) for t in tokens], dtype=np.int64), np.array([t[:1] == b" " for t in tokens]))


class Tokenizers:
    """Both tokenizers, made in a worker from their files' content."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        by_id = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        entry = lambda t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        self.va = vocabulary([entry(by_id.get(i, "")) for i in range(max(by_id) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
        self.vb = vocabulary([piece(i) for i in range(self.b.get_piece_size())])
        self.seams = not any(SEAM.search(t.decode("utf-8", "replace")) for t in (*self.va.bytes, *self.vb.bytes))

    def stretches(self, text: str) -> list[str]:
        """The text cut at every space that follows neither another space nor
        other white space, without these spaces."""
        words = text.split(" ")
        odd = {w for w in set(words) if not w or w[-1].isspace()}
        if not self.seams:
            return [text]
        if not odd:
            return words
        out, held = [], None
        for w in words:
            held = w if held is None else f"{held} {w}"
            if w not in odd:
                out.append(held)
                held = None
        if held is not None:        # white space at the end belongs to what is before it
            out[-1:] = [f"{out[-1]} {held}" if out else held]
        return out

    def encode(self, texts: list[str]) -> "Ids":
        """Ids of space + text by A and of text by B, of each stretch of text."""
        parts = [self._call(texts[at:stop]) for at, stop in _calls(texts)]
        return Ids(*(np.concatenate(c) if parts else np.zeros(0, dtype=np.int64) for c in zip(*parts))) if parts else Ids(*[np.zeros(0, dtype=np.int64)] * 4, np.zeros(0, dtype=bool))

    def _call(self, texts: list[str]) -> "Ids":
        """Stretches next to each other have the ids that each has alone; if
        their bytes differ somewhere, half of them are asked at a time."""
        joined = " ".join(texts)
        want = (" " + joined).encode()
        size = np.fromiter((len(t.encode()) + 1 for t in texts), dtype=np.int64, count=len(texts))
        first = np.append(0, np.cumsum(size))
        out, exact = [], True
        for v, ids in ((self.va, self.a.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids), (self.vb, self.b.encode(joined))):
            exact = exact and b"".join(map(v.bytes.__getitem__, ids)) == want
            ids = np.array(ids, dtype=np.int64)
            ends = np.append(0, np.cumsum(v.size[ids]))
            at = np.searchsorted(ends, first)
            exact = exact and bool((ends[at] == first).all())
            out += [ids, np.diff(at)]
        if exact:
            return Ids(*out, np.ones(len(texts), dtype=bool))
        if len(texts) > 1:
            n = len(texts) // 2
            return Ids(*map(np.concatenate, zip(self._call(texts[:n]), self._call(texts[n:]))))
        none = np.zeros(0, dtype=np.int64)
        return Ids(none, np.zeros(1, dtype=np.int64), none, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=bool))


class Ids(NamedTuple):
    a: np.ndarray           # of all stretches, end to end
    n_a: np.ndarray         # how many each has
    b: np.ndarray
    n_b: np.ndarray
    exact: np.ndarray       # are the tokens' bytes, by either, space + text; if not, a stretch has none


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists' numbers end to end, and how many each has."""
    count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(count.sum())), count


def _sums(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of x, in parts of ``count`` numbers."""
    total = np.append(0, np.cumsum(x, dtype=np.int64))
    end = np.cumsum(count)
    return total[end] - total[end - count]


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, count of them, end to end."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _calls(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of stretches of CALL_CHARS together at most, or of a single one.
    One that ends with white space is the last of its range."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and (size + len(t) > CALL_CHARS or texts[i - 1][-1:].isspace() or not texts[i - 1]):
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


# ---- windows ------------------------------------------------------------------------


class Numbers(dict):
    """Numbers what it is asked for, in order of appearance."""

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        return n


class Stretch(NamedTuple):
    n_a: int
    n_b: int
    windows: list[int]      # their numbers


class Aligner:
    """Tokenises stretches of text, splits them into windows, aligns each
    distinct window once, and remembers both."""

    def __init__(self, tokenizers: Tokenizers, memo_bytes: int = MEMO_BYTES):
        self.t, self.limit = tokenizers, memo_bytes
        self.n_b = len(tokenizers.vb.bytes)
        # a token's id with the sign that follows it: within a group, or at the end of its side
        self.signs = [f"{i}{x}" for v, end in ((tokenizers.va, "|"), (tokenizers.vb, ";")) for i in range(len(v.bytes)) for x in (",", end)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, Stretch | None] = {}
        self.number = Numbers()                 # of a window, by its two id tuples
        self.text: list[str] = []               # of window n: its groups, each with a sign after it
        self.n_groups: list[int] = []
        self.links: list[np.ndarray] = []       # a * n_b + b of its linked tokens
        self.held = 0

    def find(self, stretches: list[str]) -> list[Stretch | None]:
        """Of each stretch; None where its tokens' bytes differ from it."""
        if self.held > self.limit:
            self.forget()
        new = [t for t in stretches if t not in self.known]
        if new:
            self._learn(new)
        return [self.known[t] for t in stretches]

    def _learn(self, texts: list[str]) -> None:
        a, count_a, b, count_b, exact = self.t.encode(texts)
        self.held += 2 * sum(map(len, texts)) + 350 * len(texts)
        if not exact.all():
            self.known.update((texts[k], None) for k in np.flatnonzero(~exact).tolist())
            texts, count_a, count_b = [texts[k] for k in np.flatnonzero(exact).tolist()], count_a[exact], count_b[exact]
        if not len(a):
            return
        size_a, size_b = self.t.va.size[a], self.t.vb.size[b]
        mark_a, mark_b = np.flatnonzero(self.t.va.spaced[a]), np.flatnonzero(self.t.vb.spaced[b])
        # tokens that start at the same byte, with a space each: so do those at a stretch's start
        _, i, j = np.intersect1d((np.cumsum(size_a) - size_a)[mark_a], (np.cumsum(size_b) - size_b)[mark_b], assume_unique=True, return_indices=True)
        i, j = np.append(mark_a[i], len(a)), np.append(mark_b[j], len(b))
        raw_a, raw_b = a.astype(np.int32).tobytes(), b.astype(np.int32).tobytes()
        p, q = (4 * i).tolist(), (4 * j).tolist()
        before = len(self.number)
        numbers = list(map(self.number.__getitem__, [(raw_a[x:y], raw_b[u:v]) for x, y, u, v in zip(p, p[1:], q, q[1:])]))
        numbers_at = np.array(numbers)
        new, at = np.unique(numbers_at, return_index=True)
        self._align(a, b, i[:-1], np.diff(i), j[:-1], np.diff(j), at[new >= before])
        ends = np.searchsorted(i[:-1], np.cumsum(count_a)).tolist()
        self.known.update((t, Stretch(x, y, numbers[u:v])) for t, x, y, u, v in zip(texts, count_a.tolist(), count_b.tolist(), [0, *ends], ends))

    def _align(self, a, b, i, n_i, j, n_j, new: np.ndarray) -> None:
        """Aligns the windows ``new``, of n_i tokens of a from i and n_j of b from j."""
        n_i, n_j = n_i[new], n_j[new]
        a, b = a[_ranges(i[new], n_i)].astype(np.int64), b[_ranges(j[new], n_j)].astype(np.int64)
        end_a, end_b = np.cumsum(self.t.va.size[a]), np.cumsum(self.t.vb.size[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.isin(end_a, cuts, assume_unique=True), np.isin(end_b, cuts, assume_unique=True)
        # between neighbouring ends of either lies one pair of overlapping tokens
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.append(True, ends[1:] > ends[:-1])]
        links = a[np.searchsorted(end_a, ends)] * self.n_b + b[np.searchsorted(end_b, ends)]
        stop = end_a[np.cumsum(n_i) - 1]
        link_at = np.searchsorted(ends, stop, side="right")
        group_at = np.searchsorted(cuts, stop, side="right")
        group = np.concatenate([2 * np.searchsorted(cuts, end_a), 2 * np.searchsorted(cuts, end_b) + 1])
        sign = np.concatenate([2 * a + last_a, 2 * (len(self.t.va.bytes) + b) + last_b])
        written = list(map(self.signs.__getitem__, sign[np.argsort(group, kind="stable")].tolist()))
        at = np.cumsum(n_i + n_j).tolist()
        texts = ["".join(written[x:y]) for x, y in zip([0, *at], at)]
        self.text += texts
        self.n_groups += np.diff(group_at, prepend=0).tolist()
        self.links += np.split(links, link_at[:-1]) if len(new) else []
        self.held += sum(map(len, texts)) + 8 * len(links) + 400 * len(new)


# ---- portions -----------------------------------------------------------------------


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _portion(part: pa.RecordBatch, texts: list[str], aligner: Aligner, digest: bool) -> pa.RecordBatch:
    """A row of PORTIONS: the rows' own columns with their figures, and the
    places of their pairs among the portion's, as steps, with the pairs' numbers."""
    number = Numbers()
    cut = [list(map(number.__getitem__, aligner.t.stretches(t))) if t else [] for t in texts]
    flat, size = _flat(cut)
    doc = np.repeat(np.arange(len(texts)), size)
    found = aligner.find(list(number))
    exact = np.ones(len(texts), dtype=bool)
    exact[doc[np.array([s is None for s in found], dtype=bool)[flat]]] = False      # the whole document has no tokens then
    found = [s or Stretch(0, 0, []) for s in found]
    windows, n_windows = _flat([s.windows for s in found])
    used, windows = np.unique(windows, return_inverse=True)     # numbered anew for this portion
    used = used.tolist()
    links, n_links = _flat([aligner.links[w] for w in used])
    n_groups = np.array([aligner.n_groups[w] for w in used], dtype=np.int64)
    figures = [np.fromiter((s[k] for s in found), dtype=np.int64, count=len(found)) for k in (0, 1)]
    figures += [_sums(x[windows], n_windows) for x in (n_groups, n_links)]
    figures = [np.where(exact, np.bincount(doc, c[flat], len(texts)), 0).astype(np.int64) for c in figures]
    written = [aligner.text[s.windows[0]] if len(s.windows) == 1 else "".join([aligner.text[w] for w in s.windows]) for s in found]
    groups = ["".join([written[n] for n in own])[:-1] if ok else "" for own, ok in zip(cut, exact)]
    if digest:
        groups = [g and hashlib.sha256(g.encode()).hexdigest() for g in groups]
    flat, doc = flat[exact[doc]], doc[exact[doc]]
    pairs, local = np.unique(links, return_inverse=True)
    # the links of each stretch
    off, size = np.cumsum(n_links) - n_links, n_links[windows]
    local = local[_ranges(off[windows], size)]
    size = _sums(size, n_windows)
    off = np.cumsum(size) - size
    # (document, stretch) once with its number, then (document, pair)
    key, times = np.unique(doc * max(1, len(found)) + flat, return_counts=True)
    doc, stretch = key // max(1, len(found)), key % max(1, len(found))
    k = size[stretch]
    key = np.repeat(doc, k) * max(1, len(pairs)) + local[_ranges(off[stretch], k)]
    by = np.argsort(key, kind="stable")
    key, times = key[by], np.repeat(times, k)[by]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    times = np.add.reduceat(times, new) if len(new) else times
    doc, pair = key[new] // max(1, len(pairs)), key[new] % max(1, len(pairs))
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
    step = np.diff(pair, prepend=0)
    step[bounds[:-1][np.diff(bounds) > 0]] = pair[bounds[:-1][np.diff(bounds) > 0]]
    lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (step, times)]
    own = [*map(pa.array, figures), pa.array(groups, pa.string())]
    rows = pa.record_batch([*part.columns, *own, *lists], names=[*(f"c{i}" for i in range(part.num_columns)), "n_a", "n_b", "n_groups", "n_links", "groups", "pair", "times"])
    docs = np.bincount(pair, minlength=len(pairs)).astype(np.int32)
    return pa.record_batch([pa.array([uuid.uuid4().int >> 65]), pa.array([_ipc(rows)], pa.binary()), pa.array([pairs.astype(np.int64)], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int32()))],
                           names=["portion", "rows", "pairs", "docs"])


def portions(docs: DataFrame, a_json: str, b_model: bytes, text: str = "text", digest: bool = False) -> DataFrame:
    """The packed documents, in the shared folder; ``docs`` without its text
    column passes through."""
    files = docs.sparkSession.sparkContext.broadcast((a_json, b_model))     # fixed vocabularies
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Tokenizers(*files.value))
        for batch in batches:
            for part in textops.slices(batch, "__text", PORTION_CHARS):
                yield _portion(part.select(list(range(part.num_columns - 1))), part.column(part.num_columns - 1).to_pylist(), aligner, digest)

    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text")
    return stored(docs.select(*[F.col(f"`{c}`") for c in others], body).mapInArrow(run, PORTIONS), "portions")


def pair_counts(packed: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best): for every linked pair of ids (a * n_b + b), how
    many documents hold it linked, and whether no pair of its A id has more."""
    each = packed.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = each.groupBy("pair").agg(F.sum("docs").alias("count"))
    a = F.expr(f"pair div {n_b}").alias("a")
    most = counts.groupBy(a).agg(F.max("count").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_json: str, b_model: bytes, text: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` without its text column, and per row: n_a, n_b (tokens),
    n_groups, n_links, n_best (links whose pair is in as many documents as any
    pair of its A id), count_sum (documents of the links' pairs, summed) and
    groups: ``a1,a2|b1;a3|b2,b3``, ids in order, or its SHA-256 with ``digest``.

    A is the content of a byte-level BPE's JSON file and encodes space + text;
    B of a sentencepiece model, and encodes text.  Null and empty texts, and
    those whose tokens' bytes aren't space + text, have no tokens: zeros, and
    an empty string.  Every row is a document: repeated ones count each.  Texts
    of any length are tokenised whole; an empty table gives an empty one; input
    columns called like an added one, in any case, are replaced, others pass.
    """
    spark = docs.sparkSession
    added = {n for n, _ in FIELDS}
    passed = [c for c in docs.columns if c != text and c.lower() not in added]
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in passed], *[T.StructField(n, t) for n, t in FIELDS]])
    arrow = to_arrow_schema(schema)
    packed = portions(docs.select(*[F.col(f"`{c}`") for c in passed], F.col(f"`{text}`").alias("__text")), a_json, b_model, "__text", digest)
    import sentencepiece
    n_b = sentencepiece.SentencePieceProcessor(model_proto=b_model).get_piece_size()
    counts = stored(pair_counts(packed, n_b), "pairs")
    wanted = (packed.select(F.col("portion").alias("owner"), F.explode("pairs").alias("pair")).join(counts, "pair")
              .select("owner", "pair", "count", "best"))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        count, best = (right.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
        tables = []
        for blob in left.column("rows").to_pylist():
            rows = pa.ipc.open_stream(blob).read_all().combine_chunks()
            step, times = (rows.column(c).combine_chunks() for c in ("pair", "times"))
            bounds = step.offsets.to_numpy().astype(np.int64)
            pair = np.cumsum(step.values.to_numpy(), dtype=np.int64)
            lead = np.append(0, pair)[bounds[:-1]]
            pair -= np.repeat(lead, np.diff(bounds))
            times = times.values.to_numpy().astype(np.int64)
            total = [np.diff(np.append(0, np.cumsum(times * x[pair]))[bounds]) for x in (best, count)]
            cols = {"n_best": pa.array(total[0]), "count_sum": pa.array(total[1])} | {c: rows.column(c) for c in ("n_a", "n_b", "n_groups", "n_links", "groups")}
            tables.append(pa.Table.from_arrays([*(rows.column(f"c{i}") for i in range(len(passed))), *(cols[n] for n, _ in FIELDS)], names=arrow.names).cast(arrow))
        return pa.concat_tables(tables) if tables else arrow.empty_table()

    return packed.select("portion", "rows").groupBy("portion").cogroup(wanted.groupBy("owner")).applyInArrow(finish, schema)


def read_files(a_path: str, b_path: str) -> tuple[str, bytes]:
    """The two vocabulary files; the driver reads them, tasks get the content."""
    with open(a_path, encoding="utf-8") as f:
        a = f.read()
    json.loads(a)
    with open(b_path, "rb") as f:
        return a, f.read()
