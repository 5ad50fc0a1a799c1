"""Source divergence audit over the terms that an iceberg search keeps.

1. Terms are found level by level.  A level counts, for every language, the
   documents that hold a term starting with a byte prefix of the level's
   length, and the documents and occurrences of the complete terms up to that
   length.  Prefixes in fewer than ``min_docs`` documents are discarded; only
   terms that start with a surviving prefix are looked at by the next level,
   whose prefixes are twice as long.  The search ends when no prefix is left.
2. Tasks count before anything is shuffled, so a term in a third of all
   documents is one row per task.  Survivors reach the next level as a bitmap
   of a fixed number of bits: a collision only lets a prefix through that the
   exact counts discard one level later.
3. The divergence of two sources is summed from what is sparse: the terms that
   both have, a histogram of each source's shares, and one product for the
   terms that neither has.  All arithmetic is on integers.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops
from .tables import bitmap, stored

#: Bytes of the first level's prefixes; every later level doubles them.
FIRST_LEVEL = 8
#: Bits of the survivors' bitmap: what is broadcast is at most an eighth of it in bytes (8 MB).
BITMAP_BITS = 1 << 26
#: Distinct terms and (term, source) entries that a task holds before it hands them on.
TASK_ENTRIES = 1_500_000
#: Characters of text that a task splits into terms at once.
SLICE_CHARS = 4 << 20
#: Shares are counted in this unit.
SCALE = 1_000_000_000
#: Cells (sources x terms) that a task compares at once.
CELLS = 1 << 20

LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
COUNTS = "lang string, item binary, complete boolean, docs long, occurrences long, sources array<string>, counts array<long>"


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and non-ASCII characters; only A-Z are lower-cased."""
    return text.translate(LETTERS).split()


def _bit(prefix: bytes, seed: int, bits: int) -> int:
    return zlib.crc32(prefix, seed) % bits


class Numbers(dict):
    """Numbers what it is asked for, in order of appearance."""

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        return n


class Counts:
    """What a task has counted for one language at one level: documents and
    occurrences by (complete term, source), and documents by prefix."""

    def __init__(self, lang: str, lo: int, hi: int, bits: int, bitmap: bytes | None):
        self.lang, self.lo, self.hi, self.bits, self.bitmap = lang, lo, hi, bits, bitmap
        self.seed = zlib.crc32(lang.encode() + b"\0")
        self.terms, self.prefixes, self.sources = Numbers(), Numbers(), Numbers()
        self.place = np.zeros(0, dtype=np.int32)    # of each term: -1 not looked at, 0 complete, else 1 + its prefix's number
        self.of_prefix = np.zeros(0, dtype=np.int64)
        self.entries: list[np.ndarray] = []         # (term and source, documents, occurrences)
        self.held = 0

    def _place(self, term: bytes) -> int:
        if self.bitmap is not None:
            b = _bit(term[:self.lo], self.seed, self.bits)
            if not self.bitmap[b >> 3] >> (b & 7) & 1:
                return -1
        return 0 if len(term) <= self.hi else 1 + self.prefixes[term[:self.hi]]

    def add(self, texts: list[bytes], sources: list[str]) -> None:
        number = self.terms.__getitem__
        found = map(terms, texts)
        if self.lo:
            found = ([t for t in x if len(t) > self.lo] for x in found)
        ids = [np.fromiter(map(number, x), dtype=np.int64, count=len(x)) for x in found]
        new = list(islice(self.terms, len(self.place), None))
        if new:
            self.place = np.append(self.place, np.fromiter(map(self._place, new), dtype=np.int32, count=len(new)))
        source = np.fromiter(map(self.sources.__getitem__, sources), dtype=np.int64, count=len(sources))
        doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        x = np.concatenate(ids)
        looked = self.place[x] >= 0
        n = max(1, len(self.terms))
        once, times = np.unique(doc[looked] * n + x[looked], return_counts=True)     # every term of a document once
        doc, x = once // n, once % n
        place = self.place[x]
        whole = place == 0
        key, at = np.unique(x[whole] << 32 | source[doc[whole]], return_inverse=True)
        sums = np.bincount(at, times[whole], len(key)).astype(np.int64)
        self.entries.append(np.stack([key, np.bincount(at, minlength=len(key)), sums]))
        self.held += len(key)
        m = max(1, len(self.prefixes))
        prefix = np.unique(doc[~whole] * m + place[~whole] - 1) % m
        count = np.bincount(prefix, minlength=len(self.prefixes))
        count[:len(self.of_prefix)] += self.of_prefix
        self.of_prefix = count

    def rows(self) -> pa.RecordBatch:
        key, docs, times = np.concatenate(self.entries, axis=1) if self.entries else np.zeros((3, 0), dtype=np.int64)
        key, at = np.unique(key, return_inverse=True)
        docs, times = (np.bincount(at, v, len(key)).astype(np.int64) for v in (docs, times))
        term, source = key >> 32, key & 0xFFFFFFFF
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        off = np.append(first, len(key))
        names = list(self.terms)
        hit = np.flatnonzero(self.of_prefix)
        prefixes = list(self.prefixes)
        n = len(hit)
        total = lambda v: np.add.reduceat(v, first) if len(first) else v
        lists = [pa.ListArray.from_arrays(pa.array(np.append(off, np.full(n, off[-1])), pa.int32()), v)
                 for v in (pa.array(list(self.sources), pa.string()).take(pa.array(source)), pa.array(times, pa.int64()))]
        return pa.record_batch([
            pa.array([self.lang] * (len(first) + n), pa.string()),
            pa.array([names[i] for i in term[first].tolist()] + [prefixes[i] for i in hit.tolist()], pa.binary()),
            pa.array(np.append(np.ones(len(first), dtype=bool), np.zeros(n, dtype=bool)), pa.bool_()),
            pa.array(np.append(total(docs), self.of_prefix[hit]), pa.int64()),
            pa.array(np.append(total(times), np.zeros(n, dtype=np.int64)), pa.int64()), *lists],
            names=["lang", "item", "complete", "docs", "occurrences", "sources", "counts"])


def _level_counts(lo: int, hi: int, bits: int, survivors):
    """The counting task of one level: terms longer than ``lo`` bytes whose
    prefix of ``lo`` bytes survived; complete up to ``hi`` bytes, as prefixes
    of ``hi`` bytes beyond."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = survivors.value if survivors else None
        counts: dict[str, Counts] = {}
        for batch in batches:
            for part in textops.slices(batch, "text", SLICE_CHARS):
                by_lang: dict[str, tuple[list, list]] = {}
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                    texts, sources = by_lang.setdefault(lang, ([], []))
                    texts.append(text)
                    sources.append(source)
                for lang, (texts, sources) in by_lang.items():
                    if lang not in counts:
                        counts[lang] = Counts(lang, lo, hi, bits, bitmap)
                    counts[lang].add(texts, sources)
                if sum(len(c.terms) + c.held for c in counts.values()) > TASK_ENTRIES:
                    yield from (c.rows() for c in counts.values())
                    counts = {}
        yield from (c.rows() for c in counts.values())

    return run


def _texts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    return docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).cast("binary").alias("text"))


def kept_terms(docs: DataFrame, min_docs: int = 3, text: str = "text", lang: str = "lang", source: str = "source",
               first_level: int = FIRST_LEVEL, bits: int = BITMAP_BITS) -> DataFrame:
    """(lang, source, term, n_occurrences, lang_docs, lang_occurrences) of every
    term in at least ``min_docs`` documents of its language, for the sources
    that have it.

    Every row is a document, whatever its id (repeated rows count each).  Null
    text, language and source count as empty; texts are taken whole, however
    long; an empty table keeps nothing; columns besides the named ones are not
    read, so their names don't matter.
    """
    spark = docs.sparkSession
    texts = _texts(docs, text, lang, source)
    levels, found, lo, hi, survivors = [], [], 0, first_level, None
    while True:
        counted = stored(texts.mapInArrow(_level_counts(lo, hi, bits, survivors), COUNTS), "level")
        sums = counted.groupBy("lang", "complete", "item").agg(F.sum("docs").alias("lang_docs"), F.sum("occurrences").alias("lang_occurrences"))
        sums = stored(sums.where(F.col("lang_docs") >= min_docs), "kept")
        levels.append(counted.where("complete").select("lang", "item", F.arrays_zip("sources", "counts").alias("by_source")))
        found.append(sums.where("complete").drop("complete"))
        prefixes = sums.where(~F.col("complete"))
        if prefixes.isEmpty():
            break
        at = F.crc32(F.concat(F.concat("lang", F.lit("\0")).cast("binary"), "item"))
        survivors = spark.sparkContext.broadcast(bitmap(prefixes, at, bits))
        lo, hi = hi, 2 * hi
    every, whole = (functools.reduce(DataFrame.unionByName, x) for x in (levels, found))
    each = every.join(whole, ["lang", "item"]).select("lang", "item", "lang_docs", "lang_occurrences", F.explode("by_source").alias("s"))
    return (each.groupBy("lang", "item", F.col("s.sources").alias("source"))
            .agg(F.sum("s.counts").alias("n_occurrences"), F.first("lang_docs").alias("lang_docs"), F.first("lang_occurrences").alias("lang_occurrences"))
            .select("lang", "source", F.col("item").cast("string").alias("term"), "n_occurrences", "lang_docs", "lang_occurrences"))


def _share(count: str, total: str, kept: str) -> F.Column:
    """1 + floor(SCALE (count + 1) / (total + kept)); in 64 bits where the product fits."""
    wide = f"(cast({SCALE} as decimal(10, 0)) * (cast({count} as decimal(20, 0)) + 1)) div ({total} + {kept})"
    fits = (1 << 63) // SCALE - 2
    return F.expr(f"case when {total} + {kept} > 0 then 1 + case when {count} < {fits} then ({SCALE}L * ({count} + 1)) div ({total} + {kept}) else {wide} end end")


def _excess(p: str, q: str) -> F.Column:
    """floor((p - q)**2 / q); shares are at most SCALE + 1, so it fits 64 bits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, by_source: source, p, base), one per term: for every two
    sources, the terms they share, and by how much the excess summed from
    their shares differs from what either histogram says of these terms."""
    f = lambda x, y: (x - y) * (x - y) // y

    def compare(lang: str, rows: pa.ListArray) -> Iterator[pa.RecordBatch]:
        each = rows.flatten()
        names = each.field(0).dictionary_encode()
        place = names.indices.to_numpy()
        names = names.dictionary
        p = np.zeros((len(names), len(rows)), dtype=np.int64)
        off = rows.offsets.to_numpy()
        p[place, np.repeat(np.arange(len(rows)), np.diff(off))] = each.field(1).to_numpy()
        base = np.zeros(len(names), dtype=np.int64)
        base[place] = each.field(2).to_numpy()
        for i in range(len(names)):
            own = np.flatnonzero(p[i])
            mine, other = p[i][own], p[:, own]
            both = other > 0
            both[i] = False
            who = np.flatnonzero(both.any(axis=1))
            if not len(who):
                continue
            other, both = np.maximum(other[who], 1), both[who]
            delta = np.where(both, f(mine, other) - f(mine, base[who][:, None]) - f(base[i], other), 0).sum(axis=1)
            yield pa.record_batch([pa.array([lang] * len(who), pa.string()), names.take(pa.array([i] * len(who))), names.take(pa.array(who)),
                                   pa.array(both.sum(axis=1), pa.int64()), pa.array(delta, pa.int64())], names=["lang", "source", "item", "common", "delta"])

    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            rows = batch.column(1).filter(pa.array(langs.indices.to_numpy() == k))
            size = np.diff(rows.offsets.to_numpy())
            at = 0
            while at < len(rows):       # a task's matrix has CELLS cells at most, or one term
                stop = at + max(1, int(np.searchsorted(np.cumsum(size[at:]) * np.arange(1, len(size) - at + 1), CELLS, side="right")))
                yield from compare(lang, rows.slice(at, stop - at))
                at = stop


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, text: str = "text", lang: str = "lang", source: str = "source", **search) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a
    language is from its other sources (part ``pair``: every other source) and
    by which terms it stands out of the language (part ``term``: the ``top``
    terms whose share exceeds the language's).

    A share is 1 + floor(10**9 (count + 1) / (N + V)) over the language's V
    kept terms, the value floor((p - q)**2 / q), summed over all kept terms for
    a pair.  Nulls count as empty strings; a source without kept terms still
    has its pairs; a language without kept terms has pairs of value 0 and no
    terms; ties rank by the item's bytes; an empty table gives no rows.
    """
    counts = stored(kept_terms(docs, min_docs, text, lang, source, **search), "kept")
    langs = counts.groupBy("lang", "term").agg(F.first("lang_occurrences").alias("c")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("lang_n"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n_occurrences").alias("n"), F.count("*").alias("own"))
    groups = (_texts(docs, text, lang, source).select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["n", "own", "v", "lang_n"]))
    groups = stored(groups.withColumn("base", _share("0", "n", "v")), "groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share("n_occurrences", "n", "v"))

    terms_ = (shares.withColumn("q", _share("lang_occurrences", "lang_n", "v")).where("p > q")
              .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _excess("p", "q").alias("value")))
    terms_ = terms_.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)

    several = (shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "base")).alias("by_source")).where(F.size("by_source") > 1)
               .select("lang", "by_source"))
    shared = several.mapInArrow(_shared_terms, "lang string, source string, item string, common long, delta long")
    steps = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))      # a source's shares, and how many terms have each
    ends = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("far"))
    mine = steps.join(ends, "lang").where("source != item").select("lang", "source", "item", F.lit(0).cast("long").alias("common"), (F.col("k") * _excess("p", "far")).alias("delta"))
    other = steps.join(ends, "lang").where("source != item").select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.lit(0).cast("long").alias("common"),
                                                                   (F.col("k") * _excess("far", "p")).alias("delta"))
    sums = shared.unionByName(mine).unionByName(other).groupBy("lang", "source", "item").agg(F.sum("common").alias("common"), F.sum(F.col("delta").cast("decimal(38, 0)")).alias("delta"))
    ends = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("far"), F.col("own").alias("far_own"))
    neither = (F.col("v") - F.col("own") - F.col("far_own") + F.coalesce("common", F.lit(0))).cast("decimal(20, 0)") * F.coalesce(_excess("base", "far"), F.lit(0))
    pairs = (groups.join(ends, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.when(F.col("v") == 0, F.lit(0)).otherwise(neither + F.coalesce("delta", F.lit(0))).cast("long").alias("value")))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return pairs.unionByName(terms_)
