"""Document fingerprints (SimHash) and permuted block tables.

A fingerprint has 128 bits.  Every term of a text (a run of three words)
votes on every bit with the sign of that bit of its hash, weighted by
1 + ln(count); a bit is set where the votes are positive.  Two fingerprints
within Hamming distance r agree on whole blocks of bits, so block tables find
all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import textops
from .textops import U64

BITS = 128
TERM_WORDS = 3
#: Ranges of documents per shuffle partition; the driver holds one bound each.
RANGES_PER_PARTITION = 8
#: A weight of one in fixed point: sums of whole numbers are the same in any order.
ONE = 1 << 24


def _votes(terms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fingerprints (n x 16 bytes) of the terms of each text."""
    n = len(bounds) - 1
    out = np.zeros((n, BITS // 8), dtype=np.uint8)
    step = 1 << 14   # terms whose bits are laid out at once
    sums = np.zeros((n, BITS), dtype=np.int64)     # of the weights that vote for a bit
    whole = np.zeros(n, dtype=np.int64)            # of all weights
    doc = np.repeat(np.arange(n), np.diff(bounds))
    # equal terms of a text vote once, weighted by their number
    order = np.lexsort((terms, doc))
    t, d = terms[order], doc[order]
    new = np.append(True, (t[1:] != t[:-1]) | (d[1:] != d[:-1])) if len(t) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    weight = np.rint((1 + np.log(np.diff(np.append(at, len(t))))) * ONE).astype(np.int64)
    t, d = t[at], d[at]
    for i in range(0, len(t), step):
        x, w, own = t[i:i + step], weight[i:i + step], d[i:i + step]
        words = np.stack([x, textops.mix(x * U64(textops.BASE_1))], axis=1)
        votes = np.unpackbits(words.view(np.uint8).reshape(len(x), -1), axis=1) * w[:, None]
        cut = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        sums[own[cut]] += np.add.reduceat(votes, cut, axis=0)
        whole[own[cut]] += np.add.reduceat(w, cut)
    out[:] = np.packbits(2 * sums > whole[:, None], axis=1)
    return out


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """One row of 16 bytes for each text; null, empty and wordless texts have
    no term and the fingerprint zero; equal texts have equal ones."""
    parts, at = [], 0
    while at < len(texts):   # bounded slices
        stop, chars = at, 0
        while stop < len(texts) and (stop == at or chars + len(texts[stop] or "") <= textops.SLICE_CHARS):
            chars += len(texts[stop] or "")
            stop += 1
        w = textops.words(textops.codes(texts[at:stop]))
        parts.append(_votes(*textops.shingle_hashes(textops.word_hashes(w), w.first, TERM_WORDS)))
        at = stop
    return np.concatenate(parts) if parts else np.zeros((0, BITS // 8), dtype=np.uint8)


def hexes(fps: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in fps]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of bits on which the fingerprints agree, row by row."""
    return 1.0 - np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS


@F.arrow_udf(T.StringType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """Column function: the fingerprint of a text as 32 hex digits."""
    return pa.array(hexes(fingerprints(texts.to_pylist())), pa.string())


# ---- neighbours in fingerprint space ---------------------------------------------------


def _blocks(radius: int) -> tuple[int, int]:
    """(number of blocks, blocks that agree): the fewest tables whose key has
    at least 24 bits, else the longest key."""
    best = None
    for n in range(radius + 1, min(BITS, radius + 9)):
        agree = n - radius
        tables, key = len(list(combinations(range(n), agree))) if n <= 16 else 1 << 30, BITS // n * agree
        if best is None or (key >= 24) > (best[2] >= 24) or (key >= 24) == (best[2] >= 24) and tables < best[3]:
            best = (n, agree, key, tables)
    return best[0], best[1]


def block_keys(fp: Column, radius: int) -> Column:
    """The permuted block tables' entries of a hex fingerprint: one
    ``table:bits`` key for every choice of blocks that have to agree."""
    n, agree = _blocks(radius)
    edges = [BITS * i // n for i in range(n + 1)]
    bits = F.concat(*[F.lpad(F.conv(F.substring(fp, 1 + 8 * i, 8), 16, 2), 32, "0") for i in range(BITS // 32)])
    parts = [F.substring(bits, 1 + a, b - a) for a, b in zip(edges, edges[1:])]
    return F.array(*[F.concat(F.lit(f"{k}:"), *[parts[i] for i in pick]) for k, pick in enumerate(combinations(range(n), agree))])


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two hex fingerprints."""
    word = lambda c, i: F.conv(F.substring(c, 1 + 8 * i, 8), 16, 10).cast("long")
    return sum((F.bit_count(word(a, i).bitwiseXOR(word(b, i))) for i in range(1, BITS // 32)), F.bit_count(word(a, 0).bitwiseXOR(word(b, 0))))


def within_radius(df: DataFrame, queries: DataFrame, radius: int = 3, fp: str = "fingerprint") -> DataFrame:
    """All (query, fingerprint, distance) with distance <= radius between the
    distinct fingerprints of a stated query set and those of ``df``.

    Both sides are reduced to distinct fingerprints first, so copies cost one
    entry; pairs met in several tables are kept once.  Null fingerprints take
    no part; no rows give no rows.
    """
    n_tables = lambda side, name: (side.select(F.col(f"`{fp}`").alias(name)).where(F.col(name).isNotNull()).distinct()
                                   .withColumn("key", F.explode(block_keys(F.col(name), radius))))
    hits = n_tables(queries, "query").join(n_tables(df, "fingerprint"), "key")
    return (hits.withColumn("distance", distance(F.col("query"), F.col("fingerprint")))
            .where(F.col("distance") <= radius).select("query", "fingerprint", "distance").distinct())


# ---- documents against their edited texts and successors --------------------------------

OUT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])
LOWEST = -(1 << 63)


def with_next(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, halo, doc_id, text) rows dealt and sorted so that every row is
    followed by its successor in (doc_id, text) order: ids are cut into ranges,
    and the first rows of each range come once more (halo) at the end of the
    range before (of the last range, for the very first).

    The ranges' bounds are taken from one shuffle of the ids alone; the driver
    holds RANGES_PER_PARTITION bounds per shuffle partition.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LOWEST)).alias("at"),
                     F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    firsts = (rows.select("at").repartitionByRange(n * RANGES_PER_PARTITION, "at")
              .groupBy(F.spark_partition_id()).agg(F.min("at").alias("at")).select("at").collect())
    bounds = np.sort(np.array([r["at"] for r in firsts], dtype=np.int64))
    held = spark.sparkContext.broadcast(bounds)

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("halo", T.BooleanType())])))
    def parts(at: pa.Array) -> pa.Array:
        b, x = held.value, at.to_numpy(zero_copy_only=False)
        own = np.searchsorted(b, x, side="right") - 1
        return pa.array([[(int(p), False), (int((p - 1) % len(b)), True)] if b[p] == v else [(int(p), False)] for p, v in zip(own, x)],
                        pa.list_(pa.struct([("part", pa.int32()), ("halo", pa.bool_())])))

    return (rows.withColumn("p", F.explode(parts("at"))).select("p.part", "p.halo", "at", "doc_id", "text")
            .repartition(n, "part").sortWithinPartitions("part", "halo", "at", "text"))


def edited_and_next(df: DataFrame) -> DataFrame:
    """For every row of (doc_id, text): its length in code points, the SHA-256
    of its edited text (the last half replaced by as many code points from the
    start of the next document), both fingerprints, and the likeness of its
    fingerprint to the edited text's and to the next document's.

    Documents follow each other by (doc_id, text), null ids first, null texts
    as empty; the last is followed by the first, a single one by itself.
    Repeated rows each give a row.  No rows give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None   # the row that waits for its successor
        schema = to_arrow_schema(OUT)

        def rows():
            nonlocal held
            for batch in batches:
                for part in textops.slices(batch, "text"):
                    here = list(zip(*[part.column(i).to_pylist() for i in (0, 1, 3, 4)]))
                    todo = []
                    for r in here:
                        if held is not None and held[0] == r[0] and not held[1]:
                            todo.append((held, r))
                        held = r
                    if todo:
                        yield todo

        for todo in rows():
            texts = [a[3] for a, _ in todo]
            after = [b[3] for _, b in todo]
            edited = [t[:len(t) - len(t) // 2] + s[:len(t) // 2] for t, s in zip(texts, after)]
            own, changed = fingerprints(texts), fingerprints(edited)
            # a successor's fingerprint is its own one, unless it opens no pair here
            nxt = np.empty_like(own)
            nxt[:-1] = own[1:]
            odd = [i for i in range(len(todo)) if i + 1 == len(todo) or todo[i + 1][0] is not todo[i][1]]
            nxt[odd] = fingerprints([after[i] for i in odd])
            yield pa.record_batch([
                pa.array([a[2] for a, _ in todo], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), sha256(edited),
                pa.array(hexes(own), pa.string()), pa.array(hexes(changed), pa.string()),
                pa.array(likeness(own, changed)), pa.array(likeness(own, nxt)),
            ], schema=schema)

    return with_next(df).mapInArrow(run, OUT)


def sha256(texts: list[str]) -> pa.Array:
    import hashlib
    return pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts], pa.string())
