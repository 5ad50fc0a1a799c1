"""N-gram Jaccard self-join by chosen paths.

Every text is the set of its five-word shingles.  Equal sets are one class
from the start.  A set is embedded as 64 minhash values; every run splits the
classes recursively: each node samples one position (now and then two, 1 / 0.8
of them on average) and buckets its sets by the value there.  Buckets of
at most LEAF_ROWS sets are compared outright, larger ones are split further,
and runs repeat until pairs of the threshold's similarity meet in one of them
with the target recall.  What a bucket yields are links whose embeddings agree
about enough; the groups that these links connect are then compared exactly on
their whole shingle sets.  Oversized buckets and groups are compared block by
block in separate tasks, so nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textops
from .tables import components, stored
from .textops import U64

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
POSITIONS = 64
LEAF_ROWS = 1024
MAX_DEPTH = 4
#: Sets of one block in block-by-block comparison.
BLOCK_ROWS = 512
TOKEN_BITS = 48
_rng = np.random.default_rng(20)
MULTIPLIERS = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * U64(2) + U64(1)
ADDENDS = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)


# ---- sets ------------------------------------------------------------------------------


def shingle_sets(texts: list[str | None], n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles (48-bit hashes) of each text, end to end, and
    their bounds; at most 65,536 texts."""
    w = textops.words(textops.codes(texts))
    h, bounds = textops.shingle_hashes(textops.word_hashes(w), w.first, n)
    doc = np.repeat(np.arange(len(texts), dtype=U64), np.diff(bounds))
    x = np.sort((doc << U64(TOKEN_BITS)) | (h >> U64(64 - TOKEN_BITS)))
    if len(x):
        x = x[np.append(True, x[1:] != x[:-1])]
    edges = np.searchsorted(x, np.arange(len(texts) + 1, dtype=U64) << U64(TOKEN_BITS))
    if len(texts) == 1 << (64 - TOKEN_BITS):
        edges[-1] = len(x)
    return x & U64((1 << TOKEN_BITS) - 1), edges.astype(np.int64)


def signatures(tokens: np.ndarray, bounds: np.ndarray, texts: list[str | None]) -> list[bytes]:
    """16 bytes that are equal for equal sets; of the text itself where it
    has no word."""
    out = np.zeros((len(bounds) - 1, 2), dtype=U64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full, 0] = np.add.reduceat(textops.mix(tokens * U64(textops.BASE_1) + U64(1)), bounds[full])
        out[full, 1] = np.add.reduceat(textops.mix(tokens * U64(textops.BASE_2) + U64(3)), bounds[full])
    empty = np.flatnonzero(np.diff(bounds) == 0)
    if len(empty):
        c = textops.codes([texts[i] for i in empty])
        for k, base in enumerate((textops.BASE_1, textops.BASE_2)):
            out[empty, k] = textops.span_hashes(c.cp, c.bounds[:-1], c.bounds[1:], base)
    return [r.tobytes() for r in out]


def embed(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """POSITIONS minhash values (uint32) of each set; zeros for an empty one."""
    out = np.zeros((len(bounds) - 1, POSITIONS), dtype=np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for i, (a, b) in enumerate(zip(MULTIPLIERS, ADDENDS)):
            out[full, i] = np.minimum.reduceat(((tokens * a + b) >> U64(32)).astype(np.uint32), bounds[full])
    return out


def sketches(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, id, n, sketch) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, "text"):
                texts = part.column(1).to_pylist()
                tokens, bounds = shingle_sets(texts, shingle)
                yield pa.record_batch([part.column(0), pa.array(signatures(tokens, bounds, texts), pa.binary()),
                                       pa.array(np.diff(bounds).astype(np.int32)),
                                       pa.array([r.tobytes() for r in embed(tokens, bounds)], pa.binary())],
                                      names=["doc_id", "id", "n", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, id binary, n int, sketch binary")


def token_sets(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, tokens) of every row with words; 6 bytes a shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textops.slices(batch, "text"):
                texts = part.column(0).to_pylist()
                tokens, bounds = shingle_sets(texts, shingle)
                raw = tokens.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()   # little endian
                sets = [raw[6 * a:6 * b] for a, b in zip(bounds, bounds[1:])]
                yield pa.record_batch([pa.array(signatures(tokens, bounds, texts), pa.binary()), pa.array(sets, pa.binary())],
                                      names=["id", "tokens"])

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "id binary, tokens binary")


def unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(blobs), dtype=np.uint8).reshape(-1, 6)
    x = np.zeros((len(raw), 8), dtype=np.uint8)
    x[:, :6] = raw
    bounds = np.zeros(len(blobs) + 1, dtype=np.int64)
    np.cumsum([len(b) // 6 for b in blobs], out=bounds[1:])
    return x.view(U64).ravel(), bounds


# ---- paths -----------------------------------------------------------------------------


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = MAX_DEPTH) -> int:
    """Runs after which a pair of that similarity has met with that recall,
    if every run splits down to ``depth``: a node samples one position, and a
    second one with probability 1 / threshold - 1."""
    second = 1 / threshold - 1
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - threshold * p) * (1 - second * threshold * p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def child_keys(paths: np.ndarray, sketch: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the buckets one level below each row's path."""
    rows, keys = [], []
    h = textops.mix(paths * U64(textops.BASE_1) + U64(17))
    second = textops.mix(h + U64(1)) < U64(int((1 / threshold - 1) * 2 ** 64))
    n = np.arange(len(paths))
    first = (h % U64(POSITIONS)).astype(np.int64)
    other = (first + 1 + (textops.mix(h + U64(2)) % U64(POSITIONS - 1)).astype(np.int64)) % POSITIONS
    for at, use in ((first, np.ones(len(paths), dtype=bool)), (other, second)):
        k = textops.mix(textops.mix(paths + at.astype(U64) * U64(textops.BASE_2)) + sketch[n, at].astype(U64))
        rows.append(n[use])
        keys.append(k[use])
    return np.concatenate(rows), np.concatenate(keys)


def _keys(path: Column, sketch: Column, threshold: float) -> Column:
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(paths: pa.Array, sketches: pa.Array) -> pa.Array:
        p = paths.to_numpy(zero_copy_only=False).view(U64)
        s = np.frombuffer(b"".join(sketches.to_pylist()), dtype=np.uint32).reshape(-1, POSITIONS)
        rows, k = child_keys(p, s, threshold)
        order = np.argsort(rows, kind="stable")
        off = np.zeros(len(p) + 1, dtype=np.int32)
        np.cumsum(np.bincount(rows, minlength=len(p)), out=off[1:])
        return pa.ListArray.from_arrays(pa.array(off), pa.array(k[order].view(np.int64)))

    return F.explode(keys(path, sketch))


def agree_at_least(threshold: float) -> int:
    """Positions that must agree for a candidate: 4 standard deviations below
    what a pair of the threshold's similarity has."""
    return math.floor(POSITIONS * threshold - 4 * math.sqrt(POSITIONS * threshold * (1 - threshold)))


def spanning(sketch: np.ndarray, least: int, cross: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what the pairs of rows agreeing on ``least``
    positions connect (with ``cross``: pairs of different blocks or, for equal
    ones, all).  A search that takes every row found out of the pool, so a
    dense bucket costs about its size and no list of its pairs is made."""
    pool, links = np.arange(len(sketch)), []
    while len(pool):
        front, pool = [pool[0]], pool[1:]
        while front and len(pool):
            u = front.pop()
            hit = (sketch[pool] == sketch[u]).sum(axis=1) >= least
            if hit.any():
                found = pool[hit]
                links += [(u, v) for v in found]
                front += found.tolist()
                pool = pool[~hit]
    return links


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of whole keys, from rows sorted by their first column; a key's
    rows are bounded by the blocks that its key names."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        k = t.column(0).to_numpy()
        cut = int(np.searchsorted(k, k[-1], side="left")) if len(k) else 0
        if cut:
            yield t.slice(0, cut).combine_chunks()
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def candidate_links(leaves: DataFrame, threshold: float, small: int = 12) -> DataFrame:
    """Links within each bucket of (key, id, sketch)."""
    least = agree_at_least(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_key(batches):
            key = t.column("key").to_numpy()
            ids = t.column("id").to_pylist()
            s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint32).reshape(-1, POSITIONS)
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(cut, len(key)))
            group = np.repeat(size, size)
            a, b = [], []
            for d in range(1, small):    # small buckets: all rows d places apart at once
                i = np.flatnonzero((group[:-d] <= small) & (key[:-d] == key[d:])) if d < len(key) else np.zeros(0, dtype=np.int64)
                for j in range(0, len(i), 1 << 16):
                    x = i[j:j + (1 << 16)]
                    x = x[(s[x] == s[x + d]).sum(axis=1) >= least]
                    a += x.tolist()
                    b += (x + d).tolist()
            for c, n in zip(cut[size > small], size[size > small]):
                for u, v in spanning(s[c:c + n], least):
                    a.append(c + u)
                    b.append(c + v)
            if a:
                pairs = {(min(ids[u], ids[v]), max(ids[u], ids[v])) for u, v in zip(a, b)}
                x, y = zip(*pairs)
                yield pa.record_batch([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["a", "b"])

    return leaves.mapInArrow(run, "a binary, b binary")


def block_keys(df: DataFrame, key: Column, size: Column, id: Column, rows: int) -> DataFrame:
    """Adds ``key``: one task's key for every pair of blocks (own one first)
    that a row of a group of ``size`` rows takes part in, and ``own``, its
    block.  A group of at most ``rows`` rows is a single block."""
    blocks = F.ceil(size / F.lit(rows)).cast("int")
    df = df.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(id, F.lit(5)), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return (df.withColumn("key", F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other")))
            .withColumn("single", F.col("own") == F.col("other")).drop("blocks", "other"))


def leaves(classes: DataFrame, threshold: float, recall: float, leaf_rows: int = LEAF_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(key, id): the buckets to compare, of all runs and depths."""
    spark = classes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = runs_needed(threshold, recall, max_depth)
    nodes = classes.where("n > 0").select("id", "sketch", F.explode(F.expr(f"sequence(1L, {runs}L)")).alias("path"))
    done = []
    for depth in range(1, max_depth + 1):
        keys = nodes.select("id", _keys(F.col("path"), F.col("sketch"), threshold).alias("key")).repartition(n, "key")
        counts = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
        met = stored(keys.join(counts, "key"), f"paths{depth}")
        done.append(met.where(F.col("rows") <= leaf_rows).select("key", "id"))
        large = met.where(F.col("rows") > leaf_rows)
        if large.isEmpty():
            break
        if depth == max_depth:   # still large: compared block by block
            done.append(block_keys(large, F.col("key"), F.col("rows"), F.col("id"), leaf_rows // 2).select("key", "id"))
        else:
            nodes = large.select("id", F.col("key").alias("path")).join(classes.select("id", "sketch"), "id")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


# ---- exact comparison ---------------------------------------------------------------------


def overlaps(tokens: np.ndarray, bounds: np.ndarray, width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all pairs of the sets (n x n)."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    number, _ = textops.numbered(tokens)
    shared = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, dtype=bool)
    number, _ = textops.numbered(number[shared])
    owner = owner[shared]
    out = np.zeros((n, n), dtype=np.float64)
    width = min(width, int(number.max()) + 1 if len(number) else 1)
    for i in range(0, (number.max() + 1) if len(number) else 0, width):
        here = (number >= i) & (number < i + width)
        m = np.zeros((n, width), dtype=np.float32)
        m[owner[here], number[here] - i] = 1
        out += m @ m.T
    return out


def _connect(hit: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the pairs of the boolean matrix connect."""
    pool, links = np.arange(len(hit)), []
    while len(pool):
        front, pool = [pool[0]], pool[1:]
        while front and len(pool):
            u = front.pop()
            found = pool[hit[u, pool]]
            links += [(u, v) for v in found]
            front += found.tolist()
            pool = pool[~hit[u, pool]]
    return links


def exact_links(groups: DataFrame, threshold: float) -> DataFrame:
    """From (key, id, own, single, copies, tokens) sorted by key: rows (a, b,
    0) that connect linked classes, and rows (a, null, links): how many
    documents of other classes of this pair of blocks a class is linked to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_key(batches):
            key = t.column("key").to_numpy()
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            a, b, count = [], [], []
            for c, n in zip(cut, np.diff(np.append(cut, len(key)))):
                g = t.slice(c, n)
                ids = g.column("id").to_pylist()
                copies = g.column("copies").to_numpy()
                own = g.column("own").to_numpy()
                tokens, bounds = unpack(g.column("tokens").to_pylist())
                size = np.diff(bounds)
                inter = overlaps(tokens, bounds)
                hit = inter >= (threshold - 1e-12) * (size[:, None] + size[None, :] - inter)
                np.fill_diagonal(hit, False)
                if not g.column("single")[0].as_py():   # two blocks: pairs within each are another task's
                    hit &= own[:, None] != own[None, :]
                for i, links in zip(ids, hit @ copies):
                    if links:
                        a.append(i)
                        b.append(None)
                        count.append(int(links))
                for u, v in _connect(hit):
                    a.append(ids[u])
                    b.append(ids[v])
                    count.append(0)
            if a:
                yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(count, pa.int64())], names=["a", "b", "links"])

    return groups.mapInArrow(run, "a binary, b binary, links long")


def join(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
         shingle: int = SHINGLE_WORDS, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, id (16 bytes that equal sets of
    shingles share), class_id (the smallest doc_id of its group: what links of
    Jaccard similarity >= ``threshold`` connect), n_links (other rows that it
    is linked to, copies included) and keep (one row's (doc_id, id) of each
    group, the one with the smallest doc_id).

    Words are lower-cased runs of letters, digits and marks.  A text of fewer
    words than a shingle is one shingle; wordless texts (null counts as empty)
    are linked to equal ones only.  Repeated rows are links of each other.
    Null doc_ids come last.  Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(sketches(docs, text, shingle), "sketches")
    classes = stored(rows.groupBy("id").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                            F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    buckets = leaves(classes, threshold, recall, leaf_rows)
    found = candidate_links(buckets.join(classes.select("id", "sketch"), "id").select("key", "id", "sketch")
                            .repartition(n, "key").sortWithinPartitions("key"), threshold)
    rough = stored(components(found.distinct()), "rough")
    sizes = rough.groupBy("root").agg(F.count("*").alias("size"))
    members = (rough.join(sizes, "root").withColumnRenamed("v", "id")
               .join(classes.select("id", "copies"), "id"))
    sets = token_sets(docs, text, shingle).join(members, "id").dropDuplicates(["id"])
    groups = (block_keys(sets, F.col("root"), F.col("size"), F.col("id"), block_rows)
              .select("key", "id", "own", "single", "copies", "tokens").repartition(n, "key").sortWithinPartitions("key"))
    links = stored(exact_links(groups, threshold), "links")
    final = components(links.where("b is not null").select("a", "b"))
    counts = links.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    of_class = (classes.select("id", "rep", "copies").join(final.withColumnRenamed("v", "id"), "id", "left")
                .withColumn("root", F.coalesce("root", "id")).join(counts, "id", "left"))
    heads = of_class.groupBy("root").agg(F.min("rep").alias("class_id"), F.min(F.struct(F.col("rep").isNull(), "rep", "id")).getField("id").alias("head"))
    of_class = of_class.join(heads, "root").select("id", "class_id", "head", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return (rows.select("doc_id", "id").join(of_class, "id")
            .select("doc_id", "id", "class_id", "n_links", ((F.col("id") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("rep"))).alias("keep")))


@F.arrow_udf(T.BinaryType())
def _set_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        batch, out = pa.record_batch([texts], names=["t"]), []
        for part in textops.slices(batch, "t"):
            own = part.column(0).to_pylist()
            out += signatures(*shingle_sets(own), own)
        yield pa.array(out, pa.binary())


def keep_one(docs: DataFrame, joined: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``joined`` (of the same rows, with the usual
    shingles) keeps: one of each group.  Rows that repeat the kept one's
    doc_id and set are dropped, too."""
    kept = (joined.where("keep").groupBy("doc_id", "id").agg(F.count("*").alias("__alike"))
            .select(F.col("id").alias("__id"), F.coalesce("doc_id", F.lit(0)).alias("__doc"), F.col("doc_id").isNull().alias("__null"), "__alike"))
    doc = F.col("doc_id").cast("long")
    rows = (docs.withColumn("__id", _set_ids(F.col(f"`{text}`"))).withColumn("__doc", F.coalesce(doc, F.lit(0))).withColumn("__null", doc.isNull())
            .join(kept, ["__id", "__doc", "__null"]))
    repeated = rows.where("__alike > 1").dropDuplicates(["__id", "__doc", "__null"])
    return rows.where("__alike = 1").unionByName(repeated).select(*docs.columns)
