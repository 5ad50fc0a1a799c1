"""Intermediate tables in the shared folder, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to a fresh table in the shared folder and reads it
    back: lineage ends there, and a lost executor costs nothing written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(df: DataFrame, value: Column, bits: int) -> bytes:
    """A bitmap of ``bits`` bits (a multiple of 32,768), on where a value
    modulo ``bits`` is; built in pieces of 4 KB on the executors, so that at
    most an eighth of ``bits`` in bytes comes to the driver."""
    at = F.pmod(value, F.lit(bits)) + 1
    pieces = df.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = bytearray(bits // 8)
    for piece, part in pieces.collect():
        out[(piece - 1) * 4096:piece * 4096] = part
    return bytes(out)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(v, root) for every vertex of the undirected edges: the smallest vertex
    of its connected component.

    Alternating large-star and small-star steps: every vertex points its
    larger (then its smaller) neighbours to its smallest one, until the edges
    are stars.  Needs about log(longest path) rounds of two shuffles of the
    edges; nothing of it comes to the driver but two sums per round.  Self-loops
    and repeated edges are allowed; no edges give no rows.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    loops = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("v"), F.col(a).alias("root"))
    last = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # now every u > v: point u and all its smaller neighbours to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select("v", "m", "u")
                 .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), F.col("m")))).alias("x"))
                 .select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u != v").distinct())
        e = stored(small, "edges")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components: too many rounds")
    roots = e.select(F.col("u").alias("v"), F.col("v").alias("root"))
    ends = e.select("v").distinct().withColumn("root", F.col("v"))
    return roots.unionByName(ends).unionByName(loops).groupBy("v").agg(F.min("root").alias("root"))
