"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

Every source gets a target number of words.  Whole epochs of a source come
first; the rest of its target is a weighted sample without replacement: each
document draws an exponential key scaled by its quality weight, documents are
taken by ascending key, and their sizes are prefix-summed up to the budget.

The prefix sums are made without gathering a source in one task: sizes are
summed by (source, slot), slots being quantiles of the source's own keys; the
slots' running sums show in which one a source's budget ends, that one is dealt
to slots again, and only the last small one is summed document by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import stored

#: Slots that a source's keys are dealt to at once, by their quantiles.
SLOTS = 64
#: Rows of a source, at the end of its budget, that one task sums row by row.
END_ROWS = 1024
#: Rounds that fill what the document at the budget's end leaves open.
ROUNDS = 3
CAP = 3
WEIGHTS = (5, 2, 1)
#: Quality weight of a labelled document of quality 0; all others weigh 1.
LOW_QUALITY = 0.25


@F.arrow_udf(T.LongType())
def word_count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Maximal runs of characters other than space and \\t \\n \\v \\f \\r; null: 0."""
    blank = np.zeros(256, dtype=bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    for texts in batches:
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        out = np.zeros(len(texts), dtype=np.int64)
        at = 0
        while at < len(texts):   # bounded slices of the batch's bytes
            stop = max(at + 1, int(np.searchsorted(off, off[at] + (1 << 23), side="right")) - 1)
            data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[off[at]:off[stop]]
            word = ~blank[data]
            start = word.copy()
            start[1:] &= ~word[:-1]
            heads = off[at:stop] - off[at]
            heads = heads[heads < len(data)]
            start[heads] = word[heads]
            total = np.zeros(len(data) + 1, dtype=np.int64)
            np.cumsum(start, out=total[1:])
            out[at:stop] = total[off[at + 1:stop + 1] - off[at]] - total[off[at:stop] - off[at]]
            at = stop
        yield pa.array(out)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0, cap: int = CAP) -> DataFrame:
    """From (source, source_size): adds target, the words to take.

    Sources, by code point and null last, weigh ``weights`` in turn and share
    ``share`` of all words; a target stops at ``cap`` times its source's size
    and the excess is shared again by weight until none is above.  That ends
    where every target is min(cap x size, level x weight) for one level: with
    sources by ascending cap x size / weight, the level is reached at the
    first source that it doesn't fill.  One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn.cast("int")))
    w = w.withColumn("limit", F.col("source_size") * float(cap)).withColumn("full_at", F.col("limit") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    w = (w.withColumn("filled", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("budget", F.sum("source_size").over(every) * share)
         .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("open")))
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every)   # later ones give lower levels
    return (w.withColumn("all", level).withColumn("target", F.when(F.col("all").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("all") * F.col("weight"))))
            .select("source", "source_size", "target"))


def keys(quality: Column, *identity: Column, seed: int = 17) -> Column:
    """Exponential keys of rate ``quality``, the same in every run."""
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11) + 0.5) / float(1 << 53)
    return -F.log(unit) / F.greatest(quality, F.lit(1e-6))


def _select(rows: DataFrame, budgets: DataFrame, nearest: bool) -> DataFrame:
    """Of (row, s, size, key), the rows (row, s, size) that prefix sums by
    ascending key take from each s up to its budget; with ``nearest`` also the
    row at the budget's end if that comes nearer.

    Every source is dealt to slots between quantiles of its keys.  Slots below
    the budget's end are taken whole; the one that holds it is dealt again,
    until it has END_ROWS at most and is summed row by row (or until its rows
    share one key: rows alike)."""
    shares = F.array(*[F.lit(i / SLOTS) for i in range(1, SLOTS)])
    part, taken, held = rows.join(budgets, "s").withColumn("below", F.lit(0.0)), None, None
    while True:
        most = part.groupBy("s").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        if most <= END_ROWS or most == held:
            break
        held = most
        # tables of their own, so that the planner knows their bytes: a row per source, and one per source and slot
        cuts = stored(part.groupBy("s").agg(F.percentile_approx("key", shares, 20_000).alias("cuts")), "mix_cuts")
        dealt = stored(part.join(cuts, "s").withColumn("slot", F.expr("size(filter(cuts, c -> c < key))")).drop("cuts"), "mix_slots")
        sums = dealt.groupBy("s", "slot").agg(F.sum("size").alias("words"), F.first("below").alias("base"))
        run = Window.partitionBy("s").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)    # at most SLOTS rows of a source
        sums = stored(sums.select("s", "slot", "words", (F.col("base") + F.coalesce(F.sum("words").over(run), F.lit(0))).alias("start")), "mix_sums")
        dealt = dealt.drop("below").join(sums, ["s", "slot"]).where(F.col("start") < F.col("budget"))
        whole = F.col("start") + F.col("words") <= F.col("budget")
        kept = dealt.where(whole).select("row", "s", "size")
        taken = kept if taken is None else taken.unionByName(kept)
        part = stored(dealt.where(~whole).select("row", "s", "size", "key", "budget", F.col("start").alias("below")), "mix_ends")
    order = Window.partitionBy("s").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    end = (part.withColumn("sum", F.col("below") + F.coalesce(F.sum("size").over(order), F.lit(0)))
           .where(F.col("sum") + F.col("size") * (0.5 if nearest else 1.0) <= F.col("budget")).select("row", "s", "size"))
    return end if taken is None else taken.unionByName(end)


def row_id(doc_id: Column, text: Column, source: Column) -> Column:
    """32 hex digits for the content of a row: rows of one doc_id with
    different texts or sources differ."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.substring(F.sha2(F.concat_ws("\u0000", part(doc_id), part(source), part(text)), 256), 1, 32)


def _name(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix(docs: DataFrame, quality: DataFrame | None = None, text: str = "text", source: str = "source",
        weights: tuple = WEIGHTS, share: float = 1.0, cap: int = CAP, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: row_id, nth (1, 2, ... among rows alike in
    doc_id, text and source), doc_id, size (words), source, source_size,
    target (of the source) and copies (how often the mix takes the row, up to
    ``cap``): the words taken are copies x size.

    ``quality`` (doc_id, weight) scales the keys; documents without a row in
    it count as 1, weights that aren't positive as almost 0, several weights of
    an id as their mean.  Null texts and such without words have size 0 and
    are taken with every whole epoch (once at least).  Null sources are a
    source of their own.  Other columns are ignored; the same rows give the
    same mix; no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"),
                       row_id(F.col("doc_id"), F.col(f"`{text}`"), F.col(f"`{source}`")).alias("row_id"))
    rows = rows.groupBy("row_id", "doc_id", "source", "size").agg(F.count("*").alias("repeats"))
    if quality is not None:
        q = quality.where("doc_id is not null").groupBy("doc_id").agg(F.avg("weight").alias("quality"))
        rows = rows.join(q, "doc_id", "left")
    else:
        rows = rows.withColumn("quality", F.lit(1.0))
    rows = (rows.withColumn("key", keys(F.coalesce("quality", F.lit(1.0)), F.col("row_id"), seed=seed)).withColumn("s", _name(F.col("source")))
            .withColumn("nth", F.explode(F.expr("sequence(1L, repeats)"))).drop("quality", "repeats"))
    rows = stored(rows, "mix_rows")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    plan = (plan.withColumn("s", _name(F.col("source"))).drop("source")
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-12), F.lit(cap))).otherwise(F.lit(1)))
            .withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))))
    plan = stored(plan, "mix_plan")
    row = F.struct("row_id", "nth").alias("row")
    left = rows.where("size > 0").select("s", "size", "key", row)
    open_ = plan.where("rest >= 1").select("s", F.col("rest").alias("budget"))
    taken = None
    for i in range(ROUNDS):
        picked = stored(_select(left, open_, nearest=i == ROUNDS - 1), "mix_taken")
        taken = picked if taken is None else taken.unionByName(picked)
        got = picked.groupBy("s").agg(F.sum("size").alias("got"))
        open_ = stored(open_.join(got, "s", "left").select("s", (F.col("budget") - F.coalesce("got", F.lit(0))).alias("budget")).where("budget >= 1"), "mix_open")
        size = "size / 2 <= budget" if i == ROUNDS - 2 else "size <= budget"
        left = left.join(picked.select("row"), "row", "left_anti").join(open_, "s").where(size).drop("budget")
    extra = taken.select("row.row_id", "row.nth", F.lit(1).alias("extra"))
    return (rows.join(extra, ["row_id", "nth"], "left").join(plan.select("s", "source_size", "target", "epochs"), "s")
            .select("row_id", "nth", "doc_id", "size", "source", "source_size", "target",
                    (F.col("epochs") + F.coalesce("extra", F.lit(0))).cast("long").alias("copies")))


def repeat(docs: DataFrame, mixed: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mixed`` (of
    the same rows) takes it.  Other columns pass through (those that start
    with ``__`` are reserved)."""
    alike = mixed.groupBy(F.col("row_id").alias("__row")).agg(F.sum("copies").alias("__all"), F.count("*").alias("__alike"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*names, row_id(F.col("doc_id"), F.col(f"`{text}`"), F.col(f"`{source}`")).alias("__row"))
    # rows alike are the same: deal their copies out evenly, the rest to the first
    rows = rows.join(alike.where("__alike = 1"), "__row").unionByName(
        rows.join(alike.where("__alike > 1"), "__row").dropDuplicates(["__row"]))
    return rows.withColumn("__i", F.explode(F.expr("sequence(1L, greatest(__all, 1L))"))).where("__all > 0").select(*names)
