"""Mix sources to target weights along a curriculum that changes over the training run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import hide, stage, word_count

#: Documents of a source are dealt to this many buckets (three hex digits), so that running totals
#: never need one task to hold a source.
_BUCKET_DIGITS = 3


def source_targets(
    sizes: DataFrame, weights: Sequence[float], total_share: float, most_repeats: float
) -> DataFrame:
    """Words each source should give: `source`, `source_size`, `source_no`, `target`.

    Sources, by code point with null last, weigh `weights` in turn, repeating, and share
    `total_share` of all words. No target exceeds `most_repeats` times its source; the excess goes
    to the others by weight until none is above. The level at which that ends has a closed form: in
    the order of cap over weight, a source is capped while its share of what is left would pass its
    cap. The windows here run over sources, of which there is one row each.
    """
    if not 0 <= total_share <= most_repeats:
        raise ValueError("the mix cannot exceed what the repeats allow")
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weigh = F.array(*[F.lit(float(w)) for w in weights])
    numbered = by_source.select(
        "source",
        "source_size",
        (F.row_number().over(in_order) - 1).alias("source_no"),
        (F.sum("source_size").over(everything) * F.lit(float(total_share))).alias("budget"),
    ).withColumn("weight", F.get(weigh, F.col("source_no") % len(weights)))
    capped = numbered.withColumn("cap", F.col("source_size") * F.lit(float(most_repeats)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levelled = capped.withColumn("level", left / F.sum("weight").over(onward))
    full = F.col("cap") <= F.col("level") * F.col("weight")
    level = F.min(F.when(~full, F.struct(F.col("cap") / F.col("weight"), "source_no", "level")))
    levelled = levelled.withColumn("final", level.over(everything)["level"])
    target = F.when(full, F.col("cap")).otherwise(F.col("final") * F.col("weight"))
    return levelled.select("source", "source_size", "source_no", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    total_share: float = 1.5,
    most_repeats: int = 2,
    schedules: Sequence[tuple[float, float]] = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0)),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Plan which words of each document are trained on, and when.

    One row per document: `doc_id`, `source`, `size` (its words), `source_size`, `target`, `taken`
    (words, repeats counted) and `passes`, an array of structs `words` and `position`, one for each
    time the document is read; a pass that takes nothing is left out. `carry` names further columns
    to keep, which are in a struct, `carried`, so that they clash with none; they take part in every
    shuffle, so they should be small. `in_training_order` brings whole documents in last.

    A source is laid out in the order of the MD5 of its ids, over and over, up to its target,
    rounded to a word. So whole documents are taken but for the one that the target cuts, of which
    the first words are taken. None is taken more than `most_repeats` times.

    `schedules` give each source, in turn, its relative weight at the start and the end of training,
    changing evenly between, and averaging one. A source's demand up to time `t` is the integral,
    `s t + (e - s) t^2 / 2`; solving it for the share of the target that comes before the middle of
    a pass gives the time at which the pass is due, its position from 0 to 1.

    Running totals add a prefix of bucket sums to a window inside one bucket of one source, so a
    source with a third of all rows is spread over thousands of groups. Documents without words, or
    with null text, have size 0 and are taken 0 times; a null source is a source of its own, and the
    last; null ids come first in it. Equal rows share one place in the order and count each. An
    empty table gives no rows. Only the id, the source, the text and `carry` are read.
    """
    if any(abs(a + b - 2) > 1e-9 or min(a, b) < 0 for a, b in schedules):
        raise ValueError("a schedule must not be negative and must average one")
    rows = documents.select(
        "doc_id",
        "source",
        # A null source is a key like any other.
        F.coalesce("source", F.lit("")).alias("_name"),
        F.col("source").isNull().alias("_none"),
        F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("0" * 32)).alias("_order"),
        word_count(F.col("text")).alias("size"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    ).withColumn("_bucket", F.substring("_order", 1, _BUCKET_DIGITS))
    rows = stage(rows)

    source, bucket = ["_none", "_name"], ["_none", "_name", "_bucket"]
    buckets = stage(rows.groupBy(*bucket).agg(F.sum("size").alias("_in")))
    named = buckets.withColumns(
        {"source": F.when(~F.col("_none"), F.col("_name")), "size": F.col("_in")}
    )
    targets = source_targets(named, weights, total_share, most_repeats).select(
        F.col("source").isNull().alias("_none"),
        F.coalesce("source", F.lit("")).alias("_name"),
        "source_size",
        "source_no",
        "target",
    )
    ahead = Window.partitionBy(*source).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn(
        "_ahead", F.coalesce(F.sum("_in").over(ahead), F.lit(0))
    ).join(targets, source)
    inside = (
        Window.partitionBy(*bucket)
        .orderBy("_order", F.col("doc_id").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.withColumn("_upto", F.sum("size").over(inside)).join(offsets, bucket)
    goal = F.floor(F.col("target") + 0.5)
    start = F.col("_ahead") + F.col("_upto") - F.col("size")
    early = F.array(*[F.lit(float(a)) for a, _ in schedules])
    late = F.array(*[F.lit(float(b)) for _, b in schedules])
    turn = F.col("source_no") % len(schedules)

    def one_pass(k: Column) -> Column:
        begin = k * F.col("source_size") + start
        words = F.greatest(F.lit(0), F.least(F.col("size"), goal - begin)).cast("long")
        share = F.try_divide(begin + words / F.lit(2.0), goal)
        s, e = F.get(early, turn), F.get(late, turn)
        due = F.lit(2.0) * share / (s + F.sqrt(s * s + F.lit(2.0) * (e - s) * share))
        return F.struct(words.alias("words"), due.alias("position"))

    passes = F.array(*[one_pass(F.lit(k)) for k in range(most_repeats)])
    planned = placed.withColumn("passes", F.filter(passes, lambda p: p["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return planned.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        "passes",
        *(["carried"] if carry else []),
    )


def training_order(plan: DataFrame) -> DataFrame:
    """One row per pass, as `pass_words` and `position`, range-sorted by the position."""
    passes = plan.withColumn("_pass", F.explode("passes")).drop("passes")
    due = passes.withColumns(
        {"pass_words": F.col("_pass.words"), "position": F.col("_pass.position")}
    )
    return due.drop("_pass").orderBy("position", "doc_id")


def in_training_order(documents: DataFrame, **settings) -> DataFrame:
    """Whole documents in the order of training, one row per pass, in all their columns.

    `size`, `pass_words` and `position` are added, or replace columns of these names; `settings` are
    those of `mix`. The plan is made on ids and sizes alone. Texts are shuffled twice: when they meet
    their passes, and for the sort; the table between is stored, so that the look at it which sets
    the ranges of the sort is a scan. A row number joins them, so repeated rows and null ids are
    right.
    """
    added = ("size", "pass_words", "position")
    carried, restored = hide(documents, ("doc_id", "source", "text"), without=added)
    rows = stage(documents.select(*carried, F.monotonically_increasing_id().alias("_row")))
    plan = mix(rows.select("doc_id", "source", "text", "_row"), carry=("_row",), **settings)
    passes = stage(plan.where(F.size("passes") > 0).select("carried._row", "size", "passes"))
    # A struct of its own, so that no document's column is taken for the plan's.
    met = F.struct("size", "passes").alias("_plan")
    joined = stage(rows.join(passes.select("_row", met), "_row").drop("_row"))
    due = joined.withColumn("_pass", F.explode("_plan.passes"))
    return due.orderBy(F.col("_pass.position"), "doc_id").select(
        *restored.values(),
        F.col("_plan.size").alias("size"),
        F.col("_pass.words").alias("pass_words"),
        F.col("_pass.position").alias("position"),
    )
