"""Delete later copies of repeated line runs, with a suffix array over line ids. DataFrames only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import hide, stage, word_count

_FIRST = "_nulls_last, _doc, _row, _at"


def _suffixes(rows: DataFrame) -> DataFrame:
    """A row for each line: its suffix of the document's sequence of line ids."""
    split = rows.select(
        "_row",
        F.col("doc_id").isNull().alias("_nulls_last"),
        F.col("doc_id").alias("_doc"),
        F.posexplode(F.split("text", "\n", -1)).alias("_at", "_line"),
    )
    own = word_count(F.col("_line"))
    return split.select(
        "_row",
        "_nulls_last",
        "_doc",
        "_at",
        F.md5("_line").alias("_rank"),
        own.alias("_own"),
        own.alias("_words"),
    )


def _intervals(suffixes: DataFrame) -> DataFrame:
    """Suffixes that share their rank with others, and whether theirs occurs `_later` than elsewhere."""
    first = suffixes.groupBy("_rank").agg(
        F.count("*").alias("_n"), F.expr(f"min(struct({_FIRST}))").alias("_earliest")
    )
    shared = suffixes.join(first.where("_n > 1").drop("_n"), "_rank")
    return shared.withColumn("_later", F.expr(f"struct({_FIRST}) > _earliest")).drop("_earliest")


def repeated_runs(rows: DataFrame, copies: DataFrame, min_words: int = 8) -> DataFrame:
    """Line runs that occur earlier: `_row`, `_start`, `_end` (of maximal runs, end excluded).

    Prefix doubling: every line is a suffix of its document's sequence of line ids. In round `k`
    suffixes are ranked by their first `2^k` lines, where the rank is a digest made of the ranks of
    its two halves, so that equal ranks are the intervals of suffixes whose common prefix is that
    long. Only these intervals matter here, so no global order is kept. A suffix alone in its
    interval shares no longer prefix either and leaves; the others meet the one `2^k` lines on, for
    the next round, until no interval is shared.

    The longest common prefix of a suffix with any earlier one (by id, null last, then row, then
    line) lies between the largest power that occurs earlier and twice that. Where the powers alone
    do not settle which lines go, `_extended` finds it exactly. A run goes if it has `min_words`
    words or more as a whole.

    `rows` has `doc_id`, `text` and a number `_row`, which tells equal rows apart. `copies` holds the
    rows whose whole text occurs earlier; their lines are in the first copy too, so they are left
    out after the first round.
    """
    found, k = [], 0
    shared = stage(_intervals(_suffixes(rows)).join(copies.select("_row"), "_row", "left_anti"))
    while not shared.where("_later").isEmpty():
        found.append(shared.withColumn("_k", F.lit(k)))
        ahead = shared.select(
            "_row",
            (F.col("_at") - (1 << k)).alias("_at"),
            F.col("_rank").alias("_then"),
            F.col("_words").alias("_more"),
        )
        doubled = shared.join(ahead, ["_row", "_at"]).select(
            "_row",
            "_nulls_last",
            "_doc",
            "_at",
            F.md5(F.concat("_rank", "_then")).alias("_rank"),
            "_own",
            (F.col("_words") + F.col("_more")).alias("_words"),
        )
        shared, k = stage(_intervals(doubled)), k + 1
    if not found:
        return rows.sparkSession.createDataFrame([], "_row bigint, _start int, _end int")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return _merged(_settled(every, k, min_words))


def _settled(every: DataFrame, rounds: int, min_words: int) -> DataFrame:
    """Windows `_row`, `_start`, `_end` that go; together they are the repeated runs."""
    later = every.where("_later")
    largest = later.groupBy("_row", "_at").agg(
        F.max(F.struct("_k", "_words", "_rank", "_own", "_nulls_last", "_doc")).alias("_l")
    )
    length = F.expr("shiftleft(1, _k)")
    windows = stage(
        largest.select("_row", "_at", "_l.*").withColumn("_end", (F.col("_at") + length).cast("int"))
    )
    # Every line of a repeated run is repeated itself, so these rows are the lines in question.
    so_far = Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    good = F.when(F.col("_words") >= min_words, F.col("_end"))
    chained = windows.withColumns(
        {
            "_covered": F.coalesce(F.max(good).over(so_far) > F.col("_at"), F.lit(False)),
            "_new": (F.col("_at") > F.coalesce(F.max("_end").over(before), F.lit(-1))).cast("int"),
            "_upto": F.sum("_own").over(so_far),
        }
    ).withColumn("_chain", F.sum("_new").over(so_far))
    # A chain of windows that overlap or adjoin holds all that its lines can be part of.
    open_chains = (
        chained.groupBy("_row", "_chain")
        .agg(F.sum("_own").alias("_all"), F.min("_covered").alias("_settled"))
        .where(~F.col("_settled") & (F.col("_all") >= min_words))
        .select("_row", "_chain")
    )
    unsettled = stage(chained.join(open_chains, ["_row", "_chain"]))
    sure = windows.where(F.col("_words") >= min_words).select(
        "_row", F.col("_at").alias("_start"), "_end"
    )
    if unsettled.isEmpty():
        return sure
    reached = _extended(unsettled.where("_k > 0"), every, rounds)
    last = unsettled.select(
        "_row", (F.col("_at") + 1).alias("_end"), F.col("_upto").alias("_through")
    )
    longer = reached.join(last, ["_row", "_end"]).where(
        F.col("_through") - F.col("_upto") + F.col("_own") >= min_words
    )
    return sure.unionByName(longer.select("_row", F.col("_at").alias("_start"), "_end"))


def _extended(asking: DataFrame, every: DataFrame, rounds: int) -> DataFrame:
    """The rows with `_end` where their longest common prefix with an earlier suffix ends.

    A prefix of `2^k + m` lines, `m < 2^k`, is told by its first `2^k` lines and by the `2^k` lines
    from line `m` on. So `m` is found by halving: each suffix asks for one `m` after the other, and
    the members of its interval answer for just those that any of them asks, with the earliest of
    them that has the same lines from there on. Members are grouped by interval, `m` and lines, of
    which minima are taken before the shuffle.
    """
    lines = every.select("_k", "_row", "_at", "_rank")
    ahead = lines.select("_k", "_row", F.col("_at").alias("_from"), F.col("_rank").alias("_then"))
    place = F.struct(*[F.col(c) for c in ("_nulls_last", "_doc", "_row", "_at")])
    members = every.select("_k", "_rank", "_row", "_at", place.alias("_place"))
    state = asking.select(
        "_row", "_at", "_k", "_rank", "_own", "_upto", place.alias("_mine"), F.lit(0).alias("_m")
    )
    for j in range(rounds - 2, -1, -1):
        state = state.withColumn("_t", F.when(F.col("_k") > j, F.col("_m") + (1 << j)))
        asked = state.where(F.col("_t").isNotNull()).withColumn("_from", F.col("_at") + F.col("_t"))
        asked = stage(asked.join(ahead, ["_k", "_row", "_from"]).drop("_from"))
        wanted = asked.select("_k", "_rank", "_t").distinct()
        answers = members.join(wanted, ["_k", "_rank"]).withColumn("_from", F.col("_at") + F.col("_t"))
        earliest = (
            answers.join(ahead, ["_k", "_row", "_from"])
            .groupBy("_k", "_rank", "_t", "_then")
            .agg(F.min("_place").alias("_earliest"))
        )
        yes = asked.join(earliest, ["_k", "_rank", "_t", "_then"]).where("_mine > _earliest")
        yes = yes.select("_row", "_at", F.lit(1 << j).alias("_step"))
        state = stage(
            state.join(yes, ["_row", "_at"], "left")
            .withColumn("_m", F.col("_m") + F.coalesce("_step", F.lit(0)))
            .drop("_t", "_step")
        )
    end = F.col("_at") + F.expr("shiftleft(1, _k)") + F.col("_m")
    return state.select("_row", "_at", "_own", "_upto", end.cast("int").alias("_end"))


def _merged(windows: DataFrame) -> DataFrame:
    in_order = Window.partitionBy("_row").orderBy("_start", "_end")
    before = F.max("_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opened = windows.withColumn("_new", (F.col("_start") > F.coalesce(before, F.lit(-1))).cast("int"))
    return (
        opened.withColumn("_run", F.sum("_new").over(in_order))
        .groupBy("_row", "_run")
        .agg(F.min("_start").alias("_start"), F.max("_end").alias("_end"))
        .drop("_run")
    )


def _later_copies(rows: DataFrame) -> DataFrame:
    """Rows whose whole text is that of an earlier row: `_row`, `_lines`, `_words`."""
    text = F.col("text")
    marked = stage(
        rows.where(text.isNotNull()).select(
            "_row",
            F.sha2(text, 256).alias("_digest"),
            F.struct(F.col("doc_id").isNull(), "doc_id", "_row").alias("_place"),
            F.size(F.split(text, "\n", -1)).alias("_lines"),
            word_count(text).alias("_words"),
        )
    )
    first = marked.groupBy("_digest").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    first = first.where("_n > 1").drop("_n")
    again = marked.join(first, "_digest").where("_place > _first")
    return stage(again.select("_row", "_lines", "_words"))


def without_runs(lines: Column, runs: Column) -> Column:
    """Text of the lines less the runs, a sorted array of structs `s`, `e` (end excluded)."""
    starts = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["e"]))
    ends = F.concat(F.transform(runs, lambda r: r["s"]), F.array(F.size(lines)))
    gaps = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    gaps = F.filter(gaps, lambda g: g["e"] > g["s"])
    parts = F.transform(
        gaps, lambda g: F.array_join(F.slice(lines, g["s"] + 1, g["e"] - g["s"]), "\n")
    )
    return F.array_join(parts, "\n")


def dedup_lines(documents: DataFrame, min_words: int = 8) -> DataFrame:
    """Documents with the later copies of repeated line runs deleted from `text`.

    All rows and columns stay; `deleted_runs` is added (or replaced), an array of structs `s`, `e`:
    the deleted runs by line number from 0, end excluded. Text that loses all lines becomes empty.
    Null text has no lines and stays null; empty text is one empty line, which has too few words to
    go. A run of lines goes if it occurs earlier as it is, is not part of a longer one that does, and
    has `min_words` words or more. The first copy is the one in the smallest `doc_id` (null last), and among rows of one id or
    equal rows in any one of them; copies inside one document count, and may overlap. Lines are cut
    at `\\n` only and must be equal to the byte. Very common lines are one rank like others: counts
    and first places are aggregated before the shuffle, and the join that brings them back can be
    split by Spark. Later copies of whole texts, whose one run is the text, are told by digest. An
    empty table gives none.
    """
    carried, restored = hide(documents, ("doc_id", "text"), without=("deleted_runs",))
    rows = stage(documents.select(*carried, F.monotonically_increasing_id().alias("_row")))
    copies = _later_copies(rows)
    whole = copies.where(F.col("_words") >= min_words).select(
        "_row", F.lit(0).alias("_start"), F.col("_lines").alias("_end")
    )
    runs = repeated_runs(rows, copies, min_words).unionByName(whole)
    per_row = runs.groupBy("_row").agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("_start").alias("s"), F.col("_end").alias("e")))
        ).alias("deleted_runs")
    )
    joined = rows.join(per_row, "_row", "left")
    hit = F.col("deleted_runs").isNotNull()
    joined = joined.withColumn("_lines", F.when(hit, F.split("text", "\n", -1)))
    kept = F.when(hit, without_runs(F.col("_lines"), F.col("deleted_runs"))).otherwise(F.col("text"))
    none = F.array().cast("array<struct<s:int,e:int>>")
    restored["text"] = kept.alias("text")
    return joined.select(
        *restored.values(), F.coalesce("deleted_runs", none).alias("deleted_runs")
    )
