"""Merkle manifest of a dataset: a hash tree whose upper levels are built by a butterfly exchange."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

PROOF = "array<struct<left:string,right:string>>"


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as `-` if null, else its length in UTF-8 bytes, `:`, and itself."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def proof_text(proof: Column) -> Column:
    """The siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to; a row is as the manifest has it if it is the root."""
    return F.aggregate(proof, leaf, lambda now, p: F.sha2(F.concat(p["left"], now, p["right"]), 256))


def manifest(
    documents: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    carry: Mapping[str, Column] | None = None,
    fanout: int = 16,
    block_levels: int = 3,
) -> DataFrame:
    """Every row's leaf with its way to the root: `doc_id`, `source`, `place`, `leaf`, `proof`,
    `subroot`, `root`, and what `carry` names, computed from the row.

    Leaves are digests of `columns`. Those of a source, by id, form a tree: while there is more than
    one node, every `fanout` of them in turn (the last run: fewer, even one) become the digest of
    their digests. What is left is the source's subroot; the subroots, by source, form a tree in the
    same way. `proof` has for each level, from the leaf to the root, the siblings left and right of
    the way, concatenated.

    Blocks of `fanout ** block_levels` leaves of one source are aligned to the tree. Each hashes its
    own leaves to one node. From there the blocks swap nodes in rounds: the members of up to
    `fanout` neighbouring subtrees send each other their subtree's node, each to those with its own
    number in the other subtree, and all hash the common parent. So a block hears from each
    neighbour once a round, ends with the whole upper part of its proofs and the root, and nothing
    has to be passed down. A block then gives its leaves their proofs in one further pass.

    Only ids, sources and digests are shuffled. The sort spreads a source that holds most rows over
    all partitions, and every later group is at most a block or a run. Null sources are a source of
    their own, the first; null ids come first in their source. Equal ids are put in order of their
    leaves, so equal rows are neighbours and each has a place. Null and empty texts give different
    leaves. A source of one row has its leaf as subroot, and a single source its subroot as root. An
    empty table gives no rows. Columns not named are not read.
    """
    if fanout < 2 or block_levels < 0:
        raise ValueError("a tree needs a fanout of two or more, and blocks no fewer than 0 levels")
    carry = dict(carry or {})
    if taken := {"doc_id", "source", "place", "leaf", "proof", "subroot", "root"}.intersection(carry):
        raise ValueError(f"carried columns may not be named {', '.join(sorted(taken))}")
    leaves = stage(
        documents.select(
            F.col("doc_id"),
            F.col("source"),
            leaf_digest(*[F.col(c) for c in columns]).alias("leaf"),
            F.struct(
                F.lit(0).alias("none"), *[c.alias(f"c{i}") for i, c in enumerate(carry.values())]
            ).alias("_carried"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    placed, sources = _placed(leaves, fanout**block_levels)
    spread = stage(placed)
    local = _levels_to(fanout, block_levels)
    nodes = spread.groupBy("_unit", "_block").applyInArrow(
        _block_node(fanout, local), "_unit bigint, _block bigint, _total bigint, node string"
    )
    ways = _exchange(stage(nodes), sources, fanout, block_levels)
    kinds = {f.name: f.dataType.simpleString() for f in spread.schema}
    handed_on = ("doc_id", "source", "place", "leaf", "_carried")
    schema = ", ".join(f"{c} {kinds[c]}" for c in handed_on)
    proved = (
        spread.groupBy("_unit", "_block")
        .cogroup(ways.groupBy("_unit", "_block"))
        .applyInArrow(_with_proofs(fanout, local), f"{schema}, proof {PROOF}, subroot string, root string")
    )
    return proved.select(
        "doc_id", "source", "place", "leaf", "proof", "subroot", "root",
        *[F.col(f"_carried.c{i}").alias(n) for i, n in enumerate(carry)],
    )


def _placed(leaves: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Leaves with their place in their source, their source's number and their block's.

    And the sources: `_unit` (number), `_blocks` and `_first` (number of the first block of all).

    One sort by source and id; a leaf's place is its place in its partition plus the leaves of its
    source in earlier ones. Only windows over partitions, and over the sources that begin in one
    partition, are left.
    """
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf", "_row"]
    # The number that Spark gives a row of the sorted table is its partition and its place there.
    row = stage(leaves.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).drop("_row"))
    row = row.withColumns(
        {
            "_part": F.shiftright("_at", 33),
            # A null source is a key like any other.
            "_none": F.col("source").isNull(),
            "_name": F.coalesce(F.col("source").cast("string"), F.lit("")),
        }
    )
    key = ["_none", "_name"]
    counts = stage(row.groupBy("_part", *key).agg(F.count("*").alias("_n"), F.min("_at").alias("_low")))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))

    totals = counts.groupBy(*key).agg(
        F.sum("_n").alias("_total"), F.min(F.struct("_part", "_low")).alias("_begin")
    ).select(*key, "_total", F.ceil(F.col("_total") / block).alias("_blocks"), "_begin.*")
    # Rows here are partitions, and then the sources that begin in one of them.
    begun = totals.groupBy("_part").agg(F.count("*").alias("_u"), F.sum("_blocks").alias("_b"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select(
        "_part",
        F.coalesce(F.sum("_u").over(before), F.lit(0)).alias("_u"),
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b"),
    )
    here = Window.partitionBy("_part").orderBy("_low")
    sources = stage(
        totals.join(begun, "_part").select(
            *key,
            "_total",
            "_blocks",
            (F.col("_u") + F.row_number().over(here) - 1).alias("_unit"),
            (F.col("_b") + F.sum("_blocks").over(here) - F.col("_blocks")).alias("_first"),
        )
    )
    runs = stage(
        runs.join(sources.select(*key, "_unit", "_total"), key).drop("_n")
    )
    at = F.col("_at") - F.col("_low") + F.col("_ahead")
    placed = row.join(runs, ["_part", *key]).select(
        "doc_id", "source", "leaf", "_carried", "_unit", "_total", at.cast("long").alias("place")
    )
    placed = placed.withColumn("_block", F.floor(F.col("place") / block))
    return placed, sources.select("_unit", "_blocks", "_first")


def _levels_to(fanout: int, most: int):
    """How many levels a block hashes by itself, in a source of so many leaves."""

    def levels(total: int) -> int:
        n = 0
        while n < most and fanout**n < total:
            n += 1
        return n

    return levels


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(leaves: list[str], fanout: int, levels: int) -> list[list[str]]:
    """The nodes of each level of a block, the leaves first."""
    rows = [leaves]
    for _ in range(levels):
        below = rows[-1]
        rows.append([_hash("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return rows


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("place")


def _block_node(fanout: int, levels):
    def node(table: pa.Table) -> pa.Table:
        total = table["_total"][0].as_py()
        leaves = _in_order(table)["leaf"].to_pylist()
        top = _tree(leaves, fanout, levels(total))[-1]
        return pa.table(
            {
                "_unit": table["_unit"].slice(0, 1),
                "_block": table["_block"].slice(0, 1),
                "_total": table["_total"].slice(0, 1),
                "node": [top[0]],
            }
        )

    return node


def _exchange(blocks: DataFrame, sources: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """The upper part of every block's proofs: `_unit`, `_block`, `upper`, `subroot`, `root`.

    The blocks number `_at` in the order of sources. A subtree is a range of them: within a source
    by place, above by source. Its extent is known by arithmetic below the subroots, and from a
    table of sources above.
    """
    state = stage(
        blocks.join(sources, "_unit").select(
            "_unit",
            "_block",
            (F.col("_first") + F.col("_block")).alias("_at"),
            "_first",
            "_blocks",
            "node",
            F.array().cast(PROOF).alias("upper"),
        )
    )
    width = 1
    most = state.agg(F.max("_blocks")).first()[0] or 0
    while width < most:
        own = F.floor(F.col("_block") / width)
        group = F.floor(own / fanout) * fanout
        starts = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda i: (group + i) * width),
            lambda s: s < F.col("_blocks"),
        )
        run = F.transform(
            starts,
            lambda s: F.struct(
                (F.col("_first") + s).alias("first"),
                F.least(F.lit(width).cast("long"), F.col("_blocks") - s).alias("size"),
            ),
        )
        busy = F.col("_blocks") > width
        state = _swap(state, busy, run, (own - group).cast("int"))
        width *= fanout

    state = state.withColumn("subroot", F.col("node"))
    units = stage(
        sources.select("_unit", F.struct(F.col("_first").alias("first"), F.col("_blocks").alias("size")).alias("extent"))
    )
    n_units = units.count()
    width = 1
    while n_units > 1:
        # The extents of the subtrees of each run; one row for `fanout` subtrees.
        runs = units.groupBy(F.floor(F.col("_unit") / fanout).alias("_run")).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_unit", "extent"))), lambda u: u["extent"]
            ).alias("_extents")
        )
        runs = stage(runs)
        state = state.withColumn("_run", F.floor(F.col("_unit") / (width * fanout))).join(runs, "_run")
        nth = (F.floor(F.col("_unit") / width) % fanout).cast("int")
        state = _swap(state, F.lit(True), F.col("_extents"), nth, "subroot")
        units = stage(
            runs.select(
                F.col("_run").alias("_unit"),
                F.struct(
                    F.get("_extents", F.lit(0))["first"].alias("first"),
                    F.aggregate(
                        "_extents", F.lit(0).cast("long"), lambda n, e: n + e["size"]
                    ).alias("size"),
                ).alias("extent"),
            )
        )
        n_units = units.count()
        width *= fanout
    return state.select("_unit", "_block", "upper", "subroot", F.col("node").alias("root"))


def _swap(state: DataFrame, busy: Column, run: Column, nth: Column, *more: str) -> DataFrame:
    """One round: blocks send their node to the neighbouring subtrees and hash what they receive.

    `run` holds the extents of the subtrees that share a parent, of which the block's is the `nth`.
    A member of a subtree of `z` blocks writes to every member of another whose number there is its
    own modulo `z`; so each block gets one message from each subtree, its own included. Where
    subtrees are of one size that is one message to each; a shorter last one serves the others by
    more. Blocks that are not `busy` are done and keep their node.
    """
    ready = state.select(
        "_unit", "_block", "_at", "_first", "_blocks", "node", "upper", *more,
        busy.alias("_busy"), run.alias("_run"), nth.alias("_nth"),
    )
    mine = F.get("_run", F.col("_nth"))
    number = F.col("_at") - mine["first"]

    def to(extent: Column) -> Column:
        last = extent["first"] + extent["size"] - 1
        return F.when(
            number < extent["size"], F.sequence(extent["first"] + number, last, mine["size"])
        ).otherwise(F.array().cast("array<bigint>"))

    letters = ready.where("_busy").select(
        F.explode(F.flatten(F.transform("_run", to))).alias("_at"), F.struct("_nth", "node").alias("m")
    )
    heard = letters.groupBy("_at").agg(
        F.transform(F.array_sort(F.collect_list("m")), lambda m: m["node"]).alias("_heard")
    )
    joined = ready.drop("_run").join(heard, "_at", "left")
    left = F.array_join(F.slice("_heard", F.lit(1), F.col("_nth")), "")
    right = F.array_join(F.slice("_heard", F.col("_nth") + 2, F.size("_heard")), "")
    level = F.array(F.struct(left.alias("left"), right.alias("right")))
    parent = F.sha2(F.array_join("_heard", ""), 256)
    return stage(
        joined.select(
            "_unit", "_block", "_at", "_first", "_blocks", *more,
            F.when(F.col("_busy"), parent).otherwise(F.col("node")).alias("node"),
            F.when(F.col("_busy"), F.concat("upper", level)).otherwise(F.col("upper")).alias("upper"),
        )
    )


def _siblings(below: list[str], fanout: int) -> tuple[list[str], list[str]]:
    """For each node of a level, what stands left and right of it in its run."""
    left, right = [], []
    for i in range(len(below)):
        first = i - i % fanout
        left.append("".join(below[first:i]))
        right.append("".join(below[i + 1 : first + fanout]))
    return left, right


def _with_proofs(fanout: int, levels):
    def prove(table: pa.Table, way: pa.Table) -> pa.Table:
        table = _in_order(table)
        n, depth = len(table), levels(table["_total"][0].as_py())
        (found,) = way.to_pylist()
        rows = _tree(table["leaf"].to_pylist(), fanout, depth)
        lefts, rights, places = [], [], []
        for k in range(depth):
            left, right = _siblings(rows[k], fanout)
            places.append(len(lefts) + np.arange(n) // fanout**k)
            lefts += left
            rights += right
        for step in found["upper"]:
            places.append(np.full(n, len(lefts)))
            lefts.append(step["left"])
            rights.append(step["right"])
        if places:
            pick = pa.array(np.stack(places, axis=1).ravel())
            steps = pa.StructArray.from_arrays(
                [pa.array(lefts, pa.string()).take(pick), pa.array(rights, pa.string()).take(pick)],
                ["left", "right"],
            )
        else:
            kind = pa.struct([("left", pa.string()), ("right", pa.string())])
            steps = pa.array([], kind)
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(places))
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "source": table["source"],
                "place": table["place"],
                "leaf": table["leaf"],
                "_carried": table["_carried"],
                "proof": pa.ListArray.from_arrays(ends, steps),
                "subroot": pa.array([found["subroot"]] * n, pa.string()),
                "root": pa.array([found["root"]] * n, pa.string()),
            }
        )

    return prove
