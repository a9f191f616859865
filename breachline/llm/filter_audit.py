"""Audit of filters that interact: what each removes in every order, from a sparse word matrix."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations
from math import factorial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .shared import stage

#: Filters of `audit`, by bit: under 200 words, under half of them distinct, over 2 % capitals, a
#: character of `#$%&*|`, a copy of a smaller id's text.
FILTERS = "ABCDE"

#: Size of the row groups that shards are staged in: a shard of the usual size, or some smaller ones.
GROUP_BYTES = 8 << 20


#: What a text has beside its words: name, type, and how it is taken from the UTF-8 bytes.
Measure = tuple[str, pa.DataType, Callable[[bytes], Any]]

_INNER = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(65, 91))


def _many_capitals(body: bytes) -> bool:
    capitals = len(body) - len(body.translate(None, _CAPITALS))
    return 100 * capitals > 2 * len(body.translate(None, _INNER))


def _has_signs(body: bytes) -> bool:
    return len(body) != len(body.translate(None, b"#$%&*|"))


_FLAGS: tuple[Measure, ...] = (
    ("c", pa.bool_(), _many_capitals),
    ("d", pa.bool_(), _has_signs),
    ("digest", pa.binary(), lambda body: hashlib.sha256(body).digest()),
)


def shards(
    rows: DataFrame, shard_bytes: int = 8 << 20, measures: Sequence[Measure] = ()
) -> DataFrame:
    """Cut rows into shards of a sparse document-term matrix, words numbered within the shard.

    One row per shard: `shard`; `rows`, an array of the columns of its documents other than `text`,
    and of the `measures` of their texts; `row_ends`, the number of entries up to each document's
    last (0 first); `columns`, the entries' word numbers; `counts`, how often the word occurs; and
    `words`, the shard's words by number. A row has one entry for each of its words. A shard holds
    whole documents of one partition, of at most `shard_bytes` of text or a single longer one; their
    texts are not held together. Words are the maximal runs of other than ASCII white space, as
    bytes, so case and accents tell them apart.
    """
    kept = [f for f in rows.schema if f.name != "text"]
    inner = [f"`{f.name}`:{f.dataType.simpleString()}" for f in kept]
    inner += [f"`{n}`:{from_arrow_type(kind).simpleString()}" for n, kind, _ in measures]
    schema = (
        f"shard bigint, rows array<struct<{','.join(inner)}>>, row_ends array<bigint>, "
        "columns array<int>, counts array<int>, words array<binary>"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition and a place in it: the same if a task runs again, as its input is.
        number = TaskContext.get().partitionId() << 33
        held = _Shard(measures)
        for batch in batches:
            texts = batch.column("text")
            rest = batch.drop_columns(["text"])
            first = 0
            for i in range(len(texts)):
                body = texts[i].as_buffer().to_pybytes()
                if held.bodies and held.size + len(body) > shard_bytes:
                    held.rest.append(rest.slice(first, i - first))
                    yield held.batch(number)
                    number, held, first = number + 1, _Shard(measures), i
                held.add(body)
            held.rest.append(rest.slice(first))
        if held.bodies:
            yield held.batch(number)

    text = F.coalesce("text", F.lit("")).alias("text")
    return rows.select(*[f.name for f in kept], text).mapInArrow(cut, schema)


class _Shard:
    """A shard in the making."""

    def __init__(self, measures: Sequence[Measure]):
        self.measures = measures
        self.measured: list[tuple] = []
        self.rest: list[pa.RecordBatch] = []
        self.numbers: dict[bytes, int] = {}
        self.columns: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.bodies = self.size = 0

    def add(self, body: bytes) -> None:
        # Splits at ASCII white space only, since these are bytes.
        numbers = self.numbers
        found = [numbers.setdefault(w, len(numbers)) for w in body.split()]
        column, count = np.unique(np.array(found, np.int32), return_counts=True)
        self.columns.append(column)
        self.counts.append(count.astype(np.int32))
        self.measured.append(tuple(take(body) for _, _, take in self.measures))
        self.bodies += 1
        self.size += len(body)

    def batch(self, number: int) -> pa.RecordBatch:
        rest = pa.Table.from_batches(self.rest).combine_chunks()
        arrays = [c.combine_chunks() for c in rest.columns]
        names = list(rest.column_names)
        for (name, kind, _), values in zip(self.measures, zip(*self.measured)):
            arrays.append(pa.array(values, kind))
            names.append(name)

        def whole(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        ends = np.cumsum([0, *map(len, self.columns)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                whole(pa.StructArray.from_arrays(arrays, names)),
                whole(pa.array(ends, pa.int64())),
                whole(pa.array(np.concatenate(self.columns))),
                whole(pa.array(np.concatenate(self.counts))),
                whole(pa.array(list(self.numbers), pa.binary())),
            ],
            ["shard", "rows", "row_ends", "columns", "counts", "words"],
        )


def _code(word: Column, bits: int) -> Column:
    return F.xxhash64(word).bitwiseAND((1 << bits) - 1)


def _coded(shards: DataFrame, bits: int) -> DataFrame:
    """`word`, `_code` and `n_shards`; all words of one code lie in one partition."""
    words = shards.select(F.explode("words").alias("word"))
    # One row per word and shard goes to its code's partition, so a word of all documents is no hot
    # key, and one shuffle serves the words and their codes.
    dealt = words.withColumn("_code", _code(F.col("word"), bits)).repartition("_code")
    return dealt.groupBy("_code", "word").agg(F.count("*").alias("n_shards"))


def clashes(shards: DataFrame, bits: int = 63) -> DataFrame:
    """Words whose number is not their code, as another word has it: `word` and `column`.

    The first word of a code, by its bytes, has the code; others get negative numbers. There are
    next to none, but the numbers are right however many there are.
    """
    coded = _coded(shards, bits)
    shared = stage(
        coded.groupBy("_code").agg(F.count("*").alias("_n")).where("_n > 1").select("_code")
    )
    # If no code is shared, all words would be shuffled again to find none.
    others = shared.join(_coded(shards.limit(0) if shared.isEmpty() else shards, bits), "_code")
    nth = F.row_number().over(Window.partitionBy("_code").orderBy("word"))
    others = others.withColumn("_nth", nth).where("_nth > 1")
    return stage(others.select("word", (-1 - F.monotonically_increasing_id()).alias("column")))


def dictionary(shards: DataFrame, clashing: DataFrame, bits: int = 63) -> DataFrame:
    """All words: `word`, its number `column` in the matrix, and `n_shards`, the shards that have it."""
    others = clashing.withColumnRenamed("column", "_other")
    return _coded(shards, bits).join(others, "word", "left").select(
        "word", F.coalesce("_other", "_code").alias("column"), "n_shards"
    )


def _numbered(shards: DataFrame, clashing: DataFrame, bits: int) -> DataFrame:
    """The shards with `_numbers`, those of their words, in place of the words.

    A word's number follows from the word, so shards are coded where they are; only those that hold
    clashing words look these up.
    """
    numbered = shards.withColumn("_numbers", F.transform("words", lambda w: _code(w, bits)))
    if not clashing.isEmpty():
        local = shards.select("shard", F.posexplode("words").alias("_local", "word"))
        other = local.join(clashing, "word").groupBy("shard").agg(
            F.map_from_entries(F.collect_list(F.struct("_local", "column"))).alias("_other")
        )
        corrected = F.transform(
            "_numbers", lambda n, i: F.coalesce(F.try_element_at("_other", i), n)
        )
        numbered = numbered.join(other, "shard", "left")
        numbered = numbered.withColumn(
            "_numbers", F.when(F.col("_other").isNull(), F.col("_numbers")).otherwise(corrected)
        ).drop("_other")
    return numbered.drop("words")


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each shard with the numbers of its entries' words."""
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1)
            local = row.column("columns")[0].values.to_numpy()
            yield row, row.column("_numbers")[0].values.to_numpy()[local]


def matrix(shards: DataFrame, clashing: DataFrame, bits: int = 63) -> DataFrame:
    """The shards with the numbers of the dictionary in `columns` (bigint), without `words`."""
    out = [f for f in shards.schema if f.name not in ("words", "columns")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", columns array<bigint>"

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, found in _rows_of(batches):
            columns = pa.ListArray.from_arrays(
                pa.array([0, len(found)], pa.int32()), pa.array(found, pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [*[row.column(f.name) for f in out], columns], [*[f.name for f in out], "columns"]
            )

    return _numbered(shards, clashing, bits).mapInArrow(renumber, schema)


def row_sums(shards: DataFrame, clashing: DataFrame, bits: int = 63) -> DataFrame:
    """The documents of the matrix, with `n_words` (row sum) and `n_distinct` (nonzero entries).

    Entries get their dictionary numbers in the same pass, so the matrix itself is not stored again.
    """
    inner = shards.schema["rows"].dataType.elementType
    schema = (
        ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner)
        + ", n_words bigint, n_distinct bigint"
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns in _rows_of(batches):
            ends = shard.column("row_ends")[0].values.to_numpy()
            counts = shard.column("counts")[0].values.to_numpy()
            upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            # Entries of one row and column count once.
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            order = np.lexsort((columns, row))
            row, columns = row[order], columns[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (columns[1:] != columns[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    *shard.column("rows")[0].values.flatten(),
                    pa.array(upto[ends[1:]] - upto[ends[:-1]], pa.int64()),
                    pa.array(np.bincount(row[new], minlength=len(ends) - 1), pa.int64()),
                ],
                [*[f.name for f in inner], "n_words", "n_distinct"],
            )

    return _numbered(shards, clashing, bits).mapInArrow(add, schema)


def failures(documents: DataFrame, shard_bytes: int = 8 << 20, bits: int = 63) -> DataFrame:
    """Which filters each document fails: `doc_id`, `source`, `n_words`, `n_distinct`, `mask`.

    `mask` has bit 0 for A (under 200 words), 1 for B (under half of the words distinct), 2 for C
    (over 2 % of the code points are `A-Z`), 3 for D (a character of `#$%&*|`) and 4 for E (the text
    of a smaller id, anywhere in the table). A and B come from the row sums and the nonzero entries
    of the matrix. Null texts are empty, and copies of empty ones; a null id fails E never, and makes
    no other fail it. Copies are found by digest of the text: first places are aggregated before the
    shuffle, and only texts that occur again are joined, which Spark splits where they are many.
    """
    # A task may make any number of shards, so they are not all one row group.
    texts = documents.select("doc_id", "source", "text")
    cut = stage(shards(texts, shard_bytes, _FLAGS), GROUP_BYTES)
    judged = stage(row_sums(cut, clashes(cut, bits), bits))
    again = (
        judged.groupBy("digest")
        .agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n"))
        .where("_n > 1 AND _least IS NOT NULL")
        .drop("_n")
    )
    joined = judged.join(stage(again), "digest", "left")
    fails = [
        F.col("n_words") < 200,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        F.col("c"),
        F.col("d"),
        F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False)),
    ]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return joined.select("doc_id", "source", "n_words", "n_distinct", mask.cast("int").alias("mask"))


def interactions(
    marked: DataFrame, names: Sequence[str] = tuple(FILTERS), part: str = "part"
) -> DataFrame:
    """What each filter removes in every order: one row per part, order and step, zeros included.

    `marked` has `part`, `mask` (bit `k` is set if the filter of the `k`-th name fails the document)
    and the booleans `good` and `toxic`. Counts of a part by mask say all there is to know, so
    documents are aggregated to at most `2 ** len(names)` rows a part before anything is gathered,
    and the orders are laid out over these. `shapley` is what the filter removes summed over all
    orders: a document that fails `m` filters is removed by each of them in one order of `m`.
    """
    n = len(names)
    by_mask = marked.groupBy(part, "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    counted = by_mask.groupBy(part).agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("_m"))
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, bit in enumerate(order):
            steps.append(("".join(names[b] for b in order), k + 1, before, 1 << bit))
            before |= 1 << bit
    steps = F.array(
        *[
            F.struct(F.lit(o).alias("o"), F.lit(k).alias("k"), F.lit(b).alias("b"), F.lit(f).alias("f"))
            for o, k, b, f in steps
        ]
    )
    laid = counted.select(F.col(part), "_m", F.explode(steps).alias("_s"))
    before, bit = F.col("_s.b"), F.col("_s.f")

    def total(chosen, what=lambda m: m["n"]) -> Column:
        return F.aggregate(
            "_m", F.lit(0).cast("long"), lambda t, m: t + F.when(chosen(m["mask"]), what(m)).otherwise(0)
        )

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def removed(mask: Column) -> Column:
        return fails(mask) & (mask.bitwiseAND(before) == 0)

    orders = factorial(n)
    return laid.select(
        part,
        F.col("_s.o").alias("filter_order"),
        F.col("_s.k").alias("step"),
        total(lambda mask: mask.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda mask: fails(mask) & (mask.bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda mask: mask == bit).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"),
        total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(
            fails, lambda m: F.try_divide(m["n"] * orders, F.bit_count(m["mask"])).cast("long")
        ).alias("shapley"),
    )


def audit(
    documents: DataFrame, labels: DataFrame, shard_bytes: int = 8 << 20, bits: int = 63
) -> DataFrame:
    """The interactions of the five filters over all documents, by source (null: empty `part`).

    `labels` has `doc_id`, `quality` and `toxic`; several rows of one id count as one, which is good
    or toxic if any of them is. Equal rows of documents count each. Null ids have no label. Columns
    not named are not read. An empty table gives no rows. Words are numbered by `bits` bits of their
    hash, and those that share them apart.
    """
    marked = failures(documents, shard_bytes, bits)
    known = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic")
    )
    joined = marked.join(known, "doc_id", "left").select(
        F.coalesce("source", F.lit("")).alias("part"),
        "mask",
        F.coalesce("_good", F.lit(False)).alias("good"),
        F.coalesce("_toxic", F.lit(False)).alias("toxic"),
    )
    return interactions(joined)
