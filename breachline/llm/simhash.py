"""Near-duplicates by SimHash fingerprints, found with multi-index hashing."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, hide, stage

_BITS = 64
#: Bytes of a text that are hashed at a time, to bound memory.
_SLICE = 1 << 20
#: Up to this many comparisons a bucket is compared pair by pair; a larger one is searched.
_FEW = 256
#: Rows of a bucket that one task compares with as many others.
BLOCK = 4096


def fingerprint_of(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text, as a signed 64-bit number; see `fingerprint`."""
    import xxhash

    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(_BITS, np.int64), 0
    carried: list[bytes] = []
    for words in _word_slices(text):
        words = carried + words
        if len(words) >= shingle:
            grams = zip(*(words[i:] for i in range(shingle)))
            hashes = np.array([digest(g, seed) for g in map(b" ".join, grams)], "<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carried = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not total and carried:
        value = digest(b" ".join(carried), seed)
    else:
        value = int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")
    return value - (1 << _BITS) if value >> (_BITS - 1) else value


def _word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased in A-Z, some at a time; none is cut."""
    raw = (text or "").encode("utf-8", "replace").lower()
    if len(raw) <= _SLICE:
        yield raw.split()
        return
    start = 0
    while start < len(raw):
        end = start + _SLICE
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        yield raw[start:end].split()
        start = end


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """SimHash of a text column, a bigint.

    Words are split at ASCII white space and lower-cased in A-Z; each run of `shingle` words, joined
    by a space, votes with the bits of its XXH64, repeats included; a bit is set if over half of the
    votes have it. A shorter text is one run. A text without words, or null, has fingerprint zero.
    """

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint_of(t, shingle, seed) for t in batch], dtype="int64")

    return of(text)


def probes(distance: int, segments: int) -> list[tuple[int, int, int, int]]:
    """What to look up for a fingerprint: `(segment, shift, mask, flip)`.

    If two fingerprints differ in at most `distance` bits, and radii that add up to
    `distance - segments + 1` are dealt to the segments, then in one segment they differ by at most
    its radius: otherwise they would differ in one bit more per segment. So each segment is
    enumerated up to its radius only; `flip` is what changes, and 0 for the segment itself.
    """
    spare = distance - segments + 1
    if not 2 <= segments <= distance + 1:
        raise ValueError("there must be 2 to distance + 1 segments")
    out, shift = [], 0
    for s in range(segments):
        width = _BITS // segments + (s < _BITS % segments)
        radius = spare // segments + (s < spare % segments)
        flips = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]
        out += [(s, shift, (1 << width) - 1, f) for f in flips]
        shift += width
    return out


def links(fingerprints: DataFrame, distance: int = 4, segments: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges `a`, `b` that connect fingerprints as all pairs within `distance` bits would.

    `fingerprints` has distinct values in `fp`. Each is filed in the table under every segment, and
    looks up the values around its segments, of two that look for each other only the one with a
    zero in the lowest bit that differs. What meets in a bucket is compared in full. Of the pairs
    that pass only as many are given as connect them, so a dense group gives few edges.

    A bucket with many rows is dealt as blocks against blocks to many tasks. What a task holds is
    one such block and the rows compared with it. Nothing is skipped.
    """
    if block < 1:
        raise ValueError("a block must hold a row")
    plan = F.array(
        *[
            F.struct(
                F.lit(s).alias("s"),
                F.lit(shift).alias("shift"),
                F.lit(mask).cast("long").alias("mask"),
                F.lit(flip).cast("long").alias("flip"),
                F.lit(flip & -flip).cast("long").alias("low"),
            )
            for s, shift, mask, flip in probes(distance, segments)
        ]
    )
    seen = fingerprints.select("fp", F.explode(plan).alias("p"))
    part = F.expr("shiftrightunsigned(fp, p.shift) & p.mask")
    seen = seen.where(part.bitwiseAND(F.col("p.low")) == 0).select(
        "fp",
        F.col("p.s").alias("seg"),
        part.bitwiseXOR(F.col("p.flip")).alias("value"),
        (F.col("p.flip") != 0).alias("probe"),
    )
    large = (
        seen.groupBy("seg", "value")
        .agg(F.count("*").alias("n"), F.min("probe").alias("no_table"))
        .where((F.col("n") > block) & ~F.col("no_table"))
        .select("seg", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    dealt = seen.join(large, ["seg", "value"], "left").withColumns(
        {"blocks": F.coalesce("blocks", F.lit(1))}
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # A cell (i, j) compares the table's block i with block j. A table row stands in its own block's
    # cells, and is compared as a probe with the blocks before it; in (i, i) with the rows of i.
    as_table = F.transform(every, lambda j: F.struct(mine.alias("i"), j.alias("j"), F.lit(False).alias("probe")))
    as_probe = F.transform(every, lambda i: F.struct(i.alias("i"), mine.alias("j"), F.lit(True).alias("probe")))
    cells = F.when(F.col("probe"), as_probe).otherwise(
        F.concat(as_table, F.filter(as_probe, lambda c: c["i"] < c["j"]))
    )
    dealt = dealt.select("fp", "seg", "value", F.explode(cells).alias("c"))
    dealt = dealt.select("seg", "value", "c.i", "c.j", "c.probe", "fp")
    cell = ["seg", "value", "i", "j"]
    return (
        dealt.repartition(*cell)
        .sortWithinPartitions(*cell, "probe")
        .mapInArrow(lambda batches: _link(batches, distance), "a long, b long")
    )


def _link(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Edges of the cells of one partition, which come sorted, the table's rows first in each."""
    waiting: list[np.ndarray] = []

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        a, b = _compare(rows, distance)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(6)]
        waiting.append(np.stack(columns))
        now = waiting[-1]
        # Whole cells go on; the last may continue in the next batch.
        if (now[:4, -1] == waiting[0][:4, 0]).all():
            continue
        rows = np.concatenate(waiting, axis=1)
        last = int((rows[:4] == rows[:4, -1:]).all(axis=0).argmax())
        yield edges(rows[:, :last])
        waiting = [rows[:, last:]]
    if waiting:
        yield edges(np.concatenate(waiting, axis=1))


def _compare(rows: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    fp, probe = rows[5].view(np.uint64), rows[4].astype(bool)
    new = np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, fp.size))
    table = np.add.reduceat(~probe, start, dtype=np.int64)
    work = table * size
    few = (table > 0) & (size > 1) & (work <= _FEW)
    out = [_pairs(fp, start[few], size[few], table[few], distance)]
    for s, n, t in zip(start[(work > _FEW)], size[work > _FEW], table[work > _FEW]):
        out.append(_connected(fp[s : s + n], t, distance))
    a, b = np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])
    return a.view(np.int64), b.view(np.int64)


def _pairs(fp, start, size, table, distance):
    """All pairs within the distance, in small cells, each of a table row and a row after it."""
    cell = np.repeat(np.arange(start.size), table)
    left = np.arange(cell.size) - np.repeat(np.cumsum(table) - table, table)
    each = size[cell] - left - 1
    right = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    t = np.repeat(start[cell] + left, each)
    x = t + 1 + right
    near = np.bitwise_count(fp[t] ^ fp[x]) <= distance
    return fp[t[near]], fp[x[near]]


def _connected(fp: np.ndarray, table: int, distance: int):
    """Edges from each connected part of a large cell to the row it was first met at.

    Breadth first over the links: every row is compared once, with those that are not reached yet,
    a probe only with the table's among them.
    """
    free = np.arange(fp.size)
    a, b = [], []
    while free.size and free[0] < table:
        seed, free = free[0], free[1:]
        queue = deque([seed])
        while queue and free.size:
            row = queue.popleft()
            open_to = free if row < table else free[: np.searchsorted(free, table)]
            near = np.bitwise_count(fp[open_to] ^ fp[row]) <= distance
            if near.any():
                met = open_to[near]
                free = np.concatenate([open_to[~near], free[open_to.size :]])
                b.append(fp[met])
                a.append(np.full(met.size, fp[seed]))
                queue.extend(met)
    if not a:
        return fp[:0], fp[:0]
    return np.concatenate(a), np.concatenate(b)


def near_duplicates(
    documents: DataFrame,
    distance: int = 4,
    shingle: int = 4,
    segments: int = 3,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The `keep` columns of each document, with `fingerprint` and `group` (bigint).

    Two rows have the same group exactly if links of at most `distance` differing bits lead from one
    to the other; its number is the smallest fingerprint in it, signed. Other columns, of whatever
    name, are not read. Copies are folded before the search, so they cost one comparison together.
    Null and empty texts have fingerprint zero and so are one group. An empty table gives none.
    """
    marked = stage(
        documents.select(*keep, fingerprint(F.col("text"), shingle).alias("fingerprint"))
    )
    distinct = stage(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.lit(1).alias("_one")))
    joined = components(links(distinct.select("fp"), distance, segments))
    roots = joined.select(F.col("node").alias("fingerprint"), F.col("root").alias("group"))
    return marked.join(roots, "fingerprint", "left").select(
        *keep, "fingerprint", F.coalesce("group", "fingerprint").alias("group")
    )


def keep_first(documents: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """One document of each group, that with the smallest `doc_id`, in all its columns.

    A null id comes last. Of rows with equal ids one stays, so of equal rows one.
    """
    carried, restored = hide(documents, ("doc_id", "text"))
    rows = stage(documents.select(*carried, F.monotonically_increasing_id().alias("_row")))
    grouped = near_duplicates(rows, distance, shingle, keep=("_row", "doc_id"))
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    first = grouped.groupBy("group").agg(best["_row"].alias("_row")).select("_row")
    return rows.join(first, "_row", "left_semi").select(*restored.values())
