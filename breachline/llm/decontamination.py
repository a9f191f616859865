"""Find benchmark items in documents: q-gram counts in diagonal bands, then banded alignment."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import hide, kept_by_worker, stage

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_MAP_BITS = 24
#: Characters of a text that are searched at a time, to bound memory.
_SLICE = 1 << 20
#: Characters of items that one index holds, so what is broadcast is bounded; more items, more passes.
BLOCK_CHARS = 4 << 20


@dataclass(frozen=True)
class Budget:
    """Edits that are still a leak: `rate` of the item's length, or fewer in a short item.

    The q-gram lemma: a region within `k` edits of an item of `m` characters shares at least
    `m - q + 1 - k q` of its q-grams. `k` is the largest that leaves one at least, up to the rate.
    """

    q: int = 8
    rate: float = 0.1

    def edits(self, m: int) -> int:
        return min(int(m * self.rate), (m - self.q) // self.q)

    def shared(self, m: int) -> int:
        return m - self.q + 1 - self.edits(m) * self.q


def normal(text: str | None) -> str:
    """Lower case, with each run of white space as one space."""
    return " ".join((text or "").lower().split())


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: Sequence[tuple[object, str]], budget: Budget):
        self.budget = budget
        pairs = {(key, normal(text)) for key, text in items}
        chosen = sorted((p for p in pairs if len(p[1]) >= budget.q), key=lambda p: (str(p[0]), p[1]))
        self.keys, self.texts = [p[0] for p in chosen], [p[1] for p in chosen]
        size = np.array([len(t) for t in self.texts], np.int64)
        self.longest = int(size.max(initial=0))
        self.edits = np.array([budget.edits(m) for m in size.tolist()], np.int64)
        self.shared = np.array([budget.shared(m) for m in size.tolist()], np.int64)
        grams = [_grams(_codes(t), budget.q) for t in self.texts]
        each = [g.size for g in grams]
        hashes = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(hashes, kind="stable")
        self.gram, self.first = np.unique(hashes[order], return_index=True)
        self.last = np.append(self.first[1:], hashes.size)
        self.item = np.repeat(np.arange(len(grams)), each)[order]
        self.at = np.concatenate([*map(np.arange, each), np.empty(0, np.int64)])[order]
        self.map = np.zeros(1 << _MAP_BITS, bool)
        self.map[(self.gram >> np.uint64(64 - _MAP_BITS)).astype(np.int64)] = True

    def find(self, text: str | None) -> dict[object, int]:
        """The items within their budget somewhere in the text, with the fewest edits found."""
        found: dict[object, int] = {}
        if not self.texts or not text:
            return found
        whole = normal(text)
        overlap = self.longest + 2 * int(self.edits.max()) + self.budget.q
        for start in range(0, max(1, len(whole) - overlap), _SLICE):
            part = whole[start : start + _SLICE + overlap]
            for i, lo, hi in self._regions(part):
                key, edits = self.keys[i], int(self.edits[i])
                if found.get(key) == 0:
                    continue
                n = alignment(self.texts[i], part[max(0, lo) : hi], edits)
                if n is not None:
                    found[key] = min(n, found.get(key, n))
        return found

    def _regions(self, part: str) -> Iterator[tuple[int, int, int]]:
        """Item and region of every diagonal band with enough shared q-grams.

        All shared q-grams of a region within `k` edits lie on diagonals that are at most `k` apart.
        Bands are `2 (k + 1)` wide and begin `k + 1` apart, so that one of them holds them all.
        """
        gram = _grams(_codes(part), self.budget.q)
        at = np.flatnonzero(self.map[(gram >> np.uint64(64 - _MAP_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.gram, gram[at]), self.gram.size - 1)
        hit = self.gram[place] == gram[at]
        at, place = at[hit], place[hit]
        each = self.last[place] - self.first[place]
        if not each.size:
            return
        entry = np.arange(each.sum()) + np.repeat(self.first[place] - (np.cumsum(each) - each), each)
        item = self.item[entry]
        step = self.edits[item] + 1
        band = (np.repeat(at, each) - self.at[entry] + self.longest) // step
        bands = len(part) + 2 * self.longest + 2
        key = item * bands + band
        count_of, count = np.unique(np.concatenate([key, key - (band > 0)]), return_counts=True)
        which, band = count_of // bands, count_of % bands
        for i, b in zip(*(x[count >= self.shared[which]].tolist() for x in (which, band))):
            k = int(self.edits[i])
            low = b * (k + 1) - self.longest
            yield i, low - k, low + 2 * (k + 1) + len(self.texts[i]) + k


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every run of `q` characters, by doubling; `q` is a power of two."""
    out, span = codes, 1
    while span < q:
        out = out[:-span] * _MIX[span.bit_length() % len(_MIX)] + out[span:]
        span *= 2
    return (out ^ (out >> np.uint64(29))) * _MIX[0]


def alignment(item: str, region: str, most: int) -> int | None:
    """Fewest edits between an item and any part of a region, or None if more than `most`.

    Banded: a cell is an item's prefix and a diagonal of the region. Cells of a row are solved
    together; the running minimum settles insertions.
    """
    if item in region:
        return 0
    a, b = _codes(item), _codes(region)
    width = b.size - a.size + 2 * most + 1
    if width <= 0:
        return None
    # Diagonals start `most` to the left of the region; what lies outside equals no character.
    padded = np.full(a.size + width, np.iinfo(np.uint64).max)
    padded[most : most + b.size] = b[: padded.size - most]
    inside = np.zeros(padded.size + 1, bool)
    inside[most : most + b.size + 1] = True
    far, step = most + 1, np.arange(width)
    row = np.where(inside[:width], 0, far)
    for i, c in enumerate(a):
        match = row + (padded[i : i + width] != c)
        drop = np.append(row[1:], far) + 1
        row = np.minimum(match, drop)
        row = np.minimum(np.minimum.accumulate(row - step) + step, far)
        row[~inside[i + 1 : i + 1 + width]] = far
        if row.min() >= far:
            return None
    return int(row.min())


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    budget: Budget = Budget(),
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents with `leaks`, an array of structs `item_id`, `edits`, smallest id first.

    An item leaks into a document if some part of the text can be turned into the whole item with at
    most `budget.edits` insertions, deletions and replacements of characters, both in lower case and
    with white space as single spaces. Items below `q` characters, or null, leak nowhere. Items that
    share an id count as one, with the fewest edits of any. Null and empty texts hold none. All rows
    and columns stay; a column named `leaks` is replaced. Rows stay where they are, so long texts
    and repeated rows need no care; texts are searched in overlapping slices.

    The benchmark is a stated query set: its different items are packed into blocks of at most
    `block_chars` characters (a single longer item, or few whose hashes meet, may exceed it). One
    block at a time goes through the driver, is broadcast and searched for; a worker keeps one
    block's index. With several blocks, each pass stages what it found under the digest of the text,
    and the passes are joined to the documents last, by broadcast while what was found is small.
    """
    if budget.q & (budget.q - 1) or budget.q < 2:
        raise ValueError("q must be a power of two")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    result = f"array<struct<item_id:{kind},edits:int>>"
    nothing, text = F.array().cast(result), F.col("text")
    carried, restored = hide(documents, ("text",), ("leaks",))
    blocks = _blocks(benchmark, block_chars)
    if len(blocks) < 2:
        leaks = _search(blocks[0], budget, result)(text) if blocks else nothing
        found = documents.select(*carried, F.array_sort(leaks).alias("_leaks"))
        return found.select(*restored.values(), F.col("_leaks").alias("leaks"))
    digest = F.sha2(text.cast("binary"), 256)
    passes = None
    for block in blocks:
        searched = documents.select(text, _search(block, budget, result)(text).alias("_leaks"))
        hits = searched.where(F.size("_leaks") > 0).select(
            digest.alias("_digest"), F.explode("_leaks").alias("_leak")
        )
        hits = stage(hits.select("_digest", "_leak.item_id", "_leak.edits").distinct())
        passes = hits if passes is None else passes.unionAll(hits)
    fewest = passes.groupBy("_digest", "item_id").agg(F.min("edits").alias("edits"))
    listed = fewest.groupBy("_digest").agg(
        F.array_sort(F.collect_list(F.struct("item_id", "edits"))).alias("_leaks")
    )
    # Staged, its size is known: Spark broadcasts it only below its threshold.
    joined = documents.select(*carried, digest.alias("_digest")).join(stage(listed), "_digest", "left")
    return joined.select(*restored.values(), F.coalesce("_leaks", nothing).alias("leaks"))


def _blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    """The different items that are not null, in frames of at most `block_chars` characters.

    Items are dealt to many bins by hash, and bins packed in order while they fit.
    """
    usable = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull())
    usable = stage(usable.select("item_id", "text").distinct())
    total = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    bin_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, 16 * total // block_chars)))
    packed, filled = [], block_chars
    sizes = usable.groupBy(bin_of.alias("bin")).agg(F.sum(F.length("text")).alias("n"))
    for row in sizes.where("n > 0").orderBy("bin").collect():
        if not packed or filled + row["n"] > block_chars:
            packed.append([row["bin"], row["bin"]])
            filled = 0
        packed[-1][1] = row["bin"]
        filled += row["n"]
    return [usable.where(bin_of.between(low, high)) for low, high in packed]


def _search(block: DataFrame, budget: Budget, result: str):
    """A function that finds a block's items in texts."""
    items = block.sparkSession.sparkContext.broadcast([tuple(r) for r in block.collect()])
    name = uuid.uuid4().hex

    def index() -> Index:
        kept = kept_by_worker("benchmark block", dict)
        if name not in kept:
            kept.clear()
            kept[name] = Index(items.value, budget)
        return kept[name]

    @F.pandas_udf(result)
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block_index = index()
        for batch in texts:
            yield pd.Series(
                [[{"item_id": k, "edits": n} for k, n in block_index.find(t).items()] for t in batch]
            )

    # Or a filter on what is found would search once more.
    return search.asNondeterministic()


def decontaminate(documents: DataFrame, benchmark: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """The documents into which no benchmark item leaks, in all their columns."""
    clean = find_leaks(documents, benchmark, budget).where(F.size("leaks") == 0)
    return clean.drop("leaks")
