"""Count the tokens of texts by byte-pair merging, with a heap and a linked list."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept_by_worker

_SPACE = "▁"
#: One unit of a text: spaces and the word after them. No vocabulary entry goes on past a word into
#: a space, which `Pieces` checks, so no merge crosses units and each is counted on its own.
_UNIT = re.compile(" *[^ ]+| +")
#: Units kept with their count by each Python worker, and the longest that is kept.
_KEPT, _KEPT_LENGTH = 1_000_000, 48
#: Characters of a text that are split at a time, to bound memory.
_SLICE = 1 << 20


class Pieces:
    """The vocabulary of a sentencepiece BPE model: which pieces may be merged, and their rank."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        self.rank = {
            model.id_to_piece(i): int(-model.get_score(i))
            for i in range(model.get_piece_size())
            if not any(f(i) for f in special)
        }
        if any(_SPACE in p.lstrip(_SPACE) for p in self.rank):
            raise ValueError("a piece of this vocabulary continues past a word into a space")
        self.seen: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        """Tokens of a text, as the library would encode it; null and empty have none."""
        if not text:
            return 0
        total = 0
        for part in _slices(" " + text.replace(_SPACE, " ")):
            for unit, times in Counter(_UNIT.findall(part)).items():
                n = self.seen.get(unit)
                if n is None:
                    n = self.merged(unit.replace(" ", _SPACE))
                    if len(unit) <= _KEPT_LENGTH:
                        if len(self.seen) >= _KEPT:
                            self.seen.clear()
                        self.seen[unit] = n
                total += times * n
        return total

    def merged(self, unit: str) -> int:
        """Tokens of one unit: its symbols less its merges.

        Symbols are characters. One that the vocabulary lacks falls back to its bytes, so it counts
        as that many symbols. The heap holds adjacent pairs that form a piece, lowest rank first and
        leftmost among equals; the linked list of live symbols gives a merged symbol its neighbours.
        """
        get, n = self.rank.get, len(unit)
        symbols: list[str | None] = list(unit)
        unknown = {i: len(s.encode()) for i, s in enumerate(symbols) if s not in self.rank}
        count = n + sum(unknown.values()) - len(unknown)
        before, after = list(range(-1, n - 1)), [*range(1, n), n]
        # A pair is its rank and its left symbol, in one number.
        heap = [
            r * n + i for i, p in enumerate(map(add, unit, unit[1:])) if (r := get(p)) is not None
        ]
        heapify(heap)
        while heap:
            r, left = divmod(heappop(heap), n)
            # Either symbol may have been merged with another since the pair was offered.
            if symbols[left] is None or (right := after[left]) == n:
                continue
            piece = symbols[left] + symbols[right]
            if get(piece) != r:
                continue
            count -= 1
            if unknown:
                count -= unknown.pop(left, 1) + unknown.pop(right, 1) - 2
            symbols[left], symbols[right] = piece, None
            after[left] = beyond = after[right]
            if beyond < n:
                before[beyond] = left
                if (r := get(piece + symbols[beyond])) is not None:
                    heappush(heap, r * n + left)
            if (ahead := before[left]) >= 0:
                if (r := get(symbols[ahead] + piece)) is not None:
                    heappush(heap, r * n + ahead)
        return count


def _slices(text: str) -> Iterator[str]:
    """Parts of a text, cut only where a word ends and a space follows."""
    start = 0
    while len(text) - start > _SLICE:
        cut = re.compile(r"(?<=[^ ]) ").search(text, start + _SLICE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def token_count(text: Column, vocabulary: str) -> Column:
    """Tokens of a text column by the sentencepiece BPE model at a path that executors can read."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = kept_by_worker(f"pieces of {vocabulary}", lambda: Pieces(vocabulary))
        for batch in texts:
            yield pd.Series([pieces.count(t) for t in batch], dtype="int64")

    return count(text)


def count_tokens(
    documents: DataFrame, vocabulary: str, limit: int = 4096, id_column: str = "doc_id"
) -> DataFrame:
    """Size of every whole text: `n_bytes`, `n_tokens` and whether that is `over_limit`.

    Nothing is emitted but counts. Rows stay where they are: there is no shuffle, and equal rows
    give equal rows. A null text counts as empty, with no bytes and no tokens. Other columns, of
    whatever name, are not read. Texts are split in bounded slices, so memory does not grow with a
    text beyond the text itself, unless it is one unbroken word.
    """
    text = F.col("text")
    return documents.select(
        F.col(id_column),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(text, vocabulary).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
