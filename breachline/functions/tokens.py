"""Searching texts for many literals at once."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def token_hits(text: Column, tokens: Sequence[tuple[str, int]]) -> Column:
    """Numbers (array<bigint>) of the literals that a text contains, in their order; null has none.

    One pass over the text, whatever the number of literals: they form a trie with failure links
    (Aho-Corasick), which finds overlapping and nested ones alike. Its size is that of the literals.
    It is built once by each Python worker and kept for later tasks and batches. A literal may occur
    more than once, with other numbers; the empty one is in every text.
    """
    numbers = [n for _, n in tokens]
    places: dict[str, list[int]] = {}
    for place, (token, _) in enumerate(tokens):
        places.setdefault(token, []).append(place)
    everywhere = places.pop("", [])
    known = {token: tuple(at) for token, at in places.items()}
    key = f"tokens-{hash(tuple(known.items())):x}-{len(known)}"

    def search(texts: pa.Array) -> pa.Array:
        automaton = _kept(key, known)
        found, ends = [], [0]
        for value in texts:
            body = value.as_py()
            if body is not None:
                at = set(everywhere)
                if automaton is not None:
                    for _, hit in automaton.iter(body):
                        at.update(hit)
                found += [numbers[p] for p in sorted(at)]
            ends.append(len(found))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int64()))

    # Not deterministic to Spark, so that filter and list share one call.
    return F.arrow_udf(search, "array<bigint>").asNondeterministic()(text)


def _kept(key: str, known: dict[str, tuple[int, ...]]):
    """The automaton of this worker; functions travel by value, so their own modules keep nothing."""
    box = sys.modules.setdefault("_breachline_tokens", types.ModuleType("_breachline_tokens")).__dict__
    made = box.get(key)
    if made is None or made[0] != known:
        made = box[key] = (known, _automaton(known))
    return made[1]


def _automaton(known: dict[str, tuple[int, ...]]):
    if not known:
        return None
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for token, at in known.items():
        automaton.add_word(token, at)
    automaton.make_automaton()
    return automaton
