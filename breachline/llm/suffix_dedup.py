"""Remove byte strings that occur more than once, with a suffix array per shard of equal text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

#: Bytes of a text that are cut into pieces at a time, to bound memory.
_SLICE = 1 << 22
#: Symbols that one index holds; whole groups are put together up to this.
_INDEX = 1 << 18
#: Distinct pieces of one group beyond which they are dealt anew by more of their text.
CROWD = 256
#: Starts that a piece holds when crowded groups are dealt anew, and again; at one, groups are equal.
_FINER = (16, 1)
#: A key with more than one in so many of all rows is dealt over several tasks.
_SPREAD = 1_000
#: Hashes are compared without these bits, which hold the place to settle ties.
_PLACE = np.uint64((1 << 23) - 1)
_MULTIPLY = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of `length` bytes, by doubling; `length` is a power of two."""
    out, span = data.astype(np.uint64) + np.uint64(1), 1
    while span < length:
        out = out[:-span] * (_MULTIPLY[span.bit_length() % 3] ^ np.uint64(2 * span)) + out[span:]
        span *= 2
    return (out ^ (out >> np.uint64(31))) * _MULTIPLY[1]


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of every window of `width`."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: out.size - rest], out[rest:]) if rest else out


def _gram(length: int) -> int:
    return 1 << max(0, (length // 4).bit_length() - 1)


def pieces_of(text: bytes, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces of a text: anchor, digest, first start, number of starts, place of the anchor in it.

    The anchor of a string of `length` bytes is the part of it, an eighth to a quarter as long, with
    the least hash, the leftmost of equals. It depends on the string alone, so equal strings have
    equal anchors at equal places. Neighbouring strings mostly share theirs; a piece is the text that
    a run of such strings covers, and each string is in exactly one piece.
    """
    import xxhash

    gram = _gram(length)
    width, low = length - gram + 1, _PLACE
    for base in range(0, len(text) - length + 1, _SLICE):
        part = text[base : base + _SLICE + length - 1]
        value = _hashes(np.frombuffer(part, np.uint8), gram)
        place = np.arange(value.size, dtype=np.uint64)
        at = (_minima((value & ~low) | place, width) & low).astype(np.int64)
        start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        count = np.diff(np.append(start, at.size)).tolist()
        anchor = value[at[start]].view(np.int64).tolist()
        place = (at[start] - start).tolist()
        for a, s, n, p in zip(anchor, start.tolist(), count, place):
            digest = xxhash.xxh64_intdigest(part[s : s + n - 1 + length])
            yield a, digest - (1 << 64) if digest >> 63 else digest, base + s, n, p


def symbols(text: bytes) -> np.ndarray:
    """Bytes as symbols of an index, which are above zero."""
    return np.frombuffer(text, np.uint8).astype(np.int64) + 1


def repeated_starts(pieces: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each piece the places where a string of `length` symbols starts that also starts elsewhere.

    The suffixes of all pieces are sorted by their first `length` symbols or more. Their
    Burrows-Wheeler transform then gives the common prefixes of neighbours by increasing value: the
    interval of suffixes that begin with some string is extended backward by each symbol that
    precedes it, breadth first, so in round `v` the intervals of strings of `v` symbols end where
    neighbours share `v`. An end that is known already is not followed. Rounds stop at `length`:
    what is not known by then is as long or longer. Every piece ends in a symbol of its own, which
    is never extended by, so nothing matches across pieces.
    """
    size = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(size) - 1
    text = np.zeros(int(size.sum()), np.int64)
    kept = np.ones(text.size, bool)
    kept[ends] = False
    text[kept] = np.concatenate(pieces)
    left = np.repeat(ends, size) - np.arange(text.size)
    order, known = _sorted_suffixes(text, left, length)
    _short_prefixes(text, order, known, length)
    n = text.size
    # known[k] tells of suffix k and the one before it; both start what they share.
    long = ~known[:n]
    twice = long.copy()
    twice[:-1] |= long[1:]
    marked = np.zeros(n, bool)
    marked[order[twice]] = True
    return [np.flatnonzero(m) for m in np.split(marked, ends[:-1] + 1)]


#: Bits of a symbol, and how many fit in the key of the first sort.
_BITS, _PACKED = 15, 4


def _sorted_suffixes(text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first `length` symbols or more, by prefix doubling.

    Also, by entry `k`, whether suffixes `k - 1` and `k` differ within the first key already, whose
    symbols are `length` at most. Suffixes that differ from all others leave the next rounds.
    """
    n, depth = text.size, min(_PACKED, length)
    key = text.copy()
    for k in range(1, depth):
        # Symbols after the end of a piece count as none.
        key <<= _BITS
        if k < n:
            key[: n - k] |= np.where(left[: n - k] >= k, text[k:], 0)
    order = np.argsort(key).astype(np.int32)
    held, reach = key[order], left[order]
    new = np.ones(n + 1, bool)
    # A suffix that reaches its end symbol differs from all others.
    new[1:n] = (held[1:] != held[:-1]) | (reach[1:] < depth) | (reach[:-1] < depth)
    known = new.copy()
    rank = np.empty(n + length, np.int64)
    while depth < length:
        first = np.flatnonzero(new[:n])
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        rest = np.flatnonzero(~(new[:n] & new[1:]))
        if not rest.size:
            break
        some = order[rest]
        key = rank[some] * n + np.where(left[some] >= depth, rank[np.minimum(some + depth, n - 1)], 0)
        again = np.argsort(key)
        order[rest] = some = some[again]
        key, reach = key[again], left[some]
        depth *= 2
        apart = np.ones(rest.size, bool)
        apart[1:] = (key[1:] != key[:-1]) | (reach[1:] < depth) | (reach[:-1] < depth)
        new[rest] |= apart
    return order, known


def _short_prefixes(text: np.ndarray, order: np.ndarray, known: np.ndarray, length: int) -> None:
    """Mark in `known` the neighbours in the order that share fewer than `length` symbols.

    Entry `k` tells of `k - 1` and `k`; those that share less than the first key are marked before.
    """
    n = text.size
    before = text[order - 1].astype(np.uint16)  # of the first suffix, the last end symbol
    back = np.argsort(before, kind="stable").astype(np.int32)
    follow = np.empty(n, np.int32)  # where the suffix that starts one symbol earlier stands
    follow[back] = np.arange(n, dtype=np.int32)
    same = before[back[1:]] == before[back[:-1]]
    earlier, later = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    earlier[back[1:][same]] = back[:-1][same]
    later[back[:-1][same]] = back[1:][same]
    real = before > 0

    start = np.flatnonzero(known[:n]).astype(np.int32)
    stop = np.append(start[1:], np.int32(n))
    for _ in range(min(_PACKED, length), length):
        # All places of the intervals, with the bounds of their own interval.
        count = stop - start
        if count.max(initial=1) == 1:
            at = start[real[start]]
            start, stop = follow[at], follow[at] + 1
        else:
            shift = start - (np.cumsum(count, dtype=np.int32) - count)
            at = np.arange(int(count.sum()), dtype=np.int32) + np.repeat(shift, count)
            usable = real[at]
            opens = at[usable & (earlier[at] < np.repeat(start, count))]
            closes = at[usable & (later[at] >= np.repeat(stop, count))]
            # First and last of one symbol in one interval, in the order of where they lead.
            start, stop = np.sort(follow[opens]), np.sort(follow[closes]) + 1
        fresh = ~known[stop]
        start, stop = start[fresh], stop[fresh]
        if not start.size:
            break
        known[stop] = True


def _runs(places: np.ndarray) -> list[dict[str, int]]:
    if not places.size:
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    s = places[np.append(0, cut + 1)]
    e = places[np.append(cut, places.size - 1)] + 1
    return [{"s": int(a), "e": int(b)} for a, b in zip(s, e)]


def _parts(piece: bytes, place: int, length: int, step: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """A piece cut by starts: first start, starts, what precedes the core, the core, what follows.

    A part holds the starts whose distance to the anchor falls in one interval of `step`, so equal
    strings are in parts at equal distances. All strings of a part contain its core.
    """
    last, start = len(piece) - length, 0
    while start <= last:
        low = (place - start) // step * step
        stop = min(last, place - low) + 1
        core, after = place - low, place - low - step + 1 + length
        yield start, stop - start, piece[start:core], piece[core:after], piece[after : stop - 1 + length]
        start = stop


class _Shard:
    """Pieces of whole groups, gathered until an index is worth while.

    Pieces of a group are cut into parts. Parts with the same core may hold equal strings; in the
    index the core, nearly as long as a string, stands as one symbol, and a string is as long as the
    parts have starts. A part that is alone with its core repeats nowhere; equal parts repeat in full.
    """

    def __init__(self, length: int):
        self.length = length
        self.step = max(1, min(32, length // 2))
        self.rows: list[tuple] = []
        self.runs: list[list[np.ndarray]] = []
        self.texts: list[np.ndarray] = []
        self.owners: list[list[tuple[int, int]]] = []
        self.cores = self.size = 0

    def add(self, group: list[tuple]) -> None:
        by_core: dict[bytes, dict[tuple, list]] = {}
        for anchor, digest, place, piece in group:
            row = len(self.rows)
            self.rows.append((anchor, digest))
            self.runs.append([])
            for start, n, left, core, right in _parts(piece, place, self.length, self.step):
                by_core.setdefault(core, {}).setdefault((left, right, n), []).append((row, start))
        for parts in by_core.values():
            if len(parts) > 1:
                self.cores += 1
            for (left, right, n), owners in parts.items():
                if len(owners) > 1:
                    for row, start in owners:
                        self.runs[row].append(np.arange(start, start + n))
                if len(parts) > 1:
                    core = np.array([256 + self.cores])
                    self.texts.append(np.concatenate([symbols(left), core, symbols(right)]))
                    self.owners.append(owners)
                    self.size += len(left) + len(right) + 2

    @property
    def full(self) -> bool:
        return self.size > _INDEX or len(self.rows) > 20_000 or self.cores > 15_000

    def result(self) -> pa.RecordBatch:
        if self.texts:
            for owners, found in zip(self.owners, repeated_starts(self.texts, self.step)):
                for row, start in owners if found.size else ():
                    self.runs[row].append(found + start)
        places = [np.unique(np.concatenate(r)) if r else np.empty(0, int) for r in self.runs]
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in self.rows], pa.int64()),
                pa.array([r[1] for r in self.rows], pa.int64()),
                pa.array([_runs(p) for p in places], kind),
            ],
            names=["anchor", "digest", "runs"],
        )


def _index_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated starts of pieces that come sorted by anchor; whole groups are indexed together."""
    shard, group = _Shard(length), []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if group and group[0][0] != row[0]:
                shard.add(group)
                group = []
                if shard.full:
                    yield shard.result()
                    shard = _Shard(length)
            group.append(row)
    if group:
        shard.add(group)
    if shard.rows:
        yield shard.result()


def repeated_strings(texts: DataFrame, length: int, crowd: int = CROWD) -> DataFrame:
    """Where repeated strings start: `_id`, `_text` and `starts`, an array of structs `s`, `e`.

    `texts` has `_id`, `_text` (bigint; a row's id, and a hash of its id and text) and `body` (binary).

    Pieces bring equal strings to the same anchor, so the anchor is the shard key. Anchors seen once
    are done. Pieces equal as a whole are folded and counted; those seen twice or more repeat in
    full. Where an anchor has several different pieces these are fetched, once each, and indexed.
    A crowd of pieces around one anchor, as where a passage ends differently everywhere, would be
    one shard too large, and is dealt anew: see `_finer`.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, t, *p)
                for i, t, body in zip(*(batch.column(c).to_pylist() for c in range(3)))
                for p in pieces_of(body, length)
            ]
            for k in range(0, len(rows), 50_000):
                columns = [pa.array(c, pa.int64()) for c in zip(*rows[k : k + 50_000])]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["_id", "_text", "anchor", "digest", "at", "n", "place"]
                )

    long = texts.select("_id", "_text", "body").where(F.octet_length("body") >= length)
    cut_rows = long.mapInArrow(
        cut, "_id long, _text long, anchor long, digest long, at long, n long, place long"
    )
    pieces = stage(cut_rows.withColumns({c: F.col(c).cast("int") for c in ("at", "n", "place")}))
    anchors = stage(pieces.groupBy("anchor").agg(F.count("*").alias("many")).where("many > 1"))
    pieces = stage(_spread_join(pieces, anchors.select("anchor"), ["anchor"], anchors, pieces.count()))

    kinds = stage(
        pieces.groupBy("anchor", "digest").agg(
            F.count("*").alias("copies"),
            F.min("n").alias("n"),
            F.min("place").alias("place"),
            F.min("_text").alias("_text"),
            F.min_by("_id", "_text").alias("_id"),
            F.min_by("at", "_text").alias("at"),
        )
    )
    varied = _varied(kinds, "anchor")
    wanted = varied.groupBy("_id", "_text").agg(
        F.collect_list(F.struct("anchor", "digest", "copies", "kinds", "n", "at", "place")).alias("wanted")
    )
    bodies = long.groupBy("_id", "_text").agg(F.max("body").alias("body"))
    fetched = bodies.join(wanted, ["_id", "_text"]).select(
        F.explode(
            F.transform(
                "wanted",
                lambda w: F.struct(
                    w["anchor"].alias("anchor"),
                    w["digest"].alias("digest"),
                    w["copies"].alias("copies"),
                    w["kinds"].alias("kinds"),
                    w["place"].alias("place"),
                    F.substring(F.col("body"), w["at"] + 1, w["n"] + (length - 1)).alias("piece"),
                ),
            )
        ).alias("w")
    )
    fetched = stage(fetched.select("w.*"))

    full = kinds.where("copies > 1").select("anchor", "digest", _whole().alias("runs"))
    # A piece seen twice is in full; what the index says of it would only repeat that.
    single = kinds.where("copies = 1").select("anchor", "digest")
    partial = _partly(fetched, length, crowd, _FINER).join(single, ["anchor", "digest"])
    results = full.union(partial)
    where = pieces.select("_id", "_text", "anchor", "digest", "at").distinct()
    copies = kinds.select("anchor", "digest", F.col("copies").alias("many"))
    located = _spread_join(where, results, ["anchor", "digest"], copies, pieces.count()).select(
        "_id",
        "_text",
        F.transform(
            "runs",
            lambda r: F.struct((r["s"] + F.col("at")).alias("s"), (r["e"] + F.col("at")).alias("e")),
        ).alias("runs"),
    )
    return located.groupBy("_id", "_text").agg(F.flatten(F.collect_list("runs")).alias("starts"))


def _spread_join(rows: DataFrame, table: DataFrame, on: list[str], counts: DataFrame, total: int) -> DataFrame:
    """Rows joined with a table of one row a key, where a key may hold any share of the rows.

    `counts` has the keys and `many`, which is not below the number of rows with that key; these add
    up to at most `total`. A key with more than one in `_SPREAD` of all is dealt over as many parts
    as keep each below that, and its row of the table goes to each. There are fewer than `_SPREAD`
    such keys, whatever the size, so they are broadcast.
    """
    parts = F.ceil(F.col("many") * F.lit(_SPREAD) / F.lit(max(1, total))).cast("int")
    hot = F.broadcast(counts.where(F.col("many") * F.lit(_SPREAD) > F.lit(total)).select(*on, parts.alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    left = rows.join(hot, on, "left").withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts).cast("int"))
    right = table.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.drop("_parts").join(right.drop("_parts"), [*on, "_part"]).drop("_part")


def _varied(kinds: DataFrame, key: str) -> DataFrame:
    """Those whose key has several kinds, with their number, `kinds`."""
    variety = stage(kinds.groupBy(key).agg(F.count("*").alias("many")).where("many > 1"))
    return _spread_join(kinds, variety.withColumnRenamed("many", "kinds"), [key], variety, kinds.count())


_RUNS = "array<struct<s:int,e:int>>"


def _whole() -> Column:
    return F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e"))).cast(_RUNS)


def _partly(pieces: DataFrame, length: int, crowd: int, steps: tuple[int, ...]) -> DataFrame:
    """Repeated starts, `runs`, of different pieces by `anchor` and `digest`, from an index of each group."""
    indexed = (
        pieces.where(F.col("kinds") <= crowd)
        .select("anchor", "digest", "place", "piece")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda b: _index_shards(b, length), f"anchor long, digest long, runs {_RUNS}")
        .where(F.size("runs") > 0)
    )
    return indexed.union(_finer(pieces.where(F.col("kinds") > crowd), length, crowd, steps)) if steps else indexed


def _finer(pieces: DataFrame, length: int, crowd: int, steps: tuple[int, ...]) -> DataFrame:
    """Repeated starts of crowded pieces, cut into smaller ones around more of their text.

    A smaller piece holds `steps[0]` starts, counted from the anchor so that equal strings fall in
    the same one. All its strings contain a core, nearly as long as a string, which is the key of
    its new group. Few groups stay crowded: those whose core reaches just to where texts part. With
    one start to a piece the core is the string itself, and a group is one kind, which is counted.
    """
    step = steps[0]

    def smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (a, d, copies, *part)
                for a, d, copies, place, piece in zip(*(batch.column(c).to_pylist() for c in range(5)))
                for part in _cores(piece, place, length, step)
            ]
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.int64(), pa.int64(), pa.binary()]
            names = ["anchor", "digest", "copies", "from", "n", "place", "core", "part", "piece"]
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    cut = stage(
        pieces.select("anchor", "digest", "copies", "place", "piece").mapInArrow(
            smaller,
            "anchor long, digest long, copies long, from int, n int, place int, core long, part long, "
            "piece binary",
        )
    )
    kinds = cut.groupBy("core", "part").agg(
        F.sum("copies").alias("copies"), F.max("n").alias("n"), F.max("place").alias("place"), F.max("piece").alias("piece")
    )
    kinds = stage(kinds)
    renamed = {"core": "anchor", "part": "digest"}
    full = kinds.where("copies > 1").select("core", "part", _whole().alias("runs"))
    if len(steps) > 1:
        varied = _varied(kinds, "core").withColumnsRenamed(renamed)
        found = _partly(varied, length, crowd, steps[1:]).toDF("core", "part", "runs")
        single = kinds.where("copies = 1").select("core", "part")
        full = full.union(found.join(single, ["core", "part"]))
    moved = F.transform(
        "runs", lambda r: F.struct((r["s"] + F.col("from")).alias("s"), (r["e"] + F.col("from")).alias("e"))
    )
    back = cut.select("anchor", "digest", "from", "core", "part").join(full, ["core", "part"])
    return back.groupBy("anchor", "digest").agg(F.flatten(F.collect_list(moved)).alias("runs"))


def _cores(piece: bytes, place: int, length: int, step: int) -> Iterator[tuple]:
    """Parts as smaller pieces: first start, starts, place of the anchor, core and digest, bytes."""
    import xxhash

    for start, n, left, core, right in _parts(piece, place, length, step):
        part = left + core + right
        keys = [xxhash.xxh64_intdigest(x, seed) for x, seed in ((core, 1), (part, 2))]
        yield start, n, place - start, *[k - (1 << 64) if k >> 63 else k for k in keys], part


def _identity(text: Column) -> list[Column]:
    return [
        # Ids that are no numbers go by a second hash, of its own kind.
        F.coalesce(F.col("doc_id").try_cast("long"), F.hash("doc_id").cast("long")).alias("_id"),
        F.xxhash64(F.col("doc_id"), text).alias("_text"),
    ]


def remove_repeats(documents: DataFrame, length: int = 400, crowd: int = CROWD) -> DataFrame:
    """The documents with `kept` (binary), `n_removed` and `n_spans`.

    A byte is removed if a string of `length` bytes covers it that also starts anywhere else, in
    another row or the same, overlapping or not; all copies go, the first too. Strings are judged on
    the input. `n_spans` counts maximal runs of removed bytes. Null text is empty; texts shorter than
    `length` are kept. Rows that are equal in id and text are copies of each other like any others.
    All rows and columns stay; columns with the three names are replaced. Bytes are UTF-8; what is
    left may start or end inside a character. An empty table gives none.
    """
    names = ("kept", "n_removed", "n_spans")
    columns = [c for c in documents.columns if c not in names]
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = documents.select(*_identity(F.col("text")), body.alias("body"))
    starts = repeated_strings(texts, length, crowd)

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cleared(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for bodies, runs in parts:
            rows = [_clear(b, r, length) for b, r in zip(bodies, runs)]
            yield pd.DataFrame(rows, columns=list(names))

    kept = [F.col(c).alias(f"_kept_{i}") for i, c in enumerate(columns)]
    keyed = documents.select(*kept, *_identity(F.col("text")), body.alias("_body"))
    joined = keyed.join(starts, ["_id", "_text"], "left")
    ends = [F.col("starts.s"), F.col("starts.e")]
    pairs = F.when(F.col("starts").isNull(), F.array()).otherwise(F.concat(*ends))
    done = joined.withColumn("_out", cleared(F.col("_body"), pairs.cast("array<int>")))
    return done.select(
        *[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(columns)],
        *[F.col(f"_out.{n}").alias(n) for n in names],
    )


def _clear(body: bytes, pairs: np.ndarray, length: int) -> tuple[bytes, int, int]:
    """What is left of a text, given the first and last starts of repeated strings, all firsts first."""
    if not len(pairs):
        return body, 0, 0
    s, e = np.split(np.asarray(pairs, np.int64), 2)
    change = np.zeros(len(body) + 1, np.int64)
    np.add.at(change, s, 1)
    np.add.at(change, e + length - 1, -1)
    gone = np.cumsum(change)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    left = np.frombuffer(body, np.uint8)[~gone].tobytes()
    return left, int(gone.sum()), spans

