"""Near-duplicate embeddings by navigable small-world graphs, one per shard of a label."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, stage

#: Vectors that one graph holds, and that one task asks it for.
SHARD = 16_384
#: Vectors put in or asked together.
_BATCH = 256
#: True links that an audit looks for before it trusts a beam.
AUDIT = 1_000
#: Candidate pairs verified in one step.
_PAIRS = 65_536


class Graph:
    """A hierarchical navigable small-world graph over unit vectors.

    Every vector is on layer 0, and one in `degree` of those of a layer on the next, drawn by the
    bits of a hash. A search goes greedily down the upper layers, then keeps a beam on layer 0.
    Vectors are put in by batches: each batch searches the graph of those before it, and its members
    are compared with each other, so the links are as if they had come one by one.
    """

    def __init__(self, vectors: np.ndarray, degree: int = 16, beam: int = 64):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(self.vectors)
        self.degree = degree
        hashed = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
        draw = (hashed % np.uint64(1 << 40)).astype(float) / (1 << 40)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(degree)).astype(int), 6)
        # Layers from the bottom up; vectors are numbered so that the upper ones come first.
        self.order = np.argsort(-level, kind="stable")
        self.vectors = self.vectors[self.order]
        level = level[self.order]
        self.sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
        self.links = [np.full((s, degree * 2), -1, np.int32) for s in self.sizes]
        for k in range(len(self.sizes) - 1, -1, -1):
            self._build(k, beam)

    def _build(self, layer: int, beam: int) -> None:
        size, links = self.sizes[layer], self.links[layer]
        near = np.full(links.shape, -2.0, np.float32)
        done = 0
        while done < size:
            batch = np.arange(done, min(size, done + min(_BATCH, max(8, done))))
            own = self.vectors[batch]
            inside = own @ own.T
            inside[np.arange(len(batch))[:, None] <= np.arange(len(batch))[None, :]] = -2
            ids = np.broadcast_to(batch, inside.shape)
            if done:
                found, score = self._search(own, layer, beam, limit=done)
                ids = np.concatenate([found, ids], axis=1)
                inside = np.concatenate([score, inside], axis=1)
            pick, score = self._diverse(ids, inside)
            links[batch], near[batch] = -1, -2
            links[batch[:, None], np.arange(self.degree)], near[batch[:, None], np.arange(self.degree)] = pick, score
            self._link_back(links, near, batch, pick, score)
            done += len(batch)

    def _diverse(self, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row up to `degree` near ids, first those nearer to the row than to ones taken.

        Links to one dense spot only would leave no way elsewhere.
        """
        width = min(score.shape[1], 4 * self.degree)
        top = np.argsort(-score, axis=1, kind="stable")[:, :width]
        rows = np.arange(len(ids))[:, None]
        ids, score = ids[rows, top], score[rows, top]
        valid = score > -2
        vectors = self.vectors[np.where(valid, ids, 0)]
        between = np.einsum("bik,bjk->bij", vectors, vectors)
        taken = np.zeros(ids.shape, bool)
        for c in range(width):
            closest = np.where(taken, between[:, c], -2).max(axis=1)
            room = taken.sum(axis=1) < self.degree
            taken[:, c] = valid[:, c] & (score[:, c] > closest) & room
        # Fill up with the nearest of the rest.
        rank = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")
        pick, kept = ids[rows, rank][:, : self.degree], score[rows, rank][:, : self.degree]
        pick = np.where(kept > -2, pick, -1)
        if pick.shape[1] < self.degree:
            more = ((0, 0), (0, self.degree - pick.shape[1]))
            pick, kept = np.pad(pick, more, constant_values=-1), np.pad(kept, more, constant_values=-2)
        return pick, kept

    def _link_back(self, links, near, batch, pick, score) -> None:
        """Add the reverse of each link; where there is no room the farthest go."""
        to = pick.ravel()
        good = to >= 0
        source, to, score = np.repeat(batch, pick.shape[1])[good], to[good], score.ravel()[good]
        if not to.size:
            return
        order = np.lexsort((-score, to))
        to, source, score = to[order], source[order], score[order]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        count = np.diff(np.append(first, to.size))
        rank = np.arange(to.size) - np.repeat(first, count)
        width = self.degree
        fit = rank < width
        rows = to[first]
        extra = np.full((len(rows), width), -1, np.int32)
        extra_near = np.full((len(rows), width), -2.0, np.float32)
        row = np.repeat(np.arange(len(rows)), count)
        extra[row[fit], rank[fit]], extra_near[row[fit], rank[fit]] = source[fit], score[fit]
        # The first half of a row is the vector's own choice and stays; the second is for others.
        ids = np.concatenate([links[rows, width:], extra], axis=1)
        all_near = np.concatenate([near[rows, width:], extra_near], axis=1)
        keep = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        at = np.arange(len(rows))[:, None]
        links[rows, width:], near[rows, width:] = ids[at, keep], all_near[at, keep]

    def _search(self, queries, layer: int, beam: int, limit: int | None = None):
        """The best ids and scores for each query on a layer, entered from the layers above."""
        entry = np.zeros(len(queries), np.int64)
        for k in range(len(self.sizes) - 1, layer, -1):
            entry = self._descend(queries, k, entry)
        return self._beam(queries, layer, entry, beam, limit)

    def _descend(self, queries, layer: int, entry: np.ndarray) -> np.ndarray:
        score = np.einsum("bk,bk->b", queries, self.vectors[entry])
        live = np.arange(len(queries))
        while live.size:
            around = self.links[layer][entry[live]]
            scores = np.einsum("bk,bjk->bj", queries[live], self.vectors[np.maximum(around, 0)])
            scores[around < 0] = -2
            best = scores.argmax(axis=1)
            at = np.arange(live.size)
            better = scores[at, best] > score[live]
            live, chosen, best_score = live[better], around[at, best][better], scores[at, best][better]
            entry[live], score[live] = chosen, best_score
        return entry

    def _beam(self, queries, layer: int, entry: np.ndarray, beam: int, limit: int | None):
        """Best-first search with a beam, for all queries in step."""
        n, b = self.sizes[layer] if limit is None else limit, len(queries)
        entry = np.where(entry < n, entry, 0)
        rows = np.arange(b)
        ids = np.full((b, beam), -1, np.int64)
        score = np.full((b, beam), -2.0, np.float32)
        open_ = np.zeros((b, beam), bool)
        ids[:, 0], score[:, 0], open_[:, 0] = entry, np.einsum("bk,bk->b", queries, self.vectors[entry]), True
        seen = np.zeros((b, n), bool)
        seen[rows, entry] = True
        live = rows
        while live.size:
            ahead = np.where(open_[live], score[live], -3)
            # Several of the best are opened in one step.
            step = np.argpartition(-ahead, min(3, beam - 1), axis=1)[:, :4]
            at = live[:, None]
            use = open_[at, step]
            open_[at, step] = False
            around = self.links[layer][np.where(use, ids[at, step], 0)]
            around = np.where(use[:, :, None], around, -1).reshape(live.size, -1)
            fresh = (around >= 0) & (around < n)
            safe = np.where(fresh, around, 0)
            fresh &= ~seen[at, safe]
            r, c = np.nonzero(fresh)
            key = r * np.int64(n) + around[r, c]
            _, once = np.unique(key, return_index=True)
            r, c = r[once], c[once]
            node = around[r, c]
            seen[live[r], node] = True
            got = np.einsum("bk,bk->b", queries[live[r]], self.vectors[node])
            count = np.bincount(r, minlength=live.size)
            width = int(count.max(initial=0))
            place = np.arange(r.size) - np.repeat(np.cumsum(count) - count, count)
            new_ids = np.full((live.size, width), -1, np.int64)
            new_score = np.full((live.size, width), -2.0, np.float32)
            new_ids[r, place], new_score[r, place] = node, got
            all_ids = np.concatenate([ids[live], new_ids], axis=1)
            all_score = np.concatenate([score[live], new_score], axis=1)
            all_open = np.concatenate([open_[live], new_ids >= 0], axis=1)
            top = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
            near = np.arange(live.size)[:, None]
            ids[live], score[live] = all_ids[near, top], all_score[near, top]
            open_[live] = all_open[near, top]
            live = live[open_[live].any(axis=1)]
        return ids, score

    def within(self, queries: np.ndarray, least: float, beam: int | None) -> Iterator[tuple[int, np.ndarray]]:
        """Which vectors score `least` or more: for each batch its first query, and a row of flags a query.

        A query whose beam is full of such vectors is asked again with a wider one. Where that would
        see much of the graph, and without a beam, it is compared with every vector.
        """
        n = self.sizes[0]
        for start in range(0, len(queries), _BATCH):
            part = queries[start : start + _BATCH]
            hit = np.zeros((len(part), n), bool)
            todo, width = np.arange(len(part)), beam and min(beam, n)
            while todo.size:
                if width is None:
                    hit[todo[:, None], self.order] = part[todo] @ self.vectors.T >= least
                    break
                ids, score = self._search(part[todo], 0, width)
                good = (score >= least) & (ids >= 0)
                full = good.all(axis=1) & (width < n)
                r, c = np.nonzero(good & ~full[:, None])
                hit[todo[r], self.order[ids[r, c]]] = True
                todo, width = todo[full], 4 * width if 32 * width < n else None
            yield start, hit


def audited(
    graph: Graph, queries: np.ndarray, least: float, goal: float, beam: int = 48, own: bool = False
) -> int | None:
    """The beam that passes the audit, or none if no beam does.

    The audit compares queries with brute force, in an order drawn once, until `AUDIT` true links
    are seen or no query is left; a shard with few links is therefore audited by all of them. The
    beam doubles until it finds the goal's share of these links. `own` says that the queries are the
    graph's vectors, in their order, whose links to themselves tell nothing.
    """
    draw = np.random.default_rng(len(queries)).permutation(len(queries))
    asked, wanted = [], 0
    for start in range(0, len(draw), _BATCH):
        some = draw[start : start + _BATCH]
        true = queries[some] @ graph.vectors.T >= least
        if own:
            true &= graph.order != some[:, None]
        asked.append(some[true.any(axis=1)])
        wanted += int(true.sum())
        if wanted >= AUDIT:
            break
    asked = np.concatenate(asked) if asked else draw
    while beam < graph.sizes[0]:
        found = 0
        for start, hit in graph.within(queries[asked], least, beam):
            if own:
                hit[np.arange(len(hit)), asked[start : start + len(hit)]] = False
            found += int(hit.sum())
        if found >= goal * wanted:
            return beam
        beam *= 2
    return None


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in values])


def _unit(m: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


class Shard:
    """A graph with what its vectors stand for: class ids, number of rows of each, unit vectors."""

    def __init__(self, graph: Graph, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        self.graph, self.ids, self.rows, self.vectors = graph, ids, rows, vectors

    def pack(self) -> bytes:
        out = io.BytesIO()
        links = {f"links{k}": x for k, x in enumerate(self.graph.links)}
        own = {"ids": self.ids, "rows": self.rows, "vectors": self.vectors}
        np.savez(out, order=self.graph.order, near=self.graph.vectors, **own, **links)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Shard:
        graph, box = Graph.__new__(Graph), np.load(io.BytesIO(data))
        graph.order, graph.vectors = box["order"], box["near"]
        graph.links = [box[f"links{k}"] for k in range(sum(f.startswith("links") for f in box.files))]
        graph.sizes = [len(x) for x in graph.links]
        graph.degree = graph.links[0].shape[1] // 2
        return cls(graph, box["ids"], box["rows"], box["vectors"])


def _candidates(one: Shard, other: Shard, least: float, goal: float) -> np.ndarray:
    """Pairs that either shard's graph finds for the other's vectors, a bit each.

    A row is a vector of `other`; its bits are those of `one`. The two may be the same shard, whose
    pairs are then in both halves. The bits take an eighth of a byte a pair however many are set.
    """
    bits = np.zeros((len(other.ids), -(-len(one.ids) // 8)), np.uint8)
    # A little below the bound, for what single precision may lose.
    least -= 1e-5
    for graph, asking, turned in ((one.graph, other, False), (other.graph, one, True)):
        own = one is other
        if own and turned:
            break
        queries = asking.vectors.astype(np.float32)
        beam = audited(graph, queries, least, goal, own=own)
        for start, hit in graph.within(queries, least, beam):
            if own or not turned:
                bits[start : start + len(hit)] |= np.packbits(hit, axis=1)
            if own or turned:
                # A batch is a multiple of 8, so its columns fill whole bytes.
                packed = np.packbits(hit.T, axis=1)
                bits[:, start // 8 : start // 8 + packed.shape[1]] |= packed
    return bits


def _cell(one: Shard, other: Shard, least: float, goal: float) -> pd.DataFrame:
    """Links between the classes of two shards: rows linked to each class, and a forest of edges.

    All candidates are verified in double precision, a batch of rows at a time. Of the links only
    those go on that join two parts not joined before, so there are fewer than vectors.
    """
    bits, own, n = _candidates(one, other, least, goal), one is other, len(one.ids)
    ids = one.ids if own else np.concatenate([one.ids, other.ids])
    rows, part = np.zeros(len(ids), np.int64), np.arange(len(ids))
    base, from_, to = 0 if own else n, [], []
    for start in range(0, len(bits), _BATCH):
        near = np.unpackbits(bits[start : start + _BATCH], axis=1, count=n).astype(bool)
        if own:
            near[np.arange(len(near)), start + np.arange(len(near))] = False
        r, c = np.nonzero(near)
        for i in range(0, r.size, _PAIRS):
            x, y = r[i : i + _PAIRS], c[i : i + _PAIRS]
            near[x, y] = np.einsum("ij,ij->i", other.vectors[start + x], one.vectors[y]) >= least
        at = base + start
        rows[at : at + len(near)] += near @ one.rows
        if not own:
            rows[:n] += other.rows[start : start + len(near)] @ near
        for i in np.flatnonzero(near.any(axis=1)):
            met = np.flatnonzero(near[i])
            met = met[part[met] != part[at + i]]
            if met.size:
                parts, first = np.unique(part[met], return_index=True)
                from_.append(np.full(first.size, at + i))
                to.append(met[first])
                joined = np.zeros(len(ids), bool)
                joined[parts] = True
                part[joined[part]] = part[at + i]
    linked = np.flatnonzero(rows)
    counts = pd.DataFrame({"a": ids[linked], "b": None, "around": rows[linked]})
    if not from_:
        return counts
    edges = pd.DataFrame({"a": ids[np.concatenate(from_)], "b": ids[np.concatenate(to)], "around": 0})
    return pd.concat([counts.astype({"b": "Int64"}), edges.astype({"b": "Int64"})])


def links(classes: DataFrame, least: float = 0.93, shard: int = SHARD, goal: float = 0.999) -> DataFrame:
    """How the classes of a label are linked by cosines of `least` or more: rows `a`, `b`, `around`.

    `classes` has `label`, `class_id` (bigint), `rows` (bigint, what the class stands for) and
    `embedding` (array of double), no two classes of a label alike. Vectors of a label are dealt by
    hash to shards of about `shard`, each with a graph of its own, built once. Every shard's vectors
    ask every shard's graph: a task holds two shards, which ask each other. So each pair is met in
    one task, and the pairs themselves stay there. Where `b` is null, `around` counts rows of other
    classes linked to `a`, to be added up over all tasks; else `a` and `b` are linked, and these
    links connect whatever is connected.
    """
    sizes = classes.groupBy("label").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = classes.join(sizes, "label").withColumn(
        "part", F.pmod(F.xxhash64("class_id"), F.col("shards")).cast("int")
    )

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("class_id")
        vectors = _unit(_matrix(group["embedding"]))
        ids, rows = (group[c].to_numpy(np.int64) for c in ("class_id", "rows"))
        packed = Shard(Graph(vectors), ids, rows, vectors).pack()
        return pd.DataFrame(
            {"label": [key[0]], "part": [key[1]], "shards": [int(group["shards"].iloc[0])], "shard": [packed]}
        )

    kind = classes.schema["label"].dataType.simpleString()
    shards = stage(
        dealt.groupBy("label", "part").applyInPandas(build, f"label {kind}, part int, shards int, shard binary")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("with")
    cells = shards.select("label", "part", every, "shard").select(
        "label", F.least("part", "with").alias("one"), F.greatest("part", "with").alias("other"), "part", "shard"
    )

    def ask(group: pd.DataFrame) -> pd.DataFrame:
        met = [Shard.unpack(data) for data in group.sort_values("part")["shard"]]
        alone = group["one"].iloc[0] != group["other"].iloc[0] and len(met) < 2
        # A shard may be empty, and then has no row.
        return _NO_LINKS if alone else _cell(met[0], met[-1], least, goal)

    return cells.groupBy("label", "one", "other").applyInPandas(ask, "a long, b long, around long")


_NO_LINKS = pd.DataFrame({c: pd.Series(dtype="Int64") for c in ("a", "b", "around")})


def near_embeddings(
    embeddings: DataFrame, least: float = 0.93, shard: int = SHARD, goal: float = 0.999
) -> DataFrame:
    """Every vector with `n_links`, `component_id` and `kept`, by `vec_id`.

    Vectors are linked if their labels are equal and not null and their cosine is `least` or more.
    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and
    so do those of different lengths. Vectors alike in all components are one class, which is
    searched once; its members are linked with each other. `n_links` counts the other rows linked
    directly, `component_id` is the smallest id that links lead to, and `kept` says it is the row's
    own. Rows that share an id count as separate rows of that id; a null id is smaller than none and
    its component is null if nothing else is in it. Other columns are not read. An empty table
    gives none.
    """
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(vector, lambda x: x != 0)
    usable = F.coalesce(fine & F.col("label").isNotNull(), F.lit(False))
    rows = stage(
        embeddings.select(
            "vec_id",
            # One label for each length too; without one a vector is in no class.
            F.when(usable, F.concat_ws(":", F.col("label").cast("string"), F.size(vector))).alias("label"),
            F.when(usable, F.transform(vector, lambda x: x + F.lit(0.0))).alias("embedding"),
        )
    )
    sound = rows.where(F.col("label").isNotNull())
    key = [F.xxhash64("label", "embedding").alias("h1"), F.md5(F.to_json(F.struct("label", "embedding"))).alias("h2")]
    members = stage(sound.select("vec_id", *key))
    folded = sound.select("label", "embedding", *key).groupBy("h1", "h2").agg(
        F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"), F.count("*").alias("n")
    )
    classes = stage(folded.withColumn("class_id", F.monotonically_increasing_id()))
    found = stage(
        links(classes.select("label", "class_id", F.col("n").alias("rows"), "embedding"), least, shard, goal)
    )
    around = found.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("around").alias("around"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "class_id")
    known = (
        classes.select("h1", "h2", "class_id", "n")
        .join(around, "class_id", "left")
        .join(roots, "class_id", "left")
        .select(
            "h1",
            "h2",
            (F.col("n") - 1 + F.coalesce("around", F.lit(0))).alias("n_links"),
            F.coalesce("root", "class_id").alias("root"),
        )
    )
    placed = members.join(known, ["h1", "h2"])
    least_id = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = placed.join(least_id, "root").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("label").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
