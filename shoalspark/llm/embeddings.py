"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Equal vectors are one class. The classes of a label are dealt to shards of bounded size; each shard's graph is built once
and written to the shared folder, and a task for each pair of shards of a label reads one graph and queries it with the
other's vectors, so vectors are shuffled once. Beams widen until a recall audit against brute force passes; a query whose
beam is full of links is searched exactly. Cosines are verified in double precision.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew, delete_folder, if_small, shared_dir
from .components import connected

THRESHOLD, SHARD_ROWS, MOST_TASKS = 0.93, 16_384, 20_000


class Graph:
    """HNSW over unit vectors. Levels are built from the top; each enters from the one above, in batches."""

    def __init__(self, unit: np.ndarray, links: int = 12, beam: int = 48, seed: int = 3):
        self.x = unit.astype(np.float32)
        n = len(unit)
        height = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(16)).astype(int)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # nodes of a level, and neighbours as nodes or -1, from the top
        for level in range(int(height.max(initial=0)), -1, -1):
            self._grow(np.flatnonzero(height >= level), links * (2 if level == 0 else 1), beam)

    @classmethod
    def of_levels(cls, unit: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> Graph:
        """A graph that was built before."""
        made = cls.__new__(cls)
        made.x, made.levels = unit.astype(np.float32), levels
        return made

    def _grow(self, nodes: np.ndarray, links: int, beam: int) -> None:
        near = np.full((len(self.x), links), -1, np.int64)
        self.levels.append((nodes, near))
        step = 256
        for at in range(0, len(nodes), step):
            new = nodes[at : at + step]
            q = self.x[new]
            sims = q @ q.T
            np.fill_diagonal(sims, -2)
            k = min(links, len(new) - 1)
            mine = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k else np.empty((len(new), 0), int)
            ids, value = new[mine], np.take_along_axis(sims, mine, 1)
            if at:
                found, score = self._beam(q, self._enter(q, len(self.levels) - 1, nodes[0]), near, beam)
                ids, value = np.c_[ids, found], np.c_[value, score]
            order = np.argsort(-value, axis=1, kind="stable")
            ids, value = np.take_along_axis(ids, order, 1), np.take_along_axis(value, order, 1)
            self._link(near, new, *self._diverse(ids, value, max(2, links // 2)))

    def _diverse(self, ids: np.ndarray, value: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Of candidates by falling similarity, those nearer to the query than to what is chosen; then the nearest others."""
        rows, width = ids.shape
        width = min(width, 3 * most)
        ids, value = ids[:, :width], value[:, :width]
        v = self.x[np.maximum(ids, 0)]
        between = np.einsum("rid,rjd->rij", v, v)
        chosen, count = np.zeros((rows, width), bool), np.zeros(rows, int)
        for j in range(width):
            closest = np.where(chosen, between[:, j], -2).max(1)
            take = (ids[:, j] >= 0) & (count < most) & (value[:, j] > closest)
            chosen[:, j] = take
            count += take
        rank = np.argsort(~chosen, axis=1, kind="stable")[:, :most]
        return np.take_along_axis(ids, rank, 1), np.take_along_axis(value, rank, 1)

    def _link(self, near: np.ndarray, new: np.ndarray, ids: np.ndarray, value: np.ndarray) -> None:
        """Links both ways; a node with too many keeps the most similar."""
        near[new, : ids.shape[1]] = ids
        a, b = ids.ravel(), np.repeat(new, ids.shape[1])
        keep = a >= 0
        a, b = a[keep], b[keep]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        nodes, start, count = np.unique(a, return_index=True, return_counts=True)
        links = near.shape[1]
        for at in range(0, len(nodes), 1024):
            who, many = nodes[at : at + 1024], count[at : at + 1024]
            extra = np.full((len(who), int(many.max())), -1, np.int64)
            where = np.repeat(np.arange(len(who)), many)
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            extra[where, within] = b[start[at] : start[at] + many.sum()]
            held = near[who]
            extra[(extra[:, :, None] == held[:, None, :]).any(2)] = -1
            both = np.c_[held, extra]
            score = np.where(both >= 0, np.einsum("rd,rmd->rm", self.x[who], self.x[np.maximum(both, 0)]), -3)
            best = np.argsort(-score, axis=1, kind="stable")[:, :links]
            near[who] = np.take_along_axis(both, best, 1)

    def _enter(self, q: np.ndarray, levels: int, first: int) -> np.ndarray:
        entry = np.full(len(q), self.levels[0][0][0] if levels else first)
        for _, near in self.levels[:levels]:
            entry = self._beam(q, entry, near, 4)[0][:, 0]
        return entry

    def _beam(self, q: np.ndarray, entry: np.ndarray, near: np.ndarray, width: int, together: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The width nearest nodes that a beam search from entry finds for each query, nearest first, -1 where fewer."""
        rows = len(q)
        seen = np.zeros((rows, len(self.x)), bool)
        r = np.arange(rows)
        seen[r, entry] = True
        ids, score, done = np.full((rows, width), -1, np.int64), np.full((rows, width), -3, np.float32), np.ones((rows, width), bool)
        ids[:, 0], score[:, 0], done[:, 0] = entry, np.einsum("rd,rd->r", q, self.x[entry]), False
        live = r
        together = min(together, width)
        while len(live):
            waiting = np.where(done[live], -4, score[live])
            pick = np.argsort(-waiting, axis=1, kind="stable")[:, :together]
            valid = np.take_along_axis(waiting, pick, 1) > -3
            some = valid.any(1)
            live, pick, valid = live[some], pick[some], valid[some]
            if not len(live):
                break
            here = np.where(valid, ids[live[:, None], pick], -1)
            done[live[:, None], pick] = True
            next_ids = np.where(here[:, :, None] >= 0, near[np.maximum(here, 0)], -1).reshape(len(live), -1)
            fresh = (next_ids >= 0) & ~seen[live[:, None], np.maximum(next_ids, 0)]
            order = np.sort(np.where(fresh, next_ids, np.iinfo(np.int64).max), axis=1)  # a node may be next to several
            once = np.append(np.ones((len(live), 1), bool), order[:, 1:] != order[:, :-1], axis=1) & (order < np.iinfo(np.int64).max)
            next_ids = np.where(once, order, -1)
            a, b = np.nonzero(once)
            seen[live[a], next_ids[a, b]] = True
            value = np.full(next_ids.shape, -3, np.float32)
            value[a, b] = np.einsum("rd,rd->r", q[live[a]], self.x[next_ids[a, b]])
            all_ids, all_score, all_done = np.c_[ids[live], next_ids], np.c_[score[live], value], np.c_[done[live], ~once]
            best = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
            ids[live], score[live], done[live] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_score, best, 1), np.take_along_axis(all_done, best, 1)
        return ids, score

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        q = q.astype(np.float32)
        return self._beam(q, self._enter(q, len(self.levels) - 1, self.levels[0][0][0]), self.levels[-1][1], width)


def shard_links(index: np.ndarray, queries: np.ndarray, threshold: float = THRESHOLD, recall: float = 0.98, audit: int = 256, chunk: int = 256, own: bool = False, enough: int = 64, graph: Graph | None = None) -> list[np.ndarray]:
    """For each query the indices of unit vectors in index with cosine at threshold or more, as far as found.

    A query whose beam ends full of links may have more, and all of index is searched for it. Other queries have only what
    their beam finds, so they alone are audited: probes are drawn, audit at a time, until enough of them have links, and
    held against brute force; beams double until recall passes. Where a quarter of the queries does not hold enough
    probes, or a beam as wide as index fails, everything is searched exactly. With own, index and queries are the same
    vectors, and no link of a vector to itself counts for the recall.
    """

    def exact(q: np.ndarray) -> list[np.ndarray]:
        return [np.flatnonzero(row >= threshold) for at in range(0, len(q), chunk) for row in q[at : at + chunk] @ index.T]

    graph = graph or Graph(index)
    slack = threshold - 1e-4  # the graph holds single precision

    def found(q: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
        ids, score = graph.search(q, width)
        close = score >= slack
        rows, at = np.nonzero(close)
        near = ids[rows, at]
        good = np.einsum("rd,rd->r", index[near], q[rows]) >= threshold
        hits = np.split(near[good], np.cumsum(np.bincount(rows[good], minlength=len(q)))[:-1])
        full = close.all(1)
        for k, hit in zip(np.flatnonzero(full), exact(q[full]), strict=True):
            hits[k] = hit
        return hits, full

    def others(hits: list[np.ndarray], probes: np.ndarray) -> np.ndarray:
        return np.array([int((h != p).sum()) if own else len(h) for h, p in zip(hits, probes, strict=True)], int)

    order, width = np.random.default_rng(5).permutation(len(queries)), min(32, len(index))
    while True:
        held = linked = truth = at = 0
        while linked < enough:
            if at >= len(queries) / 4:
                return exact(queries)
            probes = order[at : at + audit]
            hits, full = found(queries[probes], width)
            probes, hits = probes[~full], [h for h, f in zip(hits, full, strict=True) if not f]
            due = others(exact(queries[probes]), probes)
            held, linked, truth, at = held + others(hits, probes).sum(), linked + (due > 0).sum(), truth + due.sum(), at + audit
        if held >= recall * truth:
            return [hit for at in range(0, len(queries), chunk) for hit in found(queries[at : at + chunk], width)[0]]
        if width == len(index):
            return exact(queries)
        width = min(2 * width, len(index))


def _hubs(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches by the links a-b."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _store(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def _build(group: pd.DataFrame, folder: str) -> pd.DataFrame:
    """Writes a shard's unit vectors, nodes, copies and graph as one file, whose name tells the attempt, and returns it."""
    group = group.sort_values("node")
    x = np.array(group["vector"].tolist(), np.float64)
    x /= np.sqrt((x * x).sum(1))[:, None]
    arrays = {"x": x, "node": group["node"].to_numpy(), "copies": group["copies"].to_numpy()}
    for k, (nodes, near) in enumerate(Graph(x).levels):
        arrays |= {f"nodes{k}": nodes.astype(np.int32), f"near{k}": near.astype(np.int32)}
    made = io.BytesIO()
    np.savez(made, **arrays)
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.npz"
    with store.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(made.getvalue())
    return group.iloc[:1][["label", "d", "shard"]].assign(file=name)


def _load(folder: str, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph]:
    store, root = _store(folder)
    with store.open_input_file(f"{root}/{name}") as source, np.load(io.BytesIO(source.read())) as a:
        levels = [(a[f"nodes{k}"].astype(np.int64), a[f"near{k}"].astype(np.int64)) for k in range(sum(n.startswith("nodes") for n in a.files))]
        return a["x"], a["node"], a["copies"], Graph.of_levels(a["x"], levels)


def _pair(folder: str, first: str, second: str, threshold: float) -> pd.DataFrame:
    """node, links, hub of the vectors of one shard, or of two linked with each other; links are counted in vectors."""
    x, node, copies, _ = _load(folder, first)
    y, node_y, copies_y, graph = _load(folder, second)
    own = first == second
    hits = shard_links(y, x, threshold, own=own, graph=graph)
    a, b = np.repeat(np.arange(len(x)), [len(h) for h in hits]), np.concatenate(hits) if hits else np.empty(0, int)
    if own:  # found from either end
        low, high = np.minimum(a, b), np.maximum(a, b)
        pair = np.unique(low[low != high] * len(x) + high[low != high])
        a, b = pair // len(x), pair % len(x)
    else:
        b, node, copies = b + len(x), np.append(node, node_y), np.append(copies, copies_y)
    links = np.zeros(len(node), np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    hub, some = _hubs(len(node), a, b), links > 0
    return pd.DataFrame({"node": node[some], "links": links[some], "hub": node[hub[some]]})


def _usable(label: Column, v: Column) -> Column:
    return F.coalesce(label.isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept per input row.

    Vectors link only within a label and a length. Null labels, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing and are their own component. A null vec_id takes part but names no component
    and is not kept. Repeated rows, and rows that share an id or a vector alone, are vectors of their own. An empty table
    gives no rows. Other columns are not read.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    # Equal vectors are told by 128 bits of hash, so that no join carries vectors.
    hashes = [F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit("second"), F.col("label"), "v").alias("h2")]
    usable = rows.where(_usable(F.col("label"), F.col("v"))).select("vec_id", "label", "v", *hashes)
    classes = cut(usable.groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")))
    # A class goes by its smallest id; of classes that share one, all but the first by a negative hash.
    owner = classes.where("least is not null").groupBy("least").agg(F.min(F.struct("h1", "h2")).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").select(dealt_anew(F.col("least").cast("long")).alias("l"), "owner")
    named = classes.withColumn("l", dealt_anew(F.col("least").cast("long"))).join(if_small(cut(owner)), "l", "left")
    own = F.col("least").isNotNull() & (F.col("owner").isNull() | ((F.col("owner.h1") == F.col("h1")) & (F.col("owner.h2") == F.col("h2"))))
    node = F.when(own, F.col("least")).otherwise(-F.shiftrightunsigned("h1", 1) - 1).cast("long")
    classes = cut(named.select("h1", "h2", "label", F.size("v").alias("d"), "v", node.alias("node"), "least", "copies"))
    sizes = cut(classes.groupBy("label", "d").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("k")))
    per = sizes.select(dealt_anew(F.col("label").cast("long")).alias("l"), F.col("d").alias("of"), "k")
    dealt = classes.join(if_small(per), (dealt_anew(F.col("label").cast("long")) == F.col("l")) & (F.col("d") == F.col("of")))
    dealt = dealt.select("label", "d", F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("shard"), "node", F.col("v").alias("vector"), "copies")
    count = sizes.agg(F.sum("k"), F.sum(F.expr("cast(k as long) * (k + 1) div 2"))).first()
    folder = f"{shared_dir(vectors.sparkSession).rstrip('/')}/graphs-{uuid.uuid4().hex}"
    kind = vectors.schema["label"].dataType.simpleString()
    # Shards and pairs of them cost time, not bytes, so by size they would be put together in few tasks.
    shards = cut(dealt.repartition(min(4 * (count[0] or 1), MOST_TASKS), "label", "d", "shard").groupBy("label", "d", "shard").applyInPandas(lambda g: _build(g, folder), f"label {kind}, d int, shard int, file string"))
    left, right = shards.select("label", "d", F.col("shard").alias("i"), F.col("file").alias("first")), shards.select(F.col("label").alias("m"), F.col("d").alias("e"), F.col("shard").alias("j"), F.col("file").alias("second"))
    pairs = left.join(right, (F.col("label") == F.col("m")) & (F.col("d") == F.col("e")) & (F.col("i") <= F.col("j"))).select("first", "second")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, second in zip(batch["first"], batch["second"], strict=True):
                yield _pair(folder, first, second, threshold)

    found = cut(pairs.repartition(min(4 * (count[1] or 1), MOST_TASKS), "first", "second").mapInPandas(search, "node long, links long, hub long"))
    delete_folder(vectors.sparkSession, folder)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(found, "node", "hub").withColumnsRenamed({"node": "n"})
    of = classes.drop("v").join(counts, "node", "left").join(roots, F.col("node") == F.col("n"), "left").select("h1", "h2", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    of = cut(of)
    named = of.groupBy("root").agg(F.min("least").alias("component_id")).select(dealt_anew(F.col("root")).alias("r"), "component_id")
    of = of.withColumn("r", dealt_anew(F.col("root"))).join(named, "r").select(dealt_anew(F.col("h1")).alias("a"), F.col("h2").alias("b"), (F.col("copies") - 1 + F.col("links")).cast("long").alias("n_links"), "component_id")
    # Computed hashes, so that both sides are dealt anew and a vector in very many rows can be split.
    linked = usable.select("vec_id", dealt_anew(F.col("h1")).alias("a"), F.col("h2").alias("b")).join(of, ["a", "b"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~_usable(F.col("label"), F.col("v"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
