"""SimHash near-duplicates with vantage-point trees.

Fingerprints are routed through trees of vantage points to shards, one tree for each half of the bits: of two
fingerprints at most RADIUS = 3 bits apart, one half is at most 1 bit apart. At each node those within the split distance
go inside, the others outside, and by the triangle inequality only inside ones closer to the split than that radius can
have partners outside, so these go both ways. Every pair then meets in some shard, which is searched exactly. The trees
of the driver are fit on a bounded sample; a shard that is still large gets a tree of its own, fit by a task.
"""

from __future__ import annotations

import functools
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew, delete_folder, if_small, shared_dir
from .components import connected

RADIUS = 3


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a text, as a signed integer; no words give 0."""
    split = (text or "").encode().lower().split()  # bytes: A-Z only, and white space as in common.SPACE
    if not split:
        return 0
    joined, lengths = b" ".join(split), np.fromiter(map(len, split), np.int64, len(split))
    stops = np.cumsum(lengths) + np.arange(len(split))
    n = max(1, len(split) - shingle + 1)
    starts, ends = (stops - lengths)[:n].tolist(), stops[-n:].tolist()
    one = xxhash.xxh64_intdigest
    return voted(np.fromiter((one(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)), np.uint64, n))


def voted(hashes: np.ndarray) -> int:
    """The fingerprint of some hashes: bits that are set in over half of them."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        votes += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (bigint) per input row, over the whole text; null text is empty."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.select("doc_id", fp("text").alias("fp"))


class Tree:
    """Vantage points and split distances in arrays; children below zero are shards. Distances are over the bits of mask."""

    def __init__(self, sample: np.ndarray, shards: int, mask: int, radius: int, seed: int = 7):
        self.point, self.split, self.inside, self.outside, self.shards = [], [], [], [], 0
        self.mask, self.radius = np.uint64(mask), radius
        self.rng = np.random.default_rng(seed)
        self.root = self._grow(np.unique(sample & self.mask), shards)

    def _grow(self, sample: np.ndarray, shards: int) -> int:
        best = None
        if shards > 1 and len(sample) >= 16:
            for v in self.rng.choice(sample, 8):
                d = np.bitwise_count(sample ^ v)
                for m in np.unique(np.quantile(d, [0.4, 0.5, 0.6], method="lower")):
                    inside, crossing = (d <= m).mean(), ((d > int(m) - self.radius) & (d <= m)).mean()
                    larger = max(inside, 1 - inside + crossing)
                    if larger < 0.8 and (best is None or larger + crossing < best[0]):
                        best = (larger + crossing, v, int(m), d)
        if best is None:
            self.shards += 1
            return -self.shards
        _, v, m, d = best
        at = len(self.point)
        self.point.append(v), self.split.append(m), self.inside.append(0), self.outside.append(0)
        self.inside[at] = self._grow(sample[d <= m], shards // 2)
        self.outside[at] = self._grow(sample[d > m], shards - shards // 2)
        return at

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into x and their shards; an x near a split appears more than once."""
        x = x & self.mask
        at, shard, todo = [], [], [(self.root, np.arange(len(x)))]
        while todo:
            node, i = todo.pop()
            if not len(i):
                continue
            if node < 0:
                at.append(i)
                shard.append(np.full(len(i), -node))
                continue
            d = np.bitwise_count(x[i] ^ self.point[node]).astype(int)
            todo.append((self.inside[node], i[d <= self.split[node]]))
            todo.append((self.outside[node], i[d > self.split[node] - self.radius]))
        return (np.concatenate(at), np.concatenate(shard)) if at else (np.empty(0, int), np.empty(0, int))


def stars(x: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Components of all x under links within radius, as (member, hub): one row for each member but the hub."""
    left, members, hubs = x, [], []
    while len(left):
        hub, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                queue.extend(found)
                members.append(found)
                hubs.append(np.full(len(found), hub))
    return (np.concatenate(members), np.concatenate(hubs)) if members else (np.empty(0, x.dtype), np.empty(0, x.dtype))


def _store(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


@functools.lru_cache(maxsize=32)
def _tree(folder: str, name: str) -> Tree:
    store, root = _store(folder)
    with store.open_input_file(f"{root}/{name}") as source:
        return pickle.loads(source.read())


def _crowded(routed: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    """keys, rows of the shards above block_rows."""
    return cut(routed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_rows))


def _subdivided(routed: DataFrame, crowded: DataFrame, halves: int, shard_rows: int, sample: int) -> DataFrame:
    """shard, sub, fp: crowded shards routed on through a tree of their own, fit on about sample of their rows."""
    session, bits = routed.sparkSession, 64 // halves
    folder = f"{shared_dir(session).rstrip('/')}/trees-{uuid.uuid4().hex}"
    known = if_small(crowded)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        x, shard = group["fp"].to_numpy().view(np.uint64), int(group["shard"].iloc[0])
        made = Tree(x, min(max(1, int(group["rows"].iloc[0]) // shard_rows), max(1, len(x) // 16)), ((1 << bits) - 1) << (bits * (shard >> 24)), RADIUS // halves)
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(pickle.dumps(made))
        return pd.DataFrame({"shard": [shard], "file": [name]})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (shard, name), rows in batch.groupby(["shard", "file"]):
                x = rows["fp"].to_numpy()
                at, sub = _tree(folder, name).route(x.view(np.uint64))
                yield pd.DataFrame({"shard": shard, "sub": sub, "fp": x[at]})

    drawn = F.pmod(F.xxhash64("fp", F.lit("sample")), F.ceil(F.col("rows") / sample)) == 0
    files = cut(routed.join(known, "shard").where(drawn).groupBy("shard").applyInPandas(fit, "shard long, file string"))
    salt = F.pmod(F.xxhash64("fp"), F.lit(64))
    inside = routed.join(if_small(files.withColumnRenamed("shard", "of")), F.col("shard") == F.col("of")).select("shard", "fp", "file").repartition("shard", salt).sortWithinPartitions("shard")
    # Shards without a tree, and a sample that drew nothing, stay as they are.
    rest = routed.join(if_small(files.select("shard")), "shard", "left_anti").select("shard", F.lit(0).cast("long").alias("sub"), "fp")
    made = cut(inside.mapInPandas(route, "shard long, sub long, fp long").unionAll(rest))
    delete_folder(session, folder)
    return made


def links(distinct: DataFrame, shard_rows: int = 4096, most_sample: int = 1 << 19, block_rows: int = 1 << 15, halves: int = 2, tree_sample: int = 1 << 16) -> DataFrame:
    """a, b: links that join the same fingerprints (column fp, distinct) as all pairs within RADIUS do.

    The driver's trees are fit on a sample by hash of an eighth of the fingerprints, at most most_sample, and those of
    shards above block_rows on about tree_sample each. What stays above block_rows then, as near copies can, is searched
    as pairs of blocks in tasks of their own.
    """
    session = distinct.sparkSession
    n = distinct.count()
    wanted = min(most_sample, n // 8)
    sample = [r["fp"] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(wanted).collect()] if wanted else []
    bits = 64 // halves
    trees = [Tree(np.array(sample, np.int64).view(np.uint64), min(max(1, n // shard_rows), max(1, wanted // 16)), ((1 << bits) - 1) << (bits * k), RADIUS // halves) for k in range(halves)]
    shared = session.sparkContext.broadcast(trees)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch["fp"].to_numpy()
            for k, tree in enumerate(shared.value):
                at, shard = tree.route(x.view(np.uint64))
                yield pd.DataFrame({"shard": shard + (k << 24), "fp": x[at]})

    routed = cut(distinct.select("fp").mapInPandas(route, "shard long, fp long"))
    crowded = _crowded(routed, ["shard"], block_rows)
    if crowded.isEmpty():
        routed = routed.withColumn("sub", F.lit(0).cast("long"))
        blocks = crowded.withColumn("sub", F.lit(0).cast("long"))
    else:
        routed = _subdivided(routed, crowded, halves, shard_rows, tree_sample)
        blocks = _crowded(routed, ["shard", "sub"], block_rows)
    blocks = blocks.select("shard", "sub", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks"))
    placed = routed.join(if_small(blocks), ["shard", "sub"], "left").withColumn("k", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    placed = placed.select("fp", "shard", "sub", "own", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    placed = placed.select("fp", "shard", "sub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        member, hub = stars(np.unique(group["fp"].to_numpy()).view(np.uint64))
        return pd.DataFrame({"a": member.view(np.int64), "b": hub.view(np.int64)})

    return placed.groupBy("shard", "sub", "i", "j").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per input row.

    Fingerprints at most RADIUS bits apart link; component_id is the smallest doc_id reachable. Empty and null texts
    share fingerprint zero. A null doc_id takes part but names no component (null if no other row does). Repeated rows
    each get their row. Only doc_id and text are read.
    """
    rows = cut(fingerprints(docs))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected(links(distinct, **limits)).select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id")).select(dealt_anew(F.col("root")).alias("r"), "component_id")
    of = rooted.select(dealt_anew(F.col("root")).alias("r"), "fp").join(named, "r").select(dealt_anew(F.col("fp")).alias("f"), "component_id")
    return rows.select(dealt_anew(F.col("fp")).alias("f"), "doc_id", "fp").join(of, "f").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of docs for each component: that of the smallest doc_id, and of the smallest text hash among equal ids.

    Rows are told apart by doc_id and fingerprint, so different texts under one id are judged one by one. A row with a
    null doc_id stays only where its component has no other. Of repeated rows one stays; an empty table gives none.
    """
    rows = cut(near_duplicates(docs.select("text", F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), F.col("doc_id").isNull().alias("nameless")).alias("doc_id"))).select("doc_id.*", "component_id"))
    order = F.struct("nameless", "doc_id", "t")
    kept = rows.groupBy("component_id").agg(F.min(order).alias("row")).select(F.col("row.doc_id").alias("kept_id"), F.col("row.t").alias("kept_t"))
    whole = docs.select(F.struct("*").alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    same = (F.col("t") == F.col("kept_t")) & F.col("row.doc_id").eqNullSafe(F.col("kept_id"))
    return whole.join(if_small(cut(kept)), same, "left_semi").groupBy("row.doc_id", "t").agg(F.first("row").alias("row")).select("row.*")
