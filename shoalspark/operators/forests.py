"""Boosted regression trees of all tiles at once.

Every tile has a model for each fold of its spatial cross-validation and for each refit. They grow together, a level at a
time: tasks add gradients up by tile, model, node, feature and bin, one aggregation joins these histograms, and the best
split of each node comes from their running sums. No tile is gathered, so one tile may hold most rows. The driver holds the
trees alone; tiles are trained in groups whose trees fit a bound.

Rows lie in blocks of arrays, whatever their tiles, so a pass over them makes no object of a row. Rows of a block with one
tile and equal bins share a cell, for which leaves and predictions are worked out once. A pass adds the trees that have grown
since predictions were last written; they are written every few rounds.

The trees follow the usual second-order rules for squared error: a node's value is the sum of residuals over rows plus l2,
a split gains the difference of squared sums over rows plus l2, and splits that gain less than gamma go, from below.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lineage import cut


@dataclass(frozen=True)
class Growth:
    """How trees grow. rounds bounds the rounds of a fold; default_rounds holds where a tile has fewer than two folds."""

    depth: int = 4
    rate: float = 0.01
    gamma: float = 1.0
    l2: float = 1.0
    least_rows: float = 1.0
    rounds: int = 1000
    default_rounds: int = 100
    patience: int = 10
    row_share: float = 0.7
    feature_share: float = 0.8
    bins: int = 64
    seed: int = 1


@dataclass
class Tree:
    """Node -> (feature, bin, gain, sum and rows to the left, sum and rows to the right); children of n are 2n and 2n + 1."""

    splits: dict[int, tuple] = field(default_factory=dict)
    total: tuple[float, float] = (0.0, 0.0)

    def pruned(self, gamma: float) -> Tree:
        kept = dict(self.splits)
        for node in sorted(self.splits, reverse=True):
            if kept[node][2] < gamma and 2 * node not in kept and 2 * node + 1 not in kept:
                del kept[node]
        return Tree(kept, self.total)

    def values(self, l2: float) -> dict[int, float]:
        """Leaf -> value."""
        sums = {1: self.total}
        for node, (_, _, _, gl, hl, gr, hr) in self.splits.items():
            sums[2 * node], sums[2 * node + 1] = (gl, hl), (gr, hr)
        return {n: g / (h + l2) for n, (g, h) in sums.items() if n not in self.splits}


def chance(ids: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for each id, by mixing bits; equal in all runs."""
    h = ids.astype(np.uint64)
    for s in (*salt, 0):
        h = (h + np.uint64((s * 2 + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype(float) / (1 << 53)


def chosen_features(count: int, model: int, turn: int, how: Growth) -> np.ndarray:
    """The features that a tree of a refit may split on, at least one."""
    return np.sort(np.argsort(chance(np.arange(count), how.seed, model, turn, 7), kind="stable")[: max(1, int(count * how.feature_share))])


def binned_rows(rows: DataFrame, tile: str, row_id: str, features: list[str], target: str, fold: str, bins: int) -> tuple[DataFrame, DataFrame]:
    """State (tile, id, y, fold, bins) and edges (tile, feature, least, width) over the rows without nulls in features and target.

    A feature has bins of equal width from its least to its largest value in the tile; a feature with one value has one.
    """
    good = rows.dropna(subset=[*features, target]).where(F.col(tile).isNotNull())
    spans = cut(good.groupBy(tile).agg(*[f(c).cast("double").alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("lo", F.min), ("hi", F.max))]))
    small = spans.withColumnRenamed(tile, "of")
    joined = good.join(F.broadcast(small) if small.count() <= 100_000 else small, F.col(tile) == F.col("of"))
    place = [F.least(F.floor((F.col(c) - F.col(f"lo{i}")) * bins / F.nullif(F.col(f"hi{i}") - F.col(f"lo{i}"), F.lit(0.0))), F.lit(bins - 1)) for i, c in enumerate(features)]
    state = joined.select(F.col(tile).cast("string").alias("tile"), F.col(row_id).cast("long").alias("id"), F.col(target).cast("double").alias("y"), F.coalesce(F.col(fold).cast("int"), F.lit(-1)).alias("fold"), F.array(*[F.coalesce(p, F.lit(0)).cast("short") for p in place]).alias("bins"))
    edges = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"lo{i}").alias("least"), ((F.col(f"hi{i}") - F.col(f"lo{i}")) / bins).alias("width")) for i, c in enumerate(features)]))
    return state, spans.select(F.col(tile).cast("string").alias("tile"), edges.alias("e")).select("tile", "e.*")


BLOCK = "names array<string>, id binary, y binary, fold binary, cell binary, code binary, bins binary, pred binary"
#: Rows of a block and of a task. Predictions are written when so many rounds, or more than so many splits, are pending.
BLOCK_ROWS, TASK_ROWS, HELD_TURNS, HELD_SPLITS = 1 << 17, 1 << 21, 8, 200_000
#: Stands for a null id in blocks.
NO_ID = -(1 << 63)


@dataclass
class Block:
    """Rows and cells of some tiles: the tiles' names, each row's id, target, fold and cell, and each cell's tile, bins (a row a feature) and predictions (a row a model)."""

    names: list[str]
    id: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    cell: np.ndarray
    code: np.ndarray
    bins: np.ndarray
    pred: np.ndarray

    @property
    def tiles(self) -> np.ndarray:
        """Each row's tile."""
        return self.code[self.cell]

    def frame(self, pred: np.ndarray) -> pd.DataFrame:
        """As a row, with such predictions."""
        arrays = self.id, self.y, self.fold, self.cell, self.code, self.bins, pred
        return pd.DataFrame([[self.names, *(x.tobytes() for x in arrays)]], columns=["names", "id", "y", "fold", "cell", "code", "bins", "pred"])

    def part(self, kept: set[str]) -> Block:
        """The rows of some tiles, without predictions."""
        own = np.array([n in kept for n in self.names])
        if own.all():
            return self
        cells = own[self.code]
        rows = cells[self.cell]
        return Block([n for n, k in zip(self.names, own, strict=True) if k], self.id[rows], self.y[rows], self.fold[rows], (np.cumsum(cells) - 1).astype(np.int32)[self.cell[rows]], (np.cumsum(own) - 1).astype(np.int32)[self.code[cells]], self.bins[:, cells], np.empty((0, int(cells.sum()))))


def _joined(parts: list[Block]) -> Block:
    """One block of the rows of all parts, without predictions."""
    if len(parts) == 1:
        return parts[0]
    number: dict[str, int] = {}
    code = np.concatenate([np.array([number.setdefault(n, len(number)) for n in p.names], np.int32)[p.code] for p in parts])
    bins = np.concatenate([p.bins for p in parts], 1)
    ahead = np.cumsum([0, *[len(p.code) for p in parts]])
    cell = code.astype(np.int64)
    for b in bins:
        cell = pd.factorize((cell << 16) | b)[0].astype(np.int64)
    _, first = np.unique(cell, return_index=True)
    row_cell = cell[np.concatenate([p.cell.astype(np.int64) + k for p, k in zip(parts, ahead, strict=False)])].astype(np.int32)
    rest = [np.concatenate([getattr(p, a) for p in parts]) for a in ("id", "y", "fold")]
    return Block(list(number), *rest, row_cell, code[first], bins[:, first], np.empty((0, len(first))))


def _even(parts: Iterator[Block]) -> Iterator[Block]:
    """Blocks of about BLOCK_ROWS rows."""
    held, rows = [], 0
    for p in parts:
        held.append(p)
        rows += len(p.y)
        if rows >= BLOCK_ROWS:
            yield _joined(held)
            held, rows = [], 0
    if rows:
        yield _joined(held)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
    for batch in batches:
        for names, row_id, y, fold, cell, code, bins, pred in batch.itertuples(index=False, name=None):
            n = len(code) // 4
            yield Block(list(names), np.frombuffer(row_id, np.int64), np.frombuffer(y), np.frombuffer(fold, np.int32), np.frombuffer(cell, np.int32), np.frombuffer(code, np.int32), np.frombuffer(bins, np.int16).reshape(-1, n), np.frombuffer(pred).reshape(-1, n))


def _packed(state: DataFrame, features: int) -> DataFrame:
    """state in blocks, without predictions, dealt to tasks of TASK_ROWS rows or less."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
        for batch in batches:
            code, names = pd.factorize(batch["tile"])
            bins = np.stack([batch[f"b{i}"].to_numpy(np.int16) for i in range(features)])
            rows = batch["id"].to_numpy(np.int64), batch["y"].to_numpy(float), batch["fold"].to_numpy(np.int32), np.arange(len(batch), dtype=np.int32)
            yield Block(list(names), *rows, code.astype(np.int32), bins, np.empty((0, len(batch))))

    def packs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _even(parts(batches)):
            yield b.frame(b.pred)

    flat = state.select("tile", F.coalesce("id", F.lit(NO_ID)).alias("id"), "y", "fold", *[F.get("bins", F.lit(i)).alias(f"b{i}") for i in range(features)])
    made = cut(flat.mapInPandas(packs, BLOCK))
    count = made.agg(F.sum(F.octet_length("y") / 8).alias("rows"), F.count(F.lit(1)).alias("blocks")).first()
    tasks = min(max(3 * state.sparkSession.sparkContext.defaultParallelism, int(count["rows"] or 0) // TASK_ROWS), count["blocks"])
    return cut(made.repartition(tasks)) if made.rdd.getNumPartitions() < tasks else made


def _summed(key: np.ndarray, size: int, *weights: np.ndarray | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The keys below size that occur, and for each of weights its sums over them (None: their counts)."""
    if size > 4 * len(key) + 1024:
        some, key = np.unique(key, return_inverse=True)
        return some, [np.bincount(key, w, len(some)) for w in weights]
    rows = np.bincount(key, minlength=size)
    some = np.flatnonzero(rows)
    return some, [(rows if w is None else np.bincount(key, w, size))[some] for w in weights]


@dataclass
class Grove:
    """One model's trees of a block's tiles as arrays: feature (-1: a leaf), last bin to the left and value at each node."""

    feature: np.ndarray
    last: np.ndarray
    value: np.ndarray
    there: np.ndarray
    depth: int

    @classmethod
    def of(cls, trees: list[Tree | None], how: Growth, valued: bool) -> Grove:
        depth = max((max(t.splits).bit_length() for t in trees if t and t.splits), default=0)
        shape = len(trees), 2 << depth
        made = cls(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape), np.array([t is not None for t in trees]), depth)
        for k, tree in enumerate(trees):
            for node, split in (tree.splits if tree else {}).items():
                made.feature[k, node], made.last[k, node] = split[:2]
            if tree and valued:
                for node, v in tree.values(how.l2).items():
                    made.value[k, node] = v
        return made

    def leaves(self, b: Block) -> np.ndarray:
        """The leaf that each cell comes to."""
        at, across = np.ones(len(b.code), np.int32), np.arange(len(b.code))
        base = b.code * self.feature.shape[1]
        feature, last = self.feature.ravel(), self.last.ravel()
        for _ in range(self.depth):
            f = feature.take(base + at)
            right = b.bins[np.maximum(f, 0), across] > last.take(base + at)
            at = np.where(f < 0, at, 2 * at + right)
        return at

    def values(self, b: Block) -> np.ndarray:
        return self.value[b.code, self.leaves(b)]


def _predicted(b: Block, model: int, pending: list[dict], how: Growth) -> np.ndarray:
    """One model's prediction of each cell, with the pending trees."""
    pred = b.pred[model].copy()
    for trees in pending:
        own = [trees.get(n, {}).get(model) for n in b.names]
        if any(own):
            pred += how.rate * Grove.of(own, how, True).values(b)
    return pred


@dataclass
class State:
    """Blocks with predictions of so many models, and the trees grown since those were written."""

    blocks: DataFrame
    models: int
    pending: list[dict] = field(default_factory=list)

    def send(self, *more):
        return self.blocks.sparkSession.sparkContext.broadcast((self.pending, *more))

    def added(self, trees: dict, how: Growth) -> State:
        """With another round of trees."""
        now = State(self.blocks, self.models, [*self.pending, trees])
        if len(now.pending) < HELD_TURNS and sum(len(t.splits) for turn in now.pending for own in turn.values() for t in own.values()) <= HELD_SPLITS:
            return now
        sent = now.send()

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in _blocks(batches):
                yield b.frame(np.stack([_predicted(b, m, sent.value[0], how) for m in range(len(b.pred))]))

        return State(cut(now.blocks.mapInPandas(add, BLOCK)), self.models)


def _members(b: Block, model: int, turn: int, folded: bool, how: Growth) -> np.ndarray:
    """The rows that a tree grows on: for a fold all others, for a refit a share by chance."""
    if folded:
        return b.fold != model
    return chance(b.id, how.seed, model, turn) < how.row_share


def _level(state: State, trees: dict, depth: int, turn: int, folded: bool, features: int, how: Growth) -> list:
    """The best split of each node at a depth that has one: rows of tile, model, node, feature, bin, gain and sums."""
    sent = state.send(trees)

    def histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending, grown = sent.value
        for b in _blocks(batches):
            names = np.array(b.names, object)
            for model in sorted({m for n in b.names for m in grown.get(n, {})}):
                grove = Grove.of([grown.get(n, {}).get(model) for n in b.names], how, False)
                use = np.flatnonzero(_members(b, model, turn, folded, how))
                own = b.cell[use]
                count, total = np.bincount(own, minlength=len(b.code)), np.bincount(own, b.y[use], len(b.code))
                at = grove.leaves(b)
                live = np.flatnonzero(grove.there[b.code] & (at >= 1 << depth) & (count > 0))
                count = count[live].astype(float)
                rest = total[live] - count * _predicted(b, model, pending, how)[live]
                where = (b.code[live].astype(np.int64) << depth) + (at[live] - (1 << depth))
                for f in range(features) if folded else chosen_features(features, model, turn, how):
                    some, (rows, sums) = _summed(where * how.bins + b.bins[f, live], len(names) * how.bins << depth, count, rest)
                    node = some // how.bins
                    yield pd.DataFrame({"tile": names[node >> depth], "model": model, "node": (node & ((1 << depth) - 1)) + (1 << depth), "feature": int(f), "bin": some % how.bins, "g": sums, "h": rows})

    made = state.blocks.mapInPandas(histograms, "tile string, model int, node int, feature int, bin int, g double, h double")
    sums = made.groupBy("tile", "model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    # A node has features times bins rows at most.
    by = Window.partitionBy("tile", "model", "node", "feature")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sums.select("tile", "model", "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"), F.sum("g").over(by).alias("g"), F.sum("h").over(by).alias("h"))
    part = lambda g, h: g * g / (h + how.l2)
    g, h, gl, hl = map(F.col, ("g", "h", "gl", "hl"))
    gain = F.round(part(gl, hl) + part(g - gl, h - hl) - part(g, h), 9)
    enough = (hl >= how.least_rows) & (h - hl >= how.least_rows)
    best = F.max(F.when(enough, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", (g - gl).alias("gr"), (h - hl).alias("hr"))))
    rows = run.groupBy("tile", "model", "node").agg(best.alias("best"), F.max_by("g", -F.col("feature")).alias("g"), F.max("h").alias("h")).collect()
    sent.unpersist()
    return rows


def _grown(state: State, live: dict[str, list[int]], turn: int, folded: bool, features: int, how: Growth) -> dict[str, dict[int, Tree]]:
    """A tree for each live model of each tile."""
    trees = {tile: {m: Tree() for m in models} for tile, models in live.items()}
    for depth in range(how.depth):
        any_split = False
        for r in _level(state, trees, depth, turn, folded, features, how):
            tree, best = trees[r["tile"]][r["model"]], r["best"]
            if depth == 0:
                tree.total = r["g"], r["h"]
            if best is not None and best["gain"] > 1e-6:
                tree.splits[r["node"]] = (-best["f"], -best["b"], best["gain"], best["gl"], best["hl"], best["gr"], best["hr"])
                any_split = True
        if not any_split:
            break
    return {tile: {m: t.pruned(how.gamma) for m, t in own.items()} for tile, own in trees.items()}


def _errors(state: State, live: dict[str, list[int]], how: Growth) -> dict[tuple[str, int], tuple[float, float]]:
    """Root mean squared and mean absolute error of each live fold's model on the fold's own rows."""
    sent = state.send(live)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending, folds = sent.value
        for b in _blocks(batches):
            names = np.array(b.names, object)
            for m in sorted({m for n in b.names for m in folds.get(n, ())}):
                own = np.flatnonzero(b.fold == m)
                cell = b.cell[own]
                there = np.array([m in folds.get(n, ()) for n in b.names])[b.code[cell]]
                own, cell = own[there], cell[there]
                e = b.y[own] - _predicted(b, m, pending, how)[cell]
                some, (rows, squares, sizes) = _summed(b.code[cell], len(names), None, e * e, np.abs(e))
                yield pd.DataFrame({"tile": names[some], "fold": m, "n": rows, "squares": squares, "sizes": sizes})

    made = state.blocks.mapInPandas(sums, "tile string, fold int, n long, squares double, sizes double")
    rows = made.groupBy("tile", "fold").agg(F.sqrt(F.sum("squares") / F.sum("n")).alias("rmse"), (F.sum("sizes") / F.sum("n")).alias("mae")).collect()
    sent.unpersist()
    return {(r["tile"], r["fold"]): (r["rmse"], r["mae"]) for r in rows}


def _started(blocks: DataFrame, means: dict[str, float], models: int, tiles: set[str]) -> State:
    """The rows of some tiles, with the tile's mean as every model's first prediction."""
    sent = blocks.sparkSession.sparkContext.broadcast((means, tiles))

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
        kept = sent.value[1]
        for b in _blocks(batches):
            b = b.part(kept)
            if len(b.y):
                yield b

    def begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _even(start(batches)):
            yield b.frame(np.tile(np.array([sent.value[0][n] for n in b.names])[b.code], (models, 1)))

    return State(cut(blocks.mapInPandas(begun, BLOCK)), models)


def validated(blocks: DataFrame, means: dict[str, float], folds: dict[str, list[int]], features: int, how: Growth) -> list[dict]:
    """Rounds of each tile and the errors of its folds there: folds grow until patience rounds bring no better error."""
    models = 1 + max((max(f) for f in folds.values() if f), default=0)
    best: dict[tuple[str, int], tuple[int, tuple]] = {}
    live = {tile: list(own) for tile, own in folds.items() if len(own) > 1}
    now = _started(blocks, means, models, set(live)) if live else None
    for turn in range(how.rounds):
        if not live:
            break
        now = now.added(_grown(now, live, turn, True, features, how), how)
        errors = _errors(now, live, how)
        for tile, own in list(live.items()):
            for m in list(own):
                error = errors[tile, m]
                if (tile, m) not in best or error[0] < best[tile, m][1][0]:
                    best[tile, m] = turn, error
                elif turn - best[tile, m][0] >= how.patience:
                    own.remove(m)
            if not own:
                del live[tile]
    found = []
    for tile, own in folds.items():
        done = [best[tile, m] for m in own if (tile, m) in best and best[tile, m][0] > 0]
        spread = lambda k, done=done: (float(np.mean([e[k] for _, e in done])), float(np.std([e[k] for _, e in done]))) if done else (None, None)
        rounds = int(np.mean([t for t, _ in done])) if done else how.default_rounds
        found.append({"tile": tile, "rounds": rounds, **dict(zip(("rmse", "rmse_sd", "mae", "mae_sd"), (*spread(0), *spread(1)), strict=True))})
    return found


def _spans(blocks: DataFrame) -> DataFrame:
    """tile, fold, least and largest target, sum and rows."""

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _blocks(batches):
            own = pd.DataFrame({"code": b.tiles, "fold": b.fold, "y": b.y}).groupby(["code", "fold"])["y"].agg(["min", "max", "sum", "count"]).reset_index()
            yield own.assign(tile=np.array(b.names, object)[own.pop("code")])[["tile", "fold", "min", "max", "sum", "count"]]

    made = blocks.mapInPandas(spans, "tile string, fold int, min double, max double, sum double, count long")
    return made.groupBy("tile", "fold").agg(F.min("min").alias("lo"), F.max("max").alias("hi"), F.sum("sum").alias("sum"), F.sum("count").alias("rows"))


def _predictions(state: State, how: Growth) -> DataFrame:
    """tile, id, actual, mean and sd over the models."""
    sent = state.send()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _blocks(batches):
            pred = np.stack([_predicted(b, m, sent.value[0], how) for m in range(len(b.pred))])
            yield pd.DataFrame({"tile": np.array(b.names, object)[b.tiles], "id": b.id, "actual": b.y, "mean": pred.mean(0)[b.cell], "sd": pred.std(0)[b.cell]})

    made = state.blocks.mapInPandas(rows, "tile string, id long, actual double, mean double, sd double")
    return made.withColumn("id", F.nullif("id", F.lit(NO_ID)))


def _fits(state: State, means: dict[str, float], how: Growth) -> DataFrame:
    """tile, replicate, rmse and r2."""
    sent = state.send(means)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending, mean = sent.value
        for b in _blocks(batches):
            names, tiles = np.array(b.names, object), b.tiles
            away = b.y - np.array([mean[n] for n in b.names])[tiles]
            for m in range(len(b.pred)):
                e = b.y - _predicted(b, m, pending, how)[b.cell]
                some, (n, squares, s, q) = _summed(tiles, len(names), None, e * e, away, away * away)
                yield pd.DataFrame({"tile": names[some], "replicate": m, "n": n, "squares": squares, "s": s, "q": q})

    made = state.blocks.mapInPandas(sums, "tile string, replicate int, n long, squares double, s double, q double")
    n, squares = F.sum("n"), F.sum("squares")
    return made.groupBy("tile", "replicate").agg(F.sqrt(squares / n).alias("rmse"), (1 - F.try_divide(squares, F.sum("q") - F.sum("s") * F.sum("s") / n)).alias("r2"))


def trained(rows: DataFrame, tile: str, row_id: str, features: list[str], target: str, fold: str, refits: int = 20, how: Growth | None = None, bound: int = 2_000_000) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Validation, importance, predictions and fit of boosted trees for every tile.

    Validation has tile, rounds, rmse, rmse_sd, mae and mae_sd over its folds; a fold counts if it has two different targets
    or more. Importance has tile, feature, replicate and gain, the mean over the splits on the feature (features without one
    are absent). Predictions have tile, id, actual, mean and sd over the refits, which differ in the rows and features that
    their trees see. Fit has tile, replicate, rmse and r2. Rows with a null tile, feature or target are left out; rows of a
    null fold train all folds. row_id should be unique. Tiles are trained in groups of at most bound splits in a round.
    """
    how = how or Growth()
    spark = rows.sparkSession
    blocks = _packed(binned_rows(rows, tile, row_id, features, target, fold, how.bins)[0], len(features))
    folds: dict[str, list[int]] = {}
    totals: dict[str, list[float]] = {}
    for r in _spans(blocks).orderBy("tile", "fold").collect():
        own, total = folds.setdefault(r["tile"], []), totals.setdefault(r["tile"], [0.0, 0])
        total[0], total[1] = total[0] + r["sum"], total[1] + r["rows"]
        if r["fold"] >= 0 and r["lo"] < r["hi"]:
            own.append(r["fold"])
    means = {t: s / n for t, (s, n) in totals.items()}
    tiles, size = sorted(folds), max(1, bound // (max(refits, 16) << how.depth))
    checks, gains, predictions, fits = [], [], [], []
    for at in range(0, len(tiles), size):
        group = tiles[at : at + size]
        checked = validated(blocks, means, {t: folds[t] for t in group}, len(features), how)
        checks += checked
        rounds = {c["tile"]: c["rounds"] for c in checked}
        now, sums = _started(blocks, means, refits, set(group)), {}
        for turn in range(max(rounds.values())):
            trees = _grown(now, {t: list(range(refits)) for t in group if rounds[t] > turn}, turn, False, len(features), how)
            for t, own in trees.items():
                for m, tree in own.items():
                    for f, _, gain, *_ in tree.splits.values():
                        total = sums.setdefault((t, m, f), [0.0, 0])
                        total[0], total[1] = total[0] + gain, total[1] + 1
            now = now.added(trees, how)
        gains += [(t, features[f], m, g / n) for (t, m, f), (g, n) in sums.items()]
        predictions.append(_predictions(now, how))
        fits.append(_fits(now, means, how))
    every = lambda parts, schema: _union(parts) if parts else spark.createDataFrame([], schema)
    return (
        spark.createDataFrame([tuple(c.values()) for c in checks], "tile string, rounds int, rmse double, rmse_sd double, mae double, mae_sd double"),
        spark.createDataFrame(gains, "tile string, feature string, replicate int, gain double"),
        every(predictions, "tile string, id long, actual double, mean double, sd double"),
        every(fits, "tile string, replicate int, rmse double, r2 double"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionAll(p)
    return whole
