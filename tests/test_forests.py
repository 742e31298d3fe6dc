"""Boosted trees of all tiles against a plain grower of one tile."""

import math
import random

from shoalspark.operators import forests as B

FEATURES = ["a", "b", "c"]


def rows():
    draw = random.Random(5)
    made = []
    for k in range(700):
        tile = "hot" if k % 3 else f"t{k % 4}"
        a, b, c = draw.uniform(-5, 5), draw.randrange(6), draw.gauss(0, 1)
        made.append((tile, k, a, float(b), c, 10 * (a > 1) + 3 * b + draw.gauss(0, 0.5), draw.randrange(3) if tile != "t3" else 0))
    return [*made, ("t1", 9001, None, 1.0, 1.0, 2.0, 0), ("t1", 9002, 1.0, 1.0, 1.0, None, 0), (None, 9003, 1.0, 1.0, 1.0, 1.0, 0), ("one", 9004, 1.0, 2.0, 3.0, 4.0, 1)]


def plain_tree(own, pred, use, features, how):
    """Nested tuples (feature, bin, gain, left, right), or a leaf's value."""

    def score(part):
        return sum(own[i][1] - pred[i] for i in part) ** 2 / (len(part) + how.l2)

    def grow(part, depth):
        value = sum(own[i][1] - pred[i] for i in part) / (len(part) + how.l2)
        best = None
        for f in features if depth < how.depth else ():
            for b in sorted({own[i][2][f] for i in part}):
                left = [i for i in part if own[i][2][f] <= b]
                right = [i for i in part if own[i][2][f] > b]
                if left and right:
                    gain = round(score(left) + score(right) - score(part), 9)
                    if best is None or gain > best[0]:
                        best = gain, f, b, left, right
        if best is None or best[0] <= 1e-6:
            return value
        gain, f, b, left, right = best
        left, right = grow(left, depth + 1), grow(right, depth + 1)
        if gain < how.gamma and not isinstance(left, tuple) and not isinstance(right, tuple):
            return value
        return f, b, gain, left, right

    return grow(use, 0)


def value(tree, bins):
    while isinstance(tree, tuple):
        tree = tree[3] if bins[tree[0]] <= tree[1] else tree[4]
    return tree


def splits(tree):
    return [(tree[0], tree[2]), *splits(tree[3]), *splits(tree[4])] if isinstance(tree, tuple) else []


def plain_tile(own, how, refits):
    """own: (id, y, bins, fold). Rounds, then replicate predictions and gains."""
    mean = sum(r[1] for r in own) / len(own)
    folds = [k for k in range(3) if len({r[1] for r in own if r[3] == k}) > 1]
    done = []
    for k in folds if len(folds) > 1 else ():
        pred, best = [mean] * len(own), None
        for turn in range(how.rounds):
            tree = plain_tree(own, pred, [i for i, r in enumerate(own) if r[3] != k], range(3), how)
            pred = [p + how.rate * value(tree, r[2]) for p, r in zip(pred, own, strict=True)]
            test = [r[1] - p for p, r in zip(pred, own, strict=True) if r[3] == k]
            rmse = math.sqrt(sum(e * e for e in test) / len(test))
            if best is None or rmse < best[1]:
                best = turn, rmse
            elif turn - best[0] >= how.patience:
                break
        if best[0] > 0:
            done.append(best)
    rounds = int(sum(t for t, _ in done) / len(done)) if done else how.default_rounds
    preds, gains = [], {}
    import numpy as np

    for m in range(refits):
        pred = [mean] * len(own)
        for turn in range(rounds):
            use = [i for i, r in enumerate(own) if B.chance(np.array([r[0]]), how.seed, m, turn)[0] < how.row_share]
            if not use:
                continue
            tree = plain_tree(own, pred, use, B.chosen_features(3, m, turn, how).tolist(), how)
            for f, g in splits(tree):
                gains.setdefault((m, FEATURES[f]), []).append(g)
            pred = [p + how.rate * value(tree, r[2]) for p, r in zip(pred, own, strict=True)]
        preds.append(pred)
    return rounds, {k: sum(g) / len(g) for k, g in gains.items()}, preds


def test_trees_of_all_tiles_equal_a_plain_grower(spark):
    how = B.Growth(depth=3, rate=0.4, gamma=4.0, rounds=7, default_rounds=3, patience=2, bins=8)
    df = spark.createDataFrame(rows(), "tile string, id long, a double, b double, c double, y double, fold int").repartition(4)
    checks, gains, predictions, fits = B.trained(df, "tile", "id", FEATURES, "y", "fold", refits=3, how=how, bound=100)  # groups of few tiles
    checks = {r["tile"]: r for r in checks.collect()}
    gains = {(r["tile"], r["replicate"], r["feature"]): r["gain"] for r in gains.collect()}
    predictions = {(r["tile"], r["id"]): r for r in predictions.collect()}
    assert fits.count() == 3 * len(checks) and set(checks) == {"hot", "t0", "t1", "t2", "t3", "one"}
    assert len(predictions) == len(rows()) - 3
    for tile in checks:
        own = [r for r in rows() if r[0] == tile and None not in r]
        lo, hi = ([f(r[2 + k] for r in own) for k in range(3)] for f in (min, max))
        binned = [(r[1], r[5], [min(how.bins - 1, math.floor((r[2 + k] - lo[k]) * how.bins / (hi[k] - lo[k]))) if hi[k] > lo[k] else 0 for k in range(3)], r[6]) for r in own]
        rounds, gain, preds = plain_tile(binned, how, 3)
        assert checks[tile]["rounds"] == rounds, tile
        assert {k[1:]: round(g, 4) for k, g in gains.items() if k[0] == tile} == {k: round(g, 4) for k, g in gain.items()}, tile
        for i, r in enumerate(own):
            each = [p[i] for p in preds]
            mean = sum(each) / 3
            got = predictions[tile, r[1]]
            assert abs(got["mean"] - mean) < 1e-6 and abs(got["sd"] - math.sqrt(sum((x - mean) ** 2 for x in each) / 3)) < 1e-6
    assert max(r["sd"] for r in predictions.values()) > 0
    assert checks["hot"]["rmse"] < 3


def test_rows_lie_in_few_blocks_and_share_cells(spark):
    df = spark.range(0, 60_000, 1, 3).selectExpr("concat('t', id % 50) AS tile", "IF(id = 7, NULL, id) AS id", "CAST(id % 5 AS DOUBLE) AS a", "CAST(id % 3 AS DOUBLE) AS b", "CAST(id AS DOUBLE) AS y", "CAST(id % 2 AS INT) AS fold")
    packed = B._packed(B.binned_rows(df, "tile", "id", ["a", "b"], "y", "fold", 8)[0], 2)
    blocks = list(B._blocks([packed.toPandas()]))
    assert len(blocks) == 3 and sum(len(b.y) for b in blocks) == 60_000
    for b in blocks:
        assert len(b.code) == 50 * 3  # a tile has one value of a
        for k in range(0, len(b.y), 997):
            y = int(b.y[k])
            assert b.names[b.tiles[k]] == f"t{y % 50}" and b.id[k] == (B.NO_ID if y == 7 else y) and b.fold[k] == y % 2
            assert b.bins[:, b.cell[k]].tolist() == [7, y % 3 * 4 - (y % 3 == 2)]  # one value is in the last bin
    part = blocks[0].part({"t3", "t44"})
    assert set(part.names) == {"t3", "t44"} and len(part.code) == 6 and all(part.names[t] == f"t{int(y) % 50}" for t, y in zip(part.tiles, part.y, strict=True))


def test_pending_trees_count_as_written_ones(spark, monkeypatch):
    how = B.Growth(depth=2, rate=0.4, gamma=4.0, rounds=1, default_rounds=3, bins=8)
    kept = [(r[0], None if r[1] == 21 else r[1], *r[2:6], -1) for r in rows()]
    df = spark.createDataFrame(kept, "tile string, id long, a double, b double, c double, y double, fold int")
    found = []
    for turns in (2, 8):
        monkeypatch.setattr(B, "HELD_TURNS", turns)
        found.append(sorted(((r.tile, r.actual, r.id, round(r["mean"], 6), round(r.sd, 6)) for r in B.trained(df, "tile", "id", FEATURES, "y", "fold", refits=2, how=how)[2].collect()), key=str))
    assert found[0] == found[1] and sum(r[2] is None for r in found[0]) == 1


def test_empty_rows_give_empty_tables(spark):
    df = spark.createDataFrame([], "tile string, id long, a double, b double, c double, y double, fold int")
    assert [t.count() for t in B.trained(df, "tile", "id", FEATURES, "y", "fold", refits=2)] == [0, 0, 0, 0]
