"""Exact nearest neighbours over a k-d partition, and nearest sites (Voronoi cells) as their case in the plane.

Points of a group are dealt to the leaves of a k-d tree, whose cuts are medians of all rows, found a level at a time; the
cuts only say where rows are searched, not what is found. A query is first answered by its own leaf, which bounds the
distance of its last neighbour, and then asks just the leaves whose boxes lie within that bound. Leaves with more rows than
a task should hold are parted once more by chance. No task sees a whole group, however large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lineage import cut


class Tree:
    """Cuts of one group: heap of (feature, value); leaves are numbered by their place in the heap."""

    def __init__(self):
        self.cuts: dict[int, tuple[int, float]] = {}

    def cut(self, node: int, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> None:
        """Parts a node at the middle of its widest feature; rows that are all alike stay together."""
        with np.errstate(invalid="ignore"):
            spread = np.nan_to_num(high - low)
        feature = int(np.argmax(spread))
        if spread[feature] > 0:
            at = middle[feature] if middle[feature] < high[feature] else low[feature] / 2 + high[feature] / 2
            self.cuts[node] = feature, float(at if low[feature] <= at < high[feature] else low[feature])

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        at, inner = np.ones(len(rows), np.int64), np.array(sorted(self.cuts), np.int64)
        feature, value = (np.array([self.cuts[n][i] for n in inner.tolist()]) for i in (0, 1))
        todo = np.arange(len(rows)) if len(inner) else np.empty(0, int)
        while len(todo):
            cut = np.minimum(np.searchsorted(inner, at[todo]), len(inner) - 1)
            todo, cut = todo[inner[cut] == at[todo]], cut[inner[cut] == at[todo]]
            at[todo] = 2 * at[todo] + (rows[todo, feature[cut]] > value[cut])
        return at


def _nearest(q: np.ndarray, q_id: np.ndarray, p: np.ndarray, p_id: np.ndarray, k: int, others: bool, step: int = 1 << 21, root: bool = False) -> pd.DataFrame:
    """The k nearest points of each query, by distance and then by id, never the query's own id if others."""
    order = np.argsort(p_id, kind="stable")
    p, p_id = p[order], p_id[order]
    made = []
    rows = max(1, step // max(1, len(p)))
    for at in range(0, len(q), rows):
        part = q[at : at + rows]
        d2 = np.zeros((len(part), len(p)))
        for f in range(q.shape[1]):
            d2 += (part[:, f, None] - p[None, :, f]) ** 2
        if root:
            d2 = np.sqrt(d2)
        if others:
            d2[q_id[at : at + rows, None] == p_id[None, :]] = np.inf
        if len(p) > k:
            last = np.partition(d2, k - 1, 1)[:, k - 1]
            i, j = np.nonzero(d2 <= last[:, None])
        else:
            i, j = np.nonzero(np.isfinite(d2))
        d = d2[i, j]
        keep = np.isfinite(d)
        i, j, d = i[keep], j[keep], d[keep]
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.searchsorted(i, i, "left")
        few = np.arange(len(i)) - first < k
        made.append(pd.DataFrame({"q": i[few] + at, "p": p_id[j[few]], "d2": d[few]}))
    return pd.concat(made) if made else pd.DataFrame({"q": [], "p": [], "d2": []})


def nearest_rows(queries: DataFrame, points: DataFrame, k: int, by: list[str], features: list[str], others: bool = True, leaf_rows: int = 4096, root: bool = False) -> DataFrame:
    """by, q_id, p_id, d and n (from 1): the k nearest points (p_id) of each query (q_id) of the same group.

    Equal distances go by p_id (equal squares, or with root equal square roots, which may round alike); with others a query never finds its own id. Rows with a null id, group or feature are left
    out, and ids are whole numbers, unique in their table. A query whose group has fewer points finds those.
    """
    key = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in by]) if by else F.lit("")
    some = lambda df, i: df.dropna(subset=[i, *by, *features]).select(key.alias("g"), F.col(i).cast("long").alias(i), F.array(*[F.col(f).cast("double") for f in features]).alias("f"))
    p, q = cut(some(points, "p_id")), cut(some(queries, "q_id"))
    sizes = p.groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
    large = {r["g"]: r["rows"] for r in sizes.where(F.col("rows") > leaf_rows).collect()}  # at most rows / leaf_rows groups
    trees, session, width = {g: Tree() for g in large}, queries.sparkSession, len(features)

    def placed():
        """The leaf of each row by the cuts that there are."""
        sent = session.sparkContext.broadcast(trees)

        @F.pandas_udf("long")
        def leaf(g: pd.Series, f: pd.Series) -> pd.Series:
            at = np.ones(len(g), np.int64)
            for name, own in pd.Series(np.arange(len(g))).groupby(g.to_numpy()):
                if name in sent.value:
                    rows = own.to_numpy()
                    at[rows] = sent.value[name].leaf(np.stack(f.to_numpy()[rows]))
            return pd.Series(at)

        return leaf

    depth = {g: int(np.ceil(np.log2(rows / leaf_rows))) for g, rows in large.items()}
    for level in range(max(depth.values(), default=0)):
        # Every row of a large group counts for its cuts; a node is a row here, and there are rows / leaf_rows of them at most.
        deep = session.createDataFrame([(g,) for g, d in depth.items() if d > level], "of string")
        rows = p.join(F.broadcast(deep), F.col("g") == F.col("of"), "left_semi").withColumn("node", placed()("g", "f")).where(F.col("node") >= 1 << level)
        ends = [F.array(*[fn(F.get("f", F.lit(i))) for i in range(width)]).alias(n) for n, fn in (("low", F.min), ("middle", lambda c: F.percentile_approx(c, 0.5)), ("high", F.max))]
        for r in rows.groupBy("g", "node").agg(*ends).collect():
            trees[r["g"]].cut(r["node"], *(np.array(r[n], float) for n in ("low", "middle", "high")))
    leaf = placed()
    p = cut(p.withColumn("leaf", leaf("g", "f")))
    boxes = cut(p.groupBy("g", "leaf").agg(F.count(F.lit(1)).alias("rows"), *[fn(F.get("f", F.lit(i))).alias(f"{n}{i}") for i in range(width) for n, fn in (("lo", F.min), ("hi", F.max))]))
    parts = boxes.select("g", "leaf", F.ceil(F.col("rows") / (4 * leaf_rows)).cast("int").alias("parts"))
    pieces = p.join(parts.where("parts > 1"), ["g", "leaf"], "left").withColumn("part", F.pmod(F.xxhash64("p_id"), F.coalesce("parts", F.lit(1)))).select("g", "leaf", "part", "p_id", "f")

    def asked(rows: DataFrame) -> DataFrame:
        """Answers of the leaves that queries (g, leaf, q_id, f) name: g, q_id, p_id, d2."""
        spread = rows.join(parts, ["g", "leaf"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))).select("g", "leaf", "part", "q_id", "f")

        def search(one: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            if one.empty or own.empty:
                return pd.DataFrame({"g": np.empty(0, object), "q_id": [], "p_id": [], "d2": []})
            ids = one["q_id"].to_numpy()
            found = _nearest(np.stack(one["f"].to_numpy()), ids, np.stack(own["f"].to_numpy()), own["p_id"].to_numpy(), k, others, root=root)
            return pd.DataFrame({"g": np.full(len(found), str(one["g"].iloc[0]), object), "q_id": ids[found["q"].to_numpy(int)], "p_id": found["p"].to_numpy(np.int64), "d2": found["d2"].to_numpy()})

        # Queries of one leaf are dealt out too, so that a leaf that many ask does not wait for one task.
        dealt = spread.withColumn("turn", F.pmod(F.xxhash64("q_id", F.lit(1)), F.lit(8)))
        copies = pieces.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long")))) if large else pieces.withColumn("turn", F.lit(0).cast("long"))
        dealt = dealt if large else dealt.withColumn("turn", F.lit(0).cast("long"))
        keys = ["g", "leaf", "part", "turn"]
        anew = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  (both sides come from the same tables)
        dealt, copies = anew(dealt), anew(copies)
        return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(search, "g string, q_id long, p_id long, d2 double")

    best = Window.partitionBy("g", "q_id").orderBy("d2", "p_id")
    first = cut(asked(q.withColumn("leaf", leaf("g", "f"))).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k))
    bounds = first.where(F.col("n") == k).select(F.col("g").alias("bg"), F.col("q_id").alias("bq"), F.col("d2").alias("bound"))
    asking = q.withColumn("own", leaf("g", "f")).join(bounds, (F.col("g") == F.col("bg")) & (F.col("q_id") == F.col("bq")), "left")
    away = lambda i: F.greatest(F.col(f"lo{i}") - F.get("f", F.lit(i)), F.get("f", F.lit(i)) - F.col(f"hi{i}"), F.lit(0.0))
    gap = sum((away(i) * away(i) for i in range(1, width)), away(0) * away(0))
    # Only groups of several leaves have more to ask; there are rows / leaf_rows leaves at most.
    many = cut(boxes.withColumn("leaves", F.count(F.lit(1)).over(Window.partitionBy("g"))).where("leaves > 1").drop("rows", "leaves"))
    further = asking.join(F.broadcast(many) if many.count() <= 100_000 else many, "g").where((F.col("leaf") != F.col("own")) & (F.col("bound").isNull() | ((F.sqrt(gap) if root else gap) <= F.col("bound"))))
    every = first.drop("n").unionByName(asked(further.select("g", "leaf", "q_id", "f")))
    ranked = every.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)
    named = queries.dropna(subset=["q_id", *by]).select(*by, F.col("q_id").cast("long").alias("q_id"), key.alias("_g"))
    inner = ranked.select(F.col("g").alias("_of"), F.col("q_id").alias("_q"), "p_id", (F.col("d2") if root else F.sqrt("d2")).alias("d"), F.col("n").cast("int").alias("n"))
    return named.join(inner, (F.col("_g") == F.col("_of")) & (F.col("q_id") == F.col("_q"))).select(*by, "q_id", "p_id", "d", "n")


def hull_sites(sites: DataFrame) -> DataFrame:
    """site_id of the sites on the border of the hull of all, whose Voronoi cells have no end. Hulls of parts are joined in turn."""

    def border(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame({"site_id": [], "x": [], "y": []})
        for batch in batches:
            rows = pd.concat([kept, batch]).drop_duplicates(["x", "y", "site_id"]).sort_values(["x", "y"], kind="stable")
            x, y = rows["x"].to_numpy(float), rows["y"].to_numpy(float)

            def chain(order, x=x, y=y) -> list[int]:
                out: list[int] = []
                for i in order:  # points on a side stay
                    while len(out) > 1 and (x[out[-1]] - x[out[-2]]) * (y[i] - y[out[-2]]) - (y[out[-1]] - y[out[-2]]) * (x[i] - x[out[-2]]) < 0:
                        out.pop()
                    out.append(i)
                return out

            on = sorted({*chain(range(len(x))), *chain(range(len(x) - 1, -1, -1))})
            kept = rows.iloc[on]
        yield kept

    known = sites.where("x is not null and y is not null").select(F.col("site_id").cast("long").alias("site_id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    schema = "site_id long, x double, y double"
    return known.mapInPandas(border, schema).coalesce(1).mapInPandas(border, schema).select("site_id")


def nearest_site(cells: DataFrame, sites: DataFrame, size: float, ended: bool = True, **options) -> DataFrame:
    """row, col, site_id of the site (site_id, x, y) nearest to each cell's centre, the smallest id of equals.

    With ended, cells of sites on the hull of all sites are left out, as their Voronoi cells have no end. Of sites at one
    place the smallest id counts.
    """
    once = sites.groupBy("x", "y").agg(F.min("site_id").alias("p_id"))
    asked = cells.select("row", "col").distinct().withColumn("q_id", F.shiftleft(F.col("row").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
    placed = asked.select("q_id", ((F.col("col") + 0.5) * size).alias("x"), ((F.col("row") + 0.5) * size).alias("y"))
    found = nearest_rows(placed, once, 1, [], ["x", "y"], others=False, **options)
    made = found.select(F.shiftright("q_id", 32).cast("int").alias("row"), F.shiftright(F.shiftleft("q_id", 32), 32).cast("int").alias("col"), F.col("p_id").alias("site_id"))
    return made.join(hull_sites(once.withColumnRenamed("p_id", "site_id")), "site_id", "left_anti").select("row", "col", "site_id") if ended else made
