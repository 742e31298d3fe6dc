"""Model preparation and evaluation: spatial blocks, folds, metrics, partial dependence and boosted trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def block(x: Column, y: Column, x0: float, y0: float, size: float) -> Column:
    """Block id of a point, null on a block's edge."""
    fx, fy = (x - x0) / size, (y - y0) / size
    on_edge = (fx == F.floor(fx)) | (fy == F.floor(fy))
    return F.when(~on_edge, F.concat_ws("_", F.floor(fx).cast("string"), F.floor(fy).cast("string")))


def folds(rows: DataFrame, group: str, block_col: str, n: int) -> DataFrame:
    """group, block, fold: blocks by falling size dealt to min(n, blocks) folds to and fro, so that folds are even."""
    sizes = rows.where(F.col(block_col).isNotNull()).groupBy(group, block_col).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy(group).orderBy(F.desc("rows"), block_col)
    k = F.least(F.lit(n), F.count(F.lit(1)).over(Window.partitionBy(group))).cast("int")
    at = (F.row_number().over(w) - 1).cast("int")
    turn = F.floor(at / k) % 2
    return sizes.select(group, block_col, "rows", F.when(turn == 0, at % k).otherwise(k - 1 - at % k).cast("int").alias("fold"))


def metrics(rows: DataFrame, group: str, actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    sums = rows.where(a.isNotNull() & p.isNotNull()).groupBy(group).agg(
        F.sqrt(F.avg(F.pow(a - p, 2))).alias("rmse"), F.avg(F.abs(a - p)).alias("mae"), F.sum(F.pow(a - p, 2)).alias("sse"), (F.var_pop(a) * F.count(a)).alias("sst")
    )
    return sums.select(group, "rmse", "mae", (1 - F.try_divide("sse", "sst")).alias("r2"))


def binned(rows: DataFrame, by: str, value: str, target: str, bins: int) -> DataFrame:
    """by, bin with mean, least and largest target over equal bins of value within each of by, closed on the right.

    The least value is in the first bin; where all values are one they are in the middle. Null values are in none.
    """
    span = rows.groupBy(by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.greatest(F.ceil((F.col(value) - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))) - 1, F.lit(0))
    placed = rows.where(F.col(value).isNotNull()).join(span, by).withColumn("bin", F.when(F.col("hi") == F.col("lo"), -(-bins // 2) - 1).otherwise(at).cast("int"))
    return placed.groupBy(by, "bin").agg(F.avg(target).alias("mean"), F.min(target).alias("least"), F.max(target).alias("largest"))


def dealt(rows: DataFrame, task_rows: int = 1 << 20) -> DataFrame:
    """rows in tasks of about task_rows at most: what a fit holds and reads again in each round is that of one task."""
    tasks = -(-rows.count() // task_rows)
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


def boosted(rows: DataFrame, features: list[str], target: str, rounds: int = 20, depth: int = 4, rate: float = 0.1, seed: int = 1):
    """A gradient-boosted tree pipeline fitted on the rows without nulls."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    trees = GBTRegressor(featuresCol="features", labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=0.7, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), trees]).fit(dealt(rows.dropna(subset=[*features, target]).select(*features, target)))


def partial_dependence(model, rows: DataFrame, features: list[str], feature: str, points: int = 20) -> DataFrame:
    """value, mean prediction with the other features at their means, over points from the least to the largest."""
    stats = rows.agg(*[F.avg(f).alias(f) for f in features], F.min(feature).alias("lo"), F.max(feature).alias("hi"))
    grid = stats.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(feature, F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("k") / (points - 1))
    return model.transform(grid).select(F.col(feature).alias("value"), "prediction")


def selected_features(rows: DataFrame, features: list[str], target: str, rounds: int = 3, seed: int = 5) -> dict[str, str]:
    """Confirmed, tentative or rejected by how often a feature's importance in a forest beats the best shuffled copy."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    wins = dict.fromkeys(features, 0)
    rows = rows.dropna(subset=[*features, target]).select(*features, target)
    for k in range(rounds):
        shadows = [f"shadow_{f}" for f in features]
        # A shadow is a hash of the value: it keeps how many values there are and loses their order.
        shadowed = rows.select("*", *[(F.xxhash64(F.col(f), F.rand(seed + k)) % 100_003).cast("double").alias(s) for f, s in zip(features, shadows, strict=True)])
        forest = RandomForestRegressor(featuresCol="features", labelCol=target, maxDepth=5, numTrees=20, seed=seed + k)
        weights = forest.fit(VectorAssembler(inputCols=features + shadows, outputCol="features").transform(shadowed)).featureImportances.toArray()
        best = max(weights[len(features) :])
        for f, w in zip(features, weights, strict=False):
            wins[f] += w > best
    return {f: "Confirmed" if w == rounds else "Rejected" if w == 0 else "Tentative" for f, w in wins.items()}
