"""Exact quantiles of groups without sorting a group: histograms are narrowed down to the rows that matter.

Every round counts the rows of a group in buckets between a lower and an upper value, finds the bucket that holds the
wanted rank, and goes on with that bucket's own least and largest value. Counts are added up in the tasks before they are
shuffled, so a group that holds most rows costs no task more than its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lineage import cut

#: Tables of at most so many groups are sent to all tasks; larger ones are joined.
SENT = 1_000_000


def _same(columns: list[str], prefix: str) -> Column:
    made = F.lit(True)
    for c in columns:
        made = made & F.col(c).eqNullSafe(F.col(prefix + c))
    return made


def group_quantiles(rows: DataFrame, groups: list[str], value: str, shares: list[float], buckets: int = 1024, gathered: int = 4096) -> DataFrame:
    """groups, share, value: the values below which shares of a group's values lie, between neighbours in proportion.

    Null and NaN values do not count; a group without others has no row. Null groups are groups of their own; without
    groups all rows are one.
    """
    held = cut(rows.select(*groups, F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)"))
    stats = held.groupBy(*groups).agg(F.count(F.lit(1)).alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = cut(stats.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).withColumn("place", (F.col("inside") - 1) * F.col("share")))
    ranks = F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place"))))
    open_ = cut(wanted.select(*groups, "inside", "lo", "hi", ranks.alias("rank")).distinct().withColumn("rest", F.col("rank")))
    done: list[DataFrame] = []
    small = open_.count() <= SENT
    named = lambda df: df.select(*[F.col(c).alias("t_" + c) for c in groups], "rank", "rest", "lo", "hi", "inside")

    def met(targets: DataFrame) -> DataFrame:
        t = named(targets)
        return held.join(F.broadcast(t) if small else t, _same(groups, "t_") & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))

    while True:
        settled = (F.col("lo") == F.col("hi")) | (F.col("inside") <= gathered)
        done.append(open_.where(settled))
        open_ = open_.where(~settled)
        if open_.isEmpty():
            break
        at = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets), F.lit(buckets - 1))
        counts = met(open_).groupBy(*groups, "rank", "rest", at.alias("bucket")).agg(F.count(F.lit(1)).alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = Window.partitionBy(*groups, "rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = counts.withColumn("before", F.sum("inside").over(upto) - F.col("inside"))  # at most so many buckets each
        open_ = cut(run.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("inside"))).select(*groups, "inside", "lo", "hi", "rank", (F.col("rest") - F.col("before")).alias("rest")))
    targets = done[0]
    for d in done[1:]:
        targets = targets.unionByName(d)
    targets = cut(targets)
    few = met(targets.where("lo < hi")).groupBy(*groups, "rank", "rest").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    found = targets.where("lo = hi").select(*groups, "rank", F.col("lo").alias("v")).unionByName(few.select(*groups, "rank", F.get("vs", F.col("rest").cast("int")).alias("v")))
    found = found.select(*[F.col(c).alias("f_" + c) for c in groups], F.col("rank").alias("at"), "v")
    pairs = wanted.join(found, _same(groups, "f_") & ((F.col("at") == F.floor("place")) | (F.col("at") == F.ceil("place"))))
    weight = F.when(F.floor("place") == F.ceil("place"), 1.0).otherwise(1 - F.abs(F.col("place") - F.col("at")))
    return pairs.groupBy(*groups, "share").agg(F.sum(F.col("v") * weight).alias("value"))


def group_medians(rows: DataFrame, groups: list[str], value: str, **options) -> DataFrame:
    """groups, median over the values that are neither null nor NaN."""
    return group_quantiles(rows, groups, value, [0.5], **options).select(*groups, F.col("value").alias("median"))
