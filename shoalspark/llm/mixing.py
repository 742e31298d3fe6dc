"""Mixing sources to target weights by Efraimidis-Spirakis keys (DataFrame functions only).

A source's target takes whole epochs first, then documents in the order of exponential keys scaled by quality weight, as
far as the token budget goes. Prefix sums run over buckets of keys, and only the bucket where the budget ends is sorted,
so no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, dealt_anew_text, if_small, words

WEIGHTS, CAP = (5, 2, 1), 3
#: Buckets for each doubling of the key: at most 0.4 % of a source lies in one, whatever the scale of its weights.
PER_OCTAVE, ROWS_PER_STEP = 64, 100_000_000
NO_SOURCE = "\U0010ffff"  # sorts after every source, for null


def quality_weight(size: Column) -> Column:
    """Between 0 and 1, rising with the words of a document; a stand-in where no quality score is given."""
    return (size + 1) / (size + 51)


def _uniform(doc_id: Column, source: Column, size: Column, seed: int) -> Column:
    """In (0, 1), from a digest, so that reruns agree."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), source, size.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sizes (source, source_size) with target: all words shared by weight, none above cap times its size.

    Sorted by cap over weight, the capped sources are a prefix; the rest share what remains. One row a source is sorted.
    """
    by_name = Window.orderBy(F.coalesce("source", F.lit(NO_SOURCE)))
    w = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights))
    rows = sizes.select("source", "source_size", w.cast("long").alias("w"), (cap * F.col("source_size")).alias("top"))
    order = Window.orderBy((F.col("top") / F.col("w")), F.coalesce("source", F.lit(NO_SOURCE)))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0))
    share = rows.select("*", (left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))).alias("share"))
    # The share rises while sources are capped and then falls, so the highest that a source can take is the level for all after.
    level = F.max(F.when(F.col("top") / F.col("w") >= F.col("share"), F.col("share"))).over(every)
    return share.select("source", "source_size", F.least(F.col("top").cast("double"), F.col("w") * level).alias("target"))


def _keyed(docs: DataFrame, seed: int, weight_col: str | None, *others: Column) -> DataFrame:
    """doc_id, source, s (source, never null), size, key and others per input row."""
    size = F.size(words(F.col("text"))).cast("long")
    given = quality_weight(F.col("size")) if weight_col is None else F.greatest(F.coalesce(F.nanvl(F.col("given"), F.lit(None).cast("double")), F.lit(1e-6)), F.lit(1e-6))
    weight = [F.col(weight_col).cast("double").alias("given")] if weight_col else []
    source = F.col("source").cast("string")
    rows = docs.select("doc_id", source.alias("source"), F.coalesce(source, F.lit(NO_SOURCE)).alias("s"), size.alias("size"), *weight, *others)
    names = rows.columns[4 + len(weight) :]
    return rows.select("doc_id", "source", "s", "size", (-F.log(_uniform(F.col("doc_id"), F.col("s"), F.col("size"), seed)) / given).alias("key"), *names)


def _bucket(per_octave: int) -> Column:
    """Rises with the key. The middle of the keys' range is at bucket 0; every source spreads over about six octaves."""
    return F.floor(F.log2(F.greatest("key", F.lit(1e-300))) * per_octave).cast("int")


def _ends(keyed: DataFrame) -> tuple[DataFrame, int]:
    """One row a source: s, source_size, target, epochs, budget, end (bucket where the budget ends) and before (words of the buckets below).

    Also the buckets an octave, which grow with the rows.
    """
    per_octave = PER_OCTAVE * max(1, -(-keyed.count() // ROWS_PER_STEP))
    held = cut(keyed.groupBy("s", _bucket(per_octave).alias("bucket")).agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    sizes = held.groupBy("s").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    goal = targets(sizes.select("source", "source_size")).withColumn("s", F.coalesce("source", F.lit(NO_SOURCE))).drop("source")
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    summed = Window.partitionBy("s").orderBy("bucket")
    prefix = held.select("s", "bucket", "words", (F.sum("words").over(summed) - F.col("words")).alias("before"))
    ends = prefix.join(goal, "s").where((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words")))
    ends = ends.groupBy("s").agg(F.min("bucket").alias("end"), F.min("before").alias("before"))
    return cut(goal.join(ends, "s", "left")).select(dealt_anew_text(F.col("s")).alias("k"), "source_size", "target", "epochs", "budget", "end", "before"), per_octave


def _with_ends(keyed: DataFrame, ends: DataFrame, per_octave: int) -> tuple[DataFrame, DataFrame]:
    """Rows outside the bucket where their source's budget ends, with once (0 or 1), and the rows within it."""
    rows = keyed.withColumn("k", dealt_anew_text(F.col("s"))).withColumn("bucket", _bucket(per_octave)).join(if_small(ends), "k")
    within = F.coalesce(F.col("bucket") == F.col("end"), F.lit(False))
    return rows.where(~within).withColumn("once", F.coalesce((F.col("bucket") < F.col("end")).cast("long"), F.lit(0).cast("long"))), rows.where(within)


def _taken_once(last: DataFrame) -> DataFrame:
    """Rows of ending buckets with once: 1 for those, by key, whose middle lies within the budget."""
    place = Window.partitionBy("k").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return last.withColumn("once", (F.col("before") + F.sum("size").over(place) - F.col("size") / 2 <= F.col("budget")).cast("long"))


def mix(docs: DataFrame, seed: int = 42, weight_col: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken per input row.

    taken is size times the epochs of the source, and once more for documents of the fractional part: those, by key,
    whose middle lies within the budget. Null text has size 0 and takes nothing; null sources are one, the last. Null or
    non-positive weights (weight_col) count as the least positive. Equal rows are documents of their own; if the budget
    ends between them, some are taken. An empty table gives no rows. Columns but doc_id, source, text and weight_col are
    not read.
    """
    keyed = cut(_keyed(docs, seed, weight_col))
    clear, last = _with_ends(keyed, *_ends(keyed))
    return clear.unionByName(_taken_once(last)).select("doc_id", "source", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("once"))).alias("taken"))


def mix_documents(docs: DataFrame, seed: int = 42, weight_col: str | None = None) -> DataFrame:
    """docs with each row as often as mix() takes it, all columns as they are; rows without words are not taken.

    Only the rows of the buckets where budgets end are joined and sorted; what becomes of the others follows from their
    key and one row for their source. Of rows equal in id, source and size, as many are taken once more as mix() takes,
    those of the smallest text hash first. Null and empty texts give no rows, null sources are one source, and an empty
    table gives none.
    """
    keyed = cut(_keyed(docs, seed, weight_col))
    ends, per_octave = _ends(keyed)
    once = _taken_once(_with_ends(keyed, ends, per_octave)[1]).groupBy("s", "doc_id", "size", "key").agg(F.sum("once").alias("n_once"))
    once = cut(once.where("n_once > 0")).select(F.col("s").alias("of"), F.col("doc_id").alias("i"), F.col("size").alias("n"), F.col("key").alias("at"), "n_once")
    whole, last = _with_ends(_keyed(docs, seed, weight_col, F.struct("*").alias("row"), F.xxhash64("text").alias("text_key")), ends, per_octave)
    same = (F.col("s") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("size") == F.col("n")) & (F.col("key") == F.col("at"))
    copy = F.row_number().over(Window.partitionBy("s", "doc_id", "size", "key").orderBy("text_key"))
    last = last.join(if_small(once), same, "left").withColumn("once", (F.coalesce("n_once", F.lit(0)) >= copy).cast("long"))
    # Flags of one step at a time, so that no row is copied that is not taken.
    times = F.when(F.col("size") > 0, F.col("epochs") + F.col("once")).otherwise(0).cast("int")
    both = whole.select("row", times.alias("times")).unionAll(last.select("row", times.alias("times"))).where("times > 0")
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
