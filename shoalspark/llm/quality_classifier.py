"""Quality by compression: zstandard dictionaries trained on good and bad labelled text.

A text that the dictionary of good text helps more than that of bad text is likelier good. Texts are compressed in windows
of WINDOW bytes, so that the dictionaries and not a text's own repeats decide, and the normalised difference of the two
sums of sizes is the one number that a logistic calibration turns into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, LEVEL, DICTIONARY_BYTES = 400, 3, 112_640
PIECES, PIECE_CHARS = 8, 2000


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: float
    slope: float


class Difference:
    """The normalised size difference of texts under the two dictionaries: positive where the good one helps more."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = []
        for content in (good, bad):
            d = zstandard.ZstdCompressionDict(content)
            d.precompute_compress(LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def of(self, text: str | None) -> float:
        raw = (text or "").encode()
        windows = [raw[a : a + WINDOW] for a in range(0, max(1, len(raw)), WINDOW)]
        good, bad = (sum(len(c.compress(w)) for w in windows) for c in self.by)
        return (bad - good) / (bad + good)


def chosen_rows(labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """doc_id, label, use: at most per_class labelled ids a class, by hash, of those whose crc32(doc_id) mod 3 is not 1.

    use is 0 for dictionaries, 1 for the calibration. An id with both labels is of both classes.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    ids = usable.select("doc_id", F.col("quality").cast("int").alias("label")).groupBy("doc_id", "label").agg(F.lit(1).alias("one")).drop("one")
    some = [ids.where(F.col("label") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    return some[0].unionAll(some[1]).select("doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit("use")), F.lit(2)).cast("int").alias("use"))


def _pieces(docs: DataFrame, chosen: DataFrame) -> dict[int, list[bytes]]:
    """For each class the samples of its dictionary: up to PIECES pieces of PIECE_CHARS characters, spread over each text.

    One text an id reaches the driver, the smallest of repeated ones, so at most PIECES * PIECE_CHARS characters for each
    of the chosen ids.
    """
    text = F.coalesce("text", F.lit(""))
    step = F.greatest((F.length(text) - PIECE_CHARS) / F.lit(PIECES - 1), F.lit(float(PIECE_CHARS)))
    count = F.least(F.ceil(F.length(text) / PIECE_CHARS), F.lit(PIECES)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda k: F.substr(text, (k * step).cast("int") + 1, F.lit(PIECE_CHARS)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.where("use = 0")), "doc_id").select("doc_id", "label", cut.alias("pieces")).groupBy("doc_id", "label").agg(F.min("pieces").alias("pieces"))
    made: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(rows.collect(), key=lambda r: (r.doc_id, r.label)):
        made[r.label] += [p.encode() for p in r.pieces if p]
    return made


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; samples too few to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[:DICTIONARY_BYTES].ljust(8, b" ")


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """centre and slope of a logistic curve over one number, with both classes of one weight. With one class: that class."""
    if len(y) == 0 or y.min() == y.max():
        return (0.0, 0.0) if len(y) == 0 else (-10.0 if y[0] else 10.0, 1.0)
    middle, scale = x.mean(), x.std() + 1e-9
    z, w = np.c_[np.ones(len(x)), (x - middle) / scale], np.zeros(2)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, z.T @ (weight * (y - p)) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slope = w[1] / scale
    return float(middle - w[0] / slope) if slope else 0.0, float(slope)


def differences(docs: DataFrame, good: bytes, bad: bytes, keep: tuple[str, ...]) -> DataFrame:
    """Columns keep and difference per input row, over whole texts; null is empty, and an empty text's difference is 0."""
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Difference(*shared.value)
        for batch in batches:
            yield batch.drop(columns="text").assign(difference=np.fromiter(map(made.of, batch["text"]), float, len(batch)))

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInPandas(run, f"{kinds}, difference double")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> Model:
    """Half of the chosen rows train the dictionaries; whole texts of the other half, scored by Spark, the calibration."""
    chosen = chosen_rows(labels, per_class)
    samples = _pieces(docs, chosen)
    good, bad = _dictionary(samples[1]), _dictionary(samples[0])
    rest = docs.select("doc_id", "text").join(F.broadcast(chosen.where("use = 1")), "doc_id").select("doc_id", "label", "text")
    # Of rows that share an id one counts, so that at most 2 * per_class numbers reach the driver.
    rows = differences(rest, good, bad, ("doc_id", "label")).groupBy("doc_id", "label").agg(F.min("difference").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label))
    return Model(good, bad, *calibrated(np.array([r.x for r in rows]), np.array([r.label for r in rows], float)))


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """doc_id, held_out, score, predicted, difference per input row, over the whole text.

    Null text is empty; empty texts have difference 0. A null doc_id is not held out. Repeated rows get equal scores; a
    score of exactly 0.5 predicts 1; an empty table gives no rows, and without labelled rows every score is 0.5. Only
    doc_id and text are read, and labels, chosen by per_class, never enter a score but through the fitted model.
    """
    model = fit(docs, labels, per_class)
    scored = differences(docs, model.good, model.bad, ("doc_id",))
    score = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(model.slope) * (F.col("difference") - model.centre), F.lit(30.0)), F.lit(-30.0))))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), "difference")
