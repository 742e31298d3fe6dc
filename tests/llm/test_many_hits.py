"""A text with very many secrets: places by plain Python, in reasonable time."""

import hashlib
import re

from pyspark.sql import functions as F

from shoalspark.llm import secrets


def test_places_of_many_hits(spark):
    text = "é🙂 " + " ".join(f"password=abcdefgh{k:06d}; {'f' * (32 + k % 3)}" for k in range(12_000))
    df = spark.createDataFrame([(1, text, "s", "en"), (2, "password=short", "s", "en")], "doc_id long, text string, source string, lang string")
    r = {x["doc_id"]: x for x in secrets.find_secrets(df).collect()}
    spans = sorted([(m.start(), 0, m.end(), "assign") for m in re.finditer(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)] + [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"(?<![0-9a-f])[0-9a-f]{32,}", text)])
    assert r[1]["n_assign"] == 12_000 and r[1]["n_hex"] == 12_000 and r[2]["spans"] == ""
    assert r[1]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()


def test_sums_before_each(spark):
    df = spark.createDataFrame([([],), ([5],), (list(range(1, 40)),), ([0] * 9,)], "a array<int>")
    for r in df.select("a", secrets._starts(F.col("a")).alias("s")).collect():
        assert r["s"] == [sum(r["a"][:k]) for k in range(len(r["a"]))]
