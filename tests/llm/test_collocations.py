"""Collocations against SQL on awkward rows, by both encodings and without pruning, and the keys on their own."""

import random
from collections import Counter

import duckdb
import numpy as np

from shoalspark.llm import collocations as P
from shoalspark.llm.sql import ORACLES

SCHEMA = "lang string, text string, id long, word string, n int"


def rows():
    draw = random.Random(4)
    words = ["new", "york", "city", "hall", "of", "the", "Big", "apple", "ünder", "a\x01b", "x" * 50]
    made = []
    for k in range(260):
        lang = draw.choice(["en", "en", "de", None, "und"])
        text = "".join(draw.choice(words[: draw.randrange(2, 12)]) + draw.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for _ in range(draw.randrange(90)))
        made.append((lang, text + draw.choice(["New York City Hall", "", "the the the the the", "the big apple of the city. " * 3])))
    return [*made, *made[:40], ("en", None), (None, ""), ("fr", " .,;"), ("en", "new york " * 5000)]


def by_sql(data):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", data)
    return db.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({ORACLES['op13_collocations']}) ORDER BY 1, 2").fetchall()


def test_awkward_rows_equal_the_sql_in_every_way(spark, monkeypatch):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in data], SCHEMA).repartition(5)
    expected = by_sql(data)
    assert len(expected) > 100 and {r[0] for r in expected} >= {"en", "de", "und"}
    monkeypatch.setattr(P, "IDS", 50)
    for options in ({}, {"dictionary_rows": 0, "pruning_rows": 0}, {"pruning_rows": 20}):
        found = P.collocations(df, **options)
        assert [tuple(r) for r in found.orderBy("lang", "rank").collect()] == expected, options


def test_top_and_empty_tables(spark):
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in rows()], SCHEMA)
    assert max(r["rank"] for r in P.collocations(df, top=3).collect()) == 3
    assert P.collocations(df.limit(0)).count() == 0


def test_places_never_fall_as_keys_rise(spark):
    dictionary = spark.createDataFrame([(k, 100 // k + 1) for k in range(1, 60)], "id int, n long")
    for most in (1 << 16, 8):
        edges = P.bounds(dictionary, most)
        assert abs(edges[1].sum() - 1) < 1e-9
        first, second = (x.ravel() for x in np.meshgrid(np.arange(1, 60), np.arange(1, 60), indexing="ij"))
        where = P.place(first, second, *edges)
        assert (np.diff(where) >= -1e-12).all() and where[0] >= 0 and where[-1] <= 1


def test_long_texts_are_cut_between_words():
    text = "One two,three. four\n" * 50
    whole = [w for block in P.tokens(text) for w in block]
    assert [w for block in P.tokens(text, 7) for w in block] == whole and whole[:5] == [b"one", b"two", b".", b"three", b"."]


def test_what_a_task_holds_is_bounded_and_small_holdings_change_nothing(spark, monkeypatch):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in data], SCHEMA).repartition(2)
    monkeypatch.setattr(P, "SENT", 100)
    monkeypatch.setattr(P, "IDS", 50)
    found = P.phrase_counts(df, 30, 1_000_000, 4_000_000, held=300)[2]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, P.phrase_counts(df, 30, 1_000_000, 4_000_000)[2].collect()))


def test_own_runs_equal_counts():
    rng = np.random.default_rng(1)
    for words in (2, 3, 4):
        hi, lo = rng.integers(1, 30, 5000) << 32 | 3, rng.integers(1, 5, 5000) * (words > 2)
        expected = Counter(zip(hi.tolist(), lo.tolist()))
        made = P.own(hi, lo, words)
        assert list(zip(*(x.tolist() for x in made[:2]))) == sorted(expected) and dict(zip(zip(*(x.tolist() for x in made[:2])), made[2].tolist())) == expected
        assert [len(x) for x in P.own(np.empty(0, np.int64), np.empty(0, np.int64), words)] == [0, 0, 0]


def test_words_and_phrases_do_not_pass_the_driver(spark, monkeypatch):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "w", 2) for r in data], SCHEMA).repartition(5)
    taken = []
    for name in ("toPandas", "collect", "toArrow"):
        whole = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, whole=whole, **options: taken.extend(self.columns) or whole(self, **options))
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: taken.append("broadcast"))
    found = P.collocations(df)
    assert not {"word", "hi", "lo", "broadcast"} & set(taken), taken
    assert found._jdf.queryExecution().analyzed().toString().count("ResolvedHint") <= 1  # the totals of languages
    monkeypatch.undo()
    assert [tuple(r) for r in found.orderBy("lang", "rank").collect()] == by_sql(data)
