"""Language-model scores: counts and base scores in plain Python, the model as a probability, and awkward tables."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from shoalspark.llm import language_model as L

SCHEMA = "doc_id long, text string, score string, c int"
TEXTS = ["The cat sat on the mat.", "the CAT sat\non  the hat", None, "", " \t\n", "Ünïcode ÄÖ stays", "a" * 3000, "word " * 4000, "new words in here every time", "The cat sat on the mat."]


@pytest.fixture(scope="module")
def rows():
    made = [(k, TEXTS[k % len(TEXTS)] if k % 3 else f"the cat number {k} sat on the mat with hat {k % 7}", "x", 1) for k in range(120)]
    return [*made, (5, "twice", "x", 1), (5, "twice", "x", 1), (None, "no id", "x", 1)]


def out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def test_counts_and_base_scores(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learnt = Counter(w for i, t, *_ in rows if not out(i) for w in [*L.split(t), b""])
    n, v = sum(learnt.values()), len(learnt)
    expected = sorted((str(i), out(i), len(L.split(t)) + 1, sum(w in learnt for w in [*L.split(t), b""]), n, round(sum(math.log10((learnt[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*L.split(t), b""]), 6)) for i, t, *_ in rows)
    for few in (1 << 18, 5, 0):
        got = L.score_documents(df, common_words=few, chunk=7).collect()
        assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected, few
        assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in got)
        same = {}
        for r in got:
            same.setdefault((r["n_tokens"], round(r["base_score"], 6)), set()).add(round(r["score"], 6))
    assert len({round(r["score"], 5) for r in got if r["doc_id"] == 5 and r["n_tokens"] == 2}) == 1


def trained(spark):
    words = [(w, c) for w, c in {"": 9, "the": 30, "then": 4, "cat": 9, "cats": 2, "sat": 7, "ünder": 3, "once": 1}.items()]
    vocab = spark.createDataFrame(words, "word string, c long").repartition(2)
    return L.train(vocab, len(words), batch_words=3, words_a_task=4), dict(words)


def test_decision_counts_are_those_of_a_plain_count(spark):
    model, words = trained(spark)
    plain, keys = Counter(), Counter()
    for w, c in words.items():
        d = model.tables.decisions([w.encode()])
        for at in range(len(d.side)):
            for k, slots in enumerate(d.slots):
                if k < len(d.slots) - 1:
                    plain[int(slots[at]), bool(d.side[at])] += c
                elif c > 1:
                    keys[int(slots[at]), int(d.check[at]), bool(d.side[at])] += c
    last = model.tables.offset[-2]
    often = {(s, x): n for (s, x), n in plain.items() if plain[s, True] + plain[s, False] > 1}
    assert {(s, x): (model.yes if x else model.no)[s] for s, x in often} == often
    for slot, check, side in keys:
        if model.check[slot - last] == check:
            assert (model.yes if side else model.no)[slot] == keys[slot, check, side]
    assert sum(model.no[last:]) + sum(model.yes[last:]) == sum(keys.values())


def test_contexts_do_not_depend_on_the_words_beside(spark):
    model, _ = trained(spark)
    words = [b"the", b"", b"cats", "ünder".encode(), b"x" * 500]
    together = model.tables.decisions(words)
    alone = [model.tables.decisions([w]) for w in words]
    assert np.array_equal(together.check, np.concatenate([d.check for d in alone]))
    for k in range(len(L.ORDERS)):
        assert np.array_equal(together.slots[k], np.concatenate([d.slots[k] for d in alone]))


def test_words_of_a_start_sum_to_its_probability(spark):
    model, _ = trained(spark)
    scorer = L.Scorer(model)
    # All decisions of the next symbol after a start: its 256 symbols share the probability 1 for each way.
    for start in (b"", b"th", b"zz"):
        others = [s for s in range(256) if s != 32]
        each = []
        for s in [*others, None]:
            word = start + (bytes([s]) if s is not None else b"")
            x, _ = scorer.outputs([word])
            n = int(sum(model.tables.code.length[b] for b in start))
            m = int(model.tables.code.length[32 if s is None else s])
            each.append([np.prod(1 / (1 + np.exp(-(a * x[0][n : n + m].astype(float) + b * x[1][n : n + m])))) for a, b in L.WAYS])
        assert np.allclose(np.sum(each, 0), 1, atol=1e-4), start


def test_words_turn_to_text_and_back_in_one_go():
    for words in ([], [b""], [b"", b"a", "ünder".encode(), b""], [b"x\x1cy", "\u2028\x85".encode()]):
        assert L.as_text(words) == [w.decode() for w in words] and L.as_bytes(L.as_text(words)) == words


def test_trust_is_the_product_of_weighted_words():
    logs = np.log(np.random.default_rng(1).uniform(0.01, 0.9, (12, len(L.WAYS))))
    trust, total = np.full(len(L.WAYS), 1 / len(L.WAYS)), 0.0
    for word in np.exp(logs):
        total += math.log(trust @ word)
        trust = trust * word / (trust @ word)
    assert abs(L.trusted(logs.sum(0, keepdims=True))[0] - total) < 1e-9


def test_held_words_give_equal_logs(spark):
    model, _ = trained(spark)
    held, free = L.Held(L.Scorer(model), {b"the": 30}, limit=3), L.Scorer(model)
    for words in ([b"the", b"cat", b"the", b"dog", b"x"], [b"y", b"cat"], [b"x", b"the", b"z"], []):
        ids = held.look(words)
        assert np.allclose(held.logs[ids], free.logs(words)) and held.counts[ids].tolist() == [30 if w == b"the" else 0 for w in words]


def test_learning_improves_and_tables_may_be_empty(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert L.score_documents(df.limit(0)).count() == 0
    alone = L.score_documents(df.where("crc32(cast(doc_id as string)) % 5 = 1")).collect()
    assert alone and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in alone)
    whole = {r["doc_id"]: r["score"] for r in L.score_documents(df).collect()}
    assert sum(whole[r["doc_id"]] for r in alone) > sum(r["score"] for r in alone)


def test_shared_starts_change_nothing(spark):
    model, _ = trained(spark)
    scorer = L.Scorer(model)
    words = [b"", b"t", b"the", b"then", b"them", b"cat", b"cats", b"catsx", "ünder".encode(), "über".encode(), b"x" * 40, b"x" * 40 + b"y", b"x" * 33, b"a\x00b", b"a\x00", b"a"]
    alone = np.vstack([scorer.logs([w]) for w in words])
    for step in (3, 100):
        assert np.allclose(scorer.logs(words, step), alone, atol=1e-4)
    plain = []
    for w in words:
        x, d = scorer.outputs([w])
        plain.append([-np.log1p(np.exp(-(a * x[0].astype(float) + b * x[1]))).sum() for a, b in L.WAYS])
    assert np.allclose(alone, plain, atol=1e-3)
