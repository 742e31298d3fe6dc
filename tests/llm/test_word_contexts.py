"""Contexts of words before: against plain Python, as a probability, and in the scores of the query."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shoalspark.llm import language_model as L
from shoalspark.llm import word_contexts as W

SCHEMA = "doc_id long, text string"


def out(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


@pytest.fixture(scope="module")
def texts():
    words, at = [f"w{k}" for k in range(300)], random.Random(3)
    phrases = [" ".join(at.choices(words, k=40)) for _ in range(6)]
    return [" ".join(at.choices(phrases, k=4)) if k % 2 else " ".join(at.choices(words, k=160)) for k in range(200)]


def looked(mixer, texts):
    split = [[*L.split(t), b""] for t in texts]
    return mixer.look(W.hashes_of([w for t in split for w in t]), np.array([len(t) for t in split]))


def test_the_order_of_words_is_scored(spark, texts):
    held = [k for k in range(1000, 2000) if out(k)][:2]
    turned = " ".join(reversed(texts[1].split()))
    rows = [*enumerate(texts), (held[0], texts[1]), (held[1], turned)]
    got = {r["doc_id"]: r for r in L.score_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    a, b = got[held[0]], got[held[1]]
    assert a["held_out"] and b["held_out"] and (a["n_tokens"], a["n_known"], round(a["base_score"], 6)) == (b["n_tokens"], b["n_known"], round(b["base_score"], 6))
    assert a["score"] > b["score"] / 2, "words that a context leads to cost little"


def test_hashes_are_those_of_single_words():
    words = [b"a", b"ab", b"ba", b"", "ünder".encode(), b"x" * 3000, b"\x00", b"a"]
    each = W.hashes_of(words)
    assert each.tolist() == [int(W.hashes_of([w])[0]) for w in words] and len(set(each.tolist())) == len(words) - 1
    assert W.word_hashes(b"a \t\n ab\x0b\x0c\rba ").tolist() == each[:3].tolist() and len(W.hashes_of([])) == 0


def test_own_words_are_those_of_a_plain_search():
    at = random.Random(5)
    split = [[*at.choices([b"a", b"b", b"c"], k=n), b""] for n in (0, 1, 2, 30, 50)]
    flat = [w for t in split for w in t]
    s = W.sequence(W.hashes_of(flat), np.array([len(t) for t in split]))
    word, cases = W.own_words(s)
    hashes, k = W.hashes_of(flat).astype(np.uint32), 0
    for t in split:
        seen, marked, first = {}, [None] * W.OWN + t, k
        for i in range(len(t)):
            context = tuple(marked[i : i + W.OWN])
            before = seen.setdefault(context, [])
            assert cases[k] == len(before) and (not before or word[k] == hashes[first + before[-1]]), (t, i)
            before.append(i)
            k += 1


def test_votes_are_those_of_a_plain_count():
    at = np.random.default_rng(7)
    slot, word, votes = at.integers(0, 40, 500), at.integers(0, 3, 500).astype(np.uint32), at.integers(1, 5, 500)
    plain = Counter()
    for s, w, n in zip(slot.tolist(), word.tolist(), votes.tolist(), strict=True):
        plain[s, w] += n
    expected = {}
    for s in range(40):
        n, w = max((plain[s, w], w) for w in range(3))
        if 2 * n > (total := sum(plain[s, w] for w in range(3))):
            expected[s] = (w, 2 * n - total)
    for order in (np.arange(500), at.permutation(500)):
        a, b, c = W.majority(slot[order], word[order], votes[order])
        assert {int(x): (int(y), int(z)) for x, y, z in zip(a, b, c, strict=True)} == expected
    table = W.Follow(W.LEAST_BITS)
    for w in ([9, 9, 9], [9, 4], [4, 4, 4, 4], [5]):
        table.add(0, np.full(len(w), 3), np.array(w, np.uint32))
    assert (table.word[0][3], table.votes[0][3]) == (5, 0) or (table.word[0][3], table.votes[0][3]) == (4, 0)
    table.add(0, np.full(2, 3), np.array([8, 8], np.uint32))
    assert (table.word[0][3], table.votes[0][3]) == (8, 2)


def test_probabilities_of_the_next_word_sum_to_one(spark, texts):
    mixer = W.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2), 32000)
    words = [f"w{k}" for k in range(300)]
    before = texts[1].split()[:100]
    spelled = np.log(np.random.default_rng(1).dirichlet(np.ones(301)))
    missed, came = looked(mixer, [" ".join([*before, w]) for w in words] + [" ".join(before)])
    ends = [(k + 1) * 102 - 2 for k in range(300)] + [300 * 102 + 100]
    made = W.combined(spelled[:, None], missed[ends], came[ends])
    assert abs(np.exp(made).sum() - 1) < 1e-6 and (came[ends] > -np.inf).sum() >= 1


def test_weights_learn_from_the_text_but_not_from_what_follows(spark, texts):
    mixer = W.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2), 32000)
    start, other = texts[1], texts[2]
    alone, followed, both = looked(mixer, [start]), looked(mixer, [start + " " + other]), looked(mixer, [other, start])
    n = len(start.split())
    for a, b, c in zip(alone, followed, both, strict=True):
        assert np.array_equal(a[:n], b[:n]) and np.allclose(a[:n], c[-n - 1 : -1])
    frozen = W.WordMixer(mixer.table, mixer.odds, mixer.weights)
    rate, W.RATE = W.RATE, 0
    try:
        still = looked(frozen, [start])
    finally:
        W.RATE = rate
    assert np.array_equal(still[0][: W.BLOCK], alone[0][: W.BLOCK]) and not np.allclose(still[1][W.BLOCK : n], alone[1][W.BLOCK : n])


def test_tables_do_not_depend_on_parts(spark, texts):
    rows = spark.createDataFrame([(t,) for t in [*texts, None, "", " \t "]], "text string").coalesce(1)
    one, small = W.train(rows, 32000), W.train(rows, 32000, slice_bytes=500)
    split = [[*L.split(t), b""] for t in texts]
    hashes, sizes = W.hashes_of([w for t in split for w in t]), np.array([len(t) for t in split])
    for a, b in zip(one.look(hashes, sizes), one.look(hashes, sizes, words=300), strict=True):
        assert np.allclose(a, b)
    assert one.table.bits == small.table.bits == 15
    assert (one.table.votes[0] > 0).sum() > 100
    assert W.train(rows.limit(0), 0).look(W.hashes_of([b"a", b""]), np.array([2]))[0].tolist() == [0, 0]
