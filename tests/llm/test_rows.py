"""Awkward rows for every operator: nulls, empty and very long texts, repeated rows, empty tables, clashing names."""

import pytest
from pyspark.sql import functions as F

from shoalspark.llm import embeddings, mixing, packing, pii, quality_classifier, quality_rules, secrets, simhash, token_counts, warc
from shoalspark.llm.registry import PIECE_TOKENIZER, WORD_TOKENIZER, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, bucket int, key string, s string"
LONG = "word and more " * 30_000
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", "b", 3), (5, LONG, "en", "b", len(LONG)),
    (6, "the same text in two rows " * 12, "en", "c", 1), (6, "the same text in two rows " * 12, "en", "c", 1), (7, "the same text in two rows " * 12, "en", None, 1), (None, "no id here at all", "de", "c", 1), (8, "a　b é 日本 \x00 \U0001f600", "ja", "c", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "y", 1, "k", "s") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")


EVERY = {
    "rules": lambda d, _: quality_rules.verdicts(quality_rules.ledger(d)),
    "secrets": lambda d, _: secrets.find_secrets(d),
    "classifier": lambda d, labels: quality_classifier.classify(d, labels),
    "pii": lambda d, _: pii.pseudonymise(d, "key"),
    "simhash": lambda d, _: simhash.near_duplicates(d),
    "tokens": lambda d, _: token_counts.count_tokens(d, tokenizer_path(PIECE_TOKENIZER)),
    "mixing": lambda d, _: mixing.mix(d),
}


@pytest.mark.parametrize("name", sorted(EVERY))
def test_one_row_for_each(docs, labels, name):
    assert EVERY[name](docs, labels).count() == len(ROWS)


@pytest.mark.parametrize("name", sorted(EVERY))
def test_empty_table(docs, labels, name):
    assert EVERY[name](docs.limit(0), labels.limit(0)).count() == 0


def test_packing_of_awkward_rows(docs):
    made = packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER)).collect()
    assert sum(r.length for r in made if r.start == 0 and r.doc_tokens == r.length and r.doc_id in (1, 2, 3)) == 3
    assert sum(r.length for r in made) == sum(r.doc_tokens for r in made if r.start == 0)
    assert packing.pack_documents(docs.limit(0), tokenizer_path(WORD_TOKENIZER)).count() == 0


def test_null_texts_and_ties(docs):
    kept = {r.doc_id: r for r in quality_rules.verdicts(quality_rules.ledger(docs)).collect()}
    assert not kept[1].kept and kept[1].n_words == 0 and kept[5].n_repeat_words == kept[5].n_words
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (3, 1), (6, 6), (7, 6)} <= found
    assert sorted(r.doc_id or 0 for r in simhash.drop_near_duplicates(docs).select(docs.columns).collect()).count(6) == 1
    assert quality_rules.keep_good(docs).columns == docs.columns == pii.pseudonymise(docs, "key").columns == mixing.mix_documents(docs).columns


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(1)).withColumn("v", F.lit("x"))
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(v).collect())
    assert got == [(0, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False)] + [(i, 0, i, True) for i in range(3, 12)]
    assert embeddings.near_duplicates(v.limit(0)).count() == 0


def test_awkward_pages(spark):
    same = "x" * 150
    rows = [(3, "http://b/\r\nc", same), (1, None, same), (1, None, same), (2, "u", None), (4, "u", ""), (None, "u", same), (5, "é", "ü" * 60), (6, "v", "short"), (7, "v", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages, roll_bytes=200).collect())
    assert [g[:3] for g in got] == [(0, 150, "revisit"), (1, 150, "response"), (1, 150, "revisit"), (2, 0, "response"), (3, 150, "revisit"), (4, 0, "response"), (5, 120, "response"), (6, 5, "response"), (7, 5, "response")]
    assert [g[3] for g in got if g[2] == "revisit"] == [1, 1, 1]
    assert warc.round_trip(pages.limit(0)).count() == 0
