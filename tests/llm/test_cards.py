"""Cards beside other numbers."""

import pytest

from shoalspark.llm import pii

CARD = "4111111111111111"
BESIDE = [
    ("4111 1111 1111 1111 12/27", "", " 12/27"),
    ("4111111111111111 123 ok", "", " 123 ok"),
    ("card 4111111111111111 2. Next", "card ", " 2. Next"),
    ("4111-1111-1111-1111 737", "", " 737"),
    ("4111 1111 1111 1111 2027", "", " 2027"),
    ("2024 4111 1111 1111 1111", "2024 ", ""),
    ("2024 4111 1111 1111 1111 12/27", "2024 ", " 12/27"),
    ("23456789 4111 1111 1111 1111", "23456789 ", ""),
    ("2345 4111111111111111.", "2345 ", "."),
]
OTHERS = [("3782 822463 10005 1234", "", " 1234"), ("4222222222222 12 x", "", " 12 x")]


@pytest.fixture(scope="module")
def made(spark):
    texts = [t for t, _, _ in BESIDE + OTHERS] + ["4111 1111 1111 1112 345", "4111 1111 1111 1111 5500 0000 0000 0004", "4111 1111 1111 1111 123-45-6789"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pseudonymise(docs, "key", counts=True).collect()}
    whole = {r.doc_id: r.text for r in pii.pseudonymise(docs, "key").collect()}
    assert all(whole[k] == r.text for k, r in rows.items())
    return {t: rows[i] for i, t in enumerate(texts)}


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(c if i % 2 == 0 else c * 2 // 10 + c * 2 % 10 for i, c in enumerate(digits)) % 10 == 0


@pytest.mark.parametrize(("text", "before", "after"), BESIDE + OTHERS)
def test_card_beside_a_number(made, text, before, after):
    new, old = made[text].text, text[len(before) : len(text) - len(after)]
    got = new[len(before) : len(new) - len(after)]
    assert made[text].n_card == 1 and new.startswith(before) and new.endswith(after) and len(new) == len(text)
    assert got != old and _luhn(got) and [c.isdigit() for c in got] == [c.isdigit() for c in old]


def test_one_card_has_one_surrogate(made):
    assert made["4111111111111111 123 ok"].text.split()[0] == made["card 4111111111111111 2. Next"].text.split()[1]


def test_numbers_without_a_card_and_neighbours_that_are_entities(made):
    assert made["4111 1111 1111 1112 345"].text == "4111 1111 1111 1112 345"
    two = made["4111 1111 1111 1111 5500 0000 0000 0004"]
    assert two.n_card == 2 and two.text[:19] != "4111 1111 1111 1111" and two.text[20:] != "5500 0000 0000 0004"
    ssn = made["4111 1111 1111 1111 123-45-6789"]
    assert (ssn.n_card, ssn.n_ssn) == (1, 1) and "123-45-6789" not in ssn.text
