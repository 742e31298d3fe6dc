"""Tokenizers of another kind than the fast paths know are used as their libraries use them."""

import json

import pytest

from shoalspark.llm import packing, token_counts
from shoalspark.llm.registry import PIECE_TOKENIZER, WORD_TOKENIZER, tokenizer_path

TEXTS = ["Hello  World, it's 42 ÄÖ", "", "<|endoftext|> and \n\t more", "word " * 300, "日本 é́ 🙂"]


def test_the_known_files_take_the_fast_path():
    assert not packing.WordIds(tokenizer_path(WORD_TOKENIZER)).whole
    assert token_counts.Counter(tokenizer_path(PIECE_TOKENIZER)).library is None


@pytest.mark.parametrize("change", [{"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, None])
def test_other_words_are_encoded_whole(tmp_path, change):
    from tokenizers import Tokenizer

    said = json.load(open(tokenizer_path(WORD_TOKENIZER if change else "byte_bpe_50k.json")))
    path = tmp_path / "other.json"
    path.write_text(json.dumps(said | (change or {})))
    ids = packing.WordIds(str(path))
    library = Tokenizer.from_file(str(path))
    assert ids.whole
    import numpy as np

    assert [np.frombuffer(b, "<u4").tolist() for b in ids.of(TEXTS)] == [library.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_other_pieces_are_counted_by_the_library(tmp_path):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=tokenizer_path(PIECE_TOKENIZER)).serialized_model_proto()
    assert token_counts.mergeable(model)
    piece = b"\x0a\x05zqzqz\x15\x00\x00\x00\x00\x18\x04"  # a piece of a user's own at the end of the vocabulary
    other = model + b"\x0a" + bytes([len(piece)]) + piece
    assert not token_counts.mergeable(other)
    path = tmp_path / "other.model"
    path.write_bytes(other)
    library = SentencePieceProcessor(model_file=str(path))
    texts = [*TEXTS, "a zqzqz b"]
    assert token_counts.Counter(str(path)).count(texts) == [len(library.encode(t)) for t in texts]
