"""Sequence packing: shortest-pack-first over the length histogram.

Tasks tokenize and cut; only the histogram of piece lengths (at most max_tokens rows) reaches the driver. Patterns are
packed there, longest lengths first, each into the pack with most space left, and joined back to pieces by their rank
among the pieces of one length.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut

MAX_TOKENS, END_ID = 2048, 1


#: What a tokenizer file says of itself where texts may be taken apart into words as WordIds does.
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}


def wordwise(tokenizer) -> bool:
    """Whether a tokenizer is of the kind that WordIds takes apart: its settings, its model's, and special tokens that begin with "<|"."""
    said = json.loads(tokenizer.to_str())
    marks = all(t["content"].startswith("<|") and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in said["added_tokens"])
    return marks and all(said[k] == v for k, v in WORDWISE.items()) and all(said["model"].get(k) == v for k, v in MODEL.items()) and not said.get("truncation") and not said.get("padding")


class WordIds(dict):
    """word bytes -> its ids as little-endian 32-bit bytes; at most 2 * limit words are held.

    The tokenizer lowers cases, cuts at white space and between letters and punctuation, and looks at no piece from
    another, so a text's ids are those of its pieces: lower-case words, with a full stop or comma after a letter and
    before white space as a piece of its own. Texts with a mark of special tokens, whose case counts, keep their case.
    Words that are not held are encoded together, a mark that is a token of its own after each; those of printable ASCII
    alone need no normalizing, so their pieces go straight to the tokenizer's model. A tokenizer of another kind encodes
    whole texts.
    """

    STOPS = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")
    MARK = "\x01"
    PLAIN = re.compile(r"[!-&(-;=-@\[-~]+").fullmatch  # no capitals, no apostrophe and no start of a special token
    PIECES = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+").findall

    def __init__(self, path: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit, self.before = Tokenizer.from_file(path), limit, {}
        self.whole = not wordwise(self.tokenizer)
        if not self.whole:
            (self.mark,) = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids

    def split(self, text: str) -> list[bytes]:
        raw = text.encode()
        if b"<|" not in raw:
            raw = self.STOPS.sub(rb" \1", raw.lower())
        return raw.split()

    def encode(self, words: list[bytes], at_once: int = 256) -> None:
        """Holds the ids of words."""
        rest, tokenize = [], self.tokenizer.model.tokenize
        for word in words:
            text = word.decode()
            if self.PLAIN(text):
                self[word] = array("I", [t.id for p in self.PIECES(text) for t in tokenize(p)]).tobytes()
            elif self.MARK in text:
                self[word] = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                rest.append(word)
        after = f" {self.MARK} "
        blocks = [rest[i : i + at_once] for i in range(0, len(rest), at_once)]
        made = self.tokenizer.encode_batch_fast([b" ".join(b).decode().replace(" ", after) + after for b in blocks], add_special_tokens=False)
        for block, m in zip(blocks, made, strict=True):
            ids = np.array(m.ids, "<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark)).tolist()
            self.update(zip(block, (raw[a:b] for a, b in zip([0, *(e + 4 for e in ends[:-1])], ends, strict=True)), strict=True))

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if self.whole:
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        split = [self.split(t) for t in texts]
        if len(self) > self.limit:
            self.before = dict(self)
            self.clear()
        missing = []
        for word in set().union(*split):
            if word not in self:
                if (held := self.before.get(word)) is None:
                    missing.append(word)
                else:
                    self[word] = held
        self.encode(missing)
        out = [b"".join(map(self.__getitem__, words)) for words in split]
        for word in missing:
            if len(word) > 64:
                del self[word]
        return out


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a Python worker."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document's ids and end_id, cut every max_tokens ids.

    Null and empty texts are the end_id alone. Repeated rows are documents of their own.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = word_ids(tokenizer_path)
        for batch in batches:
            rows = []
            for first in range(0, len(batch), 256):
                some = batch.iloc[first : first + 256]
                for doc_id, ids in zip(some["doc_id"], ids_of.of([t or "" for t in some["text"]]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    rows.extend((doc_id, at, min(max_tokens, n - at), zlib.crc32(ids[4 * at : 4 * (at + max_tokens)]), n) for at in range(0, n, max_tokens))
            made = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield made.astype({"doc_id": batch["doc_id"].dtype} if len(made) else {})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


@dataclass
class Plan:
    """Slots by length and rank: ranks from first on, each times of them in one sequence."""

    key: np.ndarray  # length << 48 | first rank, ascending
    times: np.ndarray
    sequence: np.ndarray  # of the first rank
    offset: np.ndarray  # of the first slot
    sequences: int


def plan(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> Plan:
    """Shortest-pack-first. There are at most as many open patterns as lengths, whatever the counts are."""
    space: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}  # space left -> patterns ((length, times), ...) and counts
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((s for s, held in space.items() if held and s >= length), default=None)
            if room is None:
                space.setdefault(max_tokens - length, []).append((((length, 1),), left))
                break
            pattern, count = space[room].pop()
            n = min(left, count)
            if n < count:
                space[room].append((pattern, count - n))
            # As many of one length at a time as leave no pack emptier than the others are.
            more = (*pattern[:-1], (length, pattern[-1][1] + 1)) if pattern[-1][0] == length else (*pattern, (length, 1))
            space.setdefault(room - length, []).append((more, n))
            left -= n
    rank: dict[int, int] = dict.fromkeys(histogram, 0)
    rows, sequence = [], 0
    for room in sorted(space):
        for pattern, count in space[room]:
            offset = 0
            for length, times in pattern:
                rows.append((length << 48 | rank[length], times, sequence, offset))
                rank[length] += times * count
                offset += length * times
            sequence += count
    rows.sort()
    key, times, first, offset = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 4))
    return Plan(key, times, first, offset, sequence)


def pack(cut_pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """cut_pieces (any columns with length) with sequence_id and offset.

    Pieces of one length are ranked in buckets by hash, so a length that many share is spread; the counts by length and
    bucket (at most max_tokens * buckets rows) give each bucket its first rank.
    """
    session = cut_pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    made = session.sparkContext.broadcast(plan(histogram, max_tokens))
    buckets = max(64, max(histogram.values(), default=0) // 200_000)
    rows = cut_pieces.select(F.struct("*").alias("piece"), "length", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int").alias("bucket"))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    firsts = sizes.select(F.col("length").alias("of"), F.col("bucket").alias("part"), (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("first"))
    place = Window.partitionBy("length", "bucket").orderBy("piece.doc_id", "piece.start", "piece.ids_crc32")
    ranked = rows.withColumn("at", F.row_number().over(place) - 1)
    ranked = ranked.join(firsts, (F.col("length") == F.col("of")) & (F.col("bucket") == F.col("part")))

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = made.value
        i = np.searchsorted(p.key, (length.to_numpy() << 48) | rank.to_numpy(), side="right") - 1
        instance, turn = np.divmod(rank.to_numpy() - (p.key[i] & ((1 << 48) - 1)), p.times[i])
        return pd.DataFrame({"sequence_id": p.sequence[i] + instance, "offset": p.offset[i] + turn * length.to_numpy()})

    return ranked.select("piece.*", slot("length", F.col("at") + F.col("first")).alias("slot")).select(*cut_pieces.columns, "slot.sequence_id", "slot.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """pieces() of docs, placed by pack(). An empty table gives no pieces. Only doc_id and text are read."""
    return pack(cut(pieces(docs, tokenizer_path, max_tokens, end_id)), max_tokens)
