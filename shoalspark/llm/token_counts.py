"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch are one ragged array of symbols. Every step looks up the rank of each neighbouring pair, takes
the lowest rank of every sequence, and merges it in all sequences at once; what survives is counted.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.iinfo(np.int64).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol buffer's message: bytes, or a whole number for varints and fixed widths."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at, value, shift = at + 1, value | (b & 127) << shift, shift + 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 8 if key & 7 == 1 else 4
            yield key >> 3, int.from_bytes(data[at : at + n], "little")
            at += n


def mergeable(model: bytes) -> bool:
    """Whether a serialised sentencepiece model merges pairs by rank: BPE with byte fallback, white space before words, no pieces of a user's own."""
    trainer: dict[int, int | bytes] = {}
    for number, value in _fields(model):
        if number == 1 and dict(_fields(value)).get(3, 1) == 4:  # a piece, and its type
            return False
        if number == 2:
            trainer = dict(_fields(value))
    return trainer.get(3, 1) == 2 and trainer.get(35, 0) == 1 and not trainer.get(24, 0)


class PieceMerger:
    """Symbols, pair ranks and normalisation of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        lib = self.library
        plain = [i for i in range(lib.vocab_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        piece = {lib.id_to_piece(i): i for i in plain}
        order = {s: r for r, s in enumerate(sorted({-lib.get_score(i) for i in plain}))}
        scores, times = np.unique([-lib.get_score(i) for i in plain], return_counts=True)
        self.tied = np.array([order[s] for s in scores[times > 1].tolist()], np.int64)
        self.char = {p: i for p, i in piece.items() if len(p) == 1}
        self.size = lib.vocab_size()
        made = {}
        for p, i in piece.items():
            for k in range(1, len(p)):
                a, b = piece.get(p[:k]), piece.get(p[k:])
                if a is not None and b is not None:
                    made[a * self.size + b] = (order[-lib.get_score(i)], i)
        self.keys = np.array(sorted(made), np.int64)
        self.rank = np.array([made[k][0] for k in self.keys.tolist()] + [NONE], np.int64)
        self.merged = np.array([made[k][1] for k in self.keys.tolist()] + [-1], np.int64)
        # White space marks start pieces and never follow other symbols in one, so what precedes them is a unit of its own.
        if any("▁" in p.lstrip("▁") or "\n" in p for p in piece):
            self.units = re.compile(r"(?s).+")
        else:
            self.units = re.compile(r"\n|▁*[^▁\n]+|▁+")

    def split(self, text: str) -> list[str]:
        return self.units.findall(self.library.normalize(text)) if text else []

    def _pairs(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place in the table of the pair at each symbol and the next."""
        key = np.where((seq[:-1] == seq[1:]) & (sym[:-1] >= 0) & (sym[1:] >= 0), sym[:-1] * self.size + sym[1:], -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        at = np.append(np.where(self.keys[at] == key, at, len(self.keys)), len(self.keys))
        return self.rank[at], at

    @staticmethod
    def _merge(sym: np.ndarray, seq: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sym = np.where(chosen, new, sym)
        stay = ~np.append(False, chosen[:-1])
        return sym[stay], seq[stay]

    def counts(self, units: list[str]) -> np.ndarray:
        """Surviving symbols of each unit; a symbol outside the vocabulary counts its UTF-8 bytes."""
        out = np.zeros(len(units), np.int64)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        chars = "".join(units)
        get = self.char.get
        sym = np.fromiter((get(c, -len(c.encode())) for c in chars), np.int64, len(chars))
        seq = np.repeat(np.arange(len(units)), lengths)
        while len(sym):
            rank, at = self._pairs(sym, seq)
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            best = np.minimum.reduceat(rank, starts)
            spread = np.repeat(best, np.diff(np.append(starts, len(seq))))
            over = spread == NONE
            if over.any():
                np.add.at(out, seq[over], np.where(sym[over] < 0, -sym[over], 1))
                keep = ~over
                sym, seq, rank, at, spread = sym[keep], seq[keep], rank[keep], at[keep], spread[keep]
                if not len(sym):
                    break
            lowest = rank == spread
            # Of runs of overlapping lowest pairs every second is merged, from the left.
            place = np.arange(len(sym))
            run = np.maximum.accumulate(np.where(lowest & ~np.append(False, lowest[:-1]), place, -1))
            every = lowest & ((place - run) % 2 == 0)
            first = np.zeros(len(sym), bool)
            first[np.flatnonzero(lowest)[np.unique(seq[lowest], return_index=True)[1]]] = True
            chosen = np.where(np.isin(spread, self.tied), first, every) if len(self.tied) else every
            new = self.merged[at]
            sym2, seq2 = self._merge(sym, seq, new, chosen)
            # If merging all made a pair of a lower rank, that pair's turn came before the later ones: take the first only.
            rank2, _ = self._pairs(sym2, seq2)
            starts2 = np.flatnonzero(np.append(True, seq2[1:] != seq2[:-1]))
            early = np.minimum.reduceat(rank2, starts2) < spread[np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))]
            if early.any():
                again = np.isin(seq, seq2[starts2][early])
                sym2, seq2 = self._merge(sym, seq, new, np.where(again, first, chosen))
            sym, seq = sym2, seq2
        return out


class Counter:
    """Token counts of texts; counts of at most limit short units are held between batches. Models of another kind than the
    merger's count whole texts by their library."""

    def __init__(self, path: str, limit: int = 200_000):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        self.library = None if mergeable(library.serialized_model_proto()) else library
        self.merger, self.held, self.limit = PieceMerger(path) if self.library is None else None, {}, limit

    def count(self, texts: list[str | None]) -> list[int]:
        if self.library is not None:
            return [len(self.library.encode(t or "")) for t in texts]
        split = [self.merger.split(t or "") for t in texts]
        missing = list(set().union(*split) - self.held.keys())
        if len(self.held) + len(missing) > self.limit:
            missing, self.held = list(set().union(*split)), {}
        self.held |= zip(missing, self.merger.counts(missing).tolist(), strict=True)
        counts = [sum(map(self.held.__getitem__, units)) for units in split]
        for unit in missing:
            if len(unit) > 64:
                del self.held[unit]
        return counts


@functools.lru_cache(maxsize=1)
def counter_of(path: str) -> Counter:
    """One for all tasks of a Python worker."""
    return Counter(path)


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, chunk: int = 256) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per input row, over whole texts; null is empty and has 0 tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = counter_of(model_path)
        for batch in batches:
            texts = batch["text"].tolist()
            n = [c for at in range(0, len(texts), chunk) for c in counter.count(texts[at : at + chunk])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": np.array(n, np.int64)})

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")).mapInPandas(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
