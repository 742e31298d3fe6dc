"""Decisions that hang on the words before: is the next word the one that a context leads to?

Contexts are the three words before, in a hashed table learnt from the corpus, and the two words before in the text itself,
up to the word. Every context that knows a word is asked in turn, the text's own first, unless that word was asked for
already. Such a decision's log odds are a logistic mix of what all contexts say of that word. Its weights are learnt online:
over the training texts, each predicted before it is learnt, and on from there, word by word, over the text that is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: The corpus's contexts by their words, and that of the text itself, whose words are OWN.
TABLES, OWN = (3,), 2
KINDS = len(TABLES) + 1
LEAST_BITS, MOST_BITS, PART_BITS = 12, 22, 14
#: A table's context counts from so many more cases for its word than against it.
LEAST = 2
LEVELS, INPUTS, RATE = 8, KINDS + 1, 0.02
#: Words of a text between two steps of its weights.
BLOCK = 16
MARK = b"\xff"  # before and after a text, as no UTF-8 holds it
_ODD, _SPREAD, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFFFFFFFF)
_INVERSE = np.uint64(pow(int(_SPREAD), -1, 1 << 64))
_VALUE = (np.arange(1, 257, dtype=np.uint64) * _ODD) ^ (np.arange(1, 257, dtype=np.uint64) * _SPREAD >> np.uint64(23))
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Level of so many votes: steps of twice as many.
_LEVEL = np.minimum(np.ceil(np.log2(1 + np.arange(1 << LEVELS))), LEVELS - 1).astype(np.int8)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of lower-case bytes that start with a word and end with a blank."""
    b = np.frombuffer(text, np.uint8)
    if len(_POWERS[0]) < len(b):
        for k, base in enumerate((_SPREAD, _INVERSE)):
            _POWERS[k] = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(b), base)))
    blank = _BLANK.take(b)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    ends, starts = edges[::2], np.append(0, edges[1::2])
    total = _VALUE.take(b)
    total *= _POWERS[0][: len(b)]
    total = np.append(np.uint64(0), np.cumsum(total, out=total))
    h = (total.take(ends) - total.take(starts)) * _POWERS[1].take(starts)
    h ^= h >> np.uint64(29)
    h *= _ODD
    return h ^ (h >> np.uint64(32))


def hashes_of(words: list[bytes]) -> np.ndarray:
    """Hashes of words without blanks; the empty one is the end."""
    return word_hashes(b" ".join([w or MARK for w in words]) + b" ") if words else np.empty(0, np.uint64)


@dataclass
class Sequence:
    """The words and ends of texts: hash, text and place of each, and its contexts."""

    word: np.ndarray
    text: np.ndarray
    place: np.ndarray
    contexts: list[np.ndarray]


def sequence(hashes: np.ndarray, sizes: np.ndarray) -> Sequence:
    """Of the hashes of texts' words and ends, so many a text."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    most = max(*TABLES, OWN)
    at = np.arange(len(hashes)) + most * (text + 1)
    wide = np.full(len(hashes) + most * len(sizes), hashes_of([b""])[0])
    wide[at] = hashes
    contexts, c = [], np.zeros(len(hashes), np.uint64)
    for k in range(1, most + 1):
        c = (c + wide.take(at - k)) * _SPREAD
        c ^= c >> np.uint64(31)
        contexts.append(c * _ODD)
    return Sequence(hashes, text, np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), contexts)


def heads(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)


def majority(slot: np.ndarray, word: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, the word of each with most votes, and its votes less all others', where they are more. The order of rows is nothing to it."""
    order = np.lexsort((word, slot))
    slot, word, votes = slot[order], word[order], votes[order]
    each = heads((slot.astype(np.uint64) << np.uint64(32)) | word)
    slot, word, votes = slot[each], word[each], np.add.reduceat(votes, each) if len(each) else votes
    lead = heads(slot)
    if not len(lead):
        return slot, word, votes
    total = np.add.reduceat(votes, lead)
    best = np.maximum.reduceat((votes.astype(np.uint64) << np.uint64(32)) | word, lead)
    more = 2 * (best >> np.uint64(32)).astype(np.int64) - total
    kept = more > 0
    return slot[lead][kept], (best & _LOW).astype(np.uint32)[kept], more[kept]


class Follow:
    """Of each table's slots, the word that its contexts lead to and the votes for it."""

    def __init__(self, bits: int):
        self.bits = bits
        self.word = [np.zeros(1 << bits, np.uint32) for _ in TABLES]
        self.votes = [np.zeros(1 << bits, np.uint16) for _ in TABLES]

    def slots(self, contexts: list[np.ndarray]) -> list[np.ndarray]:
        return [(contexts[k - 1] >> np.uint64(64 - self.bits)).view(np.int64) for k in TABLES]

    def add(self, k: int, slot: np.ndarray, word: np.ndarray) -> None:
        """Votes of a table's new cases: those for a slot's word are added to its votes, others taken from them."""
        key = np.sort((slot.astype(np.uint64) << np.uint64(32)) | word)
        each = heads(key)
        n, key = np.diff(np.append(each, len(key))), key[each]
        s = (key >> np.uint64(32)).view(np.int64)
        lead = heads(s)
        best = np.maximum.reduceat((n.astype(np.uint64) << np.uint64(32)) | (key & _LOW), lead)
        s, word, more = s[lead], (best & _LOW).astype(np.uint32), 2 * (best >> np.uint64(32)).astype(np.int64) - np.add.reduceat(n, lead)
        own, had = self.word[k].take(s), self.votes[k].take(s).astype(np.int64)
        left = np.where(own == word, had + more, had - more)
        self.word[k][s] = np.where((left < 0) | ((had == 0) & (more > 0)), word, own)
        self.votes[k][s] = np.minimum(np.where(had == 0, np.maximum(more, 0), np.abs(left)), 65535)


def own_words(s: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """The word that followed a context's last case in the same text, and the number of its cases before."""
    n, shift = len(s.word), np.uint64(len(s.word).bit_length())
    mixed = (s.contexts[OWN - 1] + (s.text.astype(np.uint64) + np.uint64(1)) * _SPREAD) * _ODD
    key = np.sort(((mixed >> shift) << shift) | np.arange(n, dtype=np.uint64))
    at = (key & ((np.uint64(1) << shift) - np.uint64(1))).view(np.int64)
    context, text = s.contexts[OWN - 1].take(at), s.text.take(at)
    same = np.append(False, (context[1:] == context[:-1]) & (text[1:] == text[:-1]))
    before = np.arange(n) - np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    word, cases = np.zeros(n, np.uint32), np.zeros(n, np.int64)
    word[at[1:]] = np.where(same[1:], s.word.take(at[:-1]).astype(np.uint32), 0)
    cases[at] = before
    return word, cases


@dataclass
class Asked:
    """Decisions: place in the sequence, kind of the context that is asked, what each kind says (a row a kind: its level, less than 0 against that word, 0 not known), and whether the word comes."""

    at: np.ndarray
    kind: np.ndarray
    says: np.ndarray
    hit: np.ndarray


def ask(s: Sequence, table: Follow) -> Asked:
    word, votes = [], []
    for k, slot in enumerate(table.slots(s.contexts)):
        word.append(table.word[k].take(slot))
        v = table.votes[k].take(slot)
        votes.append(np.where(v >= LEAST, v, 0))
    for made, new in zip((word, votes), own_words(s), strict=True):
        made.append(new)
    level = [_LEVEL.take(v, mode="clip") for v in votes]
    comes, left, tried, parts = s.word.astype(np.uint32), np.ones(len(s.word), bool), [], []
    for k in reversed(range(KINDS)):
        asked = left & (level[k] > 0)
        for j, before in tried:
            asked &= ~before | (word[j] != word[k])
        at = np.flatnonzero(asked)
        own = word[k].take(at)
        hit = own == comes.take(at)
        says = np.empty((KINDS, len(at)), np.int8)
        for j in range(KINDS):
            says[j] = level[j].take(at)
            if j != k:
                says[j] *= np.where(word[j].take(at) == own, np.int8(1), np.int8(-1))
        parts.append((at, np.full(len(at), k), says, hit))
        tried.append((k, asked))
        left[at[hit]] = False
    at, kind, says, hit = zip(*parts, strict=True)
    return Asked(np.concatenate(at), np.concatenate(kind), np.concatenate(says, 1), np.concatenate(hit))


def inputs(says: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Log odds that each kind gives, from those of its levels, and a constant."""
    x = np.full((says.shape[1], INPUTS), 0.3, np.float32)
    for k, said in enumerate(says):
        x[:, k] = np.append(-odds[k, ::-1], odds[k, 1:]).take(said.astype(np.int64) + (LEVELS - 1))
    return x


def mix(a: Asked, s: Sequence, x: np.ndarray, start: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the decisions, and each text's weights after it: they start alike and take a step after every few words."""
    weights = np.repeat(start[None], texts, 0).astype(np.float32).reshape(-1, INPUTS)
    place = s.place.take(a.at)
    cell, block = s.text.take(a.at) * KINDS + a.kind, np.minimum(place // BLOCK, 6 + place // (4 * BLOCK))
    order = np.argsort(np.minimum(block, 65535).astype(np.uint16) if block.max(initial=0) < 65536 else block, kind="stable")
    cell, x, hit, z = cell[order], x[order], a.hit[order].astype(np.float32), np.empty(len(order), np.float32)
    bounds = np.append(heads(block[order]), len(order)).tolist()
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        c, part = cell[lo:hi], x[lo:hi]
        z[lo:hi] = out = np.einsum("ij,ij->i", weights.take(c, 0), part)
        error = (hit[lo:hi] - 1 / (1 + np.exp(-out))) * np.float32(RATE)
        np.add.at(weights, c, error[:, None] * part)
    back = np.empty_like(z)
    back[order] = z
    return np.clip(back, -12, 12), weights.reshape(texts, KINDS, INPUTS)


def odds_of(seen: np.ndarray) -> np.ndarray:
    """Log odds of a kind's levels from the cases that did not and did come."""
    odds = np.log((seen[..., 1] + 0.4) / (seen[..., 0] + 0.4))
    odds[:, 0] = 0
    return odds.astype(np.float32)


@dataclass
class WordMixer:
    """What is learnt: tables, log odds of levels and the weights that texts start with."""

    table: Follow
    odds: np.ndarray
    weights: np.ndarray

    def look(self, hashes: np.ndarray, sizes: np.ndarray, words: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
        """Of each word of texts: log probability that it is none of those asked for before, and the log odds, if it was asked for itself, that it is it (else minus infinity).

        Texts are worked out in parts of so many words, or of one text.
        """
        ends = np.cumsum(sizes)
        first = heads(ends // words).tolist()
        parts = [(ends[a] - sizes[a], ends[b - 1], sizes[a:b]) for a, b in zip(first, [*first[1:], len(sizes)], strict=True)]
        made = [self._look(hashes[lo:hi], own) for lo, hi, own in parts]
        return (np.concatenate([m for m, _ in made]), np.concatenate([c for _, c in made])) if made else (np.empty(0), np.empty(0))

    def _look(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = sequence(hashes, sizes)
        a = ask(s, self.table)
        z, _ = mix(a, s, inputs(a.says, self.odds), self.weights, len(sizes))
        missed, came = ~a.hit, np.full(len(hashes), -np.inf)
        came[a.at[a.hit]] = z[a.hit]
        return -np.bincount(a.at[missed], np.log1p(np.exp(z[missed].astype(float))), len(hashes)), came


def new_weights() -> np.ndarray:
    return np.append(np.full((KINDS, KINDS), 0.5), np.zeros((KINDS, 1)), 1)


def combined(logs: np.ndarray, missed: np.ndarray, came: np.ndarray) -> np.ndarray:
    """Log probabilities of words, from those of their spelling (a column a way), which are overwritten: a word comes as one that was asked for, or is spelled.

    One that was asked for may be spelled as well, so that the probabilities of all words sum to 1.
    """
    hit = np.flatnonzero(came > -np.inf)
    z = came[hit][:, None]
    logs[hit] = np.logaddexp(z, logs[hit]) - np.logaddexp(0, z)
    logs += missed[:, None]
    return logs


def train(docs: DataFrame, tokens: int, slice_bytes: int = 1 << 20, partitions_a_task: int = 4) -> WordMixer:
    """Learns from all rows of text, which hold so many words and ends. Tables and weights have bounded sizes.

    A task goes through its texts online: each slice of them is predicted, then learnt. Its tables go on in parts of their
    slots, which are summed apart from one another; weights are the tasks' means.
    """
    bits = int(np.clip(np.ceil(np.log2(max(1, tokens))), LEAST_BITS, MOST_BITS))
    parts = 1 << max(0, bits - PART_BITS)

    def learnt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, seen, weights, steps = Follow(bits), np.zeros((KINDS, LEVELS, 2)), new_weights(), np.zeros(KINDS)

        def learn(texts: list[bytes]) -> None:
            nonlocal weights
            hashes = word_hashes(b"".join([t + b" \xff " for t in texts]).lstrip())
            ends = np.flatnonzero(hashes == end)
            s = sequence(hashes, np.diff(np.append(-1, ends)))
            a = ask(s, table)
            _, after = mix(a, s, inputs(a.says, odds_of(seen)), weights, len(texts))
            count = np.bincount(s.text.take(a.at) * KINDS + a.kind, minlength=len(texts) * KINDS).reshape(-1, KINDS)
            some = count.sum(0)
            mean = (after * count[..., None]).sum(0) / np.maximum(some, 1)[:, None]
            weights = np.where(some[:, None] > 0, mean, weights)
            steps[:] += some
            own = np.choose(a.kind, a.says)
            seen[:] += np.bincount((a.kind * LEVELS + own) * 2 + a.hit, minlength=seen.size).reshape(seen.shape)
            for k, slot in enumerate(table.slots(s.contexts)):
                table.add(k, slot, s.word.astype(np.uint32))

        end, held, size = hashes_of([b""])[0], [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append((text or "").encode().lower())
                size += len(held[-1]) + 3
                if size >= slice_bytes:
                    learn(held)
                    held, size = [], 0
        if held:
            learn(held)
        if steps.any() or any(v.any() for v in table.votes):
            flat = np.concatenate([seen.ravel(), (weights * steps[:, None]).ravel(), steps])
            yield pd.DataFrame({"part": [-1], "slot": [b""], "word": [flat.astype("<f8").tobytes()], "votes": [b""]})
        for k in range(len(TABLES)):
            some = np.flatnonzero(table.votes[k])
            for p, own in enumerate(np.split(some, np.searchsorted(some, np.arange(1, parts) << PART_BITS))):
                if len(own):
                    low = (own & ((1 << PART_BITS) - 1)).astype("<u2")
                    yield pd.DataFrame({"part": [k * parts + p], "slot": [low.tobytes()], "word": [table.word[k][own].astype("<u4").tobytes()], "votes": [table.votes[k][own].astype("<u2").tobytes()]})

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        if part < 0:
            made = sum(np.frombuffer(r, "<f8") for r in sorted(rows["word"]))
            return pd.DataFrame({"part": [part], "slot": [b""], "word": [made.tobytes()], "votes": [b""]})
        slot, word, votes = (np.frombuffer(b"".join(rows[c]), t) for c, t in (("slot", "<u2"), ("word", "<u4"), ("votes", "<u2")))
        slot, word, votes = majority(slot, word, votes.astype(np.int64))
        often = votes >= LEAST  # what was seen once tells nothing
        return pd.DataFrame({"part": [part], "slot": [slot[often].tobytes()], "word": [word[often].tobytes()], "votes": [np.minimum(votes[often], 65535).astype("<u2").tobytes()]})

    schema = "part int, slot binary, word binary, votes binary"
    texts = docs.select("text")
    texts = texts.coalesce(max(1, texts.rdd.getNumPartitions() // partitions_a_task))
    table, flat = Follow(bits), None
    for r in texts.mapInPandas(learnt, schema).groupBy("part").applyInPandas(summed, schema).toLocalIterator():
        if r["part"] < 0:
            flat = np.frombuffer(bytes(r["word"]), "<f8")
            continue
        k, p = divmod(r["part"], parts)
        slot = np.frombuffer(bytes(r["slot"]), "<u2").astype(np.int64) + (p << PART_BITS)
        table.word[k][slot], table.votes[k][slot] = np.frombuffer(bytes(r["word"]), "<u4"), np.frombuffer(bytes(r["votes"]), "<u2")
    if flat is None:
        return WordMixer(table, np.zeros((KINDS, LEVELS), np.float32), new_weights())
    seen, weights, steps = np.split(flat, [KINDS * LEVELS * 2, KINDS * LEVELS * 2 + KINDS * INPUTS])
    weights = np.where(steps[:, None] > 0, weights.reshape(KINDS, INPUTS) / np.maximum(steps, 1)[:, None], new_weights())
    return WordMixer(table, odds_of(seen.reshape(KINDS, LEVELS, 2)), weights)
