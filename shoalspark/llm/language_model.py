"""Language-model scores by online logistic context mixing.

A text is its words in order, each closed by a blank, and an end. Every symbol is a path of yes-or-no decisions in a
Huffman tree of the training words' bytes. Predictors know how often each decision fell either way in a hashed context:
the place in the word, the last one to four bytes, the whole word so far. Their log odds are mixed twice: by weights that
gates choose (what is known of the contexts, or place and depth), learnt online over all training words, each occurrence
predicted from the counts of all others; then by the text itself: it starts with several ways to weigh the two mixers and
trusts each as it has foretold the words so far. That spells a word; before, it is decided whether the word is the one that
the words before lead to, by a mixer that learns online over the training texts and goes on in the text (word_contexts).

The corpus is read three times. The first time gives the counts of its words; decision counts and weights of spelling are
learnt from that table, which grows with the corpus. The second time gives what follows the contexts of words. The third time,
spelling is worked out once for each different word of a batch, and decisions on words for every one.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import word_contexts
from .common import cut, dealt_anew_text

#: Contexts: the place in the word, so many bytes before, and the word so far. The last is learnt from words that recur, and
#: its table has room for one context a place, the one seen most; a check tells others apart.
ORDERS = ("place", 1, 2, 3, 4, "word")
#: Binary logarithms of the places of the first three tables; the others' follow the number of training words.
FIXED_BITS = (12, 16, 18)
LEAST_BITS, MOST_BITS = 12, 20
LEVELS, PLACES, DEPTHS = 6, 6, 4
GATES = (LEVELS * LEVELS, PLACES * DEPTHS)
INPUTS = len(ORDERS) + 1
RATE = 0.1
#: Factors of the two mixers' log odds.
WAYS = ((0.5, 0.5), (0.65, 0.65), (1.0, 0.0), (0.0, 1.0))
#: Symbols at a word's start that may be shared with the word before it.
SHARED = 32
MOST = np.float32(12)
_ODD, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
END = ""


def split(text: str | None) -> list[bytes]:
    """Words of a text: bytes, since those lower A-Z alone and part at the same six characters."""
    return (text or "").encode().lower().split()


def as_text(words: list[bytes]) -> list[str]:
    """Words as strings, turned in one go, as none holds a line end."""
    return b"\n".join(words).decode().split("\n") if words else []


def as_bytes(words: list[str]) -> list[bytes]:
    return "\n".join(words).encode().split(b"\n") if len(words) else []


class Code:
    """The decisions of each byte: nodes of a Huffman tree and the sides taken."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, s, (s,)) for s, c in enumerate(counts)]
        paths: dict[int, list[tuple[int, int]]] = {s: [] for s in range(256)}
        heapq.heapify(heap)
        node = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for side, part in enumerate((a, b)):
                for s in part[2]:
                    paths[s].append((node, side))
            heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
            node += 1
        self.length = np.array([len(paths[s]) for s in range(256)])
        self.start = np.append(0, np.cumsum(self.length)[:-1])
        flat = [d for s in range(256) for d in reversed(paths[s])]
        self.node = np.array([n for n, _ in flat], np.uint64)
        self.side = np.array([x for _, x in flat], bool)


@dataclass
class Decisions:
    """Of a list of words, each decision's place in the tables (an array for each context), the check of its last, side, place in the word and depth; the words' ends and the symbols'."""

    slots: list[np.ndarray]
    check: np.ndarray
    side: np.ndarray
    place: np.ndarray
    depth: np.ndarray
    ends: np.ndarray
    symbol_ends: np.ndarray


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for length[0] numbers, then those of start[1], and so on."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


class Tables:
    """Where the decisions of words lie in the hashed tables, which are one array."""

    def __init__(self, code: Code, bits: int):
        self.code, self.bits = code, (*FIXED_BITS, *[bits] * (len(ORDERS) - len(FIXED_BITS)))
        self.offset = np.append(0, np.cumsum([1 << b for b in self.bits]))
        self.size = int(self.offset[-1])

    def decisions(self, words: list[bytes], after: np.ndarray | None = None) -> Decisions:
        """Decisions of the words' symbols and of the blanks that close them; with after, only of those at so many symbols or beyond."""
        symbols = np.frombuffer(b" ".join(words) + b" " if words else b"", np.uint8)
        ends = np.flatnonzero(symbols == 32) + 1
        starts = np.append(0, ends[:-1])[: len(ends)]
        place = np.arange(len(symbols)) - np.repeat(starts, ends - starts)
        wide = symbols.astype(np.uint64)
        before = [np.where(place >= k, np.roll(wide, k), 0).astype(np.uint64) for k in (1, 2, 3, 4)]
        power = np.multiply.accumulate(np.full(int(place.max(initial=0)) + 1, _SPREAD))
        upto = np.cumsum((wide + np.uint64(1)) * power[place], dtype=np.uint64)
        upto = np.append(np.uint64(0), upto)[:-1] if len(upto) else upto  # without the symbol itself
        contexts = [np.minimum(place, 3).astype(np.uint64), before[0]]
        for k in (1, 2, 3):
            contexts.append(contexts[-1] | (before[k] << np.uint64(8 * k)))
        contexts.append(upto - np.repeat(upto[starts], ends - starts) if len(symbols) else upto)
        if after is not None:
            own = place >= np.repeat(after, ends - starts)
            symbols, place, contexts = symbols[own], place[own], [c[own] for c in contexts]
            ends = np.cumsum(own)[ends - 1]
        length = self.code.length[symbols]
        at = spread(self.code.start[symbols], length)
        mixed = (self.code.node[at] + np.uint64(1)) * _SPREAD
        slots = []
        for context, bits, offset in zip(contexts, self.bits, self.offset, strict=False):
            h = np.repeat((context + np.uint64(1)) * _ODD, length)
            h ^= mixed
            h *= _ODD
            h ^= h >> np.uint64(29)
            h *= _SPREAD
            slots.append((h >> np.uint64(64 - bits)).view(np.int64) + offset)
        depth = spread(np.zeros(len(length), np.int64), length)
        return Decisions(slots, (h & np.uint64(0xFFFF)).astype(np.uint16), self.code.side[at], np.repeat(place, length), depth, np.cumsum(length)[ends - 1] if len(ends) else ends, np.cumsum(length))


def stretched(no: np.ndarray, yes: np.ndarray) -> np.ndarray:
    return np.log((yes + np.float32(0.4)) / (no + np.float32(0.4)))


def level(total: np.ndarray) -> np.ndarray:
    """How much is known of a context, from 0 to LEVELS - 1: nothing, 1 to 3 decisions, and so on in steps of four times as many."""
    return np.minimum(np.ceil(np.log2(1 + np.maximum(total, 0)) * 0.5), LEVELS - 1).astype(np.int64)


def gates(word: np.ndarray, four: np.ndarray, d: Decisions) -> tuple[np.ndarray, np.ndarray]:
    """The set of weights of either mixer, from the levels of the word so far and of four bytes, or from place and depth."""
    return word * LEVELS + four, np.minimum(d.place, PLACES - 1) * DEPTHS + np.minimum(d.depth, DEPTHS - 1)


def new_weights() -> list[np.ndarray]:
    return [np.full((g, INPUTS), 1 / len(ORDERS), np.float32) for g in GATES]


def learn(model: Model, words: list[bytes], times: np.ndarray, weights: list[np.ndarray], rate: float = RATE) -> None:
    """One online step of both mixers over some words, which occur so many times; each is predicted without itself."""
    d = model.tables.decisions(words)
    own, each = d.side.astype(np.float32), np.repeat(times, np.diff(np.append(0, d.ends)))
    other, totals, x = 1 - own, [], np.empty((INPUTS, len(own)), np.float32)
    x[-1] = 0.3
    for k, slot in enumerate(d.slots):
        n0, n1 = model.no.take(slot), model.yes.take(slot)
        if k < len(d.slots) - 1:
            n0, n1 = n0 - other, n1 - own
        else:
            there, itself = model.check.take(slot - model.tables.offset[k]) == d.check, each > 1
            n0, n1 = (n0 - other * itself) * there, (n1 - own * itself) * there
        np.maximum(n0, 0, out=n0)
        np.maximum(n1, 0, out=n1)
        np.clip(stretched(n0, n1), -MOST, MOST, out=x[k])
        totals.append(n0 + n1)
    # Occurrences count by their square root: a step follows common words most, but not them alone.
    count = np.sqrt(each).astype(np.float32)
    for w, gate in zip(weights, gates(level(totals[5]), level(totals[4]), d), strict=True):
        out = x[0] * w[:, 0].take(gate)
        for k in range(1, INPUTS):
            out += x[k] * w[:, k].take(gate)
        error = count * (own - 1 / (1 + np.exp(-np.clip(out, -MOST, MOST))))
        seen = np.bincount(gate, count, len(w))
        step = np.stack([np.bincount(gate, error * x[k], len(w)) for k in range(INPUTS)], 1)
        w += (rate * step / np.maximum(seen, 1e-9)[:, None] * (seen > 0)[:, None]).astype(np.float32)


@dataclass
class Model:
    """Tables of decision counts and weights, as they are learnt."""

    tables: Tables
    no: np.ndarray
    yes: np.ndarray
    check: np.ndarray
    weights: list[np.ndarray]


class Scorer:
    """What a task needs of a model: log odds and levels instead of counts."""

    def __init__(self, m: Model):
        self.tables, self.check, self.weights = m.tables, m.check, m.weights
        self.odds, self.level = np.clip(stretched(m.no, m.yes), -MOST, MOST), level(m.no + m.yes).astype(np.int8)

    def outputs(self, words: list[bytes], after: np.ndarray | None = None) -> tuple[np.ndarray, Decisions]:
        """Both mixers' log odds of the sides taken, a row a mixer, and the decisions."""
        d = self.tables.decisions(words, after)
        x, word, four = [self.odds.take(s) for s in d.slots], self.level.take(d.slots[5]).astype(np.int64), self.level.take(d.slots[4]).astype(np.int64)
        other = self.check.take(d.slots[5] - self.tables.offset[5]) != d.check
        x[5][other], word[other] = 0, 0
        sign = np.where(d.side, np.float32(1), np.float32(-1))
        made = []
        for w, gate in zip(self.weights, gates(word, four, d), strict=True):
            each = np.ascontiguousarray(w.T)
            total = np.float32(0.3) * each[-1].take(gate)
            for i, odds in enumerate(x):
                total += odds * each[i].take(gate)
            np.clip(total, -MOST, MOST, out=total)
            total *= sign
            made.append(total)
        return np.stack(made), d

    def _symbols(self, words: list[bytes], after: np.ndarray) -> np.ndarray:
        """Natural log probability of each symbol at after or beyond, by each way of weighing the mixers."""
        x, d = self.outputs(words, after)
        starts = np.append(0, d.symbol_ends[:-1])
        return np.stack([-np.add.reduceat(np.log(1 + np.exp(np.float32(-a) * x[0] + np.float32(-b) * x[1])), starts, dtype=np.float64) for a, b in WAYS], 1)

    def logs(self, words: list[bytes], step: int = 4_000) -> np.ndarray:
        """Natural log probability of each word by each way of weighing the mixers.

        In sorted order a word's start is often the one before's, and is worked out once.
        """
        out = np.empty((len(words), len(WAYS)))
        order = sorted(range(len(words)), key=words.__getitem__)
        for at in range(0, len(order), step):
            part = [words[i] for i in order[at : at + step]]
            length = np.fromiter(map(len, part), np.int64, len(part))
            width = int(min(length.max(), SHARED))
            table = np.zeros((len(part), width + 1), np.uint8)
            rows, places = np.repeat(np.arange(len(part)), np.minimum(length, width)), spread(np.zeros(len(part), np.int64), np.minimum(length, width))
            table[rows, places] = np.frombuffer(b"".join(w[:width] for w in part), np.uint8)
            same = np.vstack([np.zeros((1, width + 1), bool), table[1:] == table[:-1]])
            after = np.argmin(np.hstack([same, np.zeros((len(part), 1), bool)]), 1)
            after = np.minimum(after, np.minimum(np.minimum(length, np.append(0, length[:-1])), width))
            each = self._symbols(part, after)
            first = np.cumsum(length + 1 - after) - (length + 1 - after)
            at_place = np.where(np.arange(width + 1) >= after[:, None], first[:, None] + np.arange(width + 1) - after[:, None], -1)
            source = np.maximum.accumulate(at_place, 0)  # the row that worked a start out is the last that differs there
            shared = source[np.repeat(np.arange(len(part)), after), spread(np.zeros(len(part), np.int64), after)]
            total = np.add.reduceat(each, first)
            np.add.at(total, np.repeat(np.arange(len(part)), after), each[shared])
            out[order[at : at + step]] = total
        return out


class Numbers(dict):
    """Word -> number, given at the first look; new holds the words of numbers given since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = made = len(self)
        self.new.append(word)
        return made


class Held:
    """Log probabilities, counts and hashes of words: of the first limit words for a worker's life, of others for a batch."""

    def __init__(self, scorer: Scorer, times: dict[bytes, int], limit: int = 1 << 19):
        self.scorer, self.times, self.limit = scorer, times, limit
        self.numbers, self.logs, self.counts, self.hashes = Numbers(), np.empty((0, len(WAYS))), np.empty(0), np.empty(0, np.uint64)

    def look(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words, which are rows of logs, counts and hashes until the next look."""
        if len(self.numbers) > self.limit:
            kept, self.numbers = list(self.numbers)[: self.limit], Numbers()
            self.numbers.update(zip(kept, range(self.limit), strict=True))
            self.logs, self.counts, self.hashes = self.logs[: self.limit], self.counts[: self.limit], self.hashes[: self.limit]
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new, get = self.numbers.new, self.times.get
        if new:
            self.logs = np.concatenate([self.logs, self.scorer.logs(new)])
            self.counts = np.append(self.counts, [get(w, 0) for w in new])
            self.hashes = np.append(self.hashes, word_contexts.hashes_of(new))
            self.numbers.new = []
        return ids


def trusted(logs: np.ndarray) -> np.ndarray:
    """Log probability of texts from those by each way: a way's weight after some words is in proportion to what it gave them.

    The product over the words of their weighted probabilities is the mean of the ways' products.
    """
    most = logs.max(1, keepdims=True)
    return (most + np.log(np.exp(logs - most).mean(1, keepdims=True)))[:, 0]


_HELD: dict[str, Held] = {}


def _held(name: str, scorer: Scorer, times: dict[bytes, int]) -> Held:
    """One for the life of a worker and the model of that name."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Held(scorer, times)
    return _HELD[name]


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether a document is kept from learning; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def vocabulary(docs: DataFrame, held: int = 600_000) -> DataFrame:
    """word, c over all words of text and one end, the empty word, for each row."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: Counter = Counter()
        for batch in batches:
            own[b""] += len(batch)
            for text in batch["text"]:
                own.update(split(text))
                if len(own) > held:
                    yield pd.DataFrame({"word": as_text(list(own)), "c": list(own.values())})
                    own.clear()
        if not own[b""]:  # no row since the last flush
            del own[b""]
        if own:
            yield pd.DataFrame({"word": as_text(list(own)), "c": list(own.values())})

    return docs.select("text").mapInPandas(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def train(vocab: DataFrame, distinct: int, batch_words: int = 500, words_a_task: int = 1 << 20) -> Model:
    """A model of a cut vocabulary with so many different words. Tables and weights have bounded sizes."""
    parts = vocab.coalesce(max(1, -(-distinct // words_a_task)))

    def bytes_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(256)
        for batch in batches:
            words = as_bytes(batch["word"].tolist())
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            counts += np.bincount(np.frombuffer(b" ".join(words) + b" " if words else b"", np.uint8), np.repeat(batch["c"].to_numpy(float), lengths), 256)
        yield pd.DataFrame({"b": np.arange(256, dtype=np.int32), "n": counts})

    counts = np.zeros(256)
    for r in parts.mapInPandas(bytes_of, "b int, n double").groupBy("b").agg(F.sum("n").alias("n")).collect():
        counts[r["b"]] = r["n"]
    tables = Tables(Code(counts), int(np.clip(np.ceil(np.log2(max(1, distinct))), LEAST_BITS, MOST_BITS)))

    def decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros(2 * int(tables.offset[-2]))
        kept: list[tuple] = []

        def flush() -> pd.DataFrame:
            keys, n, side = map(np.concatenate, zip(*kept, strict=True))
            kept.clear()
            key, where = np.unique(keys, return_inverse=True)
            return pd.DataFrame({"key": key, "no": np.bincount(where, n * ~side, len(key)), "yes": np.bincount(where, n * side, len(key))})

        for batch in batches:
            words, times = as_bytes(batch["word"].tolist()), batch["c"].to_numpy(float)
            for at in range(0, len(words), 2_000):
                d = tables.decisions(words[at : at + 2_000])
                n = np.repeat(times[at : at + 2_000], np.diff(np.append(0, d.ends)))
                for s in d.slots[:-1]:
                    np.add.at(both, 2 * s + d.side, n)
                often = n > 1
                kept.append(((d.slots[-1][often] << 16) | d.check[often], n[often], d.side[often]))
                if sum(len(k[0]) for k in kept) > 1 << 20:
                    yield flush()
        if kept:
            yield flush()
        some = np.flatnonzero(both[::2] + both[1::2])
        for at in range(0, len(some), 1 << 18):
            s = some[at : at + (1 << 18)]
            yield pd.DataFrame({"key": s << 16, "no": both[2 * s], "yes": both[2 * s + 1]})

    # Dealt out by slot, the sums of a key and the choice of a slot's key need one shuffle.
    dealt = parts.mapInPandas(decided, "key long, no double, yes double").withColumn("slot", F.shiftright("key", 16).cast("int")).repartition("slot")
    sums = dealt.groupBy("slot", "key").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    best = F.max(F.struct((F.col("no") + F.col("yes")).alias("total"), "key", "no", "yes"))
    # What was seen once tells nothing of its only word.
    sums = sums.groupBy("slot").agg(best.alias("b")).where("b.total > 1").select("slot", F.col("b.key").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("check"), "b.no", "b.yes")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({c: [batch[c].to_numpy().astype(t).tobytes()] for c, t in (("slot", "<i4"), ("check", "<u2"), ("no", "<f4"), ("yes", "<f4"))})

    no, yes, check = np.zeros(tables.size, np.float32), np.zeros(tables.size, np.float32), np.zeros(1 << tables.bits[-1], np.uint16)
    for r in sums.mapInPandas(packed, "slot binary, check binary, no binary, yes binary").toLocalIterator():
        slot = np.frombuffer(r["slot"], "<i4")
        no[slot], yes[slot] = np.frombuffer(r["no"], "<f4"), np.frombuffer(r["yes"], "<f4")
        last = slot >= tables.offset[-2]
        check[slot[last] - tables.offset[-2]] = np.frombuffer(r["check"], "<u2")[last]
    model = Model(tables, no, yes, check, new_weights())
    sent = vocab.sparkSession.sparkContext.broadcast((model,))

    def learnt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, weights, seen = sent.value[0], new_weights(), 0
        for batch in batches:
            words, times = as_bytes(batch["word"].tolist()), batch["c"].to_numpy(float)
            for at in range(0, len(words), batch_words):
                learn(m, words[at : at + batch_words], times[at : at + batch_words], weights)
            seen += len(words)
        flat = np.concatenate([w.ravel() for w in weights]).astype(float)
        yield pd.DataFrame({"k": np.arange(len(flat), dtype=np.int32), "w": flat * seen, "seen": float(seen)})

    flat = np.concatenate([w.ravel() for w in model.weights])
    for r in parts.mapInPandas(learnt, "k int, w double, seen double").groupBy("k").agg(F.try_divide(F.sum("w"), F.sum("seen")).alias("w")).collect():
        flat[r["k"]] = flat[r["k"]] if r["w"] is None else r["w"]
    sent.unpersist()
    model.weights = [w.reshape(-1, INPUTS) for w in np.split(flat.astype(np.float32), [GATES[0] * INPUTS])]
    return model


def common(vocab: DataFrame, most: int, steps: int = 8) -> dict[bytes, int]:
    """Counts of the most frequent words of a cut vocabulary, at most so many: all above a bound, which a histogram of counts gives."""
    step = F.floor(F.log2("c") * steps)
    left, bound = most, None
    for r in sorted(vocab.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        left -= r["words"]
        if left < 0:
            break
        bound = r["step"]
    rows = vocab.where(F.lit(False) if bound is None else step >= bound).toPandas()
    return {w.encode(): c for w, c in zip(rows["word"], rows["c"].tolist(), strict=True)}


def score_documents(docs: DataFrame, common_words: int = 1 << 17, chunk: int = 1000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte, a row for each row of docs.

    Learns from the rows that are not held out. base_score adds log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, the
    words and one end. score is the mixed model's log10 probability of them; bits_per_byte is that in bits over the bytes of the
    words and the blanks that close them. Null and empty texts are an end alone; repeated rows count each and have equal
    scores; without rows to learn from all counts are zero; an empty table gives no rows. Only doc_id and text are read.

    Counts of the common_words most frequent words go to all tasks; other words are joined with the vocabulary.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    vocab = cut(vocabulary(rows.where("not held_out")))
    total = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n, distinct = total[0], total[1]
    below = n + 0.5 * (distinct + 1)
    known = common(vocab, common_words)
    mixer = word_contexts.train(rows.where("not held_out"), n)
    sent, name = spark.sparkContext.broadcast((Scorer(train(vocab, distinct)), known, mixer)), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, times, mixer = sent.value
        held = _held(name, scorer, times)
        for whole in batches:
            for at in range(0, len(whole), chunk):
                batch = whole.iloc[at : at + chunk]
                texts = [[*split(t), b""] for t in batch["text"]]
                words, sizes = [w for t in texts for w in t], np.fromiter(map(len, texts), np.int64, len(texts))
                first, ids = np.cumsum(sizes) - sizes, held.look(words)
                c = held.counts[ids]
                logs = word_contexts.combined(held.logs[ids], *mixer.look(held.hashes[ids], sizes))
                # Words without a count at hand, once for each text: the first place of each and how often it occurs.
                key, place, n = np.unique((np.repeat(np.arange(len(texts)), sizes)[c == 0] << 32) | ids[c == 0], return_index=True, return_counts=True)
                rare, n, cuts = as_text([words[i] for i in np.flatnonzero(c == 0)[place].tolist()]), n.tolist(), np.searchsorted(key, np.arange(len(texts) + 1) << 32).tolist()
                yield pd.DataFrame({
                    "row": batch["row"].to_numpy(), "doc_id": batch["doc_id"].to_numpy(), "held_out": batch["held_out"].to_numpy(), "n_tokens": sizes, "n_known": np.add.reduceat((c > 0).astype(np.int64), first),
                    "base": np.add.reduceat(np.where(c > 0, np.log10((c + 0.5) / below), 0), first), "rest": [rare[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], "times": [n[a:b] for a, b in zip(cuts, cuts[1:], strict=False)],
                    "score": trusted(np.add.reduceat(logs, first)) / np.log(10), "bytes": [sum(map(len, t)) + len(t) for t in texts],
                })

    scored = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out")
    made = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, rest array<string>, times array<long>, score double, bytes long"
    scored = cut(scored.mapInPandas(run, made))
    others = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", dealt_anew_text(F.col("x.rest")).alias("word"), F.col("x.times").alias("n"))
    counts = others.join(vocab.select(dealt_anew_text(F.col("word")).alias("w"), "c"), F.col("word") == F.col("w"), "left")
    each = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / below)
    added = counts.groupBy("row").agg(F.sum(F.col("n") * each).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"))
    at = scored.drop("rest", "times").join(added.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    return at.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", (-F.col("score") * np.log2(10) / F.col("bytes")).alias("bits_per_byte"),
    )
