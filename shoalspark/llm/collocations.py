"""Collocations: phrases of two to four words, counted as sorted binary keys.

Words with enough occurrences get numbers, from the most frequent on; other words break pieces as punctuation does, since
no phrase is more frequent than its words. A phrase is a key of fixed width, four numbers of 32 bits in two bigints. Tasks
count runs of their own sorted keys, deal them out by ranges of the key whose bounds follow from the words' frequencies,
and each range is sorted (Spark's radix sort of the first bigint, then the second) and its runs are added up. Longer
phrases are counted only where both of their shorter ones are frequent, which loses none.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, delete_folder, if_small, shared_dir

#: Letters that become small, and what parts pieces and words.
UPPER, BREAKS, BLANKS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ".,;:!?\x0a\x0b\x0c\x0d", " \t"
_TABLE = bytes.maketrans((UPPER + BREAKS + BLANKS).encode(), (UPPER.lower() + "." * len(BREAKS) + " " * len(BLANKS)).encode())
MOST_WORDS = 4
#: Numbers in one array, about, and keys made at once; a text is never parted.
IDS = 1 << 18
#: Rows that a task gives to Spark at once.
SENT = 1 << 17
#: Numbers fill 31 bits, so that bigints sort as their bits do.
LAST_NUMBER = (1 << 31) - 1


def tokens(text: str | None, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """Words of a text and "." where pieces part, in lists from about size bytes each; a word holds no full stop."""
    rest = (text or "").encode().translate(_TABLE)
    at = 0
    while at < len(rest):
        end = rest.find(b" ", at + size)
        end = len(rest) if end < 0 else end
        yield rest[at:end].replace(b".", b" . ").split()
        at = end


def _words(docs: DataFrame, held: int) -> DataFrame:
    """lang, word, n over all words, and a row of a null word with the number of all occurrences for each lang."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter] = {}
        size = 0

        def rows() -> Iterator[pd.DataFrame]:
            while counts:
                lang, own = counts.popitem()
                own.pop(b".", None)
                yield pd.DataFrame({"lang": lang, "word": [*map(bytes.decode, own), None], "n": [*own.values(), own.total()]})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                own = counts.setdefault(lang, Counter())
                for block in tokens(text):
                    before = len(own)
                    own.update(block)
                    size += len(own) - before
                    if size > held:
                        yield from rows()
                        own, size = counts.setdefault(lang, Counter()), 0
        yield from rows()

    return docs.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(frequent: DataFrame) -> DataFrame:
    """lang, word, n and id: 1 for the most frequent word, and so on."""
    at = F.monotonically_increasing_id()
    ordered = cut(frequent.orderBy(F.desc("n"), "lang", "word").select("lang", "word", "n", F.shiftrightunsigned(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("row")))
    sizes = sorted(ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).collect())
    if sum(r["rows"] for r in sizes) > LAST_NUMBER:
        raise ValueError(f"more than {LAST_NUMBER} frequent words; raise the least count")
    start, offsets = 1, []
    for r in sizes:
        offsets.append((r["part"], start))
        start += r["rows"]
    before = frequent.sparkSession.createDataFrame(offsets, "p long, start long")
    return ordered.join(F.broadcast(before), F.col("part") == F.col("p")).select("lang", "word", "n", (F.col("start") + F.col("row")).cast("int").alias("id"))


#: What a Python worker has read from the shared folder last, by its place; it holds one such thing at a time.
_HELD: dict[str, object] = {}


def _written(df: DataFrame, folder: str, files: int = 8) -> str:
    """folder, with df's rows as Parquet for tasks to read: nothing of them goes through the driver."""
    df.coalesce(files).write.parquet(folder)
    return folder


def _columns(folder: str, *names: str) -> Iterator[list[pa.Array]]:
    """The columns of each batch of rows that _written has left in folder."""
    from pyarrow.dataset import dataset
    from pyarrow.fs import FileSystem

    store, root = FileSystem.from_uri(folder)
    for batch in dataset(root, filesystem=store, format="parquet").to_batches(columns=list(names), use_threads=False):
        yield [batch[n] for n in names]


def _in_worker(place: str | None, make: Callable[[], object] | None = None):
    """make(), once in each worker while tasks ask for the same place; what was held for another goes first."""
    if place not in _HELD:
        _HELD.clear()
        if place is None:
            return None
        _HELD[place] = make()
    return _HELD[place]


def _dictionary(folder: str) -> dict[str, dict[bytes, int]]:
    of: dict[str, dict[bytes, int]] = {}
    for lang, word, number in _columns(folder, "lang", "word", "id"):
        for of_lang, w, n in zip(lang.to_pylist(), word.cast(pa.binary()).to_pylist(), number.to_pylist(), strict=True):
            of.setdefault(of_lang, {})[w] = n
    return of


def encoded_in_tasks(docs: DataFrame, folder: str) -> DataFrame:
    """ids: arrays of the texts of one lang, with 0 between pieces; each ends with a text. All tasks read the dictionary that lies in folder."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _in_worker(folder, lambda: _dictionary(folder))
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                get, made, size = known.get(lang, {}).get, [], 0
                for k, text in enumerate(texts, 1):
                    made += [np.fromiter((get(w, 0) for w in block), np.int32, len(block)) for block in tokens(text)]
                    made.append(np.zeros(1, np.int32))
                    size += sum(map(len, made[-2:]))
                    if size > IDS or k == len(texts):
                        ids = np.concatenate(made)
                        yield pd.DataFrame({"ids": [ids[np.append(True, (ids[1:] != 0) | (ids[:-1] != 0))]]})
                        made, size = [], 0

    return docs.mapInPandas(encode, "ids array<int>")


def encoded_by_join(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """ids for each document, by a join of its words with the dictionary: for dictionaries that no task should hold."""
    plain = F.translate("text", UPPER, UPPER.lower())
    parted = F.split(F.regexp_replace(plain, f"[{BREAKS}]", " . "), f"[{BLANKS}]+")
    ided = docs.select(F.monotonically_increasing_id().alias("doc"), "lang", parted.alias("parted"))
    each = ided.select("doc", "lang", F.posexplode("parted").alias("at", "w")).where("w != ''")
    known = dictionary.select(F.col("lang").alias("of"), "word", "id")
    joined = each.join(known, (F.col("lang") == F.col("of")) & (F.col("w") == F.col("word")), "left")
    placed = joined.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("id", F.lit(0)).alias("id")))).alias("s"))
    return placed.select(F.transform("s", lambda x: x["id"]).alias("ids"))


def bounds(dictionary: DataFrame, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """First numbers (with the end) and shares of occurrences of blocks of numbers, at most twice most: the frequent words one by one, then many in a block."""
    total = dictionary.agg(F.count(F.lit(1)), F.sum("n")).first()
    width = max(1, -(-((total[0] or 0) - most) // most))
    block = F.when(F.col("id") <= most, F.col("id")).otherwise(most + 1 + F.floor((F.col("id") - most - 1) / width)).cast("long")
    rows = dictionary.groupBy(block.alias("b")).agg(F.min("id").alias("id"), F.sum("n").alias("n")).orderBy("b").toPandas()
    return np.append(rows["id"].to_numpy(np.int64), (total[0] or 0) + 1), rows["n"].to_numpy(float) / max(1, total[1] or 0)


def place(first: np.ndarray, second: np.ndarray, starts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Where a key lies among all, from 0 to 1, if its two first words met by chance; it never falls as keys rise."""
    before = np.append(0.0, np.cumsum(shares))
    widths = np.diff(starts)
    b1, b2 = (np.searchsorted(starts, x, "right") - 1 for x in (first, second))
    inside = np.where(widths[b1] == 1, before[b2], (first - starts[b1]) / widths[b1])
    return before[b1] + shares[b1] * np.minimum(inside, 1)


class Frequent:
    """Sorted keys of frequent phrases of two and, if given, of three words, as places in the former and the third word."""

    def __init__(self, two: np.ndarray, three: np.ndarray | None = None):
        self.two = np.sort(two)
        self.three = None if three is None else np.sort((self._find(self.two, three[:, 0]) << 32) | (three[:, 1] >> 32))

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, -1)

    def starts(self, ids: np.ndarray, words: int) -> np.ndarray:
        """Whether a frequent phrase of so many words, two or three, starts at each place."""
        two = self._find(self.two, (ids[:-1] << 32) | ids[1:])
        if words == 2:
            return two >= 0
        key = (two[:-1] << 32) | ids[2:]
        return (two[:-1] >= 0) & (self._find(self.three, key) >= 0)


def _keys(folder: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [[c.to_numpy() for c in columns] for columns in _columns(folder, "hi", "lo")]
    return tuple(np.concatenate([np.empty(0, np.int64), *(p[i] for p in parts)]) for i in (0, 1))


def _frequent(folders: tuple[str, ...]) -> Frequent:
    """Of the keys of two and, if there is a second folder, of three words."""
    return Frequent(_keys(folders[0])[0], *[np.stack(_keys(f), 1) for f in folders[1:]])


def grams(ids: np.ndarray, words: int, frequent: Frequent | None) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the keys of all phrases of so many words that may be frequent."""
    ids = ids.astype(np.int64)
    n = max(0, len(ids) - words + 1)
    parts = [ids[k : k + n] for k in range(words)]
    may = np.ones(n, bool)
    for p in parts:
        may &= p > 0
    if frequent is not None and n:
        shorter = frequent.starts(ids, words - 1)
        may &= shorter[:n] & shorter[1 : n + 1]
    parts = [p[may] for p in parts] + [np.zeros(int(may.sum()), np.int64)] * (MOST_WORDS - words)
    return (parts[0] << 32) | parts[1], (parts[2] << 32) | parts[3]


def own(hi: np.ndarray, lo: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys of phrases of so many words and how often each is there; hi may be sorted in place."""
    if words == 2:  # the other half is nothing
        hi.sort()
    else:
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
    new = np.flatnonzero(np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))[: len(hi)])
    return hi[new], lo[new], np.diff(np.append(new, len(hi)))


def runs(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of sorted runs and their sums."""
    new = np.flatnonzero(np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))[: len(hi)])
    return hi[new], lo[new], np.add.reduceat(n, new) if len(new) else n


def _counted(encoded: DataFrame, words: int, least: int, shorter: tuple[str, ...], edges, partitions: int, held: int) -> DataFrame:
    """hi, lo, a of the phrases of so many words with at least so many occurrences; shorter are the folders of the keys that prune, if any."""

    def own_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _in_worker(" ".join(shorter) or None, lambda: _frequent(shorter))
        kept, size = [], 0

        def flush() -> Iterator[pd.DataFrame]:
            both = [np.concatenate([k[i] for k in kept]) if kept else np.empty(0, np.int64) for i in (0, 1)]
            kept.clear()
            every = own(both.pop(0), both.pop(), words)
            for at in range(0, len(every[0]), SENT):
                hi, lo, n = (x[at : at + SENT] for x in every)
                where = place(hi >> 32, hi & 0xFFFFFFFF, *edges)
                yield pd.DataFrame({"part": np.minimum(where * partitions, partitions - 1).astype(np.int32), "hi": hi, "lo": lo, "n": n})

        for batch in batches:
            for ids in map(np.asarray, batch["ids"]):
                for at in range(0, len(ids), IDS):
                    kept.append(grams(ids[at : at + IDS + words - 1], words, known))
                    size += len(kept[-1][0])
                    if size > held:
                        yield from flush()
                        size = 0
        yield from flush()

    def all_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # the run that the next batch may go on with
        for batch in batches:
            if not len(batch):
                continue
            hi, lo, n = (batch[c].to_numpy(np.int64) for c in ("hi", "lo", "n"))
            if last is not None:
                hi, lo, n = (np.append(a, b) for a, b in zip(last, (hi, lo, n), strict=True))
            hi, lo, n = runs(hi, lo, n)
            last = hi[-1:], lo[-1:], n[-1:]
            many = n[:-1] >= least
            yield pd.DataFrame({"hi": hi[:-1][many], "lo": lo[:-1][many], "a": n[:-1][many]})
        if last is not None and last[2][0] >= least:
            yield pd.DataFrame(dict(zip(("hi", "lo", "a"), last, strict=True)))

    dealt = encoded.mapInPandas(own_runs, "part int, hi long, lo long, n long").repartitionById(partitions, F.col("part"))
    return dealt.sortWithinPartitions("hi", "lo").select("hi", "lo", "n").mapInPandas(all_runs, "hi long, lo long, a long")


def _number(k: int) -> Column:
    """The k-th number of a key, from 0."""
    half = F.col("hi" if k < 2 else "lo")
    return F.shiftrightunsigned(half, 32) if k % 2 == 0 else half.bitwiseAND(F.lit(0xFFFFFFFF))


def _key(first: int, after: int) -> Column:
    """The key of the numbers from first on and before after."""
    at = [_number(k) if k < after else F.lit(0).cast("long") for k in range(first, first + MOST_WORDS)]
    return F.struct(F.shiftleft(at[0], 32).bitwiseOR(at[1]).alias("hi"), F.shiftleft(at[2], 32).bitwiseOR(at[3]).alias("lo"))


def _by_length(make: Callable[[int], Column], lengths: range) -> Column:
    made = F.when(F.lit(False), make(lengths[0]))
    for n in lengths:
        made = made.when(F.col("words") == n, make(n))
    return made


def _wide(c: Column | str) -> Column:
    return F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c.cast("decimal(20,0)")


def phrase_counts(docs: DataFrame, least: int, dictionary_rows: int, pruning_rows: int, held: int = 1 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n), dictionary (lang, word, n, id) and phrases (hi, lo, words, a) of the frequent words and phrases."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = cut(_words(rows, 200_000).where(F.col("word").isNull() | (F.col("n") >= least)))
    totals, dictionary = words.where("word is null").select("lang", "n"), cut(numbered(words.where("word is not null")))
    folder = f"{shared_dir(spark).rstrip('/')}/collocations-{uuid.uuid4().hex}"
    small = dictionary.count() <= dictionary_rows
    ids = encoded_in_tasks(rows, _written(dictionary.select("lang", "word", "id"), f"{folder}/words")) if small else encoded_by_join(rows, dictionary)
    ids.write.parquet(f"{folder}/ids")
    encoded, edges = spark.read.parquet(f"{folder}/ids"), bounds(dictionary)
    partitions = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # a sort holds its whole partition
    found, shorter = [], ()
    for n in range(2, MOST_WORDS + 1):
        found.append(cut(_counted(encoded, n, least, shorter, edges, partitions, held)))
        # Frequent phrases that are too many to hold are not used to prune: all longer ones are counted then.
        usable = len(shorter) == n - 2 and n < MOST_WORDS and found[-1].count() <= pruning_rows
        shorter = (*shorter, _written(found[-1].select("hi", "lo"), f"{folder}/keys{n}")) if usable else ()
    delete_folder(spark, folder)
    phrases = found[0].withColumn("words", F.lit(2))
    for n, f in enumerate(found[1:], 3):
        phrases = phrases.unionAll(f.withColumn("words", F.lit(n)))
    return totals, dictionary, phrases.select("hi", "lo", "words", "a")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, dictionary_rows: int = 1_000_000, pruning_rows: int = 4_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's first phrases by score.

    a counts the phrase, l and r the parts of its weakest cut, n all words of the lang; score is floor(2000000 a / (l + r))
    at that cut, the smallest over all cuts, the earliest of equal ones. Phrases inside a longer frequent phrase that has
    covered percent of their occurrences or more are left out. Equal scores go by a, then by the bytes of the phrase. A null
    lang is "und", null and empty texts have no words, repeated rows count each, an empty table gives no rows. Only lang
    and text are read. Dictionaries above dictionary_rows are joined instead of read by all tasks, and more than pruning_rows
    phrases prune nothing; the result is the same. Neither words nor phrases go through the driver.
    """
    totals, dictionary, phrases = phrase_counts(docs, least, dictionary_rows, pruning_rows)
    zero = F.lit(0).cast("long")
    known = dictionary.select(F.shiftleft(F.col("id").cast("long"), 32).alias("hi"), zero.alias("lo"), F.col("n").alias("f")).unionAll(phrases.select("hi", "lo", F.col("a").alias("f")))
    lengths = range(2, MOST_WORDS + 1)
    cuts = _by_length(lambda n: F.array(*[F.struct(F.lit(k).alias("k"), _key(0, k).alias("first"), _key(k, n).alias("rest")) for k in range(1, n)]), lengths)
    each = phrases.select("hi", "lo", "words", "a", F.explode(cuts).alias("c"))
    with_key = lambda s, f: known.select(F.struct("hi", "lo").alias(s), F.col("f").alias(f))
    both = each.join(with_key("s1", "l"), F.col("c.first") == F.col("s1")).join(with_key("s2", "r"), F.col("c.rest") == F.col("s2"))
    score = F.expr("cast(cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    weakest = both.groupBy("hi", "lo", "words", "a").agg(F.min(F.struct(score.alias("score"), F.col("c.k").alias("k"), "l", "r")).alias("cut"))
    inner = _by_length(lambda n: F.array(*[_key(i, i + m) for m in range(2, n) for i in range(n - m + 1)]), range(3, MOST_WORDS + 1))
    longest = phrases.where("words > 2").select("a", F.explode(inner).alias("inside")).groupBy("inside").agg(F.max("a").alias("longer"))
    scored = weakest.join(longest, F.struct("hi", "lo") == F.col("inside"), "left")
    stay = F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * covered)
    left = cut(scored.where(stay).select("hi", "lo", "words", "a", "cut"))
    numbers = _by_length(lambda n: F.array(*[F.struct(F.lit(k).alias("at"), _number(k).cast("int").alias("number")) for k in range(n)]), lengths)
    spelled = left.select("hi", "lo", F.explode(numbers).alias("x")).join(dictionary, F.col("x.number") == F.col("id"))
    spelled = spelled.groupBy("hi", "lo").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("x.at", "word"))).alias("w"))
    texts = spelled.select("hi", "lo", "lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    rows = left.join(texts, ["hi", "lo"]).join(if_small(totals.select(F.col("lang").alias("of"), "n")), F.col("lang") == F.col("of"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
