"""Repair of conversation structure by weighted finite-state composition.

Three automata are composed: the rows of a conversation (a chain, each row with its role's initial and its fault), the
edits (Keep, Rerole, Delete, Insert), and the grammar of roles, (s?(ua)+)?. States of the composition are made when the
search reaches them; the shortest path is taken in reverse topological order over the weights (cost, labels), which are
compared in that order. All arcs that leave one state bear different labels, so the first label decides between paths of
equal cost, and no label string is built before the path is known.

Conversations are ordered by a range partitioning of their rows, so a conversation that holds a large share of all rows
spreads over many tasks. Each task reduces its part of such a conversation to the sixteen shortest paths between the
grammar's states, and these parts are composed in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew_text

#: State of the grammar -> initial -> state. 0 nothing yet, 1 after s, 2 after u, 3 after a.
GRAMMAR: dict[int, dict[str, int]] = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPTED = (0, 3)
#: The role that an inserted or reroled turn gets in a state.
GIVEN = {0: "user", 1: "user", 2: "assistant", 3: "user"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: More insertions than this before one row return to a grammar state that was left, so no cheapest path has them.
INSERTS = 2
FAR = 1 << 62

#: A row is one letter: its role's initial as s, u, a or x (any other), in upper case if it is truncated; "!" if it must go.
MUST_GO = "!"


@lru_cache(maxsize=None)
def arcs(row: str | None, inserts: int, state: int) -> tuple[tuple[str, int, bool, int, int], ...]:
    """Arcs of the composed automaton: label, cost, whether the row is consumed, insertions so far, state of the grammar."""
    made = []
    given = GRAMMAR[state][GIVEN[state][0]]
    if inserts < INSERTS:
        made.append(("I", INSERT, False, inserts + 1, given))
    if row is not None:
        made.append(("D", DELETE, True, 0, state))
        if row != MUST_GO:
            extra = TRUNCATED if row.isupper() else 0
            if row.lower() in GRAMMAR[state]:
                made.append(("K", extra, True, 0, GRAMMAR[state][row.lower()]))
            made.append(("R", REROLE + extra, True, 0, given))
    return tuple(sorted(made))


def shortest(rows: str, start: int = 0, end: int | None = None) -> tuple[int, str]:
    """Cost and labels of the shortest path over rows: from state start to acceptance, or to state end without insertions after the last row."""
    layers = [{(0, start)}]
    for row in rows:  # states that can be reached, in topological order
        here, later = layers[-1], set()
        for inserts in range(INSERTS + 1):
            for state in [s for n, s in here if n == inserts]:
                for _, _, consumed, n, to in arcs(row, inserts, state):
                    (later if consumed else here).add((n, to))
        layers.append(later)
    last: dict[tuple[int, int], tuple[int, str]] = {}
    for inserts in range(INSERTS, -1, -1):
        for state in GRAMMAR:
            stop = (0, "") if (state in ACCEPTED if end is None else (inserts, state) == (0, end)) else (FAR, "")
            go = [(cost + last[n, to][0], label) for label, cost, _, n, to in arcs(None, inserts, state)] if end is None else []
            last[inserts, state] = min([stop, *go])
    after, chosen = last, []
    for row, layer in zip(reversed(rows), reversed(layers[:-1]), strict=True):
        here = {}
        for inserts, state in sorted(layer, reverse=True):
            here[inserts, state] = min((cost + (after if consumed else here)[n, to][0], label) for label, cost, consumed, n, to in arcs(row, inserts, state))
        chosen.append(here)
        after = here
    chosen = [*reversed(chosen), last]
    labels, at, where = [], 0, (0, start)
    if after[0, start][0] >= FAR:
        return FAR, ""
    while label := chosen[at][where][1]:
        labels.append(label)
        row = rows[at] if at < len(rows) else None
        consumed, n, to = next(a[2:] for a in arcs(row, *where) if a[0] == label)
        at, where = at + consumed, (n, to)
        if at == len(rows) and end is not None:
            break
    return after[0, start][0], "".join(labels)


@lru_cache(maxsize=1 << 16)
def _whole(rows: str) -> tuple[int, str]:
    """shortest(), held for short conversations, of which many are alike."""
    return shortest(rows)


def joined(parts: list[list[tuple[int, str]]]) -> tuple[int, str]:
    """Cost and labels over the parts of one conversation, each as its sixteen shortest paths (from state * 4 + to state)."""
    rest = [shortest("", state) for state in GRAMMAR]
    for paths in reversed(parts):
        rest = [min((paths[4 * s + t][0] + rest[t][0], paths[4 * s + t][1] + rest[t][1]) for t in GRAMMAR if paths[4 * s + t][0] < FAR) for s in GRAMMAR]
    return rest[0]


def edited(rows: Iterator[tuple[str, str]], labels: str) -> Iterator[tuple[str, str, str]]:
    """label, role and text of the repaired turns: labels applied to the role and text of the rows."""
    state, rows = 0, iter(rows)
    for label in labels:
        role, text = next(rows) if label != "I" else ("", "")
        if label == "D":
            continue
        role = role if label == "K" else GIVEN[state]
        state = GRAMMAR[state][role[:1]]
        yield label, role, text


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with faults put in, by crc32 of "conv_id:turn" modulo 20.

    0 drops the row, 1 empties its text, 2 takes its full stops, question and exclamation marks, 3 repeats it, 4 makes it a
    user's. Null roles and texts are one space, as are null ids and turns in the checksum. Other columns are left out.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault")).where("fault != 0")
    times = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("time")).drop("time")


def _place(turn: str = "turn") -> list[Column]:
    return [F.col(turn).asc_nulls_first(), F.col("role"), F.col("text")]


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n (equal rows) and fault (blank, duplicate, truncated or none) over distinct rows.

    Where a row is no blank and n is above 1, all but its first copy are duplicates besides.
    """
    words = r"[^\x20\x09-\x0D]"
    same = F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.md5("role"), F.md5("text")))
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    # Only texts that one role has in two turns or more are joined back.
    twice = rows.groupBy(same.alias("k")).agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first != last").select(dealt_anew_text(F.col("k")).alias("k"), "first")
    at = distinct.withColumn("same", dealt_anew_text(same)).join(twice, F.col("same") == F.col("k"), "left")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(~F.col("text").rlike(words), "blank").when(F.col("k").isNotNull() & (order != F.col("first")), "duplicate").when(truncated, "truncated").otherwise("none")
    return at.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


def _same(a, b) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))


def audits(marked: DataFrame) -> DataFrame:
    """conv_id, illegal, cost and audit for each conversation of faults()."""
    initial = F.substring("role", 1, 1)
    letter = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).otherwise(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))
    letter = F.when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    kind = marked.schema["conv_id"].dataType.simpleString()
    ordered = marked.select("conv_id", "turn", "role", "text", "n", "fault", letter.alias("letter"), initial.alias("initial"))
    ordered = ordered.repartitionByRange(F.col("conv_id").asc_nulls_first(), *_place()).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *_place())
    # A text is read no further: beyond this point a row is two letters and a count.
    ordered = ordered.select("conv_id", "n", "fault", "letter", "initial", F.spark_partition_id().alias("part"))

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        schema = ["conv_id", "part", "border", "first", "last", "illegal", "cost", "audit", "paths"]

        def done(own: dict, border: bool) -> tuple:
            letters = "".join(own["letters"])
            if border:  # other tasks may hold more of it
                return own["id"], own["part"], True, own["first"], own["last"], own["illegal"], 0, "", [{"cost": c, "labels": s} for c, s in (shortest(letters, a, b) for a in GRAMMAR for b in GRAMMAR)]
            return own["id"], own["part"], False, own["first"], own["last"], own["illegal"], *(_whole(letters) if len(letters) < 64 else shortest(letters)), []

        own, first = None, True
        for batch in batches:
            made = []
            for conv, part, n, fault, letter, initial in zip(*(batch[c] for c in ("conv_id", "part", "n", "fault", "letter", "initial")), strict=True):
                if own is None or not _same(own["id"], conv):
                    if own is not None:
                        made.append(done(own, first))
                        first = False
                    own = {"id": conv, "part": part, "first": initial, "last": None, "illegal": 0, "letters": []}
                if own["last"] is not None and own["last"] + initial not in ("su", "ua", "au"):
                    own["illegal"] += 1
                own["illegal"] += n - 1  # copies follow each other
                own["last"] = initial
                own["letters"].append(letter + MUST_GO * (n - 1))
            yield pd.DataFrame(made, columns=schema)
        if own is not None:
            yield pd.DataFrame([done(own, True)], columns=schema)

    made = cut(ordered.mapInPandas(parts, f"conv_id {kind}, part int, border boolean, first string, last string, illegal long, cost long, audit string, paths array<struct<cost:long,labels:string>>"))

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        cost, audit = joined([[(p["cost"], p["labels"]) for p in paths] for paths in group["paths"]])
        between = sum(a + b not in ("su", "ua", "au") for a, b in zip(group["last"][:-1], group["first"][1:], strict=True))
        return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1], "illegal": [int(group["illegal"].sum()) + between], "cost": [cost], "audit": [audit]})

    # At most two conversations a task lie at its borders, and a group has a row for each task that the conversation spans.
    split = made.where("border").groupBy("conv_id").applyInPandas(compose, f"conv_id {kind}, illegal long, cost long, audit string")
    return made.where("not border").select("conv_id", "illegal", "cost", "audit").unionAll(split)


def _streams(rows: DataFrame, found: DataFrame, f, schema: str) -> DataFrame:
    """f over (conv_id, audit, iterator of role and text) of each conversation: rows pass in order and are not held."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    head = found.select("conv_id", F.lit(0).alias("step"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    both = head.unionAll(rows.select("conv_id", F.lit(1).alias("step"), "turn", "role", "text"))
    dealt = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "step", *_place())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = (row for b in batches for row in zip(b["conv_id"], b["role"], b["text"], strict=True))
        for _, group in groupby(every, key=lambda r: None if pd.isna(r[0]) else r[0]):
            conv, _, audit = next(group)
            yield from f(conv, audit, ((role, text) for _, role, text in group))

    return dealt.select("conv_id", "role", "text").mapInPandas(run, f"conv_id {kind}, {schema}")


def repaired_turns(rows: DataFrame, block: int = 1024) -> DataFrame:
    """conv_id, position (from 0), edit, role and text of the repaired conversations."""

    def turns(conv, audit, own):
        held = []
        for k, (label, role, text) in enumerate(edited(own, audit)):
            held.append((conv, k, label, role, text))
            if len(held) == block:
                yield pd.DataFrame(held, columns=["conv_id", "position", "edit", "role", "text"])
                held = []
        yield pd.DataFrame(held, columns=["conv_id", "position", "edit", "role", "text"])

    return _streams(rows, audits(faults(rows)), turns, "position long, edit string, role string, text string")


def repair(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 for each conversation.

    rows has conv_id, turn, role and text, none of the last two null. A conversation's rows are taken by turn, nulls first,
    then role, then text. every names further conversations in its conv_id: they have no rows, zeros, an empty audit and
    the digest of nothing. A null conv_id is a conversation of its own. An empty table gives no rows. Roles are judged by
    their first character; other characters than s, u and a, and empty roles, are never kept. Equal rows are duplicates.

    The digest reads a conversation's text in order, so it is made by one task for each conversation, which streams it;
    everything else is split.
    """
    marked = cut(faults(rows))
    at = (F.col("n") - 1) * (F.col("fault") != "blank").cast("int")
    counts = marked.groupBy("conv_id").agg(
        F.sum(F.when(F.col("fault") == "blank", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", 1).otherwise(0) + at).alias("duplicate"),
        F.count_if(F.col("fault") == "truncated").alias("truncated"),
    )
    turns = marked.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    found = cut(audits(marked))

    def digest(conv, audit, own):
        made, first = hashlib.sha256(), True
        for _, role, text in edited(own, audit):
            made.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
        yield pd.DataFrame({"conv_id": pd.Series([conv]), "repaired_sha256": [made.hexdigest()]})

    digests = _streams(rows, found, digest, "repaired_sha256 string")
    whole = (every.select("conv_id") if every is not None else rows.select("conv_id")).groupBy("conv_id").agg(F.lit(1).alias("one")).select(F.col("conv_id").alias("conv"))
    for k, part in enumerate((counts, turns, found, digests)):
        whole = whole.join(part.withColumnRenamed("conv_id", f"c{k}"), F.col("conv").eqNullSafe(F.col(f"c{k}")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return whole.select(
        F.col("conv").alias("conv_id"), *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    )
