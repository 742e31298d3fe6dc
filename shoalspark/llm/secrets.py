"""Secret scans with corpus-wide ownership frequency (DataFrame functions only).

Candidates are found per text, hashed, and counted by distinct repositories and owners over the whole corpus: a value
that many owners carry is a copied example; one that a single owner carries and that looks random is live-looking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, dealt_anew_text

#: Kind -> (pattern, group of the value, least length of the value), in the order of base kinds, then the method's own.
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    "jwt": (r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    "vendor": (r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})", 0, 1),
}
#: Scanned instead of the pattern where it finds the same kept matches faster.
SCAN = {"hex": r"(?<![0-9a-f])[0-9a-f]{32,}"}
BASE = ("assign", "access", "hex")
#: Words that mark placeholders.
PLACEHOLDER = r"(?i)example|changeme|change_me|placeholder|dummy|your[_-]?|xxxx|12345678|abcdefgh"


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _starts(lengths: Column) -> Column:
    """Sums of all lengths before each: first within blocks of about the square root of the array's size, then of the blocks.

    A fold that grows one array would copy it for each element; these grow to the square root alone.
    """
    one = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    sums = lambda a: F.aggregate(a, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), one)

    def of(a: Column, width: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / width).cast("int")), lambda b: sums(F.slice(a, b * width + 1, width)))
        return _let(blocks, lambda inner: F.flatten(F.zip_with(inner, sums(F.transform(inner, lambda x: x["at"]))["out"], lambda x, before: F.transform(x["out"], lambda y: y + before))))

    return _let(lengths, lambda a: F.when(F.size(a) > 0, of(a, F.ceil(F.sqrt(F.size(a))).cast("int"))).otherwise(F.array().cast("array<int>")))


def _matches(text: Column, kind: str) -> Column:
    """Array of structs (start, stop, kind, ord, value) in code points; the gaps that split() leaves give the places."""
    pattern, group, least = KINDS[kind]
    pattern = SCAN.get(kind, pattern)
    found, values, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.split(text, pattern, -1)
    lengths = F.transform(F.arrays_zip(found.alias("m"), values.alias("v"), F.slice(gaps, 1, F.size(found)).alias("g")), lambda x: F.struct(F.length(x["g"]).alias("g"), F.length(x["m"]).alias("m"), x["v"].alias("v")))

    def placed(z: Column) -> Column:
        at = lambda x, before: F.struct((before + x["g"]).alias("start"), (before + x["g"] + x["m"]).alias("stop"), F.lit(kind).alias("kind"), F.lit(list(KINDS).index(kind)).alias("ord"), x["v"].alias("value"))
        return F.filter(F.zip_with(z, _starts(F.transform(z, lambda x: x["g"] + x["m"])), at), lambda s: F.length(s["value"]) >= least)

    none = F.array().cast("array<struct<start:int,stop:int,kind:string,ord:int,value:string>>")
    return F.when(text.rlike(pattern), _let(lengths, placed)).otherwise(none)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per input row: doc_id, owner, repo, text_key, hits (array of structs by start, then kind).

    Null text is empty: no hits. Null owners and repositories count as one each. Only the named columns are read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    one = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("\u0000")).alias("owner"),
        F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in repo_cols]).alias("repo"),
        text.alias("text"),
    )
    hits = F.sort_array(F.concat(*[_matches(F.col("text"), k) for k in KINDS]))
    ordered = F.transform(
        F.sort_array(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["ord"].alias("ord"), h["stop"].alias("stop"), h["kind"].alias("kind"), h["value"].alias("value")))),
        lambda h: F.struct(h["start"].alias("start"), h["stop"].alias("stop"), h["kind"].alias("kind"), F.sha2(h["value"], 256).alias("hash"), h["value"].rlike(PLACEHOLDER).alias("placeholder"), _random_looking(h["value"]).alias("random")),
    )
    return one.select("doc_id", "owner", "repo", F.xxhash64("text").alias("text_key"), ordered.alias("hits"))


def _of(*kinds: str) -> Column:
    return F.filter("hits", lambda h: h["kind"].isin(*kinds))


def _random_looking(value: Column) -> Column:
    """At least 16 characters with digits and letters and 8 or more different characters."""
    return (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)


def ownership(hits: DataFrame) -> DataFrame:
    """hash -> n_repos, n_owners, n_hits. Distinct pairs are reduced before the shuffle, so a value in every row is cheap."""
    pairs = hits.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_hits"))


def find_secrets(docs: DataFrame, max_owners: int = 1, max_repos: int = 3, **columns) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, max_owners, max_repos.

    A value in the texts of more than max_owners owners or of more than max_repos repositories is a copied one (n_copied
    counts its hits); n_live counts hits of other values that look random and are no placeholders. The last two columns
    are the most owners and repositories of a text's values. Null and empty texts, and others without hits, have zeros and
    null in those; repeated rows get equal results; an empty table gives no rows.
    """
    scanned = cut(scan(docs, **columns))
    rows = scanned.select(
        "doc_id", "text_key",
        *[F.size(_of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(_of(*BASE)), 256).alias("base_sha256"),
        _joined(F.col("hits")).alias("spans"),
    )
    hits = scanned.where(F.size("hits") > 0).select("doc_id", "text_key", "owner", "repo", F.explode("hits").alias("h")).select("doc_id", "text_key", "owner", "repo", "h.*")
    known = cut(ownership(hits)).select(dealt_anew_text(F.col("hash")).alias("known"), "n_owners", "n_repos")
    each = hits.groupBy("hash", "doc_id", "text_key", "start", "stop", "kind", "placeholder", "random").agg(F.lit(1).alias("one"))
    judged = each.select(dealt_anew_text(F.col("hash")).alias("value"), "doc_id", "text_key", "placeholder", "random").join(known, F.col("value") == F.col("known"))
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    by_doc = judged.groupBy("doc_id", "text_key").agg(
        F.count_if(few & F.col("random") & ~F.col("placeholder")).alias("n_live"), F.count_if(~few).alias("n_copied"), F.max("n_owners").alias("max_owners"), F.max("n_repos").alias("max_repos")
    )
    # Only texts with hits have partners, and (doc_id, text_key) is as even as the ids are.
    b = by_doc.select(F.col("doc_id").alias("b_id"), F.col("text_key").alias("b_key"), "n_live", "n_copied", "max_owners", "max_repos")
    zero = F.lit(0).cast("long")
    return rows.join(b, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_key") == F.col("b_key")), "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"), "max_owners", "max_repos"
    )
