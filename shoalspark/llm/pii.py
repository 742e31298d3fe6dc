"""Surrogates for personal data (DataFrame functions only).

Entities are found by pattern and replaced by keyed surrogates of the same type and format. The surrogate hangs on the key
and on the plain form of the value alone (digits of a number, a mailbox in lower case, each name of a person), and the
mention's own format is put on afterwards, so mentions of one value agree across the corpus, however they are written,
without any join. A corpus-wide check over the distinct plain values finds surrogates that two values share, or that the
corpus already holds, and draws them anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, if_small

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Herr|Frau|Señora|Señor|Madame|Monsieur|Mme|Г-н|Г-жа)\.?"
#: What stands before a name without a title. Each is of a bounded length, as a lookbehind needs.
_CUE = r"(?:[Nn]ame is |Name: |Mein Name ist |Me llamo |me llamo |nombre es |Je m'appelle |je m'appelle |nom est |[Мм]еня зовут |[Ss]igned by |[Rr]egards,\s|Sincerely,\s|Grüßen,?\s|Atentamente,\s|Cordialement,\s)"
_NAME = r"\p{Lu}\p{L}{1,63}+(?!\p{L})(?:[-’']\p{Lu}\p{L}{1,63}+(?!\p{L}))?"
_HEX = r"[0-9A-Fa-f]{1,4}+"
_FIRST6 = r"(?:[23][0-9A-Fa-f]{3}|[Ff](?:[CcDd][0-9A-Fa-f]{2}|[Ee]80))"
#: Type -> pattern; where two match at one place the first counts. No group repeats without bound: Java's matcher recurses
#: on each repeat of a group, and a long text would overflow the stack. All matches are short: a mailbox has at most 64
#: characters and a label of a domain 63, as their standards say; more than 31 labels, and names above 64 letters, are none.
PATTERNS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,30}[A-Za-z]{2,63}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])",
    # Five groups of four are a card and a number before or after it; a longer number before four groups of four is no part of the card.
    "card": r"(?<![\w.-])(?:[2-6]\d{3}(?:[ -]\d{4}){4}(?![\w-])(?![ -]\d{4}(?!\d))|(?!\d{5,12}[ -][2-6]\d{3}(?:[ -]\d{4}){3}(?![\w-]))[2-6]\d{3}(?:[ -]?\d){9,15}(?![\w-]))",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "nino": r"(?<![A-Za-z0-9])[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D](?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "ipv6": rf"(?<![\w:.]){_FIRST6}:(?:(?:{_HEX}:){{6}}{_HEX}|(?:{_HEX}:){{0,5}}(?::{_HEX}){{1,6}})(?![\w:])",
    "person": rf"(?=[MHFSГ])(?<![\p{{L}}]){_TITLE} {_NAME}(?: {_NAME})?|(?={_NAME} \p{{Lu}}\p{{L}})(?<=\s)(?<={_CUE}){_NAME} {_NAME}",
}
NO_ENTITY = "none"
#: All patterns, each behind a look at the first character, which most places of a text fail.
_FIRST = {"email": "", "iban": "(?=[A-Z])", "phone": "(?=[0-9+(])", "card": "(?=[2-6])", "ssn": "(?=[0-9])", "nino": "(?=[A-Z])", "ip": "(?=[0-9])", "ipv6": "(?=[23Ff])", "person": r"(?=\p{Lu})"}
ANY = "|".join(f"{_FIRST[k]}(?:{p})" for k, p in PATTERNS.items())
#: A cheap test that every text with an entity passes.
HINT = rf"[0-9@]|(?=[MHFSГ]){_TITLE} |(?=[NnMmJjSsRrGACМм]){_CUE}"
#: Syllables of made-up names by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa ga go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo za ze zo".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за зе зо ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то".split(),
    "greek": "βα βε βο γα γε γο δα δε δο ζα ζε ζο κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το".split(),
}
FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Señora|Madame|Mme|Г-жа)"
MALE = r"^(?:Mr|Herr|Señor|Monsieur|Г-н)"
#: Endings of a name by script, after a female and after a male title.
ENDINGS = {"latin": ("na", "n"), "cyrillic": ("на", "н"), "greek": ("να", "ν")}
KEY_SETTING = "spark.shoalspark.surrogate.key"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once and one copy of it in the plan, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts), 256)


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte of a hex digest, from its start again after 32."""
    return F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _chars(value: Column) -> Column:
    return F.split(value, "")


def _same_classes(value: Column, digest: Column, letters: str = "[a-z]") -> Column:
    """Digits become digits and letters letters of the same case; other characters stay."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        return F.when(c.rlike("[0-9]"), (b % 10).cast("string")).when(c.rlike(letters), F.char(b % 26 + 97)).when(c.rlike("[A-Z]"), F.char(b % 26 + 65)).otherwise(c)

    return F.array_join(F.transform(_chars(value), one), "")


def _hex_digits(value: Column, digest: Column) -> Column:
    return F.array_join(F.transform(_chars(value), lambda c, i: F.when(c.rlike("[0-9a-f]"), F.lower(F.hex(_byte(digest, i) % 16))).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit a check digit."""
    each = F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.when(c.cast("int") >= 5, 1).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _quotient(v: Column, by: Column) -> Column:
    """v div by of bigints, exactly: by is a power of ten, so its digits are cut off."""
    return F.coalesce(F.substr(v.cast("string"), F.lit(1), F.length(v.cast("string")) - F.length(by.cast("string")) + 1).try_cast("long"), F.lit(0).cast("long"))


def _permuted(kind: Column, kept: Column, digits: Column, key: str) -> Column:
    """Other digits of the same number: a keyed permutation of all numbers of that length that start alike (kept).

    Two numbers never get one surrogate and none gets itself, however much of the space the corpus uses: an alternating
    Feistel network over both halves, a step of keyed length round the whole space, and the network backwards. No digits stay.
    """
    left = F.ceil(F.length(digits) / 2).cast("int")
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    a, b = power(left), power(F.length(digits) - left)
    number = lambda *parts: F.conv(F.substring(_digest(key, F.lit("digits"), kind, kept, F.length(digits).cast("string"), *parts), 1, 15), 16, 10).cast("long")

    def step(acc: Column, i: Column, sign: int) -> Column:
        even = i % 2 == 0
        f = number(i.cast("string"), F.when(even, acc["r"]).otherwise(acc["l"]).cast("string")) * sign
        return F.struct(F.when(even, F.pmod(acc["l"] + f, acc["a"])).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(F.pmod(acc["r"] + f, acc["b"])).alias("r"), acc["a"].alias("a"), acc["b"].alias("b"))

    rounds = F.array(*map(F.lit, range(4)))
    halves = F.struct(F.substr(digits, F.lit(1), left).cast("long").alias("l"), F.coalesce(F.substr(digits, left + 1).try_cast("long"), F.lit(0).cast("long")).alias("r"), a.alias("a"), b.alias("b"))
    # Above 18 digits the whole space passes a bigint, its halves do not: the step is added to them, with a carry.
    space = F.when(F.length(digits) < 19, power(F.least(F.length(digits), F.lit(18)))).otherwise(F.lit((1 << 63) - 1))
    added = lambda acc, by: _let(acc["r"] + F.pmod(by, b), lambda r: F.struct(F.pmod(acc["l"] + _quotient(by, b) + F.when(r < b, 0).otherwise(1), a).alias("l"), F.pmod(r, b).alias("r"), a.alias("a"), b.alias("b")))
    there = F.aggregate(rounds, halves, lambda acc, i: step(acc, i, 1), lambda acc: _let(1 + number(F.lit("shift")) % (space - 1), lambda by: added(acc, by)))
    back = F.aggregate(F.reverse(rounds), there, lambda acc, i: step(acc, i, -1), lambda acc: F.concat(F.lpad(acc["l"].cast("string"), left, "0"), F.when(acc["b"] > 1, F.lpad(acc["r"].cast("string"), F.length(digits) - left, "0")).otherwise("")))
    return F.when(F.length(digits) == 0, digits).otherwise(back)


def _numbers(kind: Column, plain: Column, key: str) -> Column:
    """Surrogates of phones, cards and nine-digit numbers, in one expression, as plans hold every copy of it.

    A phone keeps its plus sign and first digit, a card its first digit and a check digit that is right as the value's is.
    """
    kept = F.when(kind == "phone", _country(plain)).when(kind == "card", F.substring(plain, 1, 1)).otherwise("")
    digits = F.when(kind == "card", F.substr(plain, F.lit(2), F.length(plain) - 2)).otherwise(F.substr(plain, F.length(kept) + 1))
    checked = lambda v: F.when(kind == "card", F.concat(v, ((10 - _luhn(F.concat(v, F.lit("0"))) % 10) % 10).cast("string"))).otherwise(v)
    return _let(F.struct(kept.alias("kept"), digits.alias("digits")), lambda x: _let(F.concat(x["kept"], _permuted(kind, x["kept"], x["digits"], key)), checked))


def _iban(value: Column, digest: Column) -> Column:
    """Keeps country and length; the two check digits are right for the new number."""

    def whole(body: Column) -> Column:
        moved = F.concat(body, F.substring(value, 1, 2), F.lit("00"))
        rest = F.aggregate(_chars(moved), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
        return F.concat(F.substring(value, 1, 2), F.lpad((98 - rest).cast("string"), 2, "0"), body)

    return _let(_same_classes(F.substr(value, F.lit(5)), digest), whole)


def _by_script(name: Column, latin, cyrillic, greek) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), cyrillic).when(name.rlike(r"\p{IsGreek}"), greek).otherwise(latin)


def _made_name(digest: Column, attempt: Column, name: Column) -> Column:
    """Lower-case syllables of the name's script: four, and three more after every fourth attempt, so that space never ends.

    With an ending of one or two letters the lengths of the three forms never meet, so different syllables stay different.
    """
    count = 3 + 3 * F.least(F.floor(attempt / 4), F.lit(4)).cast("int")
    made = lambda script: F.array_join(F.transform(F.sequence(F.lit(0), count), lambda k: F.get(F.array(*map(F.lit, SYLLABLES[script])), _byte(digest, k) % len(SYLLABLES[script]))), "")
    return _by_script(name, *map(made, SYLLABLES))


#: Kinds whose surrogates are permutations, so that none need be drawn anew.
PERMUTED = ("phone", "card", "ssn")


def _country(plain: Column) -> Column:
    """The plus sign and first digit of a plain phone number, if it starts so."""
    return F.when(plain.startswith("+"), F.substring(plain, 1, 2)).otherwise("")


def _core(kind: Column, plain: Column, attempt: Column, key: str, numbers: bool = True) -> Column:
    """The plain surrogate of a plain value; without numbers, of values of other kinds than PERMUTED alone."""
    drawn = _let(_digest(key, kind, plain, attempt), lambda d: _drawn(kind, plain, attempt, key, d))
    return F.when(kind.isin(*PERMUTED), _numbers(kind, plain, key)).otherwise(drawn) if numbers else drawn


def _drawn(kind: Column, plain: Column, attempt: Column, key: str, d: Column) -> Column:
    """The plain surrogate of a plain value of other kinds than PERMUTED, from its digest."""
    local, domain = F.substring_index(plain, "@", 1), F.substring_index(plain, "@", -1)
    stem = F.regexp_replace(domain, r"\.[a-z]+$", "")
    wider = F.when(attempt > 2, F.concat(F.lit("x"), F.substring(d, 1, 8))).otherwise("")
    # All mailboxes of a domain go to one domain.
    email = F.concat(_same_classes(local, d), wider, F.lit("@"), _let(_digest(key, F.lit("domain"), domain), lambda e: _same_classes(stem, e)), F.lit(".example"))
    ip = F.concat_ws(".", (_byte(d, F.lit(0)) % 16 + 240).cast("string"), *[_byte(d, F.lit(i)).cast("string") for i in (1, 2, 3)])
    return (
        F.when(kind == "name", _made_name(d, attempt, plain))
        .when(kind == "email", email)
        .when(kind == "iban", _iban(plain, d))
        .when(kind == "nino", F.concat(F.lit("Q"), _same_classes(F.substr(plain, F.lit(2), F.lit(7)), d), F.char(_byte(d, F.lit(9)) % 4 + 65)))
        .when(kind == "ipv6", F.concat(F.lit("fd"), _hex_digits(F.substr(F.regexp_replace(plain, ":", ""), F.lit(3)), d)))
        .otherwise(ip)
    )


def _plain(kind: Column, value: Column) -> Column:
    """The value without its format; values of a type that differ in it alone are one. Persons are taken apart by _parts."""
    digits = F.regexp_replace(value, r"\D", "")
    return (
        F.when(kind.isin("email", "ipv6"), F.lower(value))
        .when(kind == "phone", F.concat(F.when(value.startswith("+"), "+").otherwise(""), digits))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind.isin("iban", "nino"), F.regexp_replace(value, " ", ""))
        .otherwise(value)
    )


def _title_and_names(value: Column) -> tuple[Column, Column]:
    return F.regexp_extract(value, rf"^{_TITLE} ", 0), F.split(F.regexp_replace(value, rf"^{_TITLE} ", ""), " ")


def _parts(kind: Column, value: Column) -> Column:
    """The plain values of an entity, as an array of structs of kind and plain: each name of a person, else the one value."""
    pair = lambda k, p: F.struct(k.alias("kind"), p.alias("plain"))
    names = F.transform(_title_and_names(value)[1], lambda n: pair(F.lit("name"), F.lower(n)))
    return F.when(kind == "person", names).otherwise(F.array(pair(kind, _plain(kind, value))))


def _formatted(value: Column, core: Column) -> Column:
    """core with the separators of value: the n-th letter, digit or plus sign of value becomes the n-th character of core."""
    place = lambda i: F.length(F.regexp_replace(F.substr(value, F.lit(1), i + 1), r"[^0-9A-Za-z+]", ""))
    return F.array_join(F.transform(_chars(value), lambda c, i: F.when(c.rlike(r"[0-9A-Za-z+]"), F.substr(core, place(i), F.lit(1))).otherwise(c)), "")


def _known_name(n: Column, key: str, anew: Column, gender: Column) -> Column:
    """The surrogate of one name in the name's own case; gender (f, m or null) chooses the ending."""
    first = lambda plain: _let(_digest(key, F.lit("name"), plain, F.lit(0)), lambda d: _made_name(d, F.lit(0), plain))
    core = _let(F.lower(n), lambda plain: F.coalesce(F.try_element_at(anew, F.concat(F.lit("name:"), plain)), first(plain)))
    ending = lambda at: _by_script(n, *[e[at] for e in ENDINGS.values()])
    last = _let(gender, lambda g: F.when(g == "f", ending(0)).when(g == "m", ending(1)).otherwise(""))
    return _let(F.concat(core, last), lambda whole: F.when(n == F.upper(n), F.upper(whole)).otherwise(F.initcap(whole)))


def _gender(title: Column) -> Column:
    return F.when(title.rlike(FEMALE), "f").when(title.rlike(MALE), "m")


def _persons(found: Column) -> Column:
    """name (lower case) and gender (f, m or null, by the mention's title) of every name of a text's persons."""
    def names(x: Column) -> Column:
        title, each = _title_and_names(x["value"])
        return F.transform(each, lambda n: F.struct(F.lower(n).alias("name"), _gender(title).alias("gender")))

    return F.flatten(F.transform(F.filter(found, lambda x: x["kind"] == "person"), names))


def _text_gender(persons: Column, n: Column) -> Column:
    """The gender of a name in a text: that of the first mention whose title tells."""
    return F.get(F.filter(persons, lambda p: (p["name"] == F.lower(n)) & p["gender"].isNotNull()), F.lit(0))["gender"]


def _other_mentions(gap: Column, persons: Column, key: str, anew: Column) -> Column:
    """What lies between entities, with every capital word that is a name of the text's persons replaced as that name is."""
    word = lambda w: w.rlike(r"^\p{Lu}") & F.exists(persons, lambda p: p["name"] == F.lower(w))
    split = F.regexp_extract_all(gap, F.lit(r"\p{L}++(?:[-’']\p{Lu}\p{L}++)?|[^\p{L}]++"), F.lit(0))
    return F.array_join(F.transform(split, lambda w: F.when(word(w), _known_name(w, key, anew, _text_gender(persons, w))).otherwise(w)), "")


def _surrogate(kind: Column, value: Column, key: str, anew: Column, persons: Column) -> Column:
    """The surrogate of a mention. anew maps kind and plain value, joined by a colon, to cores drawn anew."""
    core = _let(_plain(kind, value), lambda p: F.coalesce(F.try_element_at(anew, F.concat(kind, F.lit(":"), p)), _core(kind, p, F.lit(0), key)))
    title, names = _title_and_names(value)
    name = lambda n: _known_name(n, key, anew, F.coalesce(_gender(title), _text_gender(persons, n)))
    cased = lambda core: F.array_join(F.transform(_chars(core), lambda c, i: F.when((i < F.length(core) - 8) & F.substr(value, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")
    return (
        F.when(kind == NO_ENTITY, value)
        .when(kind == "person", F.concat(title, F.array_join(F.transform(names, name), " ")))
        .otherwise(_let(core, lambda c: F.when(kind == "email", cased(c)).when(kind == "ip", c).otherwise(_formatted(value, c))))
    )


def _valid_card(value: Column) -> Column:
    return value.rlike(r"^[2-6]\d{3}(?:[ -]?\d){9,15}$") & (_luhn(F.regexp_replace(value, r"\D", "")) % 10 == 0)


def _within(value: Column) -> Column:
    """before, value, after of a match: of a long number that is no card, the first and then longest run of its groups that is one."""
    whole = lambda: F.struct(F.lit("").alias("before"), value.alias("value"), F.lit("").alias("after"))
    places, digit = F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(value, i, F.lit(1)).rlike("[0-9]")
    starts = F.filter(places, lambda i: digit(i) & ((i == 1) | ~digit(i - 1)))
    ends = F.filter(places, lambda i: digit(i) & ~digit(i + 1))
    runs = F.flatten(F.transform(starts, lambda a: F.transform(F.filter(ends, lambda b: b - a >= 12), lambda b: F.struct(a.alias("first"), (-b).alias("last")))))
    part = lambda r: F.substr(value, r["first"], 1 - r["first"] - r["last"])
    best = F.array_min(F.filter(runs, lambda r: _valid_card(part(r))))
    split = F.transform(F.array(best), lambda r: F.struct(F.substr(value, F.lit(1), r["first"] - 1).alias("before"), part(r).alias("value"), F.substr(value, 1 - r["last"]).alias("after")))
    number = value.rlike(r"^[2-6]\d{3}[\d -]{9,}$") & value.rlike(f"^(?:{PATTERNS['card']})$") & ~value.rlike(f"^(?:{PATTERNS['phone']})$") & ~_valid_card(value)
    return F.when(number, F.coalesce(F.when(best.isNotNull(), F.get(split, F.lit(0))), whole())).otherwise(whole())


def _kind(value: Column) -> Column:
    """The type of a match; long numbers that fail the Luhn check are no cards, and no entities (NO_ENTITY)."""
    made = F.when(value.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    for k in [k for k in PATTERNS if k not in ("email", "person")]:
        kind = F.when(_valid_card(value), k).otherwise(NO_ENTITY) if k == "card" else F.lit(k)
        made = made.when(value.rlike(f"^(?:{PATTERNS[k]})$"), kind)
    return made.otherwise("person")


def _found(text: Column) -> Column:
    """The matches of a text in order, as before, value, after; before and after stay as they are."""
    return F.when(text.rlike(HINT), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), _within)).otherwise(F.array().cast("array<struct<before:string,value:string,after:string>>"))


def _gaps_and_matches(text: Column) -> Column:
    """A text taken apart in one pass: gap, match, gap and so on to the last gap. A text that holds the marks takes two."""
    marked = F.split(F.regexp_replace(text, ANY, "\u0001$0\u0002"), "[\u0001\u0002]", -1)
    gaps, found = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    apart = F.flatten(F.zip_with(gaps, found, lambda g, m: F.when(m.isNull(), F.array(g)).otherwise(F.array(g, m))))
    return F.when(~F.coalesce(text.rlike(HINT), F.lit(False)), F.array(text)).when(text.rlike("[\u0001\u0002]"), apart).otherwise(marked)


def _repaired(plains: DataFrame, key: str, rounds: int) -> DataFrame:
    """kind, plain, core over distinct plain values, no core twice and none equal to a plain value of the corpus."""
    drawn_for = lambda df: cut(df.withColumn("core", _core(F.col("kind"), F.col("plain"), F.col("attempt"), key, numbers=False)))
    at = drawn_for(plains.withColumn("attempt", F.lit(0)))
    for _ in range(rounds):
        # A core belongs to the corpus's own value if there is one, else to the smallest value that drew it.
        drawn = at.select("core", F.struct(F.lit(1).alias("late"), "kind", "plain").alias("by"))
        held = at.select(F.col("plain").alias("core"), F.struct(F.lit(0).alias("late"), "kind", "plain").alias("by"))
        taken = cut(drawn.unionAll(held).groupBy("core").agg(F.min("by").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1"))
        if taken.isEmpty():
            return at
        clash = at.join(taken.select(F.col("core").alias("c"), F.col("owner").alias("o")), F.col("core") == F.col("c"), "left_outer")
        again = F.col("o").isNotNull() & ((F.col("o.late") == 0) | (F.col("o.plain") != F.col("plain")) | (F.col("o.kind") != F.col("kind")))
        at = drawn_for(clash.select("kind", "plain", F.when(again, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt")))
    raise ValueError(f"surrogates still collide after {rounds} rounds; the value space of a type is too small for its entities")


def surrogate_key(session, default: str | None = None) -> str:
    """The secret key, from the setting spark.shoalspark.surrogate.key; without it and without a default, an error."""
    key = session.conf.get(KEY_SETTING, None) or default
    if not key:
        raise ValueError(f"set {KEY_SETTING} to a secret key")
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, rounds: int = 24, counts: bool = False) -> DataFrame:
    """docs with the entities of text replaced; all columns stay, n_chars follows the new text if there is one.

    With counts, columns n_<type> (long) come on top of doc_id and text and nothing else is returned. The key comes from
    the configuration if none is given. Values that differ in format alone (case of a mailbox, separators of a number,
    case of a name, a title) have surrogates that differ in format alone, in all texts; other values have different
    surrogates. Phones, cards and nine-digit numbers are permuted within all of their length and start, so theirs may be other
    values of the corpus, which are replaced in turn. Once a text has a person, each capital word of it that is one of the
    person's names is replaced as well, and takes the gender that a title in the text gives the name. Of matches at one place the first type counts. Null and empty texts stay as they are, repeated rows get
    equal texts, an empty table gives no rows. Columns other than text and n_chars are passed on, whatever their names.
    """
    key = key or surrogate_key(docs.sparkSession)
    text = F.col("row.text")
    rows = docs.select(F.struct("*").alias("row"))
    found = rows.select(_found(text).alias("v")).where(F.size("v") > 0).select(F.explode("v.value").alias("value"))
    entities = found.groupBy("value").agg(F.lit(1).alias("one")).select(_kind(F.col("value")).alias("kind"), "value").where(F.col("kind") != NO_ENTITY)
    plains = entities.select(F.explode(_parts(F.col("kind"), F.col("value"))).alias("p")).groupBy("p.kind", "p.plain").agg(F.lit(1).alias("one")).select("kind", "plain")
    drawn_anew = _repaired(plains.where(~F.col("kind").isin(*PERMUTED)), key, rounds).where("attempt > 0").select(F.concat("kind", F.lit(":"), "plain").alias("drawn"), F.col("core").alias("instead"))

    marked = rows.select("row", _gaps_and_matches(text).alias("apart"))
    marked = marked.select("row", F.filter("apart", lambda c, i: i % 2 == 0).alias("gaps"), F.transform(F.filter("apart", lambda c, i: i % 2 == 1), _within).alias("v"))
    if not drawn_anew.isEmpty():
        # Texts with values drawn anew get a map of them, joined by the text itself: none meets rows of other texts.
        parts = F.flatten(F.transform(_found(text), lambda x: _parts(_kind(x["value"]), x["value"])))
        pairs = rows.select(F.sha2(text, 256).alias("text_key"), F.explode(F.array_distinct(F.transform(parts, lambda p: F.concat(p["kind"], F.lit(":"), p["plain"])))).alias("part")).groupBy("text_key", "part").agg(F.lit(1).alias("one"))
        maps = cut(pairs.join(drawn_anew, F.col("part") == F.col("drawn")).groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("drawn", "instead"))).alias("anew")))
        marked = marked.withColumn("text_key", F.sha2(text, 256)).join(if_small(maps), "text_key", "left")
    else:
        marked = marked.withColumn("anew", F.lit(None).cast("map<string,string>"))
    each = marked.withColumn("s", F.transform("v", lambda x: F.struct(x["before"].alias("before"), x["value"].alias("value"), x["after"].alias("after"), _kind(x["value"]).alias("kind")))).withColumn("persons", _persons(F.col("s")))
    made = each.withColumn("s", F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), F.concat(x["before"], _surrogate(x["kind"], x["value"], key, F.col("anew"), F.col("persons")), x["after"]).alias("new"))))
    made = made.withColumn("gaps", F.when(F.size("persons") > 0, F.transform("gaps", lambda g: _other_mentions(g, F.col("persons"), key, F.col("anew")))).otherwise(F.col("gaps")))
    whole = F.when(F.size("s") == 0, text).otherwise(F.array_join(F.zip_with("gaps", F.transform("s", lambda x: x["new"]), lambda g, n: F.concat(F.coalesce(g, F.lit("")), F.coalesce(n, F.lit("")))), ""))
    if counts:
        of = lambda k: F.filter("s", lambda x: x["kind"] == k)
        n = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in PATTERNS]
        return made.select("row.doc_id", whole.alias("text"), *n)
    fields = [whole.alias(c) if c == "text" else F.coalesce(F.length(whole), F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns]
    return made.select(*fields)
