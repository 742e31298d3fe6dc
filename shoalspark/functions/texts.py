"""String, date and name rules as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def garbage(s: Column, share: float = 0.3) -> Column:
    """True if more than share of the characters are neither ASCII letters, digits nor white space; null and empty: false."""
    odd = F.length(F.regexp_replace(s, r"[A-Za-z0-9\s]", ""))
    return F.coalesce(odd / F.nullif(F.length(s), F.lit(0)) > share, F.lit(False))


#: Texts that stand for no date.
NO_DATE = ("N/A", "UNKNOWN", "NULL", "NONE", "NAN", "")


def any_date(s: Column) -> Column:
    """A date in the formats Y-m-d, Y/m/d, Y-m, Ymd and Y, else January 1st of the first number of a year, rounded, that stands alone."""
    t = F.trim(s)
    made = [
        F.when(t.rlike(p), F.try_to_date(t, f))
        for p, f in ((r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{4}-\d{1,2}$", "yyyy-M"), (r"^\d{8}$", "yyyyMMdd"), (r"^\d{4}$", "yyyy"))
    ]
    number = F.regexp_extract(t, r"\b((?:17|18|19|20)\d{2}(?:\.\d+)?)\b", 1)
    year = F.when(number != "", F.make_date(F.bround(number.try_cast("double")).cast("int"), F.lit(1), F.lit(1)))
    return F.when(~F.upper(t).isin(*NO_DATE), F.coalesce(*made, year))


def coordinate(s: Column) -> Column:
    """Degrees of 28.0N or 94.8W texts; other texts are null."""
    t = F.regexp_replace(F.trim(s), "-", "")
    n = F.regexp_extract(t, r"^([0-9.]+)[NSEW]$", 1).try_cast("double")
    return F.when(t.rlike("[NE]$"), n).when(t.rlike("[SW]$"), -n)


def number_in(s: Column) -> Column:
    """The first number of a text, 0 if there is none."""
    return F.coalesce(F.regexp_extract(s, r"(\d+\.?\d*)", 1).try_cast("double"), F.lit(0.0))


def not_blank(a: Column, b: Column) -> Column:
    return F.when(F.trim(a) != "", a).otherwise(b)


def plain_name(s: Column) -> Column:
    """Spaces become underscores, other punctuation goes."""
    return F.regexp_replace(F.regexp_replace(s, " ", "_"), r"[^A-Za-z0-9_]", "")


def fuzzy(s: Column) -> Column:
    return F.lower(F.trim(F.translate(s, " ", " ")))


def flags(*named: tuple[str, Column]) -> Column:
    """The names of the conditions that hold, joined by semicolons in the order given."""
    return F.concat_ws(";", *[F.when(c, n) for n, c in named])


def out_of_range(x: Column, most: float) -> Column:
    return x.isNull() | (x <= 0) | (x > most)


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, "^_+|_+$", "")


def standard_name(s: Column, tile: str = "") -> Column:
    """The column name of a layer file: no product, tile or legacy prefix, dates as years, the year or pair of years last.

    Depths are bathy_<year>_filled, layers derived from them lose their bathy_ prefix, and layers of the national product
    get the prefix bt.
    """
    national = F.lower(s).contains("bluetopo") | s.startswith("bt.")
    c = F.regexp_replace(F.regexp_replace(s, r"(?i)^bluetopo_?", ""), r"^bt\.", "")
    c = F.regexp_replace(F.when(national, c).otherwise(s), r"(?i)^combined\d*_", "")
    if tile:
        for part in (f"_{tile}", f"{tile}_", tile):
            c = F.replace(c, F.lit(part), F.lit(""))
    c = _stripped(F.regexp_replace(c, r"(?<!\d)((?:19|20)\d{2})\d{4}(?!\d)", "$1"))
    pair, year = F.regexp_extract(c, r"(\d{4}_\d{4})", 1), F.regexp_extract(c, r"(?<!\d)((?:19|20)\d{2})(?!\d)", 1)
    base = lambda found: F.regexp_replace(_stripped(F.replace(c, found, F.lit(""))), "__+", "_")
    last = lambda b, found: F.when(b == "", found).otherwise(F.concat(b, F.lit("_"), found))
    of_year, lower = base(year), F.lower(base(year))
    single = F.when(lower.isin("bathy", "bathy_filled"), F.concat(F.lit("bathy_"), year, F.lit("_filled"))).when(
        lower.startswith("bathy_"), F.concat(_stripped(F.substr(of_year, F.lit(7))), F.lit("_"), year)
    )
    name = F.when(pair != "", last(base(pair), pair)).when(year != "", F.coalesce(single, last(of_year, year))).otherwise(c)
    return F.when(F.lower(s).contains("survey_end_date"), "survey_end_date").otherwise(F.concat(F.when(national, "bt.").otherwise(""), name))


#: Words of a status that cast doubt on a position, and what the position codes say.
DOUBTFUL = "approx|doubt|reported|unconfirmed|existence"
POSITION_LABELS = {
    1: "surveyed", 2: "unsurveyed", 3: "inadequately surveyed", 4: "approximate", 5: "position doubtful", 6: "unreliable",
    7: "reported, not surveyed", 8: "reported, not confirmed", 9: "estimated", 10: "precisely known", 11: "calculated",
}


def position_code(s: Column) -> Column:
    """The first number of a text; null if there is none."""
    return F.regexp_extract(s, r"(\d+)", 1).try_cast("int")


def position_label(code: Column) -> Column:
    return F.get(F.array(F.lit(None).cast("string"), *map(F.lit, POSITION_LABELS.values())), code)


def quality_weight(code: Column, status: Column) -> Column:
    """Weight of a hazard by its position code: 3 for 2 to 9 and for doubtful words, 1 for none, 1, 10 and 11, else 0."""
    doubtful = F.coalesce(F.lower(status).rlike(DOUBTFUL), F.lit(False))
    return F.when(doubtful | F.coalesce(code.between(2, 9), F.lit(False)), 3).when(code.isNull() | code.isin(1, 10, 11), 1).otherwise(0)


def in_base(number: Column, digits: str, width: int) -> Column:
    """A whole number, at least 0, written with the digits given, the first of them as leading zeros up to width."""
    powers = [1]
    while powers[0] * len(digits) < 2**63:
        powers.insert(0, powers[0] * len(digits))
    n = number.cast("long")
    digit = lambda p: F.substring(F.lit(digits), (F.call_function("div", n, F.lit(p)) % len(digits) + 1).cast("int"), F.lit(1))
    return F.regexp_replace(F.concat(*map(digit, powers)), f"^{re.escape(digits[0])}{{0,{len(powers) - width}}}", "")


def dates_in(s: Column) -> Column:
    """All year-months of a text, or where it has none all years, distinct and sorted."""
    months, years = (F.array_sort(F.array_distinct(F.regexp_extract_all(s, F.lit(p), F.lit(0)))) for p in (r"(?:18|19|20)\d{2}-(?:0[1-9]|1[0-2])", r"(?:18|19|20)\d{2}"))
    return F.when(F.size(months) > 0, months).otherwise(years)
