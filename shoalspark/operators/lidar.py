"""Which lidar surveys are used: names of files, settings, approved providers, metadata and units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOOT = 0.3048006096


def name_parts(name: Column) -> dict[str, Column]:
    """year, id and dataset of a file <...>_<year>_<...>_<id>_resampled.tif; year and id are null where they are lacking."""
    found = lambda p: F.nullif(F.regexp_extract(name, p, 1), F.lit(""))
    year, ident = found(r"_((?:18|19|20)\d{2})[_.]"), found(r"(?i)_(\d+)_resampled\.tif$")
    stem = F.regexp_replace(name, r"(?i)_resampled\.tif$", "")
    # The id goes first: its own digits may begin like the year.
    tail = F.concat(F.lit("_"), ident)
    plain = F.when(stem.endswith(tail), F.substr(stem, F.lit(1), F.length(stem) - F.length(tail))).otherwise(stem)
    plain = F.coalesce(F.replace(plain, F.concat(F.lit("_"), year), F.lit("")), plain)
    corps = F.upper(stem).contains("USACE") & F.upper(stem).contains("NCMP")
    return {"year": year, "id": ident, "dataset": F.when(corps, "USACE").otherwise(F.substring_index(plain, "_", -1))}


def _says(setting: object, words: tuple[str, ...]) -> bool:
    return str(setting).strip().lower() in words


def chosen(files: DataFrame, mosaics: DataFrame, settings: dict[str, dict], name: str = "name") -> DataFrame:
    """name, year, id, dataset, manual and used of the resampled files that belong to a mosaic (column name, <stem>.vrt).

    Surveys of the national archive are left out, as are files of other names. settings maps a part of a name to what is
    to be done with files that have it: use (false: not used) and manual; files that no part meets are used.
    """
    n = F.col(name)
    mine = files.where(F.lower(n).endswith("_resampled.tif") & ~F.upper(n).contains("NCEI")).withColumn("mosaic", F.replace(n, F.lit("_resampled.tif"), F.lit(".vrt")))
    mine = mine.join(mosaics.select(F.col(name).alias("mosaic")), "mosaic", "left_semi")
    any_of = lambda key, words: F.array_contains(F.array(F.lit(False), *[n.contains(k) for k, v in settings.items() if _says((v or {}).get(key), words)]), True)
    flags = {"manual": any_of("manual", ("true", "yes", "1")), "used": ~any_of("use", ("false", "no", "0"))}
    made = mine.select(name, *[c.alias(k) for k, c in (name_parts(n) | flags).items()])
    return made.withColumn("year", F.coalesce("year", F.lit("No Year Found")))


def approved(files: DataFrame, providers: DataFrame, skip: int, path: str = "path") -> DataFrame:
    """The files of a region (region, path) whose provider is approved there (region, provider), in either case.

    The provider is what follows the first skip parts of the file's name.
    """
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    mine = files.withColumn("provider_key", F.lower(F.array_join(F.slice(parts, F.lit(skip + 1), F.greatest(F.size(parts) - skip, F.lit(0))), "_")))
    return mine.join(providers.select("region", F.lower("provider").alias("provider_key")), ["region", "provider_key"], "left_semi").select(*files.columns)


def folder_years(folders: DataFrame) -> DataFrame:
    """folder, year and date from folders (folder, metadata): the first four digits of a name, else 0, and the distinct dates of the text."""
    year = F.coalesce(F.regexp_extract("folder", r"(\d{4})", 1).try_cast("int"), F.lit(0))
    dates = F.array_sort(F.array_distinct(F.regexp_extract_all("metadata", F.lit(r"\b\d{4}(?:-\d{2}(?:-\d{2})?)?\b"), F.lit(0))))
    date = F.when(F.col("metadata").isNull(), "metadata.txt not found").when(F.size(dates) == 0, "Date not found").otherwise(F.array_join(dates, ", "))
    return folders.select("folder", year.alias("year"), date.alias("date"))


def time_frames(xml: Column, otherwise: Column) -> Column:
    """The time-frames of a metadata document as structs of description, start and end; the description is otherwise where it has none."""
    # Fields without attributes, entities or fields of their own need no parser; it takes most of the time.
    flat = r"^<time-frame>\s*(?:<([\w-]+)>[^<>&\r]*</\1>\s*)*</time-frame>$"
    plain = lambda frame, field: F.regexp_extract(frame, f"<{field}>([^<>&]*)</{field}>", 1)
    of = lambda frame, field: F.nullif(F.when(frame.rlike(flat), plain(frame, field)).otherwise(F.xpath_string(frame, F.lit(f"/time-frame/{field}"))), F.lit(""))
    frames = F.regexp_extract_all(xml, F.lit(r"(?s)<time-frame(?=[\s>]).*?</time-frame>"), F.lit(0))
    return F.transform(frames, lambda f: F.struct(F.coalesce(of(f, "description"), otherwise).alias("description"), of(f, "start-date-time").alias("start"), of(f, "end-date-time").alias("end")))


def seabed(value: Column, metric: Column) -> Column:
    """Depths below 0 in metres; what is not below 0 is land and becomes null, values in feet are converted."""
    return F.when(value < 0, F.when(metric, value).otherwise(value * FOOT))


def mask_value(tile: Column) -> Column:
    """0 for tiles of the finest nearshore levels (BH4 and BH5 in the name, in either case), else 1."""
    return F.when(F.coalesce(tile.rlike("(?i)BH4|BH5"), F.lit(False)), 0).otherwise(1)


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, n: how often each value occurs in each of the columns, nulls too."""
    tall = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return tall.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
