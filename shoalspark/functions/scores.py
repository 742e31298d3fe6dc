"""Survey scores, bins and decay as column expressions. Missing values are null throughout; NaN is made null first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DECAY, PRESENT_YEAR = 0.022, 2024


def clean(x: Column, nodata: float = -9999.0) -> Column:
    """NaN and the nodata value become null."""
    return F.when(~F.isnan(x) & (x != nodata), x)


def steps(x: Column, bounds: list[tuple[float, float]], last: float, closed: str = "right") -> Column:
    """The value of the first bound that x does not exceed (closed right) or lies below (closed left), else last."""
    below = (lambda b: x <= b) if closed == "right" else (lambda b: x < b)
    made = reduce(lambda acc, bv: acc.when(below(bv[0]), bv[1]), bounds, F.when(x.isNull(), None))
    return made.otherwise(last)


def catzoc(score: Column) -> Column:
    return F.when(score > 80, 1).when(score > 60, 2).when(score > 40, 3).when(score > 20, 4).when(score.isNotNull(), 5)


def feature(detected: Column, least_depth: Column, scaled: Column) -> Column:
    """Features and their least depths detected: 110 on the increased scale, else 100; otherwise 60."""
    return F.when(detected & least_depth, F.when(scaled, 110).otherwise(100)).otherwise(60)


def coverage(complete: Column, scaled: Column) -> Column:
    """Complete coverage: 110 on the increased scale, else 100; otherwise 60."""
    return F.when(complete, F.when(scaled, 110).otherwise(100)).otherwise(60)


def horizontal(fixed: Column, variable: Column, scaled: Column) -> Column:
    either = lambda a, b: F.when(scaled, b).otherwise(a)
    return F.when((fixed <= 5) & (variable <= 0.05), either(100, 110)).when(fixed <= 20, either(80, 85)).when(fixed <= 50, either(60, 65)).when(fixed <= 500, either(40, 45)).otherwise(either(20, 25))


def vertical(fixed: Column, variable: Column, scaled: Column) -> Column:
    """The third class is 40 or 55: the scale has that step."""
    either = lambda a, b: F.when(scaled, b).otherwise(a)
    return F.when((fixed <= 0.5) & (variable <= 0.01), either(100, 110)).when((fixed <= 1) & (variable <= 0.02), either(80, 85)).when((fixed <= 2) & (variable <= 0.05), either(40, 55)).otherwise(either(20, 25))


def supersession(*parts: Column, interpolated: Column) -> Column:
    """The least of the part scores, a hundredth less where the depth is interpolated; null if a part is missing."""
    whole = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(whole, F.least(*parts) - F.when(interpolated, 0.01).otherwise(0.0))


def decay(score: Column, days: Column, rate: float = DECAY) -> Column:
    """Exponential decay by age; null below 1, where a score has no meaning any more."""
    left = score * F.exp(-rate * days / 365)
    return F.when(left >= 1, left)


def clean_year(y: Column, present: int = PRESENT_YEAR) -> Column:
    """Years packed as YYYY, YYYYMM or YYYYMMDD numbers; 1 and less, and years outside 1800 to the present, are null."""
    r = F.rint(y)
    year = F.when(r <= 1, None).when(r >= 1e7, F.floor(r / 1e4)).when(r >= 1e4, F.floor(r / 100)).otherwise(r)
    return F.when((year >= 1800) & (year <= present), year.cast("int"))


def bin_storms(x: Column) -> Column:
    return steps(x, [(0, 1), (4, 2), (10, 3), (20, 4)], 5)


def bin_tide(x: Column) -> Column:
    return steps(x, [(0.1, 1), (0.2, 2), (0.5, 3), (1.0, 4)], 5, "left")


def bin_debris(x: Column) -> Column:
    return steps(x, [(0, 1), (1, 2), (5, 3), (10, 4)], 5)


def bin_clearance(x: Column, shallow: float, middle: float) -> Column:
    return steps(x, [(1, 100), (shallow, 80), (middle, 30)], 10)


def bin_depth(x: Column, shallow: float, middle: float) -> Column:
    return F.when(x < 2, 100).otherwise(steps(x, [(shallow, 80), (middle, 30)], 10))


def desired(clearance: Column, depth: Column, slope: Column) -> Column:
    """Desired score by under-keel clearance, and by depth where that is missing or negative, with limits by slope; null slope: null."""
    above = F.when(clearance >= 0, clearance)
    by = lambda s, m: F.coalesce(bin_clearance(above, s, m), bin_depth(depth, s, m))
    return F.when(slope < 0.5, by(20, 50)).when(slope < 1, by(30, 75)).when(slope >= 1, by(40, 100))


def coefficient(*bins: Column, rate: float = DECAY) -> Column:
    """Decay coefficient: the bins' sum above its least, null if any is."""
    return (reduce(lambda a, b: a + b, bins) - len(bins)) * rate / 3


def present(initial: Column, coeff: Column, age: Column) -> Column:
    """Present score within 0 to 110; ages above 200 count as 200, missing and negative ones give null."""
    p = initial * F.exp(-coeff * F.when(age > 200, 200).when(age >= 0, age))
    return F.when(p.isNotNull(), F.greatest(F.least(p, F.lit(110.0)), F.lit(0.0)))


def likelihood(*x: Column) -> Column:
    """log10 of the sum of tens to the powers."""
    return F.log10(reduce(lambda a, b: a + b, [F.pow(F.lit(10.0), c) for c in x]))


def grain_mm(phi: Column) -> Column:
    return F.pow(F.lit(2.0), -phi)


def sediment(name: Column, grain: Column) -> Column:
    """The class by grain size (mm), the name where there is no positive size."""
    return F.when((grain > 0) & (grain < 0.0039), "Clay").when((grain >= 0.0039) & (grain < 0.0625), "Mud").when((grain >= 0.0625) & (grain < 2), "Sand").when(grain >= 2, "Gravel").otherwise(name)


def sediment_code(name: Column) -> Column:
    return F.when(name == "Gravel", 1).when(name == "Sand", 2).when(name == "Mud", 3).when(name == "Clay", 4)


def close_to(a: Column, b: Column, absolute: float = 1e-5, relative: float = 1e-5) -> Column:
    """Equal within tolerance, or both null."""
    return F.coalesce(F.abs(a - b) <= absolute + relative * F.abs(b), F.lit(False)) | (a.isNull() & b.isNull())


def radii(wind: Column, quadrants: list[Column], at: int, default: float) -> list[Column]:
    """Wind radii with the default where the wind reaches at and no quadrant has one above 0 (null and -999 are none)."""
    known = [F.coalesce(q.cast("double"), F.lit(-999.0)) for q in quadrants]
    missing = reduce(lambda a, b: a & b, [q <= 0 for q in known])
    return [F.when((wind >= at) & missing, default).otherwise(F.when(q != -999, q)) for q in known]


def outer_radius(r34: Column) -> Column:
    """The radius of the outermost winds: half as much again as that of 34 knots, 0 where there is none."""
    return F.greatest(F.coalesce(r34, F.lit(0.0)), F.lit(0.0)) * 1.5


def priority(place: Column, levels: int, zone_class: Column, year: Column) -> Column:
    """Survey priority, larger wins: the place of its type among levels first, then the class, then the year."""
    return F.pow(F.lit(10.0), 4 + levels - place) * (6 - zone_class) + year


def change_bins(depth: Column, year: Column, soft: Column, tide: Column, storms: Column, debris: Column, present_year: int = PRESENT_YEAR, rate: float = DECAY, terms: int = 3) -> dict[str, Column]:
    """The decay coefficient of a cell, its three change bins and its tidal exposure, by name.

    depth is the bathymetry of either sign, year the cleaned survey year. Cells without either are outside the domain and
    have none of them. Storms count on soft ground (above 0) down to 40 m, tide times age on soft ground down to 20 m, and
    debris everywhere, where missing debris is none. Bins that do not apply are null and leave the sum; the divisor stays.
    """
    inside = depth.isNotNull() & year.isNotNull()
    ground, deep = inside & (soft > 0), F.abs(depth)
    age = F.when(year <= present_year, present_year - year)
    storm_bin = F.when(ground & (deep <= 40), bin_storms(storms))
    exposure = F.when(ground & (deep <= 20), tide * age)
    tide_bin, debris_bin = bin_tide(exposure), F.when(inside, bin_debris(F.coalesce(debris, F.lit(0))))
    over = reduce(lambda a, b: a + b, [F.coalesce(b - 1, F.lit(0)) for b in (storm_bin, tide_bin, debris_bin)])
    return {"coefficient": F.when(inside, over * rate / terms), "storm_bin": storm_bin, "tide_bin": tide_bin, "debris_bin": debris_bin, "exposure": exposure}


def survey_scores(initial: Column, clearance: Column, depth: Column, slope: Column, coeff: Column, year: Column, present_year: int = PRESENT_YEAR) -> dict[str, Column]:
    """Desired score, present score and the gap between them of a cell, by name; missing parts give null."""
    want = desired(clearance, F.abs(depth), slope)
    have = present(initial, coeff, present_year - year)
    return {"desired": want, "present": have, "gap": want - have}


def clearance(depth: Column, draft: Column) -> Column:
    """Under-keel clearance: depth of either sign less draft, null where either is missing."""
    return F.abs(depth) - draft


def domain_coefficient(storms: Column, exposure: Column, debris: Column, soft: Column, depth: Column, age: Column) -> Column:
    """Decay coefficient of a cell from its sources of change.

    Storms count on soft ground down to 40 m, tidal exposure (yearly, times age) on soft ground down to 20 m, debris
    everywhere and as 0 where it is missing. Cells without depth or age are outside the domain: null.
    """
    ground = F.coalesce(soft > 0, F.lit(False))
    s = F.when(ground & (depth <= 40), F.coalesce(bin_storms(storms), F.lit(1))).otherwise(1)
    t = F.when(ground & (depth <= 20), F.coalesce(bin_tide(exposure * age), F.lit(1))).otherwise(1)
    d = bin_debris(F.coalesce(debris, F.lit(0)))
    return F.when(depth.isNotNull() & age.isNotNull(), coefficient(s, t, d))
