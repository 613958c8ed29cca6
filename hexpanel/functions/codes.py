"""Code maps and identifier parsing as column expressions."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACEHOLDER = "Brak"
PARCEL = r"^(\d{6}_\d)\.(\d{4})\.(.+)$"
#: Grade of a soil class and its suffixes; simplified land use by first letter; zone number of a plane
#: coordinate system -> EPSG code; the region whose units are also written without an underscore, and the kinds of unit.
GRADES = {"I": 6.0, "II": 5.0, "III": 4.0, "IV": 3.0, "V": 2.0, "VI": 1.0}
SOIL_SUFFIXES = ("A", "B", "Z")
LAND_USE = {"B": "B", "K": "K", "L": "L", "P": "Ps", "R": "R", "T": "T", "W": "W"}
ZONES = {5: 2176, 6: 2177, 7: 2178, 8: 2179}
REGION, KINDS = "28", "12345"


def _table(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def group(c: Column, pattern: str, n: int) -> Column:
    """A group of a match; null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, n), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*map(blank_to_null, columns))


def coalesce_groups(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """target <- first filled source of each group; used sources go, groups without any source are left alone."""
    for target, sources in groups.items():
        there = [c for c in sources if c in df.columns]
        if there:
            df = df.withColumn("_first", first_filled(*(F.col(c).cast("string") for c in there))).drop(*(c for c in there if c != target)).drop(target).withColumnRenamed("_first", target)
    return df


def land_use(c: Column) -> Column:
    """Simplified land-use code: what stands before a dash, by the first letter where it tells, else in upper case; roads
    (dr) stay."""
    head = F.trim(F.split_part(F.trim(c), F.lit("-"), F.lit(1)))
    return F.when(head == "dr", head).otherwise(F.coalesce(F.try_element_at(_table(LAND_USE), F.substring(F.upper(head), 1, 1)), F.upper(head)))


def soil_score(c: Column) -> Column:
    """6 for the best class to 1 for the worst, half a point less for suffix B; null for anything else."""
    code = F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit(""))
    suffix = F.when(F.right(code, F.lit(1)).isin(*SOIL_SUFFIXES), F.right(code, F.lit(1))).otherwise("")
    grade = F.left(code, F.length(code) - F.length(suffix))
    return F.try_element_at(_table(GRADES), grade) - F.when(suffix == "B", 0.5).otherwise(0.0)


def clean_label(c: Column, placeholder: str = PLACEHOLDER) -> Column:
    return F.coalesce(F.trim(F.replace(c, F.lit(","), F.lit("_"))), F.lit(placeholder))


#: A cleaned zoning label: ordinal of the area, class and number, the symbol, its variant.
LABEL = r"^(?:[IVX]+/)?(?:[A-Z]{0,2}\d+[-_.]?(?=[A-Z]))?(.*?)\d*$"


def zoning_symbol(c: Column) -> Column:
    """The symbol of a zoning label, in upper case, without remarks between slashes or brackets and without edge marks."""
    plain = F.regexp_replace(F.regexp_replace(F.translate(F.upper(c), ",", "_"), "/[^/]*/", ""), r"\([^)]*\)|\s+", "")
    return F.btrim(F.regexp_extract(plain, LABEL, 1), F.lit("-_. "))


def plan_date_rule(label: Column, plan_date: Column, year: Column, placeholder: str = PLACEHOLDER) -> Column:
    """A plan that is younger than the row doesn't apply to it."""
    plan = F.year(plan_date.cast("string").try_cast("timestamp"))
    return F.when(plan > year, F.lit(placeholder)).otherwise(label)


def event_year(c: Column) -> Column:
    """Year of a date in text; null where it is none."""
    return F.year(c.try_cast("date"))


def unit_code(c: Column) -> Column:
    """NNNNNN_N of the first unit that a text names: six digits, an underscore and one digit, or within REGION seven
    digits, of which the last is one of KINDS. Numbers of other lengths name no unit."""
    runs = F.regexp_extract_all(c, F.lit(r"\d+|\D+"), F.lit(0))  # numbers and what is between them

    def read(run: Column, i: Column) -> Column:
        kind = F.get(runs, i + 2)
        split = run.rlike(r"^\d{6}$") & F.get(runs, i + 1).eqNullSafe(F.lit("_")) & (F.length(kind) == 1)
        joined = run.rlike(r"^\d{7}$") & run.startswith(REGION) & F.right(run, F.lit(1)).isin(*KINDS)
        return F.when(split, F.concat_ws("_", run, kind)).when(joined, F.concat_ws("_", F.left(run, F.lit(6)), F.right(run, F.lit(1))))

    return F.get(F.filter(F.transform(runs, read), lambda x: x.isNotNull()), 0)


def unit_of_text(text: str) -> str | None:
    """The same of one text, for names that are at hand on the driver."""
    runs = ["".join(g) for _, g in groupby(text, lambda ch: ch in "0123456789")] + ["", ""]
    for run, mark, kind in zip(runs, runs[1:], runs[2:], strict=False):
        if len(run) == 6 and run.isdecimal() and mark == "_" and len(kind) == 1 and kind.isdecimal():
            return f"{run}_{kind}"
        if len(run) == 7 and run.isdecimal() and run.startswith(REGION) and run[-1] in KINDS:
            return f"{run[:-1]}_{run[-1]}"
    return None


def parse_parcel_id(df: DataFrame, column: str = "iddzialki", pattern: str = PARCEL) -> DataFrame:
    """Adds jednostka, obreb, nr_dzialki where df lacks them; null where the id has another form."""
    names = [n for n in ("jednostka", "obreb", "nr_dzialki") if n not in df.columns]
    at = {"jednostka": 1, "obreb": 2, "nr_dzialki": 3}
    return df.withColumns({n: group(F.col(column), pattern, at[n]) for n in names})


def cast_year(c: Column, fallback: int | None = None) -> Column:
    return F.coalesce(c.try_cast("double").try_cast("bigint"), F.lit(fallback).cast("bigint"))


def zone_of(c: Column) -> Column:
    """EPSG code of the zone that a coordinate system's name ends with."""
    zone = group(F.upper(c), r"PAS[_ ]?(\d)", 1).cast("int")
    return F.element_at(_table(ZONES), zone)
