"""Predicates: which rows count, and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import NO_TIME_STATUSES, STROKES, blank_status


def valid_swim(c: str = "") -> Column:
    """FL1: a timed, dated individual swim with a score, in a known pool and stroke."""
    f = lambda n: F.col(c + n)
    return (
        (f("time_seconds") > 0)
        & blank_status(f("status")).isNull()
        & f("points_fina").between(1, 1500)
        & ~f("is_relay")
        & f("result_date").isNotNull()
        & f("pool_length").isin(25, 50)
        & f("stroke").isin(*STROKES)
    )


def valid_race_band(c: str = "") -> Column:
    """FL2: the same without a score, which each measure filters for itself, but with a birth year."""
    f = lambda n: F.col(c + n)
    timed = (f("time_seconds") > 0) & blank_status(f("status")).isNull() & ~f("is_relay")
    return timed & f("result_date").isNotNull() & f("pool_length").isin(25, 50) & f("stroke").isin(*STROKES) & f("birth_year").isNotNull()


def valid_fina(points: Column) -> Column:
    return points.between(1, 1500)


def valid_rudolph(points: Column) -> Column:
    return points.between(1, 20)


def populations(rows: DataFrame, nation: str, *, age: str = "age_group", country: str = "country_code", least: int = 8, most: int = 19) -> DataFrame:
    """FL3: each row once for each of the four populations it belongs to, as columns country and age_mode.

    A row is exploded over at most four literals; no join, no shuffle.
    """
    homes = F.array(F.lit("ALL"), F.when(F.col(country) == nation, nation))
    modes = F.array(F.lit("OPEN"), F.when(F.col(age).between(least, most), "AGE"))
    wide = rows.withColumn("country", F.explode(F.array_compact(homes)))
    return wide.withColumn("age_mode", F.explode(F.array_compact(modes)))


def enough_career(rows: DataFrame, bests: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """FL4: rows whose career best reaches the threshold."""
    return rows.join(bests.where(F.col("career_best") >= threshold).select(*keys), keys, "left_semi")


def of_ages(age: Column, ages: list[int]) -> Column:
    """FL5"""
    return age.isin(*ages)


def of_club(name_key: Column, code: Column, nation: Column, wanted_names: list[str], wanted_code: str, wanted_nation: str) -> Column:
    """FL6: by normalised name, or by code and nation."""
    return name_key.isin(*wanted_names) | ((code == wanted_code) & (nation == wanted_nation))


def usable(first: Column, last: Column, birth_year: Column, event: Column, seconds: Column) -> Column:
    """FL7"""
    return F.coalesce(first, last).isNotNull() & birth_year.isNotNull() & event.isNotNull() & seconds.isNotNull()


def reject_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """FL7: (keys, reason, n): rows that cannot be used, each counted under the first thing that it lacks: name, birth_year, event or time."""
    lacks = F.when(F.coalesce("first_name", "last_name").isNull(), "no_name").when(F.col("birth_year").isNull(), "no_birth_year").when(F.col("event_id").isNull(), "unknown_event").when(F.col("time_seconds").isNull(), "no_time")
    return rows.select(*keys, lacks.alias("reason")).where("reason IS NOT NULL").groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n"))


def timed_relay(seconds: Column) -> Column:
    """FL8"""
    return seconds > 0


def acceptable_status(status: Column, seconds: Column, no_time_allowed: Column | None = None) -> Column:
    """FL9: any time above zero, with or without a status; zero only with a no-time status, and where the source may say so."""
    s = F.upper(F.trim(blank_status(status)))
    zero = (seconds == 0) & s.isin(*NO_TIME_STATUSES)
    if no_time_allowed is not None:
        zero = zero & no_time_allowed
    return F.coalesce((seconds > 0) | zero, F.lit(False))


def rankable(status: Column, seconds: Column) -> Column:
    """FL10"""
    return blank_status(status).isNull() & (seconds > 0)


def overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    """FL11: [start, end] meets [low, high)."""
    return (start < high) & (end >= low)


def on_selected_days(day: Column, days: list[str]) -> Column:
    """FL12"""
    return day.isin(*[F.lit(d).cast("date") for d in days])


def not_loaded(incoming: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """FL13: what the ledger has no row for."""
    return incoming.join(ledger.select(*keys).distinct(), keys, "left_anti")


def plausible(day: Column, today: Column, birth_year: Column) -> Column:
    """FL14: not in the future, of somebody born after 1800 and not after that year."""
    return (day <= today) & (birth_year > 1800) & (birth_year <= F.year(day))


def comparable_scope(scope: Column) -> Column:
    """FL15"""
    return scope.isin("national", "age")


def individual_event(stroke: Column, legs: Column, event_gender: Column, gender: Column, status: Column) -> Column:
    """FL16"""
    return stroke.isin(*STROKES) & (F.coalesce(legs, F.lit(1)) == 1) & (event_gender == gender) & blank_status(status).isNull()


def needs_review(scope: Column) -> Column:
    """FL17"""
    return scope == "unmapped"
