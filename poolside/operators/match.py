"""Matching rows to stored rows: with tolerance, with fallback, null-safe, unique only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import pick_first


def star(facts: DataFrame, dimensions: list[tuple[DataFrame, str]], how: str = "inner") -> DataFrame:
    """Facts joined to dimensions by key; Spark broadcasts those below its size threshold."""
    for table, key in dimensions:
        facts = facts.join(table, key, how)
    return facts


def in_bands(rows: DataFrame, value: str, tolerance: float, *, around: bool = False) -> DataFrame:
    """rows with a _band of their value, twice the tolerance wide; with ``around``, once in each band where a close value can be.

    That is the value's own band and the one beside its nearer end; near the middle, where rounding
    could mistake the end, both neighbours.

    An equality on _band lets only rows near each other meet, so a key of any size makes
    pairs in proportion to what matches, not to its square.
    """
    at = F.col(value).cast("double") / (2 * tolerance)
    band = F.floor(at)
    near = F.array_compact(F.array(band, F.when(at - band < 0.51, band - 1), F.when(at - band > 0.49, band + 1)))
    return rows.withColumn("_band", F.explode(near) if around else band)


def theta_match(incoming: DataFrame, stored: DataFrame, keys: list[str], *, tolerance: float = 0.0001) -> DataFrame:
    """(row_id, id): the stored row with the same keys and heat, or both without heat, of one day and time; ambiguous ones are dropped.

    Stored rows alike in what is compared are counted first, so repeated ones are one row of the join.
    """
    alike = lambda rows, by: rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("id"))
    with_heat = alike(stored.where("heat IS NOT NULL"), [*keys, "heat"])
    without = alike(stored.where("heat IS NULL"), [*keys, "result_date", "time_seconds"]).withColumnRenamed("time_seconds", "_time")
    first = incoming.join(with_heat, [*keys, "heat"]).select("row_id", "id", "_n")
    open_ = in_bands(incoming.where("heat IS NULL"), "time_seconds", tolerance, around=True)
    close = open_.join(in_bands(without, "_time", tolerance), [*keys, "result_date", "_band"]).where(F.abs(F.col("time_seconds") - F.col("_time")) < tolerance)
    pairs = first.unionByName(close.select("row_id", "id", "_n")).withColumn("id", F.when(F.col("_n") == 1, F.col("id")))  # ids of others are not sent
    return pairs.groupBy("row_id").agg(F.sum("_n").alias("_all"), F.min("id").alias("id")).where("_all = 1").select("row_id", "id")


def nearest_match(incoming: DataFrame, stored: DataFrame, keys: list[str], *, value: str = "time_seconds", tolerance: float = 0.01, prefer: list[Column] | None = None) -> DataFrame:
    """One candidate within the tolerance: by the preferences, then the nearest, then the largest id.

    Without preferences, of stored rows with equal keys and value only the one with the largest id takes part.
    """
    if not prefer:
        stored = stored.groupBy(*keys, value).agg(F.max("id").alias("id"))
    s = in_bands(stored.withColumnRenamed(value, "_v"), "_v", tolerance)
    near = in_bands(incoming, value, tolerance, around=True)
    pairs = near.join(s, [*keys, "_band"]).withColumn("difference", F.abs(F.col(value) - F.col("_v"))).where(F.col("difference") < tolerance)
    order = [p.desc_nulls_last() for p in prefer or []]
    return pick_first(pairs, ["row_id"], [*order, F.asc("difference"), F.desc("id")]).drop("_v", "_band")


def not_stored(incoming: DataFrame, stored: DataFrame, keys: list[str], *, value: str = "time_seconds", tolerance: float = 0.01) -> DataFrame:
    """Incoming rows with no stored row of the same keys and about the same value.

    Each stored value stands once in each of its bands, so the anti join stays an equality with a condition.
    """
    i = in_bands(incoming, value, tolerance).alias("i")
    s = in_bands(stored.select(*keys, value).distinct(), value, tolerance, around=True).alias("s")
    same = (F.abs(F.col(f"i.{value}") - F.col(f"s.{value}")) < tolerance) & (F.col("i._band") == F.col("s._band"))
    for k in keys:
        same = same & (F.col(f"i.{k}") == F.col(f"s.{k}"))
    return i.join(s, same, "left_anti").drop("_band")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joined on keys where nulls are equal; the right side's keys are dropped."""
    r = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(r[f"_{k}"])
    out = left.join(r, on, how)
    return out.drop(*(f"_{k}" for k in keys))


def either_key(rows: DataFrame, lookup: DataFrame, first: str, others: list[str], value: str) -> DataFrame:
    """J14, UPS2: fill a null value by one key, or else by other keys compared null-safe.

    Two equality joins instead of one with OR, which Spark could only run as a nested loop.
    """
    by_first = lookup.where(F.col(first).isNotNull()).groupBy(first).agg(F.min(value).alias("_v1"))
    by_others = lookup.groupBy(*others).agg(F.min(value).alias("_v2"))
    out = rows.join(by_first, first, "left")
    out = null_safe(out, by_others, others, "left")
    return out.withColumn(value, F.coalesce(value, "_v1", "_v2")).drop("_v1", "_v2")


def with_fallback(rows: DataFrame, specific: DataFrame, specific_keys: list[str], default: DataFrame, default_keys: list[str], value: str) -> DataFrame:
    """The specific value, else the default one, else null."""
    s = specific.select(*specific_keys, F.col(value).alias("_s"))
    d = default.select(*default_keys, F.col(value).alias("_d"))
    return rows.join(s, specific_keys, "left").join(d, default_keys, "left").withColumn(value, F.coalesce("_s", "_d")).drop("_s", "_d")


def schedule_match(lines: DataFrame, schedule: DataFrame, keys: list[str]) -> DataFrame:
    """The one scheduled event with the line's keys and its date, or no date on the line.

    Events are counted by keys and date first, so lines of a crowded key make no pairs.
    """
    counted = lambda by, day: schedule.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("event_id").alias("event_id"), *day)
    dated = lines.where("date IS NOT NULL").join(counted([*keys, "date"], []), [*keys, "date"])
    others = lines.where("date IS NULL").drop("date").join(counted(keys, [F.min("date").alias("date")]), keys)
    pairs = dated.unionByName(others).withColumn("_all", F.sum("_n").over(Window.partitionBy("row_id")))
    return pairs.where("_all = 1").drop("_n", "_all")


def with_children(parents: DataFrame, children: DataFrame, key: str, order: list[str], values: list[str], name: str = "splits") -> DataFrame:
    """Parents with their children as an array in order; null without any."""
    kids = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *[v for v in values if v not in order]))).alias(name))
    picked = kids.select(key, F.transform(name, lambda x: F.struct(*(x[v].alias(v) for v in values))).alias(name))
    return parents.join(picked, key, "left")


def semi(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """J15"""
    return rows.join(keys, on, "left_semi")


def orphans(children: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(relation, violations) for each (name, child, foreign key, parent, key); null foreign keys are no violation."""
    out = None
    for name, child, fk, parent, key in children:
        keys = parent.select(F.col(key).alias(fk)).distinct()
        bad = child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti").agg(F.count(F.lit(1)).alias("violations"))
        row = bad.select(F.lit(name).alias("relation"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def outcomes(registry: DataFrame, found: DataFrame, keys: list[str], default: str = "not_checked") -> DataFrame:
    """Every registered key with its outcome."""
    return registry.join(found, keys, "left").withColumn("outcome", F.coalesce("outcome", F.lit(default)))


def grid(*dimensions: DataFrame) -> DataFrame:
    """Every combination of small dimension tables."""
    out = dimensions[0]
    for d in dimensions[1:]:
        out = out.crossJoin(d)
    return out


def difference(expected: DataFrame, available: DataFrame, keys: list[str]) -> DataFrame:
    """U2"""
    return expected.select(*keys).distinct().join(available.select(*keys), keys, "left_anti")


def contradictions(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on both sides, which should be none."""
    return a.select(*keys).intersect(b.select(*keys))


def known_ids(*sources: DataFrame) -> DataFrame:
    """Distinct ids of several one-column sources."""
    out = sources[0]
    for s in sources[1:]:
        out = out.union(s)
    return out.distinct()
