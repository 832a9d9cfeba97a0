"""Season, meet and race summaries: the main workload.

Averages of the best three, percentile bands and percent ranks over populations.
Percentiles and ranks are taken of the rounded averages, as they are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import enough_career, populations, valid_fina, valid_rudolph
from ..functions.scalars import clamped_age

POINTS, RANK = "decimal(6,1)", "decimal(5,2)"
BANDS = (10, 20, 25, 40, 50, 60, 75, 80, 90, 95)


def top3(swims: DataFrame, keys: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Average and values of the best three swims of each group, and how many there are.

    Ties in points go to the faster swim. One shuffle serves the window and the
    grouping, and only three rows of a group carry values on.
    """
    best = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("points_fina"), F.asc_nulls_last("time_seconds"))
    ranked = swims.withColumn("rn", F.row_number().over(best))
    of = lambda k: F.max(F.when(F.col("rn") == k, F.col("points_fina")))
    return ranked.groupBy(*keys).agg(
        F.avg(F.when(F.col("rn") <= 3, F.col("points_fina"))).cast(POINTS).alias("avg_points"),
        of(1).alias("best1"), of(2).alias("best2"), of(3).alias("best3"),
        F.count(F.lit(1)).alias("race_count"), *(extra or []),
    )


def season_points(swims: DataFrame) -> DataFrame:
    """Event rows, and overall rows marked by distance 0 and stroke ALL, from one pass over the swims.

    The best three of a season are among the best three of its events, so event rows are
    taken twice, once under the marks, and grouped again; a group is as small as a swimmer's events.
    """
    base = ["season_end_year", "swimmer_id", "course"]
    event = top3(swims, [*base, "distance", "stroke"])
    kind = event.schema
    marks = F.array(F.struct("distance", "stroke"), F.struct(F.lit(0).cast(kind["distance"].dataType).alias("distance"), F.lit("ALL").alias("stroke")))
    both = event.select(*base, F.inline(marks), F.array_compact(F.array("best1", "best2", "best3")).alias("_best"), "race_count")
    best = F.slice(F.sort_array(F.flatten(F.collect_list("_best")), asc=False), 1, 3)
    grouped = both.groupBy(*base, "distance", "stroke").agg(best.alias("_best"), F.sum("race_count").alias("race_count"))
    total = F.aggregate("_best", F.lit(0).cast("double"), lambda a, x: a + x)
    at = lambda k: F.get("_best", F.lit(k - 1)).alias(f"best{k}")
    return grouped.select(*base, "distance", "stroke", F.when(F.size("_best") > 0, total / F.size("_best")).cast(POINTS).alias("avg_points"), at(1), at(2), at(3), "race_count")


def meet_points(swims: DataFrame, by_event: bool = False) -> DataFrame:
    """The same for each meet; a meet across two seasons is parted. first_date is the swimmer's first race there in the season and course, in whatever event."""
    meet = ["season_end_year", "swimmer_id", "meet_id", "course"]
    if not by_event:
        return top3(swims, meet, [F.min("result_date").alias("first_date")])
    dated = swims.withColumn("_first", F.min("result_date").over(Window.partitionBy(*meet)))
    return top3(dated, [*meet, "distance", "stroke"], [F.min("_first").alias("first_date")])


def career_best(points: DataFrame) -> DataFrame:
    """A5: the best single score of each swimmer over all rows."""
    return points.groupBy("swimmer_id").agg(F.max("best1").alias("career_best"))


def percentiles(value: Column, bands: tuple[int, ...] = BANDS, prefix: str = "p") -> list[Column]:
    """A3: exact, interpolated; the array is computed once for all bands."""
    values = F.percentile(value.cast("double"), F.array(*(F.lit(b / 100) for b in bands)))
    return [values[i].alias(f"{prefix}{b}") for i, b in enumerate(bands)]


def eligible(points: DataFrame, threshold: float) -> DataFrame:
    """FL4: rows of swimmers whose career best reaches the threshold."""
    return enough_career(points, career_best(points), ["swimmer_id"], threshold)


def season_bands(points: DataFrame, nation: str, threshold: float = 0) -> DataFrame:
    """A3, A7, FL4: bands of each population cell."""
    cell = ["season_end_year", "course", "age_cell", "distance", "stroke", "country", "age_mode"]
    return in_cells(eligible(points, threshold), nation).groupBy(*cell).agg(F.count(F.lit(1)).alias("population"), *percentiles(F.col("avg_points")))


def in_cells(points: DataFrame, nation: str) -> DataFrame:
    """Rows in each of their populations; open populations have one age cell, 0."""
    return populations(points, nation).withColumn("age_cell", F.when(F.col("age_mode") == "AGE", F.col("age_group")).otherwise(0))


def percentile_ranks(points: DataFrame, nation: str, key: list[str], threshold: float = 0) -> DataFrame:
    """W5, FL4: 100 * percent_rank in each population cell.

    A cell may hold every athlete of a season, but only so many distinct averages as its
    decimals have. So rows are counted by cell and value, counts are summed up in order
    of value, and the ranks are joined back; no window sees the rows of a cell.
    """
    cell = ["season_end_year", "course", "age_cell", "distance", "stroke", "country", "age_mode"]
    rows = in_cells(eligible(points, threshold), nation)
    counted = rows.groupBy(*cell, "avg_points").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*cell)
    below = F.sum("n").over(w.orderBy("avg_points").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(w)
    share = F.when(total > 1, 100 * (F.coalesce(below, F.lit(0)) / (total - 1))).otherwise(0.0)
    ranks = counted.select(*cell, "avg_points", share.cast(RANK).alias("percentile"))
    return rows.join(ranks, [*cell, "avg_points"]).select(*key, "country", "age_mode", "percentile")


def default_rank_copy(points: DataFrame, ranks: DataFrame, nation: str, key: list[str]) -> DataFrame:
    """The rank in the home population by age on each row; null where there is none."""
    home = ranks.where((F.col("country") == nation) & (F.col("age_mode") == "AGE")).select(*key, F.col("percentile").alias("default_percentile"))
    return points.join(home, key, "left")


def race_bands(swims: DataFrame, nation: str) -> DataFrame:
    """A4, J3, FN13: bands and maxima of both measures by race cell; swims as valid_race_band() keeps them.

    Ages are filtered as they are, and clamped afterwards. Both measures are aggregated in
    one pass; a filter inside the aggregate stands for the join of two aggregates.
    """
    cells = populations(swims, nation)
    cells = cells.withColumn("age_cell", F.when(F.col("age_mode") == "AGE", clamped_age(F.col("age_group"))).otherwise(0))
    fina = F.when(valid_fina(F.col("points_fina")), F.col("points_fina"))
    rudolph = F.when(valid_rudolph(F.col("points_rudolph")), F.col("points_rudolph"))
    out = cells.groupBy("distance", "stroke", "pool_length", "age_cell", "country", "age_mode").agg(
        F.count(fina).alias("fina_count"), F.max(fina).alias("fina_max"), *percentiles(fina, prefix="fina_p"),
        F.count(rudolph).alias("rudolph_count"), F.max(rudolph).alias("rudolph_max"), *percentiles(rudolph, prefix="rudolph_p"),
    )
    return out.where("fina_count > 0")


def row_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of counts for each table."""
    out = None
    for name, table in tables.items():
        row = table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out


def refreshed_seasons(old: DataFrame, swims: DataFrame, changed: DataFrame) -> DataFrame:
    """ST6: season points with only the changed seasons computed anew."""
    seasons = changed.select("season_end_year").distinct()
    fresh = season_points(swims.join(seasons, "season_end_year", "left_semi"))
    return old.join(seasons, "season_end_year", "left_anti").unionByName(fresh)
