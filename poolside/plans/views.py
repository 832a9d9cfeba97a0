"""The driver's tables seen as competition results.

lineitem rows are results, orders are meets, customers are swimmers, parts are
events. Only columns that a query uses are read: every view is a lazy select.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import valid_swim
from ..functions.scalars import course_code, season_end_year

HOME = "NATION_1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as results, with the keys of swimmer, meet and event."""
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    meet = o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("swimmer_id"))
    return l.join(meet, "l_orderkey").select(
        F.col("l_orderkey").alias("meet_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("event_id"), F.col("l_suppkey").alias("lane"), "swimmer_id",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("time_seconds"), F.to_date("l_shipdate").alias("result_date"), (F.col("l_quantity") * 20).cast("int").alias("points_fina"),
        (F.col("l_quantity").cast("int") % 25).alias("points_rudolph"), F.when(F.col("l_returnflag") == "R", "DSQ").alias("status"), (F.col("l_linestatus") == "O").alias("is_relay"),
        F.when(F.col("l_linenumber") % 2 == 0, 25).otherwise(50).alias("pool_length"),
    )


#: The parts' types as strokes; one type is no stroke, so that the predicates have something to leave out.
STROKE_OF = {"ECONOMY": "FREE", "STANDARD": "BACK", "SMALL": "BREAST", "LARGE": "FLY", "PROMO": "MEDLEY"}


def _stroke() -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for pair in STROKE_OF.items() for v in pair)), F.col("p_type")), F.lit("OTHER"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("event_id"), F.col("p_size").alias("distance"), _stroke().alias("stroke"))


def swimmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_code"))
    c = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    return c.select(F.col("c_custkey").alias("swimmer_id"), F.when(F.col("c_custkey") % 6 != 5, (1972 + F.col("c_custkey") % 30).cast("int")).alias("birth_year"), "country_code", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))


#: Results that a task takes which sorts them by swimmer.
RESULTS_A_TASK = 500_000


def swims(spark: SparkSession, sf_dir: str, *, by_swimmer: bool = False) -> DataFrame:
    """All results with event, season, course and age; every sixth swimmer's birth year is not known.

    With ``by_swimmer`` they are dealt by swimmer, for summaries that join, sort and group them in
    one stage: in as many tasks as the results need, so that a task's memory does not grow with them.
    """
    s = swimmers(spark, sf_dir).select("swimmer_id", "birth_year", "country_code")
    out = results(spark, sf_dir).join(events(spark, sf_dir), "event_id")
    if by_swimmer:
        out = out.repartition(1 + table(spark, sf_dir, "lineitem").count() // RESULTS_A_TASK, "swimmer_id")
    out = out.join(s, "swimmer_id")
    season = season_end_year(F.col("result_date"))
    return out.withColumns({"season_end_year": season, "course": course_code(F.col("pool_length")), "age_group": season - F.col("birth_year")})


def valid_swims(spark: SparkSession, sf_dir: str, *, by_swimmer: bool = False) -> DataFrame:
    """Results that count (FL1)."""
    return swims(spark, sf_dir, by_swimmer=by_swimmer).where(valid_swim())


def record_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as record lists: type, nation, age bounds, name and region."""
    by = lambda c, n, *values: F.element_at(F.array(*(F.lit(x) for x in values)), (F.col(c) % n + 1).cast("int"))
    names = F.create_map(*(F.lit(x) for x in ("Brand#1", "Olympic Records", "Brand#2", "Archiv 1990", "Brand#3", "REGIO list")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", by("p_size", 9, "WR", "ER", "SUI", "SUI.RZW", "SUI.JR", "FAR", "SUI.MS", "AUT", None).alias("kind"), by("p_size", 9, *["SUI"] * 5, "FRO", "SUI", "SUI", None).alias("nation"),
        by("p_partkey", 3, 12, -1, None).alias("least"), F.when(F.col("p_partkey") % 4 == 0, 14).alias("most"), F.coalesce(F.try_element_at(names, F.col("p_brand")), "p_name").alias("name"), F.when(F.col("p_partkey") % 17 == 0, "RZW").alias("region"),
    )
