"""Choosing one row of several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an explicit order; null keys are equal."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def pick_last(rows: DataFrame, keys: list[str], position: str, values: list[str]) -> DataFrame:
    """SRC11: the last values of each key by position, in one aggregation."""
    best = F.max_by(F.struct(*values), F.col(position)).alias("_v")
    return rows.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_v.{v}").alias(v) for v in values))


def first_by_id(rows: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """The smallest id of each key."""
    return rows.groupBy(*keys).agg(F.min(id_col).alias(id_col))


def repeated(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows that repeat an earlier one's key, for review."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn > 1").drop("_rn")


def unique_only(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs once."""
    w = Window.partitionBy(*keys)
    return rows.withColumn("_n", F.count(F.lit(1)).over(w)).where("_n = 1").drop("_n")


def numbered(rows: DataFrame, order: list[Column], within: list[str] | None = None, name: str = "source_order") -> DataFrame:
    """1, 2, ... in a source's order; give within (a file, a list) so that no task sees all rows."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*(within or [])).orderBy(*order)))


def latest_club(results: DataFrame) -> DataFrame:
    """The club of each swimmer's last result that names one."""
    order = [F.desc_nulls_last("result_date"), F.desc("id")]
    return pick_first(results.where("club_name is not null"), ["swimmer_id"], order).select("swimmer_id", "club_name")
