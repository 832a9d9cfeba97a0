"""Ids for new rows, given out on all executors at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows are counted by so many leading hex digits of a hash, so 4096 counts are added up.
DIGITS = 3


def allocate(rows: DataFrame, keys: list[str], taken: DataFrame, name: str = "id") -> DataFrame:
    """rows with new ids, counted on from the largest in the one column of ``taken`` (0 if it is empty).

    Rows are dealt by a hash of their keys; each bucket is numbered on its own, after
    the counts of all buckets before it. No task sees more than a bucket, and the same rows
    get the same ids when a task runs again. The keys name a row; where they repeat,
    which of the equal rows gets which id is open. Null keys count as a value of their own.
    """
    text = F.concat_ws("\x1f", *(F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys))
    dealt = rows.withColumn("_bucket", F.substring(F.md5(text.cast("binary")), 1, DIGITS))
    sizes = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    ahead = F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))  # over the counts only
    offsets = sizes.select("_bucket", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    top = taken.agg(F.coalesce(F.max(taken.columns[0]), F.lit(0)).cast("long").alias("_top"))
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy(*(F.asc_nulls_first(k) for k in keys)))
    numbered = dealt.withColumn("_nth", nth).join(F.broadcast(offsets), "_bucket").crossJoin(F.broadcast(top))
    return numbered.withColumn(name, F.col("_top") + F.col("_ahead") + F.col("_nth")).drop("_bucket", "_nth", "_ahead", "_top")
