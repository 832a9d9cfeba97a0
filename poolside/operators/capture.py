"""Which results readers must fetch again: dirty keys from two versions of five tables, and what readers get."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import source_key


def changes(old: DataFrame, new: DataFrame, key: str, carry: list[str] | None = None) -> DataFrame:
    """(key, op, old_<c>, new_<c>): rows that were inserted, updated or deleted between two versions.

    Rows are compared by a hash in which nulls have a place of their own, so only keys,
    hashes and the carried columns are shuffled; equal updates are no change. Keys are unique.
    """
    carry = carry or []

    def side(rows: DataFrame, name: str) -> DataFrame:
        row = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(rows.columns))), {"ignoreNullFields": "false"}), 256)
        return rows.select(F.col(key), row.alias(f"_{name}"), *(F.col(c).alias(f"{name}_{c}") for c in carry))

    both = side(old, "old").join(side(new, "new"), key, "full")
    op = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(F.col("_old") != F.col("_new"), "update")
    return both.withColumn("op", op).where("op IS NOT NULL").select(key, "op", *(f"{s}_{c}" for c in carry for s in ("old", "new")))


def captured(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame]) -> DataFrame:
    """UPS14: the distinct ids of results that any change of results, splits, meets, events or swimmers touches.

    Results and splits count with every change, a split that moved for both of its results;
    meets and events when they were updated; swimmers only when their key changed, for readers see
    nothing else of them. Dimensions are mapped to the results that refer to them now.
    """
    facts = changes(old["results"], new["results"], "id").select("id")
    kids = changes(old["splits"], new["splits"], "id", ["result_id"])
    kids = kids.select(F.explode(F.array_compact(F.array("old_result_id", "new_result_id"))).alias("id"))
    now = new["results"].select("id", "meet_id", "event_id", "swimmer_id")
    out = facts.unionByName(kids)
    for name, foreign in (("meets", "meet_id"), ("events", "event_id")):
        hit = changes(old[name], new[name], "id").where("op = 'update'").select(F.col("id").alias(foreign))
        out = out.unionByName(now.join(hit, foreign, "left_semi").select("id"))
    renamed = changes(old["swimmers"], new["swimmers"], "id", ["swimmer_id"]).where("op = 'update'")
    renamed = renamed.where(~F.col("old_swimmer_id").eqNullSafe(F.col("new_swimmer_id"))).select(F.col("id").alias("swimmer_id"))
    return out.unionByName(now.join(renamed, "swimmer_id", "left_semi").select("id")).distinct()


def payloads(results: DataFrame, swimmers: DataFrame, meets: DataFrame, events: DataFrame, splits: DataFrame, tag: str) -> DataFrame:
    """What readers get of each result: (id, payload struct), with the meet and the ordered splits nested in it.

    A result without splits has an empty array. Results whose swimmer, meet or event is
    unknown have no payload; see incomplete().
    """
    parts = F.array_sort(F.collect_list(F.struct("split_order", "distance", "id", F.col("time_seconds").cast("string").alias("time_seconds"))))
    kids = splits.groupBy("result_id").agg(parts.alias("s"))
    kids = kids.select(F.col("result_id").alias("id"), F.transform("s", lambda x: F.struct(x["distance"].alias("distance"), x["time_seconds"].alias("time_seconds"), x["split_order"].alias("order"))).alias("splits"))
    r, s, m, e = (t.alias(a) for t, a in ((results, "r"), (swimmers, "s"), (meets, "m"), (events, "e")))
    joined = r.join(s, F.col("s.id") == F.col("r.swimmer_id")).join(m, F.col("m.id") == F.col("r.meet_id")).join(e, F.col("e.id") == F.col("r.event_id")).join(kids.alias("k"), F.col("k.id") == F.col("r.id"), "left")
    c = F.col
    seconds = c("r.time_seconds")
    nested = F.struct(
        F.struct(c("m.meet_id").alias("key"), c("m.name").alias("name"), c("m.city").alias("city"), c("m.country_code").alias("country")).alias("meet"), c("r.result_date").alias("date"), seconds.cast("string").alias("time_seconds"),
        c("r.status").alias("status"), c("r.points_fina").alias("points"), c("r.points_rudolph").alias("points_rudolph"), c("r.reaction_time").alias("reaction_time"), c("r.heat").alias("heat"), c("r.lane").alias("lane"), c("r.event_round").alias("round"),
        c("r.is_relay").alias("is_relay"), c("r.relay_count").alias("relay_count"), F.coalesce(c("k.splits"), F.array().cast(kids.schema["splits"].dataType)).alias("splits"),
    )
    return joined.select(
        c("r.id").alias("id"),
        F.struct(
            source_key(tag, c("m.meet_id"), c("r.id")).alias("source_key"), c("r.id").alias("source_result_id"), c("s.swimmer_id").alias("swimmer_key"), c("m.meet_id").alias("meet_key"),
            F.coalesce(F.nullif(c("e.pool_length"), F.lit(0)), F.nullif(c("m.pool_length"), F.lit(0))).alias("course"), c("e.distance").alias("distance"), c("e.stroke").alias("stroke"), c("e.gender").alias("category"), c("r.result_date").alias("race_date"),
            F.round(seconds * 100).cast("int").alias("time_hundredths"), c("r.status").alias("status"), c("r.is_relay").alias("is_relay"), c("r.points_fina").alias("points"), nested.alias("payload"),
        ).alias("payload"),
    )


def incomplete(results: DataFrame, swimmers: DataFrame, meets: DataFrame, events: DataFrame, dirty: DataFrame) -> DataFrame:
    """UPS13: dirty results without their swimmer, meet or event: a projection that leaves them out must not count as current."""
    asked = results.join(dirty.select("id"), "id", "left_semi")
    out = None
    for parent, foreign in ((swimmers, "swimmer_id"), (meets, "meet_id"), (events, "event_id")):
        part = asked.join(parent.select(F.col("id").alias(foreign)), foreign, "left_anti").select("id", F.lit(foreign).alias("missing"))
        out = part if out is None else out.unionByName(part)
    return out
