"""Record lists (XML) and record bundles (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import approval_scope, clean_text, clock_lenient, continent, record_age_key, record_scope, relay_legs, safe_int, stroke_code

_RECORD = "_swimtime: string, _points: string, _status: string, SWIMSTYLE: struct<_distance: string, _stroke: string, _relaycount: string>, MEETINFO: struct<_date: string, _name: string, _city: string, _nation: string>, ATHLETE: struct<_athleteid: string, _firstname: string, _lastname: string, _birthdate: string, _gender: string, _nation: string>, CLUB: struct<_clubid: string, _code: string, _name: string>, SPLITS: struct<SPLIT: array<struct<_distance: string, _swimtime: string>>>"
_LIST = f"_recordlistid: string, _name: string, _type: string, _nation: string, _course: string, _gender: string, _updated: string, _region: string, _handicap: string, _clubid: string, AGEGROUP: struct<_agemin: string, _agemax: string>, RECORDS: struct<RECORD: array<struct<{_RECORD}>>>"
SCHEMA = f"RECORDLISTS struct<RECORDLIST: array<struct<{_LIST}>>>"

BUNDLE = (
    "provider string, code string, course string, downloads array<struct<gender: string, page: int, url: string, payload: struct<totalRowCount: int, generatedOn: string, "
    "query: struct<page: int, current: boolean>, records: array<struct<id: string, recordName: string, pool: int, disciplineDistance: int, disciplineName: string, disciplineGroup: string, isRelay: boolean, time: string, date: string, recordStatus: int, preferredFirstName: string, preferredLastName: string, nationalityCode: string>>>>>"
)


def record_rows(documents: DataFrame) -> DataFrame:
    """SRC13, W11, FN29: a row for each record with a time, numbered within its file in document order."""
    d = documents.select("file_name", F.from_xml(F.col("xml"), SCHEMA).alias("d"))
    lists = d.select("file_name", F.posexplode("d.RECORDLISTS.RECORDLIST").alias("lp", "l"))
    rows = lists.select("file_name", "lp", "l", F.posexplode("l.RECORDS.RECORD").alias("rp", "r"))
    bounds = safe_int(F.col("l.AGEGROUP._agemin")), safe_int(F.col("l.AGEGROUP._agemax"))
    age = record_age_key(*bounds)
    out = rows.select(
        "file_name", "lp", "rp", F.col("l._recordlistid").alias("record_list_id"), clean_text(F.col("l._name")).alias("list_name"), F.col("l._course").alias("course"), F.col("l._gender").alias("gender"), clean_text(F.col("l._nation")).alias("nation"),
        age.alias("age_key"), record_scope(F.col("l._type"), clean_text(F.col("l._nation")), *bounds, F.col("l._name"), F.col("l._region"), F.col("l._handicap"), F.col("l._clubid")).alias("s"),
        safe_int(F.col("r.SWIMSTYLE._distance")).alias("distance"), F.upper("r.SWIMSTYLE._stroke").alias("stroke"), F.coalesce(safe_int(F.col("r.SWIMSTYLE._relaycount")), F.lit(1)).alias("relay_count"),
        clock_lenient(F.col("r._swimtime")).alias("time_seconds"), safe_int(F.col("r._points")).alias("points"), F.col("r.MEETINFO._date").try_cast("date").alias("record_date"), clean_text(F.col("r.MEETINFO._city")).alias("city"),
        clean_text(F.col("r.ATHLETE._firstname")).alias("first_name"), clean_text(F.col("r.ATHLETE._lastname")).alias("last_name"), clean_text(F.col("r.CLUB._name")).alias("club"), F.col("r.SPLITS.SPLIT").alias("splits"),
    )
    kept = out.where("time_seconds > 0").select("*", F.col("s.scope").alias("scope"), F.col("s.reason").alias("reason")).drop("s")
    return kept.withColumn("source_order", F.row_number().over(Window.partitionBy("file_name").orderBy("lp", "rp"))).drop("lp", "rp")


def inventory(records: DataFrame) -> DataFrame:
    """Records and splits of each list definition."""
    keys = ["record_list_id", "list_name", "course", "gender", "nation", "age_key", "scope", "reason"]
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"), F.sum(F.greatest(F.size("splits"), F.lit(0))).alias("splits"))


def bundle_rows(bundles: DataFrame) -> DataFrame:
    """SRC14, FN30, FN36: rows of JSON record bundles; a tie mark before the name is a column."""
    pages = bundles.select("provider", "code", "course", F.explode("downloads").alias("p"))
    rows = pages.select("provider", "code", "course", F.col("p.gender").alias("gender"), F.col("p.page").alias("page"), F.explode("p.payload.records").alias("r"))
    legs = relay_legs(F.col("r.disciplineName"), F.col("r.disciplineDistance"), F.col("r.isRelay"))
    return rows.select(
        "provider", "code", "course", "gender", "page", F.col("r.id").alias("record_id"), F.regexp_replace("r.recordName", "^=", "").alias("record_name"), F.col("r.recordName").startswith("=").alias("tied"),
        legs["legs"].alias("legs"), legs["distance"].alias("distance"), legs["consistent"].alias("relay_ok"), stroke_code(F.col("r.disciplineGroup")).alias("stroke"),
        clock_lenient(F.col("r.time")).alias("time_seconds"), F.to_date(F.substring("r.date", 1, 10)).alias("record_date"), approval_scope(F.col("r.recordStatus"), continent(F.col("code"))).alias("scope"),
        F.col("r.preferredFirstName").alias("first_name"), F.col("r.preferredLastName").alias("last_name"), F.col("r.nationalityCode").alias("nation"), F.when(F.col("r.pool") == 25, "SCM").otherwise("LCM").alias("record_course"),
    )


def bundle_issues(bundles: DataFrame) -> DataFrame:
    """DQ8: (code, gender, issue): pages out of sequence, totals that change or are not reached, repeated ids, another course."""
    pages = bundles.select("code", "course", F.explode("downloads").alias("p")).select("code", "course", F.col("p.gender").alias("gender"), F.col("p.page").alias("page"), F.col("p.payload.totalRowCount").alias("total"), F.size("p.payload.records").alias("n"))
    rows = bundle_rows(bundles)
    key = ["code", "gender"]
    by = pages.groupBy(*key).agg(F.count("page").alias("pages"), F.countDistinct("page").alias("numbers"), F.max("page").alias("last"), F.min("page").alias("first"), F.countDistinct("total").alias("totals"), F.max("total").alias("total"), F.sum("n").alias("n"))
    named = lambda df, name: df.select(*key, F.lit(name).alias("issue")).distinct()
    return (
        named(by.where("pages != numbers or last - first + 1 != pages"), "page_sequence")
        .unionByName(named(by.where("totals != 1"), "total_changes"))
        .unionByName(named(by.where("n != total"), "truncated"))
        .unionByName(named(rows.groupBy(*key, "record_id").count().where("count > 1"), "repeated_id"))
        .unionByName(named(rows.where("course != record_course"), "wrong_course"))
        .unionByName(named(rows.where("time_seconds is null or time_seconds <= 0"), "bad_time"))
        .unionByName(named(rows.where("not relay_ok"), "relay_mismatch"))
    )


def snapshot_issues(documents: DataFrame, records: DataFrame) -> DataFrame:
    """DQ7: files whose kept records are fewer than the raw ones, or with a value that is not positive."""
    raw = documents.select("file_name", (F.size(F.split("xml", "<RECORD[ >]")) - 1).alias("raw"))
    kept = records.groupBy("file_name").agg(F.count(F.lit(1)).alias("kept"), F.min(F.least("distance", "relay_count")).alias("least"))
    out = raw.join(kept, "file_name", "left").fillna(0, ["kept"])
    issue = F.when(F.col("kept") != F.col("raw"), "parsed_count").when(F.col("least") <= 0, "not_positive")
    return out.withColumn("issue", issue).where("issue is not null")
