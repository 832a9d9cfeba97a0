"""Counts and checks on observations, performances and refreshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .delta import compare, upsert


def counts(rows: DataFrame, *keys: str) -> DataFrame:
    """A8"""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_sets(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """How many distinct values each column has, and which."""
    out = rows.groupBy(*keys)
    return out.agg(*(F.countDistinct(c).alias(f"{c}_count") for c in columns), *(F.sort_array(F.collect_set(c)).alias(f"{c}_set") for c in columns))


def nested_count(files: DataFrame, key: str, array: str) -> DataFrame:
    """Elements of an array column, summed over each file."""
    return files.groupBy(key).agg(F.sum(F.greatest(F.size(array), F.lit(0))).alias("n"))


#: Age groups of a club's record categories, and the individual events that each must list.
AGE_GROUPS = ["X_X", "X_11", *(f"{a}_{a}" for a in range(12, 19))]
STANDARD = {"FREE": [50, 100, 200, 400, 800, 1500], "BREAST": [50, 100, 200], "BACK": [50, 100, 200], "FLY": [50, 100, 200], "IM": [200, 400]}
SHORT_COURSE_ONLY = {"IM": [100]}
KINDS = ["individual", "relay", "lap"]


def standard_events(course: Column) -> Column:
    """The keys of the events that a category of this course must list."""
    key = lambda stroke, metres: F.lit(f"individual:1:{metres}:{stroke}")
    every = F.array(*(key(s, m) for s, metres in STANDARD.items() for m in metres))
    return F.when(course == "SCM", F.concat(every, F.array(*(key(s, m) for s, metres in SHORT_COURSE_ONLY.items() for m in metres)))).otherwise(every)


def age_fits(age: Column, group: Column) -> Column:
    """Is this age one of the group: X_X everybody, X_11 up to 11, 12_12 just 12; null and beyond 120 never."""
    low = F.split(group, "_")[0].try_cast("int")
    return F.coalesce(age.between(0, 120) & F.when(group == "X_X", True).when(group == "X_11", age <= 11).otherwise(age == low), F.lit(False))


def baseline_issues(categories: DataFrame) -> DataFrame:
    """DQ4: (category, event, issue) of record categories: key, course, gender, age_group, created_at, unlisted, events.

    An event is a struct of key, kind, legs, distance, stroke, status and holders; a holder one of
    full_name, first_name, last_name, birth_year, date and time_cs. Each category is judged within
    itself by array functions; only the distinct issues are shuffled. An issue of the category itself has no event.
    """
    c = F.col
    keys = F.transform("events", lambda e: e["key"])
    whole = [
        ("bad_category", ~(c("course").isin("SCM", "LCM") & c("gender").isin("M", "F") & c("age_group").isin(*AGE_GROUPS) & (c("key") == F.concat_ws(":", "course", "gender", "age_group")))),
        ("no_events", F.size("events") < 1), ("repeated_event", F.size(keys) > F.size(F.array_distinct(keys))),
        ("wrong_unlisted", ~c("unlisted").eqNullSafe(F.array_sort(F.array_except(standard_events(c("course")), keys)))),
    ]
    out = categories.select(c("key").alias("category"), F.lit(None).cast("string").alias("event"), F.explode(_named(whole)).alias("issue"))
    each = categories.select("key", "age_group", F.to_date("created_at").alias("_made"), F.explode("events").alias("e"))
    e, h = c("e"), c("e.holders")
    single = e["kind"] != "relay"
    year = lambda x: F.year(x["date"]) - x["birth_year"]
    text = F.concat_ws(":", e["kind"], e["legs"], e["distance"], e["stroke"])
    blank = lambda x: F.coalesce(F.trim(x) == "", F.lit(True))
    own = [
        ("bad_event", ~((e["key"] == text) & e["kind"].isin(*KINDS) & e["stroke"].isin(*STANDARD) & e["distance"].between(1, 25000) & e["legs"].between(1, 10))),
        ("bad_state", (~single != (e["legs"] > 1)) | (e["status"] != F.when(F.size(h) > 0, "ready").otherwise("empty"))),
        ("bad_evidence", F.exists(h, lambda x: F.coalesce((x["time_cs"] <= 0) | (x["date"] > c("_made")), F.lit(True)))),
        ("no_identity", single & F.exists(h, lambda x: blank(x["first_name"]) | blank(x["last_name"]) | x["birth_year"].isNull())), ("no_name", F.exists(h, lambda x: blank(x["full_name"]))),
        ("other_name", single & F.exists(h, lambda x: x["full_name"] != F.concat(x["last_name"], F.lit(", "), x["first_name"]))),
        ("wrong_age", single & F.exists(h, lambda x: ~age_fits(year(x), c("age_group")))), ("holders_not_tied", F.size(F.array_distinct(F.transform(h, lambda x: x["time_cs"]))) > 1),
        ("repeated_holder", F.size(h) > F.size(F.array_distinct(h))),
    ]
    return out.unionByName(each.select(c("key").alias("category"), e["key"].alias("event"), F.explode(_named(own)).alias("issue"))).distinct()


def _named(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules that are broken; a rule that cannot be judged counts as broken."""
    return F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(True)), name) for name, broken in rules)))


def performance_issues(rows: DataFrame, today: str) -> DataFrame:
    """DQ6, FL14: performance rows with their first broken rule; what must be there and is null breaks it."""
    c = F.col
    present = lambda *names: F.lit(True) if not names else F.coalesce(F.length(F.trim(names[0])) > 0, F.lit(False)) & present(*names[1:])
    rules = [
        ("no_source", c("source_sha256").rlike("^[a-f0-9]{64}$")), ("bad_category", c("course").isin("SCM", "LCM") & c("gender").isin("F", "M") & c("stroke").isin(*STANDARD)), ("bad_time", (c("time_cs") > 0) & (c("distance") > 0)),
        ("bad_date", c("date") <= F.lit(today).cast("date")), ("bad_age", (c("birth_year") > 1800) & (c("birth_year") <= F.year("date"))), ("no_identity", present("first_name", "last_name", "meet")),
    ]
    issue = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules))
    return rows.withColumn("issue", issue).where("issue IS NOT NULL")


def readiness(baseline: DataFrame, seen: DataFrame, key: list[str], columns: list[str], group: list[str], problems: DataFrame | None = None) -> DataFrame:
    """DQ10: held, waiting, new, changed or unchanged for each group, with the counts behind it.

    What removes something is held, and what has ``problems`` (group, problems: undated or ambiguous
    results, sessions without a date) too.
    """
    states = compare(baseline, seen, [*group, *key], columns)
    by = states.groupBy(*group).agg(*(F.count_if(F.col("state") == s).alias(s) for s in ("added", "removed", "changed", "unchanged")))
    if problems is not None:
        by = by.join(problems.select(*group, "problems"), group, "full").fillna(0, ["added", "removed", "changed", "unchanged", "problems"])
    held = (F.col("removed") > 0) if problems is None else (F.col("removed") > 0) | (F.col("problems") > 0)
    total = F.col("added") + F.col("changed") + F.col("unchanged")
    decision = F.when(held, "held").when(total == 0, "waiting").when((F.col("changed") == 0) & (F.col("unchanged") == 0), "new").when(F.col("added") + F.col("changed") > 0, "changed").otherwise("unchanged")
    return by.withColumn("decision", decision)


def refresh_health(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """DQ11: the health of each list and course; a failure keeps the last good snapshot."""
    return upsert(ledger, outcomes, ["record_list_id", "course"], {"last_good_hash": "keep_if_null", "last_good_at": "keep_if_null"})


def days_without_results(meets: DataFrame, results: DataFrame, key: str = "meet_id") -> DataFrame:
    """DQ12: scheduled days on which no result is dated.

    Each meet's dated days are gathered first, so only meets are joined, never their days.
    """
    dated = results.groupBy(key).agg(F.collect_set("result_date").alias("_dated"))
    scheduled = F.sequence("start_date", "end_date")
    open_ = F.coalesce(F.array_except(scheduled, "_dated"), scheduled)  # without any result, all
    return meets.join(dated, key, "left").select(key, F.explode(open_).alias("day"))


def projection_ready(contract: DataFrame, dirty: DataFrame) -> DataFrame:
    """DQ13: one row: version 1, seeded, and nothing dirty."""
    c = contract.agg(F.max("version").alias("version"), F.bool_and("seeded").alias("seeded"))
    d = dirty.agg(F.count(F.lit(1)).alias("pending"))
    return c.crossJoin(d).withColumn("ready", F.coalesce((F.col("version") == 1) & F.col("seeded") & (F.col("pending") == 0), F.lit(False)))
