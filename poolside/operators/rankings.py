"""Rankings, record holders, coverage, and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import rankable


def competition_rank(rows: DataFrame, keys: list[str], value: str = "time_cs", name: str = "position") -> DataFrame:
    """1, 1, 3."""
    return rows.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last(value))))


def age_group_ranks(results: DataFrame) -> DataFrame:
    """Ranks among rankable results of a meet, event and age group; others have none."""
    ok = rankable(F.col("status"), F.col("time_seconds"))
    w = Window.partitionBy("meet_id", "event_id", "age_group_id", ok).orderBy("time_seconds")
    return results.withColumn("age_group_rank", F.when(ok & F.col("age_group_id").isNotNull(), F.rank().over(w)))


def holders(rows: DataFrame, keys: list[str], value: str = "time_cs", who: list[str] | None = None) -> DataFrame:
    """All distinct holders of the best value; an aggregate and a join, so that no event is sorted whole."""
    best = rows.groupBy(*keys).agg(F.min(value).alias(value))
    return rows.join(best, [*keys, value], "left_semi").select(*keys, value, *(who or [])).distinct()


def order_breaks(rows: DataFrame, keys: list[str], order: Column, value: str = "time_cs") -> DataFrame:
    """Rows whose value is below that of the row before."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("previous", before).where(F.col(value) < F.col("previous"))


def rank_breaks(rows: DataFrame, keys: list[str], value: str = "time_cs", rank: str = "position") -> DataFrame:
    """W6, DQ2: rows whose stated rank is not the computed one."""
    return competition_rank(rows, keys, value, "expected").where(~F.col(rank).eqNullSafe(F.col("expected")))


def page_breaks(pages: DataFrame, keys: list[str], total: str = "total") -> DataFrame:
    """Pages that do not begin where the one before ended, the first at 1, and last ones that do not reach the total."""
    w = Window.partitionBy(*keys).orderBy("offset")
    end = F.col("offset") + F.col("count")
    seen = pages.withColumns({"expected_offset": F.coalesce(F.lag(end).over(w), F.lit(1)), "_last": F.lead("offset").over(w).isNull()})
    return seen.where((F.col("offset") != F.col("expected_offset")) | (F.col("_last") & (end != F.col(total) + 1))).drop("_last")


def merged_pages(rows: DataFrame, pages: DataFrame, keys: list[str], athlete: str = "athlete_id", page_size: int = 25) -> tuple[DataFrame, DataFrame]:
    """(each athlete's row once, (keys, offset, issue)) of lists read page by page, whose last page overlaps the one before.

    pages: keys, offset, total, built; rows: keys, offset, the athlete, values. A list must not
    change while it is read, every page must be full, an athlete met again must have the
    same row, and each page must bring as many new athletes as it has places.
    """
    values = [c for c in rows.columns if c not in (*keys, "offset", athlete)]
    by = [*keys, athlete]
    seen = rows.withColumn("_row", F.to_json(F.struct(*sorted(values)), {"ignoreNullFields": "false"}))
    each = seen.groupBy(*by).agg(F.min("offset").alias("offset"), F.min("_row").alias("_a"), F.max("_row").alias("_b"))
    fresh = rows.join(each.select(*by, "offset"), [*by, "offset"], "left_semi").dropDuplicates([*by, "offset"])
    totals = pages.groupBy(*keys).agg(F.min("total").alias("total"), F.count_distinct(F.struct("total", "built")).alias("_states"))
    counted = rows.groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("_rows")).join(each.groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("_fresh")), [*keys, "offset"], "left")
    due = totals.where("total > 0").select(*keys, "total", F.explode(F.sequence(F.lit(1).cast("long"), F.col("total").cast("long"), F.lit(page_size).cast("long"))).alias("offset"))
    checked = due.join(counted.withColumn("offset", F.col("offset").cast("long")), [*keys, "offset"], "left")
    said = lambda frame, issue: frame.select(*keys, F.col("offset").cast("long").alias("offset"), F.lit(issue).alias("issue"))
    issues = (
        said(totals.where("_states > 1").withColumn("offset", F.lit(None).cast("long")), "source_changed")
        .unionByName(said(checked.where(F.coalesce("_rows", F.lit(0)) != F.least(F.lit(page_size), F.col("total"))), "incomplete_page"))
        .unionByName(said(each.where("_a <> _b"), "conflicting_overlap").distinct())
        .unionByName(said(checked.where(F.coalesce("_fresh", F.lit(0)) != F.least(F.lit(page_size).cast("long"), F.col("total") - F.col("offset") + 1)), "gap_or_duplicate"))
    )
    return fresh, issues


def revision_issues(old: DataFrame, new: DataFrame, old_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """UPS10: (key, issue) of new versions of populations that must not replace the old ones.

    old and new: key, captured_at, total; rows: key, athlete_id, time_cs. stale: not captured
    later; truncated: fewer athletes; regression: an athlete gone or slower. A version equal
    in every row is no revision and has no issue; neither has a population without an old version.
    """
    both = old.select("key", F.col("captured_at").alias("_then"), F.col("total").alias("_had")).join(new.select("key", "captured_at", "total"), "key")
    regressed = athletes_regressed(old_rows, new_rows.join(both.select("key"), "key", "left_semi")).join(both.select("key"), "key", "left_semi").select("key").distinct()
    rows = lambda r: r.select("key", F.struct("athlete_id", "time_cs").alias("r"))
    differ = rows(old_rows).withColumn("s", F.lit(1)).unionByName(rows(new_rows).withColumn("s", F.lit(2)))
    differ = differ.groupBy("key", "r").agg(F.count_distinct("s").alias("sides")).where("sides = 1").select("key").distinct()
    same = both.where("captured_at = _then AND total = _had").join(differ, "key", "left_anti").select("key")
    found = both.where("captured_at <= _then").select("key", F.lit("stale").alias("issue")).unionByName(both.where("total < _had").select("key", F.lit("truncated").alias("issue"))).unionByName(regressed.select("key", F.lit("regression").alias("issue")))
    return found.join(same, "key", "left_anti")


def chain_breaks(packages: DataFrame, key: str = "meet_id") -> DataFrame:
    """Revisions that do not follow the one before."""
    w = Window.partitionBy(key).orderBy("revision")
    out = packages.withColumns({"_rev": F.lag("revision").over(w), "_sha": F.lag("sha256").over(w)})
    ok = F.when(F.col("_rev").isNull(), F.col("revision") == 1).otherwise((F.col("revision") == F.col("_rev") + 1) & F.col("previous").eqNullSafe(F.col("_sha")))
    return out.where(~ok).drop("_rev", "_sha")


def population_issues(populations: DataFrame) -> DataFrame:
    """DQ2: (key, issue) for each broken rule of nested ranking populations."""
    rows = populations.select("key", F.explode("rows").alias("r")).select("key", "r.*")
    pages = populations.select("key", "total", F.explode("pages").alias("p")).select("key", "total", "p.*")
    sizes = populations.select("key", "total", F.size("rows").alias("n"), F.size(F.array_distinct(F.transform("rows", lambda r: r["athlete_id"]))).alias("athletes"))
    issue = lambda df, name: df.select("key", F.lit(name).alias("issue")).distinct()
    return (
        issue(sizes.where("n != total"), "wrong_total")
        .unionByName(issue(sizes.where("athletes != n"), "repeated_athlete"))
        .unionByName(issue(order_breaks(rows, ["key"], F.col("position")), "not_sorted"))
        .unionByName(issue(rank_breaks(rows, ["key"]), "wrong_rank"))
        .unionByName(issue(page_breaks(pages, ["key"]), "page_gap"))
    )


def coverage(expected: DataFrame, available: DataFrame, keys: list[str]) -> DataFrame:
    """DQ3: every key of either side with its state: available, missing or unlisted."""
    e, a = expected.select(*keys).distinct().withColumn("_e", F.lit(True)), available.select(*keys).distinct().withColumn("_a", F.lit(True))
    state = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unlisted").otherwise("available")
    return e.join(a, keys, "full").select(*keys, state.alias("state"))


def athletes_regressed(old: DataFrame, new: DataFrame) -> DataFrame:
    """J22, UPS10: athletes whose best is gone or slower than it was."""
    keys = ["key", "athlete_id"]
    o, n = old.groupBy(*keys).agg(F.min("time_cs").alias("old_cs")), new.groupBy(*keys).agg(F.min("time_cs").alias("new_cs"))
    return o.join(n, keys, "left").where(F.col("new_cs").isNull() | (F.col("new_cs") > F.col("old_cs")))


def provenance_issues(populations: DataFrame) -> DataFrame:
    """DQ2: (key, issue) by what each population says of itself: key, course, gender, age_group, captured_at, built, rows, pages.

    Rows: athlete_id, result_id, first_name, last_name, birth_year, date, time_cs, is_split;
    pages: offset, source_url, sha256. Judged by array functions, nothing is shuffled.
    """
    from .quality import AGE_GROUPS, age_fits

    c = F.col
    blank = lambda x: F.coalesce(F.trim(x) == "", F.lit(True))
    year = lambda r: F.year(r["date"])
    url = lambda p, part, key=None: F.try_parse_url(p["source_url"], F.lit(part), *([F.lit(key)] if key else []))
    digits = lambda x: F.coalesce(x.rlike(r"^\d+$"), F.lit(False))
    page_ok = lambda p: (url(p, "PROTOCOL") == "https") & (url(p, "QUERY", "firstPlace") == p["offset"].cast("string")) & digits(url(p, "QUERY", "rankingClubId")) & p["sha256"].rlike("^[a-f0-9]{64}$")
    rules = [
        ("bad_category", c("course").isin("SCM", "LCM") & c("gender").isin("F", "M") & c("age_group").isin(*AGE_GROUPS)), ("bad_timestamp", c("captured_at").rlike(r"^\d{4}-\d\d-\d\dT.*(Z|[+-]\d\d:\d\d)$") & c("built").startswith("Last built ")),
        ("bad_page", F.forall("pages", lambda p: F.coalesce(page_ok(p), F.lit(False)))),
        ("bad_row", F.forall("rows", lambda r: digits(r["athlete_id"]) & digits(r["result_id"]) & ~blank(r["first_name"]) & ~blank(r["last_name"]) & F.coalesce((r["time_cs"] > 0) & (r["birth_year"] > 1800) & (r["birth_year"] <= year(r)), F.lit(False)) & r["is_split"].isNotNull())),
        ("wrong_age", F.forall("rows", lambda r: age_fits(year(r) - r["birth_year"], c("age_group")))), ("future_row", F.forall("rows", lambda r: F.coalesce(r["date"] <= F.to_date(F.substring("captured_at", 1, 10)), F.lit(False)))),
    ]
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules)))
    return populations.select("key", F.explode(broken).alias("issue"))


def truncated_exports(categories: DataFrame, rows: DataFrame, key: str = "key") -> DataFrame:
    """DQ5: categories whose rows are not as many as their source says."""
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("found"))
    out = categories.select(key, "source_rows").join(found, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return out.where(~F.col("found").eqNullSafe(F.col("source_rows")))


def export_issues(rows: DataFrame, stated: DataFrame, keys: list[str], who: list[str]) -> DataFrame:
    """DQ5: stated holders that are none, and holders that are not stated."""
    true = holders(rows, keys, who=who)
    on = [*keys, "time_cs", *who]
    return stated.join(true, on, "left_anti").select(*on, F.lit("not_a_holder").alias("issue")).unionByName(true.join(stated, on, "left_anti").select(*on, F.lit("not_stated").alias("issue")))
