"""Joins that must not make pairs, and digests of whole sets."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F


def most_joined(df) -> int:
    """Collects df and says how many rows its widest join gave out."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        if "Join" in name or name.startswith("CartesianProduct"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return most


def test_a_name_of_many_swimmers_makes_no_pairs_in_plans(spark):
    from poolside.operators import planning

    who = [F.lit("Mia").alias("first_name"), F.lit("K").alias("last_name"), F.lit(2014).alias("birth_year"), F.lit("F").alias("gender")]
    swimmers = spark.range(300).select("id", F.concat(F.lit("S"), "id").alias("swimmer_id"), *who, F.when(F.col("id") % 2 == 0, "SUI").otherwise("AUT").alias("country_code"))
    kind = F.when(F.col("id") % 3 == 0, "pdf").otherwise("lenex")
    rows = spark.range(300).select(F.lit(1).alias("live_id"), F.col("id").alias("row_no"), kind.alias("source_kind"), *who, F.when(F.col("id") % 5 > 0, "SUI").alias("nation"), F.concat(F.lit("a"), "id").alias("athlete_id"))
    aliases = spark.createDataFrame([("SUI", "a4", 4), ("SUI", "a4", 4), ("SUI", "a7", 7), ("SUI", "a8", 10), ("SUI", "a8", 12)], "source_country_code string, source_swimmer_id string, swimmer_pk long")
    found = planning.identified(rows, swimmers, aliases).select("row_no", "candidates", "swimmer_pk")
    got = {r.row_no: (r.candidates, r.swimmer_pk) for r in found.collect()}
    # printed lists count all nations; a7 is Austrian, a8 names two; without a nation nobody is found
    assert (got[3], got[4], got[7], got[8], got[10]) == ((300, None), (1, 4), (150, None), (150, None), (0, None))
    assert most_joined(found) <= 300


def test_lines_of_a_crowded_key_make_no_pairs(spark):
    from poolside.operators import match

    events = [(1, 1, "2026-01-01"), (2, 2, None), (3, 3, "2026-01-02"), (3, 4, "2026-01-03")] + [(0, 100 + i, "2026-01-01") for i in range(200)]
    schedule = spark.createDataFrame(events, "size int, event_id long, date string").withColumn("date", F.to_date("date"))
    lines = [(1, 1, None), (2, 1, "2026-01-02"), (3, 2, None), (4, 3, None), (5, 3, "2026-01-03"), (6, 1, None), (6, 3, None), (7, 1, None), (7, 2, "2026-01-01")] + [(100 + i, 0, None) for i in range(200)]
    found = match.schedule_match(spark.createDataFrame(lines, "row_id long, size int, date string").withColumn("date", F.to_date("date")), schedule, ["size"])
    assert sorted((r.row_id, r.event_id, str(r.date)) for r in found.collect()) == [(1, 1, "2026-01-01"), (3, 2, "None"), (5, 4, "2026-01-03"), (7, 1, "2026-01-01")]
    assert most_joined(found) <= len(lines)


def test_a_name_of_many_swimmers_makes_no_pairs_among_candidates(spark):
    from poolside.operators import resolve

    who = [F.lit("Mia").alias("first_name"), F.lit("K").alias("last_name"), F.lit(2014).alias("birth_year"), F.lit("F").alias("gender")]
    swimmers = spark.range(300).select(F.concat(F.lit("S"), "id").alias("swimmer_id"), *who, F.when(F.col("id") % 2 == 0, "SUI").otherwise("AUT").alias("country_code"))
    kind = F.when(F.col("id") % 3 == 0, "pdf").otherwise("lenex")
    athletes = spark.range(300).select("id", F.col("id").cast("string").alias("source_swimmer_id"), kind.alias("source_kind"), *who, F.when(F.col("id") % 5 > 0, "SUI").otherwise("GER").alias("country_code"))
    aliases = spark.createDataFrame([("SUI", "4", "S4"), ("SUI", "7", "S7")], "source_country_code string, source_swimmer_id string, swimmer_id string")
    found = resolve.candidates(athletes, swimmers, aliases)
    got = {r.id: (r.candidates, r.route, r.swimmer_id) for r in found.collect()}
    assert (got[3], got[4], got[7], got[10]) == ((300, "hold", None), (1, "link", "S4"), (150, "hold", None), (0, "create", None))
    assert most_joined(found) <= 300


def test_set_digests_are_of_all_sorted_hashes(spark):
    from poolside.operators import delta
    from poolside.plans import catalog

    hashes = sorted(hashlib.sha256(f'{{"a":{a}}}'.encode()).hexdigest() for a in (3, 1, 1))
    rows = spark.createDataFrame([(1, 3), (1, 1), (1, 1)], "meet_id int, a int")
    assert [r.digest for r in delta.sorted_digest(rows, ["meet_id"], ["a"]).collect()] == [hashlib.sha256(",".join(hashes).encode()).hexdigest()]
    assert "string_agg(h, ',' ORDER BY h)" in catalog.oracle_sql()["set_digests"]


def test_days_without_results_join_meets_only(spark):
    from poolside.operators import quality

    meets = spark.createDataFrame([(1, "2026-01-01", "2026-01-03"), (2, "2020-01-01", "2026-01-01"), (3, "2026-01-01", "2026-01-02")], "meet_id int, a string, b string")
    meets = meets.select("meet_id", F.to_date("a").alias("start_date"), F.to_date("b").alias("end_date"))
    results = spark.createDataFrame([(1, "2026-01-02"), (1, "2026-01-02"), (1, None), (2, "2020-01-01")], "meet_id int, d string").select("meet_id", F.to_date("d").alias("result_date"))
    found = quality.days_without_results(meets, results)
    days = [(r.meet_id, str(r.day)) for r in found.collect()]
    assert len(days) == len(set(days)) == 2 + 2192 + 2
    assert {d for d in days if d[0] != 2} == {(1, "2026-01-01"), (1, "2026-01-03"), (3, "2026-01-01"), (3, "2026-01-02")} and (2, "2020-01-01") not in days
    assert most_joined(found) <= 3


def test_results_are_dealt_to_as_many_tasks_as_they_need(spark, monkeypatch):
    from poolside.plans import views

    monkeypatch.setattr(views, "RESULTS_A_TASK", 400)
    sf = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    swims = views.valid_swims(spark, sf, by_swimmer=True)
    assert swims.rdd.getNumPartitions() >= lines // 400 > 4
    assert swims.count() == views.valid_swims(spark, sf).count()


def test_values_stand_in_two_bands_and_lose_no_close_one(spark):
    from poolside.operators import match

    values = [i / 100 + d for i in range(0, 400, 3) for d in (-0.005, -0.0049, 0.0, 0.0049, 0.005, 0.0051, 0.0099)] + [-3.333, 99999.99, 99999.985]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    around = match.in_bands(rows, "v", 0.01, around=True)
    assert around.count() < 2.2 * len(values)
    close = around.alias("a").join(match.in_bands(rows, "v", 0.01).alias("b"), "_band").where("abs(a.v - b.v) < 0.01").selectExpr("a.id AS x", "b.id AS y")
    found = [tuple(r) for r in close.collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if abs(a - b) < 0.01}


def test_set_digests_count_rows_with_nulls_in_code_and_sql(spark, tmp_path):
    import duckdb

    from poolside.plans import catalog

    lines = [(1, 1, 5), (2, 1, 5), (2, 2, None), (3, 1, 5), (3, None, 2), (4, None, None), (5, None, None), (5, None, None), (6, 7, None), (None, 1, 5), (None, 1, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
        want = con.execute(catalog.oracle_sql()["set_digests"]).fetchall()
    found = {r.meet_id: r.digest for r in catalog.queries()["set_digests"](spark, str(tmp_path)).collect()}
    text = lambda v: "null" if v is None else v
    hashes = {k: sorted(hashlib.sha256(f'{{"l_linenumber":{text(n)},"l_partkey":{text(p)}}}'.encode()).hexdigest() for m, n, p in lines if m == k) for k, _, _ in lines}
    assert dict(want) == found == {k: hashlib.sha256(",".join(h).encode()).hexdigest() for k, h in hashes.items()}
    assert len(set(found.values())) == len(found) == 7
