"""Queries of plans, ledgers and quality checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import delta, packages, quality, rankings
from . import views as V
from .registry import query

_LEDGER = """h AS (SELECT c_custkey AS meet_id, CAST(c_custkey % 5 AS INT) AS rev, md5(CAST(c_custkey AS VARCHAR)) AS sha FROM customer WHERE c_custkey % 7 <> 0),
 p AS (SELECT c_custkey AS meet_id, CAST(c_custkey % 5 + c_custkey % 4 - 1 AS INT) AS revision, md5(CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE -c_custkey END AS VARCHAR)) AS sha256, CASE WHEN c_custkey % 2 = 0 THEN md5(CAST(c_custkey AS VARCHAR)) END AS previous FROM customer)"""


@query(f"""WITH {_LEDGER} SELECT meet_id, CASE WHEN revision=rev AND sha256=sha THEN 'repeat' WHEN revision=rev THEN 'conflict' WHEN revision < rev THEN 'stale' WHEN revision = coalesce(rev, 0) + 1 AND previous IS NOT DISTINCT FROM sha THEN 'apply' ELSE 'gap' END AS status FROM p LEFT JOIN h USING (meet_id)""")
def chain_states(spark, sf):
    c, k = V.table(spark, sf, "customer"), F.col("c_custkey")
    ledger = c.where("c_custkey % 7 <> 0").select(k.alias("meet_id"), (k % 5).cast("int").alias("revision"), F.md5(k.cast("string")).alias("sha256"))
    sent = F.md5(F.when(k % 3 == 0, k).otherwise(-k).cast("string"))
    found = c.select(k.alias("meet_id"), (k % 5 + k % 4 - 1).cast("int").alias("revision"), sent.alias("sha256"), F.when(k % 2 == 0, F.md5(k.cast("string"))).alias("previous"))
    return delta.chain_status(found, ledger).select("meet_id", "status")


@query("""WITH t AS (SELECT c_custkey, c_mktsegment AS s FROM customer WHERE c_custkey % 3 <> 0), i AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'BUILDING' ELSE 'OTHER' END AS s FROM customer)
 SELECT c_custkey, CASE WHEN t.s IS NULL OR (i.s='BUILDING' AND t.s <> 'BUILDING') THEN i.s ELSE t.s END AS segment FROM i LEFT JOIN t USING (c_custkey)""")
def preferred_values(spark, sf):
    c = V.table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    new = c.withColumn("segment", F.when(F.col("c_custkey") % 2 == 0, "BUILDING").otherwise("OTHER"))
    return delta.prefer_value(c.where("c_custkey % 3 <> 0"), new, "c_custkey", "segment", "BUILDING")


_DIGEST = ", ".join(f"CAST(sum(CAST(('0x' || substr(h, {1 + 8 * k}, 8)) AS BIGINT)) AS BIGINT)" for k in range(4))


@query(f"""WITH d AS (SELECT o_orderpriority, CASE WHEN o_orderkey % 4000 <> 1 THEN CAST(o_orderdate AS DATE) END AS day, sha256('{{"meet_key":"M' || o_orderkey || '","publisher":"A","revision":' || (o_orderkey % 5 + 1) || ',"sha256":"' || md5(CAST(o_custkey AS VARCHAR)) || '"}}') AS h FROM orders WHERE o_orderstatus = 'O')
 SELECT o_orderpriority, count(*) AS meets, CASE WHEN count(day) = count(*) THEN min(day) END AS affected_from, sha256(concat_ws(',', count(*), {_DIGEST})) AS batch_id FROM d GROUP BY 1""")
def pending_batch(spark, sf):
    """A batch for each priority; an unknown date leaves the whole batch without one."""
    k = F.col("o_orderkey")
    ledger = V.table(spark, sf, "orders").select(
        "o_orderpriority", F.concat(F.lit("M"), k).alias("meet_key"), F.lit("A").alias("publisher"), (k % 5 + 1).alias("revision"), F.md5(F.col("o_custkey").cast("string")).alias("sha256"),
        F.when(k % 4000 != 1, F.to_date("o_orderdate")).alias("affected_from"), (F.col("o_orderstatus") == "O").alias("dirty"),
    )
    return delta.pending_batch(ledger, ["o_orderpriority"])


@query("SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END IS DISTINCT FROM 'F'")
def receipts_to_retry(spark, sf):
    state = F.when(F.col("o_orderkey") % 5 > 0, F.when(F.col("o_orderstatus") == "F", "complete").otherwise("failed"))
    return delta.to_retry(V.table(spark, sf, "orders").select("o_orderkey", state.alias("state"))).select("o_orderkey")


@query("SELECT DISTINCT l_orderkey AS meet_id FROM lineitem WHERE l_linenumber = 3 AND l_partkey % 2 = 1")
def drifted_meets(spark, sf):
    """Meets of which a line was changed after the ledger was written."""
    lines = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("meet_id"), "l_linenumber", "l_partkey")
    ledger = delta.set_digest(lines, ["meet_id"], ["l_linenumber", "l_partkey"])
    changed = lines.withColumn("l_partkey", F.when((F.col("l_linenumber") == 3) & (F.col("l_partkey") % 2 == 1), -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    return packages.drifted(changed, ledger, ["l_linenumber", "l_partkey"])


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 <> 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 4 <> 0""")
def applied_plan(spark, sf):
    """A reviewed plan of inserts and updates; held rows stay as they are."""
    c = V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    target = c.where("c_custkey % 7 <> 0").withColumn("strength", F.lit(1))
    new = c.withColumns({"c_acctbal": F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")), "strength": F.lit(1), "held": F.col("c_custkey") % 4 == 0})
    plan = delta.plan_actions(new, target, ["c_custkey"], ["c_name", "c_acctbal"])
    reviewed = delta.plan_hash(plan, ["c_custkey", "c_name", "c_acctbal", "action"])
    return delta.apply_plan(target.drop("strength"), plan, ["c_custkey"], ["c_name", "c_acctbal"], reviewed, severe=F.col("c_custkey") < 0)


_GRID = "CASE WHEN course = 'SCM' THEN list_concat(std, ['individual:1:100:IM']) ELSE std END"
_STD = "[" + ", ".join(f"'individual:1:{m}:{k}'" for k, ms in quality.STANDARD.items() for m in ms) + "]"
_AGES = "[" + ", ".join(f"'{a}'" for a in quality.AGE_GROUPS) + "]"


@query(f"""WITH h AS (SELECT l_suppkey % 10 AS c, l_partkey % 40 AS e, l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS INT) AS t, l_suppkey AS s, l_partkey AS p FROM lineitem),
 b AS (SELECT c, CASE WHEN c % 2 = 0 THEN 'SCM' ELSE 'LCM' END AS course, CASE WHEN c = 9 THEN 'D' ELSE 'F' END AS gender, ({_AGES})[c + 1] AS age_group, {_STD} AS std FROM (SELECT DISTINCT c FROM h)),
 x AS (SELECT *, course || ':' || gender || ':' || coalesce(age_group, '') || CASE WHEN c = 7 THEN '!' ELSE '' END AS category FROM (SELECT * REPLACE (coalesce(age_group, 'X_9') AS age_group) FROM b)),
 ev AS (SELECT c, e, CASE WHEN e % 9 = 0 THEN 'relay' WHEN e % 10 = 0 THEN 'lap' ELSE 'individual' END AS kind, CASE WHEN e % 9 = 0 AND e <> 18 THEN 4 ELSE 1 END AS legs, CASE WHEN e = 39 THEN 0 ELSE [50, 100, 200, 400][e % 4 + 1] END AS distance, ['FREE', 'BACK', 'BREAST', 'FLY', 'IM'][e % 5 + 1] AS stroke, count(*) FILTER (WHERE e % 11 > 0 AND t < 3) AS holders FROM h GROUP BY ALL),
 ek AS (SELECT *, concat_ws(':', kind, legs, distance, stroke) || CASE WHEN e = 38 THEN '?' ELSE '' END AS key, CASE WHEN (holders > 0) = (e <> 37) THEN 'ready' ELSE 'empty' END AS status FROM ev),
 hd AS (SELECT category, age_group, ek.key, kind, h.*, 1990 + h.p % 9 AS y, 1990 + h.p % 9 + CASE WHEN c = 0 THEN h.k % 130 WHEN c = 1 THEN h.k % 13 ELSE c + 10 + CASE WHEN h.k % 7 = 0 THEN 1 ELSE 0 END END AS ry FROM h JOIN x USING (c) JOIN ek USING (c, e) WHERE e % 11 > 0 AND t < 3),
 issues AS (SELECT category, NULL AS event, 'bad_category' AS issue FROM x WHERE gender = 'D' OR age_group = 'X_9' OR c = 7
 UNION ALL SELECT category, NULL, 'repeated_event' FROM x JOIN (SELECT c FROM ek GROUP BY c HAVING count(*) > count(DISTINCT key)) USING (c)
 UNION ALL SELECT category, NULL, 'wrong_unlisted' FROM x WHERE c % 3 = 0
 UNION ALL SELECT category, key, 'bad_event' FROM ek JOIN x USING (c) WHERE e IN (38, 39) UNION ALL SELECT category, key, 'bad_state' FROM ek JOIN x USING (c) WHERE ((kind = 'relay') <> (legs > 1)) OR e = 37
 UNION ALL SELECT DISTINCT category, key, 'bad_evidence' FROM hd WHERE t = 0 OR ry >= 2030 UNION ALL SELECT DISTINCT category, key, 'no_identity' FROM hd WHERE kind <> 'relay' AND s % 17 = 0 UNION ALL SELECT DISTINCT category, key, 'no_name' FROM hd WHERE s % 19 = 0
 UNION ALL SELECT DISTINCT category, key, 'other_name' FROM hd WHERE kind <> 'relay' AND (s % 23 = 0 OR s % 19 = 0 OR s % 17 = 0) UNION ALL SELECT DISTINCT category, key, 'wrong_age' FROM hd WHERE kind <> 'relay' AND NOT (ry - y BETWEEN 0 AND 120 AND CASE age_group WHEN 'X_X' THEN true WHEN 'X_11' THEN ry - y <= 11 WHEN 'X_9' THEN false ELSE ry - y = CAST(split_part(age_group, '_', 1) AS INT) END)
 UNION ALL SELECT category, key, 'holders_not_tied' FROM hd GROUP BY category, key, e HAVING count(DISTINCT t) > 1 UNION ALL SELECT category, key, 'repeated_holder' FROM hd GROUP BY category, key, e HAVING count(*) > count(DISTINCT (t, s, CASE WHEN s % 17 <> 0 THEN p END, y, ry)))
 SELECT DISTINCT * FROM issues""")
def baseline_issues(spark, sf):
    """Categories of ten remainders, each with something of its own wrong; holders are the lines of small quantity."""
    s, p, k, t = (F.col(x) for x in ("l_suppkey", "l_partkey", "l_orderkey", "l_quantity"))
    c, e = s % 10, p % 40
    years = (1990 + p % 9).cast("int")
    age = F.when(c == 0, k % 130).when(c == 1, k % 13).otherwise(c + 10 + F.when(k % 7 == 0, 1).otherwise(0)).cast("int")
    first, last = F.when(s % 17 != 0, F.concat(F.lit("F"), p)), F.concat(F.lit("L"), s)
    full = F.when(s % 19 == 0, " ").when(s % 23 == 0, F.lit("someone else")).otherwise(F.concat(last, F.lit(", "), F.coalesce(first, F.lit("-"))))
    holder = F.struct(full.alias("full_name"), first.alias("first_name"), last.alias("last_name"), years.alias("birth_year"), F.make_date(years + age, F.lit(1), F.lit(2)).alias("date"), t.cast("int").alias("time_cs"))
    lines = V.table(spark, sf, "lineitem").select(c.alias("c"), e.alias("e"), F.when((e % 11 > 0) & (t < 3), holder).alias("h"))
    e = F.col("e")
    kind, legs = F.when(e % 9 == 0, "relay").when(e % 10 == 0, "lap").otherwise("individual"), F.when((e % 9 == 0) & (e != 18), 4).otherwise(1)
    distance, stroke = F.when(e == 39, 0).otherwise(F.element_at(F.array(*map(F.lit, (50, 100, 200, 400))), (e % 4 + 1).cast("int"))), F.element_at(F.array(*map(F.lit, ("FREE", "BACK", "BREAST", "FLY", "IM"))), (e % 5 + 1).cast("int"))
    key = F.concat(F.concat_ws(":", kind, legs, distance, stroke), F.when(e == 38, "?").otherwise(""))
    events = lines.groupBy("c", "e").agg(F.collect_list("h").alias("holders")).withColumn("status", F.when((F.size("holders") > 0) == (e != 37), "ready").otherwise("empty"))
    event = F.struct(key.alias("key"), kind.alias("kind"), legs.alias("legs"), distance.alias("distance"), stroke.alias("stroke"), "status", "holders")
    c = F.col("c")
    course, sex, ages = F.when(c % 2 == 0, "SCM").otherwise("LCM"), F.when(c == 9, "D").otherwise("F"), F.coalesce(F.try_element_at(F.array(*map(F.lit, quality.AGE_GROUPS)), (c + 1).cast("int")), F.lit("X_9"))
    cats = events.groupBy("c").agg(F.collect_list(event).alias("events")).withColumns({"course": course, "gender": sex, "age_group": ages})
    unlisted = F.array_sort(F.array_except(quality.standard_events(F.col("course")), F.transform("events", lambda x: x["key"])))
    cats = cats.withColumns({"key": F.concat(F.concat_ws(":", "course", "gender", "age_group"), F.when(c == 7, "!").otherwise("")), "unlisted": F.when(c % 3 == 0, F.array(F.lit("x"))).otherwise(unlisted), "created_at": F.lit("2029-12-31T10:00:00Z")})
    return quality.baseline_issues(cats)


@query("""WITH r AS (SELECT l_suppkey AS k, l_quantity AS time_cs, l_partkey AS who FROM lineitem), b AS (SELECT k, min(time_cs) AS time_cs FROM r GROUP BY 1), t AS (SELECT DISTINCT k, time_cs, who FROM r JOIN b USING (k, time_cs)), s AS (SELECT DISTINCT k, time_cs, who FROM r WHERE time_cs < 3 AND who % 3 > 0)
 SELECT *, 'not_a_holder' AS issue FROM (SELECT * FROM s EXCEPT SELECT * FROM t) UNION ALL SELECT *, 'not_stated' FROM (SELECT * FROM t EXCEPT SELECT * FROM s)""")
def export_issues(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("time_cs"), F.col("l_partkey").alias("who"))
    return rankings.export_issues(rows, rows.where("time_cs < 3 and who % 3 > 0").distinct(), ["k"], ["who"])


@query("""WITH p AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 1800 ELSE 1985 + o_custkey % 12 END AS b FROM orders)
 SELECT * FROM (SELECT k AS o_orderkey, CASE WHEN k % 11 = 0 THEN 'no_source' WHEN k % 13 = 0 OR k % 17 = 0 THEN 'bad_category' WHEN k % 7 = 0 THEN 'bad_time' WHEN k % 19 = 0 OR d > DATE '1998-06-01' THEN 'bad_date' WHEN b IS NULL OR b <= 1800 OR b > year(d) THEN 'bad_age' WHEN k % 23 = 0 THEN 'no_identity' END AS issue FROM p) WHERE issue IS NOT NULL""")
def performance_issues(spark, sf):
    """Rows with a null or a wrong value where the rules look, one for each remainder."""
    k = F.col("o_orderkey")
    rows = V.table(spark, sf, "orders").select(
        k, F.when(k % 7 == 0, 0).otherwise(100).alias("time_cs"), F.lit(50).alias("distance"), F.when(k % 19 != 0, F.to_date("o_orderdate")).alias("date"), F.when(k % 13 != 0, "LCM").alias("course"), F.lit("F").alias("gender"), F.when(k % 17 == 0, "LAGEN").otherwise("IM").alias("stroke"),
        F.when(k % 29 == 0, None).when(k % 31 == 0, 1800).otherwise(1985 + F.col("o_custkey") % 12).alias("birth_year"), F.when(k % 11 == 0, "x").otherwise(F.sha2("o_orderpriority", 256)).alias("source_sha256"), F.lit("A").alias("first_name"), F.when(k % 23 == 0, " ").otherwise("B").alias("last_name"), F.lit("Cup").alias("meet"),
    )
    return quality.performance_issues(rows, "1998-06-01").select("o_orderkey", "issue")


_PAGES = """n AS (SELECT o_custkey AS key, o_orderkey AS athlete, o_totalprice AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders),
 pg AS (SELECT DISTINCT key, total, k AS o FROM n WHERE k % 3 = 1 AND NOT (key % 8 = 0 AND k = 4)), r AS (SELECT pg.key, pg.o, n.athlete, CASE WHEN pg.key % 5 = 0 AND n.k < pg.o THEN v + 1 ELSE v END AS v FROM pg JOIN n ON n.key = pg.key AND n.k >= least(pg.o, greatest(pg.total - 2, 1)) AND n.k < least(pg.o, greatest(pg.total - 2, 1)) + 3 AND NOT (pg.key % 7 = 0 AND n.k = 2)),
 f AS (SELECT key, athlete, min(o) AS o, count(DISTINCT v) AS vs FROM r GROUP BY ALL)"""


@query(f"WITH {_PAGES} SELECT key, athlete, o AS \"offset\", v FROM r JOIN f USING (key, athlete, o)")
def pages_merged(spark, sf):
    """Each athlete once, although the last page begins before the one before it ends."""
    return rankings.merged_pages(*_page_tables(spark, sf), ["key"], "athlete", 3)[0].select("key", "athlete", F.col("offset").cast("long").alias("offset"), "v")


@query(f"""WITH {_PAGES}, due AS (SELECT DISTINCT key, total, k AS o FROM n WHERE k % 3 = 1), c AS (SELECT key, total, o, (SELECT count(*) FROM r WHERE r.key = due.key AND r.o = due.o) AS n_rows, (SELECT count(*) FROM f WHERE f.key = due.key AND f.o = due.o) AS fresh FROM due WHERE key IN (SELECT key FROM pg))
 SELECT key, NULL AS "offset", 'source_changed' AS issue FROM pg WHERE key % 9 = 0 GROUP BY key HAVING count(*) > 1 UNION ALL SELECT key, o, 'incomplete_page' FROM c WHERE n_rows <> least(3, total)
 UNION ALL SELECT DISTINCT key, o, 'conflicting_overlap' FROM f WHERE vs > 1 UNION ALL SELECT key, o, 'gap_or_duplicate' FROM c WHERE fresh <> least(3, total - o + 1)""")
def page_issues(spark, sf):
    """Lists that changed, lost a page or a row, or contradict themselves where pages overlap."""
    return rankings.merged_pages(*_page_tables(spark, sf), ["key"], "athlete", 3)[1]


def _page_tables(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("key")
    n = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("athlete"), F.col("o_totalprice").alias("v"))
    n = n.withColumns({"k": F.row_number().over(w.orderBy("athlete")), "total": F.count(F.lit(1)).over(w)})
    pages = n.where("k % 3 = 1 and not (key % 8 = 0 and k = 4)").select("key", F.col("k").alias("offset"), "total", F.when(F.col("key") % 9 == 0, F.col("k")).otherwise(0).alias("built"))
    first = F.least("offset", F.greatest(F.col("total") - 2, F.lit(1)))
    rows = pages.select("key", "offset", F.explode(F.sequence(first, first + 2)).alias("k")).join(n.select("key", "k", "athlete", "v"), ["key", "k"]).where("not (key % 7 = 0 and k = 2)")
    rows = rows.withColumn("v", F.when((F.col("key") % 5 == 0) & (F.col("k") < F.col("offset")), F.col("v") + 1).otherwise(F.col("v"))).drop("k")
    return rows, pages


@query("""WITH p AS (SELECT o_custkey AS key, min(CAST(o_orderdate AS DATE)) AS at, count(*) AS total FROM orders GROUP BY 1), r AS (SELECT o_custkey AS key, o_orderkey AS a, o_totalprice AS t FROM orders),
 x AS (SELECT key, a, t, t + CASE WHEN key % 7 = 0 AND a % 2 = 0 THEN 1 ELSE 0 END AS n FROM r), lost AS (SELECT key FROM r WHERE key % 11 = 0 GROUP BY key), same AS (SELECT key FROM p WHERE key % 3 = 0 AND key % 11 <> 0 AND key % 5 <> 0 AND key NOT IN (SELECT key FROM x WHERE n <> t)),
 i AS (SELECT key, 'stale' AS issue FROM p WHERE key % 3 = 0 UNION ALL SELECT key, 'truncated' FROM p WHERE key % 5 = 0 UNION ALL SELECT DISTINCT key, 'regression' FROM x WHERE n > t OR key IN (SELECT key FROM lost))
 SELECT * FROM i WHERE key NOT IN (SELECT key FROM same)""")
def revision_issues(spark, sf):
    """UPS10: new versions that are older, shorter, or take something from an athlete."""
    o = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("athlete_id"), F.col("o_totalprice").alias("time_cs"), F.to_date("o_orderdate").alias("day"))
    old = o.groupBy("key").agg(F.min("day").alias("captured_at"), F.count(F.lit(1)).alias("total"))
    k = F.col("key")
    new = old.withColumns({"captured_at": F.when(k % 3 == 0, F.col("captured_at")).otherwise(F.date_add("captured_at", 1)), "total": F.col("total") - F.when(k % 5 == 0, 1).otherwise(0)})
    rows = o.drop("day")
    first = o.groupBy("key").agg(F.min("athlete_id").alias("athlete_id"))
    slower = F.when((k % 7 == 0) & (F.col("athlete_id") % 2 == 0), F.col("time_cs") + 1).otherwise(F.col("time_cs"))
    return rankings.revision_issues(old, new, rows, rows.withColumn("time_cs", slower).join(first.where("key % 11 = 0"), ["key", "athlete_id"], "left_anti"))


@query("""WITH l AS (SELECT s_suppkey AS id, 'LCM' AS course, 'ok' AS state, s_name AS h FROM supplier WHERE s_suppkey % 5 <> 0), o AS (SELECT s_suppkey AS id, 'LCM' AS course, CASE WHEN s_suppkey % 2 = 0 THEN 'failed' ELSE 'ok' END AS state, CASE WHEN s_suppkey % 2 = 1 THEN s_name || '!' END AS h FROM supplier WHERE s_suppkey % 3 <> 0)
 SELECT coalesce(o.id, l.id) AS record_list_id, coalesce(o.course, l.course) AS course, coalesce(o.state, l.state) AS state, coalesce(o.h, l.h) AS last_good_hash FROM l FULL JOIN o ON l.id=o.id""")
def refresh_health(spark, sf):
    s = V.table(spark, sf, "supplier")
    ledger = s.where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("record_list_id"), F.lit("LCM").alias("course"), F.lit("ok").alias("state"), F.col("s_name").alias("last_good_hash"))
    odd = F.col("s_suppkey") % 2 == 1
    outcomes = s.where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("record_list_id"), F.lit("LCM").alias("course"), F.when(odd, "ok").otherwise("failed").alias("state"), F.when(odd, F.concat("s_name", F.lit("!"))).alias("last_good_hash"))
    return quality.refresh_health(ledger, outcomes)


@query("SELECT 1 AS version, bool_and(p_size > 0) AS seeded, (SELECT count(*) FROM orders WHERE o_orderstatus='P') AS pending, bool_and(p_size > 0) AND (SELECT count(*) FROM orders WHERE o_orderstatus='P') = 0 AS ready FROM part")
def projection_ready(spark, sf):
    contract = V.table(spark, sf, "part").select(F.lit(1).alias("version"), (F.col("p_size") > 0).alias("seeded"))
    return quality.projection_ready(contract, V.table(spark, sf, "orders").where("o_orderstatus = 'P'"))


@query("""WITH n AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS total FROM orders), p AS (SELECT o_custkey, total, k AS o FROM n WHERE k % 3 = 1 AND NOT (o_custkey % 4 = 0 AND k = 4)),
 q AS (SELECT *, least(3, total - o + 1) AS c FROM p), w AS (SELECT *, lag(o + c) OVER (PARTITION BY o_custkey ORDER BY o) AS due, lead(o) OVER (PARTITION BY o_custkey ORDER BY o) IS NULL AS final FROM q)
 SELECT o_custkey, o AS "offset" FROM w WHERE o <> coalesce(due, 1) OR (final AND o + c <> total + 1)""")
def page_breaks(spark, sf):
    """Pages of three orders of each customer; of every fourth customer the second page is lost."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey")
    n = V.table(spark, sf, "orders").select("o_custkey", F.row_number().over(w.orderBy("o_orderkey")).alias("offset"), F.count(F.lit(1)).over(w).alias("total"))
    p = n.where("offset % 3 = 1 and not (o_custkey % 4 = 0 and offset = 4)").withColumn("count", F.least(F.lit(3), F.col("total") - F.col("offset") + 1))
    return rankings.page_breaks(p, ["o_custkey"]).select("o_custkey", F.col("offset").cast("long").alias("offset"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
def payloads_that_differ(spark, sf):
    rows = V.table(spark, sf, "orders").select("o_orderkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"))).alias("payload"))
    return packages.field_differs(rows, "status", "F").select("o_orderkey")


@query("""SELECT l_orderkey AS key, l_partkey AS athlete_id FROM (SELECT l_orderkey, l_partkey, min(l_quantity) AS old, min(l_quantity + CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END) FILTER (WHERE l_linenumber <> 5) AS new FROM lineitem GROUP BY ALL) WHERE new IS NULL OR new > old""")
def athletes_regressed(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("athlete_id"), "l_linenumber", F.col("l_quantity").alias("time_cs"))
    new = rows.where("l_linenumber <> 5").withColumn("time_cs", F.col("time_cs") + F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(0))
    return rankings.athletes_regressed(rows, new).select("key", "athlete_id")
