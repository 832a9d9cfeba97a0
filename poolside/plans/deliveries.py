"""Snapshots of whole meets, dirty keys and batches over the driver's tables, each with its SQL.

Orders are results, customers meets, lines the splits of a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import canonical_json
from ..operators import capture, snapshots
from . import views as V
from .registry import query

_SIG = ", ".join(snapshots.SIGNATURE)
_SAME = " AND ".join(f"i.{c} IS NOT DISTINCT FROM n.{c}" for c in snapshots.SIGNATURE)
#: Meets of some remainders contradict the ledger, the table or themselves, each in one way.
_SNAPSHOTS = f"""o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(12,2)) AS v, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first FROM orders),
b AS (SELECT k, c, v, first, 'M' || c AS meet_key, CASE WHEN c % 25 = 7 THEN 0 ELSE k END AS swimmer_key, CASE WHEN c % 25 = 7 THEN 1 ELSE k % 5 END AS event_key, CASE WHEN k % 3 <> 0 AND c % 25 <> 7 THEN k % 4 END AS heat,
 CASE WHEN c % 25 = 7 THEN DATE '1995-01-01' WHEN k % 13 <> 0 THEN d END AS result_date, 'TIM' AS event_round, k % 11 = 0 AND c % 25 <> 7 AS is_relay, CAST(NULL AS INT) AS relay_count FROM o),
r AS (SELECT k AS id, meet_key, {_SIG}, v AS time_seconds, 'old' AS comment FROM b),
l AS (SELECT CASE WHEN c % 44 = 16 THEN 'B' ELSE 'A' END AS publisher, 'S' || k AS source_id, CASE WHEN c % 28 = 12 THEN 'M' || (c + 1) ELSE meet_key END AS meet_key, CASE WHEN c % 20 = 8 THEN first ELSE k END AS target_id FROM b WHERE k % 2 = 0),
sc AS (SELECT 'A' AS publisher, 'M' || c AS meet_key, min(d) AS start_date FROM o WHERE c % 4 = 0 GROUP BY c),
i AS (SELECT k, 'A' AS publisher, meet_key, CASE WHEN c % 68 = 24 THEN 'X' || c WHEN c % 52 <> 4 OR k <> first THEN 'S' || k END AS source_id, swimmer_key, event_key, heat, result_date, CASE WHEN k % 7 = 0 THEN 'FIN' ELSE event_round END AS event_round, is_relay, relay_count, v + 1 AS time_seconds
 FROM b WHERE c % 4 = 0 AND k % 3 <> 1),
n AS (SELECT meet_key, {_SIG}, min(id) AS sid, count(*) AS times FROM r WHERE meet_key IN (SELECT meet_key FROM sc) GROUP BY ALL),
f AS (SELECT i.*, coalesce(l.target_id, n.sid) AS target FROM i LEFT JOIN l ON l.publisher=i.publisher AND l.source_id=i.source_id LEFT JOIN n ON n.meet_key=i.meet_key AND {_SAME}),
bad AS (SELECT meet_key, 'no_source_id' AS reason FROM i WHERE source_id IS NULL UNION SELECT meet_key, 'repeated_source_id' FROM i WHERE source_id IN (SELECT source_id FROM i GROUP BY 1 HAVING count(*) > 1)
 UNION SELECT meet_key, 'repeated_race' FROM i GROUP BY meet_key, {_SIG} HAVING count(*) > 1 UNION SELECT meet_key, 'ambiguous_stored_race' FROM n WHERE times > 1
 UNION SELECT i.meet_key, 'source_id_of_another_meet' FROM i JOIN l USING (publisher, source_id) WHERE l.meet_key <> i.meet_key UNION SELECT meet_key, 'two_sources_for_one_result' FROM f WHERE target IN (SELECT target FROM f GROUP BY 1 HAVING count(*) > 1)
 UNION SELECT sc.meet_key, 'meet_of_another_publisher' FROM sc JOIN l USING (meet_key) WHERE l.publisher <> sc.publisher),
good AS (SELECT * FROM sc WHERE meet_key NOT IN (SELECT meet_key FROM bad)),
g AS (SELECT f.*, md5(publisher || chr(31) || source_id) AS h FROM f WHERE meet_key IN (SELECT meet_key FROM good)),
top AS (SELECT max(id) AS top FROM (SELECT id FROM r UNION ALL SELECT target_id FROM l)),
named AS (SELECT * REPLACE (target AS target) FROM g WHERE target IS NOT NULL UNION ALL SELECT * REPLACE (top + row_number() OVER (ORDER BY substr(h, 1, 3), publisher, source_id) AS target) FROM g, (SELECT top FROM top) WHERE target IS NULL)"""
_SNAPSHOTS = _SNAPSHOTS.replace("UNION ALL SELECT * REPLACE (top + row_number()", "UNION ALL SELECT g.* REPLACE (top + row_number()")


def _applied(spark, sf) -> snapshots.Applied:
    o = V.table(spark, sf, "orders")
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    first = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"), F.min(F.to_date("o_orderdate")).alias("start_date"))
    day, odd, price = F.to_date("o_orderdate"), c % 25 == 7, F.col("o_totalprice").cast("decimal(12,2)")
    row = [
        k.alias("k"), c.alias("c"), price.alias("v"), F.concat(F.lit("M"), c).alias("meet_key"), F.when(odd, 0).otherwise(k).alias("swimmer_key"), F.when(odd, 1).otherwise(k % 5).alias("event_key"),
        F.when((k % 3 != 0) & ~odd, k % 4).alias("heat"), F.when(odd, F.lit("1995-01-01").cast("date")).when(k % 13 != 0, day).alias("result_date"), F.lit("TIM").alias("event_round"), ((k % 11 == 0) & ~odd).alias("is_relay"), F.lit(None).cast("int").alias("relay_count"),
    ]
    b = o.join(first, "o_custkey").select(*row, "first")
    scopes = first.where("o_custkey % 4 = 0").select(F.lit("A").alias("publisher"), F.concat(F.lit("M"), "o_custkey").alias("meet_key"), "start_date")
    c, k = F.col("c"), F.col("k")
    results = o.select(*row).select(k.alias("id"), "meet_key", *snapshots.SIGNATURE, F.col("v").alias("time_seconds"), F.lit("old").alias("comment"))
    ledger = b.where("k % 2 = 0").select(
        F.when(c % 44 == 16, "B").otherwise("A").alias("publisher"), F.concat(F.lit("S"), k).alias("source_id"), F.when(c % 28 == 12, F.concat(F.lit("M"), c + 1)).otherwise(F.col("meet_key")).alias("meet_key"), F.when(c % 20 == 8, F.col("first")).otherwise(k).alias("target_id"),
    )
    source = F.when(c % 68 == 24, F.concat(F.lit("X"), c)).when((c % 52 != 4) | (k != F.col("first")), F.concat(F.lit("S"), k))
    sent = b.where("c % 4 = 0 and k % 3 <> 1").withColumns({"publisher": F.lit("A"), "source_id": source, "event_round": F.when(k % 7 == 0, "FIN").otherwise(F.col("event_round")), "time_seconds": F.col("v") + 1})
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 50).alias("distance"), F.col("l_extendedprice").alias("time_seconds"), F.col("l_linenumber").alias("split_order"))
    splits = lines.where("split_order <= 3").withColumnRenamed("l_orderkey", "result_id")
    new_splits = lines.where("split_order <= 2").join(sent.select(k.alias("l_orderkey"), "publisher", "source_id"), "l_orderkey").drop("l_orderkey")
    return snapshots.apply_snapshots(results, splits, ledger, scopes, sent.select("publisher", "meet_key", "source_id", *snapshots.SIGNATURE, "time_seconds"), new_splits)


@query(f"""WITH {_SNAPSHOTS} SELECT publisher, source_id, meet_key, target_id FROM l WHERE NOT EXISTS (SELECT 1 FROM good WHERE good.publisher=l.publisher AND good.meet_key=l.meet_key) AND NOT EXISTS (SELECT 1 FROM named WHERE named.publisher=l.publisher AND named.source_id=l.source_id)
 UNION ALL SELECT publisher, source_id, meet_key, target FROM named""")
def snapshot_ids(spark, sf) -> DataFrame:
    """UPS7, J20: the ledger of ids after snapshots: kept, adopted by race, or new."""
    return _applied(spark, sf).ledger


@query(f"""WITH {_SNAPSHOTS} SELECT id, meet_key, event_round, heat, CAST(time_seconds AS DECIMAL(14,2)) AS time_seconds, comment FROM r WHERE meet_key NOT IN (SELECT meet_key FROM good) AND id NOT IN (SELECT target FROM named)
 UNION ALL SELECT named.target, named.meet_key, named.event_round, named.heat, CAST(named.time_seconds AS DECIMAL(14,2)), r.comment FROM named LEFT JOIN r ON r.id=named.target""")
def snapshot_results(spark, sf) -> DataFrame:
    """UPS7: all results after snapshots; what they lack of a meet is gone, columns that they lack are kept."""
    return _applied(spark, sf).results.select("id", "meet_key", "event_round", "heat", F.col("time_seconds").cast("decimal(14,2)").alias("time_seconds"), "comment")


@query(f"""WITH {_SNAPSHOTS}, gone AS (SELECT id FROM r WHERE meet_key IN (SELECT meet_key FROM good) UNION SELECT target FROM named)
 SELECT l_orderkey AS result_id, l_linenumber * 50 AS distance, l_extendedprice AS time_seconds, l_linenumber AS split_order FROM lineitem WHERE l_linenumber <= 3 AND l_orderkey NOT IN (SELECT id FROM gone)
 UNION ALL SELECT target, l_linenumber * 50, l_extendedprice, l_linenumber FROM named JOIN lineitem ON l_orderkey=k WHERE l_linenumber <= 2""")
def snapshot_splits(spark, sf) -> DataFrame:
    """UPS7: all splits after snapshots, under the ids of their results."""
    return _applied(spark, sf).splits


@query(f"""WITH {_SNAPSHOTS}, why AS (SELECT meet_key, string_agg(reason, ',' ORDER BY reason) AS why FROM bad GROUP BY 1), cnt AS (SELECT meet_key, count(*) AS n FROM named GROUP BY 1),
 sp AS (SELECT meet_key, count(*) AS n FROM named JOIN lineitem ON l_orderkey=k WHERE l_linenumber <= 2 GROUP BY 1), del AS (SELECT meet_key, count(*) AS n FROM r WHERE meet_key IN (SELECT meet_key FROM good) AND id NOT IN (SELECT target FROM named) GROUP BY 1),
 days AS (SELECT meet_key, CASE WHEN count(*) = count(d) THEN min(d) END AS d FROM (SELECT meet_key, result_date AS d FROM r UNION ALL SELECT meet_key, result_date FROM named) GROUP BY 1)
 SELECT sc.publisher, sc.meet_key, coalesce(why, 'applied') AS status, coalesce(cnt.n, 0) AS results, coalesce(sp.n, 0) AS splits, coalesce(del.n, 0) AS deleted, CASE WHEN why IS NULL THEN days.d END AS affected_from
 FROM sc LEFT JOIN why USING (meet_key) LEFT JOIN cnt USING (meet_key) LEFT JOIN sp USING (meet_key) LEFT JOIN del USING (meet_key) LEFT JOIN days USING (meet_key)""")
def snapshot_report(spark, sf) -> DataFrame:
    """UPS7, A10: what became of each snapshot, and from when on summaries are affected."""
    return _applied(spark, sf).report


# --- what readers get, and what they must fetch again -------------------------------------

_PAYLOAD = """sp AS (SELECT l_orderkey, string_agg('{"distance":' || l_linenumber * 50 || ',"order":' || l_linenumber || ',"time_seconds":"' || CAST(l_extendedprice AS DECIMAL(10,2)) || '"}', ',' ORDER BY l_linenumber, l_linenumber * 50, l_partkey, l_suppkey) AS s FROM lineitem GROUP BY 1),
p AS (SELECT o.*, n_name AS meet, n_regionkey AS pool, p_size, p_type, p_partkey, sp.s, CAST(o_totalprice AS DECIMAL(10,2)) AS v, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'P' THEN '"DSQ"' ELSE 'null' END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS heat FROM orders o JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = o_custkey % 25 JOIN part ON p_partkey = o_orderkey % 300 + 1 LEFT JOIN sp ON l_orderkey = o_orderkey)"""
_COURSE = "CASE WHEN p_partkey % 3 > 0 THEN CAST((p_partkey % 3) * 25 AS VARCHAR) WHEN pool > 0 THEN CAST(pool * 25 AS VARCHAR) ELSE 'null' END"


def _tables(spark, sf) -> dict[str, DataFrame]:
    """Orders as results, lines as splits, nations as meets, parts as events, customers as swimmers."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    none = lambda kind: F.lit(None).cast(kind)
    lines = V.table(spark, sf, "lineitem")
    return {
        "results": V.table(spark, sf, "orders").select(
            k.alias("id"), c.alias("swimmer_id"), (c % 25).alias("meet_id"), (k % 300 + 1).alias("event_id"), F.col("o_totalprice").cast("decimal(10,2)").alias("time_seconds"), F.to_date("o_orderdate").alias("result_date"), F.when(F.col("o_orderstatus") == "P", "DSQ").alias("status"),
            (k % 1000).cast("int").alias("points_fina"), none("int").alias("points_rudolph"), F.lit("+0.70").alias("reaction_time"), F.when(k % 3 != 0, k % 7).cast("int").alias("heat"), F.lit(4).alias("lane"), F.lit("TIM").alias("event_round"), F.lit(False).alias("is_relay"), none("int").alias("relay_count"),
        ),
        "splits": lines.select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("id"), F.col("l_orderkey").alias("result_id"), (F.col("l_linenumber") * 50).alias("distance"), F.col("l_extendedprice").cast("decimal(10,2)").alias("time_seconds"), F.col("l_linenumber").alias("split_order"), "l_partkey", "l_suppkey"),
        "meets": V.table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("meet_id"), F.concat(F.lit("Cup "), "n_name").alias("name"), none("string").alias("city"), F.lit("SUI").alias("country_code"), (F.col("n_regionkey") * 25).alias("pool_length")),
        "events": V.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("distance"), F.col("p_type").alias("stroke"), F.lit("F").alias("gender"), ((F.col("p_partkey") % 3) * 25).cast("int").alias("pool_length")),
        "swimmers": V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("swimmer_id"), F.col("c_acctbal").alias("balance")),
    }


@query(f"""WITH {_PAYLOAD} SELECT o_orderkey AS id, '{{"category":"F","course":' || {_COURSE} || ',"distance":' || p_size || ',"is_relay":false,"meet_key":"' || meet || '","payload":{{"date":"' || d || '","heat":' || heat || ',"is_relay":false,"lane":4,"meet":{{"city":null,"country":"SUI","key":"' || meet || '","name":"Cup ' || meet || '"}},"points":' || (o_orderkey % 1000)
 || ',"points_rudolph":null,"reaction_time":"+0.70","relay_count":null,"round":"TIM","splits":[' || coalesce(s, '') || '],"status":' || status || ',"time_seconds":"' || v || '"}},"points":' || (o_orderkey % 1000) || ',"race_date":"' || d || '","source_key":"[\\"t\\", \\"' || meet || '\\", ' || o_orderkey || ']","source_result_id":' || o_orderkey
 || ',"status":' || status || ',"stroke":"' || p_type || '","swimmer_key":"' || (SELECT c_name FROM customer WHERE c_custkey = o_custkey) || '","time_hundredths":' || CAST(v * 100 AS INT) || '}}' AS payload FROM p""")
def result_payloads(spark, sf) -> DataFrame:
    """The payload of each result as readers get it, as canonical JSON."""
    t = _tables(spark, sf)
    splits = t["splits"].withColumn("id", F.struct("l_partkey", "l_suppkey"))
    out = capture.payloads(t["results"], t["swimmers"], t["meets"], t["events"], splits, "t")
    return out.select("id", canonical_json(F.col("payload"), out.schema["payload"].dataType).alias("payload"))


_KIDS = "k AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY ALL)"


@query(f"""WITH {_KIDS} SELECT o_orderkey AS id FROM orders WHERE (o_orderkey % 97 = 0) <> (o_orderkey % 89 = 0) OR (o_orderkey % 83 = 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0) UNION SELECT k FROM k WHERE n = 1 AND k % 31 = 0 UNION SELECT k FROM k WHERE n = 2 AND k % 37 = 0
 UNION SELECT k FROM k WHERE n = 3 AND k % 41 = 0 UNION SELECT k + 1 FROM k WHERE n = 3 AND k % 41 = 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 97 <> 0 AND (o_custkey % 25 = 3 OR o_orderkey % 300 + 1 IN (SELECT p_partkey FROM part WHERE p_partkey % 211 = 0) OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 301 = 0))""")
def captured_keys(spark, sf) -> DataFrame:
    """UPS14: dirty results after changes of all five tables; null statuses and other swimmer columns change nothing."""
    t = _tables(spark, sf)
    lines = t["splits"].groupBy("result_id", "split_order").agg(F.min("l_partkey").alias("p"))
    splits = lines.select(F.concat_ws("-", "result_id", "split_order").alias("id"), "result_id", "split_order", "p")
    k, n = F.col("result_id"), F.col("split_order")
    old = t | {"results": t["results"].where("id % 89 <> 0"), "splits": splits}
    price = F.when(F.col("id") % 83 == 0, F.col("time_seconds") + 1).otherwise(F.col("time_seconds")).cast("decimal(10,2)")
    moved = splits.where(~((n == 2) & (k % 37 == 0))).withColumns({"p": F.when((n == 1) & (k % 31 == 0), -1 - F.col("p")).otherwise(F.col("p")), "result_id": F.when((n == 3) & (k % 41 == 0), k + 1).otherwise(k)})
    new = {
        "results": t["results"].where("id % 97 <> 0").withColumn("time_seconds", price), "splits": moved, "meets": t["meets"].where("id <> 5").withColumn("city", F.when(F.col("id") == 3, "Bern")),
        "events": t["events"].withColumn("distance", F.when(F.col("id") % 211 == 0, -1).otherwise(F.col("distance"))),
        "swimmers": t["swimmers"].withColumns({"balance": F.col("balance") + 1, "swimmer_id": F.when(F.col("id") % 301 == 0, F.concat("swimmer_id", F.lit("!"))).otherwise(F.col("swimmer_id"))}),
    }
    return capture.captured(old, new)
