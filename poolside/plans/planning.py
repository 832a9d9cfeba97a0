"""Plans for live results over the driver's tables, each with its SQL.

Orders are source rows and stored results, customers swimmers; every fiftieth remainder is a meet.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical as C
from ..operators import planning
from ..sources.shared import settled
from . import views as V
from .registry import query

_RACE = """sha256('["' || {who} || '", "' || {number} || '", "' || d || '", "TIM", false]')"""
_PAYLOAD = """sha256('{"heat":' || coalesce(CAST(heat AS VARCHAR), 'null') || ',"status":' || CASE WHEN status IS NULL THEN 'null' ELSE '"' || status || '"' END || ',"time_seconds":"' || v || '"}')"""
_SEVERE = ", ".join(f"'{r}'" for r in planning.SEVERE)
_PLAN = f"""base AS (SELECT o_orderkey AS k, o_custkey AS c, o_custkey % 50 AS live_id, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 41 = 0 THEN 0 WHEN o_orderkey % 43 = 0 THEN -1 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS v, CASE WHEN o_orderkey % 82 = 0 THEN 'DSQ' WHEN o_orderkey % 19 = 0 THEN 'DNS' END AS status,
 CASE WHEN o_orderkey % 5 = 0 THEN 'pdf' ELSE 'lenex' END AS kind, CASE WHEN o_custkey % 17 = 0 THEN 'zz' ELSE 'f' || (o_custkey % 40) END AS f, 'L' || (o_custkey % 25) AS l, 1990 + o_custkey % 5 AS y, 'N' || (o_custkey // 600 % 2) AS nation, CASE WHEN o_orderkey % 2 = 0 THEN 'a' || o_custkey END AS athlete,
 'e' || (o_orderkey % 20) AS number, (o_orderkey % 4 + 1) * 50 AS distance, CASE WHEN o_orderkey % 6 > 0 THEN o_orderkey % 6 END AS heat FROM orders),
src AS (SELECT 2 * k AS row_no, * FROM base UNION ALL SELECT 2 * k + 1, * FROM base WHERE k % 23 = 0),
sw AS (SELECT c_custkey AS id, 'W' || c_custkey AS swimmer, 'f' || (c_custkey % 40) AS f, 'L' || (c_custkey % 25) AS l, 1990 + c_custkey % 5 AS y, 'N' || (c_custkey // 600 % 2) AS country FROM customer),
fx AS (SELECT c AS fc, min(id) AS fixed FROM (SELECT DISTINCT c, f, l, y FROM base WHERE c % 29 = 0) JOIN sw USING (f, l, y) GROUP BY 1),
cand AS (SELECT row_no, count(*) AS n, min(id) AS any_id, count(*) FILTER (WHERE hit) AS hits, min(id) FILTER (WHERE hit) AS own FROM (SELECT row_no, id, kind = 'lenex' AND athlete = 'a' || id AND id % 3 = 0 AND country = nation AS hit FROM src JOIN sw USING (f, l, y) WHERE kind = 'pdf' OR country = nation) GROUP BY 1),
i AS (SELECT src.*, CASE WHEN fixed IS NOT NULL OR hits = 1 THEN 1 ELSE coalesce(n, 0) END AS candidates, CASE WHEN fixed IS NOT NULL THEN fixed WHEN hits = 1 THEN own WHEN n = 1 THEN any_id END AS pk FROM src LEFT JOIN cand USING (row_no) LEFT JOIN fx ON fc = c),
w AS (SELECT i.*, coalesce(swimmer, 'CANON::' || substr(sha1(nation || '|F|' || i.y || '|' || i.f || '|' || i.l), 1, 32)) AS who FROM i LEFT JOIN sw ON id = pk),
ks AS (SELECT *, {_RACE.format(who="who", number="number")} AS race_key, {_PAYLOAD} AS payload_hash FROM w),
led AS (SELECT live_id, CASE WHEN k % 24 = 0 THEN {_RACE.format(who="('W' || c)", number="'old'")} WHEN k % 28 = 0 THEN 'other' || k ELSE {_RACE.format(who="('W' || c)", number="number")} END AS race_key, k AS result_id, number, d, CASE WHEN k % 8 = 0 THEN 'pdf' ELSE 'lenex' END AS kind, CASE WHEN k % 16 = 0 THEN {_PAYLOAD} ELSE 'x' END AS hash, f, l, y FROM base WHERE k % 4 = 0 AND k % 23 <> 0),
ev AS (SELECT * FROM (VALUES (1, 50), (2, 100), (3, 150)) t(event_id, distance)),
st AS (SELECT live_id, k AS id, c AS pk, event_id, d, CASE WHEN k % 4 > 0 THEN k % 6 END AS heat, k % 10 = 0 OR k % 7 = 0 AS rich FROM base LEFT JOIN ev USING (distance) WHERE k % 3 < 2 UNION ALL SELECT live_id, k + 1000000000, c, event_id, d, CASE WHEN k % 4 > 0 THEN k % 6 END, false FROM base LEFT JOIN ev USING (distance) WHERE k % 33 = 0),
e1 AS (SELECT ks.*, CASE WHEN NOT (v > 0 OR (v = 0 AND kind = 'lenex' AND coalesce(status, '') IN ('DNS', 'DSQ'))) THEN 'invalid_time' WHEN candidates > 1 THEN 'ambiguous_identity' WHEN candidates = 0 AND kind = 'pdf' THEN 'unknown_identity'
 WHEN kind = 'lenex' AND EXISTS (SELECT 1 FROM led WHERE led.kind = 'pdf' AND led.live_id = ks.live_id AND led.number = ks.number AND led.d = ks.d AND led.f = ks.f AND led.l = ks.l AND led.y = ks.y AND led.race_key <> ks.race_key) THEN 'lenex_identity_needs_review' END AS early FROM ks),
e2 AS (SELECT e1.*, CASE WHEN early IS NULL THEN count(*) OVER (PARTITION BY live_id, race_key, early IS NULL) END AS times, CASE WHEN early IS NULL THEN row_number() OVER (PARTITION BY live_id, race_key, early IS NULL ORDER BY row_no) END AS nth, led.result_id AS receipt, led.hash, led.kind AS was, event_id FROM e1 LEFT JOIN led USING (live_id, race_key) LEFT JOIN ev USING (distance)),
pos AS (SELECT row_no, count(*) AS found, min(st.id) AS old, min_by(rich, st.id) AS rich FROM e2 JOIN st ON st.live_id = e2.live_id AND st.pk = e2.pk AND st.event_id = e2.event_id AND st.d = e2.d WHERE early IS NULL AND CASE WHEN receipt IS NOT NULL THEN st.id = receipt WHEN e2.kind = 'lenex' AND e2.heat IS NOT NULL THEN st.heat IS NOT DISTINCT FROM e2.heat ELSE true END GROUP BY 1),
e3 AS (SELECT e2.*, coalesce(found, 0) AS found, old, rich, e2.kind = 'pdf' AND coalesce(found, 0) = 1 AND (receipt IS NULL OR was = 'lenex' OR rich) AS guarded, EXISTS (SELECT 1 FROM led WHERE led.live_id = e2.live_id AND led.result_id = old) AS taken FROM e2 LEFT JOIN pos USING (row_no)),
pl AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN nth > 1 THEN 'ambiguous_source_race' WHEN receipt IS NOT NULL AND found <> 1 THEN 'receipt_result_mismatch' WHEN found > 1 THEN 'ambiguous_existing_race' WHEN found = 1 AND receipt IS NULL AND taken THEN 'event_number_or_identity_changed' WHEN times > 1 THEN 'ambiguous_source_race' END AS reason FROM e3),
plan AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'held' WHEN guarded THEN 'protected' WHEN receipt IS NOT NULL AND hash = payload_hash THEN 'unchanged' WHEN found = 1 THEN 'update' ELSE 'insert' END AS action FROM pl),
lost AS (SELECT live_id, race_key FROM led WHERE EXISTS (SELECT 1 FROM plan p WHERE p.live_id = led.live_id AND p.number = led.number AND p.d = led.d AND p.reason IS DISTINCT FROM 'invalid_time') AND NOT EXISTS (SELECT 1 FROM plan p WHERE p.live_id = led.live_id AND p.race_key = led.race_key AND p.early IS NULL))"""


def _plan(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    swimmer = lambda c: [F.concat(F.lit("L"), c % 25).alias("last_name"), (1990 + c % 5).cast("int").alias("birth_year"), F.lit("F").alias("gender")]
    block = lambda c: F.concat(F.lit("N"), (F.floor(c / 600) % 2).cast("string"))
    price = F.when(k % 41 == 0, 0).when(k % 43 == 0, -1).otherwise(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(12,2)")
    base = V.table(spark, sf, "orders").select(
        k, c, (c % 50).alias("live_id"), F.to_date("o_orderdate").alias("event_date"), price.alias("time_seconds"), F.when(k % 82 == 0, "DSQ").when(k % 19 == 0, "DNS").alias("status"), F.when(k % 5 == 0, "pdf").otherwise("lenex").alias("source_kind"),
        F.when(c % 17 == 0, "zz").otherwise(F.concat(F.lit("f"), c % 40)).alias("first_name"), *swimmer(c), block(c).alias("nation"), F.when(k % 2 == 0, F.concat(F.lit("a"), c)).alias("athlete_id"), F.when(c % 29 == 0, F.concat(F.lit("club "), c)).alias("club"),
        F.concat(F.lit("e"), k % 20).alias("event_number"), F.lit("TIM").alias("event_round"), F.lit(False).alias("is_relay"), ((k % 4 + 1) * 50).alias("distance"), F.lit("FREE").alias("stroke"), F.lit("F").alias("event_gender"), F.lit(50).alias("pool_length"), F.when(k % 6 > 0, k % 6).alias("heat"),
    )
    rows = base.withColumn("row_no", 2 * k).unionByName(base.where("o_orderkey % 23 = 0").withColumn("row_no", 2 * k + 1))
    custs = V.table(spark, sf, "customer")
    known = F.col("c_custkey")
    swimmers = custs.select(known.alias("id"), F.concat(F.lit("W"), known).alias("swimmer_id"), F.concat(F.lit(" F"), known % 40).alias("first_name"), *swimmer(known), block(known).alias("country_code"))
    aliases = custs.where("c_custkey % 3 = 0").select(block(known).alias("source_country_code"), F.concat(F.lit("a"), known).alias("source_swimmer_id"), known.alias("swimmer_pk"))
    events = spark.createDataFrame([(1, 50), (2, 100), (3, 150)], "id int, distance long").select("id", "distance", F.lit("FREE").alias("stroke"), F.lit("F").alias("event_gender"), F.lit(50).alias("pool_length"))
    at = base.join(F.broadcast(events.select(F.col("id").alias("event_id"), "distance")), "distance", "left")
    own = [k.alias("id"), "live_id", c.alias("swimmer_id"), "event_id", F.when(k % 4 > 0, k % 6).alias("heat"), F.col("event_date").alias("result_date"), F.when(k % 2 == 0, "TIM").alias("event_round"), F.lit(None).cast("boolean").alias("is_relay"), F.when(k % 10 == 0, "+0.71").alias("reaction_time"), (k % 7 == 0).alias("has_splits")]
    more = at.where("o_orderkey % 33 = 0").select(*own).withColumns({"id": F.col("id") + 1_000_000_000, "reaction_time": F.lit(None).cast("string"), "has_splits": F.lit(False)})
    results = at.where("o_orderkey % 3 < 2").select(*own).unionByName(more)
    payload = ["time_seconds", "heat", "status"]
    key = lambda number: C.race_key(F.concat(F.lit("W"), c), number, F.col("event_date"), F.col("event_round"), F.col("is_relay"))
    race = F.when(k % 24 == 0, key(F.lit("old"))).when(k % 28 == 0, F.concat(F.lit("other"), k)).otherwise(key(F.col("event_number")))
    told = base.where("o_orderkey % 4 = 0 and o_orderkey % 23 <> 0")
    ledger = told.select(
        "live_id", race.alias("race_key"), k.alias("result_id"), "event_number", "event_date", "event_round", F.when(k % 8 == 0, "pdf").otherwise("lenex").alias("source_kind"), F.when(k % 16 == 0, C.digest_of(C.canonical_rows(base, payload))).otherwise("x").alias("payload_hash"), "first_name", "last_name", "birth_year", "gender",
    )
    reviewed = base.where("club IS NOT NULL").select(*planning._WHO[2:], "first_name", "last_name", "club").distinct()
    who = ["_f", "last_name", "birth_year", "gender"]
    least = swimmers.withColumn("_f", F.trim(F.lower("first_name"))).groupBy(*who).agg(F.min("id").alias("id"))
    reviewed = reviewed.withColumn("_f", F.trim(F.lower("first_name"))).join(least, who)
    reviewed = reviewed.withColumn("identity_key", C.identity_key(*(F.col(x) for x in ("first_name", "last_name", "birth_year", "gender", "club")))).groupBy("identity_key").agg(F.min("id").alias("swimmer_pk"))
    return planning.build_plan(rows, payload, swimmers, aliases, events, results, ledger, reviewed), ledger


def _settled_plan(spark, sf):
    """What missing races and the gate, which read the plan several times, need of it."""
    plan, ledger = _plan(spark, sf)
    return settled(plan.select("live_id", *planning.EVENT, "race_key", "reason", "reached")), ledger


@query(f"WITH {_PLAN} SELECT row_no, who AS swimmer_key, race_key, action, reason, CASE WHEN action <> 'held' THEN old END AS result_id FROM plan")
def live_plan(spark, sf):
    """UPS3, UPS4: action or reason of each source row."""
    return _plan(spark, sf)[0].select("row_no", "swimmer_key", "race_key", "action", "reason", "result_id")


@query(f"WITH {_PLAN} SELECT live_id, race_key FROM lost")
def live_plan_missing(spark, sf):
    """U4: races of an earlier import that their event has no more."""
    return planning.missing_races(*_settled_plan(spark, sf))


@query(f"""WITH {_PLAN}, n AS (SELECT live_id, count(*) FILTER (WHERE reason IS NULL) AS entries, count(*) FILTER (WHERE reason IS NOT NULL) AS held, count(*) FILTER (WHERE reason IN ({_SEVERE})) AS severe FROM plan GROUP BY 1), x AS (SELECT live_id, count(*) AS lost FROM lost GROUP BY 1),
 h AS (SELECT live_id, entries, severe, coalesce(lost, 0) AS lost, held + CASE WHEN lost > 0 THEN 1 ELSE 0 END AS holds FROM n LEFT JOIN x USING (live_id))
 SELECT live_id, entries, holds, CASE WHEN severe > 0 OR lost > 0 THEN 'refused' WHEN entries = 0 THEN 'empty' ELSE 'apply' END AS verdict, CASE WHEN holds > 0 THEN 'held' WHEN entries = 0 THEN 'empty' ELSE 'apply' END AS strict FROM h""")
def live_plan_gate(spark, sf):
    """UPS6: which meets may be applied, with holds allowed and without."""
    plan, ledger = _settled_plan(spark, sf)
    missing = planning.missing_races(plan, ledger)
    strict = planning.gate(plan, missing).select("live_id", F.col("verdict").alias("strict"))
    return planning.gate(plan, missing, allow_held=True).join(strict, "live_id")


_NESTED = T.StructType([T.StructField("name", T.StringType()), T.StructField("at", T.StructType([T.StructField("nation", T.IntegerType()), T.StructField("balance", T.DecimalType(12, 2))])), T.StructField("keys", T.ArrayType(T.LongType()))])


@query("""SELECT c_custkey, sha256('{"at":{"balance":"' || CAST(c_acctbal AS DECIMAL(12,2)) || '","nation":' || CASE WHEN c_custkey % 7 = 0 THEN 'null' ELSE CAST(c_nationkey AS VARCHAR) END || '},"keys":[' || c_custkey || ',null],"name":"é\\"' || c_name || '\\n"}') AS digest,
 '["t", "' || c_name || '", ' || c_custkey || ']' AS source_key FROM customer""")
def canonical_digests(spark, sf):
    """FN20, FN22: digests of nested rows, whatever the order of their fields."""
    c = V.table(spark, sf, "customer")
    at = F.struct(F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).cast("int").alias("nation"), F.col("c_acctbal").cast("decimal(12,2)").alias("balance"))
    row = F.struct(F.concat(F.lit('é"'), F.col("c_name"), F.lit("\n")).alias("name"), at.alias("at"), F.array(F.col("c_custkey"), F.lit(None).cast("long")).alias("keys"))
    return c.select("c_custkey", C.digest_of(C.canonical_json(row, _NESTED)).alias("digest"), C.source_key("t", F.col("c_name"), F.col("c_custkey")).alias("source_key"))


@query("""SELECT c_custkey, sha256('["f' || (c_custkey % 40) || '", "l\\u00e9", ' || (1990 + c_custkey % 5) || ', "F", ' || CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '"' || c_name || '"' END || ']') AS identity_key,
 sha256('{"birth_year":' || (1990 + c_custkey % 5) || ',"city":null,"course":"LCM","date":"1998-0' || (c_custkey % 9 + 1) || '-01","distance":50,"first_name":"f' || (c_custkey % 40) || '","gender":"F","heat":"","last_name":"le","meet":"Äpfel","meet_country":"SUI","round":"TIM","stroke":"FREE","time_cs":' || c_custkey || '}') AS performance_key FROM customer""")
def identity_keys(spark, sf):
    """FN22: keys of identities and performances."""
    k = F.col("c_custkey")
    c = V.table(spark, sf, "customer").select(
        k, F.concat(F.lit(" F"), k % 40).alias("first_name"), F.lit("Lé").alias("last_name"), (1990 + k % 5).alias("birth_year"), F.lit("F").alias("gender"), F.when(k % 3 != 0, F.col("c_name")).alias("club"), F.concat(F.lit("1998-0"), k % 9 + 1, F.lit("-01")).cast("date").alias("date"),
        k.alias("time_cs"), F.lit("LCM").alias("course"), F.lit(50).alias("distance"), F.lit("FREE").alias("stroke"), F.lit("Äpfel").alias("meet"), F.lit(None).cast("string").alias("city"), F.lit("SUI").alias("meet_country"), F.lit("TIM").alias("round"), F.lit("").alias("heat"),
    )
    return c.select(k, C.identity_key(*(F.col(x) for x in ("first_name", "last_name", "birth_year", "gender", "club"))).alias("identity_key"), C.performance_key().alias("performance_key"))

