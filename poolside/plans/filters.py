"""Queries of scalar functions, predicates and joins over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import match, quality, rankings, resolve
from ..sources import files
from ..sources import pages as html
from . import views as V
from .registry import query

_DAY = "CAST(o_orderdate AS DATE)"
_BIRTH = "DATE '1980-01-01' + CAST(o_custkey * 37 % 6000 AS INT)"
_EXACT = f"year({_DAY}) - year({_BIRTH}) - CASE WHEN o_orderkey % 2 = 1 AND month({_DAY}) * 100 + day({_DAY}) < month({_BIRTH}) * 100 + day({_BIRTH}) THEN 1 ELSE 0 END"


def _orders(spark, sf):
    birth = F.date_add(F.lit("1980-01-01").cast("date"), (F.col("o_custkey") * 37 % 6000).cast("int"))
    mode = F.when(F.col("o_orderkey") % 2 == 0, "YEAR").otherwise("DATE")
    return V.table(spark, sf, "orders").withColumns({"day": F.to_date("o_orderdate"), "birth": birth, "mode": mode})


@query(f"SELECT o_orderkey, CAST({_EXACT} AS INT) AS age FROM orders WHERE {_EXACT} IN (8, 11, 14, 17)")
def ages_at_meet(spark, sf):
    age = S.age_on(F.col("day"), F.col("mode"), F.col("birth"))
    return _orders(spark, sf).where(P.of_ages(age, [8, 11, 14, 17])).select("o_orderkey", age.alias("age"))


@query(f"SELECT o_orderkey, CAST(year({_DAY}) - year({_BIRTH}) AS INT) AS calendar, CAST(least(19, greatest(8, year({_DAY}) - year({_BIRTH}))) AS INT) AS clamped, CASE WHEN {_DAY} > DATE '1998-06-30' THEN 'upcoming' WHEN {_DAY} + 30 >= DATE '1998-06-30' THEN 'ongoing' ELSE 'ended_unverified' END AS state FROM orders")
def calendar_ages(spark, sf):
    age = S.calendar_age(F.col("day"), F.year("birth"))
    state = S.schedule_state(F.lit("1998-06-30").cast("date"), F.col("day"), F.date_add("day", 30))
    return _orders(spark, sf).select("o_orderkey", age.alias("calendar"), S.clamped_age(age).alias("clamped"), state.alias("state"))


@query("SELECT c_custkey FROM customer WHERE lower(c_mktsegment)='furniture' OR (c_nationkey=3 AND c_custkey % 2 = 0)")
def club_members(spark, sf):
    c = V.table(spark, sf, "customer")
    return c.where(P.of_club(S.folded_name(F.col("c_mktsegment")), F.col("c_custkey") % 2, F.col("c_nationkey"), ["furniture"], 0, 3)).select("c_custkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE (l_linenumber <> 1 OR l_suppkey % 3 <> 0) AND l_suppkey % 4 <> 0 AND l_partkey % 5 <> 0 AND l_quantity >= 10""")
def usable_rows(spark, sf):
    rows = V.table(spark, sf, "lineitem")
    first, last = F.when(F.col("l_linenumber") != 1, "a"), F.when(F.col("l_suppkey") % 3 != 0, "b")
    ok = P.usable(first, last, F.when(F.col("l_suppkey") % 4 != 0, 1990), F.when(F.col("l_partkey") % 5 != 0, 1), F.when(F.col("l_quantity") >= 10, F.col("l_quantity")))
    return rows.where(ok).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


_STATUS = "CASE l_suppkey % 5 WHEN 0 THEN 'DSQ' WHEN 1 THEN ' ' WHEN 2 THEN 'dns' WHEN 3 THEN 'EXH' END"
_TIME = "CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice ELSE 0 END"


def _timed(spark, sf):
    status = F.expr(_STATUS).alias("status")
    return V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", status, F.expr(_TIME).alias("time_seconds"))


@query(f"""WITH t AS (SELECT *, {_STATUS} AS status, {_TIME} AS s FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, s > 0 AS timed,
 coalesce(s > 0 OR (upper(status) IN ('DNS','DSQ') AND s = 0), FALSE) AS accepted, (status IS NULL OR trim(status)='') AND s > 0 AS rankable FROM t""")
def status_rules(spark, sf):
    s, t = F.col("status"), F.col("time_seconds")
    return _timed(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", P.timed_relay(t).alias("timed"), P.acceptable_status(s, t).alias("accepted"), P.rankable(s, t).alias("rankable"))


@query(f"""WITH t AS (SELECT *, {_STATUS} AS status, {_TIME} AS s, CASE WHEN l_linenumber <> 6 THEN CAST(l_quantity AS INT) % 3 END AS g FROM lineitem), r AS (SELECT *, (status IS NULL OR trim(status)='') AND s > 0 AS ok FROM t)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN ok AND g IS NOT NULL THEN rank() OVER (PARTITION BY l_suppkey, l_partkey % 10, g, ok ORDER BY s) END AS age_group_rank FROM r""")
def age_group_ranks(spark, sf):
    group = F.when(F.col("l_linenumber") != 6, F.col("l_quantity").cast("int") % 3)
    rows = _timed(spark, sf).withColumns({"meet_id": F.col("l_suppkey"), "event_id": F.col("l_partkey") % 10, "age_group_id": group})
    return rankings.age_group_ranks(rows).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("age_group_rank").cast("long").alias("age_group_rank"))


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1997-01-15', DATE '1998-03-02', DATE '1996-07-04')")
def selected_days(spark, sf):
    return _orders(spark, sf).where(P.on_selected_days(F.col("day"), ["1997-01-15", "1998-03-02", "1996-07-04"])).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def not_loaded(spark, sf):
    ledger = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return P.not_loaded(V.table(spark, sf, "customer"), ledger, ["c_custkey"]).select("c_custkey")


@query(f"SELECT o_orderkey FROM orders WHERE {_DAY} <= DATE '1998-01-01' AND year({_BIRTH}) > 1800 AND year({_BIRTH}) <= year({_DAY})")
def plausible_rows(spark, sf):
    return _orders(spark, sf).where(P.plausible(F.col("day"), F.lit("1998-01-01").cast("date"), F.year("birth"))).select("o_orderkey")


@query("SELECT p_partkey, kind IN ('national', 'age') AS compared, kind = 'unmapped' AS review FROM (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'national' WHEN 'SMALL' THEN 'age' WHEN 'LARGE' THEN 'world' ELSE 'unmapped' END AS kind FROM part)")
def compared_scopes(spark, sf):
    kind = F.expr("CASE p_type WHEN 'PROMO' THEN 'national' WHEN 'SMALL' THEN 'age' WHEN 'LARGE' THEN 'world' ELSE 'unmapped' END")
    return V.table(spark, sf, "part").select("p_partkey", P.comparable_scope(kind).alias("compared"), P.needs_review(kind).alias("review"))


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_STATUS} AS status, p_type, p_size FROM lineitem JOIN part ON l_partkey=p_partkey)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM t WHERE p_type <> 'MEDIUM' AND coalesce(CASE WHEN p_size % 3 > 0 THEN p_size % 3 END, 1) = 1 AND p_size % 2 = l_linenumber % 2 AND (status IS NULL OR trim(status)='')""")
def individual_events(spark, sf):
    rows = _timed(spark, sf).join(V.events(spark, sf).withColumnRenamed("event_id", "l_partkey"), "l_partkey")
    size = F.col("distance")
    ok = P.individual_event(F.col("stroke"), F.when(size % 3 > 0, size % 3), size % 2, F.col("l_linenumber") % 2, F.col("status"))
    return rows.where(ok).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7)")
def with_seventh_line(spark, sf):
    keys = V.table(spark, sf, "lineitem").where("l_linenumber = 7").select(F.col("l_orderkey").alias("o_orderkey"))
    return match.semi(V.table(spark, sf, "orders"), keys, ["o_orderkey"]).select("o_orderkey")


@query("""WITH p AS (SELECT user_id, event_id, event_id % 40 AS who FROM events), a AS (SELECT DISTINCT user_id, event_id % 25 AS who FROM events WHERE event_type <> 'error')
 SELECT event_id, a.who IS NOT NULL AS known FROM p LEFT JOIN a USING (user_id, who)""")
def relay_members(spark, sf):
    e = V.table(spark, sf, "events").withColumn("file_name", F.col("user_id"))
    positions = e.select("file_name", "event_id", (F.col("event_id") % 40).alias("athlete_id"))
    athletes = e.where("event_type <> 'error'").select("file_name", (F.col("event_id") % 25).alias("athlete_id")).distinct()
    known, unknown = resolve.relay_members(positions, athletes)
    return known.select("event_id", F.lit(True).alias("known")).unionByName(unknown.select("event_id", F.lit(False).alias("known")))


@query("""WITH s AS (SELECT p_partkey AS event_id, p_size AS size, p_type AS kind, CASE WHEN p_partkey % 3 > 0 THEN DATE '1998-01-01' + CAST(p_size AS INT) END AS day FROM part),
 i AS (SELECT o_orderkey AS row_id, CAST(o_orderkey % 50 AS BIGINT) AS size, CASE o_custkey % 3 WHEN 0 THEN 'PROMO' WHEN 1 THEN 'SMALL' ELSE 'LARGE' END AS kind, CASE WHEN o_orderkey % 2 = 0 THEN DATE '1998-01-01' + CAST(o_orderkey % 50 AS INT) END AS day FROM orders)
 SELECT row_id, min(event_id) AS event_id FROM i JOIN s ON i.size=s.size AND i.kind=s.kind AND (i.day IS NULL OR i.day=s.day) GROUP BY row_id HAVING count(*) = 1""")
def schedule_match(spark, sf):
    start = F.lit("1998-01-01").cast("date")
    s = V.table(spark, sf, "part").select(F.col("p_partkey").alias("event_id"), F.col("p_size").cast("long").alias("size"), F.col("p_type").alias("kind"), F.when(F.col("p_partkey") % 3 > 0, F.date_add(start, F.col("p_size").cast("int"))).alias("date"))
    kind = F.element_at(F.array(F.lit("PROMO"), F.lit("SMALL"), F.lit("LARGE")), (F.col("o_custkey") % 3 + 1).cast("int"))
    size = F.col("o_orderkey") % 50
    i = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), size.alias("size"), kind.alias("kind"), F.when(F.col("o_orderkey") % 2 == 0, F.date_add(start, size.cast("int"))).alias("date"))
    return match.schedule_match(i, s, ["size", "kind"]).select("row_id", "event_id")


@query("SELECT s_suppkey, coalesce(o, 'not_checked') AS outcome FROM supplier LEFT JOIN (SELECT l_suppkey, CASE WHEN count(*) > 30 THEN 'many' ELSE 'few' END AS o FROM lineitem WHERE l_linenumber = 7 AND l_suppkey % 3 > 0 GROUP BY 1) ON l_suppkey = s_suppkey")
def registry_outcomes(spark, sf):
    lines = V.table(spark, sf, "lineitem").where("l_linenumber = 7 and l_suppkey % 3 > 0")
    found = quality.counts(lines.select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey").select("s_suppkey", F.when(F.col("n") > 30, "many").otherwise("few").alias("outcome"))
    return match.outcomes(V.table(spark, sf, "supplier").select("s_suppkey"), found, ["s_suppkey"])


@query("SELECT l_orderkey FROM lineitem WHERE l_returnflag='R' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag='A'")
def contradictions(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    return match.contradictions(lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'"), ["l_orderkey"])


@query("SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey FROM supplier UNION SELECT o_custkey FROM orders")
def known_ids(spark, sf):
    one = lambda t, c: V.table(spark, sf, t).select(F.col(c).alias("id"))
    return match.known_ids(one("customer", "c_custkey"), one("supplier", "s_suppkey"), one("orders", "o_custkey"))


@query("SELECT l_suppkey, count(DISTINCT l_returnflag) AS l_returnflag_count, count(DISTINCT l_linestatus) AS l_linestatus_count, list_aggregate(list_sort(list(DISTINCT l_returnflag)), 'string_agg', ',') AS flags FROM lineitem GROUP BY 1")
def distinct_sets(spark, sf):
    out = quality.distinct_sets(V.table(spark, sf, "lineitem"), ["l_suppkey"], ["l_returnflag", "l_linestatus"])
    return out.select("l_suppkey", "l_returnflag_count", "l_linestatus_count", F.array_join("l_returnflag_set", ",").alias("flags"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS n FROM pages")
def nested_counts(spark, sf):
    return quality.nested_count(V.table(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit("(<a )")).alias("links")), "page_id", "links")


_NAMES = "CASE o_orderkey % 8 WHEN 0 THEN '4 x 50m Fr' WHEN 1 THEN '100m Bu' WHEN 2 THEN '200m Me' WHEN 3 THEN '50m Fr Lap' WHEN 4 THEN '4x50m Fr Lap' WHEN 5 THEN '50m Kraul' WHEN 6 THEN '50m Rücken' ELSE 'Overview' END"


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'relay' WHEN 1 THEN 'individual' WHEN 2 THEN 'individual' WHEN 3 THEN 'lap' WHEN 6 THEN 'individual' END AS kind, CASE WHEN o_orderkey % 8 IN (0, 4) THEN 4 ELSE 1 END AS legs,
 CASE o_orderkey % 8 WHEN 1 THEN 100 WHEN 2 THEN 200 WHEN 7 THEN NULL ELSE 50 END AS distance, CASE o_orderkey % 8 WHEN 1 THEN 'FLY' WHEN 2 THEN 'MEDLEY' WHEN 6 THEN 'BACK' WHEN 5 THEN NULL WHEN 7 THEN NULL ELSE 'FREE' END AS stroke FROM orders""")
def event_descriptors(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", S.event_descriptor(F.expr(_NAMES)).alias("e")).select("o_orderkey", "e.*")


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 2 THEN 'europe' ELSE 'pending' END AS scope, CASE WHEN o_orderkey % 5 = 0 THEN 'F' WHEN o_orderkey % 5 = 1 THEN 'U' WHEN o_orderkey % 5 = 2 THEN 'X' ELSE 'M' END AS gender,
 CASE WHEN o_orderkey % 150002 BETWEEN 1 AND 150000 THEN DATE '1899-12-30' + CAST(o_orderkey % 150002 AS INT) END AS day, CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS number FROM orders""")
def code_rules(spark, sf):
    k = F.col("o_orderkey")
    status = F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey") % 3)
    sex = F.element_at(F.array(F.lit(" f"), F.lit("u"), F.lit("X "), F.lit("?"), F.lit(None)), (k % 5 + 1).cast("int"))
    number = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.col("o_custkey"), F.lit("x"))).otherwise(F.concat(F.lit(" "), F.col("o_custkey")))
    return V.table(spark, sf, "orders").select("o_orderkey", S.approval_scope(status, F.lit("europe")).alias("scope"), S.gender(sex, "M").alias("gender"), S.serial_date((k % 150_002).cast("string")).alias("day"), S.safe_int(number).alias("number"))


@query("""WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 > 0 THEN 'DSQ' END AS s1, CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE 'DSQ' END AS s2 FROM orders)
 SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 AND nullif(trim(s1), '') IS NOT DISTINCT FROM nullif(trim(s2), '') THEN o_totalprice END AS score, coalesce(nullif(o_orderkey % 5, 0), nullif(o_orderkey % 3, 0)) AS pool, o_custkey % 2 = 0 AS right_list FROM o""")
def small_rules(spark, sf):
    k = F.col("o_orderkey")
    before, after = F.when(k % 3 > 0, "DSQ"), F.when(k % 2 == 0, " ").otherwise("DSQ")
    url = S.url_with(F.lit("https://example.org/list"), page=k, recordListId=F.col("o_custkey"))
    wanted = F.col("o_custkey") + F.when(F.col("o_custkey") % 2 == 0, 0).otherwise(1)
    return V.table(spark, sf, "orders").select("o_orderkey", S.kept_score(F.col("o_totalprice"), F.lit(1), F.when(k % 4 > 0, 1).otherwise(2), before, after).alias("score"), S.first_non_zero(k % 5, k % 3).alias("pool"), S.has_parameter(url, "recordListId", wanted).alias("right_list"))


@query("""SELECT p_partkey, lower(regexp_replace(replace(replace(replace(replace(p_name || ' Ärger ß' || p_partkey, 'Ä', 'ae'), 'ä', 'ae'), 'ö', 'oe'), 'ß', 'ss'), '[^a-zA-Z0-9]', '', 'g')) AS name_key, regexp_replace(p_name, ' ', '_', 'g') || '_Arger_' || p_partkey AS slug, 'relay:' || p_size || ':' || p_type AS event_key FROM part""")
def name_keys(spark, sf):
    name = F.concat(F.col("p_name"), F.lit(" Ärger ß"), F.col("p_partkey"))
    slug = F.concat(F.col("p_name"), F.lit(" Ärger "), F.col("p_partkey"))
    return V.table(spark, sf, "part").select("p_partkey", S.name_key(name).alias("name_key"), S.file_slug(slug).alias("slug"), S.composite_key(F.lit("relay"), F.col("p_size").cast("string"), F.col("p_type")).alias("event_key"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN epoch(o_orderdate) - 7200 WHEN o_orderkey % 3 = 1 THEN epoch(o_orderdate) END AS seconds FROM orders""")
def utc_times(spark, sf):
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.element_at(F.array(F.lit("+02:00"), F.lit("Z"), F.lit("")), (F.col("o_orderkey") % 3 + 1).cast("int")))
    return V.table(spark, sf, "orders").select("o_orderkey", F.unix_timestamp(S.utc_time(text)).cast("double").alias("seconds"))


@query("""SELECT CAST(page_id % 50 AS VARCHAR) AS list_id, count(DISTINCT page_id % 7) AS links, count(DISTINCT page_id % 3) AS labels FROM pages GROUP BY 1""")
def link_catalogue(spark, sf):
    """Lists linked from every page, beside the links that it has."""
    k = F.col("page_id")
    link = F.concat(F.lit('<a href="/x?recordListId='), k % 50, F.lit("&amp;p="), k % 7, F.lit('">label '), k % 3, F.lit("</a>"))
    found = html.catalogue(V.table(spark, sf, "pages").select("page_id", F.concat("html", link).alias("html")))
    return found.select("list_id", F.size("links").cast("long").alias("links"), F.size("labels").cast("long").alias("labels"))


@query("""SELECT page_id, url LIKE 'https://%' AND regexp_extract(url, '^https?://([^/?#]*)', 1) = 'www.example.org' AND page_id % 2 = 0 AS valid FROM pages""")
def page_registry(spark, sf):
    p = V.table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, "SUI").otherwise("Swi").alias("country"), "url")
    found = files.registry(p.withColumn("url", F.concat("url", F.lit("#"), "page_id")), "www.example.org")
    return found.select(F.substring_index("url", "#", -1).cast("long").alias("page_id"), "valid")


@query("SELECT DISTINCT p_name AS file_name FROM part WHERE regexp_matches(p_name, 'small|large|cold') AND substr(p_name, 1, 3) NOT IN ('hot') AND p_name IN (SELECT p_name FROM part WHERE p_size > 25)")
def named_files(spark, sf):
    names = V.table(spark, sf, "part").select(F.col("p_name").alias("file_name"), "p_size")
    manifest = names.select("file_name", (F.col("p_size") > 25).alias("keep"))
    wanted = names.where(files.named_like(F.col("file_name"), months=["small", "large", "cold"], exclude=["hot"]))
    return files.in_manifest(wanted, manifest).select("file_name").distinct()
