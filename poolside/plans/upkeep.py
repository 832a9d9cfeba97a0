"""Registers, dimensions, packages and texts over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import dedup, delta, match, packages, quality, rankings, resolve
from ..sources import files, shared, tables
from . import views as V
from .registry import query


@query("""WITH d AS (SELECT o_custkey AS meet_id, sha256('{"meet_id":' || o_custkey || ',"orders":' || count(*) || '}') AS sha FROM orders GROUP BY 1), l AS (SELECT c_custkey AS meet_id, CAST(c_custkey % 4 + 1 AS INT) AS rev, CASE WHEN c_custkey % 2 = 0 THEN sha ELSE 'old' END AS sha FROM customer LEFT JOIN d ON meet_id = c_custkey WHERE c_custkey % 3 > 0)
 SELECT d.meet_id, CAST(coalesce(rev, 0) + 1 AS INT) AS revision, l.sha AS previous, d.sha AS sha256 FROM d LEFT JOIN l USING (meet_id) WHERE d.sha IS DISTINCT FROM l.sha""")
def next_revisions(spark, sf):
    """SNK8, T4: the next revision of each document that changed, in order of its key."""
    docs = V.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("meet_id")).agg(F.count(F.lit(1)).alias("orders"))
    sha = docs.select("meet_id", F.sha2(F.to_json(F.struct("meet_id", "orders")), 256).alias("sha"))
    k = F.col("c_custkey")
    ledger = V.table(spark, sf, "customer").where("c_custkey % 3 > 0").join(sha, F.col("meet_id") == k, "left").select(k.alias("meet_id"), (k % 4 + 1).cast("int").alias("revision"), F.when(k % 2 == 0, F.col("sha")).otherwise("old").alias("sha256"))
    return packages.in_order(packages.packaged(docs, ledger)).drop("payload")


@query("""WITH l AS (SELECT p_partkey AS k, 'ok' AS status, p_size AS n FROM part WHERE p_partkey % 3 > 0), e AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN p_partkey % 5 > 0 THEN p_size + 1 END AS n FROM part WHERE p_partkey % 2 = 0)
 SELECT 'f' || k AS file_name, coalesce(e.status, l.status) AS status, CAST(coalesce(e.n, l.n) AS INT) AS result_count FROM l FULL JOIN e USING (k)""")
def file_statuses(spark, sf):
    """SNK9: the ledger of files with the statuses of a run merged in; a failure keeps the counts."""
    k, p = F.col("p_partkey"), V.table(spark, sf, "part")
    name = F.concat(F.lit("f"), k).alias("file_name")
    ledger = p.where("p_partkey % 3 > 0").select(name, F.lit("ok").alias("status"), F.col("p_size").alias("result_count"))
    entries = p.where("p_partkey % 2 = 0").select(name, F.when(k % 5 == 0, "failed").otherwise("ok").alias("status"), F.when(k % 5 > 0, F.col("p_size") + 1).alias("result_count"))
    return tables.log_status(ledger, entries)


@query("""WITH f AS (SELECT 'p' || page_id AS file_name, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n FROM pages), r AS (SELECT 'p' || (o_orderkey % 400) AS file_name, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT 'p' || (c_custkey % 150) AS file_name, count(*) AS n FROM customer GROUP BY 1)
 SELECT f.file_name, h AS file_fingerprint, CAST(f.n AS BIGINT) AS length, coalesce(a.n, 0) AS athlete_count, coalesce(r.n, 0) AS result_count FROM f LEFT JOIN a USING (file_name) LEFT JOIN r USING (file_name)""")
def file_registers(spark, sf):
    """SNK12: each page as a file with its hash, and how many athletes and results it has."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    pages = V.table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("file_name"), html.alias("content"), F.octet_length(html).cast("long").alias("length"))
    name = lambda c, n: F.concat(F.lit("p"), F.col(c) % n).alias("file_name")
    return files.with_counts(files.file_register(pages), V.table(spark, sf, "customer").select(name("c_custkey", 150)), V.table(spark, sf, "orders").select(name("o_orderkey", 400)))


@query("SELECT c_nationkey, c_mktsegment, min(c_custkey) AS c_custkey FROM customer GROUP BY ALL")
def first_ids(spark, sf):
    """T2"""
    return dedup.first_by_id(V.table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], "c_custkey")


@query("""WITH d AS (SELECT n_nationkey + 1 AS id, n_name AS name, n_regionkey FROM nation), w AS (SELECT DISTINCT 'NATION_' || (s_suppkey % 60) AS name FROM supplier WHERE s_suppkey % 7 > 0), n AS (SELECT name FROM w WHERE name NOT IN (SELECT name FROM d))
 SELECT CAST(id AS BIGINT) AS id, name, n_regionkey FROM d UNION ALL SELECT (SELECT max(id) FROM d) + row_number() OVER (ORDER BY substr(md5(name), 1, 3), name), name, NULL FROM n""")
def dimension_upkeep(spark, sf):
    """SNK13: names that the dimension does not have get rows and ids."""
    nation = V.table(spark, sf, "nation").select((F.col("n_nationkey") + 1).cast("long").alias("id"), F.col("n_name").alias("name"), "n_regionkey")
    wanted = V.table(spark, sf, "supplier").select(F.when(F.col("s_suppkey") % 7 > 0, F.concat(F.lit("NATION_"), F.col("s_suppkey") % 60)).alias("name"))
    return delta.with_dimension(nation, wanted, ["name"])


@query("SELECT l_suppkey % 9 AS file, CASE WHEN l_linenumber = 1 THEN 'no_name' WHEN l_partkey % 4 = 0 THEN 'no_birth_year' WHEN l_partkey % 5 = 0 THEN 'unknown_event' WHEN l_quantity < 10 THEN 'no_time' END AS reason, count(*) AS n FROM lineitem WHERE l_linenumber = 1 OR l_partkey % 4 = 0 OR l_partkey % 5 = 0 OR l_quantity < 10 GROUP BY ALL")
def unusable_rows(spark, sf):
    """FL7: how many rows of each file are left out, and why."""
    p = F.col("l_partkey")
    rows = V.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 9).alias("file"), F.lit(None).cast("string").alias("first_name"), F.when(F.col("l_linenumber") != 1, "x").alias("last_name"), F.when(p % 4 != 0, 1990).alias("birth_year"), F.when(p % 5 != 0, p).alias("event_id"), F.when(F.col("l_quantity") >= 10, F.col("l_quantity")).alias("time_seconds"))
    return P.reject_counts(rows, "file")


@query("""SELECT CAST(c_custkey % 50 AS VARCHAR) AS source_swimmer_id, c_mktsegment AS source_country_code, count(DISTINCT c_nationkey) AS claims FROM customer GROUP BY ALL HAVING count(DISTINCT c_nationkey) > 1""")
def claimed_aliases(spark, sf):
    """Aliases that one batch claims for several swimmers."""
    c = V.table(spark, sf, "customer")
    return resolve.alias_conflicts(c.select((F.col("c_custkey") % 50).cast("string").alias("source_swimmer_id"), F.col("c_mktsegment").alias("source_country_code"), F.col("c_nationkey").alias("swimmer_id")))


@query("SELECT DISTINCT p_type, p_brand, p_size FROM part WHERE p_size > 10 EXCEPT SELECT p_type, p_brand, p_size FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 49 AND l_linenumber = 3")
def unsold_kinds(spark, sf):
    """Kinds that are expected and not there, by a star join."""
    part = V.table(spark, sf, "part")
    lines = V.table(spark, sf, "lineitem").where("l_quantity > 49 and l_linenumber = 3").select(F.col("l_partkey").alias("p_partkey"))
    sold = match.star(lines, [(part.select("p_partkey", "p_type", "p_brand", "p_size"), "p_partkey")])
    return match.difference(part.where("p_size > 10"), sold, ["p_type", "p_brand", "p_size"])


@query("""SELECT l_orderkey AS id, sha256('[' || string_agg('{"n":' || l_linenumber || ',"p":' || l_partkey || '}', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) || ']') AS digest FROM lineitem GROUP BY 1""")
def digests_without_provenance(spark, sf):
    """What is hashed of a row: its nested lines without their source, and without the file that they came in."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("source"))
    rows = V.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(line)).alias("lines"), F.max("l_suppkey").alias("source_hash"))
    bare = packages.without(packages.without_nested(rows, "lines", "source"), "source_hash")
    return bare.select("id", F.sha2(F.to_json("lines"), 256).alias("digest"))


_TEXTS = """SELECT o_orderkey AS k, o_orderkey % 4 AS kind, '  ' || o_orderpriority || '   x ' AS messy, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS b FROM orders"""


@query(f"""WITH t AS ({_TEXTS}) SELECT k, CASE WHEN k % 9 > 0 THEN regexp_replace(trim(messy), '\\s+', ' ', 'g') END AS cleaned, CASE WHEN k % 3 = 0 THEN 25 ELSE 50 END AS pool, CASE WHEN a = b OR kind = 0 THEN a ELSE a END AS start_date, CASE WHEN kind = 0 THEN a ELSE b END AS end_date,
 'City ' || kind AS city, CASE WHEN kind > 1 THEN 'SUI' END AS country, CASE WHEN k % 5 = 0 THEN 4 ELSE 1 END AS legs, (k % 5 = 0) = (k % 7 = 0) AND (k % 5 > 0 OR k % 2 = 0) AS consistent, CASE WHEN k % 2 = 0 THEN 'Women' ELSE 'Men' END || ', ' || CASE k % 3 WHEN 0 THEN 'Open' WHEN 1 THEN '11 years and younger' ELSE '12 years' END AS title,
 concat_ws(':', 50, 'FREE', 'SCM', CASE WHEN k % 2 = 0 THEN 'F' ELSE 'M' END, CASE k % 3 WHEN 1 THEN 'X_11' WHEN 2 THEN '12_12' END) AS population FROM t""")
def texts_read(spark, sf):
    """FN6, FN8, FN24, FN25, FN26, FN36: white space, pools, date ranges, places, relays and titles of made texts."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    t = V.table(spark, sf, "orders").select(k.alias("k"), (k % 4).alias("kind"), F.concat(F.lit("  "), "o_orderpriority", F.lit("   x ")).alias("messy"), day.alias("a"), F.date_add(day, (k % 40).cast("int")).alias("b"))
    k, a, b = F.col("k"), F.col("a"), F.col("b")
    f = lambda d, p: F.date_format(d, p)
    same_month, same_year = f(a, "yyyyMM") == f(b, "yyyyMM"), F.year(a) == F.year(b)
    text = F.when(F.col("kind") == 0, f(a, "d MMM yyyy")).when(a == b, f(a, "d MMMM yyyy")).when(same_month, F.concat(f(a, "d"), F.lit(" – "), f(b, "d MMM yyyy"))).when(same_year, F.concat(f(a, "d MMM"), F.lit(" - "), f(b, "d MMM yyyy"))).otherwise(F.concat(f(a, "d MMM yyyy"), F.lit("-"), f(b, "d MMM yyyy")))
    t = t.withColumn("text", text)
    days, place = S.date_range(F.col("text")), S.city_country(F.concat(F.lit("City "), "kind", F.when(F.col("kind") > 1, " (SUI) ").otherwise(" ")))
    relay = S.relay_legs(F.when(k % 5 == 0, F.when(k % 2 == 0, "4x50").otherwise("4x100")).otherwise("50"), F.lit(50), k % 7 == 0)
    sex, ages = F.when(k % 2 == 0, "F").otherwise("M"), F.element_at(F.array(*map(F.lit, ("X_X", "X_11", "12_12"))), (k % 3 + 1).cast("int"))
    return t.select(
        "k", S.clean_text(F.when(k % 9 > 0, F.col("messy")).otherwise("   ")).alias("cleaned"), S.pool_length(F.when(k % 3 == 0, "scm 25").otherwise("LCM")).alias("pool"), days["start"].alias("start_date"), days["end"].alias("end_date"), place["city"].alias("city"), place["country"].alias("country"),
        relay["legs"].alias("legs"), relay["consistent"].alias("consistent"), S.category_title(sex, ages).alias("title"), S.population_key(F.lit(50), F.lit("FREE"), F.lit("SCM"), sex, ages).alias("population"),
    )


@query("""SELECT c_custkey AS key, CAST(c_custkey % 20 AS BIGINT) AS source_rows, coalesce(n, 0) AS found FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE coalesce(n, 0) <> c_custkey % 20""")
def truncated_exports(spark, sf):
    """DQ5: categories that have not as many rows as their source says."""
    cats = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 20).alias("source_rows"))
    return rankings.truncated_exports(cats, V.table(spark, sf, "orders").select(F.col("o_custkey").alias("key")))


@query("""WITH o AS (SELECT o_custkey AS k, max(year(o_orderdate)) AS y, min(year(o_orderdate)) AS y0, bool_or(o_orderkey % 61 = 0) AS odd FROM orders GROUP BY 1)
 SELECT k AS key, unnest(list_filter([CASE WHEN k % 11 = 0 THEN 'bad_category' END, CASE WHEN k % 13 = 0 THEN 'bad_timestamp' END, CASE WHEN k % 17 = 0 OR k % 19 = 0 THEN 'bad_page' END, CASE WHEN odd THEN 'bad_row' END, CASE WHEN k % 3 = 1 THEN 'wrong_age' WHEN k % 3 = 2 AND y0 < y THEN 'wrong_age' END, CASE WHEN k % 7 = 0 THEN 'future_row' END], lambda x: x IS NOT NULL)) AS issue FROM o""")
def provenance_issues(spark, sf):
    """DQ2: pages, rows and ages of ranking populations, one thing wrong for each remainder."""
    o = V.table(spark, sf, "orders")
    k, day = F.col("o_custkey"), F.to_date("o_orderdate")
    last = o.groupBy("o_custkey").agg(F.max(F.year(day)).alias("last"))
    born = F.when(k % 3 == 2, F.col("last") - 12).when(k % 3 == 1, F.year(day) - 13).otherwise(F.year(day) - 30)
    row = F.struct(F.col("o_orderkey").cast("string").alias("athlete_id"), F.when(F.col("o_orderkey") % 61 == 0, "x").otherwise("1").alias("result_id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"), born.alias("birth_year"), day.alias("date"), F.lit(100).alias("time_cs"), F.lit(False).alias("is_split"))
    pops = o.join(last, "o_custkey").groupBy("o_custkey").agg(F.collect_list(row).alias("rows"), F.max(day).alias("day"))
    url = F.concat(F.when(k % 19 == 0, "http").otherwise("https"), F.lit("://host.example/index?firstPlace="), F.when(k % 17 == 0, "26").otherwise("1"), F.lit("&rankingClubId=5"))
    pages = F.array(F.struct(F.lit(1).alias("offset"), url.alias("source_url"), F.lit("a" * 64).alias("sha256")))
    made = F.when(k % 7 == 0, F.date_sub("day", 1)).otherwise(F.col("day")).cast("string")
    pops = pops.select(
        k.alias("key"), F.lit("SCM").alias("course"), F.when(k % 11 == 0, "X").otherwise("F").alias("gender"), F.element_at(F.array(*map(F.lit, ("X_X", "X_11", "12_12"))), (k % 3 + 1).cast("int")).alias("age_group"), F.concat(made, F.when(k % 13 == 0, "T10:00:00").otherwise("T10:00:00Z")).alias("captured_at"), F.lit("Last built 1").alias("built"), "rows", pages.alias("pages"),
    )
    return rankings.provenance_issues(pops)


@query("""WITH t AS (SELECT CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 8 THEN 'a:b/c' ELSE 'n' || c_nationkey END AS part, c_custkey, c_name FROM customer), ch AS (SELECT part, c_custkey, c_name || '!' AS c_name FROM t WHERE c_custkey % 5 = 0 AND (part IS NULL OR part IN ('a:b/c', 'n3')))
 SELECT t.part, t.c_custkey, coalesce(ch.c_name, t.c_name) AS c_name, 1 AS old_version FROM t LEFT JOIN ch USING (c_custkey) WHERE t.part IS DISTINCT FROM 'n4' UNION ALL SELECT part, c_custkey, c_name, 0 FROM t""")
def manifest_table(spark, sf):
    """SNK6: a table published twice, the second time only in the partitions that changed; both versions are read."""
    k = F.col("c_nationkey")
    rows = V.table(spark, sf, "customer").select(F.when(k == 7, None).when(k == 8, "a:b/c").otherwise(F.concat(F.lit("n"), k)).alias("part"), "c_custkey", "c_name")
    table = tables.PartitionedTable(spark, shared.fresh_folder(spark, "table"), ["part"])
    table.publish(rows)
    changes = rows.where("c_custkey % 5 = 0 and (part is null or part in ('a:b/c', 'n3'))").withColumn("c_name", F.concat("c_name", F.lit("!")))
    table.publish(delta.upsert(table.read(partitions=changes), changes, ["part", "c_custkey"], null_keys_match=True), gone=rows.where("part = 'n4'").select("part").distinct())
    return table.read().withColumn("old_version", F.lit(1)).unionByName(table.read(1).withColumn("old_version", F.lit(0)))


@query("""WITH b AS (SELECT user_id, event_id, event_type FROM events WHERE user_id % 4 > 0 AND event_id % 3 > 0), n AS (SELECT user_id, event_id, CASE WHEN user_id % 7 = 0 AND event_id % 5 = 0 THEN 'other' ELSE event_type END AS event_type FROM events WHERE user_id % 6 > 0 OR event_id % 3 > 0),
 s AS (SELECT user_id, CASE WHEN b.event_id IS NULL THEN 'a' WHEN n.event_id IS NULL THEN 'r' WHEN b.event_type IS DISTINCT FROM n.event_type THEN 'c' ELSE 'u' END AS s FROM (SELECT *, event_id AS e FROM b) b FULL JOIN (SELECT *, event_id AS e FROM n) n USING (user_id, e)),
 c AS (SELECT user_id, count(*) FILTER (WHERE s = 'a') AS added, count(*) FILTER (WHERE s = 'r') AS removed, count(*) FILTER (WHERE s = 'c') AS changed, count(*) FILTER (WHERE s = 'u') AS unchanged FROM s GROUP BY 1), p AS (SELECT DISTINCT user_id, 2 AS problems FROM events WHERE user_id % 11 = 0)
 SELECT user_id, added, removed, changed, unchanged, CASE WHEN removed > 0 OR problems > 0 THEN 'held' WHEN added + changed + unchanged = 0 THEN 'waiting' WHEN changed + unchanged = 0 THEN 'new' WHEN added + changed > 0 THEN 'changed' ELSE 'unchanged' END AS decision FROM c LEFT JOIN p USING (user_id)""")
def readiness_with_problems(spark, sf):
    """DQ10: sources with undated or ambiguous results are held although nothing is gone."""
    e = V.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    seen = e.where("user_id % 6 > 0 or event_id % 3 > 0").withColumn("event_type", F.when((F.col("user_id") % 7 == 0) & (F.col("event_id") % 5 == 0), "other").otherwise(F.col("event_type")))
    problems = e.where("user_id % 11 = 0").select("user_id").distinct().withColumn("problems", F.lit(2).cast("long"))
    out = quality.readiness(e.where("user_id % 4 > 0 and event_id % 3 > 0"), seen, ["event_id"], ["event_type"], ["user_id"], problems)
    return out.select("user_id", "added", "removed", "changed", "unchanged", "decision")


@query("""WITH i AS (SELECT o_orderkey AS row_id, o_custkey AS k, o_totalprice AS v FROM orders), c AS (SELECT o_orderkey AS id, o_custkey AS k, o_totalprice + 100.0 * (o_orderkey % 5) AS v, o_orderstatus = 'F' AS f, o_orderkey % 2 = 0 AS e FROM orders)
 SELECT row_id, id FROM i JOIN c USING (k) WHERE abs(i.v - c.v) < 5000 QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY f DESC, e DESC, abs(i.v - c.v), id DESC) = 1""")
def preferred_match(spark, sf):
    """Of the candidates within the tolerance the one that the preferences name."""
    o = V.table(spark, sf, "orders")
    i = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    c = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), (F.col("o_totalprice") + 100.0 * (F.col("o_orderkey") % 5)).alias("v"), (F.col("o_orderstatus") == "F").alias("f"), (F.col("o_orderkey") % 2 == 0).alias("e"))
    return match.nearest_match(i, c, ["k"], value="v", tolerance=5000, prefer=[F.col("f"), F.col("e")]).select("row_id", "id")


@query("""WITH p AS (SELECT c_custkey AS k, md5(c_name || CASE WHEN c_custkey % 7 = 0 THEN '?' ELSE '' END) AS f, c_nationkey FROM customer WHERE c_custkey % 3 > 0), n AS (SELECT c_custkey AS k, md5(c_name) AS f FROM customer WHERE c_custkey % 10 > 0), d AS (SELECT c_custkey AS k, c_nationkey FROM customer WHERE c_custkey % 2 = 0),
 a AS (SELECT d.c_nationkey, CASE WHEN n.f IS NULL AND p.f IS NOT NULL THEN 'removed' WHEN n.f IS NULL THEN 'absent' WHEN n.f IS NOT DISTINCT FROM p.f THEN 'unchanged' ELSE 'changed' END AS action FROM d LEFT JOIN n USING (k) LEFT JOIN p USING (k))
 SELECT c_nationkey, count(*) AS processed, count(*) FILTER (WHERE action = 'changed') AS changed, count(*) FILTER (WHERE action = 'removed') AS removed FROM a GROUP BY 1""")
def fingerprint_reports(spark, sf):
    """UPS13: what a refresh of the dirty keys did, for each nation's keys."""
    c = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_nationkey")
    old = c.where("id % 3 > 0").select("id", F.md5(F.concat("c_name", F.when(F.col("id") % 7 == 0, "?").otherwise(""))).alias("fingerprint"))
    new = c.where("id % 10 > 0").select("id", F.md5("c_name").alias("fingerprint"))
    return delta.refresh_fingerprints(old, new, c.where("id % 2 = 0").select("id", "c_nationkey"), by=["c_nationkey"])[1]
