"""All queries of the library over the driver's tables, with the SQL that says the same.

A query is registered together with its SQL; the SQL is DuckDB's dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..functions.canonical import canonical_rows
from ..operators import dedup, delta, match, packages, quality, rankings, resolve, summary
from ..sources import pages as html
from ..sources.shared import settled
from . import checks, deliveries, filters, planning, upkeep  # noqa: F401  they register their queries
from . import views as V
from .registry import oracle_sql, queries, query  # noqa: F401

_R = """r AS (SELECT l_orderkey AS meet_id, l_linenumber AS line, l_partkey AS event_id, l_suppkey AS lane, o_custkey AS swimmer_id,
 CAST(l_extendedprice AS DECIMAL(12,2)) AS time_seconds, CAST(l_shipdate AS DATE) AS result_date, CAST(l_quantity*20 AS INT) AS points_fina,
 CAST(l_quantity AS INT) % 25 AS points_rudolph, CASE WHEN l_returnflag='R' THEN 'DSQ' END AS status, l_linestatus='O' AS is_relay,
 CASE WHEN l_linenumber % 2 = 0 THEN 25 ELSE 50 END AS pool_length FROM lineitem JOIN orders ON l_orderkey=o_orderkey)"""
_S = """s AS (SELECT c_custkey AS swimmer_id, CASE WHEN c_custkey % 6 <> 5 THEN CAST(1972 + c_custkey % 30 AS INT) END AS birth_year, n_name AS country_code, c_name AS name, c_mktsegment AS segment FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey)"""
_STROKE = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.STROKE_OF.items()) + " ELSE 'OTHER' END"
_V = f"""{_R}, {_S}, v AS (SELECT r.*, p_size AS distance, {_STROKE} AS stroke, birth_year, country_code, sy AS season_end_year,
 CASE WHEN pool_length=25 THEN 'SCM' ELSE 'LCM' END AS course, CAST(sy-birth_year AS INT) AS age_group
 FROM (SELECT *, CAST(year(result_date) + CASE WHEN month(result_date)>=9 THEN 1 ELSE 0 END AS INT) AS sy FROM r) r JOIN part ON event_id=p_partkey JOIN s USING (swimmer_id)
 WHERE time_seconds>0 AND status IS NULL AND NOT is_relay AND points_fina BETWEEN 1 AND 1500 AND result_date IS NOT NULL AND pool_length IN (25, 50) AND p_type <> 'MEDIUM')"""


def _top3(keys: str, source: str = "v", extra: str = "") -> str:
    return f"""SELECT {keys}, CAST(avg(CASE WHEN rn<=3 THEN points_fina END) AS DECIMAL(6,1)) AS avg_points, max(CASE WHEN rn=1 THEN points_fina END) AS best1,
 max(CASE WHEN rn=2 THEN points_fina END) AS best2, max(CASE WHEN rn=3 THEN points_fina END) AS best3, count(*) AS race_count{extra}
 FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY points_fina DESC, time_seconds) AS rn FROM {source}) GROUP BY {keys}"""


_BASE = "season_end_year, swimmer_id, course"
_EVENT = f"{_BASE}, distance, stroke"
_POINTS = f"""{_V}, e AS ({_top3(_EVENT)}), o AS ({_top3(_BASE)}), pts AS (SELECT {_EVENT}, avg_points, best1, best2, best3, race_count FROM e UNION ALL
 SELECT {_BASE}, 0, 'ALL', avg_points, best1, best2, best3, race_count FROM o)"""
_CELLS = f"""{_POINTS}, ages AS (SELECT pts.*, CAST(season_end_year-birth_year AS INT) AS age_group, country_code FROM pts JOIN s USING (swimmer_id)),
 cells AS (SELECT *, CASE WHEN age_mode='AGE' THEN age_group ELSE 0 END AS age_cell FROM ages JOIN (VALUES ('ALL'),('{V.HOME}')) c(country) ON country='ALL' OR country_code=country
 JOIN (VALUES ('OPEN'),('AGE')) m(age_mode) ON age_mode='OPEN' OR age_group BETWEEN 8 AND 19)"""


# --- summaries ------------------------------------------------------------------


def _points(spark: SparkSession, sf: str) -> DataFrame:
    ages = V.swimmers(spark, sf).select("swimmer_id", "birth_year", "country_code")
    points = summary.season_points(V.valid_swims(spark, sf, by_swimmer=True)).join(ages, "swimmer_id")
    # written once, for bands, ranks and copies read them several times
    return settled(points.withColumn("age_group", F.col("season_end_year") - F.col("birth_year")))


@query(f"WITH {_V} {_top3(_EVENT)}")
def season_top3_event(spark, sf):
    return summary.top3(V.valid_swims(spark, sf, by_swimmer=True), ["season_end_year", "swimmer_id", "course", "distance", "stroke"])


@query(f"WITH {_V} {_top3(_BASE)}")
def season_top3_overall(spark, sf):
    return summary.top3(V.valid_swims(spark, sf, by_swimmer=True), ["season_end_year", "swimmer_id", "course"])


@query(f"WITH {_POINTS} SELECT * FROM pts")
def season_points_union(spark, sf):
    return summary.season_points(V.valid_swims(spark, sf, by_swimmer=True))


@query(f"WITH {_POINTS} SELECT swimmer_id, max(best1) AS career_best FROM pts GROUP BY 1")
def career_best(spark, sf):
    return summary.career_best(summary.season_points(V.valid_swims(spark, sf, by_swimmer=True)))


LEAST_CAREER = 900
_ELIGIBLE = f"{_CELLS}, eligible AS (SELECT * FROM cells WHERE swimmer_id IN (SELECT swimmer_id FROM pts GROUP BY 1 HAVING max(best1) >= {LEAST_CAREER}))"


_PCT = ", ".join(f"round(quantile_cont(CAST(avg_points AS DOUBLE), {b / 100}), 4) AS p{b}" for b in summary.BANDS)


@query(f"WITH {_ELIGIBLE} SELECT season_end_year, course, age_cell, distance, stroke, country, age_mode, count(*) AS population, {_PCT} FROM eligible GROUP BY ALL")
def season_bands(spark, sf):
    out = summary.season_bands(_points(spark, sf), V.HOME, LEAST_CAREER)
    return out.withColumns({f"p{b}": F.round(f"p{b}", 4) for b in summary.BANDS})


_RANKS = f"""{_ELIGIBLE}, ranks AS (SELECT {_EVENT}, country, age_mode, CAST(100*percent_rank() OVER (PARTITION BY season_end_year, course, age_cell, distance, stroke, country, age_mode ORDER BY avg_points) AS DECIMAL(5,2)) AS percentile FROM eligible)"""
_KEY = ["season_end_year", "swimmer_id", "course", "distance", "stroke"]


@query(f"WITH {_RANKS} SELECT * FROM ranks")
def percentile_ranks(spark, sf):
    return summary.percentile_ranks(_points(spark, sf), V.HOME, _KEY, LEAST_CAREER)


@query(f"WITH {_RANKS} SELECT {_EVENT}, avg_points, percentile AS default_percentile FROM pts LEFT JOIN (SELECT * FROM ranks WHERE country='{V.HOME}' AND age_mode='AGE') USING ({_EVENT})")
def default_rank_copy(spark, sf):
    points = _points(spark, sf)
    out = summary.default_rank_copy(points, summary.percentile_ranks(points, V.HOME, _KEY, LEAST_CAREER), V.HOME, _KEY)
    return out.select(*_KEY, "avg_points", "default_percentile")


@query(f"WITH {_V} {_top3('season_end_year, swimmer_id, meet_id, course', extra=', min(result_date) AS first_date')}")
def meet_points(spark, sf):
    return summary.meet_points(V.valid_swims(spark, sf, by_swimmer=True))


@query(f"WITH {_V}, d AS (SELECT *, min(result_date) OVER (PARTITION BY swimmer_id, meet_id, season_end_year, course) AS meet_date FROM v) {_top3('season_end_year, swimmer_id, meet_id, course, distance, stroke', 'd', ', min(meet_date) AS first_date')}")
def meet_points_event(spark, sf):
    return summary.meet_points(V.valid_swims(spark, sf, by_swimmer=True), by_event=True)


def _measure(name: str, column: str, most: int) -> str:
    bands = ", ".join(f"round(quantile_cont(CAST({column} AS DOUBLE), {b / 100}), 4) AS {name}_p{b}" for b in summary.BANDS)
    return f"{name} AS (SELECT {_RACE_KEYS}, count(*) AS {name}_count, max({column}) AS {name}_max, {bands} FROM grouped WHERE {column} BETWEEN 1 AND {most} GROUP BY ALL)"


_RACE_KEYS = "distance, stroke, pool_length, age_cell, country, age_mode"
_RACE = f"""{_R}, {_S}, base AS (SELECT p_size AS distance, {_STROKE} AS stroke, pool_length, points_fina, points_rudolph, country_code, year(result_date) + CASE WHEN month(result_date) >= 9 THEN 1 ELSE 0 END - birth_year AS season_age
 FROM r JOIN part ON event_id=p_partkey JOIN s USING (swimmer_id) WHERE time_seconds>0 AND (status IS NULL OR trim(status)='') AND NOT is_relay AND result_date IS NOT NULL AND pool_length IN (25, 50) AND birth_year IS NOT NULL AND p_type <> 'MEDIUM'),
 grouped AS (SELECT distance, stroke, pool_length, points_fina, points_rudolph, country, age_mode, CAST(CASE WHEN age_mode='AGE' THEN least(19, greatest(8, season_age)) ELSE 0 END AS INT) AS age_cell FROM base
 JOIN (VALUES ('ALL'),('{V.HOME}')) c(country) ON country='ALL' OR country_code=country JOIN (VALUES ('OPEN'),('AGE')) m(age_mode) ON age_mode='OPEN' OR season_age BETWEEN 8 AND 19)"""


@query(f"WITH {_RACE}, {_measure('fina', 'points_fina', 1500)}, {_measure('rudolph', 'points_rudolph', 20)} SELECT * REPLACE (coalesce(rudolph_count, 0) AS rudolph_count) FROM fina LEFT JOIN rudolph USING ({_RACE_KEYS})")
def race_bands(spark, sf):
    out = summary.race_bands(V.swims(spark, sf).where(P.valid_race_band()), V.HOME)
    return out.withColumns({f"{m}_p{b}": F.round(f"{m}_p{b}", 4) for m in ("fina", "rudolph") for b in summary.BANDS})


@query(f"WITH {_CELLS} SELECT country, age_mode, count(*) AS n, count(DISTINCT swimmer_id) AS swimmers FROM cells GROUP BY ALL")
def population_counts(spark, sf):
    return summary.in_cells(_points(spark, sf), V.HOME).groupBy("country", "age_mode").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("swimmer_id").alias("swimmers"))


@query(f"WITH {_V}, e AS ({_top3(_EVENT)}), m AS ({_top3('season_end_year, swimmer_id, meet_id, course')}) SELECT 'events' AS table_name, count(*) AS row_count FROM e UNION ALL SELECT 'meets', count(*) FROM m")
def run_totals(spark, sf):
    return summary.row_totals({"events": season_top3_event(spark, sf), "meets": meet_points(spark, sf)})


@query(f"WITH {_POINTS} SELECT * REPLACE (CASE WHEN season_end_year >= 2000 THEN race_count ELSE -race_count END AS race_count) FROM pts")
def refreshed_seasons(spark, sf):
    """The old points are wrong everywhere: of the changed seasons nothing of them stays, of the others all."""
    swims = V.valid_swims(spark, sf, by_swimmer=True)
    old = summary.season_points(swims).withColumn("race_count", -F.col("race_count"))
    return summary.refreshed_seasons(old, swims, swims.where("season_end_year >= 2000"))


# --- dedup, upsert and change ------------------------------------------------------

_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER})=1")
def dedup_first_wins(spark, sf):
    rows = V.table(spark, sf, "lineitem")
    first = dedup.pick_first(rows, ["l_orderkey", "l_linenumber"], [F.asc(c) for c in _ORDER.split(", ")])
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("SELECT l_orderkey, l_linenumber, max_by(l_partkey, l_shipdate) AS l_partkey FROM lineitem GROUP BY ALL HAVING count(*) = 1")
def last_of_unique(spark, sf):
    rows = dedup.unique_only(V.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return dedup.pick_last(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey"])


@query(f"SELECT l_orderkey, l_linenumber, count(*) AS repeats FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS rn FROM lineitem) WHERE rn > 1 GROUP BY ALL")
def repeated_keys(spark, sf):
    rows = dedup.repeated(V.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.asc(c) for c in _ORDER.split(", ")])
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("repeats"))


def _two_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers without every seventh, and changed customers without every fifth."""
    c = V.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    new = c.where("c_custkey % 5 <> 0").withColumns({"c_acctbal": F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")), "c_name": F.when(F.col("c_custkey") % 4 != 0, F.col("c_name"))})
    return c.where("c_custkey % 7 <> 0"), new


_TWO = """t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 7 <> 0),
 i AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS c_name, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal+1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 5 <> 0)"""


@query(f"WITH {_TWO} SELECT * FROM i UNION ALL SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM i)")
def upsert_full(spark, sf):
    return delta.upsert(*_two_versions(spark, sf), ["c_custkey"])


@query(f"""WITH {_TWO} SELECT c_custkey, coalesce(i.c_name, t.c_name) AS c_name, coalesce(t.c_nationkey, i.c_nationkey) AS c_nationkey, greatest(t.c_acctbal, i.c_acctbal) AS c_acctbal FROM t FULL JOIN i USING (c_custkey)""")
def upsert_coalesce(spark, sf):
    return delta.upsert(*_two_versions(spark, sf), ["c_custkey"], {"c_name": delta.KEEP_IF_NULL, "c_nationkey": delta.NEVER, "c_acctbal": delta.GREATEST})


@query(f"WITH {_TWO} SELECT * FROM t UNION ALL SELECT * FROM i WHERE c_custkey NOT IN (SELECT c_custkey FROM t)")
def insert_if_absent(spark, sf):
    return delta.insert_if_absent(*_two_versions(spark, sf), ["c_custkey"])


@query(f"""WITH {_TWO} SELECT coalesce(t.c_custkey, i.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN 'added' WHEN i.c_custkey IS NULL THEN 'removed' WHEN t.c_name IS NOT DISTINCT FROM i.c_name AND t.c_acctbal=i.c_acctbal THEN 'unchanged' ELSE 'changed' END AS state FROM t FULL JOIN i ON t.c_custkey=i.c_custkey""")
def snapshot_diff(spark, sf):
    return delta.compare(*_two_versions(spark, sf), ["c_custkey"], ["c_name", "c_acctbal"])


@query("SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_quantity > 49 UNION SELECT o_orderkey FROM orders WHERE o_totalprice > 490000")
def dirty_keys(spark, sf):
    return delta.dirty_keys([(V.table(spark, sf, "lineitem").where("l_quantity > 49"), "l_orderkey"), (V.table(spark, sf, "orders").where("o_totalprice > 490000"), "o_orderkey")])


@query("SELECT id FROM (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_quantity > 49) ORDER BY id LIMIT 100")
def oldest_dirty(spark, sf):
    return delta.oldest(delta.dirty_keys([(V.table(spark, sf, "lineitem").where("l_quantity > 49"), "l_orderkey")]), 100)


@query("""WITH n AS (SELECT o_orderkey AS id, md5(concat_ws('|', o_custkey, o_orderstatus)) AS f FROM orders WHERE o_orderkey % 11 <> 0),
 p AS (SELECT o_orderkey AS id, md5(concat_ws('|', o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END)) AS f FROM orders WHERE o_orderkey % 13 <> 0),
 d AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 2 = 0)
 SELECT id, f AS fingerprint FROM p WHERE id NOT IN (SELECT id FROM d) UNION ALL SELECT id, f FROM n WHERE id IN (SELECT id FROM d)""")
def fingerprint_refresh(spark, sf):
    o = V.table(spark, sf, "orders")
    old = F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus"))
    now = o.where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("id"), S.plain_fingerprint(F.col("o_custkey"), F.col("o_orderstatus")).alias("fingerprint"))
    held = o.where("o_orderkey % 13 <> 0").select(F.col("o_orderkey").alias("id"), S.plain_fingerprint(F.col("o_custkey"), old).alias("fingerprint"))
    return delta.refresh_fingerprints(held, now, o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id")))[0]


@query("SELECT l_orderkey AS meet_id, CASE WHEN count(*) FILTER (WHERE l_linenumber=7) > 0 THEN NULL ELSE min(CAST(l_shipdate AS DATE)) END AS affected_from FROM lineitem GROUP BY 1")
def affected_from(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("meet_id"), F.when(F.col("l_linenumber") != 7, F.to_date("l_shipdate")).alias("result_date"))
    return delta.affected_from(rows, ["meet_id"])


@query(f"""WITH {_TWO}, x AS (SELECT i.*, t.c_custkey AS old, t.c_name AS on_, t.c_acctbal AS ob FROM i LEFT JOIN t USING (c_custkey))
 SELECT c_custkey, CASE WHEN c_nationkey=0 THEN 'held' WHEN old IS NULL THEN 'insert' WHEN c_name IS NOT DISTINCT FROM on_ AND c_acctbal=ob THEN 'unchanged' WHEN c_custkey % 2 < 1 THEN 'protected' ELSE 'update' END AS action FROM x""")
def plan_actions(spark, sf):
    target, incoming = _two_versions(spark, sf)
    incoming = incoming.withColumns({"strength": F.col("c_custkey") % 2, "held": F.col("c_nationkey") == 0})
    plan = delta.plan_actions(incoming, target.withColumn("strength", F.lit(1)), ["c_custkey"], ["c_name", "c_acctbal"])
    return plan.select("c_custkey", "action")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(f"SELECT {_LINE} FROM lineitem WHERE l_orderkey % 10 <> 3 OR l_linenumber > 2")
def snapshot_apply(spark, sf):
    """Orders of which the snapshot has no line left are emptied."""
    rows = V.table(spark, sf, "lineitem").select(*_LINE.split(", "))
    scopes = V.table(spark, sf, "orders").where("o_orderkey % 10 = 3").select(F.col("o_orderkey").alias("l_orderkey"))
    return delta.apply_snapshot(rows, rows.where("l_orderkey % 10 = 3 and l_linenumber > 2"), scopes, rows.columns)


@query("""WITH k AS (SELECT * FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 2 = 0) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM k)
 UNION ALL SELECT l_orderkey, l_linenumber, -l_partkey, l_suppkey, l_quantity FROM k""")
def children_replaced(spark, sf):
    rows = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    new = rows.where("l_linenumber = 1 and l_orderkey % 2 = 0").withColumn("l_partkey", -F.col("l_partkey"))
    return delta.replace_children(rows, new, "l_orderkey")


@query(f"""WITH {_TWO} SELECT t.* FROM t WHERE c_nationkey NOT IN (SELECT c_nationkey FROM t GROUP BY 1 INTERSECT SELECT c_nationkey FROM i GROUP BY 1) UNION ALL SELECT * FROM i""")
def partitions_replaced(spark, sf):
    target, incoming = _two_versions(spark, sf)
    return delta.replace_partitions(target, incoming, ["c_nationkey"], ["c_custkey", "c_name", "c_acctbal"])


@query("""SELECT l_orderkey AS meet_id, sha256(string_agg(h, ',' ORDER BY h)) AS digest FROM (SELECT l_orderkey, sha256('{"l_linenumber":' || coalesce(CAST(l_linenumber AS VARCHAR), 'null') || ',"l_partkey":' || coalesce(CAST(l_partkey AS VARCHAR), 'null') || '}') AS h FROM lineitem) GROUP BY 1""")
def set_digests(spark, sf):
    """Of all rows; nulls are written, as the source's canonical text does (meet_delivery.py:71-85)."""
    return delta.sorted_digest(V.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "meet_id"), ["meet_id"], ["l_linenumber", "l_partkey"])


@query("""WITH p AS (SELECT o_custkey AS meet_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS revision, md5(CAST(o_orderkey AS VARCHAR)) AS sha256, o_orderkey FROM orders),
 q AS (SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN 'lost' ELSE lag(sha256) OVER (PARTITION BY meet_id ORDER BY revision) END AS previous FROM p),
 b AS (SELECT *, lag(sha256) OVER (PARTITION BY meet_id ORDER BY revision) AS s, lag(revision) OVER (PARTITION BY meet_id ORDER BY revision) AS v FROM q)
 SELECT meet_id, revision, previous FROM b WHERE v IS NOT NULL AND NOT (revision=v+1 AND previous IS NOT DISTINCT FROM s)""")
def revision_chain(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("meet_id").orderBy("o_orderkey")
    p = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("meet_id"), "o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("sha256"))
    p = p.withColumns({"revision": F.row_number().over(w), "_before": F.lag("sha256").over(w)})
    p = p.withColumn("previous", F.when(F.col("o_orderkey") % 9 == 0, "lost").otherwise(F.col("_before")))
    return rankings.chain_breaks(p).select("meet_id", "revision", "previous")


@query(f"""WITH {_TWO}, old AS (SELECT c_nationkey AS k, min(c_acctbal) AS o FROM t GROUP BY 1), new AS (SELECT c_nationkey AS k, min(c_acctbal) AS n FROM i WHERE c_nationkey <> 3 GROUP BY 1)
 SELECT k AS c_nationkey, CASE WHEN n IS NULL THEN 'missing' WHEN n > o THEN 'worse' ELSE 'ok' END AS verdict FROM old LEFT JOIN new USING (k)""")
def regression_gate(spark, sf):
    target, incoming = _two_versions(spark, sf)
    return delta.no_regression(target, incoming.where("c_nationkey <> 3"), "c_nationkey", "c_acctbal")


@query(f"WITH {_TWO} SELECT c_custkey FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM i)")
def missing_accepted(spark, sf):
    target, incoming = _two_versions(spark, sf)
    return delta.missing_keys(target, incoming, ["c_custkey"]).select("c_custkey")


# --- matching ------------------------------------------------------------------------


@query("""WITH i AS (SELECT o_orderkey AS row_id, o_custkey AS k, o_totalprice AS v FROM orders), c AS (SELECT o_orderkey AS id, o_custkey AS k, o_totalprice + 100.0 * (o_orderkey % 5) AS v FROM orders),
 p AS (SELECT row_id, id, abs(i.v-c.v) AS d FROM i JOIN c USING (k) WHERE abs(i.v-c.v) < 5000) SELECT row_id, id FROM p QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d, id DESC)=1""")
def nearest_match(spark, sf):
    o = V.table(spark, sf, "orders")
    i = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    c = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), (F.col("o_totalprice") + 100.0 * (F.col("o_orderkey") % 5)).alias("v"))
    return match.nearest_match(i, c, ["k"], value="v", tolerance=5000).select("row_id", "id")


@query("""WITH n AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d, l_extendedprice AS v, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS heat, concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE), CAST(l_quantity AS INT)) AS id FROM lineitem),
 p AS (SELECT a.id AS row_id, c.id FROM n a JOIN n c ON a.l_orderkey=c.l_orderkey AND (a.heat=c.heat OR (a.heat IS NULL AND c.heat IS NULL AND a.d=c.d AND abs(a.v-c.v) < 0.0001))) SELECT row_id, min(id) AS id FROM p GROUP BY 1 HAVING count(*) = 1""")
def theta_match(spark, sf):
    heat, day = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber")), F.to_date("l_shipdate")
    id_ = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", day, F.col("l_quantity").cast("int"))
    rows = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("meet_id"), heat.alias("heat"), day.alias("result_date"), F.col("l_extendedprice").alias("time_seconds"), id_.alias("id"))
    return match.theta_match(rows.withColumnRenamed("id", "row_id"), rows, ["meet_id"])


@query("""WITH m AS (SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS VARCHAR) AS city FROM customer), k AS (SELECT s_suppkey AS c_custkey, CASE WHEN s_suppkey % 3=0 THEN NULL ELSE s_nationkey END AS c_nationkey, s_name AS city FROM supplier),
 a AS (SELECT c_custkey, min(city) AS v1 FROM k GROUP BY 1), b AS (SELECT c_nationkey, min(city) AS v2 FROM k GROUP BY 1) SELECT c_custkey, coalesce(v1, v2) AS city FROM m LEFT JOIN a USING (c_custkey) LEFT JOIN b ON m.c_nationkey IS NOT DISTINCT FROM b.c_nationkey""")
def null_safe_or_join(spark, sf):
    m = V.table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.lit(None).cast("string").alias("city"))
    k = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_nationkey")).alias("c_nationkey"), F.col("s_name").alias("city"))
    return match.either_key(m, k, "c_custkey", ["c_nationkey"], "city").select("c_custkey", "city")


@query("""WITH sp AS (SELECT p_partkey AS k, p_brand AS v FROM part WHERE p_partkey % 3=0), df AS (SELECT p_size AS z, min(p_brand) AS v FROM part WHERE p_size < 25 GROUP BY 1)
 SELECT p_partkey, coalesce(sp.v, df.v) AS brand FROM part LEFT JOIN sp ON p_partkey=k LEFT JOIN df ON p_size=z""")
def fallback_lookup(spark, sf):
    p = V.table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_brand").alias("brand"))
    default = p.where("p_size < 25").groupBy("p_size").agg(F.min("brand").alias("brand"))
    return match.with_fallback(p.select("p_partkey", "p_size"), p.where("p_partkey % 3 = 0"), ["p_partkey"], default, ["p_size"], "brand").select("p_partkey", "brand")


@query("""WITH k AS (SELECT 'S' || s_suppkey AS id, s_suppkey, s_suppkey % 60 AS p FROM supplier), a AS (SELECT c_custkey, c_custkey % 90 AS p FROM customer), least AS (SELECT p, min(id) AS id FROM k GROUP BY 1)
 SELECT CAST(c_custkey AS VARCHAR) AS source_swimmer_id, CASE WHEN k.id IS NOT NULL THEN 'alias' WHEN l.id IS NOT NULL THEN 'identity' ELSE 'new' END AS resolution,
 coalesce(k.id, l.id, 'CANON::' || substr(sha1('SUI|F|' || (1980 + a.p % 15) || '|F' || a.p || '|L' || a.p), 1, 32)) AS swimmer_id
 FROM a LEFT JOIN k ON s_suppkey=c_custkey AND s_suppkey % 4 = 0 AND k.p=a.p LEFT JOIN least l ON l.p=a.p""")
def identity_cascade(spark, sf):
    person = lambda key: [F.concat(F.lit("F"), key).alias("first_name"), F.concat(F.lit("L"), key).alias("last_name"), (1980 + key % 15).cast("int").alias("birth_year"), F.lit("F").alias("gender"), F.lit("SUI").alias("country_code")]
    s = V.table(spark, sf, "supplier")
    known = s.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("swimmer_id"), *person(F.col("s_suppkey") % 60))
    athletes = V.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("source_swimmer_id"), F.lit("SUI").alias("source_country_code"), *person(F.col("c_custkey") % 90))
    aliases = s.where("s_suppkey % 4 = 0").select(F.col("s_suppkey").cast("string").alias("source_swimmer_id"), F.lit("SUI").alias("source_country_code"), F.concat(F.lit("S"), F.col("s_suppkey")).alias("swimmer_id"))
    return resolve.cascade(athletes, aliases, known).select("source_swimmer_id", "resolution", "swimmer_id")


@query("""WITH k AS (SELECT 'S' || s_suppkey AS id, s_suppkey % 9 AS f, s_suppkey % 3 AS y, s_suppkey % 2 AS n, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey * 3 + 1 END AS alias FROM supplier),
 a AS (SELECT c_custkey, c_custkey % 7 AS f, c_custkey % 3 AS y, c_custkey % 2 AS n, CASE WHEN c_custkey % 5 = 0 THEN 'pdf' ELSE 'lenex' END AS kind FROM customer),
 p AS (SELECT c_custkey, kind, k.id, kind='lenex' AND alias=c_custkey AND k.n=a.n AS hit FROM a JOIN k ON k.f=a.f AND k.y=a.y AND (kind='pdf' OR k.n=a.n)),
 c AS (SELECT c_custkey, count(*) AS everyone, min(id) AS any_id, count(*) FILTER (WHERE hit) AS hits, min(id) FILTER (WHERE hit) AS hit_id FROM p GROUP BY 1),
 n AS (SELECT a.c_custkey, kind, CASE WHEN hits=1 THEN 1 ELSE coalesce(everyone, 0) END AS candidates, CASE WHEN hits=1 THEN hit_id ELSE any_id END AS id FROM a LEFT JOIN c USING (c_custkey))
 SELECT c_custkey, CAST(candidates AS BIGINT) AS candidates, CASE WHEN candidates=1 THEN 'link' WHEN candidates=0 AND kind='lenex' THEN 'create' ELSE 'hold' END AS route,
 CASE WHEN candidates > 1 THEN 'ambiguous_identity' WHEN candidates=0 AND kind='pdf' THEN 'unknown_identity' END AS reason, CASE WHEN candidates=1 THEN id END AS swimmer_id FROM n""")
def candidate_holds(spark, sf):
    who = lambda k, f: [F.concat(F.lit("f"), F.col(k) % f).alias("first_name"), F.lit(" X ").alias("last_name"), (F.col(k) % 3).alias("birth_year"), F.lit("F").alias("gender"), F.concat(F.lit("N"), F.col(k) % 2).alias("country_code")]
    s = V.table(spark, sf, "supplier")
    known = s.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("swimmer_id"), *who("s_suppkey", 9)).withColumn("first_name", F.upper("first_name"))
    kind = F.when(F.col("c_custkey") % 5 == 0, "pdf").otherwise("lenex").alias("source_kind")
    athletes = V.table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("source_swimmer_id"), kind, *who("c_custkey", 7))
    aliases = s.where("s_suppkey % 2 = 0").select((F.col("s_suppkey") * 3 + 1).cast("string").alias("source_swimmer_id"), F.lit("N0").alias("source_country_code"), F.concat(F.lit("S"), F.col("s_suppkey")).alias("swimmer_id"))
    out = resolve.candidates(athletes, known, aliases)
    return out.select("c_custkey", F.col("candidates").cast("long").alias("candidates"), "route", "reason", "swimmer_id")


@query("SELECT o_custkey AS swimmer_id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS club_name FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def latest_club(spark, sf):
    club = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return dedup.latest_club(V.table(spark, sf, "orders").select(F.col("o_custkey").alias("swimmer_id"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("result_date"), club.alias("club_name")))


@query("""SELECT 'line_part' AS relation, count(*) AS violations FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 1)
 UNION ALL SELECT 'order_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def fk_violations(spark, sf):
    t = lambda n: V.table(spark, sf, n)
    return match.orphans([("line_part", t("lineitem"), "l_partkey", t("part").where("p_size > 1"), "p_partkey"), ("order_customer", t("orders"), "o_custkey", t("customer").where("c_acctbal > 0"), "c_custkey")])


@query("SELECT o_orderkey, s AS splits FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS s FROM lineitem GROUP BY 1) ON l_orderkey=o_orderkey")
def ordered_splits(spark, sf):
    kids = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    out = match.with_children(V.table(spark, sf, "orders").select("o_orderkey"), kids, "o_orderkey", ["l_linenumber", "l_partkey"], ["l_partkey"])
    return out.select("o_orderkey", F.when(F.col("splits").isNotNull(), F.array_join(F.transform("splits", lambda x: x["l_partkey"].cast("string")), ",")).alias("splits"))


@query("""WITH i AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2=0), c AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2=1)
 SELECT o_orderkey FROM i WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.o_custkey=i.o_custkey AND abs(c.o_totalprice-i.o_totalprice) < 20000)""")
def tolerance_anti(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return match.not_stored(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey"], value="o_totalprice", tolerance=20000).select("o_orderkey")


# --- rankings, records, coverage -------------------------------------------------------


@query(f"WITH {_V} SELECT event_id, course, swimmer_id, time_seconds, meet_id, line, rank() OVER (PARTITION BY event_id, course ORDER BY time_seconds) AS position FROM v")
def competition_rank(spark, sf):
    out = rankings.competition_rank(V.valid_swims(spark, sf), ["event_id", "course"], "time_seconds")
    return out.select("event_id", "course", "swimmer_id", "time_seconds", "meet_id", "line", F.col("position").cast("long").alias("position"))


@query(f"WITH {_V}, b AS (SELECT distance, stroke, course, min(points_fina) AS points_fina FROM v GROUP BY ALL) SELECT DISTINCT distance, stroke, course, points_fina, swimmer_id FROM v JOIN b USING (distance, stroke, course, points_fina)")
def record_holders(spark, sf):
    return rankings.holders(V.valid_swims(spark, sf), ["distance", "stroke", "course"], "points_fina", ["swimmer_id"])


@query("SELECT o_custkey AS key, o_orderkey, position, expected FROM (SELECT o_custkey, o_orderkey, CAST(o_orderkey % 4 + 1 AS INT) AS position, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS INT) AS expected FROM orders) WHERE position <> expected")
def rank_check(spark, sf):
    rows = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", "o_totalprice", (F.col("o_orderkey") % 4 + 1).cast("int").alias("position"))
    return rankings.rank_breaks(rows, ["key"], "o_totalprice").select("key", "o_orderkey", "position", "expected")


@query("SELECT o_custkey, o_orderkey, o_totalprice, previous FROM (SELECT *, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous FROM orders) WHERE o_totalprice < previous")
def order_check(spark, sf):
    return rankings.order_breaks(V.table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderkey"), "o_totalprice").select("o_custkey", "o_orderkey", "o_totalprice", "previous")


@query("""WITH e AS (SELECT p_type, p_size, n_name FROM (SELECT DISTINCT p_type FROM part), (SELECT DISTINCT p_size FROM part WHERE p_size < 12), (SELECT n_name FROM nation WHERE n_nationkey < 6)),
 a AS (SELECT DISTINCT p_type, p_size, n_name FROM lineitem JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey WHERE p_size < 14 AND n_nationkey BETWEEN 3 AND 7)
 SELECT p_type, p_size, n_name, CASE WHEN a.n_name IS NULL THEN 'missing' WHEN e.n_name IS NULL THEN 'unlisted' ELSE 'available' END AS state FROM (SELECT *, 1 AS x FROM e) e FULL JOIN (SELECT *, 1 AS y FROM a) a USING (p_type, p_size, n_name)""".replace("a.n_name IS NULL", "y IS NULL").replace("e.n_name IS NULL", "x IS NULL"))
def coverage_missing(spark, sf):
    t = lambda n: V.table(spark, sf, n)
    expected = match.grid(t("part").select("p_type").distinct(), t("part").where("p_size < 12").select("p_size").distinct(), t("nation").where("n_nationkey < 6").select("n_name"))
    lines = t("lineitem").select("l_partkey", "l_suppkey").join(t("part").where("p_size < 14"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation").where("n_nationkey between 3 and 7"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rankings.coverage(expected, lines, ["p_type", "p_size", "n_name"])


@query("SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE < DATE '1997-02-01' AND o_orderdate::DATE + CAST(o_orderkey % 10 AS INT) >= DATE '1997-01-01'")
def month_overlap(spark, sf):
    day = F.to_date("o_orderdate")
    o = V.table(spark, sf, "orders").select("o_orderkey", day.alias("day"), F.date_add(day, (F.col("o_orderkey") % 10).cast("int")).alias("until"))
    return o.where(P.overlaps(F.col("day"), F.col("until"), F.lit("1997-01-01").cast("date"), F.lit("1997-02-01").cast("date"))).select("o_orderkey", "day")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ALL")
def status_counts(spark, sf):
    return V.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_suppkey").alias("suppliers"))


_LISTS = """l AS (SELECT p_partkey, CASE p_size % 9 WHEN 0 THEN 'WR' WHEN 1 THEN 'ER' WHEN 2 THEN 'SUI' WHEN 3 THEN 'SUI.RZW' WHEN 4 THEN 'SUI.JR' WHEN 5 THEN 'FAR' WHEN 6 THEN 'SUI.MS' WHEN 7 THEN 'AUT' END AS kind,
 CASE WHEN p_size % 9 = 5 THEN 'FRO' WHEN p_size % 9 < 8 THEN 'SUI' END AS nation, CASE WHEN p_partkey % 3 = 0 THEN 12 WHEN p_partkey % 3 = 1 THEN -1 END AS least, CASE WHEN p_partkey % 4 = 0 THEN 14 END AS most,
 CASE p_brand WHEN 'Brand#1' THEN 'Olympic Records' WHEN 'Brand#2' THEN 'Archiv 1990' WHEN 'Brand#3' THEN 'REGIO list' ELSE p_name END AS name, CASE WHEN p_partkey % 17 = 0 THEN 'RZW' END AS region FROM part)"""


@query(f"""WITH {_LISTS}, b AS (SELECT *, coalesce(least, 0) > 0 OR coalesce(most, 0) > 0 AS bounded FROM l)
 SELECT p_partkey, CASE WHEN region IS NOT NULL OR regexp_matches(lower(name), 'until |archiv|former |championship|olympic|games|world cup|regio|provincial|para record') THEN 'excluded'
 WHEN kind='WR' AND NOT bounded THEN 'world' WHEN kind='ER' AND NOT bounded THEN 'europe' WHEN kind=nation OR (nation='FRO' AND kind='FAR') OR (bounded AND kind IN (nation || '.JR', nation || '.MS')) THEN CASE WHEN bounded THEN 'age' ELSE 'national' END ELSE 'unmapped' END AS scope FROM b""")
def scope_classify(spark, sf):
    lists = V.record_lists(spark, sf)
    scope = S.record_scope(*(F.col(c) for c in ("kind", "nation", "least", "most", "name", "region")))
    return lists.select("p_partkey", scope["scope"].alias("scope"))


@query(f"""WITH {_LISTS} SELECT p_partkey, CASE WHEN least=most THEN CAST(least AS VARCHAR) WHEN most IS NOT NULL AND coalesce(least, 0) <= 0 THEN most || 'u' WHEN least IS NOT NULL AND most IS NOT NULL THEN least || '-' || most ELSE 'open' END AS age_key,
 CASE WHEN least=most THEN least || ' years' WHEN most IS NOT NULL AND coalesce(least, 0) <= 0 THEN most || ' years and younger' WHEN least IS NOT NULL AND most IS NOT NULL THEN least || '-' || most || ' years' ELSE 'Open' END AS label FROM l""")
def record_ages(spark, sf):
    return V.record_lists(spark, sf).select("p_partkey", S.record_age_key(F.col("least"), F.col("most")).alias("age_key"), S.record_age_label(F.col("least"), F.col("most")).alias("label"))


_CLOCK = "CASE WHEN o_orderkey % 4 = 0 THEN 'NT' WHEN o_orderkey % 4 = 1 THEN lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || '.50' ELSE CAST(o_orderkey % 3 AS VARCHAR) || ':' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || '.25' END"


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 IN (2,3) THEN (o_orderkey % 3)*60 + o_custkey % 60 + 0.25 END AS DECIMAL(10,2)) AS strict,
 CAST(CASE WHEN o_orderkey % 4 = 1 THEN o_custkey % 60 + 0.5 WHEN o_orderkey % 4 IN (2,3) THEN (o_orderkey % 3)*60 + o_custkey % 60 + 0.25 END AS DECIMAL(10,2)) AS lenient,
 CAST(CASE WHEN o_orderkey % 4 = 1 THEN (o_custkey % 60)*100 + 50 WHEN o_orderkey % 4 IN (2,3) THEN ((o_orderkey % 3)*60 + o_custkey % 60)*100 + 25 END AS INT) AS cs FROM orders""")
def clock_parse(spark, sf):
    text = F.expr(_CLOCK.replace("VARCHAR", "STRING"))
    return V.table(spark, sf, "orders").select("o_orderkey", S.clock_strict(text).alias("strict"), S.clock_lenient(text).alias("lenient"), S.centiseconds(text).alias("cs"))


@query("""SELECT c_custkey, 'CANON::' || substr(sha1(c_mktsegment || '|' || CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END || '|' || coalesce(CAST(CASE WHEN c_custkey % 3 > 0 THEN c_nationkey END AS VARCHAR), '') || '|' || c_name || '|L' || c_custkey), 1, 32) AS swimmer_id FROM customer""")
def canonical_ids(spark, sf):
    year, sex = F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey")), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M")
    return V.table(spark, sf, "customer").select("c_custkey", S.canonical_swimmer_id(F.col("c_mktsegment"), sex, year, F.col("c_name"), F.concat(F.lit("L"), "c_custkey")).alias("swimmer_id"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate)>=9 THEN 1 ELSE 0 END AS INT) AS season, CASE WHEN o_custkey % 3=0 THEN CAST(o_custkey % 5 + 8 AS VARCHAR) || '-' || CAST(o_custkey % 5 + 9 AS VARCHAR) WHEN o_custkey % 3=1 THEN '>=' || CAST(o_custkey % 5 + 8 AS VARCHAR) ELSE '<=' || CAST(o_custkey % 5 + 9 AS VARCHAR) END AS band,
 substr(replace(o_orderpriority || '_' || CAST(o_orderdate::DATE AS VARCHAR), ' ', '_'), 1, 100) AS meet_key FROM orders""")
def season_and_keys(spark, sf):
    q, low = F.col("o_custkey") % 3, (F.col("o_custkey") % 5 + 8).cast("int")
    day = F.to_date("o_orderdate")
    return V.table(spark, sf, "orders").select("o_orderkey", S.season_end_year(day).alias("season"), S.age_band(F.when(q <= 1, low), F.when(q != 1, low + 1)).alias("band"), S.meet_key(F.col("o_orderpriority"), day).alias("meet_key"))


@query("""WITH o AS (SELECT o_custkey AS meet, CAST(o_orderdate AS DATE) AS day FROM orders), m AS (SELECT meet, min(day) AS a, max(day) AS b FROM o GROUP BY 1)
 SELECT meet, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM m EXCEPT SELECT meet, day FROM o""")
def days_without_results(spark, sf):
    o = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("meet"), F.to_date("o_orderdate").alias("result_date"))
    days = o.groupBy("meet").agg(F.min("result_date").alias("start_date"), F.max("result_date").alias("end_date"))
    return quality.days_without_results(days, o, "meet")


# --- pages and texts ---------------------------------------------------------------------


@query(r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>.*?</a>', 1)) AS href FROM pages) SELECT page_id, href, count(*) AS links FROM a GROUP BY ALL""")
def link_inventory(spark, sf):
    return html.links(V.table(spark, sf, "pages"), ["page_id"]).groupBy("page_id", "href").agg(F.count("label").alias("links"))


@query(r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>.*?</a>', 1)) AS href FROM pages) SELECT DISTINCT page_id, href FROM a WHERE regexp_matches(href, '^/[a-d]')""")
def result_links(spark, sf):
    return html.result_links(V.table(spark, sf, "pages"), ["page_id"], [], "^/[a-d]")


@query(r"""WITH l AS (SELECT doc_id, generate_subscripts(s, 1) - 1 AS line_no, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))
 SELECT doc_id, CAST(line_no AS INT) AS line_no, last_value(CASE WHEN length(line) < 40 THEN length(line) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l""")
def text_carry_forward(spark, sf):
    lines = html.text_lines(V.table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    heading = F.when(F.length("line") < 40, F.length("line"))
    return html.carried(lines, ["doc_id"], heading, "heading").select("doc_id", "line_no", F.col("heading").cast("long").alias("heading"))


# --- nested documents and validation ---------------------------------------------------------


@query("""SELECT o_orderkey AS meet_id, '{"events":[' || coalesce(e, '') || '],"meet":{"day":"' || CAST(o_orderdate AS DATE) || '"},"meet_id":' || o_orderkey || ',"results":[' || coalesce(r, '') || ']}' AS document FROM orders
 LEFT JOIN (SELECT l_orderkey AS k, string_agg('{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey || '}', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem GROUP BY 1) a ON a.k = o_orderkey
 LEFT JOIN (SELECT l_orderkey AS k, string_agg('{"l_partkey":' || l_partkey || '}', ',' ORDER BY l_partkey) AS e FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1) b ON b.k = o_orderkey""")
def meet_documents(spark, sf):
    """Whole documents, as canonical JSON."""
    meets = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("meet_id"), F.to_date("o_orderdate").alias("day"))
    rows = V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("meet_id"), "l_linenumber", "l_partkey", "l_suppkey")
    docs = packages.meet_documents(meets, {"results": rows, "events": rows.select("meet_id", "l_partkey").distinct()})
    return docs.select("meet_id", canonical_rows(docs).alias("document"))


@query("""SELECT o_orderkey AS id, md5(concat_ws('|', n, o_orderstatus)) AS fingerprint FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey=o_orderkey WHERE n IS NOT NULL""")
def payload_fingerprints(spark, sf):
    n = quality.counts(V.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    return V.table(spark, sf, "orders").join(n, "o_orderkey").select(F.col("o_orderkey").alias("id"), S.plain_fingerprint(F.col("n"), F.col("o_orderstatus")).alias("fingerprint"))


@query("""WITH b AS (SELECT user_id, event_type, event_id FROM events WHERE event_id % 4 <> 0), n AS (SELECT user_id, event_type, event_id FROM events WHERE event_id % 9 <> 0)
 SELECT user_id, count(*) FILTER (WHERE b.event_id IS NULL) AS added, count(*) FILTER (WHERE n.event_id IS NULL) AS removed, count(*) FILTER (WHERE b.event_id=n.event_id) AS unchanged,
 CASE WHEN count(*) FILTER (WHERE n.event_id IS NULL) > 0 THEN 'held' WHEN count(*) FILTER (WHERE b.event_id=n.event_id) = 0 THEN 'new' WHEN count(*) FILTER (WHERE b.event_id IS NULL) > 0 THEN 'changed' ELSE 'unchanged' END AS decision FROM b FULL JOIN n USING (user_id, event_id) GROUP BY 1""".replace("b.event_id IS NULL", "x IS NULL").replace("n.event_id IS NULL", "y IS NULL").replace("b.event_id=n.event_id", "x=y").replace("event_id % 4 <> 0)", "event_id % 4 <> 0)").replace("SELECT user_id, event_type, event_id FROM events WHERE event_id % 4", "SELECT user_id, event_id, 1 AS x FROM events WHERE event_id % 4").replace("SELECT user_id, event_type, event_id FROM events WHERE event_id % 9", "SELECT user_id, event_id, 1 AS y FROM events WHERE event_id % 9"))
def readiness(spark, sf):
    e = V.table(spark, sf, "events")
    out = quality.readiness(e.where("event_id % 4 <> 0"), e.where("event_id % 9 <> 0"), ["event_id"], ["event_type"], ["user_id"])
    return out.select("user_id", "added", "removed", "unchanged", "decision")
