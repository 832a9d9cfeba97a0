"""Upserts, snapshot differences and fingerprints of whole tables.

Tables are DataFrames; an operator returns the next version of a table, and
poolside.sources.tables writes and publishes versions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import pick_first
from .ids import allocate

OVERWRITE, KEEP_IF_NULL, NEVER, FILL_NULL, GREATEST, LEAST = "overwrite", "keep_if_null", "never", "fill_null", "greatest", "least"


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], policy: Mapping[str, str] | None = None, *, default: str = OVERWRITE, null_keys_match: bool = False) -> DataFrame:
    """UPS1, UPS2, UPS17, SNK2-SNK4, SNK9: target with incoming merged in, by a policy for each column.

    overwrite takes the incoming value; keep_if_null takes it unless null; fill_null
    takes it only where the target is null; never keeps the target's; greatest and
    least keep one of both. Rows found on one side only are kept as they are. Keys with a
    null never match unless ``null_keys_match``. incoming has one row for each key.
    """
    policy = policy or {}
    columns = target.columns
    t, i = target.withColumn("_t", F.lit(1)).alias("t"), incoming.withColumn("_i", F.lit(1)).alias("i")
    same = F.lit(True)
    for k in keys:
        a, b = F.col(f"t.{k}"), F.col(f"i.{k}")
        same = same & (a.eqNullSafe(b) if null_keys_match else (a == b))
    both = t.join(i, same, "full")
    has_t, has_i = F.col("t._t").isNotNull(), F.col("i._i").isNotNull()

    def merged(c: str) -> Column:
        old = F.col(f"t.{c}")
        if c not in incoming.columns:
            return old
        new, how = F.col(f"i.{c}"), policy.get(c, default)
        if c in keys:
            return F.when(has_t, old).otherwise(new)
        kept = {
            OVERWRITE: new, KEEP_IF_NULL: F.coalesce(new, old), NEVER: old, FILL_NULL: F.coalesce(old, new),
            GREATEST: F.greatest(old, new), LEAST: F.least(old, new),
        }[how]
        return F.when(has_t & has_i, kept).when(has_i, new).otherwise(old)

    return both.select(*(merged(c).cast(target.schema[c].dataType).alias(c) for c in columns))


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """SNK1, SNK3, SNK10, SNK13: target and the incoming rows with new keys, of each the first by the other columns.

    Rows with a null in a key are all new, as a database would have it.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    order = [F.asc_nulls_last(c) for c in incoming.columns if c not in keys] or [F.lit(1)]
    first = pick_first(incoming.where(whole), keys, order).unionByName(incoming.where(~whole))
    new = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def with_dimension(dimension: DataFrame, wanted: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """SNK13: the dimension with a row and a new id for each key that it does not have; other columns of new rows are null.

    Rows with a null in a key name nothing and are left out.
    """
    named = wanted.select(*keys).distinct().dropna(subset=keys)
    new = allocate(named.join(dimension.select(*keys), keys, "left_anti"), keys, dimension.select(id_col), id_col)
    return dimension.unionByName(new, allowMissingColumns=True)


def replace_children(children: DataFrame, incoming: DataFrame, parent: str) -> DataFrame:
    """SNK5: all children of parents that have incoming ones are replaced."""
    return children.join(incoming.select(parent).distinct(), parent, "left_anti").unionByName(incoming.select(*children.columns))


def replace_partitions(target: DataFrame, incoming: DataFrame, keys: list[str], value_columns: list[str]) -> DataFrame:
    """SNK6: partitions whose content hash differs are replaced; others stay untouched."""
    old, new = set_digest(target, keys, value_columns), set_digest(incoming, keys, value_columns)
    changed = new.join(old.withColumnRenamed("digest", "_old"), keys, "left").where(~F.col("digest").eqNullSafe(F.col("_old"))).select(*keys)
    kept = target.join(changed, keys, "left_anti")
    return kept.unionByName(incoming.join(changed, keys, "left_semi").select(*target.columns))


def set_digest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A15, UPS9, UPS12: a content hash of the multiset of rows of each key, whatever their order.

    Four parts of 32 bits of each row's sha256 are added up as long integers, which have room
    for two billion rows of a key; a key of any size costs five numbers.
    """
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring("_h", 1 + 8 * k, 8), 16, 10).cast("long"))
    return rows.select(*keys, row.alias("_h")).groupBy(*keys).agg(F.sha2(F.concat_ws(",", F.count(F.lit(1)), *(part(k) for k in range(4))), 256).alias("digest"))


def sorted_digest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The sha256 of the sorted sha256 of a key's rows, each a JSON object, repeats included.

    A task holds the hashes of one key's rows: a meet's, 64 bytes each.
    """
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    return rows.groupBy(*keys).agg(F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(row))), 256).alias("digest"))


def compare(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Each key with its state: added, removed, changed or unchanged."""
    o = old.select(*keys, F.struct(*columns).alias("_o"))
    n = new.select(*keys, F.struct(*columns).alias("_n"))
    both = o.join(n, keys, "full")
    state = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_o").eqNullSafe(F.col("_n")), "unchanged").otherwise("changed")
    return both.select(*keys, state.alias("state"))


def dirty_keys(changes: list[tuple[DataFrame, str]]) -> DataFrame:
    """UPS14, U1: distinct ids touched by changes of several tables, each mapped to the fact's id."""
    out = None
    for frame, key in changes:
        ids = frame.select(F.col(key).alias("id"))
        out = ids if out is None else out.unionByName(ids)
    return out.distinct()


def oldest(dirty: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first n keys, 1 to 5000, by order; Spark keeps n rows a partition."""
    if not 1 <= n <= 5000:
        raise ValueError("n must be from 1 to 5000")
    return dirty.orderBy(order).limit(n)


def refresh_fingerprints(projection: DataFrame, payloads: DataFrame, dirty: DataFrame, key: str = "id", by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """UPS13: (next projection, report) for dirty keys. Gone keys leave, changed ones are replaced, equal ones stay.

    projection: key, fingerprint. payloads: the same, computed from the current tables.
    The report counts processed, changed and removed keys, for each value of the
    columns ``by`` of dirty, if any are named.
    """
    ids = dirty.select(key, *(by or [])).distinct()
    asked = ids.select(key).distinct()
    now = payloads.join(asked, key, "left_semi").select(key, F.col("fingerprint").alias("_new"))
    old = projection.select(key, F.col("fingerprint").alias("_old"))
    seen = ids.join(now, key, "left").join(old, key, "left")
    action = (
        F.when(F.col("_new").isNull() & F.col("_old").isNotNull(), "removed").when(F.col("_new").isNull(), "absent")
        .when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged").otherwise("changed")
    )
    actions = seen.select(*ids.columns, "_new", action.alias("action"))
    replaced = actions.where("action in ('changed', 'removed')")
    kept = projection.join(replaced.select(key), key, "left_anti")
    changed = actions.where("action = 'changed'").select(key, F.col("_new").alias("fingerprint")).distinct()
    out = kept.unionByName(changed, allowMissingColumns=True)
    report = actions.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("action") == "changed").alias("changed"), F.count_if(F.col("action") == "removed").alias("removed"))
    return out, report


def affected_from(dates: DataFrame, keys: list[str], day: str = "result_date") -> DataFrame:
    """A10, UPS15: the smallest date of each key, null if any date is unknown."""
    unknown = F.count_if(F.col(day).isNull()) > 0
    return dates.groupBy(*keys).agg(F.when(unknown, F.lit(None)).otherwise(F.min(day)).alias("affected_from"))


def affected_since(current: DataFrame, incoming: DataFrame, meets: DataFrame, keys: list[str], day: str = "result_date") -> DataFrame:
    """A10: from when on a meet's summaries are affected: the smallest date of its stored and incoming rows together, null if one is unknown.

    A meet without any row counts from its start_date; a pending_from of meets, if they have
    that column, stays in force until its refresh, and an unknown one (null under ``pending``) stays unknown.
    """
    dates = current.select(*keys, F.col(day).alias("_day")).unionByName(incoming.select(*keys, F.col(day).alias("_day")))
    found = dates.groupBy(*keys).agg(F.count_if(F.col("_day").isNull()).alias("_unknown"), F.min("_day").alias("_first"))
    own = F.when(F.col("_unknown").isNull(), F.col("start_date")).when(F.col("_unknown") == 0, F.col("_first"))
    out = meets.join(found, keys, "left").withColumn("affected_from", own)
    if "pending_from" in meets.columns:
        both = F.when(F.col("affected_from").isNotNull() & F.col("pending_from").isNotNull(), F.least("affected_from", "pending_from"))
        out = out.withColumn("affected_from", F.when(F.coalesce("pending", F.lit(False)), both).otherwise(F.col("affected_from")))
    return out.select(*keys, "affected_from")


def plan_actions(incoming: DataFrame, stored: DataFrame, keys: list[str], columns: list[str], *, strength: str = "strength", held: str = "held") -> DataFrame:
    """UPS3, UPS4, ST5: what to do with each incoming row: held, insert, unchanged, protected or update.

    A row of weaker evidence than the stored one is protected from it.
    """
    s = stored.select(*keys, F.struct(*columns).alias("_old"), F.col(strength).alias("_old_strength"))
    both = incoming.join(s, keys, "left")
    new = F.struct(*columns)
    action = (
        F.when(F.coalesce(F.col(held), F.lit(False)), "held").when(F.col("_old").isNull(), "insert").when(new.eqNullSafe(F.col("_old")), "unchanged")
        .when(F.col(strength) < F.col("_old_strength"), "protected").otherwise("update")
    )
    return both.withColumn("action", action).drop("_old", "_old_strength")


def plan_hash(plan: DataFrame, columns: list[str]) -> str:
    """UPS5: one hash of a plan; compare it again before writing."""
    row = set_digest(plan.withColumn("_all", F.lit(1)), ["_all"], columns).first()
    return row["digest"] if row else ""


def apply_plan(target: DataFrame, plan: DataFrame, keys: list[str], columns: list[str], expected: str, policy: Mapping[str, str] | None = None, severe: Column | None = None) -> DataFrame:
    """UPS5, UPS6: target with the plan's inserts and updates, if the plan is still the reviewed one and has no severe hold."""
    if plan_hash(plan, [*keys, *columns, "action"]) != expected:
        raise ValueError("the plan is stale")
    if severe is not None and not plan.where((F.col("action") == "held") & severe).isEmpty():
        raise ValueError("severe holds stand against this plan")
    rows = plan.where("action in ('insert', 'update')").select(*keys, *columns)
    return upsert(target, rows, keys, policy)


def apply_snapshot(target: DataFrame, snapshot: DataFrame, scopes: DataFrame, keys: list[str]) -> DataFrame:
    """UPS7, J16: complete snapshots replace their scopes: rows update, appear, or go; other scopes stay.

    scopes names what the snapshots cover, so that an empty one clears its scope. A
    key that a snapshot has twice, or a row outside the scopes, is an error.
    """
    scope = scopes.columns
    if not snapshot.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("the snapshot repeats a key")
    if not snapshot.join(scopes, scope, "left_anti").isEmpty():
        raise ValueError("the snapshot has rows outside its scope")
    return target.join(scopes, scope, "left_anti").unionByName(snapshot.select(*target.columns))


def chain_status(packages: DataFrame, ledger: DataFrame, key: str = "meet_id") -> DataFrame:
    """UPS8, UPS18: what each package is to the ledger: apply, repeat, conflict, stale or gap."""
    held = ledger.select(key, F.col("revision").alias("_rev"), F.col("sha256").alias("_sha"))
    p = packages.join(held, key, "left")
    status = (
        F.when((F.col("revision") == F.col("_rev")) & (F.col("sha256") == F.col("_sha")), "repeat").when(F.col("revision") == F.col("_rev"), "conflict")
        .when(F.col("revision") < F.col("_rev"), "stale")
        .when((F.col("revision") == F.coalesce("_rev", F.lit(0)) + 1) & F.col("previous").eqNullSafe(F.col("_sha")), "apply").otherwise("gap")
    )
    return p.withColumn("status", status).drop("_rev", "_sha")


def prefer_value(target: DataFrame, incoming: DataFrame, key: str, column: str, preferred: str) -> DataFrame:
    """UPS11: new keys are added; a stored row gives way only to one with the preferred value that it lacks itself."""
    old = target.select(key, F.col(column).alias("_old"))
    better = incoming.join(old, key, "left").where(F.col("_old").isNull() | ((F.col(column) == preferred) & (F.col("_old") != preferred))).drop("_old")
    return target.join(better.select(key), key, "left_anti").unionByName(better.select(*target.columns))


def pending_batch(ledger: DataFrame, group: list[str] | None = None) -> DataFrame:
    """UPS15: dirty meets as one batch (or one for each group): how many, from which date, and a digest over publisher, meet, revision and hash of each."""
    keys = group or ["_all"]
    unknown = F.count_if(F.col("affected_from").isNull()) > 0
    dirty = ledger.where("dirty").withColumn("_all", F.lit(1))
    counted = dirty.groupBy(*keys).agg(F.count(F.lit(1)).alias("meets"), F.when(unknown, F.lit(None)).otherwise(F.min("affected_from")).alias("affected_from"))
    named = set_digest(dirty, keys, ["meet_key", "publisher", "revision", "sha256"])
    return counted.join(named, keys).select(*(group or []), "meets", "affected_from", F.col("digest").alias("batch_id"))


def to_retry(receipts: DataFrame) -> DataFrame:
    """UPS16"""
    return receipts.where(~F.col("state").eqNullSafe("complete"))


def no_regression(old: DataFrame, new: DataFrame, key: str, value: str, *, lower_is_better: bool = True) -> DataFrame:
    """UPS10, J22: keys of old with a verdict: missing, worse or ok."""
    o, n = old.groupBy(key).agg(F.min(value).alias("_o") if lower_is_better else F.max(value).alias("_o")), new.groupBy(key).agg(F.min(value).alias("_n") if lower_is_better else F.max(value).alias("_n"))
    worse = F.col("_n") > F.col("_o") if lower_is_better else F.col("_n") < F.col("_o")
    verdict = F.when(F.col("_n").isNull(), "missing").when(worse, "worse").otherwise("ok")
    return o.join(n, key, "left").select(key, verdict.alias("verdict"))


def missing_keys(accepted: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """U4: once accepted, not there now; for review, nothing is deleted."""
    return accepted.join(current.select(*keys), keys, "left_anti")
