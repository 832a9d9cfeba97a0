"""Plans for live results: what to do with each source row, and why some are held.

One pass of joins over source rows, known swimmers, stored results and the ledger of
earlier imports gives each row an action or a reason to hold it. Nothing is written
while a plan is made; a gate decides by meet whether it may be applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.canonical import canonical_rows, digest_of, identity_key, race_key
from ..functions.predicates import acceptable_status
from ..functions.scalars import canonical_swimmer_id, folded_name
from .match import null_safe

#: Reasons that no review of identities can set aside.
SEVERE = ["previously_imported_races_missing", "receipt_result_mismatch", "event_number_or_identity_changed", "duplicate_race_identity", "ambiguous_existing_race", "invalid_time"]
ROW = ["live_id", "row_no"]
EVENT = ["event_number", "event_date", "event_round"]
STYLE = ["distance", "stroke", "event_gender", "pool_length"]
_WHO = ["_first", "_last", "birth_year", "gender"]


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_first": folded_name(F.col("first_name")), "_last": folded_name(F.col("last_name"))})


def _matches(rows: DataFrame, swimmers: DataFrame, aliases: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """rows with candidates and _who, the struct of the one swimmer's id and swimmer_id (null: none or several).

    Swimmers are counted by identity before they meet rows, so a name that many swimmers
    and many rows have makes no pairs.
    """
    who = F.struct(F.col("id").alias("id"), F.col("swimmer_id").alias("swimmer_id"))
    known = _named(swimmers).select(F.col("id").alias("_pk"), *_WHO, F.col("country_code").alias("_country"), who.alias("_is"))
    counted = lambda keys: known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_is").alias("_any"))
    by_name = counted([*_WHO, "_country"]).withColumn("_abroad", F.lit(False)).unionByName(counted(_WHO).withColumns({"_country": F.lit(None).cast("string"), "_abroad": F.lit(True)}))
    lenex = F.coalesce(F.col("source_kind") == "lenex", F.lit(False))
    anywhere = F.coalesce(F.col("source_kind") != "lenex", F.lit(False))
    named = _named(rows).withColumns({"_abroad": anywhere, "_country": F.when(~anywhere, F.col("nation"))})
    out = _with(named, by_name, [*_WHO, "_abroad", "_country"])
    # swimmers of an alias that bear the row's name in its own nation
    alias = aliases.select(F.col("source_country_code").alias("nation"), F.col("source_swimmer_id").alias("athlete_id"), F.col("swimmer_pk").alias("_pk")).distinct()
    own = alias.join(known, "_pk").where("_country = nation").groupBy("nation", "athlete_id", *_WHO).agg(F.count(F.lit(1)).alias("_hits"), F.min("_is").alias("_own"))
    out = _with(out, own.where("athlete_id IS NOT NULL"), ["nation", "athlete_id", *_WHO])
    one = lenex & F.coalesce(F.col("_hits") == 1, F.lit(False))
    n, is_ = F.when(one, 1).otherwise(F.coalesce("_n", F.lit(0))), F.when(one, F.col("_own")).when(F.col("_n") == 1, F.col("_any"))
    helpers = ["_n", "_any", "_hits", "_own", "_abroad", "_country"]
    if overrides is None:
        return out.withColumns({"candidates": n, "_who": is_}).drop(*helpers)
    fixed = overrides.select("identity_key", F.col("swimmer_pk").alias("_pk")).join(known, "_pk", "left")
    fixed = fixed.select("identity_key", F.col("_pk").alias("_fixed"), "_is", *(F.col(c).alias(f"_o{c}") for c in _WHO))
    out = out.withColumn("identity_key", identity_key(*(F.col(c) for c in ("first_name", "last_name", "birth_year", "gender", "club")))).join(fixed, "identity_key", "left")
    agrees = F.col("_is").isNotNull()
    for c in _WHO:
        agrees = agrees & F.col(c).eqNullSafe(F.col(f"_o{c}"))
    wrong = F.raise_error(F.concat(F.lit("reviewed identity does not match name, birth year and gender: "), F.col("identity_key"))).cast(swimmers.select(who.alias("w")).schema["w"].dataType)
    chosen = F.when(F.col("_fixed").isNull(), is_).when(agrees, F.col("_is")).otherwise(wrong)
    return out.withColumns({"candidates": F.when(F.col("_fixed").isNotNull(), 1).otherwise(n), "_who": chosen}).drop("identity_key", *helpers, "_fixed", "_is", *(f"_o{c}" for c in _WHO))


def _with(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """A left join on keys where nulls are equal; the table's keys are dropped."""
    return null_safe(rows, table, keys, "left")


def identified(rows: DataFrame, swimmers: DataFrame, aliases: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Rows with swimmer_pk (null: none or several) and how many candidates they have.

    A reviewed override decides, and is an error if its swimmer does not have the row's name,
    birth year and gender. Rows of LENEX files are looked for in their own nation,
    and the one candidate that the source's alias names decides.
    """
    return _matches(rows, swimmers, aliases, overrides).withColumn("swimmer_pk", F.col("_who.id")).drop("_who")


def build_plan(rows: DataFrame, payload: list[str], swimmers: DataFrame, aliases: DataFrame, events: DataFrame, results: DataFrame, ledger: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """UPS3, UPS4: rows with swimmer_key, race_key, payload_hash, result_id, action and reason.

    Actions are insert, update, unchanged, protected (a printed list never overrides what
    another source said, or a row with reaction time or splits) and held, with the first
    reason that applies. Of several rows of one race none is applied. Rows are named by live_id
    and row_no; payload names the columns whose change makes an update. Events are few and are
    broadcast. Whatever rows meet is grouped first, so no join multiplies them, and each
    join shuffles the rows once.
    """
    seen = _matches(rows, swimmers, aliases, overrides).withColumn("swimmer_pk", F.col("_who.id"))
    new = canonical_swimmer_id(*(F.col(c) for c in ("nation", "gender", "birth_year", "first_name", "last_name")))
    # a LENEX row whose race an earlier printed list gave to somebody else of that name
    prior = _named(ledger.where("source_kind = 'pdf'")).groupBy("live_id", *EVENT, *_WHO).agg(F.min("race_key").alias("_least"), F.max("race_key").alias("_most"))
    seen = _with(seen, prior, ["live_id", *EVENT, *_WHO]).withColumn("swimmer_key", F.coalesce("_who.swimmer_id", new))
    seen = seen.withColumn("race_key", race_key(F.col("swimmer_key"), *(F.col(c) for c in EVENT), F.col("is_relay")))
    pdf, lenex = F.col("source_kind") == "pdf", F.col("source_kind") == "lenex"
    timed = acceptable_status(F.col("status"), F.col("time_seconds"), lenex)
    identity = (
        F.when(~timed, "invalid_time").when(F.col("candidates") > 1, "ambiguous_identity").when((F.col("candidates") == 0) & pdf, "unknown_identity")
    )
    review = lenex & ((F.col("race_key") != F.col("_least")) | (F.col("race_key") != F.col("_most")))
    seen = seen.withColumn("_early", F.coalesce(identity, F.when(review, "lenex_identity_needs_review"))).drop("_who", "_least", "_most", *_WHO[:2])
    all_ = F.collect_list("result_id").over(Window.partitionBy("live_id", "race_key"))
    receipt = ledger.select("live_id", "race_key", F.col("result_id").alias("_receipt"), all_.alias("_receipts"), F.col("payload_hash").alias("_hash"), F.col("source_kind").alias("_kind"))
    seen = seen.join(receipt, ["live_id", "race_key"], "left").join(F.broadcast(events.select(F.col("id").alias("event_id"), *STYLE)), STYLE, "left")
    race = Window.partitionBy("live_id", "race_key", F.col("_early").isNull())
    open_ = F.col("_early").isNull()
    seen = seen.withColumns({"_times": F.when(open_, F.count(F.lit(1)).over(race)), "_nth": F.when(open_, F.row_number().over(race.orderBy("row_no")))})
    at = ["live_id", "swimmer_pk", "event_id", "event_date", "is_relay", "event_round"]
    taken = ledger.select("live_id", F.col("result_id").alias("id")).distinct().withColumn("taken", F.lit(True))
    stored = results.join(taken, ["live_id", "id"], "left").select(
        "live_id", F.col("swimmer_id").alias("swimmer_pk"), "event_id", F.col("result_date").alias("event_date"), F.coalesce("is_relay", F.lit(False)).alias("is_relay"), F.coalesce("event_round", F.lit("TIM")).alias("event_round"),
        F.struct("id", "heat", (F.col("reaction_time").isNotNull() | F.col("has_splits")).alias("rich"), "taken").alias("_old"),
    ).groupBy(*at).agg(F.collect_list("_old").alias("_stored"))
    # a swimmer's results in one event of one day
    seen = seen.join(stored, at, "left")
    of_heat = F.filter("_stored", lambda x: ~F.coalesce(lenex & F.col("heat").isNotNull(), F.lit(False)) | x["heat"].eqNullSafe(F.col("heat")))
    of_receipts = F.flatten(F.transform("_receipts", lambda r: F.filter("_stored", lambda x: x["id"] == r)))
    seen = seen.withColumn("_fits", F.when(open_, F.when(F.col("_receipt").isNotNull(), of_receipts).otherwise(of_heat)))
    seen = seen.withColumns({"_found": F.when(F.col("_fits").isNotNull(), F.size("_fits")), "_old": F.array_min("_fits")})
    has, known = F.coalesce("_found", F.lit(0)), F.col("_receipt").isNotNull()
    repeated = F.col("_times") > 1
    reason = F.coalesce(
        F.col("_early"), F.when(repeated & (F.col("_nth") > 1), "ambiguous_source_race"), F.when(known & (has != 1), "receipt_result_mismatch"), F.when(has > 1, "ambiguous_existing_race"),
        F.when((has == 1) & ~known & F.coalesce("_old.taken", F.lit(False)), "event_number_or_identity_changed"), F.when(repeated, "ambiguous_source_race"),
    )
    action = (
        F.when(F.col("reason").isNotNull(), "held").when(_protected(pdf, has, known), "protected").when(known & (F.col("_hash") == F.col("payload_hash")), "unchanged").when(has == 1, "update").otherwise("insert")
    )
    hashed = seen.withColumn("payload_hash", digest_of(canonical_rows(rows, payload)))
    out = hashed.withColumn("reason", reason).withColumn("action", action).withColumn("result_id", F.when(F.col("action") != "held", F.col("_old.id")))
    return out.select(*rows.columns, "swimmer_pk", "swimmer_key", "race_key", "payload_hash", "result_id", "action", "reason", open_.alias("reached"))


def _protected(pdf: Column, has: Column, known: Column) -> Column:
    return pdf & (has == 1) & (~known | (F.col("_kind") == "lenex") | F.coalesce(F.col("_old.rich"), F.lit(False)))


def missing_races(plan: DataFrame, ledger: DataFrame) -> DataFrame:
    """U4: races imported before, of events that the source has now, which it has no more: (live_id, race_key)."""
    now = plan.where("reason IS NULL OR reason <> 'invalid_time'").select("live_id", *EVENT).distinct()
    reached = plan.where("reached").select("live_id", "race_key").distinct()
    return ledger.join(now, ["live_id", *EVENT], "left_semi").join(reached, ["live_id", "race_key"], "left_anti").select("live_id", "race_key")


def gate(plan: DataFrame, missing: DataFrame, *, allow_held: bool = False) -> DataFrame:
    """UPS6: (live_id, entries, holds, verdict): apply, held (holds that nobody has allowed), refused (a severe hold) or empty."""
    lost = missing.groupBy("live_id").agg(F.count(F.lit(1)).alias("_lost"))
    by = plan.groupBy("live_id").agg(F.count_if(F.col("reason").isNull()).alias("entries"), F.count_if(F.col("reason").isNotNull()).alias("_held"), F.count_if(F.col("reason").isin(*SEVERE)).alias("_severe"))
    by = by.join(lost, "live_id", "left").withColumn("_lost", F.coalesce("_lost", F.lit(0)))
    holds = F.col("_held") + F.when(F.col("_lost") > 0, 1).otherwise(0)  # one hold for all missing races of a meet
    verdict = F.when((holds > 0) & F.lit(not allow_held), "held").when((F.col("_severe") > 0) | (F.col("_lost") > 0), "refused").when(F.col("entries") == 0, "empty").otherwise("apply")
    return by.select("live_id", "entries", holds.alias("holds"), verdict.alias("verdict"))


def selected_days(rows: DataFrame, days: list[str]) -> DataFrame:
    """FL12: rows of the selected days; a day outside a row's meet (start_date to end_date) is an error."""
    chosen = F.array(*(F.lit(d).cast("date") for d in days))
    outside = F.exists(chosen, lambda d: (d < F.col("start_date")) | (d > F.col("end_date")))
    checked = F.when(outside, F.raise_error(F.lit("selected day is outside the meet's schedule")).cast("date")).otherwise(F.col("event_date"))
    return rows.where(F.array_contains(chosen, checked))
