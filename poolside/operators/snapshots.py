"""Complete snapshots of meets: what they say replaces what is stored, under ids that stay.

Source rows keep the ids that the ledger gave them. A source row that the ledger does not
know takes over the stored race with its signature; what is left gets new ids. Splits move
with their results. A snapshot that contradicts the ledger or itself is refused as a
whole and reported; the other meets of the batch are applied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settled
from .delta import affected_since
from .ids import allocate
from .match import null_safe

#: What makes a stored race and an incoming one the same; nulls are equal to nulls.
SIGNATURE = ["swimmer_key", "event_key", "heat", "result_date", "event_round", "is_relay", "relay_count"]
MEET, SOURCE = ["publisher", "meet_key"], ["publisher", "source_id"]


@dataclass(frozen=True)
class Applied:
    """The next tables, and (publisher, meet_key, status, results, splits, deleted, affected_from) of each snapshot."""

    results: DataFrame
    splits: DataFrame
    ledger: DataFrame
    report: DataFrame


def resolved(results: DataFrame, ledger: DataFrame, scopes: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming with the stored id as ``target``: by the ledger, else by signature, else null."""
    return _named_by(_races(results, scopes), ledger, incoming)


def _races(results: DataFrame, scopes: DataFrame) -> DataFrame:
    """The stored races of the meets in scopes, with their smallest id and how many rows each has."""
    stored = results.join(scopes.select("meet_key").distinct(), "meet_key", "left_semi")
    return stored.groupBy("meet_key", *SIGNATURE).agg(F.min("id").alias("_signed"), F.count(F.lit(1)).alias("_times"))


def _named_by(races: DataFrame, ledger: DataFrame, incoming: DataFrame) -> DataFrame:
    mapped = incoming.join(ledger.select(*SOURCE, F.col("target_id").alias("_mapped")), SOURCE, "left")
    both = null_safe(mapped, races.drop("_times"), ["meet_key", *SIGNATURE], "left")
    return both.withColumn("target", F.coalesce("_mapped", "_signed")).drop("_mapped", "_signed")


def refusals(results: DataFrame, ledger: DataFrame, scopes: DataFrame, incoming: DataFrame) -> DataFrame:
    """(publisher, meet_key, reason): why snapshots cannot be applied."""
    races = settled(_races(results, scopes))
    return _refused(races, settled(_named_by(races, ledger, incoming)), ledger, scopes)


def _refused(races: DataFrame, found: DataFrame, ledger: DataFrame, scopes: DataFrame) -> DataFrame:
    wanted = scopes.select(*MEET).distinct()
    incoming = found.drop("target")
    repeated = lambda rows, keys: rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    owner = ledger.select("meet_key", F.col("publisher").alias("_other")).union(wanted.select("meet_key", "publisher")).distinct()
    said = {
        "no_source_id": incoming.where("source_id IS NULL"),
        "outside_the_scope": incoming.join(wanted, MEET, "left_anti"),
        "repeated_source_id": incoming.join(repeated(incoming.where("source_id IS NOT NULL"), SOURCE), SOURCE),
        "repeated_race": repeated(incoming, [*MEET, *SIGNATURE]),
        "ambiguous_stored_race": wanted.join(races.where("_times > 1"), "meet_key"),
        "source_id_of_another_meet": incoming.join(ledger.select(*SOURCE, F.col("meet_key").alias("_meet")), SOURCE).where("_meet <> meet_key"),
        "two_sources_for_one_result": found.join(repeated(found.where("target IS NOT NULL"), ["target"]), "target"),
        "meet_of_another_publisher": wanted.join(owner, "meet_key").where("_other <> publisher"),
    }
    out = None
    for reason, rows in said.items():
        part = rows.select(*MEET, F.lit(reason).alias("reason"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def apply_snapshots(results: DataFrame, splits: DataFrame, ledger: DataFrame, scopes: DataFrame, incoming: DataFrame, incoming_splits: DataFrame) -> Applied:
    """UPS7, J16, J20: apply the complete snapshots of the meets that ``scopes`` names.

    results: id, meet_key, the signature, values. splits: result_id, values. ledger: publisher,
    source_id, meet_key, target_id. scopes: publisher, meet_key, start_date; a meet
    without incoming rows is emptied. incoming: publisher, source_id, meet_key, the
    signature, values; columns of results that it lacks keep what is stored.
    incoming_splits: publisher, source_id, values.
    """
    races = settled(_races(results, scopes))
    sent = settled(_named_by(races, ledger, incoming))
    refused = settled(_refused(races, sent, ledger, scopes))
    why = refused.groupBy(*MEET).agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("_why"))
    good = scopes.join(refused, MEET, "left_anti")
    found = settled(sent.join(good, MEET, "left_semi"))
    added = allocate(found.where("target IS NULL").drop("target"), SOURCE, results.select("id").union(ledger.select("target_id")), "target")
    named = settled(found.where("target IS NOT NULL").unionByName(added))
    stored = results.join(good.select("meet_key"), "meet_key", "left_semi")
    kept = [c for c in results.columns if c != "id" and c not in incoming.columns]
    ids = named.select(F.col("target").alias("id"))
    # one join by id: new rows with what they keep of the old one, and old rows that no snapshot replaces
    emptied = good.select("meet_key", F.lit(True).alias("_is_emptied")).distinct()
    old = results.join(emptied, "meet_key", "left").select(F.col("id").alias("_id"), "_is_emptied", *(F.col(c).alias(f"_{c}") for c in results.columns if c != "id"))
    both = old.join(named, F.col("_id") == F.col("target"), "full_outer").where("target IS NOT NULL OR _is_emptied IS NULL")
    new = lambda c: F.col("target" if c == "id" else f"_{c}" if c in kept else c)
    next_results = both.select(*(F.when(F.col("target").isNotNull(), new(c)).otherwise(F.col(f"_{c}")).alias(c) for c in results.columns))
    moved = incoming_splits.join(named.select(*SOURCE, F.col("target").alias("result_id")), SOURCE)
    gone = stored.select("id").union(ids).distinct().withColumnRenamed("id", "result_id")
    next_splits = splits.join(gone, "result_id", "left_anti").unionByName(moved.select(*splits.columns))
    mapped = named.select(*SOURCE, "meet_key", F.col("target").alias("target_id"))
    next_ledger = ledger.join(good, MEET, "left_anti").join(mapped, SOURCE, "left_anti").unionByName(mapped.select(*ledger.columns))
    counted = lambda frame, name: frame.groupBy(*MEET).agg(F.count(F.lit(1)).alias(name))
    deleted = good.select(*MEET).join(stored.select("meet_key", "id"), "meet_key").join(ids, "id", "left_anti")
    since = affected_since(stored.join(good.select(*MEET), "meet_key"), named, good, MEET)
    report = scopes.select(*MEET).unionByName(refused.select(*MEET)).distinct().join(why, MEET, "left").withColumn("status", F.coalesce("_why", F.lit("applied"))).drop("_why")
    for frame in (counted(named, "results"), counted(moved.join(named.select(*SOURCE, "meet_key"), SOURCE), "splits"), counted(deleted, "deleted")):
        report = report.join(frame, MEET, "left")
    report = report.fillna(0, ["results", "splits", "deleted"]).join(since, MEET, "left")
    return Applied(next_results, next_splits, next_ledger, report)
