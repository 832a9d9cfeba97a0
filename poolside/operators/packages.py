"""Nested documents of whole meets: building, exporting and validating them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import canonical_json, digest_of
from .delta import set_digest


def field_differs(rows: DataFrame, field: str, value: str) -> DataFrame:
    """Rows whose payload field is not the value, null-safe."""
    return rows.where(~F.get_json_object("payload", f"$.{field}").eqNullSafe(F.lit(value)))


def without(rows: DataFrame, *provenance: str) -> DataFrame:
    """N4"""
    return rows.drop(*provenance)


def without_nested(rows: DataFrame, array: str, field: str) -> DataFrame:
    """A field dropped from the structs of an array."""
    return rows.withColumn(array, F.transform(array, lambda x: x.dropFields(field)))


def meet_documents(meets: DataFrame, parts: dict[str, DataFrame], key: str = "meet_id") -> DataFrame:
    """A row for each meet with each part as an array of structs in a fixed order.

    Each part is grouped on its own before the joins, so nothing multiplies.
    """
    out = meets.select(key, F.struct(*[c for c in meets.columns if c != key]).alias("meet"))
    for name, part in parts.items():
        rows = part.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*[c for c in part.columns if c != key]))).alias(name))
        out = out.join(rows, key, "left").withColumn(name, F.coalesce(name, F.array().cast(rows.schema[name].dataType)))
    return out


def packaged(documents: DataFrame, ledger: DataFrame, key: str = "meet_id") -> DataFrame:
    """SNK8: the next revision of each changed document, with the hash of the one before."""
    body = F.to_json(F.struct(*[c for c in documents.columns]), {"ignoreNullFields": "false"})
    held = ledger.select(key, F.col("revision").alias("_rev"), F.col("sha256").alias("previous"))
    out = documents.withColumn("payload", body).withColumn("sha256", F.sha2("payload", 256)).join(held, key, "left")
    changed = out.where(~F.col("sha256").eqNullSafe(F.col("previous")))
    return changed.select(key, (F.coalesce("_rev", F.lit(0)) + 1).alias("revision"), "previous", "sha256", "payload")


def in_order(documents: DataFrame, key: str = "meet_id") -> DataFrame:
    """T4: one order for whatever is written: by key, whole table, as a range sort over all executors."""
    return documents.orderBy(key)


def write_packages(packages: DataFrame, folder: str, key: str = "meet_id") -> None:
    """SNK8: gzip JSON, a folder for each key; earlier revisions stay."""
    packages.write.mode("append").partitionBy(key).option("compression", "gzip").json(folder)


#: What makes an event, and a race, of a package.
EVENT = ["distance", "stroke", "gender", "pool_length"]
SIGNATURE = ["swimmer_key", "event_key", "heat", "result_date", "event_round", "is_relay", "relay_count"]
#: part: (unique keys, {foreign key: (parent part, its key)})
RULES = {
    "countries": ([["code"]], {}),
    "swimmers": ([["swimmer_id"]], {"country_code": ("countries", "code")}),
    "aliases": ([["source_country_code", "source_swimmer_id"]], {"swimmer_key": ("swimmers", "swimmer_id"), "source_country_code": ("countries", "code")}),
    "events": ([["key"]], {}),
    "results": ([["source_id"], SIGNATURE], {"swimmer_key": ("swimmers", "swimmer_id"), "event_key": ("events", "key")}),
    "splits": ([["source_result_id", "split_order"], ["source_split_id"]], {"source_result_id": ("results", "source_id")}),
}
#: Foreign keys that may be null.
OPTIONAL = {("swimmers", "country_code")}


def _values(part: str, fields: list[str]) -> Column:
    """The fields of each element as one string, in which null is a value."""
    return F.transform(F.col(part), lambda x: F.to_json(F.struct(*(x[f].cast("string").alias(f) for f in fields)), {"ignoreNullFields": "false"}))


def _strangers(values: Column, known: Column, null_is_one: bool) -> Column:
    """How many of the values are not known; a null is a stranger only where it must not be."""
    missing = F.array_except(F.array_compact(values), F.array_compact(known))
    count = F.size(F.filter(values, lambda v: F.array_contains(missing, v)))
    nulls = F.size(F.filter(values, lambda v: v.isNull())) if null_is_one else F.lit(0)
    # only documents with a stranger are counted value by value
    return F.when(F.size(missing) == 0, 0).otherwise(count) + nulls


def package_issues(documents: DataFrame, key: str = "meet_id") -> DataFrame:
    """DQ1: (key, part, issue, n) of nested documents.

    repeated_key and repeated_race: elements too many of an identity or a race's signature;
    no_<part>: foreign keys without a parent; wrong_key: events whose key is not the digest
    of what makes them; bad_source_id: ids of results that are not positive. Each document
    is judged within itself by array functions; nothing is shuffled. Parts and
    fields that a table does not have are not judged.
    """
    checks = []
    kinds = {p: documents.schema[p].dataType.elementType for p in RULES if p in documents.columns}
    for part, kind in kinds.items():
        fields = set(kind.names)
        unique, foreign = RULES[part]
        for k, own in enumerate(unique):
            if set(own) <= fields:
                checks.append((part, "repeated_race" if own is SIGNATURE else "repeated_key", F.size(part) - F.size(F.array_distinct(_values(part, own)))))
        for field, (parent, parent_key) in foreign.items():
            if field in fields and parent in kinds:
                ids = lambda p, f: F.transform(F.col(p), lambda x: x[f].cast("string"))
                checks.append((part, f"no_{parent}", _strangers(ids(part, field), ids(parent, parent_key), (part, field) not in OPTIONAL)))
        if part == "events" and set(EVENT) <= fields:
            event = T.StructType([kind[f] for f in EVENT])
            digest = lambda x: digest_of(canonical_json(F.struct(*(x[f].alias(f) for f in EVENT)), event))  # noqa: E731, B023
            checks.append((part, "wrong_key", F.size(F.filter(part, lambda x: ~x["key"].eqNullSafe(digest(x))))))
        if part == "results" and "source_id" in fields:
            checks.append((part, "bad_source_id", F.size(F.filter(part, lambda x: ~F.coalesce(x["source_id"].cast("long") > 0, F.lit(False))))))
    rows = F.array(*(F.struct(F.lit(p).alias("part"), F.lit(i).alias("issue"), n.alias("n")) for p, i, n in checks))
    return documents.select(key, F.explode(rows).alias("c")).select(key, "c.*").where("n > 0")


def envelope_issues(packages: DataFrame, payload: str = "payload") -> DataFrame:
    """DQ1: packages with issues of their envelope: publisher, revision chain, or a checksum that is not the payload's canonical digest.

    The payload is a struct; its digest is that of its canonical JSON, whatever the order of its fields.
    """
    chain = F.when(F.col("revision") == 1, F.col("previous").isNull()).otherwise(F.col("previous").rlike("^[a-f0-9]{64}$"))
    digest = digest_of(canonical_json(F.col(payload), packages.schema[payload].dataType))
    rules = [("bad_publisher", F.col("publisher").rlike("^[a-z0-9][a-z0-9-]{0,63}$")), ("bad_revision", F.col("revision") >= 1), ("bad_chain", chain), ("bad_checksum", F.col("sha256") == digest)]
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules)))
    return packages.withColumn("issues", broken).where("size(issues) > 0")


def schema_issues(documents: DataFrame, expected: dict[str, set[str]]) -> list[str]:
    """DQ1: parts whose fields are not exactly the expected ones."""
    found = {f.name: {x.name for x in getattr(getattr(f.dataType, "elementType", f.dataType), "fields", [])} for f in documents.schema.fields}
    return sorted(p for p, fields in expected.items() if found.get(p) != fields)


def drifted(target: DataFrame, ledger: DataFrame, columns: list[str], key: str = "meet_id") -> DataFrame:
    """UPS9: meets whose rows are no longer what the ledger recorded."""
    now = set_digest(target, [key], columns)
    return ledger.select(key, F.col("digest").alias("recorded")).join(now, key, "left").where(~F.col("digest").eqNullSafe(F.col("recorded"))).select(key)
