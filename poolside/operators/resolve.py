"""Resolving source athletes to known swimmers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_swimmer_id, folded_name

IDENTITY = ["first_name", "last_name", "birth_year", "gender", "country_code"]


def cascade(athletes: DataFrame, aliases: DataFrame, swimmers: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Athletes with swimmer_id and how it was found: override, alias, identity or new.

    An alias counts only if all identity fields agree. Athletes of one identity that
    nobody knows get one hashed id, so a batch needs no order and no loop. Of several
    swimmers of one identity the least id counts; an alias of several decides nothing. An override
    counts only if name, birth year and gender of its swimmer agree.
    """
    s = swimmers.select("swimmer_id", *IDENTITY)
    alias = aliases.select("source_swimmer_id", "source_country_code", F.col("swimmer_id").alias("_alias")).join(
        s.select(F.col("swimmer_id").alias("_alias"), *(F.col(c).alias(f"_{c}") for c in IDENTITY)), "_alias"
    )
    alias = alias.groupBy("source_swimmer_id", "source_country_code").agg(F.countDistinct("_alias").alias("_n"), *(F.min(c).alias(c) for c in ["_alias", *(f"_{x}" for x in IDENTITY)])).where("_n = 1").drop("_n")
    out = athletes.join(alias, ["source_swimmer_id", "source_country_code"], "left")
    agrees = F.lit(True)
    for c in IDENTITY:
        agrees = agrees & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = out.withColumn("_alias", F.when(agrees, F.col("_alias"))).drop(*(f"_{c}" for c in IDENTITY))
    identity = s.groupBy(*IDENTITY).agg(F.min("swimmer_id").alias("_same"))
    out = out.join(identity, IDENTITY, "left")
    if overrides is None:
        out = out.withColumn("_fixed", F.lit(None).cast("string"))
    else:
        named = s.select(F.col("swimmer_id").alias("_fixed"), _name_key().alias("_name"), F.col("birth_year").alias("_year"), F.col("gender").alias("_sex"))
        checked = overrides.select("identity_key", F.col("swimmer_id").alias("_fixed")).join(named, "_fixed")
        out = out.join(checked, "identity_key", "left")
        same = (_name_key() == F.col("_name")) & F.col("birth_year").eqNullSafe(F.col("_year")) & F.col("gender").eqNullSafe(F.col("_sex"))
        out = out.withColumn("_fixed", F.when(same, F.col("_fixed"))).drop("_name", "_year", "_sex")
    new = canonical_swimmer_id(*(F.col(c) for c in ("country_code", "gender", "birth_year", "first_name", "last_name")))
    how = F.when(F.col("_fixed").isNotNull(), "override").when(F.col("_alias").isNotNull(), "alias").when(F.col("_same").isNotNull(), "identity").otherwise("new")
    return out.withColumns({"resolution": how, "swimmer_id": F.coalesce("_fixed", "_alias", "_same", new)}).drop("_fixed", "_alias", "_same")


def _name_key() -> Column:
    return F.concat_ws("|", folded_name(F.col("first_name")), folded_name(F.col("last_name")))


def candidates(athletes: DataFrame, swimmers: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Athletes by how many swimmers have their folded name, birth year and gender: create, link or hold.

    athletes have ``source_kind``. Those of LENEX files are looked for in their own
    country, and an alias among several decides. Unknown athletes of printed lists are held, for a
    list does not say enough to make a swimmer of them.
    """
    by = ["_key", "birth_year", "gender"]
    anywhere = F.coalesce(F.col("source_kind") != "lenex", F.lit(False))
    rows = athletes.withColumns({"_key": _name_key(), "_abroad": anywhere, "_place": F.when(anywhere, F.lit("")).otherwise(F.col("country_code"))})
    known = swimmers.select("swimmer_id", _name_key().alias("_key"), "birth_year", "gender", F.col("country_code").alias("_place"))
    # swimmers are counted by identity before they meet athletes, so no name makes pairs
    counted = lambda keys: known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), F.min("swimmer_id").alias("_any"))
    there = counted([*by, "_place"]).withColumn("_abroad", F.lit(False)).unionByName(counted(by).withColumns({"_place": F.lit(""), "_abroad": F.lit(True)}))
    out = rows.join(there, [*by, "_place", "_abroad"], "left")
    if aliases is not None:
        a = aliases.select("source_swimmer_id", F.col("source_country_code").alias("country_code"), "swimmer_id").distinct()
        own = a.join(known, "swimmer_id").where("_place = country_code")
        own = own.groupBy("source_swimmer_id", "country_code", *by).agg(F.count(F.lit(1)).alias("_hits"), F.min("swimmer_id").alias("_hit"))
        out = out.join(own, ["source_swimmer_id", "country_code", *by], "left")
    else:
        out = out.withColumns({"_hits": F.lit(0), "_hit": F.lit(None).cast(swimmers.schema["swimmer_id"].dataType)})
    one = (F.col("source_kind") == "lenex") & (F.col("_hits") == 1)
    n = F.when(one, 1).otherwise(F.coalesce("_all", F.lit(0)))
    route = F.when(n == 1, "link").when((n == 0) & (F.col("source_kind") != "pdf"), "create").otherwise("hold")
    reason = F.when(route == "hold", F.when(n == 0, "unknown_identity").otherwise("ambiguous_identity"))
    found = F.when(n == 1, F.when(one, F.col("_hit")).otherwise(F.col("_any")))
    return out.withColumns({"candidates": n, "route": route, "reason": reason, "swimmer_id": found}).drop("_abroad", "_place", "_key", "_all", "_any", "_hits", "_hit")


def alias_conflicts(claims: DataFrame) -> DataFrame:
    """Aliases that one batch claims for several swimmers: held, not raced."""
    return claims.groupBy("source_country_code", "source_swimmer_id").agg(F.countDistinct("swimmer_id").alias("claims")).where("claims > 1")


def relay_members(positions: DataFrame, athletes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J23, SRC9: (rows of known members, unknown ones for review), within each file."""
    on = ["file_name", "athlete_id"]
    return positions.join(athletes, on), positions.join(athletes.select(*on), on, "left_anti")
