"""Connected components of a graph given as a table of links.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step is a
grouped minimum and a join, so a node with very many neighbours is summed up
before the shuffle and split by adaptive execution, never gathered in one task.
Each round is written by checkpoint(), so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, mark_of


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Connect each node's neighbours (the larger ones, or the smaller ones and itself) to its smallest neighbour."""
    both = links.select("a", "b")
    if large:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _summary(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of a link that is not the smallest of its component.

    links may hold repeated links, loops and either order. No links: no rows.
    """
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col("a") != F.col("b")).distinct()
    now = checkpointed(now)
    seen = _summary(now)
    while seen[0]:
        now = checkpointed(_star(_star(now, large=True), large=False))
        last, seen = seen, _summary(now)
        if seen == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def least_labels(nodes: DataFrame, links: DataFrame, label: str, *, places: int = 16) -> DataFrame:
    """(node, least) for each of ``nodes`` (node, label; one row each): the smallest label in its component, null if all are null.

    A large component has one root; the joins on it are dealt to ``places`` tasks, and
    nodes without a link take no part in them.
    """
    roots = components(links)
    rows = nodes.join(roots, "node", "left").select("node", F.col(label).alias("label"), F.coalesce("root", "node").alias("root"), F.pmod(F.xxhash64("node"), F.lit(places)).cast("int").alias("place"))
    several = roots.select("root").distinct()
    least = rows.groupBy("root").agg(F.min("label").alias("least")).join(several, "root", "left_semi")
    dealt = least.select("root", "least", F.explode(F.sequence(F.lit(0), F.lit(places - 1))).alias("place"))
    return rows.join(dealt, ["root", "place"], "left").select("node", F.coalesce("least", "label").alias("least"))


def one_of_each(docs: DataFrame, nodes: DataFrame, links: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs, one for each component of nodes (doc_id, mark, node) under links.

    The smallest id stays, null ids come last; among rows of one id the smallest node
    and digest of the text decide, and of rows equal in all of these one stays. So
    components whose rows share an id, or have none, each keep a row of their own.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0)).alias("id"), "node", "mark")
    first = nodes.groupBy("node").agg(F.min(order).alias("best"))
    best = first.join(components(links), "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("best").alias("best"))
    keys = ["unknown", "id", "mark"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).isNull().alias("unknown"), F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"), mark_of(F.col(text_col)).alias("mark"))
    return rows.join(best.select(*(f"best.{k}" for k in keys)), keys, "left_semi").dropDuplicates(keys).select("row.*")
