"""Benchmark passages in documents: a prefix-filtered set join, in DataFrame functions alone.

A window is ten consecutive words of an item (the whole item, if it is shorter). A
document holds a window only if it holds all its shingles, so the rarest one is a
sufficient prefix: shingles are ordered by how often the documents have them, and only
the rarest of each window is joined. Its place in both texts fixes where the window would
start, which bounds by position and length rule out at once; what is left is compared word by word.

Documents are read once for a block of windows and are not shuffled: of their places only
those with a shingle of the block are kept, with the words around them. Benchmarks of any
size are taken in blocks of at most :data:`BLOCK_WINDOWS` windows, whose shingles (eight
numbers of eight bytes a window) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, mark_of

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 3
#: Windows whose shingles are broadcast together, about 64 MB with Spark's hash table.
BLOCK_WINDOWS = 250_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: all of ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The shingle that stands before the first one of each document, so that none is lost in a join.
FIRST = 0


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN), "")


def _shingles(words: Column, width: int) -> Column:
    """(at, shingle): hashes of the shingles of so many words, by position."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (width - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.struct(i.alias("at"), F.xxhash64(F.lit(width), w, *(F.get(words, i + k) for k in range(1, width))).alias("shingle")))


def windows_of(items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(wid, window, n_words) of the distinct windows, and (wid, item_id string) of who has them."""
    worded = items.select(F.col(f"`{item_col}`").cast("string").alias("item_id"), words_of(F.col(f"`{text_col}`")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    each = worded.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", F.slice("words", F.col("at") + 1, size).alias("words"))
    named = each.select("item_id", F.concat_ws(" ", "words").alias("window"), F.size("words").alias("n_words")).withColumn("wid", F.unhex(F.md5(F.col("window").cast("binary"))))
    return named.select("wid", "window", "n_words").distinct(), named.where("item_id IS NOT NULL").select("wid", "item_id").distinct()


def occurrences(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Where windows occur, and one row for each row of docs.

    The first is distinct (doc_id, mark, start, n_words, wid), start counting words from 0;
    the second (doc_id, mark, doc_words). mark is a digest of the text.
    """
    spark = docs.sparkSession
    worded = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), mark_of(F.col(f"`{text_col}`")).alias("mark"), words_of(F.col(f"`{text_col}`")).alias("words"))
    blocks = -(-windows.count() // BLOCK_WINDOWS) or 1
    windows.withColumn("block", F.pmod(F.xxhash64("wid"), F.lit(blocks))).write.parquet(path := fresh_path(spark, "windows"))
    found = rows = None
    for block in range(blocks):
        own = spark.read.parquet(path).where(F.col("block") == block).drop("block")
        matches = _matches(worded, own)
        rows = matches.where("at = -1").select("doc_id", "mark", "doc_words") if rows is None else rows
        hits = _verified(matches.where("at >= 0"), own)
        found = hits if found is None else found.unionByName(hits)
    return found, rows


def _own_shingles(windows: DataFrame) -> DataFrame:
    """(wid, n_words, offset, shingle): all shingles of all windows, each as wide as its window has room for."""
    out = None
    for s in range(1, SHINGLE + 1):
        some = windows.where(F.least("n_words", F.lit(SHINGLE)) == s)
        part = some.select("wid", "n_words", F.inline_outer(_shingles(F.split("window", " "), s))).withColumnRenamed("at", "offset")
        out = part if out is None else out.unionByName(part)
    return out


def _matches(worded: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, mark, doc_words, at, shingle, since, near): where documents have any shingle of the windows, with the words around it.

    Each row of the documents has one row more, with -1 as its place. One pass over the
    texts; the shingles of a block are few enough to be broadcast, so nothing is shuffled.
    """
    spark = worded.sparkSession
    # inline_outer, for inline() brings a filter along, which would split the text again for each word
    widths = [r[0] for r in windows.select(F.least("n_words", F.lit(SHINGLE))).distinct().collect()]  # at most SHINGLE numbers
    first = F.array(F.struct(F.lit(-1).alias("at"), F.lit(FIRST).cast("long").alias("shingle")))
    placed = worded.select("doc_id", "mark", "words", F.concat(first, *(_shingles(F.col("words"), s) for s in widths)).alias("places"))
    each = placed.select("doc_id", "mark", "words", F.size("words").alias("doc_words"), F.inline_outer("places"))
    asked = _own_shingles(windows).select("shingle").union(spark.range(1).select(F.lit(FIRST).cast("long"))).distinct()
    since = F.greatest(F.col("at") - (WINDOW - SHINGLE), F.lit(0))
    near = F.when(F.col("at") >= 0, F.slice("words", since + 1, 2 * WINDOW - SHINGLE))
    matches = each.join(F.broadcast(asked), "shingle").select("doc_id", "mark", "doc_words", "at", "shingle", since.alias("since"), near.alias("near"))
    matches.write.parquet(path := fresh_path(spark, "matches"))
    return spark.read.parquet(path)


def _verified(matches: DataFrame, windows: DataFrame) -> DataFrame:
    """The occurrences among the places of each window's rarest shingle."""
    own = _own_shingles(windows)
    often = matches.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    rarest = own.join(often, "shingle", "left").groupBy("wid").agg(F.min_by(F.struct("shingle", "offset", "times"), F.struct(F.coalesce("times", F.lit(0)), "shingle", "offset")).alias("p"))
    # a window goes here if there is a shingle that no document has
    prefixes = rarest.where("p.times IS NOT NULL").select("wid", "p.shingle", "p.offset").join(windows, "wid")
    candidates = matches.join(prefixes, "shingle").withColumn("start", F.col("at") - F.col("offset")).where("start >= 0 AND start + n_words <= doc_words")
    there = F.concat_ws(" ", F.slice("near", F.col("start") - F.col("since") + 1, F.col("n_words")))
    return candidates.where(there == F.col("window")).select("doc_id", "mark", "start", "n_words", "wid").distinct()


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joined on keys of which doc_id may be null."""
    r = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & (left[k].eqNullSafe(r[f"_{k}"]) if k == "doc_id" else left[k] == r[f"_{k}"])
    return left.join(r, on, how).drop(*(f"_{k}" for k in keys))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """One row for each row of docs: n_words, n_hit, n_items, items_sha256 and contaminated.

    A null text has no words; an item without words has no window; an item with a null id
    makes words hit but is not listed or counted. Repeated documents get equal rows, repeated
    items count once. Other columns of both tables are not read, whatever their names;
    empty tables give no rows, or rows without hits.
    """
    windows, owners = windows_of(items, item_col)
    hits, rows = occurrences(docs, windows, id_col, text_col)
    hits.write.parquet(path := fresh_path(docs.sparkSession, "hits"))
    hits = docs.sparkSession.read.parquet(path)
    # words under any occurrence: what each one adds to those that start before it
    ends = hits.groupBy("doc_id", "mark", "start").agg((F.col("start") + F.max("n_words")).alias("end"))
    before = F.max("end").over(Window.partitionBy("doc_id", "mark").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce("before", F.lit(0))), F.lit(0))
    n_hit = ends.withColumn("before", before).groupBy("doc_id", "mark").agg(F.sum(new).alias("n_hit"))
    listed = hits.select("doc_id", "mark", "wid").distinct().join(owners, "wid").groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    out = _same(_same(rows, n_hit, ["doc_id", "mark"], "left"), listed, ["doc_id", "mark"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", F.col("doc_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
#: The same by plain equality of all windows of both sides.
ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, unnest(list_transform(range(0, greatest(len(w) - 10, 0) + 1), lambda s: array_to_string(w[s + 1 : s + 10], ' '))) AS g FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT r, k, unnest(range(0, len(w) - k + 1)) AS s, unnest(list_transform(range(0, len(w) - k + 1), lambda s: array_to_string(w[s + 1 : s + k], ' '))) AS g FROM d, sizes WHERE len(w) >= k),
h AS (SELECT r, s, k, item_id FROM dw JOIN iw USING (k, g)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT r, s, k FROM h)) GROUP BY r),
m AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)"""
