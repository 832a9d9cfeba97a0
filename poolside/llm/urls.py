"""Allowing and blocking URLs by rules, and by boosted trees where no rule fits.

URLs that a rule fits are the labelled ones. Lexical features of them train
gradient-boosted trees, which judge all others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NUMBERS = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "entropy", "parameters", "hyphens", "is_https", "has_fragment", "path_digits"]


@dataclass(frozen=True)
class Rule:
    """verdict for a host and its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


#: The fixed rules.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """host and path beside each url; both empty without a scheme's ://."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return urls.withColumns({"host": F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), "path": F.regexp_extract(text, pattern, 2)})


def with_rule(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The longest rule that fits, and its verdict; both null without one."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # a later, longer one overrides
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def with_features(urls: DataFrame, url: str = "url") -> DataFrame:
    """Lexical features of a URL and its suffix."""
    text, host, path = F.coalesce(F.col(url).cast("string"), F.lit("")), F.col("host"), F.col("path")
    chars = F.split(host, "")
    shares = F.transform(F.array_distinct(chars), lambda c: (F.size(chars) - F.size(F.array_remove(chars, c))) / F.size(chars))
    values = {
        "url_length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": _count(path, "/"),
        "labels": _count(host, r"\."),
        "digit_ratio": _count(text, "[0-9]") / F.greatest(F.length(text), F.lit(1)),
        "host_digits": _count(host, "[0-9]"),
        "entropy": F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p)),
        "parameters": _count(F.regexp_extract(text, r"\?([^#]*)", 1), "="),
        "hyphens": _count(text, "-"),
        "is_https": F.lower(text).startswith("https:").cast("int"),
        "has_fragment": F.contains(text, F.lit("#")).cast("int"),
        "path_digits": _count(path, "[0-9]"),
    }
    out = urls.withColumns({k: v.cast("double") for k, v in values.items()})
    return out.withColumns({"suffix": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2), "folder": F.regexp_extract(path, r"\A/([^/]*)", 1)})


#: Statistics are counted by so many folds of the URLs.
FOLDS = 10


@dataclass(frozen=True)
class UrlModel:
    trees: GBTClassificationModel | None  # none: the only label seen
    rates: dict[str, DataFrame]  # by key: (key, _fold, _good, _n), fold null for all folds together
    base: float

    def features(self, urls: DataFrame, *, out_of_fold: bool = False) -> DataFrame:
        """Suffix statistics joined on, and all features in one vector.

        ``out_of_fold`` is for the rows that were counted: each gets the statistics of the folds
        that it is not in, so that they do not hold its own label.
        """
        urls = urls.withColumn("_fold", fold_of())
        for key, table in self.rates.items():
            every = table.where("_fold IS NULL").drop("_fold")
            urls = urls.join(every, key, "left")
            good, n = F.col("_good"), F.col("_n")
            if out_of_fold:
                urls = urls.join(table.where("_fold IS NOT NULL").withColumnsRenamed({"_good": "_own_good", "_n": "_own_n"}), [key, "_fold"], "left")
                good, n = good - F.coalesce("_own_good", F.lit(0.0)), n - F.coalesce("_own_n", F.lit(0))
            urls = urls.withColumn(f"{key}_rate", F.coalesce((good + 5 * self.base) / (n + 5), F.lit(self.base))).drop("_good", "_n", "_own_good", "_own_n")
        return VectorAssembler(inputCols=[*NUMBERS, *(f"{k}_rate" for k in self.rates)], outputCol="features").transform(urls)


def fold_of() -> Column:
    return F.pmod(F.xxhash64("host", "path", F.lit(29)), F.lit(FOLDS))


def train(labelled: DataFrame, *, sample: int = 50_000, trees: int = 8, depth: int = 3, seed: int = 3) -> UrlModel:
    """Fit the trees to URLs with a verdict in ``ruled``, about ``sample`` of them by a hash of the URL.

    Suffix statistics are the shares of allowed URLs of every suffix, domain and first
    folder, counted over all URLs with a verdict; the trees see each URL's without the fold that it is in.
    """
    known = labelled.where("ruled is not null").withColumn("label", (F.col("ruled") == "allow").cast("double"))
    totals = known.agg(F.avg("label").alias("rate"), F.count("label").alias("n")).first()
    base, size = totals["rate"] if totals["rate"] is not None else 1.0, totals["n"]
    rates = {}
    for key in ("suffix", "domain", "folder"):
        by_fold = known.withColumn("_fold", fold_of()).groupBy(key, "_fold").agg(F.sum("label").alias("_good"), F.count("label").alias("_n"))
        every = by_fold.groupBy(key).agg(F.sum("_good").alias("_good"), F.sum("_n").alias("_n")).withColumn("_fold", F.lit(None).cast("long"))
        path = fresh_path(labelled.sparkSession, f"rates-{key}")  # written, so that Spark knows the size and decides on the join
        by_fold.unionByName(every).write.parquet(path)
        rates[key] = labelled.sparkSession.read.parquet(path)
    share = min(1.0, sample / max(1, size))
    some = known.where(F.pmod(F.xxhash64("host", "path", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))
    model = UrlModel(None, rates, base)
    if not 0 < base < 1:
        return model
    fitted = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.4, seed=seed).fit(model.features(some, out_of_fold=True).select("features", "label"))
    return UrlModel(fitted, rates, base)


def judge_urls(pages: DataFrame, *, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", **training) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each row.

    The verdict is the rule's, else allow if the trees give at least one half. A null
    URL has an empty host and path and goes to the trees. Repeated rows and null ids
    are kept. An empty table gives no rows; without any ruled URL all are allowed.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    ruled = with_features(with_rule(with_parts(base), rules))
    model = train(ruled, **training)
    if model.trees is None:
        judged = ruled.withColumn("score", F.lit(float(model.base >= 0.5)))
    else:
        judged = model.trees.transform(model.features(ruled)).withColumn("score", vector_to_array("probability")[1])
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block")).alias("verdict"), "score")


def held_out_auc(pages: DataFrame, *, rules: tuple[Rule, ...] = RULES, url_col: str = "url", **training) -> dict[str, float]:
    """The area under the ROC curve on a fifth of the ruled URLs that the trees and rates did not see.

    By all features, and by the lexical numbers alone: the rates of suffix, domain and
    folder state much of the rules themselves.
    """
    ruled = with_features(with_rule(with_parts(pages.select(F.col(url_col).cast("string").alias("url"))), rules)).where("ruled is not null")
    place = F.pmod(F.xxhash64("host", "path", F.lit(17)), F.lit(5))
    model = train(ruled.where(place > 0), **training)
    if model.trees is None:
        return {"all": 0.5, "numbers": 0.5}
    labelled = lambda df: df.withColumn("label", (F.col("ruled") == "allow").cast("double"))
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction")
    out = {"all": area.evaluate(model.trees.transform(labelled(model.features(ruled.where(place == 0)))))}
    plain = VectorAssembler(inputCols=NUMBERS, outputCol="features")
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=8, maxDepth=3, stepSize=0.4, seed=3)
    out["numbers"] = area.evaluate(trees.fit(plain.transform(labelled(ruled.where(place > 0)))).transform(plain.transform(labelled(ruled.where(place == 0)))))
    return out
