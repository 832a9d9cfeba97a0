"""Finding source files: by folder, extension, name pattern, manifest and registry."""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def binary_files(spark: SparkSession, folder: str, pattern: str = "*", *, recursive: bool = True) -> DataFrame:
    """SRC3: (path, file_name, length, content) of files in a folder."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder).select("path", F.substring_index("path", "/", -1).alias("file_name"), "length", "content")


def named_like(file_name: Column, *, months: list[str] | None = None, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """SRC4: names with one of the months in them, and a country prefix that is wanted."""
    out = F.lit(True)
    if months:
        out = out & file_name.rlike("|".join(months))
    if include:
        out = out & F.substring(file_name, 1, 3).isin(*include)
    if exclude:
        out = out & ~F.substring(file_name, 1, 3).isin(*exclude)
    return out


def in_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """SRC5: files that the manifest keeps."""
    return files.join(manifest.where("keep").select("file_name"), "file_name", "left_semi")


def registry(pages: DataFrame, host: str) -> DataFrame:
    """SRC24: (country, url, valid): three capitals, https, and the allowed host."""
    ok = F.col("country").rlike("^[A-Z]{3}$") & F.col("url").startswith("https://") & F.try_parse_url("url", F.lit("HOST")).eqNullSafe(F.lit(host))
    return pages.select("country", "url", F.coalesce(ok, F.lit(False)).alias("valid"))


def file_register(files: DataFrame) -> DataFrame:
    """SNK12: a row for each file with its content hash; upsert it on file_name."""
    return files.select("file_name", F.sha1("content").alias("file_fingerprint"), "length")


def with_counts(register: DataFrame, athletes: DataFrame, results: DataFrame) -> DataFrame:
    """SNK12: the register with how many athletes and results each file has."""
    count = lambda rows, name: rows.groupBy("file_name").agg(F.count(F.lit(1)).alias(name))
    out = register.join(count(athletes, "athlete_count"), "file_name", "left").join(count(results, "result_count"), "file_name", "left")
    return out.fillna(0, ["athlete_count", "result_count"])


def snapshots(spark: SparkSession, folder: str, schema: str, most_bytes: int = 256 << 20) -> DataFrame:
    """SRC15: (file_name, problem, columns of schema) of gzip JSON packages; one of more unpacked bytes, or that is no gzip JSON, is a row with a problem.

    Each file is read once, on the executor, and unpacked no further than the bound.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["file_name"], frame["content"], strict=True):
                text, problem = None, None
                try:
                    with gzip.open(io.BytesIO(content)) as f:
                        data = f.read(most_bytes + 1)
                    if len(data) > most_bytes:
                        problem = "too_large"
                    else:
                        text = data.decode("utf-8")
                except (OSError, EOFError, zlib.error, UnicodeDecodeError):
                    problem = "bad_gzip"
                yield pd.DataFrame({"file_name": [name], "text": [text], "problem": [problem]}, dtype=object)

    found = binary_files(spark, folder, "*.json.gz", recursive=False).select("file_name", "content").mapInPandas(unpack, "file_name string, text string, problem string")
    kind = f"{schema}, _broken string"
    parsed = found.withColumn("_p", F.from_json("text", kind, {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}))
    problem = F.coalesce("problem", F.when(F.col("_p._broken").isNotNull() | F.col("_p").isNull(), "bad_json"))
    return parsed.select("file_name", problem.alias("problem"), "_p.*").drop("_broken")
