"""Spreadsheet exports: a data source for the XML parts of workbooks, and tables made of the parts.

A workbook is a zip of XML parts. The source only unpacks; the parts are parsed with
from_xml, and what refers to other parts (sheets to their files, cells to shared strings) is joined.
Workbooks that cannot be read are rows with a problem, not errors of the whole read.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..functions.scalars import calendar_age, centiseconds, gender, serial_date, stroke_code

#: Most bytes of a workbook, as it is and unpacked.
MOST_BYTES = 50 << 20
PARTS = "file string, part string, xml string, problem string"
#: Parts that every workbook has, or may have, under these names.
BOOK, LINKS, STRINGS, PROPERTIES = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml", "docProps/core.xml"
_XML = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE"}
_RUNS = "t: string, r: array<struct<t: string>>"
_BOOK = "workbookPr struct<_date1904: string>, sheets struct<sheet: array<struct<_name: string, _id: string>>>"
_LINKS = "Relationship array<struct<_Id: string, _Target: string>>"
_STRINGS = f"si array<struct<{_RUNS}>>"
_SHEET = f"sheetData struct<row: array<struct<_r: int, c: array<struct<_r: string, _t: string, v: string, is: struct<{_RUNS}>>>>>>"


def unpacked(name: str, content: bytes | None, most_bytes: int, wanted: set[str] | None = None) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """(file, part, xml, problem) of the XML parts of one workbook; only the wanted ones, if any are named."""
    if content is None:
        yield name, None, None, "too_large"
        return
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            if sum(part.file_size for part in book.infolist()) > most_bytes:
                yield name, None, None, "too_large"
                return
            found = [(name, part, book.read(part).decode("utf-8-sig"), None) for part in book.namelist() if part.endswith((".xml", ".rels")) and (wanted is None or part in wanted)]
    except (zipfile.BadZipFile, UnicodeDecodeError, RuntimeError, NotImplementedError):
        yield name, None, None, "bad_workbook"
        return
    yield from found


class File(InputPartition):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size


class PartReader(DataSourceReader):
    """One partition for each file; a filter on ``part`` keeps other parts from being unpacked.

    Spark applies the filter too: scans that differ only in what was pushed count as equal to it.
    """

    def __init__(self, path: str, most_bytes: int):
        self.path, self.most_bytes, self.wanted = path, most_bytes, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("part",):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = names if self.wanted is None else self.wanted & names
            yield f

    def partitions(self) -> list[File]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        return [File(i.path, i.size) for i in sorted(found, key=lambda i: i.path) if i.type == fs.FileType.File and i.path.endswith(".xlsx")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        content = None
        if partition.size <= self.most_bytes:
            with system.open_input_file(partition.path) as f:
                content = f.read()
        for row in unpacked(partition.path.rsplit("/", 1)[-1], content, self.most_bytes, self.wanted):
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in row], ["file", "part", "xml", "problem"])


class WorkbookSource(DataSource):
    """``spark.read.format("workbook_parts").load(folder)``: SRC22, the XML parts of all .xlsx files below a folder."""

    @classmethod
    def name(cls) -> str:
        return "workbook_parts"

    def schema(self) -> str:
        return PARTS

    def reader(self, schema) -> PartReader:  # noqa: ANN001
        return PartReader(self.options["path"], int(self.options.get("mostBytes", MOST_BYTES)))


def read_parts(spark: SparkSession, folder: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The parts of the workbooks in a folder that Python on the executors can open."""
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook_parts").option("mostBytes", most_bytes).load(folder)


def parts_of(files: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The same of files read by binary_files(), for stores that only Spark opens."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["file_name"], frame["content"], strict=True):
                yield pd.DataFrame(list(unpacked(name, None if content is None else bytes(content), most_bytes)), columns=["file", "part", "xml", "problem"])

    return files.select("file_name", F.when(F.col("length") <= most_bytes, F.col("content")).alias("content")).mapInPandas(read, PARTS)


def _joined(run: Column) -> Column:
    """The text of a string: one piece, or pieces with formats of their own."""
    return F.when(run["r"].isNotNull(), F.array_join(F.transform(run["r"], lambda x: F.coalesce(x["t"], F.lit(""))), "")).otherwise(F.coalesce(run["t"], F.lit("")))


def workbook_rows(parts: DataFrame) -> DataFrame:
    """SRC22: (file, sheet, row_no, epoch_1904, created, cells, problem) of the parts of workbooks.

    A workbook with a problem has one row that says so and no others: too_large, bad_workbook,
    no_book, sheet_without_part, formula (which is no evidence). Cells are a map of
    column letters to their text; empty cells are left out.
    """
    xml = lambda name, schema: parts.where(F.col("part") == name).select("file", F.from_xml("xml", schema, _XML).alias("x"))
    book = xml(BOOK, _BOOK)
    made = parts.where(F.col("part") == PROPERTIES).select("file", F.nullif(F.regexp_extract("xml", r"created\b[^>]*>\s*([^<\s]+)", 1), F.lit("")).alias("created"))
    books = book.select("file", F.coalesce(F.col("x.workbookPr._date1904").isin("1", "true"), F.lit(False)).alias("epoch_1904")).join(made, "file", "left")
    sheets = book.select("file", F.inline("x.sheets.sheet")).select("file", F.col("_name").alias("sheet"), F.col("_id").alias("id"))
    targets = xml(LINKS, _LINKS).select("file", F.inline("x.Relationship")).select("file", F.col("_Id").alias("id"), F.col("_Target").alias("target"))
    inside = F.when(F.col("target").startswith("/"), F.substr("target", F.lit(2))).otherwise(F.concat(F.lit("xl/"), "target"))
    placed = sheets.join(targets, ["file", "id"], "left").withColumn("part", F.when(F.col("target").endswith(".xml") & ~F.array_contains(F.split("target", "/"), ".."), inside))
    bodies = placed.join(parts.select("file", "part", "xml"), ["file", "part"], "left")
    problems = (
        parts.where("problem IS NOT NULL").select("file", "problem")
        .unionByName(parts.where("problem IS NULL").select("file").distinct().join(book.where("x.sheets IS NOT NULL").select("file"), "file", "left_anti").select("file", F.lit("no_book").alias("problem")))
        .unionByName(bodies.where("xml IS NULL").select("file", F.lit("sheet_without_part").alias("problem")))
        .unionByName(bodies.where(F.col("xml").rlike(r"<(\w+:)?f[\s/>]")).select("file", F.lit("formula").alias("problem")))
    ).groupBy("file").agg(F.min("problem").alias("problem"))
    strings = xml(STRINGS, _STRINGS).select("file", F.posexplode("x.si").alias("at", "s")).select("file", "at", _joined(F.col("s")).alias("shared"))
    lines = bodies.select("file", "sheet", F.from_xml("xml", _SHEET, _XML).alias("x")).select("file", "sheet", F.explode("x.sheetData.row").alias("r"))
    cells = lines.select("file", "sheet", F.col("r._r").alias("row_no"), F.explode_outer("r.c").alias("c"))
    cells = cells.withColumn("at", F.when(F.col("c._t") == "s", F.col("c.v").try_cast("int"))).join(strings, ["file", "at"], "left")
    value = F.when(F.col("c._t") == "s", F.col("shared")).when(F.col("c._t") == "inlineStr", _joined(F.col("c.is"))).otherwise(F.col("c.v"))
    column = F.regexp_replace("c._r", r"\d", "")
    entries = F.collect_list(F.when(value != "", F.struct(column.alias("k"), value.alias("v"))))
    rows = cells.groupBy("file", "sheet", "row_no").agg(F.map_from_entries(entries).alias("cells"))
    good = rows.join(books, "file").join(problems, "file", "left_anti").withColumn("problem", F.lit(None).cast("string"))
    return good.unionByName(problems, allowMissingColumns=True).select("file", "sheet", "row_no", "epoch_1904", "created", "cells", "problem")


def export_swims(rows: DataFrame, ignored_sheet: str = "Top Results") -> DataFrame:
    """Club export rows with typed columns; headings and the overview sheet are left out."""
    c = lambda k: F.try_element_at("cells", F.lit(k))
    day = F.when(F.col("epoch_1904"), serial_date(c("N"), True)).otherwise(serial_date(c("N")))
    birth = F.when(F.col("epoch_1904"), serial_date(c("F"), True)).otherwise(serial_date(c("F")))
    return rows.where((F.col("sheet") != ignored_sheet) & (F.col("row_no") > 1)).select(
        "file", "sheet", "row_no", c("A").alias("course"), gender(c("B")).alias("gender"), c("C").try_cast("int").alias("distance"), stroke_code(c("D")).alias("stroke"), c("E").alias("full_name"), birth.alias("birth_date"),
        c("G").alias("nation"), c("H").alias("club_code"), centiseconds(c("I")).alias("time_cs"), day.alias("meet_date"), c("O").alias("city"), c("P").alias("meet"), c("Q").alias("club"), calendar_age(day, F.year(birth)).alias("age"),
    )
