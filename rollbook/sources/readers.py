"""Readers: typed manifests, text CSV, zipped CSV, workbooks, page text, unions of Parquet.

Files are read by Spark (``binaryFile``) and parsed on executors, so a path
may be in any store that Spark reads.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = (
    "directory_year int, survey_year int, filename string, source_url string, sha256 string, start_page int, end_page int, n_columns int, layout_profile string, delimiter string, "
    "margin double, overlap double, crop_top double, crop_bottom double, expected_category_count int"
)
WORKBOOKS = "directory_year int, survey_year int, filename string, source_url string, sha256 string, facility_sheet string, codebook_sheet string, expected_facilities int"
FACILITY_COLUMNS = "name1 name2 street1 street2 city state zip phone intake1 intake2 intake1a intake2a service_code_info".split()
CODEBOOK_COLUMNS = "category_code category_name service_code service_name service_description".split()


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """A CSV manifest with declared types; a malformed row raises."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")


def select_year(manifest: DataFrame, year: int):
    """The manifest row of a year, or KeyError."""
    if row := manifest.where(F.col("directory_year") == year).first():
        return row
    raise KeyError(f"no manifest row for {year}")


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, missing values as empty text."""
    return spark.read.csv(path, header=True, inferSchema=False).na.fill("")


def read_parquet_union(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files of different columns as one table by name."""
    return spark.read.option("mergeSchema", "true").parquet(*([paths] if isinstance(paths, str) else paths))


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or CSV by suffix."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else read_text_csv(spark, path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_zipped_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of the CSV members of ZIP archives: path, source_row, and ``columns`` as text, names lower-cased."""
    schema = "path string, source_row long, " + ", ".join(f"`{c}` string" for c in columns)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in sorted(x for x in archive.namelist() if not x.endswith("/")):
                        with archive.open(member) as raw:
                            rows = csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig"))
                            rows.fieldnames = [x.strip().lower() for x in rows.fieldnames or []]
                            if missing := set(columns) - set(rows.fieldnames):
                                raise ValueError(f"{name} lacks columns: {sorted(missing)}")
                            part = []
                            for i, r in enumerate(rows):
                                part.append([name, i, *(r[c] for c in columns)])
                                if len(part) == 10_000:
                                    yield pd.DataFrame(part, columns=["path", "source_row", *columns])
                                    part = []
                            yield pd.DataFrame(part, columns=["path", "source_row", *columns])

    return _files(spark, path).mapInPandas(run, schema)


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def workbook_sheet(content: bytes, sheet: str) -> list[list[str]]:
    """Cells of one sheet of an XLSX file as text, rows padded to the widest."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        tree = lambda name: ElementTree.fromstring(z.read(name))
        strings = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in tree("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in z.namelist() else []
        ids = {s.get("name"): s.get(f"{{{_NS['r']}}}id") for s in tree("xl/workbook.xml").iter(f"{{{_NS['m']}}}sheet")}
        if sheet not in ids:
            raise ValueError(f"no sheet {sheet!r}")
        targets = {x.get("Id"): x.get("Target") for x in tree("xl/_rels/workbook.xml.rels")}
        target = targets[ids[sheet]]
        rows = []
        for row in tree(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iter(f"{{{_NS['m']}}}row"):
            own: dict[int, str] = {}
            for i, cell in enumerate(row.findall("m:c", _NS)):
                letters = re.sub(r"\d", "", cell.get("r") or "")
                at = sum((ord(c) - 64) * 26**k for k, c in enumerate(reversed(letters))) - 1 if letters else i
                value = cell.findtext("m:v", "", _NS)
                inline = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
                own[at] = strings[int(value)] if cell.get("t") == "s" and value else inline or value
            rows.append([own.get(k, "") for k in range(max(own, default=-1) + 1)])
    width = max(map(len, rows), default=0)
    return [r + [""] * (width - len(r)) for r in rows]


def read_workbook(spark: SparkSession, path: str, sheet: str, columns: list[str]) -> DataFrame:
    """path, source_row (from 2) and text columns of a sheet whose header must be ``columns`` in order."""
    schema = "path string, source_row int, " + ", ".join(f"`{c}` string" for c in columns)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                rows = workbook_sheet(content, sheet)
                header = [x.strip().lower() for x in (rows or [[]])[0]]
                if header != columns:
                    raise ValueError(f"unexpected columns of {sheet!r}: {header}")
                yield pd.DataFrame([[name, i, *r] for i, r in enumerate(rows[1:], start=2)], columns=["path", "source_row", *columns])

    return _files(spark, path).mapInPandas(run, schema)


def column_boxes(width: float, height: float, config: dict) -> list[tuple[float, float, float, float]]:
    """Crop boxes (left, top, right, bottom) of a page's columns."""
    top, bottom = config["crop_top"], height - config["crop_bottom"]
    if config["layout_profile"] == "three_column_transition":
        return [(width * a, top, width * b, bottom) for a, b in ((0.08, 0.35), (0.36, 0.635), (0.64, 0.91))]
    n, step = config["n_columns"], (width - 2 * config["margin"]) / config["n_columns"]
    shift = lambda i: config["overlap"] if i else 0.0
    boxes = [(config["margin"] + i * step + shift(i), top, config["margin"] + (i + 1) * step + shift(i), bottom) for i in range(n)]
    return [(30.0, *boxes[0][1:]), *boxes[1:]] if config["directory_year"] == 1998 else boxes


def read_pages(spark: SparkSession, path: str, year: int, extract: Callable[[bytes], Iterator[tuple[int, int, str]]]) -> DataFrame:
    """Positioned lines (directory_year, page, column, line_no, text) of documents.

    ``extract`` maps a file's bytes to (page, column, text of the column); any
    PDF library on the executors can supply it.
    """
    from ..functions.text import clean

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                for page, column, text in extract(content):
                    lines = [x for raw in text.splitlines() if (x := clean(raw))]
                    yield pd.DataFrame({"directory_year": year, "page": page, "column": column, "line_no": range(1, len(lines) + 1), "text": lines})

    return _files(spark, path).mapInPandas(run, "directory_year int, page int, column int, line_no int, text string")


def verify_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """exists, observed_sha256 and ok of each manifest row; digests ignore case."""
    found = _files(spark, f"{folder}/*").select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("observed_sha256"))
    out = manifest.join(found, F.col("filename") == F.col("name"), "left").drop("name")
    return out.withColumn("exists", F.col("observed_sha256").isNotNull()).withColumn("ok", F.coalesce(F.lower("sha256") == F.col("observed_sha256"), F.lit(False)))
