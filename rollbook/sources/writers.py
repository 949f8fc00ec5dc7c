"""Writers: yearly partitions, compressed CSV, dictionary, checksums, Stata."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_years(df: DataFrame, path: str, by: str = "directory_year") -> None:
    """Parquet by year; only the years in ``df`` are replaced, each at once by the committer."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_csv_years(df: DataFrame, path: str, by: str = "survey_year") -> None:
    """Gzip CSV, a folder per year; arrays become JSON."""
    flat = df.withColumns({n: F.to_json(n) for n, t in df.dtypes if t.startswith(("array", "map", "struct"))})
    flat.write.mode("overwrite").option("header", True).option("compression", "gzip").partitionBy(by).csv(path)


def data_dictionary(spark: SparkSession, tables: dict[str, DataFrame], descriptions: dict[str, str] | None = None) -> DataFrame:
    """table, column, dtype and description of every column."""
    rows = [(t, f.name, f.dataType.simpleString(), (descriptions or {}).get(f.name, "")) for t, df in tables.items() for f in df.schema]
    return spark.createDataFrame(rows, "`table` string, `column` string, dtype string, description string")


def checksums(spark: SparkSession, folder: str, skip: tuple[str, ...] = ("checksums.sha256",)) -> DataFrame:
    """sha256 and name of each file of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.sha2("content", 256).alias("sha256"), F.element_at(F.split("path", "/"), -1).alias("name")).where(~F.col("name").isin(*skip))


def write_report(path: str, report: dict) -> None:
    """A small JSON report next to the driver."""
    Path(path).write_text(json.dumps(report, indent=2, default=str), encoding="utf-8")


def stata_names(columns: list[str]) -> dict[str, str]:
    """Valid unique names of at most 32 characters."""
    out: dict[str, str] = {}
    for c in columns:
        name = base = re.sub(r"\W", "_", c)[:32]
        n = 1
        while name in out.values():
            n += 1
            name = f"{base[: 31 - len(str(n))]}_{n}"
        out[c] = name
    return out


def write_stata(df: DataFrame, path: str, max_rows: int = 5_000_000) -> None:
    """Stata 118 file from the driver; long texts as strL, flags and nullable integers as floats.

    The format is one local file, so more than ``max_rows`` rows raise.
    """
    if (n := df.count()) > max_rows:
        raise ValueError(f"{n} rows don't fit one Stata file of at most {max_rows}")
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("double").alias(c) if t in ("boolean", "int", "bigint") else F.col(c) for c, t in df.dtypes])
    frame = flat.toPandas()
    text = [c for c, t in flat.dtypes if t == "string"]
    frame[text] = frame[text].fillna("")
    names = stata_names(list(frame.columns))
    long = [names[c] for c in text if len(frame) and frame[c].str.len().max() > 244]
    frame.rename(columns=names).to_stata(path, write_index=False, version=118, convert_strl=long)
