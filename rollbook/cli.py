"""Command line: one subcommand per step, tables as Parquet or CSV folders."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runs
from .operators import bounds, continuity, evaluation, geo, linkage, quality, records, sampling, status
from .sources import readers, writers


def _known(args, read) -> list[str]:
    return [r.code for r in read(args.codebook).where("asked").select("code").distinct().toLocalIterator()]


def commands() -> dict:
    """name: (table arguments, function of (spark, args, read) -> DataFrame)."""
    return {
        "verify-manifest": (["manifest", "folder"], lambda s, a, r: readers.verify_files(s, readers.read_manifest(s, a.manifest), a.folder)),
        "verify-xlsx": (["manifest", "folder"], lambda s, a, r: readers.verify_files(s, readers.read_manifest(s, a.manifest, readers.WORKBOOKS), a.folder)),
        "parse": (["lines", "codebook"], lambda s, a, r: records.parse_records(r(a.lines), _known(a, r))),
        "import-xlsx": (["workbook", "sheet"], lambda s, a, r: readers.read_workbook(s, a.workbook, a.sheet, readers.FACILITY_COLUMNS)),
        "county-cells": (["archives", "year"], lambda s, a, r: bounds.county_cells(_archive(s, a), ("621420", "623220"))),
        "county-compare": (["counts", "cells"], lambda s, a, r: bounds.compare_counts(r(a.counts), r(a.cells), ("621420", "623220"))),
        "link": (["facilities"], lambda s, a, r: linkage.link_facilities(r(a.facilities))),
        "geocode-finalize": (["geocoded", "facilities", "crosswalk"], lambda s, a, r: geo.zip_fallback(r(a.geocoded), r(a.facilities), r(a.crosswalk))),
        "service-status": (["facilities", "services", "availability"], lambda s, a, r: status.service_status(r(a.facilities), r(a.services), r(a.availability))),
        "qa": (["facilities", "services"], lambda s, a, r: quality.qa_by_year(r(a.facilities), r(a.services))),
        "preliminary-release": (["facilities", "reviews"], lambda s, a, r: quality.label_release(r(a.facilities), r(a.reviews))),
        "gold-create": (["facilities", "size"], lambda s, a, r: sampling.create(sampling.sampling_features(r(a.facilities)), int(a.size))),
        "gold-refresh": (["reviews", "facilities"], lambda s, a, r: evaluation.refresh(r(a.reviews), r(a.facilities))),
        "gold-evaluate": (["reviews", "facilities"], lambda s, a, r: evaluation.year_metrics(evaluation.compare(r(a.reviews), r(a.facilities)))),
        "gold-import": (["reviews"], lambda s, a, r: evaluation.check_reviews(r(a.reviews))),
        "run-status": (["run"], lambda s, a, r: runs.read_status(s, Path(a.run))),
        "audit": (["facilities"], lambda s, a, r: continuity.year_summary(r(a.facilities))),
        "overview": (["facilities"], lambda s, a, r: continuity.overview(r(a.facilities))),
    }


def _archive(spark: SparkSession, args) -> DataFrame:
    rows = readers.read_zipped_csv(spark, args.archives, ["fipstate", "fipscty", "naics", "est"])
    return rows.withColumn("year", F.lit(int(args.year)))


def in_years(rows: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Rows of the directory years asked for; a table without years passes whole."""
    if "directory_year" not in rows.columns:
        return rows
    year = F.col("directory_year")
    return rows.where(year.between(first if first is not None else -(10**9), last if last is not None else 10**9)) if (first, last) != (None, None) else rows


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rollbook")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (names, _) in commands().items():
        own = sub.add_parser(name)
        for x in names:
            own.add_argument(f"--{x}", required=True)
        own.add_argument("--out", required=True)
        own.add_argument("--from-year", type=int)
        own.add_argument("--to-year", type=int)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    out = commands()[args.command][1](spark, args, lambda p: in_years(readers.read_any(spark, p), args.from_year, args.to_year))
    if "directory_year" in out.columns and args.command == "parse":
        writers.write_years(out, args.out)
    else:
        out.write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
