"""A release: every table, its dictionary, the quality report and checksums, in one folder that Spark writes."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import evaluation, geo, quality, status
from .sources import writers


def facts(facilities: DataFrame, links: DataFrame | None = None, geocoded: DataFrame | None = None) -> DataFrame:
    """Facilities with their entity and geography, null where a part isn't there."""
    out = geo.attach(facilities, links) if links is not None else facilities.withColumn("facility_id", F.lit(None).cast("string"))
    if geocoded is None:
        return out.withColumns({c: F.lit(None).cast("string") for c in ("county_fips", "geocode_confidence")})
    return geo.attach(out, geocoded)


def report(facilities: DataFrame, services: DataFrame, expected: DataFrame, geocoded: DataFrame | None = None, gold: DataFrame | None = None, linkage_accuracy: float | None = None) -> tuple[dict, DataFrame]:
    """The gates as a dict, and the yearly table behind them.  An absent part fails its gate."""
    annual = quality.with_count_reference(quality.qa_by_year(facilities, services), expected)
    spark = facilities.sparkSession
    if geocoded is None:
        geocoded = spark.createDataFrame([], "county_fips string, geocode_confidence string")
    if gold is None:
        reviewed = spark.createDataFrame([], "address_accuracy double, service_accuracy double")
    else:
        reviewed = evaluation.simple_accuracy(gold, facilities)
    gates = quality.release_gates(annual, geocoded, reviewed, linkage_accuracy).first().asDict()
    gates["blocking_reasons"] = [x for x in gates["blocking_reasons"].split("; ") if x]
    return gates, annual


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    """One text in a folder of one part, wherever Spark can write."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def assemble(
    folder: str, facilities: DataFrame, services: DataFrame, availability: DataFrame, expected: DataFrame, links: DataFrame | None = None, geocoded: DataFrame | None = None,
    gold: DataFrame | None = None, linkage_accuracy: float | None = None, version: str = "0", descriptions: dict[str, str] | None = None, preliminary: bool = False,
) -> dict:
    """Writes all parts of a release below ``folder`` and returns its report.

    Tables go out as Parquet by directory year, facilities also as gzip CSV by
    survey year.  A release whose gates fail is refused before any table is
    written, unless it is ``preliminary``.
    """
    spark = facilities.sparkSession
    gates, annual = report(facilities, services, expected, geocoded, gold, linkage_accuracy)
    if not gates["release_ready"] and not preliminary:
        raise ValueError("the release is blocked: " + "; ".join(gates["blocking_reasons"]))
    whole = facts(facilities, links, geocoded).withColumn("release_status", F.lit("preliminary" if preliminary else "final"))
    tables = {"facilities": whole, "facility_services": services, "service_availability": availability, "facility_service_status": status.service_status(facilities, services, availability)}
    if links is not None:
        tables["facility_entities"] = links
    if geocoded is not None:
        tables["geocoding_results"] = geocoded
    rows = {}
    for name, table in tables.items():
        path = f"{folder}/{name}.parquet"
        if "directory_year" in table.columns:
            writers.write_years(table, path)
        else:
            table.write.mode("overwrite").parquet(path)
        # Counts come from the written table, so nothing is computed twice.
        rows[name] = spark.read.parquet(path).count()
    writers.write_csv_years(spark.read.schema(whole.schema).parquet(f"{folder}/facilities.parquet"), f"{folder}/facilities_csv")
    annual.coalesce(1).orderBy("directory_year").write.mode("overwrite").option("header", True).csv(f"{folder}/qa_by_year_csv")
    writers.data_dictionary(spark, tables, descriptions).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/data_dictionary_csv")
    out = gates | {"version": version, "preliminary": preliminary, "rows": rows}
    _write_text(spark, json.dumps(out, default=str), f"{folder}/qa_report")
    # Read whole before the result is written into the same folder.
    sums = writers.checksums(spark, folder).where(~F.col("name").startswith("_")).orderBy("name", "sha256")
    sums.coalesce(1).write.mode("overwrite").option("sep", " ").csv(f"{folder.rstrip('/')}_checksums")
    return out


def dashboard_status(report_: dict | None, version: str = "0") -> dict:
    """What a dashboard shows of a release; none yet is a blocked one."""
    found = report_ or {}
    return {"release_ready": bool(found.get("release_ready", False)), "version": version, "blocking_reasons": found.get("blocking_reasons", ["release has not been built"])}


def zip_sources(rights: DataFrame, folder: str, path: str, name: str = "file") -> list[str]:
    """One ZIP of the source files that the rights scan found eligible; the names left out, for review by hand.

    ``rights`` has a row for each source file, some dozen; files are local and
    stream one at a time.
    """
    marks = {r[name]: r["archive_eligible"] for r in rights.select(name, "archive_eligible").toLocalIterator()}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for own in sorted(k for k, eligible in marks.items() if eligible):
            out.write(Path(folder) / own, own)
    return sorted(k for k, eligible in marks.items() if not eligible)
