"""Geocoding results: parsing, cache rules, ZIP fallback, attachment."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import zero_padded


def parse_response(rows: DataFrame) -> DataFrame:
    """County, place and confidence of (listing_id, match_status, coordinates "lon,lat", state_fips, county_code, ...)."""
    number = lambda c, n: zero_padded(F.col(c), n)
    fips = F.coalesce(F.concat(number("state_fips", 2), number("county_code", 3)), F.lit(""))
    confidence = F.when(F.col("match_status") == "Match", "high").when(F.col("match_status") == "No_Match", "unmatched").otherwise("review")
    return rows.select(
        "listing_id", F.when(fips == "00000", "").otherwise(fips).alias("county_fips"), F.expr("try_cast(get(split(coordinates, ','), 1) AS double)").alias("latitude"), F.expr("try_cast(get(split(coordinates, ','), 0) AS double)").alias("longitude"),
        F.lit("census_batch").alias("geocode_method"), confidence.alias("geocode_confidence"),
    )


def county_of_json(body: Column) -> Column:
    """County of a coordinate lookup's JSON answer, empty if it has none."""
    return F.coalesce(F.get_json_object(body, "$.result.geographies.Counties[0].GEOID"), F.lit(""))


def keep_last(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by an explicit order."""
    last = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def best_zip(crosswalk: DataFrame) -> DataFrame:
    """The county with the largest share of each ZIP code, least county at ties."""
    return crosswalk.groupBy("zip").agg(F.min(F.struct((-F.col("res_ratio")).alias("w"), "county_fips"))["county_fips"].alias("fallback"))


def zip_fallback(geocoded: DataFrame, facilities: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Geocoded rows and listings without one, missing counties filled by ZIP code at low confidence."""
    filled = facilities.select("listing_id", "zip").join(best_zip(crosswalk), "zip", "left").select(F.col("listing_id").alias("its_id"), "zip", "fallback")
    out = geocoded.join(filled, F.col("listing_id").eqNullSafe(F.col("its_id")), "full").withColumn("listing_id", F.coalesce("listing_id", "its_id")).drop("its_id")
    missing = F.coalesce("county_fips", F.lit("")) == ""
    used = missing & (F.coalesce("fallback", F.lit("")) != "")
    return out.withColumns({
        "county_fips": F.when(missing, F.col("fallback")).otherwise(F.col("county_fips")), "geocode_method": F.when(used, "zip_crosswalk").otherwise(F.col("geocode_method")),
        "geocode_confidence": F.when(used, "low").otherwise(F.col("geocode_confidence")),
    }).drop("fallback")


def pending(facilities: DataFrame, cache: DataFrame) -> DataFrame:
    """Listings that the cache lacks; a listing without identifier is pending."""
    return facilities.join(cache.select("listing_id").distinct(), "listing_id", "left_anti")


def batches(rows: DataFrame, order: str, size: int, slices: int = 1024) -> DataFrame:
    """Rows with the number of their ``batch``: every batch holds ``size`` rows but the last.

    Rows are numbered within slices of a hash, ``slices`` counts give what goes
    before each, and so no task holds all rows.
    """
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(order), F.lit(slices)))
    # One row a slice.
    before = F.sum("_count").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    counts = sliced.groupBy("_slice").agg(F.count("*").alias("_count")).select("_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_slice").orderBy(order)) - 1
    return sliced.join(F.broadcast(counts), "_slice").withColumn("batch", F.floor(number / size)).drop("_slice", "_before")


def geocode_pending(facilities: DataFrame, cache: DataFrame, geocoder: Callable[[pd.DataFrame], pd.DataFrame], schema: str, size: int = 1000) -> DataFrame:
    """The cache and the answers for the listings it lacks, asked in batches of ``size``; pauses and retries are the geocoder's."""
    asked = batches(pending(facilities, cache), "listing_id", size).groupBy("batch").applyInPandas(lambda frame: geocoder(frame.drop(columns="batch")), schema)
    return cache.unionByName(asked, allowMissingColumns=True)


def attach(facilities: DataFrame, extra: DataFrame, key: str = "listing_id") -> DataFrame:
    """Left join of one row per key, the least by its columns; columns of the extra table replace those of the same name."""
    others = [c for c in extra.columns if c != key]
    once = extra.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*") if others else extra.distinct()
    return facilities.drop(*[c for c in extra.columns if c != key]).join(once, key, "left")
