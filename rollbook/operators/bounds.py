"""Comparison with an external county series whose small cells are suppressed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import zero_padded

#: First year in which an absent cell may hold up to ``OMITTED_MAX`` establishments instead of none.
BREAK_YEAR, OMITTED_MAX, UNIVERSE = 2017, 2.0, "------"


def county_fips(state: str, county: str) -> tuple:
    """(state_fips, county_fips) Columns, padded and never cut."""
    two = zero_padded(F.col(state).cast("string"), 2)
    return two.alias("state_fips"), F.concat(two, zero_padded(F.col(county).cast("string"), 3)).alias("county_fips")


def county_cells(raw: DataFrame, naics: tuple[str, ...], break_year: int = BREAK_YEAR) -> DataFrame:
    """Every county of the universe times every industry, with what was published of it.

    ``raw``: year, fipstate, fipscty, naics, est (text), source_row; the first row of a cell stands.
    """
    rows = raw.select("year", *county_fips("fipstate", "fipscty"), F.trim("naics").alias("naics"), F.expr("try_cast(est AS double)").alias("establishments"), "source_row")
    universe = rows.where(F.col("naics") == UNIVERSE).select("year", "county_fips", "state_fips").distinct()
    grid = universe.withColumn("naics", F.explode(F.array(*map(F.lit, sorted(naics)))))
    first = rows.where(F.col("naics").isin(*naics)).groupBy("year", "county_fips", "state_fips", "naics").agg(F.min(F.struct("source_row", "establishments")).alias("cell"))
    cells = grid.join(first, ["year", "county_fips", "state_fips", "naics"], "left").withColumn("est", F.col("cell.establishments"))
    early = F.col("year") < break_year
    status = F.when(F.col("est").isNotNull(), "published").when(early, "zero").otherwise("omitted_or_zero")
    return cells.select("county_fips", "state_fips", "year", "naics", F.when(early, F.coalesce("est", F.lit(0.0))).otherwise(F.col("est")).alias("establishments"), status.alias("publication_status"))


def compare_counts(counts: DataFrame, cells: DataFrame, naics: tuple[str, ...], break_year: int = BREAK_YEAR) -> DataFrame:
    """Counts of listings (county_fips, state_fips, year, listing_count) beside bounds of the external series; full outer."""
    keys = ["county_fips", "state_fips", "year"]
    years = counts.select("year").distinct()
    own = cells.where(F.col("naics").isin(*naics)).join(years, "year", "left_semi")
    published = F.col("publication_status").isin("published", "zero") & F.col("establishments").isNotNull()
    upper = F.when(published, F.col("establishments")).otherwise(F.when(F.col("year") < break_year, 0.0).otherwise(OMITTED_MAX))
    grouped = own.groupBy(*keys).agg(
        F.when(F.count("establishments") == F.count("*"), F.sum("establishments")).alias("total"),
        F.sum(published.cast("int")).alias("cells"),
        F.sum(F.when(published, F.col("establishments")).otherwise(0.0)).alias("lower_bound"),
        F.sum(upper).alias("upper_bound"),
    )
    full = F.col("cells") == len(naics)
    grouped = grouped.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.when(full, F.col("total")).alias("external_count"), F.when(full, "published").otherwise("partially_or_fully_omitted").alias("publication_status"),
        "lower_bound", "upper_bound", (F.col("cells") / len(naics)).alias("cell_coverage_rate"), full.alias("common_support"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    out = counts.join(grouped, same, "full").withColumns({k: F.coalesce(k, f"_{k}") for k in keys}).drop(*[f"_{k}" for k in keys])
    out = out.withColumn("listing_count", F.coalesce("listing_count", F.lit(0)).cast("long")).withColumn("reporting_break", F.col("year") >= break_year)
    return out.select(*keys, "listing_count", "external_count", "publication_status", "lower_bound", "upper_bound", "cell_coverage_rate", "common_support", "reporting_break")


def summarize(comparison: DataFrame, break_year: int = BREAK_YEAR) -> DataFrame:
    """Yearly totals; sums are null where no county has a value."""
    supported, available = F.sum(F.col("common_support").cast("int")), F.count("publication_status")
    out = comparison.groupBy("year").agg(
        F.sum("listing_count").alias("listing_count"), F.sum("external_count").alias("published_count"), F.sum("lower_bound").alias("lower_bound"), F.sum("upper_bound").alias("upper_bound"),
        F.coalesce(supported, F.lit(0)).alias("published_counties"), available.alias("compared_counties"),
    )
    return out.withColumn("county_coverage_rate", F.try_divide("published_counties", "compared_counties")).withColumn("reporting_break", F.col("year") >= break_year)


def county_counts(facilities: DataFrame, geography: DataFrame) -> DataFrame:
    """Listings per county and year, of those with a five-digit county."""
    first = Window.partitionBy("listing_id").orderBy("ordinal")
    one = geography.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("listing_id", "county_fips")
    out = facilities.select("listing_id", F.col("survey_year").alias("year")).join(one, "listing_id", "left").where(F.col("county_fips").rlike(r"^\d{5}$"))
    return out.groupBy("county_fips", F.substring("county_fips", 1, 2).alias("state_fips"), "year").agg(F.count("*").alias("listing_count"))
