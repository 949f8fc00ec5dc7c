"""Services of listings: workbook tokens, availability, and the three states of a service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def workbook_services(rows: DataFrame, codebook: DataFrame) -> DataFrame:
    """Known codes of (listing_id, directory_year, service_code_info), each once, in order, with category and label."""
    tokens = F.array_distinct(F.filter(F.split(F.trim("service_code_info"), r"\s+"), lambda t: (t != "*") & (t != "")))
    exploded = rows.select("listing_id", "directory_year", F.posexplode(tokens).alias("position", "code"))
    least = codebook.groupBy("code").agg(F.min(F.struct("category", "label")).alias("_row")).select("code", "_row.*")
    return exploded.join(least, "code")


def unknown_workbook_tokens(rows: DataFrame, codebook: DataFrame) -> DataFrame:
    """Distinct tokens per year that the codebook lacks."""
    tokens = F.filter(F.split(F.trim("service_code_info"), r"\s+"), lambda t: (t != "*") & (t != ""))
    return rows.select("directory_year", F.explode(tokens).alias("code")).distinct().join(codebook.select("code"), "code", "left_anti")


def json_items(value: Column) -> Column:
    """Items of a JSON list that aren't empty; other text is one item."""
    text = F.coalesce(value, F.lit(""))
    return F.filter(F.coalesce(F.from_json(text, "array<string>"), F.array(text)), lambda x: x != "")


def unknown_tokens(facilities: DataFrame) -> DataFrame:
    """Distinct unknown tokens of each year that has any, sorted, joined by bars."""
    rows = facilities.select("directory_year", F.explode(json_items(F.col("unknown_service_tokens"))).alias("token"))
    return rows.groupBy("directory_year").agg(F.array_join(F.array_sort(F.collect_set("token")), "|").alias("tokens"))


def codes_by_listing(services: DataFrame) -> DataFrame:
    """Sorted distinct codes of each listing, joined by spaces."""
    return services.groupBy("listing_id").agg(F.array_join(F.array_sort(F.collect_set("code")), " ").alias("service_codes"))


def code_frequency(services: DataFrame) -> DataFrame:
    """Listings per year and code."""
    return services.select("directory_year", "listing_id", "code").distinct().groupBy("directory_year", "code").agg(F.count("*").alias("listings"))


def backfill_availability(availability: DataFrame, services: DataFrame) -> DataFrame:
    """Asked codes, and codes that listings of the year show although its legend lacks them."""
    asked = availability.where("asked").select("directory_year", "code", "asked", F.lit("pdf_legend").alias("source"))
    seen = services.select("directory_year", "code").distinct().join(asked, ["directory_year", "code"], "left_anti")
    return asked.unionByName(seen.select("directory_year", "code", F.lit(True).alias("asked"), F.lit("observed_listing_fallback").alias("source")))


def service_status(facilities: DataFrame, offered: DataFrame, availability: DataFrame) -> DataFrame:
    """offered, not_offered or not_asked for each listing and code of the reference.

    The reference row of a code prefers asked, then late years.  What was
    asked is joined to the reference, a table of codes and years, before
    listings multiply it; listings meet it by year and then only their own
    offers.
    """
    latest = Window.partitionBy("code").orderBy(F.desc("asked"), F.desc("directory_year"), "category", "label")
    reference = availability.withColumn("_n", F.row_number().over(latest)).where("_n = 1").select("code", "category", "label")
    years = facilities.select("directory_year").distinct()
    asked = availability.where("asked").select("directory_year", "code").distinct().withColumn("was_asked", F.lit(True))
    # The years and codes of the panel: two small dimensions, whatever the number of listings.
    grid = years.crossJoin(reference).join(asked, ["directory_year", "code"], "left")
    offers = offered.select("listing_id", "code").distinct().withColumn("is_offered", F.lit(True))
    out = facilities.select("listing_id", "directory_year", "survey_year").join(grid, "directory_year").join(offers, ["listing_id", "code"], "left")
    status = F.when(F.col("is_offered"), "offered").when(F.col("was_asked"), "not_offered").otherwise("not_asked")
    return out.select("listing_id", "directory_year", "survey_year", "code", "category", "label", status.alias("status"))


def build_codebook(legend: DataFrame, known: DataFrame) -> DataFrame:
    """Codebook of (directory_year, line_no, heading, code, label): headings carry on, the first of a code stands.

    Codes of ``known`` (code, category, label) that the legend lacks follow with asked = false.
    """
    order = Window.partitionBy("directory_year").orderBy("line_no")
    carried = legend.withColumn("category", F.coalesce(F.last("heading", True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit("Unclassified")))
    first = Window.partitionBy("directory_year", "code").orderBy("line_no")
    listed = carried.where("code is not null").withColumn("_n", F.row_number().over(first)).where("_n = 1")
    fallback = known.select("code", F.col("category").alias("core_category"), F.col("label").alias("core_label"))
    listed = listed.join(fallback, "code", "left").select("directory_year", "code", F.coalesce("core_category", "category").alias("category"), F.coalesce("core_label", "label").alias("label"), F.lit(True).alias("asked"), F.lit("pdf_legend").alias("source"))
    rest = legend.select("directory_year").distinct().crossJoin(known.select("code", "category", "label")).join(listed, ["directory_year", "code"], "left_anti")
    return listed.unionByName(rest.withColumns({"asked": F.lit(False), "source": F.lit("fallback_dictionary")}))
