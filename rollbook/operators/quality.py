"""Yearly quality of the panel, structural metrics and release gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geography import is_valid_state
from ..functions.text import is_header_noise

# Gates.
MAX_CHANGE, COUNT_GATE, GEOCODE_GATE, LINKAGE_GATE, EARLY_GATE, LATE_GATE = 0.25, 0.02, 0.90, 0.98, 0.95, 0.98
EARLY_YEARS = (1998, 2000, 2001)
COVERAGE = {"early_ocr": 0.60, "other": 0.80}
PRIORITY_YEARS = (1998, 2000, 2001, 2003, 2004, 2017, 2018, 2021)


# Phrases of the rights scan, and the pages that are read at least.
NOTICE, NOTICE_PAGE, FEE = "PUBLIC DOMAIN NOTICE", "PUBLIC DOMAIN", "DISTRIBUTED FOR A FEE"
REPRODUCTION = ("MAY BE REPRODUCED", "REPRODUCED OR COPIED")
LEAST_PAGES = 20


def share(condition: Column) -> Column:
    """Mean of a condition; null counts as false."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def qa_by_year(facilities: DataFrame, services: DataFrame) -> DataFrame:
    """Rows, states, shares of defects and the change from the year before."""
    served = services.groupBy("directory_year").agg(F.countDistinct("listing_id").alias("served"))
    out = facilities.groupBy("directory_year").agg(
        F.min("survey_year").alias("survey_year"), F.count("*").alias("rows"), F.countDistinct("state").alias("states"),
        share(blank("name1")).alias("missing_name_share"), share(blank("address1")).alias("missing_address_share"),
        share(~is_valid_state(F.col("state"))).alias("invalid_state_share"), share(is_header_noise(F.col("name1"))).alias("header_noise_share"),
        share(F.col("parser_warnings").contains("weak_address_pattern")).alias("weak_address_share"),
    )
    # One row a year from here on.
    out = out.join(served, "directory_year", "left").withColumn("service_record_share", F.coalesce("served", F.lit(0)) / F.col("rows")).drop("served")
    before = F.lag("rows").over(Window.orderBy("directory_year"))
    out = out.withColumn("row_change", F.col("rows") / before - 1)
    return out.withColumn("large_discontinuity", F.coalesce(F.abs("row_change") > MAX_CHANGE, F.lit(False)))


def label_release(facilities: DataFrame, reviews: DataFrame, workbook_year: int = 2022) -> DataFrame:
    """Source format, warning flag, review counts, sample targets and status of a preliminary release."""
    done = reviews.where(F.lower("review_complete") == "yes").groupBy("directory_year").agg(F.count("*").cast("int").alias("reviewed_listings_in_year"))
    late = F.col("directory_year") >= workbook_year
    out = facilities.withColumn("source_format", F.when(late, "official_xlsx").otherwise("historical_pdf"))
    out = out.withColumn("has_parser_warning", F.coalesce("parser_warnings", F.lit("[]")) != "[]").join(F.broadcast(done), "directory_year", "left")
    out = out.withColumn("reviewed_listings_in_year", F.coalesce("reviewed_listings_in_year", F.lit(0)))
    out = out.withColumn("gold_target_in_year", F.when(late, 0).when(F.col("directory_year").isin(*PRIORITY_YEARS), 100).otherwise(50))
    status = F.when(F.col("source_format") == "official_xlsx", "official_xlsx_checks_passed").when(F.col("reviewed_listings_in_year") > 0, "partial_review").otherwise("not_reviewed")
    return out.withColumn("year_qa_status", status).withColumn("release_status", F.lit("preliminary"))


def qa_preliminary(labelled: DataFrame) -> DataFrame:
    """Yearly counts and status of a preliminary release; a null year is a group."""
    out = labelled.groupBy("directory_year", "survey_year").agg(
        F.count("*").alias("facility_count"), F.sum(F.col("has_parser_warning").cast("int")).alias("warning_count"), F.max("reviewed_listings_in_year").alias("reviewed_listings"),
        F.max("gold_target_in_year").alias("gold_target"), F.max("year_qa_status").alias("qa_status"),
    )
    return out.withColumn("warning_share", F.col("warning_count") / F.col("facility_count"))


def percent(value: Column, places: int = 1) -> Column:
    """A share as text, like 12.5%."""
    return F.format_string(f"%.{places}f%%", F.bround(value * 100, places))


def structural_metrics(facilities: DataFrame, services: DataFrame, availability: DataFrame, expected: DataFrame, min_rows: int = 1000, max_rows: int = 30000) -> DataFrame:
    """Per year: counts, shares, page range, and the reasons that block it, in order.

    ``expected``: directory_year, expected_listings (null for none) and, where
    known, layout_profile, end_page (the last page to read) and pdf_page_count.
    """
    optional = {"layout_profile": "string", "end_page": "int", "pdf_page_count": "int"}
    expected = expected.withColumns({c: F.lit(None).cast(t) for c, t in optional.items() if c not in expected.columns})
    out = facilities.groupBy("directory_year").agg(
        F.count("*").alias("facility_rows"), F.countDistinct("state").alias("state_count"), F.array_join(F.array_sort(F.collect_set("state")), "|").alias("states"),
        F.sum((~is_valid_state(F.col("state"))).cast("int")).alias("invalid_state_records"), F.sum(F.coalesce(is_header_noise(F.col("name1")), F.lit(False)).cast("int")).alias("header_records"),
        F.sum((F.coalesce("parser_warnings", F.lit("")) != "[]").cast("int")).alias("warning_records"), share(blank("name1")).alias("missing_name_share"), share(blank("address1")).alias("missing_address_share"),
        share(F.col("parser_warnings").contains("weak_address_pattern")).alias("weak_address_share"),
        F.min("source_page").alias("first_page_with_record"), F.max("source_page").alias("last_page_with_record"), F.countDistinct("source_page").alias("pages_with_records"),
    )
    served = services.groupBy("directory_year").agg(F.count("*").alias("service_rows"), F.countDistinct("listing_id").alias("service_listings"))
    asked = availability.groupBy("directory_year").agg(F.count("*").alias("availability_rows"))
    out = out.join(served, "directory_year", "left").join(asked, "directory_year", "left").join(expected, "directory_year", "left")
    out = out.fillna(0, ["service_rows", "service_listings", "availability_rows"])
    out = out.withColumn("service_coverage", F.col("service_listings") / F.greatest("facility_rows", F.lit(1)))
    out = out.withColumn("count_difference_share", F.try_divide(F.abs(F.col("facility_rows") - F.col("expected_listings")), "expected_listings"))
    out = out.withColumn("page_coverage_complete", F.col("pdf_page_count") >= F.col("end_page"))
    least = F.when(F.col("layout_profile") == "early_ocr", COVERAGE["early_ocr"]).otherwise(COVERAGE["other"])
    says = lambda text, value: F.concat(F.lit(text), value)
    rules = [
        (F.col("invalid_state_records") > 0, F.concat("invalid_state_records", F.lit(" malformed state records"))), (F.col("header_records") > 0, F.concat("header_records", F.lit(" parsed header records"))),
        (~F.col("facility_rows").between(min_rows, max_rows), says("implausible listing count: ", F.col("facility_rows"))), (F.col("service_listings") == 0, F.lit("empty service extraction")),
        ((F.col("service_listings") > 0) & (F.col("service_coverage") < least), F.concat(F.lit("service coverage "), percent(F.col("service_coverage")), F.lit(" is below "), percent(least, 0))),
        (F.col("availability_rows") == 0, F.lit("empty service availability")), (~F.col("page_coverage_complete"), F.lit("PDF ends before the configured final page")),
        (F.col("missing_name_share") > 0.05, says("missing facility-name share is ", percent(F.col("missing_name_share")))), (F.col("missing_address_share") > 0.01, says("missing address share is ", percent(F.col("missing_address_share")))),
        (F.col("weak_address_share") > 0.25, says("weak-address warning share is ", percent(F.col("weak_address_share")))),
        (F.col("count_difference_share") > 0.35, says("listing count differs from comparison fixture by ", percent(F.col("count_difference_share")))),
    ]
    reasons = F.array_compact(F.array(*[F.when(rule, text) for rule, text in rules]))
    return out.withColumn("blocking_reasons", F.array_join(reasons, "; ")).withColumn("structural_pass", F.size(reasons) == 0).drop("end_page", "pdf_page_count")


def workbook_metrics(facilities: DataFrame, services: DataFrame, unknown: DataFrame, expected: DataFrame) -> DataFrame:
    """Per year of workbook import: exact row count, valid states, no unknown token, coverage of 99 %."""
    out = facilities.groupBy("directory_year").agg(F.count("*").alias("facility_rows"), F.sum((~is_valid_state(F.col("state"))).cast("int")).alias("invalid_state_records"))
    served = services.groupBy("directory_year").agg(F.countDistinct("listing_id").alias("served"))
    tokens = unknown.groupBy("directory_year").agg(F.count("*").alias("unknown_token_count"))
    out = out.join(served, "directory_year", "left").join(tokens, "directory_year", "left").join(expected, "directory_year", "left").fillna(0, ["served", "unknown_token_count"])
    out = out.withColumn("service_coverage", F.col("served") / F.col("facility_rows")).drop("served")
    passes = (F.col("invalid_state_records") == 0) & (F.col("unknown_token_count") == 0) & (F.col("facility_rows") == F.col("expected_listings")) & (F.col("service_coverage") >= 0.99)
    return out.withColumn("structural_pass", F.coalesce(passes, F.lit(False)))


def with_count_reference(annual: DataFrame, expected: DataFrame) -> DataFrame:
    """Yearly rows beside independent counts (directory_year, expected_listings, acceptance_reference)."""
    out = annual.join(F.broadcast(expected), "directory_year", "left")
    out = out.withColumn("count_difference_share", F.try_divide(F.abs(F.col("rows") - F.col("expected_listings")), "expected_listings"))
    return out.withColumn("count_within_2pct", F.coalesce(F.col("count_difference_share") <= COUNT_GATE, F.lit(False)))


def geocode_shares(geocoded: DataFrame) -> DataFrame:
    """Shares of listings with a county and with a confident one."""
    return geocoded.agg(share(~blank("county_fips")).alias("assigned_share"), share(F.col("geocode_confidence") == "high").alias("high_share"))


def release_gates(annual: DataFrame, geocoded: DataFrame, gold: DataFrame, linkage_accuracy: float | None) -> DataFrame:
    """One row: the five gates and the reasons that block a release, in order.

    ``annual`` from ``with_count_reference``; ``gold`` has address_accuracy and service_accuracy, or no row.
    """
    structure = (F.col("invalid_state_share") == 0) & (F.col("header_noise_share") == 0) & ~F.col("large_discontinuity")
    accepted = (F.lower(F.coalesce("acceptance_reference", F.lit("no"))) == "yes") & F.col("expected_listings").isNotNull() & F.col("count_within_2pct")
    out = annual.agg(F.min(structure).alias("structural_pass"), F.min(accepted).alias("count_reference_pass"), F.min(F.col("directory_year").isin(*EARLY_YEARS)).alias("early"))
    out = out.withColumn("gold_target", F.when(F.col("early"), EARLY_GATE).otherwise(LATE_GATE)).drop("early")
    # Single rows from here on.
    out = out.join(F.broadcast(gold.agg(F.min("address_accuracy").alias("a"), F.min("service_accuracy").alias("s"))), F.lit(True), "left").join(F.broadcast(geocode_shares(geocoded).select("high_share")), F.lit(True), "left")
    false = F.lit(False)
    out = out.withColumn("gold_pass", F.coalesce((F.col("a") >= F.col("gold_target")) & (F.col("s") >= F.col("gold_target")), false)).drop("a", "s")
    out = out.withColumn("geocoding_pass", F.coalesce(F.col("high_share") >= GEOCODE_GATE, false)).withColumn("linkage_pass", F.lit(linkage_accuracy is not None and linkage_accuracy >= LINKAGE_GATE))
    named = {
        "structural_pass": "structural parser QA failed", "count_reference_pass": "independent annual count references are incomplete or outside 2%", "gold_pass": "manual gold sample is incomplete or below target",
        "geocoding_pass": "high-confidence county assignment is below 90% or absent", "linkage_pass": "manual linkage precision is below 98% or absent",
    }
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(k), false), text) for k, text in named.items()]))
    return out.withColumn("blocking_reasons", F.array_join(reasons, "; ")).withColumn("release_ready", F.size(reasons) == 0)


def rights_scan(pages: DataFrame, by: str, whole: bool = False) -> DataFrame:
    """Rights phrases in the pages (``by``, page, start_page, text) of each file.

    The first ``LEAST_PAGES`` pages are read, or up to the start page where that
    is later; ``whole`` reads all.  A phrase counts within one page; a null text
    holds none, and a null start page counts as the first.
    """
    read = pages if whole else pages.where(F.col("page") <= F.greatest(F.col("start_page"), F.lit(LEAST_PAGES)))
    text = F.upper(F.coalesce("text", F.lit("")))
    held = lambda *phrases: F.max(reduce(Column.__or__, [text.contains(p) for p in phrases]))
    out = read.groupBy(by).agg(
        held(NOTICE).alias("public_domain_notice"), held(*REPRODUCTION).alias("reproduction_permission"), held(FEE).alias("fee_restriction_found"),
        F.min(F.when(text.contains(NOTICE_PAGE), F.col("page"))).alias("notice_pdf_page"),
    )
    eligible = F.col("public_domain_notice") & F.col("reproduction_permission")
    return out.withColumns({"archive_eligible": eligible, "manual_review_required": ~eligible})
