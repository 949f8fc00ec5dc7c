"""Evaluation of reviewed samples, and refreshing them against a new parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_codes, normalize_key
from .quality import EARLY_GATE, EARLY_YEARS, LATE_GATE, share
from .sampling import CHECKS

# What a check and a completion mark may say.
ANSWERS, COMPLETION = ("yes", "no", "uncertain"), ("yes", "no")
PARSED = ("parsed_name1", "parsed_name2", "parsed_address1", "parsed_city", "parsed_state", "parsed_zip", "parsed_service_codes")


def _text(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def gold_value(corrected: str, parsed: str) -> Column:
    """The correction where there is one, else what was parsed."""
    return F.when(_text(corrected) != "", _text(corrected)).otherwise(_text(parsed))


def gold_name() -> Column:
    """Both name lines: the corrected pair if either is given, so that a blank can clear the second."""
    pair = lambda a, b: F.array_join(F.filter(F.array(_text(a), _text(b)), lambda x: x != ""), " ")
    return F.when((_text("corrected_name1") != "") | (_text("corrected_name2") != ""), pair("corrected_name1", "corrected_name2")).otherwise(pair("parsed_name1", "parsed_name2"))


def compare(reviews: DataFrame, facilities: DataFrame, ascii_only: bool = False) -> DataFrame:
    """name_accurate, address_accurate, service_accurate and anchor_matched of each complete active review."""
    done = reviews.where((F.lower("review_complete") == "yes") & F.lower(F.coalesce("review_disposition", F.lit(""))).isin("", "active"))
    now = facilities.select("source_anchor_id", F.lit(True).alias("found"), "name1", "name2", "address1", "city", "state", "zip", "service_codes")
    both = done.join(now, "source_anchor_id", "left")
    name = F.trim(F.concat_ws(" ", F.coalesce("name1", F.lit("")), F.coalesce("name2", F.lit(""))))
    place = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in ("address1", "city", "state", "zip")])
    gold_place = F.concat_ws("|", *[gold_value(f"corrected_{c}", f"parsed_{c}") for c in ("address1", "city", "state", "zip")])
    return both.withColumns({
        "anchor_matched": F.coalesce("found", F.lit(False)), "name_accurate": normalize_key(gold_name(), ascii_only) == normalize_key(name, ascii_only),
        "address_accurate": normalize_key(gold_place, ascii_only) == normalize_key(place, ascii_only),
        "service_accurate": canonical_codes(gold_value("corrected_service_codes", "parsed_service_codes")) == canonical_codes(F.col("service_codes")),
    })


def year_metrics(compared: DataFrame) -> DataFrame:
    """Accuracies, pass, and the sample size to go on with, per year."""
    uncertain = F.greatest(*[F.coalesce(F.lower(c) == "uncertain", F.lit(False)) for c in CHECKS])
    wrong = ~(F.col("name_accurate") & F.col("address_accurate") & F.col("service_accurate"))
    worst = compared.where(wrong).groupBy("directory_year", "sample_stratum").agg(F.count("*").alias("n")).groupBy("directory_year").agg((F.max("n") / F.sum("n")).alias("largest_error_stratum_share"))
    out = compared.groupBy("directory_year").agg(
        F.count("*").alias("reviewed_rows"), share(F.col("name_accurate")).alias("name_accuracy"), share(F.col("address_accurate")).alias("address_accuracy"), share(F.col("service_accurate")).alias("service_accuracy"),
        share(uncertain).alias("uncertain_share"), F.sum((~F.col("anchor_matched")).cast("long")).alias("unmatched_anchors"), F.sum(F.coalesce(F.lower("boundary_check") == "no", F.lit(False)).cast("long")).alias("boundary_errors"),
    ).join(worst, "directory_year", "left").fillna(0.0, ["largest_error_stratum_share"])
    out = out.withColumn("target", F.when(F.col("directory_year").isin(*EARLY_YEARS), EARLY_GATE).otherwise(LATE_GATE))
    good = F.least("name_accuracy", "address_accuracy", "service_accuracy") >= F.col("target")
    out = out.withColumn("pass", good & (F.col("uncertain_share") <= 0.05) & (F.col("unmatched_anchors") == 0) & (F.col("boundary_errors") == 0))
    out = out.withColumn("expansion_required", ~F.col("pass") | (F.col("largest_error_stratum_share") >= 0.5))
    full, n = F.col("reviewed_rows") >= 200, F.col("reviewed_rows")
    return out.withColumn("recommended_sample_size", F.when(F.col("expansion_required") & ~full, F.least(n + 50, F.lit(200))).otherwise(n)).withColumn("blocked_at_200", F.col("expansion_required") & full)


def run_summary(metrics: DataFrame, years: list[int]) -> DataFrame:
    """One row over the yearly metrics: whether every expected year passes without boundary errors, and what is missing or blocked.

    Years are lists joined by bars, as a run has some dozen of them.
    """
    expected = metrics.sparkSession.createDataFrame([(y,) for y in years], "year int")
    both = expected.join(metrics, F.col("year") == F.col("directory_year"), "full")
    listed = lambda rule, year: F.array_join(F.array_sort(F.collect_set(F.when(rule, F.col(year)))), "|")
    out = both.agg(listed(F.col("directory_year").isNull(), "year").alias("missing_review_years"), listed(~F.col("pass"), "directory_year").alias("blocked_years"), F.coalesce(F.sum("boundary_errors"), F.lit(0)).alias("unresolved_boundary_errors"))
    return out.withColumn("passing", (F.col("missing_review_years") == "") & (F.col("blocked_years") == "") & (F.col("unresolved_boundary_errors") == 0))


def invalid_review_values(reviews: DataFrame) -> DataFrame:
    """(column, value, rows) of checks and completion marks outside their domain; null counts as blank."""
    value = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in (*CHECKS, "review_complete")])
    rows = reviews.select(F.explode(cells).alias("cell")).select("cell.*").groupBy("column", "value").agg(F.count("*").alias("rows"))
    allowed = F.col("value").isin(*ANSWERS, "") & ((F.col("column") != "review_complete") | F.col("value").isin(*COMPLETION, ""))
    return rows.where(~allowed)


def check_reviews(reviews: DataFrame) -> DataFrame:
    """The reviews with their completion mark in lower case; missing columns or values outside their domain raise."""
    if absent := [c for c in (*CHECKS, "review_complete") if c not in reviews.columns]:
        raise ValueError(f"reviews lack the columns {', '.join(absent)}")
    if wrong := invalid_review_values(reviews).orderBy("column", "value").take(20):
        raise ValueError("invalid values: " + ", ".join(f"{r.column}={r.value!r}" for r in wrong))
    return reviews.withColumn("review_complete", F.lower(F.coalesce("review_complete", F.lit(""))))


def simple_accuracy(gold: DataFrame, facilities: DataFrame, ascii_only: bool = False) -> DataFrame:
    """One row: completed reviews and the shares of equal addresses and code sets."""
    codes = lambda c: F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")))
    own = facilities.select("listing_id", "address1", "service_codes")
    both = gold.where(F.lower("review_complete") == "yes").join(own, "listing_id", "left")
    same = normalize_key(F.col("address1_gold"), ascii_only) == normalize_key(F.col("address1"), ascii_only)
    return both.agg((F.count("*") > 0).alias("completed"), F.count("*").alias("rows"), share(same).alias("address_accuracy"), share(codes("service_codes_gold") == codes("service_codes")).alias("service_accuracy"))


def refresh(reviews: DataFrame, facilities: DataFrame) -> DataFrame:
    """Reviews with parsed fields of the new parse; human fields stay.

    An anchor that is gone takes the one listing at the same (year, page,
    column, order), if there is just one; ``refresh_status`` says what happened.
    """
    spot = ["directory_year", "source_page", "source_column", "source_record_order"]
    now = facilities.select("source_anchor_id", *spot, *[F.col(p.removeprefix("parsed_")).alias(f"new_{p}") for p in PARSED])
    only = now.withColumn("_n", F.count("*").over(Window.partitionBy(*spot))).where("_n = 1").select(F.col("source_anchor_id").alias("moved_to"), *spot)
    out = reviews.join(now.select(F.col("source_anchor_id").alias("same")), F.col("source_anchor_id") == F.col("same"), "left").join(only, spot, "left")
    status = F.when(F.col("same").isNotNull(), "matched").when(F.col("moved_to").isNotNull(), "reanchored").otherwise("unmatched")
    out = out.withColumn("refresh_status", status).withColumn("new_anchor", F.coalesce("same", "moved_to"))
    new = now.select(F.col("source_anchor_id").alias("new_anchor"), *[f"new_{p}" for p in PARSED])
    out = out.join(new, "new_anchor", "left").withColumn("source_anchor_id", F.coalesce("new_anchor", "source_anchor_id"))
    return out.withColumns({p: F.when(F.col("new_anchor").isNotNull(), F.coalesce(f"new_{p}", F.lit(""))).otherwise(F.col(p)) for p in PARSED}).drop("same", "moved_to", "new_anchor", *[f"new_{p}" for p in PARSED])
