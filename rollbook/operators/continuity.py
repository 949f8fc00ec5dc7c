"""Continuity across years: yearly profile, transitions, and multi-scope rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import audit_text, has_code
from .quality import blank, share


def add_match_keys(facilities: DataFrame) -> DataFrame:
    """strict_key (name, address, city, state) and name_zip_key; blank if an essential part is."""
    name, address, city, state, zip5 = (audit_text(F.col(c)) for c in ("name1", "address1", "city", "state", "zip"))
    zip5 = F.substring(zip5, 1, 5)
    strict = F.when((name == "") | (address == "") | (state == ""), "").otherwise(F.concat_ws("|", name, address, city, state))
    return facilities.withColumns({"strict_key": strict, "name_zip_key": F.when((name == "") | (zip5 == "") | (state == ""), "").otherwise(F.concat_ws("|", name, zip5, state))})


def year_summary(facilities: DataFrame) -> DataFrame:
    """Profile of each directory year; shares are of its headline listings."""
    total = facilities.groupBy("directory_year").agg(F.count("*").alias("all_listings"))
    own = facilities.where("headline_us = 'yes'")
    n = F.size(F.filter(F.split(F.coalesce("service_codes", F.lit("")), r"\s+"), lambda x: x != ""))
    owner = lambda p: share(F.col("ownership_type").rlike(p))
    out = own.groupBy("directory_year").agg(
        F.min("survey_year").alias("survey_year"), F.count("*").alias("headline_us_listings"), share(blank("name1")).alias("missing_name_share"), share(blank("address1")).alias("missing_address_share"),
        share(blank("zip")).alias("missing_zip_share"), share(F.col("parser_warnings") != "[]").alias("warning_share"), F.avg(n).alias("mean_service_codes"), F.median(n).alias("median_service_codes"),
        owner("Non-profit").alias("nonprofit_share"), owner("For-profit").alias("forprofit_share"), owner("Public|Federal|Tribal").alias("government_share"),
        share(has_code(F.col("medication_services"), "OTP")).alias("otp_share"), share(has_code(F.col("care_settings"), "OP")).alias("outpatient_share"), share(has_code(F.col("care_settings"), "RES")).alias("residential_share"),
        share(has_code(F.col("care_settings"), "HI")).alias("hospital_share"), share(F.col("accepts_medicaid")).alias("medicaid_share"), share(F.col("accepts_medicare")).alias("medicare_share"),
        share(F.col("accepts_private_insurance")).alias("private_insurance_share"),
    )
    return out.join(total, "directory_year").withColumn("territory_listings", F.col("all_listings") - F.col("headline_us_listings"))


def state_transitions(facilities: DataFrame, transitions: list[tuple[int, int]]) -> DataFrame:
    """State counts of the two years of each transition; a state absent in one year counts 0."""
    pairs = facilities.sparkSession.createDataFrame(transitions, "earlier int, later int")
    counts = facilities.where("headline_us = 'yes'").groupBy("directory_year", "state").agg(F.count("*").alias("n"))
    both = counts.join(F.broadcast(pairs), (F.col("directory_year") == F.col("earlier")) | (F.col("directory_year") == F.col("later")))
    of = lambda c: F.coalesce(F.sum(F.when(F.col("directory_year") == F.col(c), F.col("n"))), F.lit(0))
    out = both.groupBy("earlier", "later", "state").agg(of("earlier").alias("earlier_count"), of("later").alias("later_count"))
    out = out.withColumn("count_change", F.col("later_count") - F.col("earlier_count"))
    out = out.withColumn("percent_change", F.try_divide("count_change", F.nullif("earlier_count", F.lit(0))))
    return out.withColumn("transition", F.concat_ws("_to_", "earlier", "later"))


def match_shares(facilities: DataFrame, transitions: list[tuple[int, int]], key: str) -> DataFrame:
    """Shares of later and earlier listings whose key the other year has, blank keys left out.

    Rows are counted per (year, key) before years meet, so each side of the
    join holds a key once and a frequent key is one row.
    """
    pairs = F.broadcast(facilities.sparkSession.createDataFrame(transitions, "earlier int, later int"))
    counts = facilities.where((F.col("headline_us") == "yes") & (F.col(key) != "")).groupBy("directory_year", F.col(key).alias("k")).agg(F.count("*").alias("n"))
    left = counts.join(pairs, F.col("directory_year") == F.col("earlier")).select("earlier", "later", "k", F.col("n").alias("n_earlier"))
    right = counts.join(pairs, F.col("directory_year") == F.col("later")).select("earlier", "later", "k", F.col("n").alias("n_later"))
    both = left.join(right, ["earlier", "later", "k"], "full")
    hit = F.col("n_earlier").isNotNull() & F.col("n_later").isNotNull()
    part = lambda c: F.try_divide(F.sum(F.when(hit, F.col(c)).otherwise(0)), F.sum(c))
    return both.groupBy("earlier", "later").agg(part("n_later").alias("later_share"), part("n_earlier").alias("earlier_share"))


def transition_summary(facilities: DataFrame, transitions: list[tuple[int, int]]) -> DataFrame:
    """National change, correlation of state counts, median change and match shares of each transition."""
    keyed = add_match_keys(facilities)
    states = state_transitions(facilities, transitions).groupBy("earlier", "later", "transition").agg(
        F.sum("earlier_count").alias("earlier_count"), F.sum("later_count").alias("later_count"),
        F.corr(F.col("earlier_count").cast("double"), F.col("later_count").cast("double")).alias("state_count_correlation"), F.median("percent_change").alias("median_state_percent_change"),
    )
    states = states.withColumn("national_percent_change", F.try_divide("later_count", "earlier_count") - 1)
    for name, key in (("strict", "strict_key"), ("name_zip", "name_zip_key")):
        rates = match_shares(keyed, transitions, key).withColumnsRenamed({"later_share": f"later_{name}_match_share", "earlier_share": f"earlier_{name}_match_share"})
        states = states.join(rates, ["earlier", "later"], "left")
    return states


def overview(facilities: DataFrame) -> DataFrame:
    """Listings and flags per year for the nation, regions, divisions and the Northwest, in one scan and one shuffle."""
    scope = lambda kind, value: F.struct(F.lit(kind).alias("scope_type"), value.alias("scope"))
    scopes = F.array(scope("us", F.lit("United States")), scope("region", F.col("census_region")), scope("division", F.col("census_division")), scope("pnw", F.col("pnw")))
    rows = facilities.where("headline_us = 'yes'").withColumn("s", F.explode(scopes)).select("directory_year", "s.*", "accepts_medicaid", "offers_telehealth")
    return rows.groupBy("scope_type", "scope", "directory_year").agg(
        F.count("*").alias("listings"), F.sum(F.col("accepts_medicaid").cast("long")).alias("accepting_medicaid"), F.sum(F.col("offers_telehealth").cast("long")).alias("offering_telehealth")
    )


def map_extract(facilities: DataFrame, codes: DataFrame, year: int) -> DataFrame:
    """Listings of one year with the codes of their service rows."""
    own = facilities.where(F.col("directory_year") == year).select("listing_id", "directory_year", "name1", "state", "zip")
    return own.join(codes, "listing_id", "left").withColumn("service_codes", F.coalesce("service_codes", F.lit("")))
