"""Stratified samples for review: features, quotas and round-robin choice."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import checkpointed
from ..functions.text import clean_zip, short_hash

# Strata in order of choice, with their shares; the rest is random.
SHARES = {"warning_unknown": 0.20, "boundary": 0.10, "rare_dense_services": 0.10, "complex_record": 0.10}
RARE, QUINTILES = 10, 5
FLAGS = {"warning_unknown": "has_warning_unknown", "boundary": "is_boundary", "rare_dense_services": "is_rare_dense", "complex_record": "is_complex"}
CHECKS = ("name_check", "address_check", "services_check", "boundary_check")
FIELDS = ("name1", "name2", "address1", "city", "state", "zip", "service_codes")
GROUPS = ["page_quantile", "source_column", "census_region", "state"]
_UNIT = r"(?i)\b(?:Suite|Ste|Unit|Room|Floor|Building|Bldg|Apt|#)\b"


def quotas(total: int) -> dict[str, int]:
    """Rows per stratum, halves to even; the random stratum takes what is left."""
    out = {name: round(total * share) for name, share in SHARES.items()}
    return out | {"random": total - sum(out.values())}


def quota_counts(total: Column) -> dict[str, Column]:
    """``quotas`` as Columns."""
    out = {name: F.bround(total * F.lit(share), 0).cast("int") for name, share in SHARES.items()}
    return out | {"random": total - sum(out.values(), F.lit(0))}


def sampling_features(facilities: DataFrame) -> DataFrame:
    """page_quantile and the four flags of each listing.

    Page ranks come from the distinct pages of a year and code counts from an
    aggregate, so no window holds a year's listings.
    """
    rank = Window.partitionBy("directory_year").orderBy("source_page")
    pages = facilities.select("directory_year", "source_page").distinct().where("source_page is not null").withColumn("r", F.dense_rank().over(rank))
    pages = pages.withColumn("n", F.max("r").over(Window.partitionBy("directory_year")))
    pages = pages.select("directory_year", "source_page", F.least(F.ceil(F.col("r") * QUINTILES / F.col("n")), F.lit(QUINTILES)).cast("int").alias("page_quantile"))
    ends = facilities.groupBy("directory_year", "source_page", "source_column").agg(F.min("source_record_order").alias("lo"), F.max("source_record_order").alias("hi"))
    twins = facilities.groupBy("directory_year", "state", "city", "address1").agg((F.count("*") > 1).alias("is_twin"))
    codes = facilities.withColumn("codes", F.array_distinct(F.filter(F.split(F.coalesce("service_codes", F.lit("")), r"\s+"), lambda x: x != "")))
    frequent = codes.select("directory_year", F.explode("codes").alias("code")).groupBy("directory_year", "code").agg(F.count("*").alias("n"))
    rare = frequent.where(F.col("n") <= RARE).groupBy("directory_year").agg(F.collect_set("code").alias("rare"))
    dense = codes.groupBy("directory_year").agg(F.greatest(F.percentile(F.size("codes"), F.lit(0.9)), F.lit(1.0)).alias("p90"))
    out = codes.join(pages, ["directory_year", "source_page"], "left").join(ends, ["directory_year", "source_page", "source_column"], "left")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("directory_year", "state", "city", "address1")]
    out = out.join(twins.select("is_twin", *[F.col(c).alias(f"_{c}") for c in ("directory_year", "state", "city", "address1")]), same, "left")
    out = out.join(F.broadcast(dense), "directory_year").join(F.broadcast(rare), "directory_year", "left")
    text = F.coalesce("raw_record_text", F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    none = lambda c: F.coalesce(c, F.lit(False))
    return out.withColumns({
        "has_warning_unknown": (F.coalesce("parser_warnings", F.lit("")) != "[]") | (F.coalesce("unknown_service_tokens", F.lit("")) != "[]"),
        "is_boundary": none((F.col("source_record_order") == F.col("lo")) | (F.col("source_record_order") == F.col("hi"))),
        "is_rare_dense": none(F.arrays_overlap("codes", "rare")) | (F.size("codes") >= F.col("p90")),
        "is_complex": (breaks >= 5) | none(F.length("name1") >= 50) | (F.coalesce("name2", F.lit("")) != "") | none(F.col("address1").rlike(_UNIT)) | none(F.col("is_twin")),
    }).drop("lo", "hi", "p90", "rare", "codes", "is_twin", "_directory_year", "_state", "_city", "_address1")


def _order(seed: int, key: str) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), "directory_year", F.col(key)))


def _group(seed: int) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in GROUPS]))


def sample(features: DataFrame, size: int | DataFrame, seed: int = 0, key: str = "source_anchor_id") -> DataFrame:
    """``size`` listings per year, or (directory_year, size) of years, with their sample_stratum, in order of a seeded hash.

    Each stratum goes round its groups (page quintile, column, region, state)
    and takes one listing of each in turn.  A stratum's choice reads only the
    first ``size`` of each group, so what is ranked per year is bounded.
    """
    sized = features.withColumn("_size", F.lit(size)) if isinstance(size, int) else features.join(F.broadcast(size.withColumnRenamed("size", "_size")), "directory_year")
    left = checkpointed(sized.withColumn("_h", _order(seed, key)))
    chosen = None
    for stratum, n in quota_counts(F.col("_size")).items():
        flag = F.col(FLAGS[stratum]) if stratum in FLAGS else F.lit(True)
        taken = F.lit(0) if chosen is None else F.coalesce("_taken", F.lit(0))
        pool = left if chosen is None else left.join(chosen.select(key).distinct(), key, "left_anti")
        if stratum == "random" and chosen is not None:
            counts = chosen.groupBy("directory_year").agg(F.count("*").cast("int").alias("_taken"))
            pool = pool.join(F.broadcast(counts), "directory_year", "left")
        within = Window.partitionBy("directory_year", *GROUPS).orderBy("_h")
        turn = pool.where(flag).withColumn("_n", F.row_number().over(within)).where(F.col("_n") <= F.col("_size"))
        place = Window.partitionBy("directory_year").orderBy("_n", _group(seed), "_h")
        limit = F.col("_size") - taken if stratum == "random" else n
        turn = turn.withColumn("_p", F.row_number().over(place)).where(F.col("_p") <= limit).withColumn("sample_stratum", F.lit(stratum))
        turn = turn.select(*features.columns, "_h", "sample_stratum")
        chosen = checkpointed(turn if chosen is None else chosen.unionByName(turn))
    return chosen.drop("_h")


def stratum_counts(sampled: DataFrame) -> DataFrame:
    """Rows of each stratum."""
    return sampled.groupBy("sample_stratum").agg(F.count("*").alias("rows"))


def create(features: DataFrame, size: int | DataFrame, seed: int = 0, key: str = "source_anchor_id") -> DataFrame:
    """A new review table: the sample's identifiers, what was parsed, and blank fields for the reviewer.  An anchor sampled twice raises."""
    chosen = sample(features, size, seed, key)
    if twice := chosen.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").take(1):
        raise ValueError(f"the sample holds the source anchor {twice[0][key]!r} more than once")
    has = set(chosen.columns)
    kept = [c for c in ("source_anchor_id", "directory_year", "survey_year", "source_pdf", "source_page", "source_column", "source_record_order", "sample_stratum", "page_quantile", "raw_record_text", "raw_service_text", "parser_warnings", "unknown_service_tokens") if c in has]
    parsed = [(clean_zip(F.col(c)) if c == "zip" else F.col(c)).alias(f"parsed_{c}") for c in FIELDS if c in has]
    blank = [F.lit("").alias(c) for c in ("replacement_for_sample_id", "page_image", *[f"corrected_{c}" for c in FIELDS], *CHECKS, "review_complete")]
    return chosen.select(short_hash("G", 15, F.lit(seed), F.col(key)).alias("sample_id"), F.col("listing_id").alias("listing_id_at_sampling"), *kept, F.lit("active").alias("review_disposition"), *parsed, *blank)


def metadata(created: DataFrame, seed: int) -> dict:
    """Seed, rows, rows per year and per stratum of a review table; both counts are bounded by years and strata."""
    years = {r.directory_year: r.n for r in created.groupBy("directory_year").agg(F.count("*").alias("n")).orderBy("directory_year").collect()}
    return {"seed": seed, "total_rows": sum(years.values()), "sample_sizes": years, "stratum_counts": {r.sample_stratum: r["rows"] for r in stratum_counts(created).orderBy("sample_stratum").collect()}}


def disposition() -> Column:
    """A review's disposition: active unless it says otherwise, replaced if any check is uncertain."""
    uncertain = [F.lower(F.coalesce(c, F.lit(""))) == "uncertain" for c in CHECKS]
    given = F.lower(F.coalesce("review_disposition", F.lit("")))
    return F.when(uncertain[0] | uncertain[1] | uncertain[2] | uncertain[3], "unreviewable_replaced").otherwise(F.when(given == "", "active").otherwise(given))


def expand(reviewed: DataFrame, features: DataFrame, target: int | DataFrame, seed: int = 0, key: str = "source_anchor_id", most: int | None = 200) -> DataFrame:
    """More listings, none reviewed before, for years with fewer active reviews than ``target``, a number or (directory_year, target), at most ``most``.

    An unreviewable review is replaced from its own stratum first, in order of
    its key, and ``replaces`` names it; a fresh sample fills the rest.
    """
    marked = checkpointed(reviewed.withColumn("_d", disposition()).select("directory_year", key, "sample_stratum", "_d"))
    have = marked.where("_d = 'active'").groupBy("directory_year").agg(F.count("*").alias("have"))
    years = features.select("directory_year").distinct()
    wanted = years.withColumn("target", F.lit(target)) if isinstance(target, int) else years.join(target, "directory_year")
    bound = F.col("target") if most is None else F.least("target", F.lit(most))
    short = wanted.join(have, "directory_year", "left").select("directory_year", (bound - F.coalesce("have", F.lit(0))).cast("int").alias("size"))
    short = checkpointed(short.where("size > 0"))
    fresh = features.join(marked.select(key).distinct(), key, "left_anti").join(F.broadcast(short), "directory_year")
    fresh = checkpointed(fresh.withColumn("_h", _order(seed + 10_000, key)))
    stratum_of = F.when(F.col("sample_stratum").isin(*FLAGS), F.col("sample_stratum")).otherwise("random")
    old = marked.where("_d = 'unreviewable_replaced'").withColumn("_s", stratum_of).withColumn("_p", F.row_number().over(Window.partitionBy("directory_year", "_s").orderBy(key)))
    old = checkpointed(old.select("directory_year", "_s", "_p", "sample_stratum", F.col(key).alias("replaces")))
    pairs = None
    for stratum in [*FLAGS, "random"]:
        pool = fresh if pairs is None else fresh.join(pairs.select(key), key, "left_anti")
        pool = pool.where(F.col(FLAGS[stratum]) if stratum in FLAGS else F.lit(True))
        # No year needs more of a stratum than it needs in all.
        turn = pool.withColumn("_n", F.row_number().over(Window.partitionBy("directory_year", *GROUPS).orderBy("_h"))).where(F.col("_n") <= F.col("size"))
        turn = turn.withColumn("_p", F.row_number().over(Window.partitionBy("directory_year").orderBy("_n", _group(seed + 10_000), "_h"))).where(F.col("_p") <= F.col("size"))
        met = turn.select("directory_year", key, "_p").join(old.where(F.col("_s") == stratum), ["directory_year", "_p"]).select("directory_year", key, "sample_stratum", "replaces")
        pairs = checkpointed(met if pairs is None else pairs.unionByName(met))
    pairs = pairs.withColumn("_r", F.row_number().over(Window.partitionBy("directory_year").orderBy("replaces"))).join(F.broadcast(short), "directory_year").where(F.col("_r") <= F.col("size"))
    pairs = checkpointed(pairs.select(key, "directory_year", "sample_stratum", "replaces"))
    done = pairs.groupBy("directory_year").agg(F.count("*").cast("int").alias("done"))
    rest = short.join(done, "directory_year", "left").select("directory_year", (F.col("size") - F.coalesce("done", F.lit(0))).cast("int").alias("size")).where("size > 0")
    others = fresh.join(pairs.select(key), key, "left_anti").select(*features.columns)
    more = sample(others, rest, seed + 20_000, key).withColumn("replaces", F.lit(None).cast("string"))
    replaced = features.join(pairs.select(key, "sample_stratum", F.col("replaces").cast("string").alias("replaces")), key)
    return replaced.select(more.columns).unionByName(more)


def round_robin(frame: pd.DataFrame, n: int, groups: list[str]) -> list:
    """Plain version of the choice, for tests: indexes in order, one of each group in turn."""
    queues = [list(g.index) for _, g in frame.groupby(groups, dropna=False, sort=False)]
    return [q[i] for i in range(max(map(len, queues), default=0)) for q in queues if i < len(q)][:n]
