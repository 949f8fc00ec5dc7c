"""Entity resolution of listings across years, by exact keys and then by similarity within a ZIP code.

The result depends on the order of records, but only within a (state, zip):
that block is one group.  Only the first record of each exact key needs the
comparison, so the group holds distinct spellings and later repeats are
joined by key.  Records without a state or ZIP code are compared with
nothing, so they are no group and stay in the JVM.

Within a block most pairs are settled by bounds of the ratio: it is at most
twice the common letters over all letters, and that at most twice the shorter
length over both.  Only pairs whose bounds reach the threshold are matched in
full, so the result is that of all pairs.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_key

# Weights and thresholds of the match.
NAME_WEIGHT, ADDRESS_WEIGHT, ACCEPT, AUTO = 0.65, 0.35, 0.93, 0.97
_SCHEMA = "exact_key string, facility_id string, method string, confidence double, review string, head_id string"


class _Key:
    """A text with its letters counted once."""

    def __init__(self, text: str):
        self.text, self.size, self.letters = text, len(text), Counter(text)

    def bound(self, other: _Key) -> float:
        """At least the ratio, by lengths."""
        whole = self.size + other.size
        return 2 * min(self.size, other.size) / whole if whole else 1.0

    def closer_bound(self, other: _Key) -> float:
        """At least the ratio, by letters."""
        whole = self.size + other.size
        return 2 * (self.letters & other.letters).total() / whole if whole else 1.0

    def ratio(self, other: _Key) -> float:
        return SequenceMatcher(None, self.text, other.text).ratio()


def _score(own: tuple[_Key, _Key], seed: tuple[_Key, _Key], least: float) -> float:
    """Weighted similarity, or 0 as soon as it can't reach ``least``."""
    for bound in (_Key.bound, _Key.closer_bound):
        if NAME_WEIGHT * bound(own[0], seed[0]) + ADDRESS_WEIGHT * bound(own[1], seed[1]) < least - 1e-9:
            return 0.0
    name = own[0].ratio(seed[0])
    if NAME_WEIGHT * name + ADDRESS_WEIGHT * own[1].closer_bound(seed[1]) < least - 1e-9:
        return 0.0
    return NAME_WEIGHT * name + ADDRESS_WEIGHT * own[1].ratio(seed[1])


def link_block(block: pd.DataFrame, threshold: float = ACCEPT) -> pd.DataFrame:
    """Entities of the distinct spellings of one block, in the order of its rows."""
    seeds: list[tuple[str, tuple[_Key, _Key]]] = []
    out = []
    for r in block.itertuples(index=False):
        own = _Key(r.name_key), _Key(r.address_key)
        score, entity = max(((_score(own, keys, threshold), f) for f, keys in seeds), default=(0.0, ""))
        if score >= threshold:
            out.append((r.exact_key, entity, "fuzzy_within_zip", round(score, 4), "manual_review" if score < AUTO else "not_required", r.listing_id))
        else:
            entity = "F" + hashlib.sha1(f"{r.exact_key}|{r.listing_id}".encode()).hexdigest()[:14]
            seeds.append((entity, own))
            out.append((r.exact_key, entity, "new_entity", 1.0, "not_required", r.listing_id))
    return pd.DataFrame(out, columns=["exact_key", "facility_id", "method", "confidence", "review", "head_id"])


def link_facilities(facilities: DataFrame, threshold: float = ACCEPT, ascii_only: bool = False) -> DataFrame:
    """listing_id, facility_id, linkage_method, linkage_confidence, review_status.

    A null state or ZIP code never matches by similarity.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    keyed = facilities.select("listing_id", "survey_year", "state", "zip", "name1", normalize_key(F.col("name1"), ascii_only).alias("name_key"), normalize_key(F.col("address1"), ascii_only).alias("address_key"))
    keyed = keyed.withColumn("exact_key", F.concat_ws("|", blank("state"), blank("zip"), "name_key", "address_key"))
    # The order of records, nulls last.
    names = [x for c in ("survey_year", "state", "zip", "name1") for x in (f"no_{c}", c)] + ["listing_id"]
    order = [F.col(c.removeprefix("no_")).isNull().alias(c) if c.startswith("no_") else F.col(c) for c in names]
    heads = keyed.groupBy("exact_key").agg(F.min(F.struct(*order)).alias("head"), F.min("name_key").alias("name_key"), F.min("address_key").alias("address_key"))
    heads = heads.select("exact_key", "name_key", "address_key", "head.*")

    def linked_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.astype(object).where(block.notna(), None)
        # Within a flag's group of nulls the value itself says nothing.
        place = block[names].apply(lambda r: tuple("" if x is None else x for x in r), axis=1)
        return link_block(block.assign(place=place).sort_values("place", kind="stable"), threshold)

    complete = F.col("state").isNotNull() & F.col("zip").isNotNull()
    matched = heads.where(complete).groupBy("state", "zip").applyInPandas(linked_block, _SCHEMA)
    entity = F.concat(F.lit("F"), F.substring(F.sha1(F.concat_ws("|", "exact_key", "listing_id")), 1, 14))
    alone = heads.where(~complete).select("exact_key", entity.alias("facility_id"), F.lit("new_entity").alias("method"), F.lit(1.0).alias("confidence"), F.lit("not_required").alias("review"), F.col("listing_id").alias("head_id"))
    out = keyed.select("listing_id", "exact_key").join(matched.unionByName(alone), "exact_key")
    repeat = F.col("listing_id") != F.col("head_id")
    return out.select(
        "listing_id", "facility_id", F.when(repeat, "exact_name_address").otherwise(F.col("method")).alias("linkage_method"),
        F.when(repeat, 1.0).otherwise(F.col("confidence")).alias("linkage_confidence"), F.when(repeat, "not_required").otherwise(F.col("review")).alias("review_status"),
    )
