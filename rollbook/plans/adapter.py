"""A facility panel derived from the star-schema tables, as SQL that Spark and DuckDB both read.

The oracle prepends the same texts, so both engines start from equal rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Names of the views each SQL text reads.
SQL = {
    "fac": """
SELECT concat('L', substr(sha1(concat(cast(y AS string), '|', cast(ck AS string))), 1, 15)) AS listing_id,
  concat('A', substr(sha1(concat(cast(y AS string), '#', cast(ck AS string))), 1, 19)) AS source_anchor_id,
  y AS directory_year, y - 1 AS survey_year,
  CASE WHEN ck % 97 = 0 THEN '' ELSE nm END AS name1, CASE WHEN ck % 9 = 0 THEN 'Annex' ELSE '' END AS name2,
  CASE WHEN ck % 89 = 0 THEN '' ELSE concat(cast(ck % 500 AS string), ' Main Street', CASE WHEN ck % 7 = 0 THEN ' Suite 2' ELSE '' END) END AS address1,
  concat('City ', cast(ck % 40 AS string)) AS city,
  CASE nk WHEN 24 THEN 'PR' WHEN 23 THEN 'ZZ' ELSE CASE nk % 3 WHEN 0 THEN 'OR' WHEN 1 THEN 'NY' ELSE 'TX' END END AS state,
  lpad(cast(97000 + ck % 900 AS string), 5, '0') AS zip,
  CASE WHEN ck % 8 = 0 THEN '["weak_address_pattern"]' ELSE '[]' END AS parser_warnings,
  CASE WHEN ck % 17 = 0 THEN '["ZZQ"]' ELSE '[]' END AS unknown_service_tokens,
  cast(1 + floor(ck / 3) AS int) AS source_page, cast(1 + ck % 2 AS int) AS source_column,
  cast(row_number() OVER (PARTITION BY y ORDER BY ck) AS int) AS source_record_order, ck, nk,
  concat(nm, CASE WHEN ck % 50 = 0 THEN repeat(chr(10), 6) ELSE '' END) AS raw_record_text
FROM (SELECT DISTINCT o_custkey AS ck, cast(year(o_orderdate) AS int) AS y, c_name AS nm, c_nationkey AS nk
      FROM orders JOIN customer ON o_custkey = c_custkey) b""",
    "svc": """
SELECT DISTINCT concat('L', substr(sha1(concat(cast(cast(year(o_orderdate) AS int) AS string), '|', cast(o_custkey AS string))), 1, 15)) AS listing_id,
  cast(year(o_orderdate) AS int) AS directory_year, o_custkey AS ck,
  split_part('OP,RES,HI,SA,DT,MH,PVTN,PVTP,LCCG,STG,VAMC,OTP,MU,BU,NU,MD,MC,PI,SF,TELE,SS,CM,HH,TX,ODT', ',', bn) AS code
FROM (SELECT o_orderdate, o_custkey, cast(substr(p_brand, 7) AS int) AS bn
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey) b""",
    "avail": """
SELECT y.directory_year, c.code, concat('Group ', cast(length(c.code) AS string)) AS category,
  concat('Label ', c.code, CASE WHEN y.directory_year % 2 = 0 THEN '' ELSE ' (odd)' END) AS label, (ascii(c.code) + y.directory_year) % 5 <> 0 AS asked
FROM (SELECT DISTINCT directory_year FROM fac) y CROSS JOIN (SELECT DISTINCT code FROM svc) c WHERE (ascii(c.code) * 7 + y.directory_year) % 11 <> 0""",
    "geo": """
SELECT listing_id, CASE WHEN ck % 5 = 0 THEN '' ELSE lpad(cast(41000 + 2 * (ck % 30) + 1 AS string), 5, '0') END AS county_fips,
  CASE WHEN ck % 5 = 0 THEN 'unmatched' WHEN ck % 11 = 0 THEN 'review' ELSE 'high' END AS geocode_confidence, 'census_batch' AS geocode_method,
  cast(ck AS bigint) AS ordinal
FROM fac WHERE ck % 13 <> 0""",
    "crosswalk": """
SELECT lpad(cast(97000 + z AS string), 5, '0') AS zip, concat('410', lpad(cast(z % 50 AS string), 2, '0')) AS county_fips, (z % 7 + 1) / 10.0 AS res_ratio
FROM (SELECT DISTINCT ck % 700 AS z FROM fac) b
UNION ALL
SELECT lpad(cast(97000 + z AS string), 5, '0') AS zip, '41999' AS county_fips, 0.35 AS res_ratio FROM (SELECT DISTINCT ck % 700 AS z FROM fac) b""",
    "raw_county": """
SELECT 1995 + cast(s_suppkey % 7 AS int) AS year, cast(s_nationkey AS string) AS fipstate, cast(cast(floor(s_suppkey / 7) % 12 AS int) AS string) AS fipscty,
  '------' AS naics, '9' AS est, s_suppkey AS source_row FROM supplier
UNION ALL
SELECT 1995 + cast(s_suppkey % 7 AS int), cast(s_nationkey AS string), cast(cast(floor(s_suppkey / 7) % 12 AS int) AS string), ' 621420 ',
  CASE WHEN s_suppkey % 5 = 0 THEN 'N' ELSE cast(s_suppkey % 9 AS string) END, s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL
SELECT 1995 + cast(s_suppkey % 7 AS int), cast(s_nationkey AS string), cast(cast(floor(s_suppkey / 7) % 12 AS int) AS string), '623220', cast(s_suppkey % 4 AS string), s_suppkey
FROM supplier WHERE s_suppkey % 4 <> 0""",
    "reviews": """
SELECT source_anchor_id, directory_year, name1 AS parsed_name1, name2 AS parsed_name2, address1 AS parsed_address1, city AS parsed_city, state AS parsed_state, zip AS parsed_zip,
  'PL OP' AS parsed_service_codes, source_page, source_column, source_record_order,
  CASE WHEN ck % 31 = 0 THEN 'Other Name, LLC' ELSE '' END AS corrected_name1, '' AS corrected_name2, CASE WHEN ck % 37 = 0 THEN '1 Elm St' ELSE '' END AS corrected_address1,
  '' AS corrected_city, '' AS corrected_state, '' AS corrected_zip, CASE WHEN ck % 3 = 0 THEN 'OP; pi' ELSE '' END AS corrected_service_codes,
  CASE WHEN ck % 6 = 0 THEN 'no' ELSE 'Yes' END AS review_complete, CASE WHEN ck % 29 = 0 THEN 'replaced' ELSE '' END AS review_disposition,
  CASE WHEN ck % 40 = 1 THEN 'Uncertain' ELSE 'yes' END AS name_check, 'yes' AS address_check, 'yes' AS services_check, CASE WHEN ck % 200 = 7 THEN 'no' ELSE 'yes' END AS boundary_check,
  split_part('warning_unknown,boundary,random', ',', cast(1 + ck % 3 AS int)) AS sample_stratum, ck
FROM fac WHERE ck % 4 <> 0""",
    "gold_now": """
SELECT source_anchor_id, directory_year, name1, name2, address1, city, state, zip, CASE WHEN ck % 10 = 0 THEN 'OP PI SF' ELSE 'PI OP' END AS service_codes,
  source_page, source_column, source_record_order, listing_id, ck FROM fac WHERE ck % 53 <> 0""",
    "notices": """
SELECT source, cast(1 + floor(doc_id / 20) AS bigint) AS page, cast(1 AS bigint) AS start_page,
  concat(coalesce(text, ''), CASE WHEN doc_id % 97 = 5 THEN ' Public Domain Notice' WHEN doc_id % 89 = 7 THEN ' This may be reproduced' WHEN doc_id % 83 = 11 THEN ' REPRODUCED or copied'
    WHEN doc_id % 79 = 13 THEN ' distributed for a fee' WHEN doc_id % 71 = 2 THEN ' in the public domain' ELSE '' END) AS text
FROM documents""",
}


def needed(text: str) -> list[str]:
    """Views that an SQL text reads, in the order in which they can be made."""
    out: list[str] = []
    for name in SQL:
        if re.search(rf"\b{name}\b", text):
            out += [x for x in [*needed(SQL[name].replace(f" {name} ", " ")), name] if x not in out and x != name or x == name and x not in out]
    return out


class Panel:
    """The derived tables over one folder of Parquet tables."""

    BASE = ("customer", "supplier", "part", "orders", "lineitem", "documents")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._made = spark, folder, {}

    def table(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in SQL:
                text = SQL[name]
                inputs = [x for x in (*self.BASE, *SQL) if x != name and re.search(rf"\b{x}\b", text)]
                # Named arguments keep views out of the session's catalogue.
                for x in inputs:
                    text = re.sub(rf"\b(FROM|JOIN) {x}\b", rf"\1 {{{x}}}", text)
                self._made[name] = self.spark.sql(text, **{x: self.table(x) for x in inputs})
            else:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._made[name]

    __getattr__ = table


def with_views(query: str) -> str:
    """An oracle's SQL with the derived tables it reads in front."""
    names = needed(query)
    body = query.strip()
    made = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    if not made:
        return body
    return f"WITH {made},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {made}\n{body}"
