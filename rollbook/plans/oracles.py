"""DuckDB SQL that each query's rows must equal; derived tables are put in front by ``with_views``."""

KNOWN = "OP RES HI SA DT MH PVTN PVTP LCCG STG VAMC OTP MU BU NU MD MC PI SF TELE SS CM HH TX ODT".split()
STATES = "'CT','ME','MA','NH','RI','VT','NJ','NY','PA','IN','IL','MI','OH','WI','IA','KS','MN','MO','NE','ND','SD','DE','DC','FL','GA','MD','NC','SC','VA','WV','AL','KY','MS','TN','AR','LA','OK','TX','AZ','CO','ID','MT','NV','NM','UT','WY','AK','CA','HI','OR','WA'"
VALID = STATES + ",'PR','GU','VI','AS','MP','FM','PW'"
REGION = "CASE state WHEN 'OR' THEN 'West' WHEN 'NY' THEN 'Northeast' WHEN 'TX' THEN 'South' ELSE 'Territory' END"
DIVISION = "CASE state WHEN 'OR' THEN 'Pacific' WHEN 'NY' THEN 'Middle Atlantic' WHEN 'TX' THEN 'West South Central' ELSE 'Territory' END"
PNW = "CASE WHEN state = 'OR' THEN 'PNW' ELSE 'Not PNW' END"
KEY = lambda x: f"regexp_replace(regexp_replace(upper({x}), '\\b(INC|LLC|LTD|CORP|CORPORATION|CENTER|CENTRE)\\b', ' ', 'g'), '[^A-Z0-9]+', '', 'g')"
AUDIT = lambda x: f"regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g')"
YEARS = "(VALUES (1995, 1996), (1996, 1997), (1997, 1998), (1998, 1999), (1999, 2000), (2000, 2001)) t(earlier, later)"

_EXPECTED = """expected AS (SELECT directory_year, CASE WHEN directory_year % 4 <> 0 THEN count(*) - directory_year % 7 END AS expected_listings,
  CASE WHEN directory_year % 3 = 0 THEN 'no' ELSE 'yes' END AS acceptance_reference FROM fac GROUP BY directory_year)"""
_ANNUAL = f"""base AS (SELECT directory_year, min(survey_year) AS survey_year, count(*) AS rows, count(DISTINCT state) AS states,
  avg((name1 = '')::int) AS missing_name_share, avg((address1 = '')::int) AS missing_address_share, avg((state NOT IN ({VALID}))::int) AS invalid_state_share,
  0.0::double AS header_noise_share, avg((parser_warnings LIKE '%weak_address_pattern%')::int) AS weak_address_share FROM fac GROUP BY directory_year),
served AS (SELECT directory_year, count(DISTINCT listing_id) AS served FROM svc GROUP BY directory_year),
annual AS (SELECT base.*, coalesce(served, 0) / rows AS service_record_share, rows / lag(rows) OVER (ORDER BY directory_year) - 1 AS row_change
  FROM base LEFT JOIN served USING (directory_year))"""
_LABEL = """done AS (SELECT directory_year, count(*) AS n FROM reviews WHERE lower(review_complete) = 'yes' GROUP BY 1),
labelled AS (SELECT fac.*, CASE WHEN directory_year >= 2000 THEN 'official_xlsx' ELSE 'historical_pdf' END AS source_format, parser_warnings <> '[]' AS has_parser_warning,
  coalesce(n, 0) AS reviewed, CASE WHEN directory_year >= 2000 THEN 0 WHEN directory_year = 1998 THEN 100 ELSE 50 END AS target,
  CASE WHEN directory_year >= 2000 THEN 'official_xlsx_checks_passed' WHEN coalesce(n, 0) > 0 THEN 'partial_review' ELSE 'not_reviewed' END AS year_qa_status
  FROM fac LEFT JOIN done USING (directory_year))"""
_XLSX = """wb AS (SELECT listing_id, directory_year, state, concat('OP  * ', CASE WHEN ck % 3 = 0 THEN 'RES OP ' ELSE '' END, CASE WHEN ck % 19 = 0 THEN 'QQQ' ELSE 'SA' END) AS info FROM fac),
tok AS (SELECT listing_id, directory_year, state, unnest(list_filter(string_split_regex(trim(info), '\\s+'), lambda x: x <> '*' AND x <> '')) AS code,
  unnest(range(len(list_filter(string_split_regex(trim(info), '\\s+'), lambda x: x <> '*' AND x <> '')))) AS i FROM wb),
tok1 AS (SELECT listing_id, directory_year, code, row_number() OVER (PARTITION BY listing_id ORDER BY min(i)) - 1 AS position FROM tok GROUP BY 1, 2, 3),
cb AS (SELECT code, category, label FROM avail WHERE directory_year = 1996),
xs AS (SELECT tok1.*, category, label FROM tok1 JOIN cb USING (code))"""
_COUNTS = """g AS (SELECT listing_id, CASE WHEN county_fips <> '' THEN concat(lpad((ordinal % 25)::varchar, 2, '0'), lpad((ordinal % 12)::varchar, 3, '0')) END AS county FROM geo),
counts AS (SELECT county AS county_fips, substr(county, 1, 2) AS state_fips, survey_year AS year, count(*) AS listing_count
  FROM fac JOIN g USING (listing_id) WHERE regexp_full_match(county, '\\d{5}') GROUP BY 1, 2, 3)"""
_CELLS = """rw AS (SELECT year, lpad(fipstate, 2, '0') AS state_fips, lpad(fipstate, 2, '0') || lpad(fipscty, 3, '0') AS county_fips, trim(naics) AS naics, try_cast(est AS double) AS est, source_row FROM raw_county),
universe AS (SELECT DISTINCT year, county_fips, state_fips FROM rw WHERE naics = '------'),
first AS (SELECT * FROM rw WHERE naics <> '------' QUALIFY row_number() OVER (PARTITION BY year, county_fips, naics ORDER BY source_row) = 1),
cells AS (SELECT u.county_fips, u.state_fips, u.year, n.naics,
  CASE WHEN u.year < 1998 THEN coalesce(est, 0) ELSE est END AS establishments,
  CASE WHEN est IS NOT NULL THEN 'published' WHEN u.year < 1998 THEN 'zero' ELSE 'omitted_or_zero' END AS publication_status
  FROM universe u CROSS JOIN (VALUES ('621420'), ('623220')) n(naics) LEFT JOIN first f ON f.year = u.year AND f.county_fips = u.county_fips AND f.naics = n.naics)"""
_COMPARED = f"""{_COUNTS}, {_CELLS},
own AS (SELECT *, establishments IS NOT NULL AS pub FROM cells WHERE year IN (SELECT year FROM counts)),
ext AS (SELECT county_fips, state_fips, year, CASE WHEN count(*) FILTER (pub) = 2 THEN sum(establishments) END AS external_count,
  CASE WHEN count(*) FILTER (pub) = 2 THEN 'published' ELSE 'partially_or_fully_omitted' END AS publication_status,
  sum(CASE WHEN pub THEN establishments ELSE 0 END) AS lower_bound, sum(CASE WHEN pub THEN establishments WHEN year < 1998 THEN 0 ELSE 2 END) AS upper_bound,
  count(*) FILTER (pub) / 2 AS cell_coverage_rate, count(*) FILTER (pub) = 2 AS common_support FROM own GROUP BY 1, 2, 3),
compared AS (SELECT coalesce(c.county_fips, e.county_fips) AS county_fips, coalesce(c.state_fips, e.state_fips) AS state_fips, coalesce(c.year, e.year) AS year,
  coalesce(listing_count, 0) AS listing_count, external_count, publication_status, lower_bound, upper_bound, cell_coverage_rate, common_support, coalesce(c.year, e.year) >= 1998 AS reporting_break
  FROM counts c FULL JOIN ext e ON c.county_fips IS NOT DISTINCT FROM e.county_fips AND c.state_fips IS NOT DISTINCT FROM e.state_fips AND c.year IS NOT DISTINCT FROM e.year)"""
_CODES = "codes AS (SELECT listing_id, string_agg(DISTINCT code, ' ' ORDER BY code) AS service_codes FROM svc GROUP BY 1)"
_HEAD = f"head AS (SELECT * FROM fac WHERE state IN ({STATES}))"
_KEYS = f"""keys AS (SELECT listing_id, directory_year, state,
  CASE WHEN {AUDIT('name1')} = '' OR {AUDIT('address1')} = '' OR {AUDIT('state')} = '' THEN '' ELSE concat_ws('|', {AUDIT('name1')}, {AUDIT('address1')}, {AUDIT('city')}, {AUDIT('state')}) END AS strict_key,
  CASE WHEN {AUDIT('name1')} = '' OR {AUDIT('zip')} = '' OR {AUDIT('state')} = '' THEN '' ELSE concat_ws('|', {AUDIT('name1')}, substr({AUDIT('zip')}, 1, 5), {AUDIT('state')}) END AS name_zip_key FROM fac)"""
_TRANS = f"""n AS (SELECT directory_year, state, count(*) AS n FROM head GROUP BY 1, 2),
st AS (SELECT earlier, later, state, coalesce(sum(n) FILTER (directory_year = earlier), 0)::bigint AS earlier_count, coalesce(sum(n) FILTER (directory_year = later), 0)::bigint AS later_count
  FROM n JOIN {YEARS} ON directory_year IN (earlier, later) GROUP BY 1, 2, 3)"""
_RATE = lambda key, a, b: f"""(SELECT avg((k.{key} IN (SELECT {key} FROM keys o WHERE o.directory_year = t.{b} AND o.state IN ({STATES})))::int)
  FROM keys k WHERE k.directory_year = t.{a} AND k.state IN ({STATES}) AND k.{key} <> '')"""  # noqa: E731
_GOLD = f"""gold AS (SELECT listing_id, CASE WHEN ck % 25 = 0 THEN '9 Elm' ELSE upper(address1) END AS address1_gold, ['OP', 'PI'] AS codes_gold, ck FROM fac WHERE ck % 2 = 0),
simple AS (SELECT count(*) > 0 AS completed, count(*) AS rows, avg(({KEY("address1_gold")} = {KEY("coalesce(n.address1, '')")})::int) AS address_accuracy,
  avg(coalesce(list_sort(string_split(n.service_codes, ' ')) = codes_gold, false)::int) AS service_accuracy FROM gold g LEFT JOIN gold_now n USING (listing_id))"""
_EVAL = f"""ev AS (SELECT r.*, n.source_anchor_id IS NOT NULL AS anchor_matched,
  {KEY("CASE WHEN corrected_name1 <> '' THEN corrected_name1 ELSE concat_ws(' ', nullif(parsed_name1, ''), nullif(parsed_name2, '')) END")} = {KEY("concat(coalesce(n.name1, ''), ' ', coalesce(n.name2, ''))")} AS name_accurate,
  {KEY("concat_ws('|', coalesce(nullif(corrected_address1, ''), parsed_address1), parsed_city, parsed_state, parsed_zip)")} = {KEY("concat_ws('|', coalesce(n.address1, ''), coalesce(n.city, ''), coalesce(n.state, ''), coalesce(n.zip, ''))")} AS address_accurate,
  coalesce(list_sort(string_split(n.service_codes, ' ')) = ['OP', 'PI'], false) AS service_accurate
  FROM reviews r LEFT JOIN gold_now n USING (source_anchor_id) WHERE lower(review_complete) = 'yes' AND review_disposition = '')"""
_LINE = """ln AS (SELECT listing_id, city, state, zip, ck, ck % 4 AS third FROM fac)"""
_METRICS = f"""{_EVAL}, e AS (SELECT directory_year, sample_stratum, count(*) AS n FROM ev WHERE NOT (name_accurate AND address_accurate AND service_accurate) GROUP BY 1, 2), x AS (SELECT directory_year, max(n) / sum(n) AS worst FROM e GROUP BY 1),
m AS (SELECT directory_year, count(*) AS n, avg(name_accurate::int) AS na, avg(address_accurate::int) AS aa, avg(service_accurate::int) AS sa, avg((lower(name_check) = 'uncertain')::int) AS u, sum((NOT anchor_matched)::int)::bigint AS un, sum((boundary_check = 'no')::int)::bigint AS be FROM ev GROUP BY 1),
j AS (SELECT m.*, coalesce(worst, 0) AS worst, CASE WHEN directory_year IN (1998, 2000, 2001) THEN 0.95 ELSE 0.98 END::double AS target FROM m LEFT JOIN x USING (directory_year)),
k AS (SELECT *, least(na, aa, sa) >= target AND u <= 0.05 AND un = 0 AND be = 0 AS pass FROM j)"""
_FEATURES = f"""{_CODES}, f AS (SELECT fac.*, CASE WHEN service_codes IS NULL THEN [] ELSE string_split(service_codes, ' ') END AS c FROM fac LEFT JOIN codes USING (listing_id)),
pg AS (SELECT directory_year, source_page, dense_rank() OVER (PARTITION BY directory_year ORDER BY source_page) AS r FROM fac), pq AS (SELECT directory_year, source_page, any_value(r) AS r, max(any_value(r)) OVER (PARTITION BY directory_year) AS n FROM pg GROUP BY 1, 2),
fr AS (SELECT directory_year, code FROM svc GROUP BY 1, 2 HAVING count(DISTINCT listing_id) <= 10), ra AS (SELECT directory_year, list(code) AS rare FROM fr GROUP BY 1), de AS (SELECT directory_year, greatest(quantile_cont(len(c), 0.9), 1) AS p90 FROM f GROUP BY 1),
w AS (SELECT f.*, min(source_record_order) OVER (PARTITION BY directory_year, source_page, source_column) AS lo, max(source_record_order) OVER (PARTITION BY directory_year, source_page, source_column) AS hi, count(*) OVER (PARTITION BY directory_year, state, city, address1) AS twins FROM f),
feat AS (SELECT w.*, least((r * 5 + n - 1) // n, 5)::bigint AS page_quantile, parser_warnings <> '[]' OR unknown_service_tokens <> '[]' AS has_warning_unknown, source_record_order IN (lo, hi) AS is_boundary,
    coalesce(list_has_any(c, rare), false) OR len(c) >= p90 AS is_rare_dense, ck % 50 = 0 OR name2 <> '' OR regexp_matches(address1, '\\bSuite\\b') OR twins > 1 AS is_complex
  FROM w JOIN pq USING (directory_year, source_page) JOIN de USING (directory_year) LEFT JOIN ra USING (directory_year))"""


def _sampled(size: int, seed: int) -> str:
    """CTEs up to ``sampled``: ``size`` rows a year by stratum, each going round its groups."""
    group = "directory_year, page_quantile, source_column, census_region, state"
    digest = f"sha1(concat_ws('|', '{seed}', page_quantile::varchar, source_column::varchar, coalesce(census_region, ''), coalesce(state, '')))"
    quota = {name: round(size * share) for name, share in (("warning_unknown", 0.2), ("boundary", 0.1), ("rare_dense", 0.1), ("complex", 0.1))}
    parts = [f"{_FEATURES}, pool AS (SELECT *, {REGION} AS census_region, sha1(concat_ws('|', '{seed}', directory_year::varchar, source_anchor_id)) AS h FROM feat)"]
    before = "SELECT source_anchor_id, directory_year FROM pool WHERE false"
    for stage, (stratum, limit) in enumerate([*((k, str(n)) for k, n in quota.items()), ("random", f"{size} - (SELECT count(*) FROM ({{before}}) x WHERE x.directory_year = t.directory_year)")]):
        flag = "true" if stratum == "random" else f"is_{stratum}" if stratum != "warning_unknown" else "has_warning_unknown"
        parts.append(f"turn{stage} AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY h) AS turn FROM pool WHERE {flag} AND source_anchor_id NOT IN (SELECT source_anchor_id FROM ({before})))")
        parts.append(f"place{stage} AS (SELECT *, row_number() OVER (PARTITION BY directory_year ORDER BY turn, {digest}, h) AS place FROM turn{stage} WHERE turn <= {size})")
        parts.append(f"own{stage} AS (SELECT * FROM place{stage} t WHERE place <= {limit.format(before=before)})")
        before = " UNION ALL ".join(f"SELECT source_anchor_id, directory_year FROM own{i}" for i in range(stage + 1))
    names = ("warning_unknown", "boundary", "rare_dense_services", "complex_record", "random")
    return ", ".join([*parts, "sampled AS (" + " UNION ALL ".join(f"SELECT *, '{x}' AS sample_stratum FROM own{i}" for i, x in enumerate(names)) + ")"])


ORACLE_TEXTS = {
    "qa_by_year": f"WITH {_ANNUAL} SELECT directory_year::bigint AS directory_year, survey_year::bigint AS survey_year, rows, states, round(missing_name_share, 9) AS missing_name_share, round(missing_address_share, 9) AS missing_address_share, round(invalid_state_share, 9) AS invalid_state_share, header_noise_share, round(weak_address_share, 9) AS weak_address_share, round(service_record_share, 9) AS service_record_share, round(row_change, 9) AS row_change, coalesce(abs(row_change) > 0.25, false) AS large_discontinuity FROM annual",
    "qa_prelim": f"WITH {_LABEL} SELECT directory_year::bigint AS directory_year, survey_year::bigint AS survey_year, count(*) AS facility_count, sum(has_parser_warning::int)::bigint AS warning_count, max(reviewed) AS reviewed_listings, max(target)::bigint AS gold_target, max(year_qa_status) AS qa_status, round(avg(has_parser_warning::int), 9) AS warning_share FROM labelled GROUP BY 1, 2",
    "source_format_fill": f"WITH {_LABEL} SELECT listing_id, source_format, has_parser_warning, target::bigint AS gold_target_in_year, year_qa_status FROM labelled",
    "structural_metrics": f"""WITH {_EXPECTED}, m AS (SELECT directory_year, count(*) AS facility_rows, count(DISTINCT state) AS state_count, string_agg(DISTINCT state, '|' ORDER BY state) AS states,
  sum((state NOT IN ({VALID}))::int)::bigint AS invalid_state_records, 0::bigint AS header_records, sum((parser_warnings <> '[]')::int)::bigint AS warning_records,
  avg((name1 = '')::int) AS missing_name_share, avg((address1 = '')::int) AS missing_address_share, avg((parser_warnings LIKE '%weak%')::int) AS weak_address_share,
  min(source_page)::bigint AS first_page_with_record, max(source_page)::bigint AS last_page_with_record, count(DISTINCT source_page) AS pages_with_records FROM fac GROUP BY 1),
s AS (SELECT directory_year, count(*) AS service_rows, count(DISTINCT listing_id) AS service_listings FROM svc GROUP BY 1), a AS (SELECT directory_year, count(*) AS availability_rows FROM avail GROUP BY 1),
j AS (SELECT m.*, coalesce(service_rows, 0) AS service_rows, coalesce(service_listings, 0) AS service_listings, coalesce(availability_rows, 0) AS availability_rows, expected_listings,
  CASE WHEN directory_year % 2 = 0 THEN 'early_ocr' ELSE 'two_column' END AS layout_profile, CASE WHEN directory_year % 5 <> 0 THEN 390 + directory_year % 5 * 5 >= 400 END AS page_coverage_complete,
  coalesce(service_listings, 0) / facility_rows AS service_coverage, abs(facility_rows - expected_listings) / expected_listings AS count_difference_share
  FROM m LEFT JOIN s USING (directory_year) LEFT JOIN a USING (directory_year) LEFT JOIN expected USING (directory_year)),
r AS (SELECT *, list_filter([CASE WHEN invalid_state_records > 0 THEN concat(invalid_state_records, ' malformed state records') END, CASE WHEN facility_rows NOT BETWEEN 1000 AND 30000 THEN concat('implausible listing count: ', facility_rows) END,
  CASE WHEN service_listings = 0 THEN 'empty service extraction' WHEN layout_profile = 'early_ocr' AND service_coverage < 0.6 THEN format('service coverage {{:.1f}}% is below 60%', service_coverage * 100) WHEN layout_profile <> 'early_ocr' AND service_coverage < 0.8 THEN format('service coverage {{:.1f}}% is below 80%', service_coverage * 100) END,
  CASE WHEN availability_rows = 0 THEN 'empty service availability' END, CASE WHEN NOT page_coverage_complete THEN 'PDF ends before the configured final page' END,
  CASE WHEN missing_name_share > 0.05 THEN format('missing facility-name share is {{:.1f}}%', missing_name_share * 100) END, CASE WHEN missing_address_share > 0.01 THEN format('missing address share is {{:.1f}}%', missing_address_share * 100) END,
  CASE WHEN weak_address_share > 0.25 THEN format('weak-address warning share is {{:.1f}}%', weak_address_share * 100) END, CASE WHEN count_difference_share > 0.35 THEN format('listing count differs from comparison fixture by {{:.1f}}%', count_difference_share * 100) END], lambda x: x IS NOT NULL) AS reasons FROM j)
SELECT directory_year::bigint AS directory_year, facility_rows, state_count, states, invalid_state_records, header_records, warning_records, round(missing_name_share, 9) AS missing_name_share, round(missing_address_share, 9) AS missing_address_share,
  round(weak_address_share, 9) AS weak_address_share, first_page_with_record, last_page_with_record, pages_with_records, service_rows, service_listings, availability_rows, expected_listings, layout_profile, page_coverage_complete, round(service_coverage, 9) AS service_coverage,
  round(count_difference_share, 9) AS count_difference_share, array_to_string(reasons, '; ') AS blocking_reasons, len(reasons) = 0 AS structural_pass FROM r""",
    "count_reference": f"WITH {_EXPECTED}, n AS (SELECT directory_year, count(*) AS rows FROM fac GROUP BY 1) SELECT directory_year::bigint AS directory_year, rows, expected_listings, acceptance_reference, round(abs(rows - expected_listings) / expected_listings, 9) AS count_difference_share, coalesce(abs(rows - expected_listings) / expected_listings <= 0.02, false) AS count_within_2pct FROM n LEFT JOIN expected USING (directory_year)",
    "geocode_share": "SELECT round(avg((county_fips <> '')::int), 9) AS assigned_share, round(avg((geocode_confidence = 'high')::int), 9) AS high_share FROM geo",
    "qa_gates": f"""WITH {_EXPECTED}, {_ANNUAL}, {_GOLD},
gates AS (SELECT bool_and(invalid_state_share = 0 AND header_noise_share = 0 AND coalesce(abs(row_change) <= 0.25, true)) AS structural_pass,
  bool_and(acceptance_reference = 'yes' AND expected_listings IS NOT NULL AND coalesce(abs(rows - expected_listings) / expected_listings <= 0.02, false)) AS count_reference_pass FROM annual LEFT JOIN expected USING (directory_year)),
g AS (SELECT gates.*, 0.98::double AS gold_target, address_accuracy >= 0.98 AND service_accuracy >= 0.98 AS gold_pass, (SELECT avg((geocode_confidence = 'high')::int) FROM geo) AS high FROM gates, simple)
SELECT structural_pass, count_reference_pass, gold_target, gold_pass, round(high, 9) AS high_share, high >= 0.9 AS geocoding_pass, true AS linkage_pass,
  array_to_string(list_filter([CASE WHEN NOT structural_pass THEN 'structural parser QA failed' END, CASE WHEN NOT count_reference_pass THEN 'independent annual count references are incomplete or outside 2%' END,
  CASE WHEN NOT gold_pass THEN 'manual gold sample is incomplete or below target' END, CASE WHEN NOT high >= 0.9 THEN 'high-confidence county assignment is below 90% or absent' END], lambda x: x IS NOT NULL), '; ') AS blocking_reasons,
  structural_pass AND count_reference_pass AND gold_pass AND high >= 0.9 AS release_ready FROM g""",
    "unknown_tokens": "SELECT directory_year::bigint AS directory_year, string_agg(DISTINCT token, '|' ORDER BY token) AS tokens FROM (SELECT directory_year, unnest(CASE WHEN ck % 23 = 0 THEN ['not a list'] WHEN ck % 19 = 0 THEN ['A1', 'B2'] WHEN ck % 17 = 0 THEN ['ZZQ'] ELSE [] END) AS token FROM fac) b GROUP BY 1",
    "rights_audit": """
SELECT source, bool_or(contains(u, 'PUBLIC DOMAIN NOTICE')) AS public_domain_notice, bool_or(regexp_matches(u, 'MAY BE REPRODUCED|REPRODUCED OR COPIED')) AS reproduction_permission,
  bool_or(contains(u, 'DISTRIBUTED FOR A FEE')) AS fee_restriction_found, min(page) FILTER (contains(u, 'PUBLIC DOMAIN')) AS notice_pdf_page,
  public_domain_notice AND reproduction_permission AS archive_eligible, NOT (public_domain_notice AND reproduction_permission) AS manual_review_required
FROM (SELECT source, page, upper(text) AS u FROM notices) b GROUP BY 1""",
    "xlsx_services": f"WITH {_XLSX} SELECT code, listing_id, directory_year::bigint AS directory_year, position, category, label FROM xs",
    "xlsx_metrics": f"""WITH {_EXPECTED}, {_XLSX}, f AS (SELECT directory_year, count(*) AS facility_rows, sum((state NOT IN ({VALID}))::int)::bigint AS invalid_state_records FROM wb GROUP BY 1),
s AS (SELECT directory_year, count(DISTINCT listing_id) AS served FROM xs GROUP BY 1), u AS (SELECT directory_year, count(DISTINCT code) AS unknown FROM tok WHERE code NOT IN (SELECT code FROM cb) GROUP BY 1)
SELECT directory_year::bigint AS directory_year, facility_rows, invalid_state_records, coalesce(unknown, 0) AS unknown_token_count, expected_listings, acceptance_reference AS x, round(coalesce(served, 0) / facility_rows, 9) AS service_coverage,
  coalesce(invalid_state_records = 0 AND coalesce(unknown, 0) = 0 AND facility_rows = expected_listings AND coalesce(served, 0) / facility_rows >= 0.99, false) AS structural_pass
FROM f LEFT JOIN s USING (directory_year) LEFT JOIN u USING (directory_year) LEFT JOIN expected USING (directory_year)""".replace(" acceptance_reference AS x,", ""),
    "service_status": """WITH ref AS (SELECT code, category, label FROM avail QUALIFY row_number() OVER (PARTITION BY code ORDER BY asked DESC, directory_year DESC, category, label) = 1),
o AS (SELECT DISTINCT listing_id, code, true AS offered FROM svc), a AS (SELECT DISTINCT directory_year, code, true AS was FROM avail WHERE asked)
SELECT f.listing_id, f.directory_year::bigint AS directory_year, f.survey_year::bigint AS survey_year, r.code, r.category, r.label, CASE WHEN offered THEN 'offered' WHEN was THEN 'not_offered' ELSE 'not_asked' END AS status
FROM fac f CROSS JOIN ref r LEFT JOIN a ON a.directory_year = f.directory_year AND a.code = r.code LEFT JOIN o ON o.listing_id = f.listing_id AND o.code = r.code""",
    "service_codes_agg": f"WITH {_CODES} SELECT * FROM codes",
    "code_frequency": "SELECT directory_year::bigint AS directory_year, code, count(DISTINCT listing_id) AS listings FROM svc GROUP BY 1, 2",
    "availability_backfill": "WITH a AS (SELECT directory_year, code FROM avail WHERE asked) SELECT directory_year::bigint AS directory_year, code, true AS asked, 'pdf_legend' AS source FROM a UNION ALL SELECT DISTINCT directory_year::bigint, code, true, 'observed_listing_fallback' FROM svc WHERE (directory_year, code) NOT IN (SELECT (directory_year, code) FROM a)",
    "codebook_build": """WITH base AS (SELECT directory_year, code, label, ascii(code) * 26 + length(code) AS line_no FROM avail),
lg AS (SELECT directory_year, line_no - 1 AS line_no, concat('Heading ', substr(any_value(code), 1, 1)) AS heading, NULL AS code, NULL AS label FROM base WHERE ascii(code) % 5 = 0 GROUP BY 1, 2
  UNION ALL SELECT directory_year, line_no, NULL, code, label FROM base WHERE code IN ('OP', 'SA', 'HI', 'PI', 'TELE', 'NU')),
ca AS (SELECT *, coalesce(last_value(heading IGNORE NULLS) OVER (PARTITION BY directory_year ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'Unclassified') AS category FROM lg),
core(code, cat, lab) AS (VALUES ('OP', 'Service Settings', 'Outpatient'), ('RES', 'Service Settings', 'Residential'), ('XA', 'Unclassified', '')),
li AS (SELECT directory_year, ca.code, coalesce(cat, category) AS category, coalesce(lab, label) AS label FROM ca LEFT JOIN core USING (code) WHERE ca.code IS NOT NULL)
SELECT directory_year::bigint AS directory_year, code, category, label, true AS asked, 'pdf_legend' AS source FROM li
UNION ALL SELECT y.directory_year::bigint, core.code, cat, lab, false, 'fallback_dictionary' FROM (SELECT DISTINCT directory_year FROM lg) y CROSS JOIN core
WHERE NOT EXISTS (SELECT 1 FROM li WHERE li.directory_year = y.directory_year AND li.code = core.code)""",
    "county_counts": f"WITH {_COUNTS} SELECT county_fips, state_fips, year::bigint AS year, listing_count FROM counts",
    "cbp_cells": f"WITH {_CELLS} SELECT county_fips, state_fips, year::bigint AS year, naics, establishments, publication_status FROM cells",
    "cbp_comparison": f"WITH {_COMPARED} SELECT county_fips, state_fips, year::bigint AS year, listing_count, external_count, publication_status, lower_bound::double AS lower_bound, upper_bound::double AS upper_bound, cell_coverage_rate, common_support, reporting_break FROM compared",
    "cbp_summary": f"WITH {_COMPARED} SELECT year::bigint AS year, sum(listing_count)::bigint AS listing_count, sum(external_count) AS published_count, sum(lower_bound)::double AS lower_bound, sum(upper_bound)::double AS upper_bound, coalesce(sum(common_support::int), 0)::bigint AS published_counties, count(publication_status) AS compared_counties, round(sum(common_support::int) / nullif(count(publication_status), 0), 9) AS county_coverage_rate, year >= 1998 AS reporting_break FROM compared GROUP BY year",
    "audit_keys": f"WITH {_KEYS} SELECT listing_id, strict_key, name_zip_key FROM keys",
    "year_summary": f"""WITH {_CODES}, {_HEAD}, f AS (SELECT head.*, string_split(service_codes, ' ') AS c FROM head LEFT JOIN codes USING (listing_id)),
al AS (SELECT directory_year, count(*) AS all_listings FROM fac GROUP BY 1), b AS (SELECT *, coalesce(len(c), 0) AS k FROM f),
m AS (SELECT directory_year, min(survey_year) AS survey_year, count(*) AS n, avg((name1 = '')::int) AS mn, avg((address1 = '')::int) AS ma, avg((zip = '')::int) AS mz, avg((parser_warnings <> '[]')::int) AS w, avg(k) AS mean, median(k) AS med,
  avg(coalesce(list_contains(c, 'PVTN'), false)::int) AS np, avg(coalesce(list_contains(c, 'PVTP'), false)::int) AS fp, avg(coalesce(list_has_any(c, ['LCCG', 'STG', 'VAMC']), false)::int) AS gov,
  avg(coalesce(list_contains(c, 'OTP'), false)::int) AS otp, avg(coalesce(list_contains(c, 'OP'), false)::int) AS op, avg(coalesce(list_contains(c, 'RES'), false)::int) AS res, avg(coalesce(list_contains(c, 'HI'), false)::int) AS hi,
  avg(coalesce(list_contains(c, 'MD'), false)::int) AS md, avg(coalesce(list_contains(c, 'MC'), false)::int) AS mc, avg(coalesce(list_contains(c, 'PI'), false)::int) AS pi FROM b GROUP BY 1)
SELECT directory_year::bigint AS directory_year, survey_year::bigint AS survey_year, all_listings, n AS headline_us_listings, all_listings - n AS territory_listings, round(mn, 9) AS missing_name_share, round(ma, 9) AS missing_address_share, round(mz, 9) AS missing_zip_share,
  round(w, 9) AS warning_share, round(mean, 9) AS mean_service_codes, round(med, 9) AS median_service_codes, round(np, 9) AS nonprofit_share, round(fp, 9) AS forprofit_share, round(gov, 9) AS government_share, round(otp, 9) AS otp_share, round(op, 9) AS outpatient_share,
  round(res, 9) AS residential_share, round(hi, 9) AS hospital_share, round(md, 9) AS medicaid_share, round(mc, 9) AS medicare_share, round(pi, 9) AS private_insurance_share FROM m JOIN al USING (directory_year)""",
    "state_transitions": f"WITH {_HEAD}, {_TRANS} SELECT earlier::bigint AS earlier, later::bigint AS later, state, earlier_count, later_count, later_count - earlier_count AS count_change, round((later_count - earlier_count) / nullif(earlier_count, 0), 9) AS percent_change, concat(earlier, '_to_', later) AS transition FROM st",
    "transition_summary": f"""WITH {_HEAD}, {_KEYS}, {_TRANS}, s AS (SELECT earlier, later, sum(earlier_count)::bigint AS earlier_count, sum(later_count)::bigint AS later_count, corr(earlier_count, later_count) AS c, median((later_count - earlier_count) / nullif(earlier_count, 0)) AS med FROM st GROUP BY 1, 2)
SELECT t.earlier::bigint AS earlier, t.later::bigint AS later, concat(t.earlier, '_to_', t.later) AS transition, earlier_count, later_count, round(c, 9) AS state_count_correlation, round(med, 9) AS median_state_percent_change, round(later_count / earlier_count - 1, 9) AS national_percent_change,
  round({_RATE('strict_key', 'later', 'earlier')}, 9) AS later_strict_match_share, round({_RATE('strict_key', 'earlier', 'later')}, 9) AS earlier_strict_match_share,
  round({_RATE('name_zip_key', 'later', 'earlier')}, 9) AS later_name_zip_match_share, round({_RATE('name_zip_key', 'earlier', 'later')}, 9) AS earlier_name_zip_match_share FROM s t""",
    "overview": f"""WITH {_HEAD}, {_CODES}, f AS (SELECT head.*, coalesce(list_contains(string_split(service_codes, ' '), 'MD'), false)::int AS md, coalesce(list_contains(string_split(service_codes, ' '), 'TELE'), false)::int AS te, {REGION} AS region, {DIVISION} AS division, {PNW} AS pnw FROM head LEFT JOIN codes USING (listing_id)),
u AS (SELECT 'us' AS scope_type, 'United States' AS scope, * FROM f UNION ALL SELECT 'region', region, * FROM f UNION ALL SELECT 'division', division, * FROM f UNION ALL SELECT 'pnw', pnw, * FROM f)
SELECT scope_type, scope, directory_year::bigint AS directory_year, count(*) AS listings, sum(md)::bigint AS accepting_medicaid, sum(te)::bigint AS offering_telehealth FROM u GROUP BY 1, 2, 3""",
    "map_extract": f"WITH {_CODES} SELECT listing_id, directory_year::bigint AS directory_year, name1, state, zip, coalesce(service_codes, '') AS service_codes FROM fac LEFT JOIN codes USING (listing_id) WHERE directory_year = 1996",
    "zip_fallback": """WITH best AS (SELECT zip, county_fips AS fallback FROM crosswalk QUALIFY row_number() OVER (PARTITION BY zip ORDER BY res_ratio DESC, county_fips) = 1),
f AS (SELECT listing_id, zip, fallback FROM fac LEFT JOIN best USING (zip)), j AS (SELECT coalesce(g.listing_id, f.listing_id) AS listing_id, g.county_fips AS own, coalesce(g.county_fips, '') = '' AS missing, geocode_confidence, geocode_method, zip, fallback FROM geo g FULL JOIN f ON g.listing_id = f.listing_id)
SELECT listing_id, CASE WHEN missing THEN fallback ELSE own END AS county_fips, CASE WHEN missing AND fallback IS NOT NULL THEN 'low' ELSE geocode_confidence END AS geocode_confidence, CASE WHEN missing AND fallback IS NOT NULL THEN 'zip_crosswalk' ELSE geocode_method END AS geocode_method, zip FROM j""",
    "geo_attach": "SELECT listing_id, state, county_fips, geocode_confidence FROM fac LEFT JOIN geo USING (listing_id)",
    "link_attach": "SELECT listing_id, state, CASE WHEN ck % 3 <> 0 THEN concat('F', substr(sha1(ck::varchar), 1, 14)) END AS facility_id FROM fac",
    "dedupe_last": "SELECT zip, max(listing_id) AS listing_id FROM fac GROUP BY 1",
    "geocode_parse": """SELECT listing_id, CASE ck % 4 WHEN 0 THEN concat('41', lpad((ck % 50)::varchar, 3, '0')) ELSE '' END AS county_fips, round(CASE WHEN ck % 4 = 0 THEN concat('45.', ck::varchar)::double END, 9) AS latitude,
  round(CASE WHEN ck % 4 = 0 THEN concat('-123.', ck::varchar)::double END, 9) AS longitude, 'census_batch' AS geocode_method, CASE ck % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'unmatched' ELSE 'review' END AS geocode_confidence FROM fac""",
    "json_geoid": "SELECT listing_id, CASE WHEN ck % 2 = 0 THEN zip ELSE '' END AS county_fips FROM fac",
    "anti_pending": "SELECT listing_id FROM fac WHERE listing_id NOT IN (SELECT listing_id FROM geo)",
    "semi_filter": "SELECT listing_id FROM fac WHERE listing_id IN (SELECT listing_id FROM geo WHERE geocode_confidence = 'high')",
    "anti_codes": "SELECT directory_year::bigint AS directory_year, code FROM svc EXCEPT SELECT directory_year, code FROM avail WHERE asked",
    "batch_chunks": "SELECT i // 10 AS batch, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY listing_id) - 1 AS i FROM fac) b GROUP BY 1",
    "geocode_step": "SELECT listing_id, coalesce(county_fips, concat('41', substr(zip, 3))) AS county_fips, true AS bounded FROM fac LEFT JOIN geo USING (listing_id)",
    "parquet_union": "SELECT listing_id, directory_year::bigint AS directory_year, CASE WHEN directory_year < 1998 THEN name1 END AS name1, CASE WHEN directory_year >= 1998 THEN 'workbook' END AS source_file FROM fac",
    "fips": "SELECT listing_id, CASE WHEN length(ck::varchar) >= 3 THEN ck::varchar ELSE lpad(ck::varchar, 3, '0') END AS county, lpad(nk::varchar, 2, '0') AS state_code FROM fac",
    "sampling_features": f"WITH {_FEATURES} SELECT listing_id, page_quantile, has_warning_unknown, is_boundary, is_rare_dense, is_complex FROM feat",
    "quota_counts": "WITH n AS (SELECT directory_year, count(*) AS n FROM fac GROUP BY 1), q AS (SELECT directory_year, n, round_even(n * 0.2, 0)::bigint AS a, round_even(n * 0.1, 0)::bigint AS b FROM n) SELECT directory_year::bigint AS directory_year, a AS warning_unknown, b AS boundary, b AS rare_dense_services, b AS complex_record, n - a - 3 * b AS random FROM q",
    "gold_simple": f"WITH {_GOLD} SELECT completed, rows, round(address_accuracy, 9) AS address_accuracy, round(service_accuracy, 9) AS service_accuracy FROM simple",
    "gold_eval": f"WITH {_EVAL} SELECT source_anchor_id, anchor_matched, name_accurate, address_accurate, service_accurate FROM ev",
    "gold_metrics": f"""WITH {_METRICS}
SELECT directory_year::bigint AS directory_year, n AS reviewed_rows, round(na, 9) AS name_accuracy, round(aa, 9) AS address_accuracy, round(sa, 9) AS service_accuracy, round(u, 9) AS uncertain_share, un AS unmatched_anchors, be AS boundary_errors, round(worst, 9) AS largest_error_stratum_share, target, pass,
  NOT pass OR worst >= 0.5 AS expansion_required, CASE WHEN (NOT pass OR worst >= 0.5) AND n < 200 THEN least(n + 50, 200) ELSE n END AS recommended_sample_size, (NOT pass OR worst >= 0.5) AND n >= 200 AS blocked_at_200 FROM k""",
    "gold_refresh": """WITH nw AS (SELECT CASE WHEN ck % 10 = 3 THEN concat('B', source_anchor_id) ELSE source_anchor_id END AS anchor, * FROM gold_now),
j AS (SELECT r.*, a.anchor AS same, CASE WHEN a.anchor IS NULL THEN b.anchor END AS moved, coalesce(a.name1, b.name1) AS nn, coalesce(a.service_codes, b.service_codes) AS nc FROM reviews r LEFT JOIN nw a ON a.anchor = r.source_anchor_id
  LEFT JOIN nw b ON b.directory_year = r.directory_year AND b.source_page = r.source_page AND b.source_column = r.source_column AND b.source_record_order = r.source_record_order)
SELECT coalesce(same, moved, source_anchor_id) AS source_anchor_id, CASE WHEN same IS NOT NULL THEN 'matched' WHEN moved IS NOT NULL THEN 'reanchored' ELSE 'unmatched' END AS refresh_status, CASE WHEN coalesce(same, moved) IS NULL THEN parsed_name1 ELSE nn END AS parsed_name1,
  CASE WHEN coalesce(same, moved) IS NULL THEN parsed_service_codes ELSE nc END AS parsed_service_codes, review_complete FROM j""",
    "parse_location": "SELECT listing_id, CASE WHEN ck % 4 = 0 AND state = 'ZZ' THEN NULL ELSE city END AS city, CASE ck % 4 WHEN 0 THEN CASE WHEN state = 'ZZ' THEN NULL ELSE state END WHEN 1 THEN 'OR' WHEN 2 THEN 'AL' ELSE 'NY' END AS state, CASE WHEN ck % 4 = 0 AND state = 'ZZ' THEN NULL ELSE zip END AS zip FROM fac",
    "clean_text": "SELECT listing_id, trim(regexp_replace(concat(name1, ' ', address1), '\\s+', ' ', 'g')) AS cleaned FROM fac",
    "normalize_key": f"SELECT listing_id, {AUDIT('name1')} AS name_key, {KEY('address1')} AS address_key FROM fac",
    "geography_fields": f"SELECT listing_id, {REGION} AS census_region, {DIVISION} AS census_division, {PNW} AS pnw, CASE WHEN state IN ({STATES}) THEN 'yes' ELSE 'no' END AS headline_us FROM fac",
    "hash_ids": "SELECT listing_id, concat('A', substr(sha1(concat(directory_year::varchar, '|', source_page::varchar, '|', name1)), 1, 19)) AS anchor FROM fac",
    "zip_clean": "SELECT listing_id, zip FROM fac",
    "derived_fields": """WITH c AS (SELECT listing_id, list(DISTINCT code) AS c FROM svc GROUP BY 1)
SELECT listing_id, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN list_contains(c, 'PVTP') THEN 'For-profit' END, CASE WHEN list_contains(c, 'PVTN') THEN 'Non-profit' END, CASE WHEN list_has_any(c, ['LCCG', 'STG']) THEN 'Public' END, CASE WHEN list_contains(c, 'VAMC') THEN 'Federal' END], lambda x: x IS NOT NULL))), '|') AS ownership_type,
  array_to_string(list_filter(['SA', 'TX', 'DT', 'HH', 'SUMH', 'MH', 'GH'], lambda x: list_contains(c, x)), '|') AS center_types, array_to_string(list_filter(['OP', 'RES', 'HI', 'PH', 'OD', 'ODT', 'OIT', 'OMB', 'ORT', 'RD', 'RL', 'RS'], lambda x: list_contains(c, x)), '|') AS care_settings,
  array_to_string(list_filter(['MU', 'BU', 'NU', 'OTP', 'MM', 'DM', 'BUM', 'UB', 'UN', 'NXN', 'VTRL'], lambda x: list_contains(c, x)), '|') AS medication_services,
  list_contains(c, 'MD') AS accepts_medicaid, list_contains(c, 'MC') AS accepts_medicare, list_contains(c, 'PI') AS accepts_private_insurance, list_contains(c, 'TELE') AS offers_telehealth FROM c""",
    "canonical_codes": "SELECT listing_id, CASE WHEN ck % 2 = 0 THEN 'CM OP PI SS' ELSE 'OP SS TC' END AS codes FROM fac",
    "names_address": """WITH b AS (SELECT listing_id, name1 AS n, trim(concat(name2, ' Hall')) AS h, ck % 5 = 0 AS unit, name1 = '' AS bare FROM fac)
SELECT listing_id, CASE WHEN bare AND unit THEN '' WHEN bare THEN h ELSE n END AS name1, CASE WHEN bare OR unit THEN '' ELSE h END AS name2, CASE WHEN unit THEN concat(h, ', Suite 9') ELSE '77 Oak Ave' END AS address1,
  CASE WHEN unit AND bare THEN 'weak_address_pattern|missing_facility_name' WHEN unit THEN 'weak_address_pattern' ELSE '' END AS warnings FROM b""",
    "line_classify": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents), b AS (SELECT doc_id, line_no, trim(regexp_replace(line, '[ 	]+', ' ', 'g')) AS line FROM l),
c AS (SELECT doc_id, line_no, CASE WHEN line_no % 7 = 0 THEN upper(array_to_string(string_split(line, ' ')[1:3], ' ')) ELSE line END AS line FROM b),
h AS (SELECT *, regexp_matches(line, '(?i)National Directory|For Code Definitions|See KEY|Treatment Facilities|Substance Abuse and Mental Health Services Administration|(?:ment|treatment)\s+Facilities\s+[A-Z ]+$|^\d+$') AS header_noise FROM c)
SELECT doc_id, line_no, header_noise, header_noise OR NOT regexp_matches(line, '[A-Za-z0-9]') OR regexp_matches(line, '^[A-Za-z]$') OR regexp_matches(line, '^[iIl1 ]+$') AND len(replace(line, ' ', '')) > 1 AND line[1] <> ' ' AS noise,
  len(line) >= 3 AND regexp_matches(line, '^[\p{L}\[~]') AND NOT regexp_matches(line, '\p{Nd}') AND len(string_split(line, ' ')) <= 6 AND line = upper(line) AND NOT header_noise AS city_header FROM h""",
    "column_boxes": """WITH b AS (SELECT listing_id, ck % 4 AS kind, CASE WHEN ck % 4 IN (0, 3) THEN 2 ELSE 3 END AS n, CASE WHEN ck % 4 = 3 THEN 40 ELSE 30 END AS margin FROM fac), c AS (SELECT *, unnest(range(n)) AS i FROM b)
SELECT listing_id, i + 1 AS column, 36.0::double AS y0, 752.0::double AS y1,
  round(CASE WHEN kind = 3 AND i = 0 THEN 30 WHEN kind = 2 THEN 612 * [0.08, 0.36, 0.64][i + 1] ELSE margin + i * (612 - 2 * margin)::double / n + CASE WHEN i > 0 THEN 4 ELSE 0 END END::double, 9) AS x0,
  round(CASE WHEN kind = 2 THEN 612 * [0.35, 0.635, 0.91][i + 1] ELSE margin + (i + 1) * (612 - 2 * margin)::double / n + CASE WHEN i > 0 THEN 4 ELSE 0 END END::double, 9) AS x1 FROM c""",
    "anchor_ids": "SELECT listing_id, row_number() OVER (PARTITION BY directory_year, source_page, source_column, city ORDER BY source_record_order) AS occurrence, row_number() OVER (PARTITION BY directory_year ORDER BY source_page, source_column, source_record_order) AS record_order FROM fac",
    "header_ffill": "SELECT listing_id, coalesce(last_value(CASE WHEN ck % 6 = 0 THEN upper(city) END IGNORE NULLS) OVER (PARTITION BY directory_year ORDER BY source_page, source_column, source_record_order ROWS UNBOUNDED PRECEDING), '') AS header FROM fac",
    "stratified_sample": f"WITH {_sampled(20, 7)} SELECT listing_id, directory_year::bigint AS directory_year, sample_stratum FROM sampled",
    "gold_create": f"WITH {_sampled(50, 11)} SELECT concat('G', substr(sha1(concat('11|', source_anchor_id)), 1, 15)) AS sample_id, source_anchor_id, listing_id AS listing_id_at_sampling, directory_year::bigint AS directory_year, sample_stratum, page_quantile, 'active' AS review_disposition, name1 AS parsed_name1, zip AS parsed_zip, '' AS review_complete FROM sampled",
    "stratum_counts": "SELECT sample_stratum, count(*) AS rows FROM reviews GROUP BY 1",
    "review_domains": "SELECT 'address_check' AS column, 'maybe' AS value, count(*) AS rows FROM reviews WHERE ck % 41 = 0 HAVING count(*) > 0 UNION ALL SELECT 'review_complete', 'uncertain', count(*) FROM reviews WHERE ck % 43 = 0 HAVING count(*) > 0",
    "gold_summary": f"""WITH {_METRICS}, s AS (SELECT coalesce(string_agg(y::varchar, '|' ORDER BY y) FILTER (directory_year IS NULL), '') AS missing_review_years, coalesce(string_agg(directory_year::varchar, '|' ORDER BY directory_year) FILTER (NOT pass), '') AS blocked_years, coalesce(sum(be), 0)::bigint AS unresolved_boundary_errors
  FROM range(1994, 2003) r(y) FULL JOIN k ON y = directory_year)
SELECT *, missing_review_years = '' AND blocked_years = '' AND unresolved_boundary_errors = 0 AS passing FROM s""",
    "service_tokens": """SELECT DISTINCT listing_id, '2' AS group_index, code, 'ZZQ9' AS unknown FROM svc WHERE code <> ''
UNION ALL SELECT listing_id, '3', unnest(['TX', 'HH', 'PI']), 'ZZQ9' FROM (SELECT DISTINCT listing_id FROM svc) b""",
    "code_split": f"""WITH c AS (SELECT DISTINCT code FROM svc), t AS (SELECT a.code || b.code AS token FROM c a CROSS JOIN c b), known AS (SELECT unnest({KNOWN}) AS code),
cut AS (SELECT DISTINCT token, k.code AS head, l.code AS tail FROM t JOIN known k ON starts_with(token, k.code) JOIN known l ON l.code = substr(token, length(k.code) + 1)),
best AS (SELECT token, head || '+' || tail AS pieces FROM cut QUALIFY row_number() OVER (PARTITION BY token ORDER BY length(head) DESC) = 1)
SELECT token, CASE WHEN token IN (SELECT code FROM known) THEN token ELSE pieces END AS pieces FROM t LEFT JOIN best USING (token)""",
    "lines_scan": """WITH co AS (SELECT listing_id, string_agg(DISTINCT code, ' ' ORDER BY code) AS codes FROM svc GROUP BY 1),
t AS (SELECT directory_year, source_page, source_column, source_record_order, unnest(range(6)) AS i, unnest([CASE WHEN ck % 6 = 0 THEN 'CITY OF ' || translate(upper(city), '0123456789', 'ABCDEFGHIJ') END, translate(nullif(name1, ''), '#0123456789', ' abcdefghij'), address1,
  city || CASE WHEN ck % 4 = 3 THEN '. new york ' || zip || '-1234' WHEN ck % 4 = 2 THEN ', A1' || zip WHEN ck % 4 = 1 THEN ', Oregon ' || replace(zip, '5', 'S') ELSE ', ' || state || ' ' || zip END,
  CASE WHEN ck % 4 = 0 THEN 'Intake: ' ELSE 'Phone: ' END || '(503) 555-' || lpad((ck % 10000)::varchar, 4, '0'), '① ' || coalesce(codes, 'SA')]) AS text FROM fac LEFT JOIN co USING (listing_id))
SELECT directory_year::bigint AS directory_year, source_page::bigint AS page, source_column::bigint AS column, (source_record_order * 10 + i)::bigint AS line_no, text FROM t WHERE text <> ''""",
}
