"""Procedural operators on small cases and against plain Python."""

import io
import random
import zipfile
from difflib import SequenceMatcher

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollbook import cli, release, runs
from rollbook.functions import text as T
from rollbook.functions.geography import geography
from rollbook.functions.tokens import Codes, normalize_markers, service_tokens
from rollbook.operators import bounds, evaluation, geo, linkage, quality, records, sampling, status
from rollbook.sources import readers, writers
from rollbook.streaming import incremental

KNOWN = ["SA", "OP", "TX", "HH", "SF", "MD", "SS", "CM", "TC", "PI", "DT", "OS", "ORT", "OIT", "STU", "TCC", "HAEC", "HEOH"]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("line", "want"), [("Abbeville, Alabama 36310", ("Abbeville", "AL", "36310")), ("Birmingham, AL35204", ("Birmingham", "AL", "35204")), ("Birmingham, AI.35203", ("Birmingham", "AL", "35203")), ("Birmingham. AL 3S208", ("Birmingham", "AL", "35208")), ("Nowhere, XX 12345", None), ("Washington, D.C. 20001", None)])
def test_location(spark, line, want):
    assert records.location(line) == want
    got = one(spark, T.parse_location(F.lit(line)))
    assert (tuple(got) if got else None) == want


def test_keys_and_text(spark):
    for value in ("Example Treatment Center, LLC", "Café №5 Ｆull­ width", "", None, "a  b"):
        assert one(spark, T.normalize_key(F.lit(value).cast("string"))) == T.key_of(value)
        assert one(spark, T.clean_text(F.lit(value).cast("string"))) == T.clean(value)
    assert T.key_of("Example Treatment Center, LLC") == "EXAMPLETREATMENT"
    assert one(spark, T.zero_padded(F.lit("123456"), 5)) == "123456"
    assert one(spark, geography(F.lit("WA"))["pnw"]) == "PNW"


def test_tokens(spark):
    codes = Codes(KNOWN)
    assert codes.parse("① SA ③ OP ZZ", "circled") == ([(2, "SA"), (3, "OP")], ["ZZ"])
    assert codes.parse("TXHH SFMD OCRJUNK", "circled") == ([(1, "TX"), (1, "HH"), (1, "SF"), (1, "MD")], ["OCRJUNK"])
    assert {c for _, c in codes.parse("SSCM SSTC Pl", "slash")[0]} == {"SS", "CM", "TC", "PI"}
    assert codes.is_service_line("HAEC HEOH STU TCC") and not codes.is_service_line("South Central Alabama MHC")
    assert normalize_markers("♦ SA (cid:12) I'19") == "| SA | F19"
    got = spark.createDataFrame([("① SA ② OP QQ",), (None,)], "t string").select(service_tokens(F.col("t"), KNOWN).alias("x")).collect()
    assert [(c.group_index, c.code) for c in got[0].x.codes] == [("2", "SA"), ("3", "OP")] and got[0].x.unknown == ["QQ"] and got[1].x.codes == []


LINES = ["ABBEVILLE", "SpectraCare", "Henry County/Outpatient", "219 Dothan Road", "Abbeville, Alabama 36310", "Phone: (800) 951-4357", "① SA ③ OP"]


def test_records(spark):
    rows = [(2021, 15, 1, i, t) for i, t in enumerate([*LINES, "e v."])] + [(2021, 15, 2, i, t) for i, t in enumerate(["Next Facility", "12 Elm St", "Abbeville, AL 36310", "W/ Hotline: (334) 555-0000", "TX OS DT/ PI"])]
    got = records.parse_records(spark.createDataFrame(rows, "directory_year int, page int, column int, line_no int, text string"), KNOWN).orderBy("source_record_order").collect()
    assert [r.name1 for r in got] == ["SpectraCare", "Next Facility"] and got[0].name2 == "Henry County/Outpatient"
    assert got[0].service_codes == "OP SA" and got[0].phone == "(800) 951-4357" and got[1].intake_phone == "(334) 555-0000"
    assert got[1].service_codes == "DT OS PI TX" and {r.directory_city_header for r in got} == {"Abbeville"}
    renamed = [(2021, 15, 1, i, t) for i, t in enumerate(["ABBEVILLE", "Other Name", "1 Oak St", *LINES[4:]])]
    again = records.parse_records(spark.createDataFrame(renamed, "directory_year int, page int, column int, line_no int, text string"), KNOWN).first()
    assert again.source_anchor_id == got[0].source_anchor_id and again.listing_id != got[0].listing_id


def test_linkage(spark):
    rng = random.Random(1)
    rows = [(f"L{i:03}", 2000 + rng.randrange(4), rng.choice(["OR", None, ""]), rng.choice(["97001", "97002"]), rng.choice(["River House", "River Hause", "Hope LLC", "Hope", "", None]), rng.choice(["100 Main Street", "100 Main St.", "7 Elm"])) for i in range(120)]
    got = {r.listing_id: r for r in linkage.link_facilities(spark.createDataFrame(rows, "listing_id string, survey_year int, state string, zip string, name1 string, address1 string")).collect()}
    frame = pd.DataFrame(rows, columns=["id", "year", "state", "zip", "name", "address"])
    frame = frame.sort_values(["year", "state", "zip", "name", "id"], na_position="last")
    index, seeds = {}, []
    for r in frame.itertuples():
        name, address, state = T.key_of(r.name), T.key_of(r.address), r.state if isinstance(r.state, str) else None
        key = ((state or ""), r.zip, name, address)
        if key in index:
            entity, how = index[key], "exact_name_address"
        else:
            scored = [(0.65 * SequenceMatcher(None, name, n).ratio() + 0.35 * SequenceMatcher(None, address, a).ratio(), e) for e, s, z, n, a in seeds if s is not None and s == state and z == r.zip]
            best = max(scored, default=(0, None))
            entity, how = (best[1], "fuzzy_within_zip") if best[0] >= 0.93 else (got[r.id].facility_id, "new_entity")
            if how == "new_entity":
                seeds.append((entity, state, r.zip, name, address))
        index[key] = entity
        assert (got[r.id].linkage_method, got[r.id].facility_id) == (how, entity)


def test_status(spark):
    fac = spark.createDataFrame([("L1", 2020, 2019), ("L2", 2020, 2019)], "listing_id string, directory_year int, survey_year int")
    svc = spark.createDataFrame([("L1", "OP")], "listing_id string, code string")
    avail = spark.createDataFrame([(2020, "OP", "a", "b", True), (2020, "TELE", "a", "b", False)], "directory_year int, code string, category string, label string, asked boolean")
    got = {(r.listing_id, r.code): r.status for r in status.service_status(fac, svc, avail).collect()}
    assert got == {("L1", "OP"): "offered", ("L2", "OP"): "not_offered", ("L1", "TELE"): "not_asked", ("L2", "TELE"): "not_asked"}


def test_bounds(spark):
    cells = spark.createDataFrame([("01001", "01", 2017, "621420", 4.0, "published"), ("01001", "01", 2017, "623220", None, "omitted_or_zero")], "county_fips string, state_fips string, year int, naics string, establishments double, publication_status string")
    counts = spark.createDataFrame([("01001", "01", 2017, 5)], "county_fips string, state_fips string, year int, listing_count int")
    r = bounds.compare_counts(counts, cells, ("621420", "623220")).first()
    assert (r.external_count, r.lower_bound, r.upper_bound, r.common_support, r.reporting_break) == (None, 4.0, 6.0, False, True)


def test_sample(spark):
    rows = [(f"A{i}", 2020, 1 + i // 3, 1 + i % 2, i, ["OR", "NY", "TX", "WA", "CA"][i % 5], f"City {i % 9}", f"{i} Main" + " Suite 1" * (i % 7 == 0), f"N{i}", "x" * (i % 9 == 0), "RARE OP" if i < 8 else "OP SA", "[]" if i % 8 else '["w"]', "[]" if i % 17 else '["u"]', "") for i in range(300)]
    names = "source_anchor_id string, directory_year int, source_page int, source_column int, source_record_order int, state string, city string, address1 string, name1 string, name2 string, service_codes string, parser_warnings string, unknown_service_tokens string, raw_record_text string"
    frame = spark.createDataFrame(rows, names).withColumns(geography(F.col("state")))
    features = sampling.sampling_features(frame)
    got = sampling.sample(features, 50, seed=3).collect()
    again = sampling.sample(features.repartition(5), 50, seed=3).collect()
    assert len(got) == 50 and len({r.source_anchor_id for r in got}) == 50
    assert {r.sample_stratum for r in got} == {"warning_unknown", "boundary", "rare_dense_services", "complex_record", "random"}
    assert {(r.source_anchor_id, r.sample_stratum) for r in got} == {(r.source_anchor_id, r.sample_stratum) for r in again}
    assert sampling.quotas(50) == {"warning_unknown": 10, "boundary": 5, "rare_dense_services": 5, "complex_record": 5, "random": 25}


def test_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.txt", "FIPSTATE,FIPSCTY,NAICS,EST\n01,001,------,9\n01,001,621420,4\n")
    rows = readers.read_zipped_csv(spark, str(tmp_path / "a.zip"), ["fipstate", "fipscty", "naics", "est"]).withColumn("year", F.lit(2016))
    got = {(r.naics, r.publication_status, r.establishments) for r in bounds.county_cells(rows, ("621420", "623220")).collect()}
    assert got == {("621420", "published", 4.0), ("623220", "zero", 0.0)}
    late = {(r.naics, r.publication_status, r.establishments) for r in bounds.county_cells(rows.withColumn("year", F.lit(2017)), ("621420", "623220")).collect()}
    assert late == {("621420", "published", 4.0), ("623220", "omitted_or_zero", None)}
    book = io.BytesIO()
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>a</t></si><si><t>b</t></si></sst>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="B2"><v>5</v></c></row></sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(book.getvalue())
    assert [(r.source_row, r.a, r.b) for r in readers.read_workbook(spark, str(tmp_path / "b.xlsx"), "S", ["a", "b"]).collect()] == [(2, "", "5")]
    lines = readers.read_pages(spark, str(tmp_path / "b.xlsx"), 2021, lambda raw: iter([(3, 1, " one \n\ntwo")])).collect()
    assert [(r.page, r.line_no, r.text) for r in lines] == [(3, 1, "one"), (3, 2, "two")]
    config = {"crop_top": 1, "crop_bottom": 2, "layout_profile": "two_column", "n_columns": 2, "margin": 10, "overlap": 3, "directory_year": 1998}
    assert readers.column_boxes(110, 50, config) == [(30.0, 1, 55.0, 48), (58.0, 1, 103.0, 48)]


def test_sinks_and_runs(spark, tmp_path):
    df = spark.createDataFrame([(2020, 2019, "x" * 300, True, ["a"]), (2021, 2020, None, None, [])], "directory_year int, survey_year int, text string, flag boolean, codes array<string>")
    writers.write_years(df, str(tmp_path / "t"))
    writers.write_years(df.where("directory_year = 2021").withColumn("text", F.lit("new")), str(tmp_path / "t"))
    assert {(r.directory_year, (r.text or "")[:3]) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {(2020, "xxx"), (2021, "new")}
    writers.write_stata(df, str(tmp_path / "t.dta"))
    assert pd.read_stata(tmp_path / "t.dta")["text"].str.len().tolist() == [300, 0]
    assert len(set(writers.stata_names(["a" * 40, "a" * 41, "a-b", "a_b"]).values())) == 4
    assert writers.checksums(spark, str(tmp_path / "t")).count() >= 2 and writers.data_dictionary(spark, {"t": df}).count() == 5
    calls = []
    for t in runs.REQUIRED:
        (tmp_path / "run" / t / "directory_year=2020").mkdir(parents=True)
    work = lambda y: calls.append(y) or ({"structural_pass": True} if y == 2020 else 1 / 0)
    for _ in range(2):
        runs.run_years(tmp_path / "run", [2020, 2021], "sig", work)
    assert calls == [2020, 2021, 2021] and runs.validate(tmp_path / "run", [2020, 2021, 2022]) == {"missing": [2022], "failed": [2021], "incomplete": [], "blocked": [], "complete": False}
    assert [(r.directory_year, r.state, r.structural_pass) for r in runs.read_status(spark, tmp_path / "run").collect()] == [(2020, "complete", True), (2021, "failed", False)]
    runs.run_years(tmp_path / "run", [2020, 2023, 2024], "sig", lambda y: {"structural_pass": True}, workers=3)
    assert runs.validate(tmp_path / "run", [2020, 2023, 2024])["incomplete"] == [2023, 2024]
    assert runs.selected([2022, 2020, 2021], 2021) == [2021, 2022] and runs.selected([2020, 2021], only={2021}) == [2021]
    with pytest.raises(ValueError, match="2019"):
        runs.selected([2020], only={2019})
    assert runs.latest_run(tmp_path) == tmp_path / "run"


def test_incremental(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(["a,1\nb,2", "a,3"]):
        (tmp_path / "in" / f"{i}.csv").write_text(f"listing_id,county_fips\n{rows}\n")
        incremental.follow_answers(spark, str(tmp_path / "in"), "listing_id string, county_fips string", str(tmp_path / "cache"), str(tmp_path / "ck")).awaitTermination()
    assert {(r.listing_id, r.county_fips) for r in incremental.current(spark, str(tmp_path / "cache")).collect()} == {("a", "3"), ("b", "2")}


def test_expand_replaces_from_the_same_stratum(spark):
    flags = list(sampling.FLAGS.values())
    features = [(f"n{i:02}", 2000, 1 + i % 5, 1, "South", "TX", *(f == "is_boundary" and i < 3 for f in flags)) for i in range(40)]
    frame = spark.createDataFrame(features, "source_anchor_id string, directory_year int, page_quantile int, source_column int, census_region string, state string, " + ", ".join(f"{f} boolean" for f in flags))
    old = [("o1", "boundary", "", "Uncertain"), ("o2", "boundary", "", "uncertain"), ("o3", "random", "", "uncertain"), ("o4", "random", "", "yes"), ("o5", "random", "replaced", "yes")]
    reviewed = spark.createDataFrame([(a, 2000, s, d, "yes", c, "yes", None) for a, s, d, c in old], "source_anchor_id string, directory_year int, sample_stratum string, review_disposition string, name_check string, address_check string, services_check string, boundary_check string")
    got = {r.source_anchor_id: (r.sample_stratum, r.replaces) for r in sampling.expand(reviewed, frame, 12, seed=3).collect()}
    assert len(got) == 11 and {r for _, r in got.values() if r} == {"o1", "o2", "o3"}
    assert all(a in {"n00", "n01", "n02"} for a, (_, r) in got.items() if r in ("o1", "o2"))
    assert {s for s, r in got.values() if r in ("o1", "o2")} == {"boundary"}
    few = sampling.expand(reviewed, frame, 3, seed=3).collect()
    assert [r.replaces for r in sorted(few, key=lambda r: r.replaces)] == ["o1", "o2"]
    assert sampling.expand(reviewed, frame, 1, seed=3).count() == 0


def test_rights_scan(spark):
    rows = [
        ("a", 1, 3, "A Public Domain Notice"), ("a", 20, 3, "it may be reproduced"), ("a", 21, 3, "distributed for a fee"), ("a", 2, 3, None),
        ("b", 25, 30, "public domain"), ("b", 30, 30, "public domain notice"), ("b", 31, 30, "reproduced or copied"), ("c", 1, None, ""), ("c", 2, None, "reproduced or copied"),
    ]
    pages = spark.createDataFrame(rows, "file string, page int, start_page int, text string")
    found = {r["file"]: tuple(r)[1:] for r in quality.rights_scan(pages, "file").collect()}
    assert found == {"a": (True, True, False, 1, True, False), "b": (True, False, False, 25, False, True), "c": (False, True, False, None, False, True)}
    whole = {r["file"]: tuple(r)[1:] for r in quality.rights_scan(pages, "file", whole=True).collect()}
    assert whole["a"][2] and whole["b"][1]
    assert quality.rights_scan(pages.limit(0), "file").count() == 0


def test_print_order_carries_headers_over_columns(spark):
    rows = [(2000, 2, 1, 1, None, True), (2000, 1, 2, 5, "B", False), (2000, 1, 2, 6, None, True), (2000, 1, 1, 9, None, True), (2000, 1, 2, 4, None, True), (2000, None, 1, 1, "A", True), (2001, 1, 1, 1, None, True), (2000, 3, 1, 1, None, None)]
    lines = spark.createDataFrame(rows, "directory_year int, page int, column int, line_no int, h string, counted boolean")
    got = {(r.directory_year, r.page, r.column, r.line_no): (r.header_so_far, r.number_so_far) for r in records.in_print_order(lines, F.col("h"), F.col("counted")).collect()}
    assert got == {(2000, None, 1, 1): ("A", 1), (2000, 1, 1, 9): ("A", 2), (2000, 1, 2, 4): ("A", 3), (2000, 1, 2, 5): ("B", 3), (2000, 1, 2, 6): ("B", 4), (2000, 2, 1, 1): ("B", 5), (2000, 3, 1, 1): ("B", 5), (2001, 1, 1, 1): ("", 1)}


def test_geocode_pending_asks_in_whole_batches(spark):
    fac = spark.createDataFrame([(f"L{i:03}",) for i in range(57)], "listing_id string")
    cache = spark.createDataFrame([("L003", "old"), ("L040", "old")], "listing_id string, county_fips string")
    out = geo.geocode_pending(fac, cache, lambda f: f.assign(county_fips=f"{len(f)}"), "listing_id string, county_fips string", 10).collect()
    sizes = [r.county_fips for r in out]
    assert len(out) == 57 and sizes.count("old") == 2 and sizes.count("10") == 50 and sizes.count("5") == 5
    assert geo.geocode_pending(fac.limit(0), cache, lambda f: f, "listing_id string, county_fips string").count() == 2


def test_attach_takes_the_least_row(spark):
    fac = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "listing_id string, county string")
    extra = spark.createDataFrame([("a", "2", 1), ("a", "1", 9), (None, "3", 0)], "listing_id string, county string, n int").repartition(3)
    assert {tuple(r) for r in geo.attach(fac, extra).collect()} == {("a", "1", 9), ("b", None, None), (None, None, None)}


def test_json_items(spark):
    texts = spark.createDataFrame([('["a", "", "b"]',), ("plain",), ("",), (None,), ("[]",)], "t string")
    assert [r.x for r in texts.select(status.json_items(F.col("t")).alias("x")).collect()] == [["a", "b"], ["plain"], [], [], []]


def test_page_gate_and_counted_reasons(spark):
    fac = spark.createDataFrame([(y, "OR" if i else "??", "" if i < 2 else "n", "a", "[]", 1) for y in (2000, 2001) for i in range(10)], "directory_year int, state string, name1 string, address1 string, parser_warnings string, source_page int")
    svc = spark.createDataFrame([(y, f"L{i}") for y in (2000, 2001) for i in range(7)], "directory_year int, listing_id string")
    avail = spark.createDataFrame([(2000, "OP")], "directory_year int, code string")
    expected = spark.createDataFrame([(2000, 20, "early_ocr", 9, 8), (2001, None, "two_column", 9, 9)], "directory_year int, expected_listings int, layout_profile string, end_page int, pdf_page_count int")
    got = {r.directory_year: r.blocking_reasons.split("; ") for r in quality.structural_metrics(fac, svc, avail, expected).collect()}
    early = ["1 malformed state records", "implausible listing count: 10", "PDF ends before the configured final page", "missing facility-name share is 20.0%", "listing count differs from comparison fixture by 50.0%"]
    late = ["1 malformed state records", "implausible listing count: 10", "service coverage 70.0% is below 80%", "empty service availability", "missing facility-name share is 20.0%"]
    assert got == {2000: early, 2001: late}
    bare = {r.directory_year: r.blocking_reasons for r in quality.structural_metrics(fac, svc, avail, expected.select("directory_year", "expected_listings")).collect()}
    assert "final page" not in bare[2000] and "below 80%" in bare[2000]


def test_review_domains(spark):
    names = "name_check string, address_check string, services_check string, boundary_check string, review_complete string"
    good = spark.createDataFrame([("Yes", "no", None, "", "YES"), ("uncertain", "yes", "yes", "yes", None)], names)
    assert [r.review_complete for r in evaluation.check_reviews(good).collect()] == ["yes", ""]
    for bad in (("maybe", "no", "no", "no", "yes"), ("yes", "no", "no", "no", "uncertain")):
        with pytest.raises(ValueError, match="maybe|uncertain"):
            evaluation.check_reviews(good.union(spark.createDataFrame([bad], names)))
    with pytest.raises(ValueError, match="boundary_check"):
        evaluation.check_reviews(good.drop("boundary_check"))


def test_create_refuses_a_repeated_anchor(spark):
    rows = [(f"L{i}", f"A{i}", 2000, 1 + i % 5, 1, "South", "TX", f"N{i}", "9701.0", *(False,) * 4) for i in range(30)]
    names = "listing_id string, source_anchor_id string, directory_year int, page_quantile int, source_column int, census_region string, state string, name1 string, zip string, " + ", ".join(f"{f} boolean" for f in sampling.FLAGS.values())
    frame = spark.createDataFrame(rows, names)
    made = sampling.create(frame, 10, seed=1)
    assert sampling.metadata(made, 1) == {"seed": 1, "total_rows": 10, "sample_sizes": {2000: 10}, "stratum_counts": {"random": 10}}
    first = made.first()
    assert first.sample_id.startswith("G") and first.parsed_zip == "9701" and first.review_disposition == "active" and first.corrected_name1 == ""
    with pytest.raises(ValueError, match="more than once"):
        sampling.create(frame.union(frame), 30, seed=1)


def test_release(spark, tmp_path):
    fac = spark.createDataFrame([(f"L{i}", 2000 + i % 2, 1999 + i % 2, f"N{i}", "1 Elm", "OR", "[]", "OP") for i in range(8)], "listing_id string, directory_year int, survey_year int, name1 string, address1 string, state string, parser_warnings string, service_codes string")
    svc = fac.select("listing_id", "directory_year", F.lit("OP").alias("code"))
    avail = spark.createDataFrame([(y, "OP", "c", "l", True) for y in (2000, 2001)], "directory_year int, code string, category string, label string, asked boolean")
    expected = spark.createDataFrame([(2000, 4, "yes"), (2001, 4, "yes")], "directory_year int, expected_listings int, acceptance_reference string")
    geocoded = fac.select("listing_id", F.lit("41001").alias("county_fips"), F.lit("high").alias("geocode_confidence"))
    gold = fac.select("listing_id", F.col("address1").alias("address1_gold"), F.col("service_codes").alias("service_codes_gold"), F.lit("yes").alias("review_complete"))
    links = fac.select("listing_id", F.concat(F.lit("F"), "listing_id").alias("facility_id"))
    out = str(tmp_path / "release")
    with pytest.raises(ValueError, match="manual gold sample"):
        release.assemble(out, fac, svc, avail, expected, links, geocoded)
    assert not (tmp_path / "release").exists()
    made = release.assemble(out, fac, svc, avail, expected, links, geocoded, gold, 0.99)
    assert made["release_ready"] and made["blocking_reasons"] == [] and made["rows"] == {"facilities": 8, "facility_services": 8, "service_availability": 2, "facility_service_status": 8, "facility_entities": 8, "geocoding_results": 8}
    read = {r.listing_id: (r.facility_id, r.county_fips, r.release_status) for r in spark.read.parquet(f"{out}/facilities.parquet").collect()}
    assert len(read) == 8 and read["L1"] == ("FL1", "41001", "final")
    assert spark.read.option("header", True).csv(f"{out}/facilities_csv").count() == 8 and spark.read.text(f"{out}/qa_report").count() == 1
    assert spark.read.csv(f"{out}_checksums", sep=" ").count() > 6
    early = release.assemble(str(tmp_path / "early"), fac, svc, avail, expected, preliminary=True)
    assert not early["release_ready"] and release.dashboard_status(early, "1")["blocking_reasons"] == early["blocking_reasons"]
    assert release.dashboard_status(None)["blocking_reasons"] == ["release has not been built"]
    (tmp_path / "a.pdf").write_bytes(b"a")
    rights = spark.createDataFrame([("a.pdf", True), ("b.pdf", False)], "file string, archive_eligible boolean")
    assert release.zip_sources(rights, str(tmp_path), str(tmp_path / "s.zip")) == ["b.pdf"] and zipfile.ZipFile(tmp_path / "s.zip").namelist() == ["a.pdf"]


def test_cli_reads_the_years_asked_for(spark, tmp_path):
    spark.createDataFrame([(y, "L", "OP") for y in (1999, 2000, 2001)], "directory_year int, listing_id string, code string").write.parquet(str(tmp_path / "t.parquet"))
    whole = spark.read.parquet(str(tmp_path / "t.parquet"))
    assert {r.directory_year for r in cli.in_years(whole, 2000, None).collect()} == {2000, 2001} and cli.in_years(whole, None, 1999).count() == 1
    assert cli.in_years(whole, None, None).count() == 3 and cli.in_years(whole.drop("directory_year"), 2000, 2000).count() == 3
