"""X1-X15 on small landed-file fixtures (FIXTURES C2 and hand-made rows)."""

import json

import pytest

from conftest import d
from hebdo.plans import national_feeds as NF
from hebdo.plans.normalize import normalize_paged, normalize_pages, normalize_source
from hebdo.sources.readers import read_csv_text, read_json_records, read_landed_payloads


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def page_rows(rows):
    keys = ["state", "date", NF.US_ADULT, NF.US_PAEDIATRIC]
    return json.dumps([{k: v for k, v in zip(keys, r) if v is not None} for r in rows])


C2_PAGE1 = [("CA", "2022-01-03", "5", "1"), ("NY", "2022-01-03", "6", None), ("TX", "2022-01-04", None, None),
            ("PR", "2022-01-03", "9", "9"), (None, "2022-01-03", "4", "4")]
C2_PAGE2 = [("WA", "2022-01-03", "4", "2"), ("OR", "2022-01-04", "2", "abc"), ("VI", "2022-01-04", "1", "0")]


@pytest.fixture()
def landed(tmp_path):
    t = "T00:00:00.000"
    write(tmp_path / "us" / "page-1.json", page_rows([(s, dt + t, a, p) for s, dt, a, p in C2_PAGE1]))
    write(tmp_path / "us" / "page-2.json", page_rows([(s, dt + t, a, p) for s, dt, a, p in C2_PAGE2]))
    write(tmp_path / "nz.csv",
          "Variable Label,Variable,Admissions for COVID-19 in the week ending,Hospitalisations,ICU\n"
          "Sex,Female,2022-01-09,3,1\nSex,Male,2022-01-09,4,\nAge,0-9,2022-01-09,50,50\n"
          "Sex,Female,2022-01-16,2,0\nSex,Male,2022-01-16,,0\n")
    write(tmp_path / "cdc.json", json.dumps([
        {"season": "2324", "time_period": " Week ", "estimate": "370", "strata": "Overall", "time": "05/04/2024"},
        {"season": "2324", "time_period": "week", "estimate": "378.6", "strata": "Overall", "time": "05/11/2024"},
        {"season": "2324", "time_period": "week", "estimate": "9", "strata": "Age", "time": "05/11/2024"},
        {"season": "2223", "time_period": "week", "estimate": "5", "strata": "Overall", "time": "05/11/2024"},
        {"season": "2324", "time_period": "week", "estimate": "1", "strata": "Overall", "time": "04/27/2024"},
        {"season": "2425", "time_period": "month", "estimate": "7", "strata": "Overall", "time": "05/11/2024"}]))
    write(tmp_path / "ch.json", json.dumps([
        {"geoRegion": "CH", "altersklasse_covid19": "all", "primary_hosp_reason": "covid", "date": "202001", "entries": "10"},
        {"geoRegion": "CH", "altersklasse_covid19": "all", "primary_hosp_reason": "covid", "date": "202053", "entries": "99"},
        {"geoRegion": "ZH", "altersklasse_covid19": "all", "primary_hosp_reason": "covid", "date": "202001", "entries": "5"},
        {"geoRegion": "CH", "altersklasse_covid19": "10-19", "primary_hosp_reason": "covid", "date": "202001", "entries": "5"}]))
    write(tmp_path / "uk_h.csv", "areaName,date,newAdmissions\nUnited Kingdom,2022-01-03,100\nUnited Kingdom,2022-01-04,90\n")
    write(tmp_path / "uk_i.csv", "areaName,date,covidOccupiedMVBeds\nUnited Kingdom,2022-01-03,7\nUnited Kingdom,2022-01-05,8\n")
    fc = lambda props: json.dumps({"type": "FeatureCollection",
                                    "features": [{"type": "Feature", "properties": p} for p in props]})
    write(tmp_path / "ie_h.geojson", fc([{"Date": 1641168000000, "SUM_no_new_admissions_covid19_p": 30},
                                         {"Date": 1641254400000, "SUM_no_new_admissions_covid19_p": 20}]))
    write(tmp_path / "ie_i.geojson", fc([{"extract": 1641168000000, "adcconf": 3}]))
    write(tmp_path / "dk.csv", "Dato,Total\n2022-01-03,40\n2022-01-04,41\n")
    write(tmp_path / "no_h.csv", "date,new_hospit\n03/01/2022,11\n04/01/2022,12\n")
    write(tmp_path / "no_i.csv", "date,new_icu\n2022-01-03,1\n")
    write(tmp_path / "ca.csv", "Date,COVID_NEWICU,COVID_NEWOTHER\n2022-01-03,2,20\n2022-01-04,x,21\n")
    write(tmp_path / "bg.json", json.dumps([list(NF.BG_FIELDS), ["2022-01-03", "12"]], ensure_ascii=False))
    write(tmp_path / "ref.csv", "ADM0_NAME,WHO_REGION,ISO_3_CODE\nNEW ZEALAND,WPRO,NZL\nNEW ZEALAND,WPRO,NZL\n"
                                "DENMARK,EURO,DNK\nCANADA,AMRO,CAN\n")
    return NF.LandedFeeds(
        nz=str(tmp_path / "nz.csv"), cdc=str(tmp_path / "cdc.json"), us_states=str(tmp_path / "us"),
        switzerland=str(tmp_path / "ch.json"), uk_admissions=str(tmp_path / "uk_h.csv"),
        uk_ventilated=str(tmp_path / "uk_i.csv"), ireland_admissions=str(tmp_path / "ie_h.geojson"),
        ireland_icu=str(tmp_path / "ie_i.geojson"), denmark=str(tmp_path / "dk.csv"),
        norway_admissions=str(tmp_path / "no_h.csv"), norway_icu=str(tmp_path / "no_i.csv"),
        canada=str(tmp_path / "ca.csv"), bulgaria=str(tmp_path / "bg.json"), reference_places=str(tmp_path / "ref.csv"))


def tidy(df):
    return sorted((r["country_name"], r["report_date"].isoformat(), r["new_hospitalization"],
                   r["new_icu"] if "new_icu" in r else None) for r in df.collect())


def test_us_pages_union_and_full_join(spark, landed):
    rows = read_landed_payloads(spark, landed.us_states, NF.STATE_RECORD)
    pages = sorted(r["page_file"] for r in rows.select("page_file").distinct().collect())
    assert len(pages) == 2
    union = normalize_pages([rows], NF.US_STATES)
    assert tidy(union) == [("United States of America", "2022-01-03", 18, None)]
    joined = normalize_paged(rows, NF.US_STATES, "page_file")
    assert tidy(joined) == [("United States of America", "2022-01-03", 12, None)]
    split = [rows.filter(rows.page_file == p) for p in pages]
    assert tidy(normalize_pages(split, NF.US_STATES, mode="full_join_on_values")) == tidy(joined)
    terr = normalize_paged(rows, NF.US_TERRITORY_PAGES, "page_file")
    assert tidy(terr) == [("Puerto Rico", "2022-01-03", 18, None), ("United States Virgin Islands", "2022-01-04", 1, None)]
    compat = NF.archived_feeds(spark, NF.LandedFeeds(us_states=landed.us_states), us_pages_mode="full_join_on_values")
    assert [tidy(f) for f in compat] == [sorted(tidy(joined) + tidy(terr))]
    both = NF.archived_feeds(spark, NF.LandedFeeds(us_states=landed.us_states))
    assert [tidy(f) for f in both] == [sorted(tidy(union) + tidy(normalize_pages([rows], NF.US_TERRITORY_PAGES)))]


def test_nz_current(spark, landed):
    out = normalize_source(read_csv_text(spark, landed.nz), NF.NZ_CURRENT)
    got = sorted((r["report_date"].isoformat(), r["new_hospitalization"], r["new_icu"], r["WHO_REGION"]) for r in out.collect())
    assert got == [("2022-01-09", 7, 1, "WPRO"), ("2022-01-16", 2, 0, "WPRO")]


def test_cdc(spark, landed):
    out = normalize_source(read_json_records(spark, landed.cdc, NF.CDC_RECORD), NF.CDC_SENTINEL)
    got = sorted((r["report_date"].isoformat(), r["new_hospitalization"], r["new_icu"]) for r in out.collect())
    assert got == [("2024-05-04", 370, None), ("2024-05-11", 378, None)]


def test_switzerland_both_week_rules(spark, landed):
    raw = read_json_records(spark, landed.switzerland, NF.CH_RECORD)
    assert tidy(normalize_source(raw, NF.switzerland("monday_week"))) == [("Switzerland", "2020-01-06", 10, None)]
    assert tidy(normalize_source(raw, NF.switzerland("iso"))) == [("Switzerland", "2019-12-30", 10, None),
                                                                 ("Switzerland", "2020-12-28", 99, None)]


def test_archived_feeds(spark, landed):
    feeds = NF.archived_feeds(spark, landed, include_bulgaria=True)
    got = []
    for f in feeds:
        got += tidy(f)
    by_country = {}
    for c, day, h, i in got:
        by_country.setdefault(c, []).append((day, h, i))
    assert by_country["United Kingdom"] == [("2022-01-03", 100, 7), ("2022-01-04", 90, 0), ("2022-01-05", 0, 8)]
    assert by_country["Ireland"] == [("2022-01-03", 30, 3), ("2022-01-04", 20, 0)]
    assert by_country["Norway"] == [("2022-01-03", 11, 1), ("2022-01-04", 12, 0)]
    assert by_country["Canada"] == [("2022-01-03", 20, 2), ("2022-01-04", 21, 0)]
    assert by_country["Denmark"] == [("2022-01-03", 40, None), ("2022-01-04", 41, None)]
    assert by_country["Bulgaria"] == [("2022-01-03", 12, None)]
    assert by_country["New Zealand"] == [("2022-01-09", 7, 1), ("2022-01-16", 2, 0)]


def test_archived_release_from_files(spark, landed):
    out = NF.archived_release_from_files(spark, landed)
    cols = out.columns
    assert cols[:8] == ["country", "iso_year", "iso_week_number", "epiweek", "freq", "freq_time",
                        "new_hospitalization", "new_icu"]
    assert cols[8:] == ["WHO_REGION", "ISO_3_CODE"]
    rows = {(r["country"], r["epiweek"]): r for r in out.collect()}
    # the latest week overall (2022-01-10, NZ's 2022-01-16 report) is dropped
    assert all(k[1] < d("2022-01-10") for k in rows)
    dk = rows[("DENMARK", d("2022-01-03"))]
    assert (dk["new_hospitalization"], dk["new_icu"], dk["freq_time"], dk["freq"]) == (81, None, 2, "daily")
    assert (dk["WHO_REGION"], dk["ISO_3_CODE"], dk["iso_year"], dk["iso_week_number"]) == ("EURO", "DNK", 2022, 1)
    nz = rows[("NEW ZEALAND", d("2022-01-03"))]
    assert (nz["new_hospitalization"], nz["freq"], nz["WHO_REGION"]) == (7, "weekly", "WPRO")
    uk = rows[("THE UNITED KINGDOM", d("2022-01-03"))]
    assert (uk["new_hospitalization"], uk["new_icu"], uk["WHO_REGION"]) == (190, 15, None)
    assert ("SWITZERLAND", d("2020-01-06")) in rows


def test_current_release_from_files(spark, landed):
    out = NF.current_release_from_files(spark, landed)
    assert out.columns == ["WHO_REGION", "ISO_3_CODE", "country", "epiweek", "new_hospitalization", "new_icu",
                           "iso_year", "iso_week_number"]
    got = sorted((r["country"], r["epiweek"].isoformat(), r["new_hospitalization"], r["new_icu"],
                  r["iso_year"], r["iso_week_number"]) for r in out.collect())
    assert got == [("NEW ZEALAND", "2022-01-03", 7, 1, 2022, 1), ("NEW ZEALAND", "2022-01-10", 2, 0, 2022, 2),
                   ("UNITED STATES OF AMERICA", "2024-04-29", 370, None, 2024, 18),
                   ("UNITED STATES OF AMERICA", "2024-05-06", 378, None, 2024, 19)]


def test_legacy_layouts(spark, landed):
    from hebdo.plans.release import OUTPUT_LEGACY_REGION, OUTPUT_LEGACY_SHORT
    short = NF.archived_release_from_files(spark, landed, spec=OUTPUT_LEGACY_SHORT)
    assert short.columns == list(OUTPUT_LEGACY_SHORT.columns) + ["WHO_REGION", "ISO_3_CODE"]
    region = NF.archived_release_from_files(spark, landed, spec=OUTPUT_LEGACY_REGION)
    assert region.columns == list(OUTPUT_LEGACY_REGION.columns)
    dk = [r for r in region.collect() if r["country"] == "DENMARK"]
    assert [(r["WHO_REGION"], r["ISO_3_CODE"], r["iso_week_number"]) for r in dk] == [("EURO", "DNK", 1)]


def test_feed_quarantine(spark, tmp_path):
    from hebdo.plans.normalize import quarantined_rows
    p = write(tmp_path / "dk_bad.csv", "Dato,Total\n2022-01-03,40\n0015-01-20,5\nnot a date,3\n2022-01-04,1\n")
    raw = read_csv_text(spark, p)
    valid = normalize_source(raw, NF.DENMARK)
    assert tidy(valid) == [("Denmark", "2022-01-03", 40, None), ("Denmark", "2022-01-04", 1, None)]
    bad = quarantined_rows(raw, NF.DENMARK)
    assert sorted((r["raw_date"], r["date_issue"], r["feed"]) for r in bad.collect()) == [
        ("0015-01-20", "before_min", "dk"), ("not a date", "unparsed", "dk")]


def test_command_line(spark, landed, tmp_path):
    from hebdo.__main__ import main
    out = tmp_path / "csv"
    main(["current", "--nz", landed.nz, "--cdc", landed.cdc, "--csv", str(out)])
    text = next(p for p in out.iterdir() if p.name.endswith(".csv")).read_text().splitlines()
    assert text[0] == "WHO_REGION,ISO_3_CODE,country,epiweek,new_hospitalization,new_icu,iso_year,iso_week_number"
    assert text[1] == "WPRO,NZL,NEW ZEALAND,2022-01-03,7,1,2022,1"
    assert text[-1] == "AMRO,USA,UNITED STATES OF AMERICA,2024-05-06,378,,2024,19"
    out2 = tmp_path / "csv2"
    main(["current", "--nz", landed.nz, "--csv", str(out2), "--week-rule", "iso_week_end_year",
          "--layout", "legacy_short"])
    text2 = next(p for p in out2.iterdir() if p.name.endswith(".csv")).read_text().splitlines()
    assert text2[0] == "country,epiweek,new_hospitalization,new_icu,iso_year,iso_week_number"
    assert text2[1] == "NEW ZEALAND,2022-01-03,7,1,2022,1"
    main(["archived", "--denmark", landed.denmark, "--canada", landed.canada, "--reference-places",
          landed.reference_places, "--parquet", str(tmp_path / "pq"), "--latest-week", "keep"])
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert sorted((r["country"], r["new_hospitalization"]) for r in back.collect()) == [("CANADA", 41), ("DENMARK", 81)]


def test_stock_measure_weekly(spark, landed):
    feeds = NF.archived_feeds(spark, NF.LandedFeeds(uk_admissions=landed.uk_admissions,
                                                    uk_ventilated=landed.uk_ventilated))
    from hebdo.plans.release import archived_weekly_series
    summed = archived_weekly_series(feeds, latest_week="keep").first()
    last = archived_weekly_series(feeds, latest_week="keep", weekly_aggregates={"new_icu": "last"}).first()
    peak = archived_weekly_series(feeds, latest_week="keep", weekly_aggregates={"new_icu": "max"}).first()
    assert (summed["new_icu"], last["new_icu"], peak["new_icu"]) == (15, 8, 8)
    assert summed["new_hospitalization"] == last["new_hospitalization"] == 190


def test_spec_validation():
    from hebdo.plans.specs import DateSpec, MeasureSpec, SourceSpec
    m = (MeasureSpec("new_hospitalization", ("x",)),)
    with pytest.raises(ValueError):
        SourceSpec(name="a", date=DateSpec("d"), measures=m)                       # no country
    with pytest.raises(ValueError):
        SourceSpec(name="a", date=DateSpec("d"), measures=m, country="X", country_column="c")
    with pytest.raises(ValueError):
        DateSpec("d", "formats")
    with pytest.raises(ValueError):
        MeasureSpec("m", ("x",), aggregate="mean")
    with pytest.raises(ValueError):
        SourceSpec(name="a", date=DateSpec("d"), measures=m, country="X", drop_zero="other")


def test_normalize_with_quarantine_one_pass(spark, tmp_path):
    from hebdo.plans.normalize import normalize_with_quarantine, quarantined_rows
    p = write(tmp_path / "dk_bad2.csv", "Dato,Total\n2022-01-03,40\n0015-01-20,5\nnot a date,3\n2022-01-03,1\n")
    raw = read_csv_text(spark, p)
    valid, bad = normalize_with_quarantine(raw, NF.DENMARK, str(tmp_path / "staged"))
    assert tidy(valid) == tidy(normalize_source(raw, NF.DENMARK)) == [("Denmark", "2022-01-03", 41, None)]
    key = lambda r: (r["raw_date"], r["date_issue"], r["feed"])
    assert sorted(map(key, bad.collect())) == sorted(map(key, quarantined_rows(raw, NF.DENMARK).collect()))
    assert "PartitionFilters: [isnotnull(date_issue" in bad._jdf.queryExecution().executedPlan().toString()


def test_command_line_archived_options(spark, landed, tmp_path):
    from hebdo.__main__ import main
    out = tmp_path / "arch"
    main(["archived", "--us-states", landed.us_states, "--switzerland", landed.switzerland,
          "--bulgaria", landed.bulgaria, "--reference-places", landed.reference_places,
          "--us-pages-mode", "full_join_on_values", "--switzerland-weeks", "iso", "--include-bulgaria",
          "--freq-mode", "compat", "--latest-week", "keep", "--parquet", str(out)])
    got = {(r["country"], r["epiweek"].isoformat()): (r["new_hospitalization"], r["freq"], r["freq_time"])
           for r in spark.read.parquet(str(out)).collect()}
    assert got[("UNITED STATES OF AMERICA", "2022-01-03")] == (12, "weekly", 1)     # two-page join: 12
    assert got[("PUERTO RICO", "2022-01-03")] == (18, "weekly", 1)
    assert got[("SWITZERLAND", "2019-12-30")] == (10, "weekly", 1)                # ISO reading of 202001
    assert got[("SWITZERLAND", "2020-12-28")] == (99, "weekly", 1)                # ISO week 53 kept
    assert got[("BULGARIA", "2022-01-03")] == (12, "weekly", 1)


def test_numeric_json_tokens_read_as_text(spark, tmp_path):
    p = write(tmp_path / "ch_num.json", json.dumps([
        {"geoRegion": "CH", "altersklasse_covid19": "all", "primary_hosp_reason": "covid", "date": 202001,
         "entries": 10},
        {"geoRegion": "CH", "altersklasse_covid19": "all", "primary_hosp_reason": "covid", "date": 202002,
         "entries": 12.0}]))
    raw = read_json_records(spark, p, NF.CH_RECORD)
    assert sorted((r["date"], r["entries"]) for r in raw.collect()) == [("202001", "10"), ("202002", "12.0")]
    assert tidy(normalize_source(raw, NF.switzerland("iso"))) == [("Switzerland", "2019-12-30", 10, None),
                                                                 ("Switzerland", "2020-01-06", 12, None)]


def test_normalize_with_quarantine_default_staging(spark, tmp_path):
    from hebdo.plans.normalize import normalize_with_quarantine
    p = write(tmp_path / "dk_bad3.csv", "Dato,Total\n2022-01-03,40\nnot a date,3\n")
    valid, bad = normalize_with_quarantine(read_csv_text(spark, p), NF.DENMARK)
    assert tidy(valid) == [("Denmark", "2022-01-03", 40, None)]
    assert [r["date_issue"] for r in bad.collect()] == ["unparsed"]


def test_command_line_explain(spark, landed, capsys):
    from hebdo.__main__ import main
    main(["current", "--nz", landed.nz, "--cdc", landed.cdc, "--explain"])
    out = capsys.readouterr().out
    assert "Physical Plan" in out and "SortAggregate" in out


def test_archived_csv_keeps_reference_columns(spark, landed, tmp_path):
    from hebdo.__main__ import main
    out = tmp_path / "arch_csv"
    main(["archived", "--denmark", landed.denmark, "--reference-places", landed.reference_places,
          "--latest-week", "keep", "--csv", str(out)])
    text = next(p for p in out.iterdir() if p.name.endswith(".csv")).read_text().splitlines()
    assert text[0] == ("country,iso_year,iso_week_number,epiweek,freq,freq_time,new_hospitalization,new_icu,"
                       "WHO_REGION,ISO_3_CODE")
    assert text[1] == "DENMARK,2022,1,2022-01-03,daily,2,81,,EURO,DNK"


def test_command_line_named_csv(spark, landed, tmp_path):
    from hebdo.__main__ import main
    target = tmp_path / "data" / "clean" / "historical_clean_data.csv"
    main(["current", "--nz", landed.nz, "--cdc", landed.cdc, "--csv-file", str(target)])
    text = target.read_text().splitlines()
    assert text[0].startswith("WHO_REGION,ISO_3_CODE,country,epiweek") and len(text) == 5
