import json

import pytest
from pyspark.sql import functions as F

from meterstar.operators import quality
from meterstar.plans.master import run_master
from meterstar.sources.catalog import ArtifactMissingError, Catalog
from meterstar.sources.contracts import FILES
from meterstar.sources.star import MissingFilesError, StarTables, load_star, typed


def found(df):
    return {r["name"]: r["n_rows"] for r in df.collect()}


def write_csv(tables: StarTables, folder):
    """Write each table as one CSV file, as the raw folder holds them."""
    folder.mkdir()
    for name, df in tables.items():
        df.toPandas().to_csv(folder / f"{FILES[name]}.csv", index=False)
    return str(folder)


def test_clean_star_has_no_findings(make_star):
    assert found(quality.validate(make_star())) == {}


def test_missing_column_is_named(make_star):
    star = make_star()
    findings = quality.validate(star.replace(fact=star.fact.drop("CostUSD", "LatencyMs")))
    row = findings.where("name = 'missing_columns_fact'").first()
    assert (row["n_rows"], row["detail"]) == (2, "2 required columns missing: CostUSD, LatencyMs")


def test_repeated_and_null_dimension_keys(make_star):
    region = [(1, "US", "US", 0.0), (1, "US", "US", 0.0), (None, "?", "?", 0.0), (None, "?", "?", 0.0)]
    assert found(quality.all_dimension_keys(make_star(region=region))) == {
        "null_primary_key_region": 2, "duplicate_primary_key_region": 4, "many_to_one_cardinality_region": 4,
    }


def test_orphan_and_null_foreign_keys_count_together(make_star):
    star = make_star([{}, {"ClientKey": 999}, {"ClientKey": None}, {"RegionKey": 7}])
    assert found(quality.referential_integrity(star)) == {
        "referential_integrity_ClientKey": 2, "referential_integrity_RegionKey": 1,
    }


def test_null_key_in_dimension_does_not_answer_a_null_key(make_star):
    star = make_star([{"RegionKey": None}], region=[(1, "US", "US", 0.0), (None, "?", "?", 0.0)])
    assert found(quality.referential_integrity(star)) == {"referential_integrity_RegionKey": 1}


def test_mixed_defects(make_star):
    star = make_star([{"ClientKey": -999}, {"TokensInput": -1}, {"UsageID": 9}, {"UsageID": 9}, {"UsageID": 9, "TimeKey": 1}])
    assert found(quality.validate(star)) == {
        "referential_integrity_ClientKey": 1, "negative_TokensInput": 1,
        "duplicate_fact_records": 2, "duplicate_fact_usage_ids": 3,
    }


def test_null_usage_ids_equal_each_other(make_star):
    star = make_star([{"UsageID": None}, {"UsageID": None}, {}])
    assert found(quality.duplicate_records(star.fact)) == {"duplicate_fact_records": 2, "duplicate_fact_usage_ids": 2}


def test_text_that_is_no_number_is_counted_not_fatal(make_star):
    star = make_star([{}, {}])
    fact = star.fact.withColumn("CostUSD", F.when(F.col("UsageID") == 1, "abc").otherwise("0.1"))
    dates = star["date"].withColumn("Date", F.lit("2025-13-45"))
    findings = found(quality.validate(star.replace(fact=fact, date=dates)))
    assert findings == {"invalid_type_fact_CostUSD": 1, "invalid_type_date_Date": 1}


def test_other_types_are_reported_by_name(make_star):
    star = make_star()
    bad = star.replace(region=star["region"].withColumn("RegionKey", F.current_date()))
    row = quality.wrong_types(bad["region"], {"RegionKey": "invalid_type_region_RegionKey"}).first()
    assert row["name"] == "invalid_type_region_RegionKey" and "date" in row["detail"]


def test_cost_outliers_are_a_warning_and_need_deviation(make_star):
    star = make_star([{"CostUSD": 1.0}] * 30 + [{"CostUSD": 100.0}])
    rows = quality.cost_outliers(star.fact).collect()
    assert [(r["severity"], r["n_rows"]) for r in rows] == [("warning", 1)]
    assert found(quality.cost_outliers(make_star([{"CostUSD": 1.0}] * 5).fact)) == {}
    assert found(quality.cost_outliers(make_star().fact)) == {}


def test_gate_lets_warnings_pass_and_names_critical_findings(spark):
    warning = spark.createDataFrame([("cost_outliers", "warning", 3, "3 values")], quality.FINDING_SCHEMA)
    quality.gate(warning)
    critical = spark.createDataFrame([("negative_CostUSD", "critical", 2, "2 negative values")], quality.FINDING_SCHEMA)
    with pytest.raises(quality.DataQualityError, match="negative_CostUSD: 2 negative values"):
        quality.gate(warning.unionByName(critical))


def test_report_is_one_nested_row(spark):
    rows = [("negative_CostUSD", "critical", 2, "2 negative values"), ("cost_outliers", "warning", 1, "1 value")]
    report = quality.quality_report(spark.createDataFrame(rows, quality.FINDING_SCHEMA), 10).first()
    assert report["fact_rows"] == 10 and report["finding_count"] == 2 and report["critical_failure"]
    assert {f["name"] for f in report["findings"]} == {"negative_CostUSD", "cost_outliers"}
    empty = quality.quality_report(spark.createDataFrame([], quality.FINDING_SCHEMA), 0).first()
    assert not empty["critical_failure"] and empty["findings"] == []


def test_missing_files_are_all_named(spark, tmp_path):
    with pytest.raises(MissingFilesError, match="Dim_Region.csv"):
        load_star(spark, str(tmp_path))


def test_blank_csv_cells_become_null(spark, make_star, tmp_path):
    star = make_star([{"SatisfactionScore": None}, {}])
    loaded = typed(load_star(spark, write_csv(star, tmp_path / "raw")))
    assert loaded.fact.where("SatisfactionScore IS NULL").count() == 1
    assert dict(loaded.fact.dtypes) == dict(star.fact.dtypes)


def test_pipeline_reports_before_it_stops(spark, make_star, tmp_path):
    raw = write_csv(make_star([{"CostUSD": -1.0}, {}]), tmp_path / "raw")
    out = str(tmp_path / "out")
    with pytest.raises(quality.DataQualityError, match="negative_CostUSD"):
        run_master(spark, raw, out)
    report = Catalog(spark, out).load("data quality report").first()
    assert report["critical_failure"] and report["fact_rows"] == 2
    with pytest.raises(ArtifactMissingError):
        Catalog(spark, out).load("usage data")
    with pytest.raises(KeyError):
        Catalog(spark, out).load("unknown")
    markdown = spark.read.text(f"{out}/processed/data_quality_report_markdown", wholetext=True).first()[0]
    assert "- Fact rows: 2" in markdown and "negative_CostUSD" in markdown
    assert json.loads(spark.read.text(Catalog(spark, out).path("data quality report")).first()[0])["finding_count"] == 1


def test_the_survey_counts_while_it_stores(make_star, spark):
    star = make_star([{"CostUSD": 1.0}] * 30 + [{"CostUSD": 100.0, "ClientKey": None}, {"TokensInput": -1, "SatisfactionScore": None}])
    for store in (True, False):
        got = quality.survey(star.fact, store)
        assert got.rows == 32 and {name: n for name, n, _ in got.findings} == {"null_ClientKey": 1, "negative_TokensInput": 1}
        assert got.missing["ClientKey"] == got.missing["SatisfactionScore"] == 1 and got.missing["CostUSD"] == 0
        costs = star.fact.agg(F.avg("CostUSD"), F.stddev_samp("CostUSD")).first()
        assert got.cost_limit == pytest.approx(costs[0] + 3 * costs[1])
        assert got.fact.count() == 32
    empty = quality.survey(star.fact.limit(0))
    assert empty.rows == 0 and empty.findings == [] and empty.cost_limit is None and empty.fact.count() == 0


def test_findings_are_those_of_the_single_checks(make_star):
    region = [(1, "US", "US", 0.0), (1, "US", "US", 0.0), (None, "?", "?", 0.0)]
    facts = [{"CostUSD": 1.0}] * 30 + [{"CostUSD": 100.0}, {"UsageID": 9}, {"UsageID": 9}, {"RegionKey": 5}, {"LatencyMs": -2.0, "ClientKey": None}]
    star = make_star(facts, region=region)
    star = star.replace(date=star["date"].withColumn("Date", F.lit("no day")), client=star["client"].withColumn("ClientKey", F.lit("x")))
    single = [quality.fact_columns(star.fact), quality.all_dimension_keys(star), quality.invalid_dates(star), quality.duplicate_records(star.fact),
              quality.referential_integrity(star), quality.cost_outliers(star.fact), quality.wrong_types(star["client"], {"ClientKey": "invalid_type_client_ClientKey"})]
    wanted = sorted(tuple(r) for df in single for r in df.collect())
    assert sorted(map(tuple, quality.validate(star).collect())) == wanted and len(wanted) > 8


def test_validation_reads_the_fact_once(make_star, spark, tmp_path):
    star = make_star([{}, {}, {"UsageID": 1}])
    path = str(tmp_path / "fact")
    star.fact.write.parquet(path)
    fact = spark.read.parquet(path)
    surveyed = quality.survey(fact)
    assert path not in str(surveyed.fact.inputFiles()) and len(surveyed.findings) == 0
    stored = set(surveyed.fact.inputFiles())
    read = set(quality.validate(star.replace(fact=fact), surveyed).inputFiles())
    assert not any(f.startswith(f"file://{path}") for f in read) and stored & read


def test_markdown_report(make_star, spark):
    findings = quality.validate(make_star([{"CostUSD": -1.0}, {}]))
    text = quality.markdown_report(quality.quality_report(findings, 1234)).first()["value"]
    assert "- Fact rows: 1,234\n- Dimension tables: 6\n- Checks with findings: 1\n- Critical findings: 1\n" in text
    assert text.endswith("- **negative_CostUSD** (critical): 1 negative values")
    clean = quality.markdown_report(quality.quality_report(findings.limit(0), 0)).first()["value"]
    assert clean.endswith("## Findings\n\nNo findings.")


def test_summary_counts(usage_star):
    rows = {(r["section"], r["item"]): r["value"] for r in quality.quality_summary(usage_star).collect()}
    fact = usage_star.fact.toPandas()
    assert rows["row_counts", "fact"] == 3000 and rows["duplicate_count", "fact"] == 0
    assert rows["missing_values", "SatisfactionScore"] == fact["SatisfactionScore"].isna().sum()
    for c in quality.MEASURES:
        q1, q3 = fact[c].quantile(0.25), fact[c].quantile(0.75)
        assert rows["outliers", c] == (fact[c] > q3 + 1.5 * (q3 - q1)).sum()
