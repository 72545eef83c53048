"""Build the enriched master: load, check, enrich, aggregate, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterstar.operators import quality
from meterstar.operators.aggregates import build_aggregates
from meterstar.operators.enrich import enrich
from meterstar.session import materialise
from meterstar.sources.catalog import Catalog
from meterstar.sources.sinks import write_by_month, write_report, write_table, write_text
from meterstar.sources.star import StarTables, load_star, typed

ROW_COUNT_CHANGED = "fact_row_count_changed_after_enrichment"


def run_master(spark: SparkSession, raw_dir: str, out_dir: str, file_format: str = "csv") -> DataFrame:
    """From the seven raw tables to the master and the four reporting tables.

    The quality reports are written before a critical finding stops the job. A
    CSV fact is first stored by column, as text, and checked while it is: the other checks read a few stored columns each.
    """
    return build_master(load_star(spark, raw_dir, file_format), out_dir, store=file_format == "csv")


def build_master(tables: StarTables, out_dir: str, store: bool = False) -> DataFrame:
    """``run_master`` for tables already loaded; ``store`` the fact if it does not lie by column. Returns the master as written."""
    spark = tables.fact.sparkSession
    catalog = Catalog(spark, out_dir)
    surveyed = quality.survey(tables.fact, store)
    tables = tables.replace(fact=surveyed.fact)
    findings = materialise(quality.validate(tables, surveyed))
    fact_rows = surveyed.rows
    report_path = catalog.path("data quality report")

    def report(found: DataFrame) -> None:
        row = quality.quality_report(found, fact_rows)
        write_report(row, report_path)
        write_text(quality.markdown_report(row), f"{out_dir.rstrip('/')}/processed/data_quality_report_markdown")

    report(findings)
    quality.gate(findings)

    clean = typed(tables)
    counted = Observation("master")
    # The checks above proved the dimension keys unique.
    master = enrich(clean, validate=False).observe(counted, F.count(F.lit(1)).alias("rows"))
    master_path = catalog.path("enriched master")
    write_by_month(master, master_path)
    written = counted.get["rows"]
    if written != fact_rows:
        detail = f"expected {fact_rows} rows, found {written}"
        extra = spark.createDataFrame([(ROW_COUNT_CHANGED, "critical", abs(written - fact_rows), detail)],
                                      quality.FINDING_SCHEMA)
        report(findings.unionByName(extra))
        raise quality.DataQualityError(detail)
    master = spark.read.parquet(master_path)
    for name, table in build_aggregates(master).items():
        write_table(table, f"{out_dir.rstrip('/')}/processed/{name}")
    for name, dimension in clean.dimensions.items():
        if name != "date":
            write_table(dimension, catalog.path(f"{name} dimension"))
    return master
