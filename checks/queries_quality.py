"""Registered: data-quality checks."""

from pyspark.sql import functions as F

from checks.registry import register
from meterstar.operators import enrich, quality
from meterstar.sources import samples
from meterstar.sources.contracts import DIMENSION_KEYS


@register("dq4_dq5_dq6_dimension_keys")
def _(spark, sf_dir):
    part = samples.table(spark, sf_dir, "part")
    sized = part.select(F.when(F.col("p_size") <= 45, F.col("p_size")).alias("ModelKey"))
    return quality.dimension_keys(sized, "model", "ModelKey")


@register("dq4_dq6_all_dimensions")
def _(spark, sf_dir):
    """Every dimension with keys that repeat and keys that are missing."""
    tables = samples.shipments(spark, sf_dir, place=False)
    folded = {
        name: tables[name].withColumn(key, F.when(F.col(key) % 5 != 1, F.col(key) - F.col(key) % 2).cast(tables[name].schema[key].dataType))
        for name, key in DIMENSION_KEYS.items()
    }
    return quality.all_dimension_keys(tables.replace(**folded))


@register("dq8_nulls")
def _(spark, sf_dir):
    return quality.null_values(samples.defective(spark, sf_dir).fact)


@register("dq9_dq10_duplicates")
def _(spark, sf_dir):
    folded = samples.fact_table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 9973).alias("UsageID"),
        F.col("l_linenumber").alias("TimeKey"),
        F.col("l_returnflag").alias("RequestType"),
    )
    return quality.duplicate_records(folded)


@register("dq10_duplicate_ids")
def _(spark, sf_dir):
    found = quality.duplicate_records(samples.defective(spark, sf_dir).fact)
    return found.where("name = 'duplicate_fact_usage_ids'")


@register("dq11_referential")
def _(spark, sf_dir):
    return quality.referential_integrity(samples.defective(spark, sf_dir))


@register("dq12_negative")
def _(spark, sf_dir):
    return quality.negative_values(samples.defective(spark, sf_dir).fact)


@register("dq13_cost_outliers")
def _(spark, sf_dir):
    return quality.cost_outliers(samples.defective(spark, sf_dir).fact)


@register("dq17_summary")
def _(spark, sf_dir):
    return quality.quality_summary(samples.requests(spark, sf_dir))


@register("dq_all_findings")
def _(spark, sf_dir):
    return quality.validate(samples.defective(spark, sf_dir))


@register("dq2_wrong_types")
def _(spark, sf_dir):
    item = samples.fact_table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).otherwise(F.col("l_quantity").cast("string"))
    return quality.wrong_types(item.select(text.alias("CostUSD"), F.col("l_shipdate").alias("LatencyMs")))


@register("dq7_invalid_dates")
def _(spark, sf_dir):
    order = samples.fact_table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "2025-13-45").when(
        F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("string"))
    star = samples.shipments(spark, sf_dir, place=False)
    return quality.invalid_dates(star.replace(date=order.select(text.alias("Date"))))


@register("dq16_row_conservation")
def _(spark, sf_dir):
    tables = samples.requests(spark, sf_dir)
    counted = tables.fact.agg(F.count(F.lit(1)).alias("FactRows"))
    enriched = enrich.enrich(tables).agg(F.count(F.lit(1)))
    return counted.withColumn("EnrichedRows", enriched.scalar())
