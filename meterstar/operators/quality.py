"""Data-quality checks. Each returns findings: name, severity, n_rows, detail.

A finding appears only if it affects rows. ``survey`` reads the fact once: all
column checks are metrics of the pass that stores it. What needs groups then reads a few stored columns:
keys and costs together, ids, and the rows of repeated ids. Each dimension is read once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators.ranking import tukey_fences
from meterstar.session import materialise
from meterstar.sources.contracts import (
    DATE_COLUMNS,
    DIMENSION_KEYS,
    FACT,
    NON_NEGATIVE_FACT_COLUMNS,
    NOT_NULL_FACT_COLUMNS,
    NUMERIC_FACT_COLUMNS,
    SCHEMAS,
    contract,
)
from meterstar.sources.star import StarTables

FINDING_SCHEMA = "name string, severity string, n_rows bigint, detail string"
WARNING_FINDINGS = ("cost_outliers",)
MEASURES = ("CostUSD", "TotalTokens", "LatencyMs")


# Texts of the findings, each after its number of rows.
NOT_NUMERIC = "values are not numeric"
NULL_KEYS = "null {key} values"
DUPLICATE_KEYS = "rows have duplicate {key} values"
NOT_MANY_TO_ONE = "rows prevent a many-to-one join on {key}"
NOT_DATES = "values are not valid dates"
NULL_VALUES = "null values"
DUPLICATE_RECORDS = "rows are part of duplicate fact records"
UNKNOWN_KEYS = "fact rows reference unknown dimension keys"
NEGATIVE_VALUES = "negative values"
COST_OUTLIERS = "values exceed mean + 3 standard deviations"


class DataQualityError(ValueError):
    """Source data cannot safely be enriched."""


def severity(name: Column) -> Column:
    """Everything but a cost outlier makes enrichment untrustworthy."""
    return F.when(name.isin(*WARNING_FINDINGS), "warning").otherwise("critical")


def _findings(df: DataFrame, name: Column, rows: Column, detail: Column) -> DataFrame:
    return df.select(
        name.alias("name"), severity(name).alias("severity"), rows.cast("bigint").alias("n_rows"), detail.alias("detail")
    )


def _from_counts(counts: DataFrame, details: Mapping[str, str]) -> DataFrame:
    """Turn a one-row frame of counts (one column per finding) into findings."""
    long = counts.select(F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.coalesce(F.col(f"`{name}`"), F.lit(0)).cast("bigint").alias("n"),
            F.lit(detail).alias("text"),
        )
        for name, detail in details.items()
    ])).alias("f")).select("f.*").where("n > 0")
    return _findings(long, F.col("name"), F.col("n"), F.concat(F.col("n").cast("string"), F.lit(" "), F.col("text")))


def _fixed(spark: SparkSession, rows: list[tuple[str, int, str]]) -> DataFrame:
    out = spark.createDataFrame(rows, "name string, n_rows bigint, detail string")
    return _findings(out, F.col("name"), F.col("n_rows"), F.col("detail"))


def missing_columns(tables: StarTables) -> DataFrame:
    """Required columns that a table lacks; answered from the schemas alone."""
    rows = []
    for name in SCHEMAS:
        missing = sorted(set(contract(name).columns) - set(tables[name].columns))
        if missing:
            text = f"{len(missing)} required columns missing: {', '.join(missing)}"
            rows.append((f"missing_columns_{name}", len(missing), text))
    return _fixed(tables.fact.sparkSession, rows)


def _is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def _present(c: str, data_type: T.DataType) -> Column:
    column = F.col(f"`{c}`")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


Checks = tuple[list[Column], dict[str, str]]  # counting columns, and the text of each finding


def _type_checks(df: DataFrame, wanted: Mapping[str, str]) -> tuple[Checks, list[tuple[str, int, str]]]:
    """Checks that text columns hold numbers, and findings for columns of other types."""
    types = {f.name: f.dataType for f in df.schema}
    counts, details, fixed = [], {}, []
    for c, name in wanted.items():
        if c not in types:
            continue
        if isinstance(types[c], T.StringType):
            bad = F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()
            counts.append(F.count_if(bad).alias(name))
            details[name] = NOT_NUMERIC
        elif not _is_number(types[c]):
            fixed.append((name, 1, f"expected numeric data, found {types[c].simpleString()}"))
    return (counts, details), fixed


def _null_checks(fact: DataFrame) -> Checks:
    types = {f.name: f.dataType for f in fact.schema}
    columns = [c for c in NOT_NULL_FACT_COLUMNS if c in types]
    return (
        [F.count_if(~_present(c, types[c])).alias(f"null_{c}") for c in columns],
        {f"null_{c}": NULL_VALUES for c in columns},
    )


def _negative_checks(fact: DataFrame) -> Checks:
    types = {f.name: f.dataType for f in fact.schema}
    columns = [c for c in NON_NEGATIVE_FACT_COLUMNS if c in types]

    def number(c: str) -> Column:
        return F.col(c).try_cast("double") if isinstance(types[c], T.StringType) else F.col(c)

    return (
        [F.count_if(number(c) < 0).alias(f"negative_{c}") for c in columns],
        {f"negative_{c}": NEGATIVE_VALUES for c in columns},
    )


def _run(df: DataFrame, *checks: Checks) -> DataFrame:
    """Run several checks in one aggregate over ``df``."""
    counts = [c for columns, _ in checks for c in columns]
    details = {name: text for _, texts in checks for name, text in texts.items()}
    return _from_counts(df.agg(*counts), details) if counts else _fixed(df.sparkSession, [])


FACT_TYPES = {c: f"invalid_type_fact_{c}" for c in NUMERIC_FACT_COLUMNS}


def wrong_types(df: DataFrame, wanted: Mapping[str, str] = FACT_TYPES) -> DataFrame:
    """Columns that should be numeric: text that is no number, or another type."""
    checks, fixed = _type_checks(df, wanted)
    return _run(df, checks).unionByName(_fixed(df.sparkSession, fixed))


def null_values(fact: DataFrame) -> DataFrame:
    """Missing values in the columns that must be filled."""
    return _run(fact, _null_checks(fact))


def negative_values(fact: DataFrame) -> DataFrame:
    """Measures below zero."""
    return _run(fact, _negative_checks(fact))


@dataclass
class Survey:
    """A fact and what one pass over it found."""

    fact: DataFrame
    rows: int
    findings: list[tuple[str, int, str]]    # name, rows, detail
    missing: dict[str, int]                 # missing values by column
    cost_limit: float | None                # mean plus deviations; None if costs don't deviate


def _cost(fact: DataFrame) -> Column:
    """Costs as doubles; text that is no number and NaN are missing."""
    cost = F.col("CostUSD").try_cast("double") if isinstance(fact.schema["CostUSD"].dataType, T.StringType) else F.col("CostUSD").cast("double")
    return F.when(~F.isnan(cost), cost)


def survey(fact: DataFrame, store: bool = True, deviations: float = 3) -> Survey:
    """Count rows, wrong types, missing and negative values and the spread of costs, all in one pass.

    With ``store`` the pass is the one that writes the fact to the shared folder, where later checks read single columns, so
    the counts cost no pass of their own. A fact that already lies stored by column needs no copy: then
    the pass is one aggregate.
    """
    (columns, texts), fixed = _type_checks(fact, FACT_TYPES)
    for more, details in (_null_checks(fact), _negative_checks(fact)):
        columns, texts = columns + more, {**texts, **details}
    metrics = [F.count(F.lit(1)).alias("rows"), *columns,
               *[F.count_if(~_present(f.name, f.dataType)).alias(f"missing {f.name}") for f in fact.schema]]
    if "CostUSD" in fact.columns:
        metrics += [F.avg(_cost(fact)).alias("mean cost"), F.stddev_samp(_cost(fact)).alias("cost deviation")]
    if store:
        seen = Observation()
        stored = materialise(fact.observe(seen, *metrics))
        got = seen.get
    else:
        stored, got = fact, fact.agg(*metrics).first().asDict()
    counted = [(name, got.get(name) or 0, text) for name, text in texts.items()]
    deviation = got.get("cost deviation")
    return Survey(
        stored, got.get("rows") or 0, [*fixed, *[(name, n, f"{n} {text}") for name, n, text in counted if n]],
        {f.name: got.get(f"missing {f.name}") or 0 for f in fact.schema},
        got["mean cost"] + deviations * deviation if deviation else None,
    )


def fact_columns(fact: DataFrame) -> DataFrame:
    """Types, missing values and negative measures of the fact in one pass."""
    return _fixed(fact.sparkSession, survey(fact, store=False).findings)


def dimension_keys(dimension: DataFrame, table: str, key: str) -> DataFrame:
    """Null and repeated dimension keys; all rows of a repeated key count, and NULLs equal each other."""
    groups = dimension.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")))
    return _from_counts(
        groups.agg(
            F.sum(F.when(F.col("k").isNull(), F.col("n"))).alias(f"null_primary_key_{table}"),
            repeated.alias(f"duplicate_primary_key_{table}"),
            repeated.alias(f"many_to_one_cardinality_{table}"),
        ),
        {
            f"null_primary_key_{table}": NULL_KEYS.format(key=key),
            f"duplicate_primary_key_{table}": DUPLICATE_KEYS.format(key=key),
            f"many_to_one_cardinality_{table}": NOT_MANY_TO_ONE.format(key=key),
        },
    )


def all_dimension_keys(tables: StarTables) -> DataFrame:
    """``dimension_keys`` over every dimension that has its key column."""
    parts = [dimension_keys(tables[d], d, k) for d, k in DIMENSION_KEYS.items() if k in tables[d].columns]
    return reduce(DataFrame.unionByName, parts)


def _bad_dates(df: DataFrame, c: str) -> Column:
    column = F.col(c)
    return (column.try_cast("timestamp") if isinstance(df.schema[c].dataType, T.StringType) else column).isNull()


def dimension_findings(dimension: DataFrame, table: str, key: str) -> DataFrame:
    """Key types, null and repeated keys and unreadable dates of one dimension, in one pass."""
    (types, texts), fixed = _type_checks(dimension, {key: f"invalid_type_{table}_{key}"})
    counts, details = [*types], {**texts}
    date = DATE_COLUMNS.get(table)
    if date in dimension.columns:
        name = f"invalid_type_{table}_{date}"
        counts.append(F.count_if(_bad_dates(dimension, date)).alias(name))
        details[name] = NOT_DATES
    fixed = _fixed(dimension.sparkSession, fixed)
    if key not in dimension.columns:
        return fixed.unionByName(_run(dimension, (counts, details)))
    groups = dimension.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"), *counts)
    repeated = F.sum(F.when(F.col("_n") > 1, F.col("_n")))
    totals = groups.agg(
        F.sum(F.when(F.col("_k").isNull(), F.col("_n"))).alias(f"null_primary_key_{table}"),
        repeated.alias(f"duplicate_primary_key_{table}"), repeated.alias(f"many_to_one_cardinality_{table}"),
        *[F.sum(f"`{name}`").alias(name) for name in details],
    )
    return fixed.unionByName(_from_counts(totals, {
        f"null_primary_key_{table}": NULL_KEYS.format(key=key), f"duplicate_primary_key_{table}": DUPLICATE_KEYS.format(key=key),
        f"many_to_one_cardinality_{table}": NOT_MANY_TO_ONE.format(key=key), **details,
    }))


def invalid_dates(tables: StarTables) -> DataFrame:
    """Dates that are missing or cannot be read."""
    parts = []
    for table, c in DATE_COLUMNS.items():
        if c in tables[table].columns:
            name = f"invalid_type_{table}_{c}"
            counts = tables[table].agg(F.count_if(_bad_dates(tables[table], c)).alias(name))
            parts.append(_from_counts(counts, {name: NOT_DATES}))
    return reduce(DataFrame.unionByName, parts, _fixed(tables.fact.sparkSession, []))


def _record_groups(fact: DataFrame) -> DataFrame:
    """The distinct records among the rows that share a UsageID, with their counts as ``_n``.

    Equal records share their UsageID, so only rows with a repeated id are
    compared in full; the fact itself is shuffled by the id column alone.
    """
    repeated = fact.groupBy("UsageID").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = repeated.select(F.col("UsageID").alias("_id"))
    suspects = fact.join(keys, F.col("UsageID").eqNullSafe(F.col("_id")), "left_semi")
    return suspects.groupBy(*[f"`{c}`" for c in fact.columns]).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_records(fact: DataFrame) -> DataFrame:
    """Rows in groups of equal records, and rows that share a UsageID; both from the same groups."""
    if "UsageID" not in fact.columns:
        return _fixed(fact.sparkSession, [])
    counts = _record_groups(fact).agg(
        F.sum(F.when(F.col("_n") > 1, F.col("_n"))).alias("duplicate_fact_records"), F.sum("_n").alias("duplicate_fact_usage_ids"))
    return _from_counts(counts, {
        "duplicate_fact_records": DUPLICATE_RECORDS, "duplicate_fact_usage_ids": DUPLICATE_KEYS.format(key="UsageID"),
    })


_OUTLIER = "cost outlier"


def _used_keys(tables: StarTables, dimensions: Mapping[str, str], limit: float | None = None) -> DataFrame:
    """``fk, key, n``: the fact's distinct key values with their counts, and with a ``limit`` the costs above it, in one pass."""
    usable = {d: k for d, k in dimensions.items() if k in tables.fact.columns and k in tables[d].columns}
    cells = [F.struct(F.lit(k).alias("fk"), F.col(k).try_cast("bigint").alias("key")) for k in usable.values()]
    if limit is not None:
        above = _cost(tables.fact) > F.lit(limit)
        cells.append(F.struct(F.when(above, F.lit(_OUTLIER)).alias("fk"), F.lit(None).cast("bigint").alias("key")))
    used = tables.fact.select(F.explode(F.array(*cells)).alias("u")).select("u.*") if cells else tables.fact.select(
        F.lit(None).cast("string").alias("fk"), F.lit(None).cast("bigint").alias("key"))
    return used.where("fk IS NOT NULL").groupBy("fk", "key").agg(F.count(F.lit(1)).alias("n"))


def _unanswered(used: DataFrame, tables: StarTables, dimensions: Mapping[str, str]) -> DataFrame:
    known = reduce(DataFrame.unionByName, [
        tables[d].select(F.lit(k).alias("fk"), F.col(k).try_cast("bigint").alias("key")) for d, k in dimensions.items() if k in tables[d].columns
    ])
    return used.join(known, ["fk", "key"], "left_anti").groupBy("fk").agg(F.sum("n").alias("n"))


def orphan_keys(tables: StarTables, dimensions: Mapping[str, str] = DIMENSION_KEYS) -> DataFrame:
    """Fact rows per foreign key that no dimension row answers: columns fk, n. A NULL key is an orphan.

    The fact is first reduced to its distinct key values with their counts, so
    only those meet the dimensions, however hot a key is.
    """
    return _unanswered(_used_keys(tables, dimensions), tables, dimensions)


def _orphan_findings(orphans: DataFrame) -> DataFrame:
    text = F.concat(F.col("n").cast("string"), F.lit(f" {UNKNOWN_KEYS}"))
    return _findings(orphans, F.concat(F.lit("referential_integrity_"), F.col("fk")), F.col("n"), text)


def referential_integrity(tables: StarTables) -> DataFrame:
    """Findings for foreign keys without a dimension row."""
    return _orphan_findings(orphan_keys(tables))


def cost_outliers(fact: DataFrame, deviations: float = 3) -> DataFrame:
    """Costs above the mean plus three sample deviations; only if there is any deviation."""
    if "CostUSD" not in fact.columns:
        return _fixed(fact.sparkSession, [])
    cost = fact.select(_cost(fact).alias("c"))
    deviation = F.stddev_samp("c")
    limit = cost.agg(F.when(deviation > 0, F.avg("c") + deviations * deviation))
    counts = cost.agg(F.count_if(F.col("c") > limit.scalar()).alias("cost_outliers"))
    return _from_counts(counts, {"cost_outliers": COST_OUTLIERS})


def validate(tables: StarTables, surveyed: Survey | None = None) -> DataFrame:
    """All checks together. The fact is read by ``survey``, which also gives the stored rows for the checks that need groups."""
    surveyed = surveyed or survey(tables.fact)
    stored = tables.replace(fact=surveyed.fact)
    used = materialise(_used_keys(stored, DIMENSION_KEYS, surveyed.cost_limit))
    outliers = used.where(F.col("fk") == _OUTLIER).agg(F.sum("n").alias("cost_outliers"))
    parts = [
        missing_columns(tables), _fixed(tables.fact.sparkSession, surveyed.findings),
        *[dimension_findings(tables[d], d, k) for d, k in DIMENSION_KEYS.items()], duplicate_records(surveyed.fact),
        _orphan_findings(_unanswered(used.where(F.col("fk") != _OUTLIER), tables, DIMENSION_KEYS)),
        _from_counts(outliers, {"cost_outliers": COST_OUTLIERS}),
    ]
    return reduce(DataFrame.unionByName, parts)


def gate(findings: DataFrame) -> None:
    """Raise if any finding is critical. Findings are as few as the checks, so they are collected."""
    critical = findings.where("severity = 'critical'").select("name", "detail").collect()
    if critical:
        listed = "; ".join(f"{r['name']}: {r['detail']}" for r in critical)
        raise DataQualityError(f"Critical data quality validation failed: {listed}")


def quality_report(findings: DataFrame, fact_rows: int, dimension_tables: int = len(DIMENSION_KEYS)) -> DataFrame:
    """The machine-readable report as one nested row."""
    detail = F.struct("name", "severity", F.array("detail").alias("details"))
    return findings.agg(
        F.lit(fact_rows).cast("bigint").alias("fact_rows"),
        F.lit(dimension_tables).alias("dimension_tables"),
        F.count(F.lit(1)).alias("finding_count"),
        F.coalesce(F.bool_or(F.col("severity") == "critical"), F.lit(False)).alias("critical_failure"),
        F.sort_array(F.collect_list(detail)).alias("findings"),
    )


def quality_summary(tables: StarTables, surveyed: Survey | None = None) -> DataFrame:
    """Row counts, missing values, repeated rows, orphan keys and upper outliers: section, item, value.

    Counts of the fact come from its survey; the rest reads the stored columns it needs.
    """
    surveyed = surveyed or survey(tables.fact)
    fact = surveyed.fact
    spark = fact.sparkSession

    def known(name: str, values: Mapping[str, int]) -> DataFrame:
        return spark.createDataFrame([(name, item, int(n)) for item, n in values.items()], "section string, item string, value bigint")

    def section(df: DataFrame, name: str, item: str) -> DataFrame:
        return df.select(F.lit(name).alias("section"), F.lit(item).alias("item"), F.col("n").cast("bigint").alias("value"))

    rows = [
        section(df.agg(F.count(F.lit(1)).alias("n")), "row_counts", name) for name, df in tables.items() if name not in ("date", FACT)
    ]
    groups = _record_groups(fact)
    surplus = groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n"))
    keyed = {d: k for d, k in DIMENSION_KEYS.items() if d != "date"}
    orphans = orphan_keys(tables.replace(fact=fact), keyed).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    fences = tukey_fences(fact, MEASURES)
    above = fact.agg(*[F.count_if(F.col(c).cast("double") > F.lit(fences[c])).alias(c) for c in MEASURES]).first().asDict()
    parts = [
        known("row_counts", {FACT: surveyed.rows}), *rows, known("missing_values", {c: n for c, n in surveyed.missing.items() if n}),
        section(surplus, "duplicate_count", FACT), section(orphans, "foreign_key_violations", FACT), known("outliers", above),
    ]
    return reduce(DataFrame.unionByName, parts)


def markdown_report(report: DataFrame) -> DataFrame:
    """The one-row ``quality_report`` as Markdown, one text in column ``value``: a summary, then a line for each finding."""
    number = lambda c: F.format_number(c, 0)
    critical = F.size(F.filter("findings", lambda f: f["severity"] == "critical"))
    summary = F.array(
        F.lit("# Data quality report"), F.lit(""), F.lit("## Summary"), F.lit(""),
        F.concat(F.lit("- Fact rows: "), number(F.col("fact_rows"))),
        F.concat(F.lit("- Dimension tables: "), number(F.col("dimension_tables"))),
        F.concat(F.lit("- Checks with findings: "), number(F.col("finding_count"))),
        F.concat(F.lit("- Critical findings: "), number(critical)), F.lit(""), F.lit("## Findings"), F.lit(""),
    )
    lines = F.transform("findings", lambda f: F.concat(
        F.lit("- **"), f["name"], F.lit("** ("), f["severity"], F.lit("): "), F.array_join(f["details"], "; ")))
    found = F.when(F.size("findings") == 0, F.array(F.lit("No findings."))).otherwise(lines)
    return report.select(F.array_join(F.concat(summary, found), "\n").alias("value"))
