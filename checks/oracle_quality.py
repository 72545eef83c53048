"""SQL counterparts of the quality checks, on a star with planted defects."""

from checks.oracle_base import SHIPMENTS, requests

# Line items with defects: every seventh line has no client, client keys past
# the customers, negative costs, and ids that repeat by nature.
DEFECTS = """defect AS (
  SELECT l_orderkey * 8 + l_linenumber AS UsageID,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -o_custkey - 1 ELSE o_custkey END AS ClientKey,
    l_partkey + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS ModelKey,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 1 AS FeatureKey,
    CAST(l_quantity - 2 AS BIGINT) AS TokensInput, CAST(l_quantity AS BIGINT) AS TokensOutput,
    CASE WHEN l_quantity > 48 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS TotalTokens,
    l_extendedprice / 50 - 20 AS LatencyMs,
    power(l_extendedprice / 10000, 8) - CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS CostUSD,
    CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS SuccessFlag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
"""


def findings(*selects: str) -> str:
    body = " UNION ALL ".join(selects)
    return f"""WITH {DEFECTS} f(name, n, text) AS ({body})
      SELECT name, CASE WHEN name = 'cost_outliers' THEN 'warning' ELSE 'critical' END AS severity,
        CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) || ' ' || text AS detail FROM f WHERE n > 0"""


NULLABLE = ("UsageID", "ClientKey", "ModelKey", "FeatureKey", "TokensInput", "TokensOutput", "TotalTokens",
            "LatencyMs", "CostUSD", "SuccessFlag")
NEGATIVE = ("TokensInput", "TokensOutput", "TotalTokens", "LatencyMs", "CostUSD")
NULLS = [f"SELECT 'null_{c}', count(*) - count({c}), 'null values' FROM defect" for c in NULLABLE]
NEGATIVES = [f"SELECT 'negative_{c}', count(*) FILTER ({c} < 0), 'negative values' FROM defect" for c in NEGATIVE]
DUPLICATE_IDS = """SELECT 'duplicate_fact_usage_ids', sum(n), 'rows have duplicate UsageID values'
  FROM (SELECT count(*) AS n FROM defect GROUP BY UsageID HAVING count(*) > 1)"""
MISSING = """SELECT 'missing_columns_fact', 6,
  'required columns missing: DateKey, RegionKey, RequestType, SatisfactionScore, SubscriptionTierKey, TimeKey'"""
BAD_DATES = """SELECT 'invalid_type_client_OnboardingDate', count(*), 'values are not valid dates'
  FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
DUPLICATES = """SELECT 'duplicate_fact_records', sum(n), 'rows are part of duplicate fact records'
  FROM (SELECT count(*) AS n FROM defect GROUP BY UsageID, ClientKey, ModelKey, FeatureKey, TokensInput, TokensOutput,
    TotalTokens, LatencyMs, CostUSD, SuccessFlag HAVING count(*) > 1)"""
ORPHANS = [
    f"""SELECT 'referential_integrity_{fk}', count(*), 'fact rows reference unknown dimension keys'
        FROM defect WHERE {fk} IS NULL OR NOT EXISTS (SELECT 1 FROM {table} WHERE {key} = {fk})"""
    for fk, table, key in (("ClientKey", "customer", "c_custkey"), ("ModelKey", "part", "p_partkey"))
] + ["""SELECT 'referential_integrity_FeatureKey', count(*), 'fact rows reference unknown dimension keys'
        FROM defect WHERE FeatureKey NOT BETWEEN 1 AND 5"""]
OUTLIERS = """SELECT 'cost_outliers', count(*), 'values exceed mean + 3 standard deviations' FROM defect
  WHERE CostUSD > (SELECT avg(CostUSD) + 3 * stddev_samp(CostUSD) FROM defect)"""

# Keys of every dimension, folded in pairs; every fifth is missing.
ALL_KEYS = """WITH days AS (SELECT unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS d
    FROM lineitem),
  source(t, name, k) AS (
    SELECT 'date', 'DateKey', CAST(strftime(d, '%Y%m%d') AS BIGINT) FROM days
    UNION ALL SELECT 'client', 'ClientKey', c_custkey FROM customer UNION ALL SELECT 'model', 'ModelKey', p_partkey FROM part
    UNION ALL SELECT 'feature', 'FeatureKey', range FROM range(1, 6) UNION ALL SELECT 'region', 'RegionKey', r_regionkey FROM region
    UNION ALL SELECT 'subscription', 'SubscriptionTierKey', range FROM range(1, 6)),
  g AS (SELECT t, name, CASE WHEN k % 5 <> 1 THEN k - k % 2 END AS k, count(*) AS n FROM source GROUP BY ALL),
  f(name, n, text) AS (
    SELECT 'null_primary_key_' || t, sum(n) FILTER (k IS NULL), 'null ' || name || ' values' FROM g GROUP BY t, name
    UNION ALL SELECT 'duplicate_primary_key_' || t, sum(n) FILTER (n > 1), 'rows have duplicate ' || name || ' values' FROM g GROUP BY t, name
    UNION ALL SELECT 'many_to_one_cardinality_' || t, sum(n) FILTER (n > 1),
      'rows prevent a many-to-one join on ' || name FROM g GROUP BY t, name)
  SELECT name, 'critical' AS severity, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) || ' ' || text AS detail
  FROM f WHERE n > 0"""

# Dimension keys: nations keyed by their region repeat; part sizes above 45 become NULL.
KEYS = """WITH part_key AS (SELECT CASE WHEN p_size <= 45 THEN p_size END AS k, count(*) AS n FROM part GROUP BY 1),
  f(name, n, text) AS (
    SELECT 'null_primary_key_model', sum(n) FILTER (k IS NULL), 'null ModelKey values' FROM part_key
    UNION ALL SELECT 'duplicate_primary_key_model', sum(n) FILTER (n > 1), 'rows have duplicate ModelKey values' FROM part_key
    UNION ALL SELECT 'many_to_one_cardinality_model', sum(n) FILTER (n > 1),
      'rows prevent a many-to-one join on ModelKey' FROM part_key)
  SELECT name, 'critical' AS severity, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) || ' ' || text AS detail
  FROM f WHERE n > 0"""

# Line items folded to three columns, so that whole records repeat.
FOLDED = """WITH folded AS (SELECT l_orderkey % 9973 AS UsageID, l_linenumber AS TimeKey, l_returnflag AS RequestType FROM lineitem),
  f(name, n, text) AS (
    SELECT 'duplicate_fact_records', sum(n), 'rows are part of duplicate fact records'
    FROM (SELECT count(*) AS n FROM folded GROUP BY UsageID, TimeKey, RequestType HAVING count(*) > 1)
    UNION ALL SELECT 'duplicate_fact_usage_ids', sum(n), 'rows have duplicate UsageID values'
    FROM (SELECT count(*) AS n FROM folded GROUP BY UsageID HAVING count(*) > 1))
  SELECT name, 'critical' AS severity, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) || ' ' || text AS detail
  FROM f WHERE n > 0"""

SUMMARY = requests(
    """SELECT section, item, CAST(value AS BIGINT) AS value FROM s""",
    """s(section, item, value) AS (
      SELECT 'row_counts', 'fact', count(*) FROM events
      UNION ALL SELECT 'row_counts', 'client', count(*) FROM customer
      UNION ALL SELECT 'row_counts', 'model', count(*) FROM part
      UNION ALL SELECT 'row_counts', 'feature', 5 UNION ALL SELECT 'row_counts', 'subscription', 5
      UNION ALL SELECT 'row_counts', 'region', count(*) FROM region
      UNION ALL SELECT 'missing_values', 'SatisfactionScore', count(*) - count(SatisfactionScore) FROM usage
      UNION ALL SELECT 'duplicate_count', 'fact', (SELECT count(*) FROM usage) - (SELECT count(*) FROM (SELECT DISTINCT * FROM usage))
      UNION ALL SELECT 'foreign_key_violations', 'fact', 0
      UNION ALL SELECT 'outliers', 'CostUSD', count(*) FROM usage WHERE CAST(CostUSD AS DOUBLE) >
        (SELECT 2.5 * quantile_cont(CAST(CostUSD AS DOUBLE), 0.75) - 1.5 * quantile_cont(CAST(CostUSD AS DOUBLE), 0.25) FROM usage)
      UNION ALL SELECT 'outliers', 'TotalTokens', count(*) FROM usage WHERE TotalTokens >
        (SELECT 2.5 * quantile_cont(TotalTokens, 0.75) - 1.5 * quantile_cont(TotalTokens, 0.25) FROM usage)
      UNION ALL SELECT 'outliers', 'LatencyMs', count(*) FROM usage WHERE LatencyMs >
        (SELECT 2.5 * quantile_cont(LatencyMs, 0.75) - 1.5 * quantile_cont(LatencyMs, 0.25) FROM usage))""",
)

ORACLES = {
    "dq4_dq5_dq6_dimension_keys": KEYS,
    "dq2_wrong_types": """SELECT 'invalid_type_fact_CostUSD' AS name, 'critical' AS severity, count(*) AS n_rows,
        count(*) || ' values are not numeric' AS detail FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT 'invalid_type_fact_LatencyMs', 'critical', 1, 'expected numeric data, found timestamp_ntz' """,
    "dq7_invalid_dates": """SELECT * FROM (SELECT 'invalid_type_date_Date' AS name, 'critical' AS severity, count(*) AS n_rows,
          count(*) || ' values are not valid dates' AS detail FROM orders WHERE o_orderstatus <> 'O'
        UNION ALL SELECT 'invalid_type_client_OnboardingDate', 'critical', count(*), count(*) || ' values are not valid dates'
          FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) WHERE n_rows > 0""",
    "dq4_dq6_all_dimensions": ALL_KEYS,
    "dq8_nulls": findings(*NULLS),
    "dq9_dq10_duplicates": FOLDED,
    "dq10_duplicate_ids": findings(DUPLICATE_IDS),
    "dq11_referential": findings(*ORPHANS),
    "dq12_negative": findings(*NEGATIVES),
    "dq13_cost_outliers": findings(OUTLIERS),
    "dq16_row_conservation": "SELECT count(*) AS FactRows, count(*) AS EnrichedRows FROM events",
    "dq17_summary": SUMMARY,
    "dq_all_findings": findings(MISSING, BAD_DATES, DUPLICATES, *NULLS, *NEGATIVES, DUPLICATE_IDS, *ORPHANS, OUTLIERS),
}
