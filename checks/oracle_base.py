"""The two sample stars as SQL, written independently of the Spark adapters."""

TIERS = """tiers(tier_key, segment, tier_name, rate, ship_quota, req_quota) AS (VALUES
  (1, 'AUTOMOBILE', 'Free', 1.5::DOUBLE, 100, 2000), (2, 'BUILDING', 'Starter', 1.3::DOUBLE, 150, 4000),
  (3, 'MACHINERY', 'Team', 1.2::DOUBLE, 200, 5000), (4, 'FURNITURE', 'Professional', 1.15::DOUBLE, 300, 6000),
  (5, 'HOUSEHOLD', 'Enterprise', 1.0::DOUBLE, 1000, 20000))"""

MODEL = """dim_model AS (
  SELECT p_partkey AS ModelKey, p_name AS ModelName, p_brand AS Provider,
    p_retailprice AS CostPer1kInput, p_retailprice * 1.5::DOUBLE AS CostPer1kOutput FROM part)"""

# Line items as usage.
SHIPMENTS = f"""{TIERS}, {MODEL},
first_order AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS OnboardingDate FROM orders GROUP BY 1),
usage AS (
  SELECT l_orderkey * 8 + l_linenumber AS UsageID,
    CAST(l_shipdate AS DATE) AS Date, strftime(l_shipdate, '%Y-%m') AS Month,
    CAST((l_partkey % 24) * 100 + l_suppkey % 60 AS INTEGER) AS TimeKey,
    o_custkey AS ClientKey, c_name AS ClientName, OnboardingDate,
    l_partkey AS ModelKey, ModelName, Provider, CostPer1kInput, CostPer1kOutput,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS FeatureKey, o_orderpriority AS FeatureName,
    o_orderpriority < '3' AS IsPremium,
    r_regionkey AS RegionKey, r_name AS RegionName,
    tier_key AS SubscriptionTierKey, tier_name AS TierName, ship_quota AS MonthlyQuotaTokens,
    rate AS OverageRateMultiplier,
    CAST(l_quantity AS BIGINT) AS TokensInput, CAST(l_quantity * l_linenumber AS BIGINT) AS TokensOutput,
    CAST(l_quantity * (1 + l_linenumber) AS BIGINT) AS TotalTokens,
    sqrt(l_extendedprice) * 5 AS LatencyMs,
    CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS CostUSD,
    CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS SuccessFlag,
    CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE + l_linenumber % 5 END AS SatisfactionScore,
    l_returnflag AS RequestType
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN tiers ON segment = c_mktsegment JOIN dim_model ON ModelKey = l_partkey
  JOIN first_order USING (o_custkey))"""

# Events as usage.
REQUESTS = f"""{TIERS}, {MODEL},
kinds(FeatureKey, FeatureName, IsPremium) AS (VALUES
  (1, 'click', false), (2, 'error', false), (3, 'purchase', true), (4, 'signup', true), (5, 'view', false)),
event_k AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events),
usage AS (
  SELECT event_id AS UsageID, CAST(ts AS DATE) AS Date, strftime(ts, '%Y-%m') AS Month,
    CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS DateKey,
    CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS TimeKey,
    user_id AS ClientKey, c_name AS ClientName,
    DATE '2023-06-01' + CAST(c_custkey * 37 % 240 AS INTEGER) AS OnboardingDate,
    k AS ModelKey, ModelName, Provider, CostPer1kInput, CostPer1kOutput,
    FeatureKey, FeatureName, IsPremium, r_regionkey AS RegionKey, r_name AS RegionName,
    tier_key AS SubscriptionTierKey, tier_name AS TierName, req_quota AS MonthlyQuotaTokens,
    rate AS OverageRateMultiplier,
    k AS TokensInput, CAST(floor(value) AS BIGINT) AS TokensOutput, CAST(k + floor(value) AS BIGINT) AS TotalTokens,
    value * 10 AS LatencyMs, CAST(value / 1000 AS DECIMAL(18, 6)) AS CostUSD,
    CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS SuccessFlag,
    CASE WHEN k % 3 = 0 THEN 1.0::DOUBLE + (k % 9) * 0.5::DOUBLE END AS SatisfactionScore,
    event_type AS RequestType
  FROM event_k JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN tiers ON segment = c_mktsegment JOIN dim_model ON ModelKey = k JOIN kinds ON FeatureName = event_type)"""


def shipments(query: str, *ctes: str) -> str:
    """``query`` over ``usage`` from line items, with extra CTEs."""
    return f"WITH {', '.join([SHIPMENTS, *ctes])} {query}"


def requests(query: str, *ctes: str) -> str:
    """``query`` over ``usage`` from events, with extra CTEs."""
    return f"WITH {', '.join([REQUESTS, *ctes])} {query}"
