"""SQL counterparts of enrichment, reporting tables, filters and measures."""

from checks.oracle_base import requests, shipments

EFFICIENCY = "CASE WHEN TokensInput <> 0 THEN TokensOutput / CAST(TokensInput AS DOUBLE) ELSE 0 END"
DAYS = "date_diff('day', OnboardingDate, Date)"
THEORETICAL = "TokensInput / 1000.0::DOUBLE * CostPer1kInput + TokensOutput / 1000.0::DOUBLE * CostPer1kOutput"
RUNNING = """r AS (SELECT *, CAST(sum(TotalTokens) OVER (PARTITION BY ClientKey, Month
  ORDER BY Date, TimeKey, UsageID ROWS UNBOUNDED PRECEDING) AS BIGINT) AS MonthlyTokensUsed FROM usage)"""
QUOTA = f"""{RUNNING}, q AS (SELECT *, CAST(MonthlyTokensUsed AS DOUBLE) / nullif(MonthlyQuotaTokens, 0) * 100
  AS QuotaUtilizationPct FROM r)"""
VOLUME = """CAST(sum(CostUSD) AS DOUBLE) AS TotalCost, CAST(sum(TotalTokens) AS BIGINT) AS TotalTokens,
  count(UsageID) AS RequestCount, round(avg(LatencyMs), 6) AS AvgLatency,
  round(avg(SuccessFlag) * 100, 6) AS SuccessRate"""
MODELS = f"""m AS (SELECT ModelKey, ModelName, Provider, avg(LatencyMs) AS lat, avg(SuccessFlag) * 100 AS succ,
  avg(SatisfactionScore) AS sat, CAST(sum(CostUSD) AS DOUBLE) AS cost, count(*) AS n, avg({EFFICIENCY}) AS eff
  FROM usage GROUP BY ALL)"""
CLIENT_MONTH = f"""SELECT ClientKey, ClientName, Month, {VOLUME}, round(avg(SatisfactionScore), 6) AS AvgSatisfaction,
  count(DISTINCT ModelKey) AS UniqueModelsUsed,
  round(avg(CAST(IsPremium AS INTEGER)) * 100, 6) AS PremiumFeatureUsagePct
  FROM usage GROUP BY ClientKey, ClientName, Month"""
SCORES = """scores AS (SELECT ClientKey, round((1 - avg(SuccessFlag)) * 150, 2) AS ChurnRiskScore
  FROM usage GROUP BY 1 HAVING ClientKey % 10 <> 3)"""


def scaled(c: str, better: bool, label: str) -> str:
    lo, hi = f"min({c}) OVER ()", f"max({c}) OVER ()"
    value = f"CASE WHEN {lo} = {hi} THEN 0.5 ELSE ({c} - {lo}) / ({hi} - {lo}) END"
    return f'round({value if better else f"1 - ({value})"}, 6) AS "{label}"'


QUANTILES = " UNION ALL ".join(
    f"SELECT '{c}' AS measure, {p}::DOUBLE AS p, round(quantile_cont({c}, {p}), 6) AS quantile FROM lineitem"
    for c, ps in (("l_extendedprice", (0.25, 0.5, 0.75, 0.98)), ("l_quantity", (0.25, 0.5, 0.75))) for p in ps
)

ORACLES = {
    "s3_fact_view": requests(
        """SELECT UsageID, Date, Month, ClientName, ModelName, Provider, FeatureName, RegionName, TierName,
             CAST(MonthlyQuotaTokens AS BIGINT) AS MonthlyQuotaTokens, m AS MonthlyTokensUsed,
             round(m * 100.0::DOUBLE / nullif(MonthlyQuotaTokens, 0), 6) AS QuotaUtilizationPct
           FROM (SELECT *, CAST(sum(TotalTokens) OVER (PARTITION BY ClientKey, Month) AS BIGINT) AS m FROM usage)"""
    ),
    "e0_star_join": requests(
        """SELECT UsageID, Date, 'Q' || quarter(Date) AS Quarter, isodow(Date) >= 6 AS IsWeekend, ClientName, ModelName,
             FeatureName, IsPremium, RegionName, TierName FROM usage"""
    ),
    "e1_to_e13_derived": requests(
        f"""SELECT UsageID, round({EFFICIENCY}, 8) AS TokenEfficiencyRatio,
              CASE WHEN SuccessFlag = 1 THEN CAST(CostUSD AS DOUBLE) ELSE 0 END AS CostPerSuccessfulRequest,
              round({THEORETICAL}, 8) AS TheoreticalCostUSD,
              round(CAST(CostUSD AS DOUBLE) - ({THEORETICAL}), 8) AS CostVariance,
              CAST(CostUSD AS DOUBLE) - ({THEORETICAL}) > 0.005 AS IsOverBudget,
              TimeKey // 100 AS HourOfDay, TimeKey // 100 BETWEEN 9 AND 17 AS PeakHour,
              CASE WHEN LatencyMs < 400 THEN 'Fast' WHEN LatencyMs < 800 THEN 'Medium' ELSE 'Slow' END AS ResponseSpeedTier,
              CASE WHEN SatisfactionScore IS NULL THEN 'Not Rated' WHEN SatisfactionScore < 3.5 THEN 'Low(<3.5)'
                WHEN SatisfactionScore < 4.5 THEN 'Mid(3.5-4.4)' ELSE 'High(4.5-5.0)' END AS SatisfactionBucket,
              CAST({DAYS} AS INTEGER) AS DaysSinceOnboarding, {DAYS} BETWEEN 0 AND 7 AS IsFirstWeekClient,
              CASE WHEN {DAYS} <= 30 THEN '0-30 days' WHEN {DAYS} <= 90 THEN '31-90 days'
                WHEN {DAYS} <= 180 THEN '91-180 days' ELSE '180+ days' END AS ClientAgeCohort, Month FROM usage"""
    ),
    "e14_running_tokens": requests("SELECT UsageID, ClientKey, Month, MonthlyTokensUsed FROM r", RUNNING),
    "e14_running_tokens_by_months": shipments(
        """SELECT UsageID, ClientKey, Month, Date, TimeKey, CAST(sum(tokens) OVER (PARTITION BY ClientKey, Month
             ORDER BY Date, TimeKey, UsageID ROWS UNBOUNDED PRECEDING) AS BIGINT) AS MonthlyTokensUsed
           FROM (SELECT UsageID, ClientKey, Month, Date, TimeKey, sum(TotalTokens) AS tokens FROM usage GROUP BY ALL)"""
    ),
    "e14b_month_tokens": shipments(
        """SELECT UsageID, ClientKey, Month, TotalTokens,
             CAST(sum(TotalTokens) OVER (PARTITION BY ClientKey, Month) AS BIGINT) AS MonthlyTokensUsed FROM usage"""
    ),
    "e15_e17_effective_cost": requests(
        """SELECT UsageID, round(QuotaUtilizationPct, 7) AS QuotaUtilizationPct,
             QuotaUtilizationPct > 100 AS IsOverQuota,
             round(CAST(CostUSD AS DOUBLE) * CASE WHEN QuotaUtilizationPct > 100 THEN OverageRateMultiplier ELSE 1 END, 7)
               AS EffectiveCostWithOverage FROM q""",
        QUOTA,
    ),
    "e15_zero_quota": requests(
        """SELECT UsageID, TierName = 'Free' AND MonthlyTokensUsed > 0 AS IsInfinite,
             CASE WHEN TierName = 'Free' THEN MonthlyTokensUsed > 0 ELSE QuotaUtilizationPct > 100 END AS IsOverQuota,
             round(CAST(CostUSD AS DOUBLE) * CASE WHEN CASE WHEN TierName = 'Free' THEN MonthlyTokensUsed > 0
               ELSE QuotaUtilizationPct > 100 END THEN OverageRateMultiplier ELSE 1 END, 7) AS EffectiveCostWithOverage FROM q""",
        QUOTA,
    ),
    "p1_cascade_filter": requests(
        """SELECT UsageID, RegionName, Provider, ModelName, ClientName FROM usage
           WHERE RegionName IN ('ASIA', 'EUROPE') AND Provider IN ('Brand#2', 'Brand#17', 'Brand#5')"""
    ),
    "p1_facet_values": requests("SELECT DISTINCT Provider FROM usage WHERE RegionName = 'ASIA'"),
    "a1_client_month": shipments(CLIENT_MONTH),
    "a2_model_performance": shipments(
        """SELECT ModelKey, ModelName, Provider, round(lat, 6) AS AvgLatency, round(succ, 6) AS SuccessRate,
             round(sat, 6) AS AvgSatisfaction, cost AS TotalCost, n AS TotalRequests, round(eff, 6) AS AvgTokenEfficiency,
             rank() OVER (ORDER BY cost DESC) AS CostRank, rank() OVER (ORDER BY round(lat, 9)) AS LatencyRank FROM m""",
        MODELS,
    ),
    "a3_region_month": shipments(f"SELECT RegionKey, RegionName, Month, {VOLUME} FROM usage GROUP BY ALL"),
    "a4_feature_adoption": shipments(
        """SELECT FeatureKey, FeatureName, IsPremium, count(*) AS UsageCount,
             round(count(DISTINCT ClientKey) * 100.0::DOUBLE / (SELECT count(DISTINCT ClientKey) FROM usage), 6)
               AS PremiumAdoptionRate,
             round(avg(SatisfactionScore), 6) AS AvgSatisfactionByFeature FROM usage GROUP BY 1, 2, 3"""
    ),
    "a5_overview": requests(
        """SELECT count(*) AS requests, CAST(sum(CostUSD) AS DOUBLE) AS cost, CAST(sum(TotalTokens) AS BIGINT) AS tokens,
             round(avg(SuccessFlag) * 100, 6) AS success_rate, round(avg(SatisfactionScore), 6) AS satisfaction,
             round(count(SatisfactionScore) * 100.0::DOUBLE / count(*), 6) AS satisfaction_coverage,
             round(count(*) FILTER (LatencyMs > 2000) * 100.0::DOUBLE / count(*), 6) AS anomaly_rate,
             round(avg(LatencyMs), 6) AS avg_latency FROM usage"""
    ),
    "a6_monthly_trend": shipments(
        """SELECT Month, CAST(sum(CostUSD) AS DOUBLE) AS CostUSD, CAST(sum(TotalTokens) AS BIGINT) AS TotalTokens,
             count(*) AS RequestCount, round(avg(SuccessFlag) * 100, 6) AS SuccessRate FROM usage GROUP BY Month"""
    ),
    "a7_model_costs": shipments(
        f"""SELECT ModelName, Provider, CAST(sum(CostUSD) AS DOUBLE) AS TotalCost, count(*) AS Requests,
              round(avg(LatencyMs), 6) AS AvgLatency, round(avg({EFFICIENCY}), 6) AS AvgTokenEfficiency,
              round(avg(SatisfactionScore), 6) AS AvgSatisfaction FROM usage GROUP BY ModelName, Provider"""
    ),
    "a8_provider_costs": shipments(
        "SELECT Provider, CAST(sum(CostUSD) AS DOUBLE) AS TotalCost, count(*) AS Requests FROM usage GROUP BY 1"
    ),
    "a9_feature_use": shipments(
        """SELECT FeatureName, count(*) AS Requests, round(avg(CAST(IsPremium AS INTEGER)) * 100, 6) AS PremiumRate,
             round(avg(SatisfactionScore), 6) AS AvgSatisfaction FROM usage GROUP BY FeatureName"""
    ),
    "a10_client_health": shipments(
        """SELECT cm.*, ChurnRiskScore FROM cm LEFT JOIN scores USING (ClientKey)
           QUALIFY row_number() OVER (PARTITION BY ClientKey ORDER BY Month DESC) = 1""",
        f"cm AS ({CLIENT_MONTH})", SCORES,
    ),
    "a11_risk_bands": shipments(
        """SELECT b AS BandOrder, label AS RiskBand, count(ChurnRiskScore) AS Clients
           FROM (VALUES (0, 'Low (0–25)', -1, 25), (1, 'Moderate (25–50)', 25, 50),
                        (2, 'High (50–75)', 50, 75), (3, 'Critical (75–100)', 75, 100)) t(b, label, lo, hi)
           LEFT JOIN scores ON ChurnRiskScore > lo AND ChurnRiskScore <= hi GROUP BY b, label""",
        SCORES,
    ),
    "a12_quota_latest": requests(
        """SELECT ClientKey, ClientName, round(QuotaUtilizationPct, 6) AS QuotaUtilizationPct,
             QuotaUtilizationPct > 100 AS IsOverQuota FROM q
           QUALIFY row_number() OVER (PARTITION BY ClientKey ORDER BY Date DESC, TimeKey DESC, UsageID DESC) = 1""",
        QUOTA,
    ),
    "a14_histogram": requests(
        """SELECT CAST(b * 500 AS DOUBLE) AS BinStart, CAST(b * 500 + 500 AS DOUBLE) AS BinEnd, count(*) AS Count
           FROM (SELECT floor(LatencyMs / 500) AS b FROM usage) GROUP BY b"""
    ),
    "a19_flag_patterns": shipments(
        """SELECT CAST(CostUSD > 60000 AS INTEGER) AS HighCost, CAST(TotalTokens > 200 AS INTEGER) AS ManyTokens,
             CAST(LatencyMs > 1200 AS INTEGER) AS Slow, count(*) AS Count FROM usage GROUP BY 1, 2, 3"""
    ),
    "a20_client_feature_counts": shipments(
        "SELECT ClientName, FeatureName, count(*) AS Requests FROM usage GROUP BY ALL"
    ),
    "a20_heatmap": shipments(
        "SELECT ClientName, "
        + ", ".join(f"""count(*) FILTER (FeatureName = '{f}') AS "{f}" """
                    for f in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
        + "FROM usage GROUP BY ClientName"
    ),
    "o3_top_rows": shipments(
        """SELECT Provider, CAST(sum(CostUSD) AS DOUBLE) AS TotalCost FROM usage GROUP BY 1
           ORDER BY TotalCost DESC, Provider LIMIT 10"""
    ),
    "b_measures": shipments(
        """SELECT count(*) AS TotalRequests, round(sum(SuccessFlag) / count(*)::DOUBLE, 6) AS SuccessRate,
             count(*) FILTER (SuccessFlag = 0) AS FailedRequests, round(median(LatencyMs), 6) AS MedianLatency,
             round(count(*) FILTER (LatencyMs > 1200) / count(*)::DOUBLE, 6) AS HighLatencyShare,
             CAST(sum(CostUSD) AS DOUBLE) AS TotalCost, round(CAST(sum(CostUSD) AS DOUBLE) / count(*), 6) AS CostPerRequest,
             round(CAST(sum(CostUSD) AS DOUBLE) / (CAST(sum(TotalTokens) AS DOUBLE) / 1000), 6) AS CostPer1KTokens
           FROM usage"""
    ),
    "v3_scorecard": shipments(
        "SELECT ModelKey, " + ", ".join([
            scaled("cost", False, "Cost"), scaled("lat", False, "Latency"), scaled("sat", True, "Satisfaction"),
            scaled("eff", True, "Token Efficiency"), scaled("succ", True, "Success Rate"),
        ]) + " FROM m",
        MODELS,
    ),
    "v5_scatter_points": requests(
        """SELECT round(LatencyMs, 6) AS LatencyMs, SatisfactionScore, ModelName FROM usage
           WHERE SatisfactionScore IS NOT NULL"""
    ),
    "v5_cost_scatter_points": requests(
        """SELECT CAST(CostUSD AS DOUBLE) AS CostUSD, TotalTokens, round(LatencyMs, 6) AS LatencyMs, ModelName FROM usage
           WHERE CostUSD IS NOT NULL AND TotalTokens IS NOT NULL AND LatencyMs IS NOT NULL"""
    ),
    "r1_row_index": """SELECT o_orderkey, o_totalprice,
        row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS RowIndex FROM orders""",
    "r1_global_rank": """SELECT o_orderkey, round(o_totalprice, -3) AS price,
        rank() OVER (ORDER BY round(o_totalprice, -3) DESC) AS PriceRank FROM orders""",
    "r2_quantiles": QUANTILES,
    "r3_ntile": """SELECT o_orderkey, o_custkey, o_totalprice,
        CAST(ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS by_price,
        CAST(ntile(7) OVER (ORDER BY o_custkey DESC, o_orderkey) AS INTEGER) AS by_client FROM orders""",
    "f8_holidays": """WITH d AS (
          SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS Date FROM lineitem),
        years AS (SELECT DISTINCT year(Date) + o AS y FROM d, (VALUES (0), (1)) t(o)),
        fixed AS (SELECT make_date(y, m, dd) AS h FROM years, (VALUES (1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0))
            t(m, dd, since) WHERE y >= since),
        nth AS (SELECT make_date(y, m, 1) AS first, wd, n FROM years,
            (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) t(m, wd, n)),
        floating AS (SELECT first + CAST((wd - isodow(first) + 7) % 7 + (n - 1) * 7 AS INTEGER) AS h FROM nth
          UNION ALL SELECT make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) - 1) AS INTEGER) FROM years),
        days AS (SELECT h FROM fixed UNION SELECT h FROM floating
          UNION SELECT h - 1 FROM fixed WHERE isodow(h) = 6 UNION SELECT h + 1 FROM fixed WHERE isodow(h) = 7)
        SELECT Date, Date IN (SELECT h FROM days) AS IsHoliday, isodow(Date) >= 6 AS IsWeekend FROM d""",
}
