"""SQL counterparts of features and evaluation."""

from checks.oracle_base import requests, shipments

JUDGED = """j AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS a,
    l_quantity / 100 + l_linenumber / 20.0::DOUBLE AS s FROM lineitem),
  jp AS (SELECT *, CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS p FROM j)"""


def judged(query: str, *ctes: str) -> str:
    return f"WITH {', '.join([JUDGED, *ctes])} {query}"


def rates(positive: str) -> str:
    tp = f"CAST(count(*) FILTER (a = 1 AND {positive}) AS DOUBLE)"
    pp = f"count(*) FILTER ({positive})"
    ap = "count(*) FILTER (a = 1)"
    return f"""round(coalesce({tp} / nullif({pp}, 0), 0), 6) AS "Precision",
      round(coalesce({tp} / nullif({ap}, 0), 0), 6) AS Recall,
      round(coalesce(2 * {tp} / nullif({pp} + {ap}, 0), 0), 6) AS F1"""


QUOTA = """q AS (SELECT *, CAST(sum(TotalTokens) OVER (PARTITION BY ClientKey, Month) AS DOUBLE)
    / nullif(MonthlyQuotaTokens, 0) * 100 AS pct FROM usage)"""
FEATURES = [
    QUOTA,
    """mon AS (SELECT ClientKey, year(Date) * 12 + month(Date) AS m, CAST(sum(CostUSD) AS DOUBLE) AS c,
         avg(SatisfactionScore) AS s FROM usage GROUP BY ALL)""",
    """trend AS (SELECT ClientKey, CASE WHEN count(*) > 1 THEN regr_slope(c, m) ELSE 0 END AS ct,
         CASE WHEN count(s) > 1 THEN regr_slope(s, m) FILTER (s IS NOT NULL) ELSE 0 END AS st FROM mon GROUP BY 1)""",
    "last AS (SELECT max(Date) AS d FROM usage)",
    """feats AS (SELECT q.ClientKey, CAST(date_diff('day', max(Date), any_value(last.d)) AS INTEGER) AS days,
         any_value(ct) AS ct, any_value(st) AS st,
         avg(SuccessFlag) FILTER (Date >= last.d - 30) AS recent, avg(SuccessFlag) AS overall,
         max(pct) AS quota, avg(CAST(IsPremium AS INTEGER)) * 100 AS premium
       FROM q JOIN trend USING (ClientKey), last GROUP BY q.ClientKey)""",
]
FENCE = "2.5 * quantile_cont({c}, 0.75) - 1.5 * quantile_cont({c}, 0.25)"
FENCES = "fences AS (SELECT {} FROM usage)".format(", ".join(
    f"{FENCE.format(c=f'CAST({c} AS DOUBLE)')} AS f{c}" for c in ("CostUSD", "TotalTokens", "LatencyMs")))
FLAGS = """fl AS (SELECT *, CAST(CostUSD AS DOUBLE) > fCostUSD AS rc, TotalTokens > fTotalTokens AS rt,
    LatencyMs > fLatencyMs AS rl, CostUSD > 95000 AS st FROM usage, fences),
  fr AS (SELECT *, rc OR rt OR rl AS r FROM fl)"""
RULE = "'Rule baseline: value > Q3 + 1.5 * IQR.'"
SUMMARY = f"""SELECT SummaryType, Pattern, CAST(n AS BIGINT) AS Count,
    round(n * 100.0::DOUBLE / (SELECT count(*) FROM usage), 6) AS Percentage, round(t, 6) AS Threshold, Notes FROM (
  SELECT 'configuration' AS SummaryType, 'Isolation Forest contamination' AS Pattern, 0 AS n, 0.02::DOUBLE AS t,
    'Configured expected proportion; not a confirmed incident rate.' AS Notes
  UNION ALL SELECT 'population', 'Total scored requests', count(*), NULL, '' FROM fr
  UNION ALL SELECT 'statistical_signal', 'Statistical anomaly', count(*) FILTER (st), NULL, '' FROM fr
  UNION ALL SELECT 'rule_signal', 'Rule-based outlier', count(*) FILTER (r), NULL, '' FROM fr
  UNION ALL SELECT 'comparison', 'Both statistical anomaly and rule-based outlier', count(*) FILTER (st AND r), NULL, '' FROM fr
  UNION ALL SELECT 'comparison', 'Statistical anomaly only', count(*) FILTER (st AND NOT r), NULL, '' FROM fr
  UNION ALL SELECT 'comparison', 'Rule-based outlier only', count(*) FILTER (r AND NOT st), NULL, '' FROM fr
  UNION ALL SELECT 'rule_pattern', 'CostUSD above Tukey upper fence', count(*) FILTER (rc), max(fCostUSD), {RULE} FROM fr
  UNION ALL SELECT 'rule_pattern', 'TotalTokens above Tukey upper fence', count(*) FILTER (rt), max(fTotalTokens), {RULE} FROM fr
  UNION ALL SELECT 'rule_pattern', 'LatencyMs above Tukey upper fence', count(*) FILTER (rl), max(fLatencyMs), {RULE} FROM fr
  UNION ALL SELECT 'common_pattern', concat_ws(' + ', CASE WHEN rc THEN 'CostUSD' END, CASE WHEN rt THEN 'TotalTokens' END,
      CASE WHEN rl THEN 'LatencyMs' END), count(*), NULL, 'Features exceeding their transparent Tukey upper fences.'
    FROM fr WHERE r GROUP BY 2)"""
ERRORS = """count(*) AS SampleSize, round(avg(abs(y - p)), 6) AS MAE, round(sqrt(avg((y - p) * (y - p))), 6) AS RMSE,
    round(CASE WHEN min(y) < max(y) THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END, 6) AS R2,
    bool_and(p BETWEEN 1 AND 5) AS PredictionRangeValid"""
RATED = """rated AS (SELECT *, SatisfactionScore AS y, 1 + sqrt(TokensInput) / 2 AS p FROM usage)"""
DIMENSIONS = ("ModelKey", "ClientKey", "RegionKey", "FeatureKey", "RequestType")
COVER = """count(*) AS TotalRequests, count(SatisfactionScore) AS LabeledRequests,
    count(*) - count(SatisfactionScore) AS UnlabeledRequests,
    round(count(SatisfactionScore) * 100.0::DOUBLE / count(*), 6) AS LabelCoveragePct,
    round(avg(SatisfactionScore), 6) AS ObservedSatisfactionMean"""

ORACLES = {
    "ml5_stratified_holdout": """SELECT o_orderstatus, CAST(ceil(count(*) * 0.25) AS BIGINT) AS "Holdout",
        count(*) AS "Total" FROM orders GROUP BY o_orderstatus""",
    "ml1_client_features": shipments(
        """SELECT ClientKey, days AS DaysSinceLastRequest, round(ct, 6) AS AvgMonthlyCostTrend,
             round(st, 9) AS SatisfactionTrend, round(recent, 6) AS SuccessRateLast30Days,
             round(overall, 6) AS SuccessRateOverall, round(quota, 6) AS QuotaUtilizationPct,
             round(premium, 6) AS PremiumFeatureUsagePct FROM feats""",
        *FEATURES),
    "ml3_proxy_label": shipments(
        "SELECT ClientKey, CASE WHEN days > 45 AND quota < 20 THEN 1 ELSE 0 END AS ChurnSignal FROM feats", *FEATURES),
    "ml4_class_balance": judged(
        """SELECT CAST(sum(a) AS BIGINT) AS PositiveCount, CAST(count(*) - sum(a) AS BIGINT) AS NegativeCount,
             count(*) AS TotalCount, round(avg(a) * 100, 6) AS PositivePct, round((1 - avg(a)) * 100, 6) AS NegativePct FROM j"""),
    "ml9_classification_metrics": judged(
        f"""SELECT 'Formula' AS Model, CAST(sum(a) AS BIGINT) AS PositiveCount,
              CAST(count(*) - sum(a) AS BIGINT) AS NegativeCount, round(avg(a) * 100, 6) AS ClassBalancePositivePct,
              {rates("p = 1")} FROM jp"""),
    "ml10_roc_auc": judged(
        """SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS ROCAUC
           FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)""",
        "g AS (SELECT s, sum(a) AS pos, count(*) - sum(a) AS neg FROM j GROUP BY s)"),
    "ml11_average_precision": judged(
        """SELECT round(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / sum(pos), 6) AS PRAUC
           FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (ORDER BY s DESC))""",
        "g AS (SELECT s, sum(a) AS pos, count(*) - sum(a) AS neg FROM j GROUP BY s)"),
    "ml13_confusion_matrix": judged(
        """SELECT t.a AS Actual, t.p AS Predicted, count(jp.a) AS Count
           FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, p) LEFT JOIN jp ON jp.a = t.a AND jp.p = t.p GROUP BY 1, 2"""),
    "ml14_threshold_sweep": judged(" UNION ALL ".join(
        f"""SELECT {t / 10}::DOUBLE AS Threshold, {rates(f's >= {t / 10}::DOUBLE')},
              count(*) FILTER (s >= {t / 10}::DOUBLE) AS PositivePredictions FROM j""" for t in range(1, 10))),
    "ml19_regression_metrics": shipments(
        f"SELECT 'Formula' AS Model, {ERRORS} FROM rated WHERE y IS NOT NULL", RATED),
    "ml19_group_metrics": shipments(" UNION ALL ".join(
        f"""SELECT '{d}' AS GroupDimension, CAST({d} AS VARCHAR) AS "Group", 'Formula' AS Model, {ERRORS}
            FROM rated WHERE y IS NOT NULL GROUP BY {d} HAVING count(*) >= 10""" for d in DIMENSIONS), RATED),
    "ml19b_population_summary": shipments(
        """SELECT CASE WHEN y IS NOT NULL THEN 'Observed satisfaction scores'
             ELSE 'Predictions for previously unrated requests' END AS "Group", count(*) AS SampleSize,
             bool_and(p BETWEEN 1 AND 5) AS PredictionRangeValid FROM rated GROUP BY 1""", RATED),
    "ml19c_label_coverage": shipments(" UNION ALL ".join([
        *[f"""SELECT '{d}' AS Dimension, CAST({d} AS VARCHAR) AS "Group", {COVER} FROM usage GROUP BY {d}""" for d in DIMENSIONS],
        f"""SELECT 'Overall', 'All requests', {COVER} FROM usage"""])),
    "ml20_tukey_fences": shipments(" UNION ALL ".join(
        f"SELECT '{c}' AS Feature, round(f{c}, 6) AS UpperFence FROM fences" for c in ("CostUSD", "TotalTokens", "LatencyMs")), FENCES),
    "ml21_rule_outliers": requests(
        """SELECT UsageID, rc AS RuleOutlier_CostUSD, rt AS RuleOutlier_TotalTokens, rl AS RuleOutlier_LatencyMs,
             r AS IsRuleBasedOutlier FROM fr""", FENCES, FLAGS),
    "ml23_anomaly_summary": shipments(SUMMARY, FENCES, FLAGS),
}
