"""SQL counterparts of the series operators."""

from checks.oracle_base import shipments

DAILY = [
    """d AS (SELECT RegionName, Date, CAST(sum(CostUSD) AS DOUBLE) AS c, CAST(sum(TotalTokens) AS DOUBLE) AS t,
         CAST(count(*) AS DOUBLE) AS n FROM usage GROUP BY ALL)""",
    """ends AS (SELECT RegionName, unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS day FROM d GROUP BY 1)""",
    """daily AS (SELECT e.RegionName, CAST(day AS DATE) AS Date, coalesce(c, 0) AS CostUSD, coalesce(t, 0) AS TotalTokens,
         coalesce(n, 0) AS RequestCount FROM ends e LEFT JOIN d ON d.RegionName = e.RegionName AND d.Date = CAST(day AS DATE))""",
]
LONG = [*DAILY, """s AS (SELECT RegionName, 'CostUSD' AS Metric, Date AS ds, CostUSD AS y FROM daily
    UNION ALL SELECT RegionName, 'TotalTokens', Date, TotalTokens FROM daily
    UNION ALL SELECT RegionName, 'RequestCount', Date, RequestCount FROM daily)"""]
SPLIT = [*LONG, """split AS (SELECT *, ds > max(ds) OVER (PARTITION BY RegionName, Metric) - 30 AS IsTest FROM s)""",
         "train AS (SELECT * FROM split WHERE NOT IsTest)",
         """tail AS (SELECT *, row_number() OVER (PARTITION BY RegionName, Metric ORDER BY ds DESC) AS back,
              max(ds) OVER (PARTITION BY RegionName, Metric) AS last FROM train)""",
         """naive AS (SELECT RegionName, Metric, CAST(last + step AS DATE) AS ds, y AS yhat
              FROM tail, (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS step) WHERE back = 1)""",
         """seasonal AS (SELECT RegionName, Metric, CAST(last + step AS DATE) AS ds, y AS yhat
              FROM tail, (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS step) WHERE back = 7 - (step - 1) % 7)"""]
METRICS = """m AS (SELECT RegionName, Metric, Model, avg(abs(y - yhat)) AS MAE, sqrt(avg((y - yhat) * (y - yhat))) AS RMSE,
    avg(abs(y - yhat) / y) FILTER (y <> 0) * 100 AS MAPE,
    avg(CASE WHEN abs(y) + abs(yhat) = 0 THEN 0 ELSE 2 * abs(y - yhat) / (abs(y) + abs(yhat)) END) * 100 AS sMAPE
  FROM (SELECT *, 'Naive' AS Model FROM naive UNION ALL SELECT *, 'SeasonalNaive' FROM seasonal)
  JOIN (SELECT * FROM split WHERE IsTest) USING (RegionName, Metric, ds) GROUP BY 1, 2, 3)"""
DECOMPOSE = [*LONG,
    """b AS (SELECT RegionName, Metric, ds, y, count(*) OVER w AS n, date_diff('day', min(ds) OVER w, ds) AS t
         FROM s WHERE Metric = 'RequestCount' WINDOW w AS (PARTITION BY RegionName, Metric))""",
    """mid AS (SELECT *, CASE WHEN t BETWEEN 3 AND n - 4 THEN avg(y) OVER (PARTITION BY RegionName ORDER BY t
         ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS mv FROM b)""",
    """head AS (SELECT RegionName, regr_slope(mv, t) AS hs, regr_intercept(mv, t) AS hb FROM mid
         WHERE t BETWEEN 3 AND 9 GROUP BY 1)""",
    """rear AS (SELECT RegionName, regr_slope(mv, t) AS ls, regr_intercept(mv, t) AS lb FROM mid
         WHERE t BETWEEN n - 10 AND n - 4 GROUP BY 1)""",
    """trend AS (SELECT *, CASE WHEN t < 3 THEN hb + hs * t WHEN mv IS NOT NULL THEN mv ELSE lb + ls * t END AS Trend
         FROM mid JOIN head USING (RegionName) JOIN rear USING (RegionName))""",
    "phase AS (SELECT RegionName, t % 7 AS ph, avg(y - Trend) AS e FROM trend GROUP BY 1, 2)",
    "centre AS (SELECT RegionName, avg(e) AS c FROM phase GROUP BY 1)"]

ORACLES = {
    "f1_daily_calendar": shipments(
        "SELECT *, CASE WHEN isodow(Date) >= 6 THEN 1 ELSE 0 END AS IsWeekend FROM daily", *DAILY),
    "f2_holdout_split": shipments("SELECT * FROM split", *SPLIT),
    "f3_naive": shipments("SELECT * FROM naive", *SPLIT),
    "f4_seasonal_naive": shipments("SELECT * FROM seasonal", *SPLIT),
    "f5_f11_model_comparison": shipments(
        """SELECT RegionName, Metric, Model, round(MAE, 6) AS MAE, round(RMSE, 6) AS RMSE, round(MAPE, 6) AS MAPE,
             round(sMAPE, 6) AS sMAPE,
             row_number() OVER (PARTITION BY RegionName, Metric ORDER BY sMAPE, RMSE, Model) = 1 AS Selected FROM m""",
        *SPLIT, METRICS),
    "f10_forecast_dates": shipments(
        """SELECT RegionName, Metric, max(ds) AS _last, 29::BIGINT AS Days, 29::BIGINT AS DistinctDays,
             CAST(max(ds) + 1 AS DATE) AS FirstDay FROM s WHERE Metric = 'TotalTokens' GROUP BY 1, 2""", *LONG),
    "f14_history_and_forecast": shipments(
        """SELECT RegionName, Metric, ds AS Date, y AS Value, 'history' AS Part, NULL::DOUBLE AS Lower, NULL::DOUBLE AS Upper FROM s
           UNION ALL SELECT RegionName, Metric, CAST(ds + step AS DATE), y, 'forecast', NULL, NULL
           FROM (SELECT *, row_number() OVER (PARTITION BY RegionName, Metric ORDER BY ds DESC) AS back FROM s),
             (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS step) WHERE back = 1""",
        *LONG),
    "f15_decomposition": shipments(
        """SELECT RegionName, Metric, ds, y AS Observed, round(Trend, 6) AS Trend, round(e - c, 6) AS Seasonal,
             round(y - Trend - (e - c), 6) AS Residual
           FROM trend t JOIN phase p ON p.RegionName = t.RegionName AND p.ph = t.t % 7
           JOIN centre c ON c.RegionName = t.RegionName""".replace("SELECT RegionName,", "SELECT t.RegionName,", 1),
        *DECOMPOSE),
    "f16_unit_root": shipments(
        """SELECT RegionName, Metric, count(*) AS Observations,
             round(regr_slope(dy, x) / sqrt((regr_syy(dy, x) - regr_slope(dy, x) * regr_sxy(dy, x))
               / (count(*) - 2) / regr_sxx(dy, x)), 6) AS DickeyFullerT
           FROM (SELECT *, lag(y) OVER w AS x, y - lag(y) OVER w AS dy FROM s
                 WINDOW w AS (PARTITION BY RegionName, Metric ORDER BY ds)) WHERE x IS NOT NULL GROUP BY 1, 2""",
        *LONG),
}
