"""SQL counterparts of distinct members and refreshed reporting tables."""

from checks import oracle_analyses, oracle_usage
from checks.oracle_base import shipments

ORACLES = {
    "a15_distinct_clients": shipments(
        """SELECT FeatureKey, Month, count(DISTINCT ClientKey) AS Clients FROM usage
           GROUP BY GROUPING SETS ((FeatureKey, Month), (FeatureKey))"""
    ),
    "q4_funnel_from_sets": oracle_analyses.ORACLES["q4_feature_funnel"],
    "q10_retention_from_sets": oracle_analyses.ORACLES["q10_cohort_retention"],
    "s6_refreshed_client_month": oracle_usage.ORACLES["a1_client_month"],
    "s6_refreshed_models": oracle_usage.ORACLES["a2_model_performance"],
    "s6_refreshed_region_month": oracle_usage.ORACLES["a3_region_month"],
    "s6_refreshed_features": oracle_usage.ORACLES["a4_feature_adoption"],
}
