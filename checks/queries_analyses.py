"""Registered: the ten analyses."""

from meterstar.operators import analyses
from meterstar.sources import samples

from checks.registry import item_parts, register, requested, rounded, shipped


@register("q1_rolling_cost")
def _(spark, sf_dir):
    return rounded(analyses.rolling_model_cost(shipped(spark, sf_dir, "model")))


@register("q2_cost_efficiency")
def _(spark, sf_dir):
    return rounded(analyses.model_cost_efficiency(shipped(spark, sf_dir, "model")))


@register("q3_client_rfm")
def _(spark, sf_dir):
    return rounded(analyses.client_rfm(shipped(spark, sf_dir, "client")))


@register("q4_feature_funnel")
def _(spark, sf_dir):
    return rounded(analyses.feature_adoption_funnel(shipped(spark, sf_dir, "feature")))


@register("q5_region_growth")
def _(spark, sf_dir):
    return rounded(analyses.region_growth(shipped(spark, sf_dir, "region")), CostChangeUSD=4)


@register("q6_upsell")
def _(spark, sf_dir):
    usage = shipped(spark, sf_dir, "client", "subscription")
    return rounded(analyses.upsell_candidates(usage, parts=item_parts(spark, sf_dir)))


@register("q7_model_substitution")
def _(spark, sf_dir):
    out = analyses.model_substitution(shipped(spark, sf_dir, "model"))
    return rounded(out, CheapestEquivalentCostUSD=4, EstimatedSavingsUSD=4)


@register("q8_correlation")
def _(spark, sf_dir):
    return rounded(analyses.cost_satisfaction_correlation(shipped(spark, sf_dir)))


@register("q9_cost_anomalies")
def _(spark, sf_dir):
    clients, models = (samples.dimension(spark, sf_dir, "requests", name) for name in ("client", "model"))
    return rounded(analyses.cost_anomalies(requested(spark, sf_dir), clients, models), 8)


@register("q10_cohort_retention")
def _(spark, sf_dir):
    return rounded(analyses.cohort_retention(shipped(spark, sf_dir, "client")))
