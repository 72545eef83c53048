"""What each table of the star schema must look like."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Table files, required columns, types and keys of the star schema.
FACT = "fact"
FILES = {
    "fact": "Fact_AI_Usage",
    "date": "Dim_Date",
    "client": "Dim_Client",
    "model": "Dim_Model",
    "feature": "Dim_Feature",
    "region": "Dim_Region",
    "subscription": "Dim_Subscription",
}
SCHEMAS = {
    "fact": (
        "UsageID bigint, DateKey int, TimeKey int, ClientKey int, ModelKey int, FeatureKey int, "
        "RegionKey int, SubscriptionTierKey int, TokensInput bigint, TokensOutput bigint, "
        "TotalTokens bigint, LatencyMs double, CostUSD double, SuccessFlag int, "
        "SatisfactionScore double, RequestType string"
    ),
    "date": (
        "DateKey int, Date date, Year int, Quarter string, Month int, MonthName string, "
        "WeekOfYear int, DayOfWeek string, IsWeekend boolean"
    ),
    "client": (
        "ClientKey int, ClientID string, ClientName string, Industry string, CompanySize string, "
        "OnboardingDate date, AccountManager string, Status string"
    ),
    "model": (
        "ModelKey int, ModelName string, Provider string, ModelFamily string, ContextWindow bigint, "
        "CostPer1kInput double, CostPer1kOutput double, IsLatest boolean"
    ),
    "feature": "FeatureKey int, FeatureName string, FeatureCategory string, IsPremium boolean",
    "region": "RegionKey int, RegionName string, Country string, TimeZoneOffset double",
    "subscription": (
        "SubscriptionTierKey int, TierName string, MonthlyQuotaTokens bigint, "
        "OverageRateMultiplier double, SupportLevel string"
    ),
}
DIMENSION_KEYS = {
    "date": "DateKey",
    "client": "ClientKey",
    "model": "ModelKey",
    "feature": "FeatureKey",
    "region": "RegionKey",
    "subscription": "SubscriptionTierKey",
}
NUMERIC_FACT_COLUMNS = (
    "UsageID", "DateKey", "TimeKey", "ClientKey", "ModelKey", "FeatureKey", "RegionKey",
    "SubscriptionTierKey", "TokensInput", "TokensOutput", "TotalTokens", "LatencyMs", "CostUSD",
    "SuccessFlag",
)
NOT_NULL_FACT_COLUMNS = tuple(c for c in NUMERIC_FACT_COLUMNS if c != "TimeKey")
NON_NEGATIVE_FACT_COLUMNS = ("TokensInput", "TokensOutput", "TotalTokens", "LatencyMs", "CostUSD")
DATE_COLUMNS = {"date": "Date", "client": "OnboardingDate"}


@dataclass(frozen=True)
class Contract:
    """Rules for one table."""

    table: str
    schema: T.StructType
    key: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def contract(table: str) -> Contract:
    """The contract of one of the seven tables."""
    schema = T.StructType.fromDDL(SCHEMAS[table])
    return Contract(table, schema, DIMENSION_KEYS.get(table))
