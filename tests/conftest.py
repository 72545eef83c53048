"""One local session for all tests, and small stars to start from."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from meterstar.session import build_session  # noqa: E402
from meterstar.sources.contracts import SCHEMAS  # noqa: E402
from meterstar.sources.star import StarTables  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__default__parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DAY = dt.date(2025, 1, 1)
ONE_ROW = {
    "date": [(20250101, DAY, 2025, "Q1", 1, "January", 1, "Wednesday", False)],
    "client": [(1, "CLI-NW", "Northwind Mills", "Milling", "Large", dt.date(2024, 11, 18), "Iris", "Active")],
    "model": [(1, "Heron", "Lakeside", "Wader", 64000, 0.02, 0.05, False)],
    "feature": [(1, "Summaries", "Reading", False)],
    "region": [(1, "Alps", "CH", 1.0)],
    "subscription": [(1, "Silver", 24000, 1.5, "Mail")],
}
FACT_ROW = {
    "UsageID": 1, "DateKey": 20250101, "TimeKey": 1015, "ClientKey": 1, "ModelKey": 1, "FeatureKey": 1, "RegionKey": 1,
    "SubscriptionTierKey": 1, "TokensInput": 80, "TokensOutput": 240, "TotalTokens": 320, "LatencyMs": 180.0,
    "CostUSD": 0.12, "SuccessFlag": 1, "SatisfactionScore": 3.0, "RequestType": "Digest",
}


@pytest.fixture
def make_star(spark):
    """Star with one row per dimension; facts are given as changes to one valid row."""

    def build(facts=({},), **dimensions):
        rows = [tuple({**FACT_ROW, "UsageID": i + 1, **f}.values()) for i, f in enumerate(facts)]
        tables = {"fact": spark.createDataFrame(rows, SCHEMAS["fact"])}
        for name, default in ONE_ROW.items():
            tables[name] = spark.createDataFrame(dimensions.get(name, default), SCHEMAS[name])
        return StarTables(tables)

    return build


@pytest.fixture
def usage_star(spark, make_star):
    """A generated star: 120 days, 12 clients, one of which has a third of 3,000 requests."""
    days = [DAY + dt.timedelta(days=i) for i in range(120)]
    dates = [(int(d.strftime("%Y%m%d")), d, d.year, f"Q{(d.month + 2) // 3}", d.month, d.strftime("%B"),
              d.isocalendar()[1], d.strftime("%A"), d.weekday() >= 5) for d in days]
    clients = [(k, f"CLI-{k}", f"Client {k}", "X", "Small", DAY - dt.timedelta(days=k * 9), "A", "Active") for k in range(1, 13)]
    models = [(k, f"Model {k}", f"Provider {k % 2}", "F", 1000, 0.001 * k, 0.002 * k, True) for k in range(1, 5)]
    features = [(k, f"Feature {k}", "Core", k % 2 == 0) for k in range(1, 4)]
    tiers = [(1, "Basic", 3000, 1.5, "S"), (2, "Enterprise", 100000, 1.1, "S"), (3, "None", 0, 2.0, "S")]
    facts = []
    for i in range(3000):
        h = (i * 2654435761) % 4294967296
        day = days[(h >> 3) % 120] if i % 12 else days[(h >> 3) % 30]
        client = 1 if i % 3 == 0 else 2 + (h >> 5) % 11
        if client == 12:
            day = days[(h >> 3) % 20]
        tokens_in, tokens_out = (h >> 7) % 90, (h >> 11) % 200
        facts.append({
            "UsageID": 3000 - i, "DateKey": int(day.strftime("%Y%m%d")), "TimeKey": (h >> 13) % 24 * 100 + (h >> 17) % 60,
            "ClientKey": client, "ModelKey": 1 + (h >> 9) % 4, "FeatureKey": 1 + (h >> 15) % 3,
            "SubscriptionTierKey": 1 + client % 3, "TokensInput": tokens_in, "TokensOutput": tokens_out,
            "TotalTokens": tokens_in + tokens_out, "LatencyMs": 100.0 + (h >> 6) % 900 + (5000.0 if i % 97 == 0 else 0),
            "CostUSD": round(0.0001 * (1 + (h >> 4) % 500) + (3.0 if i % 97 == 0 else 0), 4),
            "SuccessFlag": int(h % 17 != 0), "SatisfactionScore": 1.0 + (h >> 8) % 5 if h % 3 == 0 else None,
            "RequestType": "Chat" if h % 2 else "Batch",
        })
    return make_star(facts, date=dates, client=clients, model=models, feature=features, subscription=tiers)
