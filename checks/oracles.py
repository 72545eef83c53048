"""All SQL counterparts by query name."""

from checks import oracle_analyses, oracle_quality, oracle_refresh, oracle_scoring, oracle_series, oracle_usage

ORACLES: dict[str, str] = {**oracle_analyses.ORACLES, **oracle_quality.ORACLES, **oracle_usage.ORACLES, **oracle_series.ORACLES,
                            **oracle_scoring.ORACLES, **oracle_refresh.ORACLES}
