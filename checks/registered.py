"""All registered queries."""

from checks import queries_analyses, queries_quality, queries_refresh, queries_scoring, queries_series, queries_usage  # noqa: F401
from checks.registry import QUERIES  # noqa: F401
