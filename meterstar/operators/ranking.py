"""Global order without a single-task sort.

``ordered_prefix`` gives running sums over a global order from one range sort.
``order_statistics`` finds exact order statistics by narrowing brackets with
one-row aggregates, so it neither sorts nor moves the rows. Quantiles and
NTILE build on it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.session import materialise

# Rows whose exact values one aggregate may hold per bracket, and rows sampled to propose a bracket.
EXACT_BUFFER_ROWS = 100_000
LEAST_SAMPLE = 1_000
# Half-width of a proposed bracket in standard errors of the sample's quantile.
BRACKET_ERRORS = 4.5
SAMPLE_SEED = 42
PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def ordered_prefix(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column | str]) -> DataFrame:
    """Add inclusive running sums over a global order.

    ``order`` must be total: combine rows of equal keys before. The rows are range-sorted once and written; a running sum within
    each sort partition plus the totals of the partitions before it (one row
    per partition, so safe to broadcast) gives the global value.
    """
    staged = df.select("*", *[F.expr(c).alias(f"_in_{n}") if isinstance(c, str) else c.alias(f"_in_{n}")
                              for n, c in sums.items()])
    staged = materialise(
        staged.orderBy(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", PARTITION_SHIFT))
    )
    before_window = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = (
        staged.groupBy("_part")
        .agg(*[F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in sums])
        .select("_part", *[F.sum(f"_sum_{n}").over(before_window).alias(f"_before_{n}") for n in sums])
    )
    within = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    out = staged.select("*", *[F.sum(f"_in_{n}").over(within).alias(f"_run_{n}") for n in sums])
    out = out.join(F.broadcast(before), "_part")
    for n in sums:
        out = out.withColumn(n, F.coalesce(F.col(f"_before_{n}"), F.lit(0)) + F.col(f"_run_{n}"))
    return out.select(*df.columns, *sums)


def row_index(df: DataFrame, order: Sequence[Column], name: str = "RowIndex") -> DataFrame:
    """Add a 1-based position in a global total order."""
    return ordered_prefix(df, order, {name: F.lit(1).cast("bigint")})


def rank(df: DataFrame, value: str, name: str, by: Sequence[str] = (), descending: bool = False,
         rank_nulls: bool = False) -> DataFrame:
    """Add the rank of ``value`` over all rows, or within the groups ``by``.

    Ties share the smallest rank. A NULL value has no rank, or with
    ``rank_nulls`` ranks after all others. Equal values combine first, so
    neither a large group nor a frequent value ends up in one task.
    """
    counted = df if rank_nulls else df.where(F.col(value).isNotNull())
    counts = counted.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_ties"))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    places = ordered_prefix(counts, [*[F.col(c) for c in by], order], {"_up_to": "_ties"})
    places = places.withColumn("_before", F.col("_up_to") - F.col("_ties"))
    if by:
        starts = places.groupBy(*by).agg(F.min("_before").alias("_start"))
        places = _null_safe_join(places, starts, by, "inner")
    else:
        places = places.withColumn("_start", F.lit(0))
    places = places.select(*by, value, (F.col("_before") - F.col("_start") + 1).cast("bigint").alias(name))
    return _null_safe_join(df, places, [*by, value], "left").select(*df.columns, name)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys whose NULLs equal each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


@dataclass
class _Search:
    """One wanted order statistic: the value at 0-based ``rank`` among non-null rows."""

    column: Column
    rank: int
    rows: int
    low: float | None = None       # open lower bound
    high: float | None = None      # open upper bound
    below: int = 0                 # rows at or under the open lower bound
    inside: int = field(init=False)
    value: object = None

    def __post_init__(self) -> None:
        if not 0 <= self.rank < self.rows:
            raise ValueError(f"rank {self.rank} is outside 0..{self.rows - 1}")
        self.inside = self.rows

    @property
    def share(self) -> float:
        """Place of the target inside the bracket; the half step keeps it clear of the neighbours."""
        return (self.rank - self.below + 0.5) / self.inside

    @property
    def bracket(self) -> tuple:
        return (id(self.column), self.low, self.high)

    def bracketed(self) -> Column:
        column = self.column
        if self.low is not None:
            column = F.when(self.column > F.lit(self.low), column)
        if self.high is not None:
            column = F.when(self.column < F.lit(self.high), column)
        return column


def _one_row(df: DataFrame, columns: Sequence[Column]) -> list:
    return list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def _by_bracket(searches: Sequence[_Search]) -> list[list[_Search]]:
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault(s.bracket, []).append(s)
    return list(groups.values())


def order_statistics(df: DataFrame, wanted: Sequence[tuple[Column, int]], rows: Sequence[int],
                     buffer_rows: int | None = None) -> list:
    """Exact values at the given 0-based ranks, one per (column, rank).

    ``rows`` gives each column's non-null row count; pass the same Column object
    for the same column, so that its ranks share their work. Every round is two
    aggregates with a one-row result: a bounded sample proposes an interval
    around each rank, and counts prove it or show where the target is instead.
    The sample decides only how fast the search is, never its result. Heavy ties
    resolve at the interval's ends, so a round keeps about a hundredth of the
    rows. The last round reads at most ``buffer_rows`` values exactly.
    """
    limit = max(EXACT_BUFFER_ROWS if buffer_rows is None else buffer_rows, 1)
    searches = [_Search(c, r, n) for (c, r), n in zip(wanted, rows)]
    while large := [s for s in searches if s.value is None and s.inside > limit]:
        _narrow(df, large, max(limit, LEAST_SAMPLE))
    groups = _by_bracket([s for s in searches if s.value is None])
    if groups:
        staged = df.select(*[g[0].bracketed().alias(f"b{i}") for i, g in enumerate(groups)])
        exact = [
            F.expr(f"percentile_disc(array({', '.join(f'{s.share!r}D' for s in g)})) WITHIN GROUP (ORDER BY b{i})")
            for i, g in enumerate(groups)
        ]
        for group, values in zip(groups, _one_row(staged, exact)):
            for s, value in zip(group, values):
                s.value = value
    return [s.value for s in searches]


def _narrow(df: DataFrame, searches: list[_Search], sample: int) -> None:
    """One round: shrink each search's bracket, or settle its value."""
    groups = _by_bracket(searches)
    drawn, points = [], []
    for i, group in enumerate(groups):
        share = min(sample / group[0].inside, 1.0)
        drawn.append(F.when(F.rand(SAMPLE_SEED + i) < share, group[0].bracketed()).alias(f"b{i}"))
        ends = []
        for s in group:
            margin = BRACKET_ERRORS * math.sqrt(s.share * (1 - s.share) / sample) + 1 / sample
            ends += [max(s.share - margin, 0.0), min(s.share + margin, 1.0)]
        points.append(F.expr(
            f"percentile_disc(array({', '.join(f'{e!r}D' for e in ends)})) WITHIN GROUP (ORDER BY b{i})"
        ))
    sampled = _one_row(df.select(*drawn), points)
    if any(values is None for values in sampled):  # an empty draw; its bracket holds at least one row
        sampled = [
            values or list(df.agg(F.min(g[0].bracketed()), F.max(g[0].bracketed())).first()) * len(g)
            for g, values in zip(groups, sampled)
        ]
    proposals = []
    for group, values in zip(groups, sampled):
        proposals += [(s, values[2 * i], values[2 * i + 1]) for i, s in enumerate(group)]
    bounds = list(dict.fromkeys((id(s.column), v) for s, low, high in proposals for v in (low, high)))
    columns = {id(s.column): s.column for s in searches}
    counts = _one_row(df, [
        f for key, v in bounds for f in (F.count_if(columns[key] < F.lit(v)), F.count_if(columns[key] <= F.lit(v)))
    ])
    under = {bound: counts[2 * i] for i, bound in enumerate(bounds)}
    upto = {bound: counts[2 * i + 1] for i, bound in enumerate(bounds)}
    for s, low, high in proposals:
        at_low, at_high = (id(s.column), low), (id(s.column), high)
        if under[at_low] <= s.rank < upto[at_low]:
            s.value = low
        elif under[at_high] <= s.rank < upto[at_high]:
            s.value = high
        elif s.rank < under[at_low]:      # the sample missed: the target is below its interval
            s.high, s.inside = low, under[at_low] - s.below
        elif s.rank >= upto[at_high]:     # or above it
            s.inside -= upto[at_high] - s.below
            s.low, s.below = high, upto[at_high]
        else:
            s.low, s.high, s.below, s.inside = low, high, upto[at_low], under[at_high] - upto[at_low]


def quantiles(df: DataFrame, probabilities: Mapping[str, Sequence[float]],
              buffer_rows: int | None = None) -> dict[str, dict[float, float | None]]:
    """Exact linearly interpolated quantiles of several numeric columns.

    The result is a handful of numbers; the rows never leave the executors.
    Reads ``df`` a few times, so pass a stored table rather than a long plan.
    """
    names = list(probabilities)
    values = {n: F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")) for n in names}
    counts = dict(zip(names, _one_row(df, [F.count(values[n]) for n in names])))
    positions = {(n, p): (counts[n] - 1) * p for n in names for p in probabilities[n] if counts[n]}
    slots = list(dict.fromkeys(
        (n, rank) for (n, _), at in positions.items() for rank in (math.floor(at), math.ceil(at))
    ))
    found = dict(zip(slots, order_statistics(
        df, [(values[n], rank) for n, rank in slots], [counts[n] for n, _ in slots], buffer_rows
    )))

    def interpolated(n: str, p: float) -> float | None:
        if (n, p) not in positions:
            return None
        at = positions[n, p]
        low, high = found[n, math.floor(at)], found[n, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    return {n: {p: interpolated(n, p) for p in probabilities[n]} for n in names}


def tukey_fences(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5,
                 buffer_rows: int | None = None) -> dict[str, float | None]:
    """Upper fence Q3 + multiplier * IQR per column."""
    found = quantiles(df, {c: (0.25, 0.75) for c in columns}, buffer_rows)
    return {
        c: None if q[0.75] is None else q[0.75] + multiplier * (q[0.75] - q[0.25])
        for c, q in found.items()
    }


@dataclass(frozen=True)
class Tiles:
    """An NTILE column: ``buckets`` equal groups by ``value``, ties broken by the key."""

    name: str
    value: str
    buckets: int = 4
    descending: bool = False


def ntile(df: DataFrame, key: str, tiles: Sequence[Tiles], buffer_rows: int | None = None) -> DataFrame:
    """Add NTILE columns over all rows, without sorting or moving them.

    ``key`` must be a unique whole number, ``value`` numeric and not NULL. The
    first row of each bucket is found by exact selection, first on the value, then
    among its ties on the upper and on the lower half of the key (each exact as a
    double, whatever the key); a row's bucket is then a comparison.
    """
    rows = df.count()
    firsts: list[tuple[Tiles, int, int]] = []
    for t in tiles:
        size, extra = divmod(rows, t.buckets)
        for bucket in range(2, t.buckets + 1):
            rank = (bucket - 1) * size + min(bucket - 1, extra)
            if rank < rows:
                firsts.append((t, bucket, rank))
    number = F.col(key).cast("bigint")
    halves = [F.shiftright(number, 32), number.bitwiseAND(F.lit((1 << 32) - 1))]
    levels = {t.name: [F.col(t.value).cast("double") * (-1.0 if t.descending else 1.0), *halves] for t in tiles}
    tied: list[Column | None] = [None] * len(firsts)
    ranks, sizes = [rank for _, _, rank in firsts], [rows] * len(firsts)
    splits: list[list] = [[] for _ in firsts]
    for level in range(3 if firsts else 0):
        own = [levels[t.name][level] for t, _, _ in firsts]
        among = [c if on is None else F.when(on, c) for c, on in zip(own, tied)]
        values = order_statistics(df, list(zip(among, ranks)), sizes, buffer_rows)
        counts = _one_row(df, [f for c, v in zip(among, values) for f in (F.count_if(c < F.lit(v)), F.count_if(c == F.lit(v)))])
        for i, v in enumerate(values):
            splits[i].append(v)
            ranks[i], sizes[i] = ranks[i] - counts[2 * i], counts[2 * i + 1]
            same = own[i] == F.lit(v)
            tied[i] = same if tied[i] is None else tied[i] & same
    out = {}
    for t in tiles:
        bucket_column = F.lit(1)
        for (other, bucket, _), split in zip(firsts, splits):
            if other.name == t.name:
                a, b, c = levels[t.name]
                v, high, low = (F.lit(s) for s in split)
                reached = (a > v) | ((a == v) & ((b > high) | ((b == high) & (c >= low))))
                bucket_column = F.when(reached, F.lit(bucket)).otherwise(bucket_column)
        out[t.name] = bucket_column.cast("int")
    return df.withColumns(out)
