"""Random forest regression with exact splits and no depth limit.

A task that may hold all rows grows whole trees. Otherwise a node with more rows than one task should hold is split by the
cluster: sums per (tree, node, feature, value), running sums over one range sort, the best boundary of each node; smaller nodes
are finished where their rows meet. All ways choose among every boundary between values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.operators.ranking import ordered_prefix
from meterstar.session import materialise, ship_package

GROUP_ROWS = 500_000             # rows of a node that one task finishes
WHOLE = 4                        # so many groups' rows are still sent whole to each task, which holds them as small numbers
BATCH_TREES = 50                 # trees that one task grows from the same rows at most, if it may hold them all
BROADCAST_BYTES = 64 << 20       # trees up to this size go to all tasks at a time
LEAST_LEAF = 2
_EQUAL = 1e-24                   # rows whose squares around their mean are such a part of their squares are equal
FEW_ROWS = 256                   # rows at a node that walk on one node at a time
FEW_NODE_ROWS = 4096             # a node with fewer rows is finished together with others
FEW_VALUES = 1 << 16             # a feature with more values is sorted anew in each node
_NARROW = 1e-6                   # sums around a centre serve nodes with at least such a part of the first node's mean square
_ROW = float(1 << 26)            # counts a row above the sum of its weights; a task holds fewer rows
GRAINS = 1e9                     # gains are compared in such parts of a node's squares; smaller differences are rounding
_ALL, _P1, _P2, _P3, _P5 = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5  # of xxhash64
_POISSON = np.cumsum([np.exp(-1.0)] + [np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(1, 15)])
_TREE = "tree int, node string, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
_NODE = ["tree", "node"]


@dataclass
class Tree:
    """Nodes of one tree as arrays, the root first; a leaf has feature -1.

    A number at or below the threshold goes left; a category goes right if it is the threshold.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray, numeric: int) -> np.ndarray:
        return self.predict_columns(list(np.ascontiguousarray(x.T)), numeric)

    def predict_columns(self, columns: list[np.ndarray], numeric: int) -> np.ndarray:
        """The tree's value for each row of the feature columns.

        Many rows at one node are parted together; few rows walk down one node at a time, all of them at once.
        """
        n = len(columns[0]) if columns else 0
        out, at = np.empty(n), np.full(n, -1, np.int64)
        todo = [(0, np.arange(n))]
        while todo:
            node, rows = todo.pop()
            f = self.feature[node]
            if f < 0:
                out[rows] = self.value[node]
            elif len(rows) < FEW_ROWS:
                at[rows] = node
            else:
                own, limit = columns[f][rows], self.threshold[node]
                right = own > limit if f < numeric else own == limit
                todo += [(self.left[node], rows[~right]), (self.right[node], rows[right])]
        open_ = np.flatnonzero(at >= 0)
        if len(open_):
            x = np.stack([c[open_] for c in columns])
            node, left = at[open_], np.arange(len(open_))
            while len(left):
                now = node[left]
                f = self.feature[now]
                own, limit = x[f, left], self.threshold[now]
                right = np.where(f < numeric, own > limit, own == limit)
                node[left] = now = np.where(right, self.right[now], self.left[now])
                left = left[self.feature[now] >= 0]
            out[open_] = self.value[node]
        return out


@dataclass
class Ranked:
    """Per feature its values in order and each row's place among them."""

    values: list[np.ndarray]
    codes: list[np.ndarray]

    @classmethod
    def of(cls, columns: Iterator[np.ndarray]) -> Ranked:
        out = cls([], [])
        for column in columns:
            values, codes = np.unique(column, return_inverse=True)
            small = np.uint8 if len(values) <= 1 << 8 else np.uint16 if len(values) <= 1 << 16 else np.int32
            out.values.append(values.astype(float))
            out.codes.append(codes.astype(small))
        return out

    def threshold(self, feature: int, at: int, after: int, category: bool) -> float:
        """Between two neighbours of a node, such that the upper one lies above it; of categories the one itself."""
        low, high = self.values[feature][at], self.values[feature][after]
        half = (low + high) / 2
        return float(low if category or not half < high else half)


def _by_code(code: np.ndarray) -> np.ndarray:
    """The rows by code, equals as they come. Numbers of 16 bits are sorted by radix, several times faster than wider ones."""
    if code.dtype.itemsize <= 2:
        return np.argsort(code, kind="stable")
    low = np.argsort((code & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((code >> 16).astype(np.uint16)[low], kind="stable")]


@dataclass
class _Sums:
    """A node's sums per value of every feature with few values, one feature after the other.

    ``both`` has rows and weight in one number, ``s`` weighted distances from ``centre``, around which the rows of the first
    node with this centre had the mean square ``spread``.
    """

    both: np.ndarray
    s: np.ndarray
    centre: float
    spread: float

    @classmethod
    def of(cls, rows: np.ndarray, own: np.ndarray, weights: np.ndarray, ranked: Ranked, centre: float, spread: float | None = None) -> _Sums:
        both, apart = weights + _ROW, own - centre
        s = weights * apart
        found = [(codes[rows], len(values)) for codes, values in zip(ranked.codes, ranked.values) if len(values) <= FEW_VALUES]
        parts = [np.concatenate([np.bincount(c, a, n) for c, n in found]) if found else np.zeros(0) for a in (both, s)]
        return cls(*parts, centre, float((s * apart).sum() / weights.sum()) if spread is None else spread)


def _grains(lw: np.ndarray, ls: np.ndarray, weight: np.ndarray, total: np.ndarray, parent: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Gains of splits in whole grains, from weight and sum of one side and of the node."""
    rs = total - ls
    return np.floor((ls * ls / lw + rs * rs / (weight - lw) - parent) / square * GRAINS + 0.5)


def _best_split(rows: np.ndarray, w: np.ndarray, s: np.ndarray, mean: float, square: float, sums: _Sums, ranked: Ranked, numeric: int, leaf: int) -> tuple | None:
    """(feature, code, next code) of one node's best split, if any gains; ``s`` are weighted distances from its mean."""
    weight, total = w.sum(), s.sum()
    parent = total**2 / weight
    best, out, start = 0.0, None, 0
    for f, codes in enumerate(ranked.codes):
        size = len(ranked.values[f])
        if size <= FEW_VALUES:
            both = sums.both[start:start + size]
            found = np.flatnonzero(both)
            both = both[found]
            ln = np.floor(both / _ROW)
            lw = both - ln * _ROW
            ls = sums.s[start:start + size][found] - lw * (mean - sums.centre)
            start += size
        else:
            code = codes[rows]
            order = _by_code(code)
            code = code[order]
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            found, ln = code[first], np.diff(np.append(first, len(code)))
            lw, ls = np.add.reduceat(w[order], first), np.add.reduceat(s[order], first)
        if f < numeric:
            ln, lw, ls = np.cumsum(ln), np.cumsum(lw), np.cumsum(ls)
        at = np.flatnonzero((ln >= leaf) & (len(rows) - ln >= leaf))
        if not len(at):
            continue
        gain = _grains(lw[at], ls[at], weight, total, parent, square)
        top = int(np.argmax(gain))                                  # the first of equals
        if gain[top] > best:
            best, i = gain[top], at[top]
            out = f, int(found[i]), int(found[min(i + 1, len(found) - 1)])
    return out


class _Nodes:
    """A tree that grows: its nodes as lists."""

    def __init__(self) -> None:
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def add(self, values: list[float]) -> int:
        """Add leaves; the number of the first."""
        first, n = len(self.value), len(values)
        for column, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0)):
            column.extend([empty] * n)
        self.value.extend(values)
        return first

    def split(self, name: int, feature: int, threshold: float, left: int) -> None:
        """Make a leaf a node whose children are ``left`` and the one after it."""
        self.feature[name], self.threshold[name], self.left[name], self.right[name] = feature, threshold, left, left + 1

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int64), np.array(self.threshold, float), np.array(self.left, np.int64), np.array(self.right, np.int64), np.array(self.value, float))


def _grow_small(out: _Nodes, nodes: list[tuple[int, int, np.ndarray]], y: np.ndarray, w: np.ndarray, ranked: Ranked, numeric: int, leaf: int, depth: int | None) -> None:
    """Finish nodes (name, level, rows) level by level, all of them and all features at once.

    Each feature has the rows by node and, within it, by value; so the places of a node are the same for all features.
    """
    rows = np.concatenate([r for _, _, r in nodes])
    codes = np.stack([c[rows] for c in ranked.codes]).astype(np.int32)
    y, w = y[rows], w[rows]
    names, level = np.array([n for n, _, _ in nodes]), np.array([d for _, d, _ in nodes])
    sizes, means = np.array([len(r) for _, _, r in nodes]), np.array([out.value[n] for n, _, _ in nodes])
    node = np.repeat(np.arange(len(sizes)), sizes)
    short = node.astype(np.uint16)
    places = np.stack([o[np.argsort(short[o], kind="stable")] for o in map(_by_code, codes)])
    value = np.take_along_axis(codes, places, 1)
    features = len(codes)
    while len(names):
        # Nodes that are pure, too small or deep enough stay leaves.
        held = places[0]
        at, hw, hy = node[held], w[held], y[held]
        weight = np.bincount(at, hw, len(names))
        apart = hy - means[at]
        s = np.zeros(len(rows))
        s[held] = hs = hw * apart
        total = np.bincount(at, hs, len(names))
        square = np.bincount(at, hs * apart, len(names))
        live = (square > _EQUAL * np.bincount(at, hw * hy * hy, len(names))) & (sizes >= 2 * leaf)
        if depth is not None:
            live &= level < depth
        if not live.any():
            return
        if not live.all():
            stays = np.flatnonzero(np.repeat(live, sizes))
            places, value = places.take(stays, 1), value.take(stays, 1)
            held = places[0]
            node[held] = (np.cumsum(live) - 1)[node[held]]
            names, level, sizes, weight, total, square = (a[live] for a in (names, level, sizes, weight, total, square))
        parent = total**2 / weight
        m, k = places.shape[1], len(names)
        seg = np.repeat(np.arange(k), sizes)
        starts = np.cumsum(sizes) - sizes
        nth = np.arange(m) - starts[seg] + 1
        place_s, place_w = s[places], w[places]
        change = np.ones((features, m), bool)                       # another value than the place before
        np.not_equal(value[:, 1:], value[:, :-1], out=change[:, 1:])
        # Numbers: every boundary between values, by running sums within the node.
        up_w, up_s = np.cumsum(place_w[:numeric], axis=1), np.cumsum(place_s[:numeric], axis=1)
        room = (nth >= leaf) & (sizes[seg] - nth >= leaf)
        ends = np.zeros((numeric, m), bool)
        np.logical_and(change[:numeric, 1:], room[:-1], out=ends[:, :-1])
        at = np.flatnonzero(ends)
        f = np.repeat(np.arange(numeric), np.count_nonzero(ends, axis=1))
        p = at - f * m
        own = seg[p]
        before = f * k + own
        lw = up_w.ravel()[at] - (up_w[:, starts] - place_w[:numeric, starts]).ravel()[before]
        ls = up_s.ravel()[at] - (up_s[:, starts] - place_s[:numeric, starts]).ravel()[before]
        # Categories: every one against the rest, by sums over its rows.
        if numeric < features:
            first = change[numeric:]
            first[:, starts] = True
            run = np.flatnonzero(first)
            rn = np.diff(np.append(run, first.size))
            cf = np.repeat(np.arange(features - numeric), np.count_nonzero(first, axis=1))
            cp = run - cf * m
            fits = (rn >= leaf) & (sizes[seg[cp]] - rn >= leaf)
            lw = np.concatenate([lw, np.add.reduceat(place_w[numeric:].ravel(), run)[fits]])
            ls = np.concatenate([ls, np.add.reduceat(place_s[numeric:].ravel(), run)[fits]])
            f, p = np.concatenate([f, cf[fits] + numeric]), np.concatenate([p, cp[fits]])
            own = seg[p]
        gain = _grains(lw, ls, weight[own], total[own], parent[own], square[own])
        best = np.zeros(k)
        np.maximum.at(best, own, gain)
        top = np.flatnonzero((gain == best[own]) & (gain > 0))[::-1]
        chosen = np.full(k, -1)
        chosen[own[top]] = top                                      # the first of equals is written last
        split = chosen >= 0
        if not split.any():
            return
        if not split.all():
            stays = np.flatnonzero(split[seg])
            new = np.cumsum(split) - 1
            p = (np.cumsum(split[seg]) - 1)[p]                      # of the chosen ones, all of which stay
            places, value = places.take(stays, 1), value.take(stays, 1)
            held = places[0]
            node[held] = new[node[held]]
            names, level, sizes, chosen = names[split], level[split], sizes[split], chosen[split]
            m, k = len(stays), len(names)
            seg = np.repeat(np.arange(k), sizes)
            starts = np.cumsum(sizes) - sizes
        f, p = f[chosen], p[chosen]
        code, after = value[f, p], value[f, np.minimum(p + 1, m - 1)]
        left = out.add([0.0] * (2 * k))
        for i, (name, a, b, c) in enumerate(zip(names.tolist(), f.tolist(), code.tolist(), after.tolist())):
            out.split(name, a, ranked.threshold(a, b, c, a >= numeric), left + 2 * i)
        held = places[0]
        at = node[held]
        own = codes[f[at], held]
        goes = np.zeros(len(rows), bool)
        goes[held] = right = np.where(f[at] < numeric, own > code[at], own == code[at])
        node[held] = at = 2 * at + right
        names, level = left + np.arange(2 * k), np.repeat(level + 1, 2)
        sizes = np.bincount(at, minlength=2 * k)
        means = np.bincount(at, w[held] * y[held], 2 * k) / np.bincount(at, w[held], 2 * k)
        out.value[left:] = means.tolist()
        # Within a node the left rows come first, both sides in the order they had.
        part = goes[places]
        ups = np.cumsum(part, axis=1)
        gone = (np.cumsum(sizes[1::2]) - sizes[1::2])[seg]          # rows that went right before the node
        to = np.where(part, ups + (starts + sizes[::2])[seg] - gone - 1, np.arange(m) + gone - ups)
        to += np.arange(features)[:, None] * m
        moved = np.empty_like(places), np.empty_like(value)
        for new, old in zip(moved, (places, value)):
            new.ravel()[to.ravel()] = old.ravel()
        places, value = moved


def grown(x: np.ndarray | None, y: np.ndarray, w: np.ndarray, numeric: int, leaf: int = LEAST_LEAF, depth: int | None = None,
          ranked: Ranked | None = None) -> Tree:
    """One tree on all given rows: least squares, every boundary tried, until leaves are pure or have too few rows.

    The first ``numeric`` columns are numbers, the others categories, split one against the rest. Equal gains go to the
    first feature, then to the smallest value. Weights are whole numbers. ``ranked`` has the columns of ``x``, if the caller has them.

    A node with many rows is split by itself, by sums per value; smaller ones are finished together.
    """
    ranked = Ranked.of(x.T) if ranked is None else ranked
    y, w = y.astype(float, copy=False), w.astype(float)
    out, rows = _Nodes(), np.flatnonzero(w > 0)
    if not len(rows):
        out.add([0.0])
        return out.tree()
    out.add([float((w[rows] * y[rows]).sum() / w[rows].sum())])
    todo, small, held = [(0, 0, rows, None)], [], 0
    while todo:
        name, level, rows, sums = todo.pop()
        if len(rows) < FEW_NODE_ROWS:
            small.append((name, level, rows))
            held += len(rows)
            if held >= 2 * FEW_NODE_ROWS:
                _grow_small(out, small, y, w, ranked, numeric, leaf, depth)
                small, held = [], 0
            continue
        own, weights, mean = y[rows], w[rows], out.value[name]
        apart = own - mean
        s = weights * apart
        square = float((s * apart).sum())
        if square <= _EQUAL * float((weights * own * own).sum()) or (depth is not None and level >= depth):
            continue
        if sums is None:
            sums = _Sums.of(rows, own, weights, ranked, float(np.rint(mean)))      # scores in halves have exact sums
        if square < _NARROW * sums.spread * float(weights.sum()):
            sums = _Sums.of(rows, own, weights, ranked, mean)                      # differences of sums would be mostly rounding
        found = _best_split(rows, weights, s, mean, square, sums, ranked, numeric, leaf)
        if found is None:
            continue
        f, code, after = found
        values = ranked.codes[f][rows]
        right = values > code if f < numeric else values == code
        sides = [np.flatnonzero(side) for side in (~right, right)]
        left = out.add([float((weights[side] * own[side]).sum() / weights[side].sum()) for side in sides])
        out.split(name, f, ranked.threshold(f, code, after, f >= numeric), left)
        # The larger side's sums are the node's less those of the smaller one, which is finished first, so that few sums are held.
        few = int(len(sides[1]) < len(sides[0]))
        part = None
        if len(sides[1 - few]) >= FEW_NODE_ROWS:
            part = _Sums.of(rows[sides[few]], own[sides[few]], weights[sides[few]], ranked, sums.centre, sums.spread)
            sums.both -= part.both
            sums.s -= part.s
        todo += [(left + 1 - few, level + 1, rows[sides[1 - few]], sums), (left + few, level + 1, rows[sides[few]], part)]
    if small:
        _grow_small(out, small, y, w, ranked, numeric, leaf, depth)
    return out.tree()


@dataclass
class Forest:
    """Subtrees (one row each, ``node`` is the way to its root) and the splits above them."""

    subtrees: DataFrame
    splits: DataFrame | None
    numeric: int
    trees: int

    def bytes(self) -> int:
        """Size of all subtrees."""
        return self.subtrees.agg(F.coalesce(F.sum(28 * F.size("feature")), F.lit(0))).first()[0]


def _weight(tree: Column | str) -> Column:
    """How often a tree's bootstrap sample has a row: a Poisson draw by a hash of the tree and ``_h``, the hashed key."""
    draw = F.shiftrightunsigned(F.xxhash64("_h", tree), 11).cast("double") / float(1 << 53)
    return reduce(lambda a, b: a + b, [(draw >= F.lit(float(p))).cast("int") for p in _POISSON])


def _members(rows: DataFrame, trees: int, key: str, seed: int) -> DataFrame:
    """The rows of each tree's bootstrap sample with their weights."""
    every = rows.select(F.xxhash64(F.lit(seed), key).alias("_h"), "y", "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    return every.withColumn("w", _weight("tree")).where("w > 0").select("tree", F.lit("").alias("node"), "w", "y", "x")


def _features(group: pa.Table | pa.RecordBatch) -> np.ndarray:
    x = group.column("x")
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return x.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)


def _stored(trees: list[tuple[int, str, Tree]]) -> pa.Table:
    """Subtrees (tree, way to the root, nodes) as rows of ``_TREE``."""
    names = [c.split(" ")[0] for c in _TREE.split(", ")]
    kinds = [pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64())]
    columns = [[t for t, _, _ in trees], [n for _, n, _ in trees], *[[getattr(g, c).tolist() for _, _, g in trees] for c in names[2:]]]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _narrow(a: np.ndarray) -> np.ndarray:
    """A copy in the smallest kind of numbers that has the same values."""
    with np.errstate(invalid="ignore", over="ignore"):
        return next((b for b in map(a.astype, (np.int8, np.int16, np.float32)) if (b == a).all()), a.copy())


def _drawn(hashed: np.ndarray, tree: int) -> np.ndarray:
    """``_weight`` of one tree for rows whose ``xxhash64(_h)`` is given."""
    h = (hashed + np.uint64(_P5 + 4)) ^ np.uint64(tree * _P1 & _ALL)
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * np.uint64(_P2) + np.uint64(_P3)
    for shift, prime in ((33, _P2), (29, _P3)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(prime)
    draw = ((h ^ (h >> np.uint64(32))) >> np.uint64(11)).astype(float) / float(1 << 53)
    w = np.zeros(len(draw), np.int8)
    for p in _POISSON:
        above = draw >= p
        if not above.any():
            break
        w += above
    return w


def _whole_trees(rows: DataFrame, numeric: int, trees: int, leaf: int, depth: int | None, key: str, seed: int) -> DataFrame:
    """All trees on rows that one task may hold: each task gets the rows once, draws each of its trees' samples and grows them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    batches = min(trees, cores * -(-trees // (BATCH_TREES * cores)))      # all cores have as many trees
    every = F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))
    hashed = rows.select(F.xxhash64(F.xxhash64(F.lit(seed), key)).alias("h"), "y", "x", every.alias("batch"))

    def finish(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        parts = [(b.column("batch")[0].as_py(), b.column("h").to_numpy().copy(), _narrow(b.column("y").to_numpy()), [_narrow(c) for c in _features(b).T]) for b in tables if b.num_rows]
        if not parts:
            return
        hashed, y = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        # The order of arrival must not decide between sums that differ in rounding only.
        order = np.argsort(hashed, kind="stable")
        columns = range(len(parts[0][3]))
        if (np.diff(hashed[order]) == 0).any():
            order = np.lexsort([*(np.concatenate([p[3][f] for p in parts]) for f in columns), y, hashed])
        y, hashed = y[order].astype(float), hashed[order].view(np.uint64)
        ranked = Ranked.of(np.concatenate([p[3][f] for p in parts])[order] for f in columns)
        batch = parts[0][0]
        del parts
        for tree in range(batch, trees, batches):
            w = _drawn(hashed, tree)
            if w.any():
                yield _stored([(tree, "", grown(None, y, w, numeric, leaf, depth, ranked))])

    # Each batch is a partition of its own.
    dealt = hashed.repartitionById(batches, "batch")
    return dealt.mapInArrow(lambda tables: (b for t in finish(tables) for b in t.to_batches()), _TREE)


def _goes_right(numeric: int) -> Column:
    own = F.get("x", F.col("feature"))
    return F.when(F.col("feature") < numeric, own > F.col("threshold")).otherwise(own == F.col("threshold"))


def _level_splits(big: DataFrame, numeric: int, leaf: int) -> DataFrame:
    """The best split of every node: ``tree, node, feature, threshold``; nodes that cannot be split are left out."""
    apart = F.col("y") - F.col("mean")
    cells = big.select(*_NODE, "w", (F.col("w") * apart).alias("s"), (F.col("w") * apart * apart).alias("q"), (F.col("w") * F.col("y") * F.col("y")).alias("z"),
                       F.posexplode("x").alias("feature", "v"))
    stats = materialise(cells.groupBy(*_NODE, "feature", "v").agg(
        F.sum("w").cast("double").alias("w"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"), F.sum("z").alias("z")))
    totals = stats.where("feature = 0").groupBy(*_NODE).agg(*[F.sum(c).alias(f"all_{c}") for c in ("w", "s", "n", "q", "z")])
    numbers = stats.where(F.col("feature") < numeric)
    by = [*_NODE, "feature"]
    summed = materialise(ordered_prefix(numbers, [*map(F.col, by), F.col("v")], {"cw": F.col("w"), "cs": F.col("s"), "cn": F.col("n")}))
    before = summed.groupBy(*by).agg(F.min_by(F.struct((F.col("cw") - F.col("w")).alias("w"), (F.col("cs") - F.col("s")).alias("s"), (F.col("cn") - F.col("n")).alias("n")), "v").alias("b"))
    left = summed.join(before, by).select(*by, "v", (F.col("cw") - F.col("b.w")).alias("w"), (F.col("cs") - F.col("b.s")).alias("s"), (F.col("cn") - F.col("b.n")).alias("n"))
    left = left.unionByName(stats.where(F.col("feature") >= numeric).select(*by, "v", "w", "s", "n"))
    other_w, other_s = F.col("all_w") - F.col("w"), F.col("all_s") - F.col("s")
    allowed = left.join(totals, _NODE).where((F.col("n") >= leaf) & (F.col("all_n") - F.col("n") >= leaf))
    parent = F.col("all_s") ** 2 / F.col("all_w")
    square = F.col("all_q")
    share = F.when(square > F.col("all_z") * _EQUAL, (F.col("s") ** 2 / F.col("w") + other_s**2 / other_w - parent) / square)
    rated = allowed.withColumn("gain", F.floor(share * GRAINS + 0.5)).where("gain > 0")
    best = rated.groupBy(*_NODE).agg(F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("v")).alias("v"))).alias("b"))
    best = best.select(*_NODE, (-F.col("b.f")).alias("feature"), (-F.col("b.v")).alias("at"))
    # The threshold lies halfway to the next value of the node.
    renamed = stats.select(F.col("tree").alias("t"), F.col("node").alias("m"), F.col("feature").alias("f"), "v")
    after = best.join(renamed, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("m")) & (F.col("feature") == F.col("f")) & (F.col("v") > F.col("at")))
    after = after.groupBy(*_NODE).agg(F.min("v").alias("next"))
    threshold = F.when(F.col("feature") < numeric, (F.col("at") + F.col("next")) / 2).otherwise(F.col("at"))
    return best.join(after, _NODE, "left").select(*_NODE, F.col("feature").cast("int").alias("feature"), threshold.alias("threshold"))


def fit_forest(rows: DataFrame, numeric: int, trees: int = 250, leaf: int = LEAST_LEAF, depth: int | None = None, key: str = "UsageID",
               seed: int = 42, group_rows: int = GROUP_ROWS) -> Forest:
    """Grow ``trees`` trees on rows with ``key``, ``y`` and ``x`` (numbers first, then category numbers).

    Each tree sees a bootstrap sample and tries all features at every node. Up to ``WHOLE * group_rows`` rows go whole to every task;
    of more rows no task holds more than ``group_rows`` of a node. The driver holds none. Samples depend on keys alone, so
    partitioning changes nothing.
    """
    ship_package(rows.sparkSession)
    rows = materialise(rows.select(key, "y", "x"))
    if rows.count() <= WHOLE * group_rows:
        return Forest(materialise(_whole_trees(rows, numeric, trees, leaf, depth, key, seed)), None, numeric, trees)
    members = materialise(_members(rows, trees, key, seed))
    done, splits, level = [], [], 0
    while True:
        mean = F.sum(F.col("w") * F.col("y")) / F.sum("w")
        sizes = materialise(members.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n"), mean.alias("mean")))
        large = sizes.where(F.col("n") > group_rows).drop("n")
        if large.isEmpty() or (depth is not None and level >= depth):
            done.append(members)
            break
        level += 1
        big = members.join(large, _NODE)
        found = materialise(_level_splits(big, numeric, leaf))
        splits.append(found)
        done.append(members.join(large.select(*_NODE), _NODE, "left_anti"))
        moved = big.join(found, _NODE, "left")
        leafs = moved.where("feature IS NULL")                      # pure, or without an allowed split: sums are all that is left
        ends = leafs.groupBy(*_NODE).agg(F.lit(1).alias("w"), F.first("mean").alias("y"), F.min("x").alias("x"))
        done.append(ends.select("tree", "node", "w", "y", "x"))
        child = F.concat("node", F.when(_goes_right(numeric), "1").otherwise("0"))
        members = materialise(moved.where("feature IS NOT NULL").select("tree", child.alias("node"), "w", "y", "x"))

    def finish(key: tuple, group: pa.Table) -> pa.Table:
        # The order of arrival must not decide between sums that differ in rounding only.
        x, y, w = _features(group), group.column("y").to_numpy(), group.column("w").to_numpy()
        order = np.lexsort([y, w, *x.T])
        left = None if depth is None else depth - len(key[1].as_py())
        return _stored([(key[0].as_py(), key[1].as_py(), grown(x[order], y[order], w[order], numeric, leaf, left))])

    small = reduce(DataFrame.unionByName, done)
    subtrees = materialise(small.groupBy(*_NODE).applyInArrow(finish, _TREE))
    return Forest(subtrees, materialise(reduce(DataFrame.unionByName, splits)) if splits else None, numeric, trees)


def _as_trees(stored: pa.Table) -> list[Tree]:
    names = [c.split(" ")[0] for c in _TREE.split(", ")][2:]
    return [Tree(*[stored.column(c)[i].values.to_numpy() for c in names]) for i in range(stored.num_rows)]


def _as_tree(row: dict) -> Tree:
    return Tree(*[np.asarray(row[c]) for c in ("feature", "threshold", "left", "right", "value")])


def _value_sums(subtrees: DataFrame, numeric: int, x: str) -> tuple[Column, Broadcast]:
    """Sum of the values of some whole trees, and the trees, which all tasks have."""
    # Trees in their own order, so that the sum is the same however they were stored.
    packed = subtrees.sparkSession.sparkContext.broadcast(_as_trees(subtrees.orderBy(*_NODE).toArrow()))

    @F.arrow_udf("double")
    def value_sum(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            total = np.zeros(len(batch))
            if len(batch):
                columns = list(np.ascontiguousarray(batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1).T))
                for tree in packed.value:
                    total += tree.predict_columns(columns, numeric)
            yield pa.array(total)

    return value_sum(x), packed


def predict_forest(model: Forest, df: DataFrame, x: str = "x", name: str = "prediction", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the mean of all trees' values; ``x`` has the features as in the fit."""
    numeric = model.numeric
    packs = 0 if model.splits is not None else min(model.trees, max(1, -(-model.bytes() // max(broadcast_bytes, 1))))
    if packs == 1:
        total, packed = _value_sums(model.subtrees, numeric, x)
        return df.withColumn(name, total / float(max(len(packed.value), 1)))
    keyed = materialise(df.withColumn("_rid", F.monotonically_increasing_id()))
    if packs:
        # The driver and the tasks hold one pack of trees at a time, and the rows stay where they are.
        sums, held = [], 0
        for i in range(packs):
            total, packed = _value_sums(model.subtrees.where(F.col("tree") % packs == i), numeric, x)
            sums.append(materialise(keyed.select("_rid", total.alias("_v"))))
            held += len(packed.value)
            packed.unpersist()
        each = reduce(DataFrame.unionByName, sums).groupBy("_rid").agg((F.sum("_v") / float(max(held, 1))).alias(name))
        return keyed.join(each, "_rid").drop("_rid")
    routed = keyed.select("_rid", F.col(x).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(model.trees - 1))).alias("tree"), F.lit("").alias("node"))
    settled = []
    for _ in range(model.splits.agg(F.coalesce(F.max(F.length("node")), F.lit(-1))).first()[0] + 1):
        routed = routed.join(model.splits, _NODE, "left")
        settled.append(routed.where("feature IS NULL").select("_rid", "x", *_NODE))
        child = F.concat("node", F.when(_goes_right(numeric), "1").otherwise("0"))
        routed = materialise(routed.where("feature IS NOT NULL").select("_rid", "x", "tree", child.alias("node")))
    routed = materialise(reduce(DataFrame.unionByName, settled, routed.select("_rid", "x", *_NODE)))
    # A subtree that many rows reach is sent to several groups of them.
    parts = materialise(routed.groupBy(*_NODE).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("parts")))
    left = routed.join(parts, _NODE).withColumn("part", F.pmod(F.xxhash64("_rid"), F.col("parts")).cast("int")).drop("parts")
    right = model.subtrees.join(parts, _NODE).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def values(key: tuple, rows: pa.Table, tree: pa.Table) -> pa.Table:
        found = _as_tree(tree.to_pylist()[0]).predict(_features(rows), numeric)
        return pa.table({"_rid": rows.column("_rid"), "_v": pa.array(found)})

    keys = (*_NODE, "part")
    each = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(values, "_rid bigint, _v double")
    return keyed.join(each.groupBy("_rid").agg(F.avg("_v").alias(name)), "_rid").drop("_rid")
