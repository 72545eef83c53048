"""Top-k search, lexical search and clustering against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterstar.llm import clusters, lexical, queries, topk, vectors

VECTORS = "vec_id bigint, embedding array<float>, label int, dims string, batch string, cluster string"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, term string, rank string"
ITEMS = "item_id bigint, text string, term string, df string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def vector_rows(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], VECTORS)


def whole(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def random_vectors(n, dims, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    x = middle[rng.integers(centres, size=n)] + 0.6 * rng.normal(size=(n, dims))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).tolist()


AWKWARD = [(900, None), (901, []), (902, [0.5, None]), (903, [float("nan"), 0.0]), (904, [float("inf"), 1.0]), (905, [1e30, 0.0])]


def test_whole_vectors_round_down_and_leave_out_what_is_no_vector(spark):
    got = vectors.whole_vectors(vector_rows(spark, [*AWKWARD, (1, [-0.001, 0.5]), (None, [0.25, -1.0])]), 256).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, [-1, 128]), (None, [64, -256])], key=repr)


@pytest.mark.parametrize("size", [1.0, 3e4, 2e6])
def test_lists_give_what_brute_force_gives(size):
    rng = np.random.default_rng(3)
    x = np.floor(size * rng.normal(size=(500, 16))).astype(np.int64)
    x[100:140] = x[99]
    q = np.concatenate([np.floor(size * rng.normal(size=(40, 16))).astype(np.int64), x[99:101], np.zeros((1, 16), np.int64)])
    lists = np.argsort(x, axis=0, kind="stable")
    scores = q @ x.T
    for known in (False, True):
        least = np.sort(scores, axis=1)[:, -6] if known else np.full(len(q), np.iinfo(np.int64).min)
        for own, (rows, found) in zip(scores, topk.read_lists(x, lists, q, least, 6)):
            assert set(np.flatnonzero(own >= np.sort(own)[-6])) == set(rows.tolist())
            assert (own[rows] == found).all()


def test_lists_stop_before_their_ends(monkeypatch):
    x = np.floor(256 * np.array(random_vectors(2000, 32, 5))).astype(np.int64)
    lists, read = np.argsort(x, axis=0, kind="stable"), []
    put = np.put_along_axis
    monkeypatch.setattr(topk.np, "put_along_axis", lambda a, i, v, axis: (read.append(len(i)), put(a, i, v, axis))[1])
    topk.read_lists(x, lists, x[:8], np.sort(x[:8] @ x.T, axis=1)[:, -6], 6)
    assert min(read) > 0  # the last of the depths, where nothing is left unread, was not reached


def brute_top_k(rows, is_query, k):
    usable = {(i, tuple(whole(v, 256))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in v)}
    asking = {}
    for i, v in usable:
        if is_query(i):
            asking[i] = min(asking.get(i, v), v)
    out = []
    for i, v in asking.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(w) == len(v))
        out += [(i, at + 1, j, -s) for at, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def top_k(df, **options):
    rows = topk.exact_top_k(df, F.col("vec_id") % 5 == 0, **options)
    return sorted(map(tuple, rows.select("query_id", "rank", "vec_id", "score").collect()))


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(topk, "BATCH_QUERIES", 8)
    base = random_vectors(150, 12, 7)
    rows = list(enumerate(base)) + [(200 + i, base[3]) for i in range(60)]      # a frequent vector, ids that ask among them
    rows += [(7, base[7]), (10, base[20]), (None, base[5]), (300, [0.5, 0.25]), (301, [0.5, 0.5]), (305, [0.0, 0.0]), *AWKWARD]
    assert top_k(vector_rows(spark, rows)) == brute_top_k(rows, lambda i: i % 5 == 0, 5)


def test_top_k_of_few_or_no_rows(spark):
    assert top_k(vector_rows(spark, [])) == []
    assert top_k(vector_rows(spark, [(5, [1.0, 0.0])])) == []
    assert top_k(vector_rows(spark, [(5, [1.0, 0.0]), (6, [0.5, 0.5])])) == [(5, 1, 6, 256 * 128)]
    assert top_k(vector_rows(spark, AWKWARD)) == []


@pytest.mark.parametrize("k", [1, 2, 16])
def test_walk_finds_the_nearest_and_the_smaller_number(k):
    rng = np.random.default_rng(k)
    centroids = rng.integers(-20, 20, size=(k, 9))
    centroids[-1] = centroids[0]
    x = np.concatenate([rng.integers(-25, 25, size=(400, 9)), centroids])
    every = ((x[:, None, :] - centroids) ** 2).sum(axis=2)
    found, distance = clusters.nearest(x, centroids)
    assert (found == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_walk_ends_early():
    centroids = np.array([[1000 * i] * 4 for i in range(50)])
    steps = []
    original = np.searchsorted
    lists = clusters.sorted_lists(centroids)
    clusters.np.searchsorted = lambda *a: (steps.append(1), original(*a))[1]
    try:
        found, _ = clusters.nearest(np.array([[7002] * 4]), centroids, lists)
    finally:
        clusters.np.searchsorted = original
    assert found.tolist() == [7] and len(steps) == 4


def brute_clusters(rows, k, rounds, components):
    kept = [(i, whole(v, 64)) for i, v in rows if v and len(v) == components and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in v)]
    centres = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        met = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            own = [v for (_, v), m in zip(kept, met) if m == n]
            if own:
                centres[n] = [sum(c) // len(own) for c in zip(*own)]
    last = [(i, *nearest(v)) for i, v in kept]
    own = Counter()
    for _, d, n in last:
        own[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, own[n], sum(own.values()), digest[n]) for i, d, n in last), key=repr)


@pytest.mark.parametrize("n", [0, 3, 120])
def test_clusters_equal_brute_force(spark, n):
    base = random_vectors(max(n, 1), 8, 11)[:n]
    rows = list(enumerate(base)) + [(500 + i, base[0]) for i in range(40 if n > 3 else 0)]
    rows += [(1, base[2]), (None, base[1]), (501, [0.5, 0.25])] if n > 3 else []
    got = clusters.clustered(vector_rows(spark, [*rows, *AWKWARD]), 6, 3, 8, 64)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, 6, 3, 8)


def test_terms_are_the_runs_of_letters_digits_and_higher_characters():
    text = "Ünï Ab9-cD_e\x7ff ÄÖ　x [q] \x00z ẞ\n"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert [t.decode() for t in lexical.terms_of(text)] == TERM.findall(text.translate(lower))
    assert lexical.terms_of(None) == lexical.terms_of(" \t") == []


def brute_search(docs, items, k):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parsed = [(i, Counter(TERM.findall((t or "").translate(lower)))) for i, t in docs]
    parsed = [(i, c) for i, c in parsed if c]
    n_all, l_all = len(parsed), sum(sum(c.values()) for _, c in parsed)
    df = Counter(t for _, c in parsed for t in c)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(TERM.findall((t or "").translate(lower)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, c in parsed:
            m = 10 + 90 * sum(c.values()) * n_all // l_all
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, at + 1, None if none else d, -s) for at, (s, none, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def documents_frame(spark, docs):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", "z") for i, t in docs], SCHEMA)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    odds = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(words, odds, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(30)]                      # copies, so scores tie
    docs += [(None, docs[7][1]), (3, docs[9][1]), (3, docs[9][1]), (n + 90, None), (n + 91, ""), (n + 92, "w1 " * 3000 + "w2")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(2, 25)))) for i in range(30)]
    items += [(40, docs[5][1]), (41, None), (42, "nowhere"), (None, "w1"), (43, "w3"), (43, "w4 w5"), (44, "w0 w1 w2 w3")]
    return docs, items


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("shard, paired", [(4096, 64), (50, 64), (50, 3), (50, 0)])
def test_search_equals_brute_force(spark, monkeypatch, shard, paired):
    monkeypatch.setattr(lexical, "SHARD_DOCUMENTS", shard)
    monkeypatch.setattr(lexical, "BATCH_ITEMS", 16)
    docs, items = corpus()
    index = lexical.build_index(documents_frame(spark, docs).repartition(3), paired_terms=paired)
    assert found(lexical.search(index, items_frame(spark, items))) == brute_search(docs, items, 10)


def test_search_of_empty_tables(spark):
    docs, items = corpus(20)
    empty = lexical.build_index(documents_frame(spark, []))
    assert found(lexical.search(empty, items_frame(spark, items))) == []
    index = lexical.build_index(documents_frame(spark, docs))
    assert found(lexical.search(index, items_frame(spark, []))) == []
    assert found(lexical.search(index, items_frame(spark, items), 1)) == brute_search(docs, items, 1)
    with pytest.raises(ValueError):
        lexical.search(index, items_frame(spark, items), 11)


def one_shard(docs, weights, best=3):
    numbers = {t: i for i, t in enumerate(sorted({t for d in docs for t in d}))}
    cells = sorted((numbers[t], place, c) for place, d in enumerate(docs) for t, c in Counter(d).items())
    starts = np.searchsorted([c[0] for c in cells], np.arange(len(numbers) + 1))
    row = {"terms": b" ".join(numbers), "starts": starts.astype(np.int32).tobytes(), "places": np.array([c[1] for c in cells], np.int32).tobytes(),
           "counts": np.array([c[2] for c in cells], np.int32).tobytes(), "lengths": np.array([len(d) for d in docs], np.int64).tobytes()}
    postings = lexical.Postings(row, len(docs), sum(map(len, docs)))
    own, lists, joint, least = lexical.joint_maxima(postings, weights, len(docs), best)
    pairs = lexical.PairBounds({"paired": own, "lists": lists.tobytes(), "joint": joint.tobytes(), "best": least.tobytes()}, len(docs))
    return postings, pairs


def test_pair_lists_hold_members_and_joint_maxima():
    rng = random.Random(4)
    docs = [rng.choices([b"a", b"b", b"c", b"d"], k=rng.randint(1, 5)) for _ in range(37)]
    weights = {b"a": 5, b"b": 7, b"c": 11}
    postings, pairs = one_shard(docs, weights)
    for a, b in ((b"a", b"b"), (b"c", b"a"), (b"b", b"c")):
        dense = {t: dict(zip(*(x.tolist() for x in postings.list_of(t, weights[t])))) for t in (a, b)}
        both = [i for i, d in enumerate(docs) if a in d and b in d]
        pair = pairs.pair(a, b)
        assert np.flatnonzero(pairs.members(pair)).tolist() == both
        sums = sorted((dense[a][i] + dense[b][i] for i in both), reverse=True)
        assert pairs.joint[pair] == sums[0] and pairs.best[pair] == (sums[2] if len(sums) > 2 else 0)
    assert pairs.pair(b"a", b"d") is None


def test_pair_bounds_skip_documents_that_single_maxima_would_read(monkeypatch):
    # "a" and "b" are strong in different documents, so together they add far less than the sum of their maxima.
    docs = [[b"a"] * 5 for _ in range(40)] + [[b"b"] * 5 for _ in range(40)] + [[b"a", b"b", *[b"x"] * 30]] + [[b"c", b"c"]] * 5
    weights = {b"a": 100, b"b": 100}
    item = [(b"a", 100), (b"b", 100), (b"c", 150)]
    results = {}
    for name, paired in (("pairs", weights), ("single", {})):
        postings, pairs = one_shard(docs, paired)
        read = []
        monkeypatch.setattr(lexical.np, "searchsorted", lambda a, v, *o, f=np.searchsorted: (read.append(len(v)), f(a, v, *o))[1])
        places, scores = lexical.search_shard(postings, pairs, item, 0, 3)
        monkeypatch.undo()
        results[name] = (sorted(places.tolist()), sorted(scores.tolist()))
        optional = len(read)
        results[name + " read"] = optional
    assert results["pairs"] == results["single"]
    assert results["pairs read"] > results["single read"]


def test_registered_queries_have_these_columns(spark):
    sf = "/root/testdata/sf0.001"
    wanted = {
        "op11_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
        "op12_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
        "op13_centroid_clusters": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
    }
    for name, columns in wanted.items():
        assert dict(queries.QUERIES[name](spark, sf).dtypes) == columns
