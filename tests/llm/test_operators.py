"""Small fixtures for the training-data operators: brute force, round trips and awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import struct
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterstar.llm import (
    components,
    fingerprints,
    held,
    importance,
    mixing,
    near_dup,
    oracles,
    outliers,
    packing,
    queries,
    shards,
    substring,
    token_codes,
    tokens,
    warc,
    words,
)
from meterstar.llm.inputs import picked

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, component_id string, size string"


def make(spark, texts, ids=None, source="s"):
    rows = [(i, t, "en", source, None if t is None else len(t), "x", "y", "z") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(300)]
    base = [rng.choices(vocabulary, k=rng.randint(3, 160)) for _ in range(40)]
    near = []
    for w in base[:20]:
        for _ in range(3):
            changed = list(w)
            changed[rng.randrange(len(w))] = rng.choice(vocabulary)
            near.append(changed)
    shared = rng.choices(vocabulary, k=70)
    pasted = [w[:5] + shared[rng.randint(0, 15):70] + w[5:] for w in base[20:30]]
    out = [" ".join(w) for w in base + near + pasted]
    return [*out, out[3], out[3].upper(), "", None, " \t\n", "one", "One", "a b c d"]


def test_words_hash_alike_wherever_they_stand():
    assert words.words(" a\tB\x0bc d\n") == [b"a", b"B", "c d".encode()]
    assert np.array_equal(words.hashes("AB cé", lower=True), words.hashes("\n ab  cé ", lower=True))
    assert len(words.hashes(None)) == 0
    h = words.hashes("a b c a b c d")
    w = words.windows(h, 3)
    assert w[0] == w[3] and len(set(w.tolist())) == 4 and len(words.windows(h, 8)) == 0


def test_components_reach_the_smallest(spark):
    path = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 60), (70, 70)]
    found = dict(components.components(spark.createDataFrame(path, "a bigint, b bigint")).collect())
    assert found == {**{i: 1 for i in range(1, 31)}, 40: 40, 50: 40, 60: 40}


def brute_groups(rows, least=0.85):
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in (t or "").split()]
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if sets[a] & sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                group[a] = group[b] = min(group[a], group[b])
    return {i: (len(sets[i]), group[i]) for i in sets}


def test_near_duplicates_against_brute_force(spark, texts):
    found = near_dup.near_duplicates(make(spark, texts), 0.85).collect()
    wanted = brute_groups(list(enumerate(texts)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_open_buckets_are_settled(spark, monkeypatch):
    # copies of copies: the first is like the second, the second like the third, and so on
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    rng = random.Random(2)
    text = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    chain = []
    for k in range(14):
        text[k * 14:k * 14 + 3] = [f"x{k}{j}" for j in range(3)]
        chain.append(" ".join(text))
    ids = list(range(14))
    rng.shuffle(ids)
    found = near_dup.near_duplicates(make(spark, chain, ids), 0.85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_groups(list(zip(ids, chain)))


def test_near_duplicates_of_awkward_rows(spark):
    df = make(spark, ["a b", "a b", "c", None, "a b"], [5, 5, None, 3, 2])
    found = sorted(tuple(r) for r in near_dup.near_duplicates(df).collect() if r.doc_id is not None)
    assert found == [(2, 1, 2, True), (3, 0, 3, True), (5, 1, 2, False), (5, 1, 2, False)]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0
    assert near_dup.without_near_duplicates(df).columns == df.columns


def test_rows_that_share_a_key_keep_the_links_of_each_text(spark):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a), (2, "something else that no other text says"), (2, a + " more"), (3, a + " more"), (4, "far away from all of them"), (None, a)]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id) == [
        (1, 56, 1), (2, 3, 1), (2, 57, 1), (3, 57, 1), (4, 2, 4)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]
    chain = [(k % 3, " ".join(f"w{i}" for i in range(k, k + 40))) for k in range(0, 12)]
    found = near_dup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert len(found) == 12 and {r.component_id for r in found} == {0}


def test_fingerprint_is_a_sum_over_paragraphs():
    of = fingerprints.Fingerprint.of_text
    assert of("a.\nb, c\nd") == of("d\na.\nb, c") != of("a.\nb, c")
    assert of("a\nb") + of("c") == of("a\nb\nc") and of("a\nb\nc") - of("c") == of("b\na")
    assert of(None) == of("") and of("a\na") != of("a")
    again = fingerprints.Fingerprint.from_hex(of("x. y").hex())
    assert again == of("x. y") and again.likeness(of("x. y")) == 1.0
    many = [f"line {i}" for i in range(400)]
    assert 0.4 < of("\n".join(many)).likeness(of("\n".join(many[:200] + [f"new {i}" for i in range(200)]))) < 0.6


def test_likeness_of_very_many_clauses():
    """Counts that agree modulo 2**16 are not alike."""
    tail = [f"clause {i}" for i in range(50)]
    many, few = (fingerprints.Fingerprint.of_paragraphs(["again"] * n + tail) for n in (70_000, 70_000 - 65_536))
    counts = np.array([70_000.0, 4_464.0])
    wanted = 1 - (counts[0] - counts[1]) ** 2 / ((counts ** 2).sum() + 100)
    assert abs(many.likeness(few) - wanted) < 0.02
    assert fingerprints.Fingerprint.from_hex(many.hex()) == many


def test_neighbours_of_hot_keys_are_dealt(spark):
    """Rows without an id, and of one id, are cut into parts; all have the right neighbour."""
    ids = [None] * 40 + [7] * 40 + list(range(8, 28))
    df = make(spark, [f"text {i}" for i in range(100)], ids)
    dealt = [(r.part, r.head, r.doc_id, r.text) for r in fingerprints.with_neighbours(picked(df, doc_id="doc_id", text="text")).collect()]
    assert len({p for p, head, i, _ in dealt if i is None and not head}) > 1
    assert len({p for p, head, i, _ in dealt if i == 7 and not head}) > 1
    found = fingerprints.fingerprints(df).collect()
    of = {t: fingerprints.Fingerprint.of_text(t) for t in (f"text {i}" for i in range(100))}
    texts = {of[t].hex(): t for t in of}
    assert sorted(texts[r.fingerprint] for r in found) == sorted(of)
    order = [(i, t) for _, head, i, t in sorted(dealt, key=lambda d: d[0]) if not head]
    assert [i for i, _ in order] == sorted([i for i in ids if i], reverse=True) + [None] * 40
    following = {t: order[(n + 1) % 100][1] for n, (_, t) in enumerate(order)}
    for r in found:
        t = texts[r.fingerprint]
        cut = len(t) // 3
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - cut] + following[t][:cut]).encode()).hexdigest()


def test_fingerprints_of_edits(spark, texts):
    found = {r.doc_id: r for r in fingerprints.fingerprints(make(spark, texts)).collect()}
    body = [t or "" for t in texts]
    assert len(found) == len(body)
    for i, t in enumerate(body):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + body[i - 1][:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprints.Fingerprint.of_text(t).hex()
        assert r.edited_fingerprint == fingerprints.Fingerprint.of_text(edited).hex()
    assert fingerprints.fingerprints(make(spark, ["a"], [None])).first().near_next == 1.0
    assert fingerprints.fingerprints(make(spark, texts).limit(0)).count() == 0
    assert fingerprints.fingerprints(make(spark, ["a", "b", "c"], [None, 4, 4])).count() == 3


ODD = ["a  b\n\n c", "don't  stop ", "  x y\x1cz\x85w", "ÀÉ ñ 12,345!! <|endoftext|> é", "　漢字 かな", "", " ", "\r\n\t a",
       "Straße, À'll x!'s _a_ b__ µm ªº", "İstanbul ΣΑΣ é́ e\u0301!", "×÷ a×b word… 's"]


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(name, spaced, texts, monkeypatch):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    marks = [t.content for t in whole.get_added_tokens_decoder().values()]
    body = ODD + marks + [f"a {m}b  {m.upper()} {m}{m} c" for m in marks] + [t or "" for t in texts] + ["".join(random.Random(i).choices("ab ,.'\n\t é1!", k=300)) for i in range(40)]
    wanted = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(body, add_special_tokens=False)]
    assert tokens.PieceEncoder(path, spaced).encode(body) == wanted
    monkeypatch.setattr(held, "BUDGET_BYTES", 700)
    assert tokens.PieceEncoder(path, spaced).encode(body) == wanted
    held.release()
    assert all(not c and not c.bytes for c in held._caches)


def test_batches_are_cut_by_bytes():
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "text": ["aaaa", None, "", "bbbbbbbbbb", "c", "dd"]})
    cut = [p.column(0).to_pylist() for p in held.pieces(batch, 1, 5)]
    assert cut == [[0, 1, 2], [3], [4, 5]]
    assert [p.num_rows for p in held.pieces(batch.slice(0, 0), 1)] == [0]


def test_first_fit_decreasing_is_what_it_says():
    rng = random.Random(3)
    lengths = [rng.randint(1, 60) for _ in range(300)]
    room = []
    wanted = [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        room += [64] * (at == len(room))
        wanted[i] = (at, 64 - room[at])
        room[at] -= lengths[i]
    assert packing.first_fit_decreasing(lengths, 64) == wanted


def test_packing_keeps_every_token_once(spark):
    rng = random.Random(4)
    docs = {i: [rng.randrange(50_000) for _ in range(rng.choice([0, 1, 5, 30, 64, 200]))] for i in range(200)}
    df = spark.createDataFrame([(i, bytearray(struct.pack(f"<{len(v)}I", *v))) for i, v in docs.items()], "doc_id bigint, ids binary")
    pieces = packing.pack(df, 64, group_documents=40).collect()
    parts, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p.doc_id].append((p.start, list(struct.unpack(f"<{p.length}I", p.ids))))
        sequences[p.sequence_id].append((p.offset, p.length))
        assert p.doc_tokens == len(docs[p.doc_id])
    assert {i: sum((x for _, x in sorted(v)), []) for i, v in parts.items()} == {i: v for i, v in docs.items() if v}
    for v in sequences.values():
        assert [o for o, _ in sorted(v)] == list(itertools.accumulate([0] + [n for _, n in sorted(v)][:-1])) and sum(n for _, n in v) <= 64
    assert packing.pack(df.limit(0), 64).count() == 0
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack_texts(make(spark, [None, "a b", "a b"], [None, 1, 1]), path).count() == 3


def test_codes_give_any_token():
    rng = np.random.default_rng(5)
    for high in (1, 2, 300, 50_000, 2**32):
        ids = rng.integers(0, high, 3000, dtype=np.uint64).astype(np.uint32)
        for widths in ([32], [8, 8, 16], token_codes.chunk_widths(ids)):
            if sum(widths) < 32:
                widths = [*widths, 32 - sum(widths)]
            again = token_codes.Segment.from_bytes(token_codes.Segment.encode(ids, widths).to_bytes(), widths)
            assert np.array_equal(again.decode(), ids)
            assert all(again.access(i) == ids[i] for i in range(0, 3000, 37))


def test_token_files_round_trip(spark, texts, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_codes.write_tokens(make(spark, texts), path, file_tokens=500)
    found = {r.doc_id: (r.start, bytes(r.ids)) for r in token_codes.read_tokens(manifest).collect()}
    whole, start = Tokenizer.from_file(path), 0
    flat = []
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        assert found[i] == (start, struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)
        flat += ids
    one = manifest.orderBy("before").first()
    file = token_codes.TokenFile(one.uri)
    assert [file.token(i) for i in range(0, one.tokens, 7)] == flat[:one.tokens:7]
    empty = token_codes.write_tokens(make(spark, texts).limit(0), path)
    assert token_codes.read_tokens(empty).count() == 0
    odd = token_codes.read_tokens(token_codes.write_tokens(make(spark, ["a", "b", None], [None, 7, 7]), path))
    assert [r.doc_id for r in odd.orderBy("start").collect()] == [7, 7, None]


def test_mixing_meets_targets(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 9)), s) for i, s in enumerate(["a"] * 300 + ["b"] * 100 + [None] * 200 + ["z"] * 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    planned = mixing.plan(df).collect()
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", "z", None)}
    target, open_, left = {}, {"a": 3, "b": 1, "z": 2, None: 3}, 1.5 * sum(size.values())
    while True:  # share, stop, share again
        level = left / sum(open_.values())
        stopped = [s for s, w in open_.items() if level * w > 2 * size[s]]
        if not stopped:
            target |= {s: level * w for s, w in open_.items()}
            break
        for s in stopped:
            target[s] = 2.0 * size[s]
            left -= target[s]
            del open_[s]
    for s in size:
        own = [r for r in planned if r.source == s]
        assert own[0].target == pytest.approx(target[s]) and own[0].source_size == size[s]
        assert abs(sum(r.taken for r in own) - target[s]) <= 18
        assert all(r.taken <= 2 * r.size for r in own)
    taken = {r.doc_id: r.copies for r in planned}
    assert taken == {r.doc_id: r.copies for r in mixing.plan(df.repartition(7)).collect()}
    mixed = mixing.mix(df).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {i: c for i, c in taken.items() if c}
    assert mixing.plan(df.limit(0)).count() == 0 and mixing.plan(make(spark, [None, ""])).first().taken == 0


def test_importance_parts_noise_from_text(spark):
    rng = random.Random(7)
    plain = [" ".join(rng.choices(["the", "sea", "was", "calm", "and", "grey", "today"], k=40)) for _ in range(150)]
    noise = [" ".join(rng.choices(["buy", "now!!", "&&&", "$$$", "cheap"], k=40)) for _ in range(50)]
    df = make(spark, [*plain, *noise, "", None])
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(0, 200, 2)], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in importance.selection(df, labels).where("kept").collect()}
    assert kept == {*range(150), 200, 201}
    assert importance.good_documents(df, labels).columns == df.columns
    assert importance.selection(df, labels.limit(0)).where("kept").count() == 202
    assert importance.selection(df.limit(0), labels).count() == 0
    assert importance.selection(make(spark, ["a", "a"], [None, None]), labels).count() == 2


def test_good_documents_judges_each_text(spark):
    rng = random.Random(7)
    plain = [" ".join(rng.choices(["the", "sea", "was", "calm", "and", "grey", "today"], k=40)) for _ in range(160)]
    noise = [" ".join(rng.choices(["buy", "now!!", "&&&", "$$$", "cheap"], k=40)) for _ in range(54)]
    ids = [*range(150), *[None] * 9, 999, *range(1000, 1050), None, None, 999, 999]
    df = make(spark, [*plain, *noise], ids)
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in (*range(0, 150, 2), *range(1000, 1050, 2))], "doc_id bigint, quality int, toxic int")
    kept = sorted(r.text for r in importance.good_documents(df, labels).collect())
    assert kept == sorted(plain)


def brute_statistics(text):
    w = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x.split()]
    seen = defaultdict(list)
    for k in range(len(w) - 2):
        seen[tuple(w[k:k + 3])].append(k)
    again = {k + j for v in seen.values() if len(v) > 1 for k in v for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_outliers_statistics_and_verdict(spark):
    rng = random.Random(8)
    vocabulary = [f"wörd{i}" for i in range(500)]
    plain = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 200))) for _ in range(80)]
    odd = ["#$% &&& ||| " * 40, "a b c d\n" * 30, "x\ny\nx\n \n \n", "", None, "w " * 100]
    mess = [" ".join(f"{w}&&&" for w in rng.choices(vocabulary, k=90)) for _ in range(3)]
    df = make(spark, plain + odd + mess)
    found = {r.doc_id: r for r in outliers.judged(df).collect()}
    for i, t in enumerate(plain + odd + mess):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_statistics(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert all(found[i].kept for i in range(80)) and not any(found[i].kept for i in range(80, 89))
    assert outliers.judged(df.limit(0)).count() == 0
    nulls = df.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    assert outliers.judged(nulls).where("kept").count() == 80


def test_moderate_outliers_are_rejected(spark):
    rng = random.Random(12)
    vocabulary = [f"wort{i}" for i in range(3000)]
    drawn = lambda n: rng.choices(vocabulary, k=n)
    plain = []
    for i in range(300):  # a few have a repeated phrase or a symbol, as real texts do
        w = drawn(rng.randint(100, 300))
        plain.append(" ".join(w + w[:3] if i % 6 == 0 else [*w, "&"] if i % 20 == 1 else w))
    symbols = [" ".join(drawn(150)) + " #" * 30 for _ in range(4)]
    phrases = [" ".join(drawn(120) + drawn(5) * 16) for _ in range(4)]  # two fifths of the words
    found = {r.doc_id: r for r in outliers.judged(make(spark, plain + symbols + phrases)).collect()}
    assert all(not found[300 + i].base_failed and not found[300 + i].kept for i in range(8))
    assert sum(found[i].kept for i in range(300)) >= 297


def test_fit_recovers_a_covariance_behind_outliers(spark):
    rng = np.random.default_rng(3)
    lower = np.tril(rng.uniform(-0.4, 0.4, (5, 5)), -1) + np.diag([0.5, 0.8, 1.2, 1.5, 1.1])
    clean = rng.normal(size=(4000, 5)) @ lower.T + 6
    away = rng.normal(size=(200, 5)) * 0.1 + 12
    rows = [("en", "a", *map(float, x)) for x in np.concatenate([clean, away])]
    df = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"_x{i} double" for i in range(5)))
    fit = outliers._fitted(df).first()
    inverse = np.array([[fit[f"_l{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert np.allclose([fit[f"_m{i}"] for i in range(5)], 6, atol=0.15)
    # Whitening the clean rows by the estimate must leave about unit spreads without correlation.
    white = (clean - clean.mean(0)) @ inverse.T
    assert np.allclose(np.cov(white.T), np.eye(5), atol=0.25)


def test_consistency_of_the_inner_share():
    assert outliers.chi_squared_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert outliers.chi_squared(9.0, 7) == pytest.approx(0.7473, abs=1e-3)


@pytest.mark.parametrize("period", sorted(substring.COVERS))
def test_covers_hold_every_difference(period):
    c = substring.COVERS[period]
    assert {(a - b) % period for a in c for b in c} == set(range(period))


def brute_cut(rows, length):
    found, first = {}, {}
    for i, t in sorted(rows):
        w = (t or "").split()
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k:k + length]), i)
    for i, t in rows:
        w = (t or "").split()
        gone = {k + j for k in range(len(w) - length + 1) if first[tuple(w[k:k + length])] < i for j in range(length)}
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        found[i] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return found


def test_repeated_passages_against_brute_force(spark, texts):
    ids = list(range(len(texts)))
    random.Random(9).shuffle(ids)
    for length, period in ((50, 31), (20, 13)):
        found = substring.repeated_passages(make(spark, texts, ids), length, period).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_cut(list(zip(ids, texts)), length)


def test_repeated_passages_behind_a_full_bitmap(spark, texts, monkeypatch):
    monkeypatch.setattr(substring, "LEAST_FILTER_BITS", 64)
    monkeypatch.setattr(substring, "MOST_FILTER_BITS", 64)  # lets nearly every run through
    found = substring.repeated_passages(make(spark, texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_cut(list(enumerate(texts)), 50)


def test_halves_of_a_run_hash_are_independent():
    h = words.hashes(" ".join(f"w{i}" for i in range(5000)))
    a, b = words.windows(h, 50), substring._second(h, 50)
    assert len(np.unique(a)) == len(np.unique(b)) == 4951 and not np.intersect1d(a, b).size
    assert abs(np.corrcoef(a.astype(float), b.astype(float))[0, 1]) < 0.06


def test_repeated_passages_of_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    df = make(spark, [long, long, long + " x", None, long], [None, 4, 4, 2, 9])
    found = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring.repeated_passages(df).collect())
    assert found == [(-1, 60, 60), (2, 0, 0), (4, 60, 0), (4, 61, 0), (9, 60, 60)]
    cut = substring.without_repeats(make(spark, [long, f"a {long} b"], [1, 2]))
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == {1: (long, len(long)), 2: ("a b", 3)}
    assert substring.repeated_passages(df.limit(0)).count() == 0


def test_without_repeats_cuts_each_row_by_its_own_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (None, f"a {long} b"), (None, "own text"), (None, "own text"), (None, None), (None, f"c {long}"), (7, f"d {long}"), (7, "of  seven")]
    cut = substring.without_repeats(make(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3))
    expected = [(1, long), (None, "a b"), (None, "own text"), (None, "own text"), (None, None), (None, "c"), (7, "d"), (7, "of  seven")]
    order = lambda x: (x[0] or -1, x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=order) == sorted(expected, key=order)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.collect())


def test_shards_are_stable_and_even(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    weights = {i: 1.0 for i in range(8)}
    placed = shards.assign(df, weights, {**weights, 8: 1.0})
    assert shards.slot_gaps(placed).count() == 0
    rows = placed.collect()
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert 300 < sum(r.grown_shard == 8 for r in rows) < 600
    heavy = shards.assign(df, {0: 3.0, 1: 1.0}).where("shard = 0").count()
    assert 2850 < heavy < 3150
    odd = shards.assign(make(spark, [None, "é", "é"], [None, 1, 1]), weights).collect()
    assert sorted((r.size, r.text_crc32) for r in odd) == [(1, 0), (3, zlib.crc32("é".encode())), (3, zlib.crc32("é".encode()))]
    assert shards.assign(df.limit(0), weights).count() == 0


def test_shards_against_sql(spark, tmp_path):
    df = spark.range(3000).selectExpr("id * 7 - 500 AS doc_id", "if(id % 50 = 0, NULL, repeat('é', cast(id % 9 AS int))) AS text")
    placed = shards.assign(df.repartition(5), queries.SHARDS, {**queries.SHARDS, 16: 1.0}).collect()
    df.write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
        wanted = db.sql(oracles.SHARDING).fetchall()
    assert sorted((r.doc_id, r.size, "key", r.shard, r.grown_shard, r.slot) for r in placed) == sorted(wanted)
    sums = {r.doc_id: zlib.crc32((r.text or "").encode()) for r in df.collect()}
    assert all(r.text_crc32 == sums[r.doc_id] for r in placed)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives_round_trip(spark, tmp_path, compression):
    html = ["x" * 200, "x" * 200, "short", "short", None, "é" * 60, "a\r\n\r\nWARC/1.1\r\n" * 20]
    rows = [(i if i else None, f"http://h{i}/" if i != 2 else None, h) for i, h in enumerate([*html, "x" * 200])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = str(tmp_path / "a")
    warc.write_warc(warc.page_records(df), path, compression, roll_bytes=600)
    found = {r.record_id: r for r in warc.read_warc(spark, path).collect()}
    assert len(found) == 8
    for i, (_, url, h) in enumerate(rows):
        r = found[f"urn:page:{i}" if i else "urn:page:"]
        data = (h or "").encode()
        again = i in (0, 7)
        assert (r.target_uri, r.payload_length, r.payload_digest) == (url, len(data), f"sha256:{hashlib.sha256(data).hexdigest()}")
        assert (r.record_type, r.refers_to) == (("revisit", "urn:page:1") if again else ("response", None))
        assert (None if again else data) == (r.payload if r.payload is None else bytes(r.payload))
    some = warc.read_warc(spark, path, payload=False).where("record_type = 'revisit' AND target_uri LIKE 'http://h7%'")
    assert [(r.record_id, r.payload) for r in some.collect()] == [("urn:page:7", None)]
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_header_filters_skip_blocks():
    from pyspark.sql.datasource import EqualTo, GreaterThan, Not

    is_response = warc._test(EqualTo(("record_type",), "response"))
    assert is_response({"record_type": "response"}) and not is_response({"record_type": None})
    assert warc._test(Not(EqualTo(("record_type",), "response")))({"record_type": "revisit"})
    assert warc._test(GreaterThan(("payload_length",), 5)) is None


def test_negated_header_filters_agree_with_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h{i}/", "x" * 200 if i in (1, 4) else f"page {i}") for i in range(6)], "page_id bigint, url string, html string")
    path = str(tmp_path / "a")
    warc.write_warc(warc.page_records(df), path, "none")
    read = warc.read_warc(spark, path)
    whole = spark.createDataFrame(read.collect(), read.schema)
    c = F.col("refers_to")
    first = whole.where("refers_to IS NOT NULL").first().refers_to
    conditions = [c.eqNullSafe(first), c.eqNullSafe(F.lit(None)), c.isNull(), c.isNotNull(), c == first, c.isin(first, "urn:page:9"), c.isin("urn:page:9"),
                  c > "urn:page:0", c >= first, c < first, c <= first, c.startswith("urn"), c.endswith("9"), c.contains("page")]
    for condition in [x for k in conditions for x in (k, ~k)]:
        ids = [sorted(r.record_id for r in d.where(condition).select("record_id").collect()) for d in (warc.read_warc(spark, path), whole)]
        assert ids[0] == ids[1], condition
    assert warc.read_warc(spark, path).where(~c.eqNullSafe(first)).count() == 5


def test_negated_list_with_a_null_is_never_true():
    from pyspark.sql.datasource import In, Not

    assert not warc._test(Not(In(("record_type",), ("response", None))))({"record_type": "revisit"})


def test_an_archive_that_is_written_to_twice_keeps_both(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i}" * 30) for i in range(6)], "page_id bigint, url string, html string")
    records = warc.page_records(pages)
    for low in (0, 3):
        warc.write_warc(records.where(F.col("record_id").isin(*[f"urn:page:{i}" for i in range(low, low + 3)])), str(tmp_path / "a"))
    assert sorted(r.record_id for r in warc.read_warc(spark, str(tmp_path / "a")).collect()) == [f"urn:page:{i}" for i in range(6)]


def test_pages_without_an_id_stay_in_the_query(spark, tmp_path):
    rows = [(None, "u", "x" * 200), (3, None, "x" * 200), (4, "u", None), (-5, "u", "y")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.op10_warc(spark, str(tmp_path)).collect()}
    assert set(got) == {None, 3, 4, -5} and got[None].record_type == "revisit" and got[None].refers_to == 3
    assert got[4].payload_bytes == 0 and got[-5].record_type == "response"


def test_rows_that_repeat_key_and_size_are_planned_one_by_one(spark):
    texts = ["w " * 10] * 200 + ["v " * (5 + i % 7) for i in range(1000)]
    df = make(spark, texts, [7] * 200 + list(range(100, 1100)))
    planned = mixing.plan(df).collect()
    size = sum(len(t.split()) for t in texts)
    assert len(planned) == 1200 and all(r.taken <= 2 * r.size for r in planned)
    assert sum(r.taken for r in planned) == pytest.approx(1.5 * size, rel=0.02)
    same = [r.copies for r in planned if r.doc_id == 7]
    assert len(same) == 200 and sum(same) == pytest.approx(300, abs=2) and set(same) == {1, 2}
    mixed = mixing.mix(df)
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in planned)
    assert mixing.mix(df).where("doc_id = 7").count() == sum(same)
    alike = make(spark, [f"a{i} b" for i in range(40)], [None] * 40)
    found = [r.text for r in mixing.mix(alike.repartition(5)).collect()]
    assert sorted(found) == sorted(r.text for r in mixing.mix(alike).collect()) and len(found) == 60 and len(set(found)) == 40


CLASHING = ["_gone", "_gone_mark", "_cut_text", "_cut_id", "_row", "_own_key", "_copies", "_mark", "_key"]


def test_columns_of_any_name_pass_through(spark, texts):
    df = make(spark, texts)
    for name in CLASHING:
        df = df.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    for out in (near_dup.without_near_duplicates(df), substring.without_repeats(df), importance.good_documents(df, labels), mixing.mix(df)):
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(r[name] == f"{name} {r.doc_id}" for r in rows for name in CLASHING)
