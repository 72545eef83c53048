"""The whole corpus pipeline on a small corpus, against brute force stage by stage."""

from __future__ import annotations

import random
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from meterstar.llm import mixing

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    w = text.lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Folder of tables, clean texts by id, ids of noise."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 8))) for _ in range(120)]
    texts = [rng.choices(vocabulary, k=rng.randint(80, 200)) for _ in range(120)]
    passage = rng.choices(vocabulary, k=75)
    for k in range(100, 110):
        texts[k] = texts[k][:40] + passage[rng.randint(0, 10):] + texts[k][40:]
    near = []
    for w in texts[:12]:
        changed = list(w)
        changed[rng.randrange(len(w))] = "changed"
        near += [changed, list(w)]
    clean = [" ".join(w) for w in texts + near]
    rng.shuffle(clean)
    noise = [" ".join(rng.choices(["&&&", "$$$", "BUY", "now!!!", "xxx"], k=90)) for _ in range(30)]
    rows = [(i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(clean + noise)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    marks = [(r[0], int(r[0] < len(clean)), int(r[0] >= len(clean))) for r in rows[::2]]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(enumerate(clean)), {r[0] for r in rows[len(clean):]}


def brute(clean):
    """What the second and third stage keep: ids with their texts."""
    sets = {i: shingles(t) for i, t in clean.items()}
    group = {i: i for i in clean}
    changed = True
    while changed:
        changed = False
        for a in clean:
            for b in range(a):
                if group[a] != group[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    left = {i: t.split() for i, t in clean.items() if group[i] == i}
    first = {}
    for i in sorted(left):
        for k in range(len(left[i]) - 49):
            first.setdefault(tuple(left[i][k:k + 50]), i)
    out = {}
    for i, w in left.items():
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k:k + 50])] < i for j in range(50)}
        out[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    return out


def test_pipeline_against_brute_force(spark, corpus):
    folder, clean, _ = corpus
    kept = brute(clean)
    assert len(kept) == 120 and sum(kept[i] != clean[i] for i in kept) >= 5
    frame = spark.createDataFrame([(i, t, "en", "ab"[i % 2], len(t)) for i, t in kept.items()], COLUMNS)
    copies = {r.doc_id: r.copies for r in mixing.plan(frame).collect() if r.copies}

    pieces, taken, sequences = defaultdict(list), defaultdict(Counter), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
        taken[r.doc_id][r.start] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i: set(c.values()) for i, c in taken.items()} == {i: {n} for i, n in copies.items()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, found in pieces.items():
        ids = [*tokenizer.encode(kept[i], add_special_tokens=False).ids, 1]
        assert b"".join(p for _, p in sorted(set(found))) == struct.pack(f"<{len(ids)}I", *ids)
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048


def test_stages_return_documents(spark, corpus):
    folder, clean, noise = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_classifier"
    good = corpus_pipeline.quality_classifier(spark, docs, folder)
    assert {r.doc_id for r in good.collect()} == set(clean)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
