"""The near-dedup stage against all pairs of documents by exact similarity."""

import random

import numpy as np
import pytest

import corpus_pipeline
from idloom.llm import jaccard, simhash
from tests.compare import SMALL
from tests.llm.test_llm_basic import brute_components


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def likeness(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("wide", [2, 32])
def test_near_dedup_stage_equals_brute_force(spark, monkeypatch, wide):
    monkeypatch.setattr(jaccard, "WIDE", wide)
    rng = random.Random(4)
    texts = []
    for _ in range(6):  # copies with some words exchanged, and the passage that all have in common
        words = [f"w{rng.randrange(5000)}" for _ in range(150)]
        for edits in (0, 0, 1, 1, 2, 2, 3, 3, 4, 5, 6, 8, 10):
            own = list(words)
            for at in rng.sample(range(150), edits):
                own[at] = f"e{rng.randrange(5000)}"
            texts.append(" ".join(own) + " a line that every one of these texts has at its end")
    rows = list(enumerate(texts)) + [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    sets, prints = {i: shingles(t) for i, t in rows}, {i: simhash.fingerprint(t or "", 5) for i, t in rows}
    want = brute_components(sorted(sets), lambda a, b: likeness(sets[a], sets[b]) >= 0.8 or (prints[a] ^ prints[b]).bit_count() <= 3)
    by_bits = brute_components(sorted(sets), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, SMALL).collect())
    assert got == sorted({*want.values()}) and len(got) < len({*by_bits.values()})


def test_sketches_rule_out_no_similar_pair():
    """Pairs of similarity 0.8 or more all pass, pairs far below it mostly don't; hashes take both signs."""
    rng = np.random.default_rng(3)
    passed, ruled_out = 0, 0
    for size in (1, 2, 5, 9, 40, 150, 900):
        for _ in range(200):
            one = np.unique(rng.integers(-(2**63), 2**63, size))
            edits = int(rng.integers(0, size // 2 + 1))
            two = np.unique(np.r_[one[edits:], rng.integers(-(2**63), 2**63, edits)])
            columns = [np.r_[0, len(x) << 32, 0, 0, -1, jaccard.sketch(x)] for x in (one, two)]
            out = jaccard._unlike(np.stack(columns, axis=1).astype(np.int64), np.array([0]), np.array([1]), 0.8)[0]
            common = len(np.intersect1d(one, two))
            similarity = common / (len(one) + len(two) - common)
            assert not (out and similarity >= 0.8)
            passed += similarity >= 0.8
            ruled_out += bool(out)
    assert passed > 300 and ruled_out > 300
