"""The corpus pipeline against a plain version, stage by stage."""

import re

import numpy as np
import pytest

import corpus_pipeline
from idloom.llm import quality, simhash
from tests.compare import SMALL
from tests.llm.test_jaccard import likeness, shingles
from tests.llm.test_llm_basic import brute_components, spans_in


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(spark, stages):
    want = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    assert [s.columns for s in stages[:-1]] == [want] * 3


def test_quality_keeps_what_scores_enough(spark, stages):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify(docs, labels).toPandas()
    assert sorted(scored.doc_id[scored.score >= quality.THRESHOLD]) == sorted(r.doc_id for r in stages[0].collect())
    labelled = scored.merge(labels.toPandas(), on="doc_id")
    assert labelled.predicted[labelled.quality == 1].mean() > 0.95 and labelled.predicted[labelled.quality == 0].mean() < 0.1


def test_near_dedup_keeps_one_of_each_group(stages):
    """Against all pairs: shingles of five words at a similarity of 0.8 or more, or fingerprints within 3 bits."""
    rows = {r.doc_id: (shingles(r.text), simhash.fingerprint(r.text, 5)) for r in stages[0].collect()}
    root = brute_components(sorted(rows), lambda a, b: likeness(rows[a][0], rows[b][0]) >= 0.8 or (rows[a][1] ^ rows[b][1]).bit_count() <= 3)
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted({*root.values()})


def test_secrets_are_gone(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[1:3])
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert not spans_in(row.text) and len(row.text) == row.n_chars
        if not spans_in(before[i].text):
            assert before[i].text == row.text or "[SECRET]" in row.text
        plain = re.sub(r"\[SECRET\]", "", row.text)
        assert len(plain) <= len(before[i].text)


def test_packing_holds_every_document(stages):
    pieces = stages[3].toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in stages[2].collect()}
    for _, bin_ in pieces.groupby("sequence_id"):
        ordered = bin_.sort_values("offset")
        assert list(ordered.offset) == [0, *np.cumsum(ordered.length)[:-1]]


def test_run_gives_the_same(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).select("doc_id", "ids_crc32").collect())) == sorted(map(str, stages[3].select("doc_id", "ids_crc32").collect()))


AWKWARD = "doc_id long, text string, lang string, source string, n_chars int, score double, spans string, text2 array<string>"


def awkward(spark):
    """Nulls in any column, empty and repeated texts, repeated and null ids, clashing and extra columns, a long text."""
    words = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45, 0.5, "x", ["y"]),
        (8, "one two three four five six seven", "en", "a", 33, None, None, None),
        (8, "quite another text under the very same number", None, None, None, None, None, None),
        (8, "quite another text under the very same number", None, "b", 45, 0.1, None, None),
        (None, words, "en", "a", len(words), None, None, None),
        (None, words, "en", "a", len(words), None, None, None),
        (3, words + " more", "en", "a", None, None, None, None),
        (4, None, None, None, None, None, None, None),
        (5, "", "en", "a", 0, None, None, None),
        (6, "password = abcdefghijklmnop", "en", "a", 27, None, None, None),
        (7, " ".join(f"w{i % 977} v{i % 1009}" for i in range(100_000)), "en", "a", None, None, None, None),
    ]
    return spark.createDataFrame(rows, AWKWARD)


def test_near_dedup_on_awkward_rows(spark):
    docs = awkward(spark)
    got = corpus_pipeline.near_dedup_stage(spark, docs, SMALL)
    assert got.columns == docs.columns and got.schema == docs.schema
    rows = got.collect()
    assert sorted((r.doc_id, (r.text or "")[:9]) for r in rows) == [(1, "alpha bet"), (3, "word0 wor"), (4, ""), (6, "password "), (7, "w0 v0 w1 "), (8, "one two t"), (8, "quite ano")]
    assert [r.source for r in rows if (r.text or "").startswith("quite")] == ["b"]  # the least by the other columns


def test_stages_on_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        else:
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} >= {1, 8, 7}
        out.write.parquet(str(tmp_path / name))


def test_stages_on_an_empty_table(spark):
    docs = awkward(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_run_on_a_folder_of_awkward_rows(spark, tmp_path):
    awkward(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {1, 3, 4, 6, 7, 8}


def test_tokenizer_workers_stay_small():
    """Two workers stand beside an executor's heap; what they remember is bounded."""
    from idloom.llm import packing
    from idloom.llm.queries import tokenizer_path

    code, most = packing.WordEncoder(tokenizer_path("word_bpe_49k.json")), 0
    for i in range(0, 250_000, 1_000):
        code.encode([" ".join("".join(chr(97 + j // 26**k % 26) for k in range(5)) for j in range(i, i + 1_000))])
        most = max(most, len(code) + len(code.known))
    assert most <= 302_000
