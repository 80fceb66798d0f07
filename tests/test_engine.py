"""The engine on the small package: golden results, policies, shuffles, faulty inputs and corrupted outputs."""

import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from idloom.functions import ids, names
from idloom.operators import pairs
from idloom.operators.project import project
from idloom.operators.resolve import resolve
from idloom.plans import acceptance, runs
from idloom.policy import Policy, PolicyError, Settings, load_settings
from idloom.sources import integrity, jsonl, tables
from tests import package

GOLDEN = {
    "canon_c5787e4c70093980b990": "p001 p002", "canon_e07053c4a6536e4729bf": "p003", "canon_5bef70e153edf0cf5519": "p004 p005", "canon_2f37d3a0eade023f36c1": "e001 e002",
    "canon_935173eb8945684620fd": "e003", "canon_8b93c957cf76134e3443": "e004", "canon_ea06b34336d85c3e898d": "a001", "canon_aa0d0c31e0da6aafbfab": "t001",
    "canon_dcf7b3ba8c83c2893c5b": "t002", "canon_5a499ce66be7edef4ad5": "pl001",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return package.write(tmp_path_factory.mktemp("package"))


@pytest.fixture(scope="module")
def inputs(spark, folder):
    return jsonl.load_package(spark, folder)


def resolved(inputs, **policy):
    return resolve(tables.scoped(inputs.occurrences, inputs.ledger), Policy(**policy), ids.portable, ids.casefold)


def members(result):
    return {r.canonical_entity_id: " ".join(x.removeprefix("cent_") for x in r.member_candidate_entity_ids) for r in result.entities.collect()}


@pytest.fixture(scope="module")
def written(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    done = runs.run(spark, Settings(input_dir=folder, output_dir=str(out)))
    return out, done


def lines(path):
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines()]


def test_golden_entities(inputs):
    assert members(resolved(inputs)) == GOLDEN


def test_golden_assignments(inputs):
    got = {r.candidate_entity_id.removeprefix("cent_"): (r.decision, r.confidence, r.reason_codes) for r in resolved(inputs).assignments.collect()}
    scoped, open_ = "ONE_TOKEN_PERSON_SOURCE_SCOPED", "ONE_TOKEN_PERSON_UNRESOLVED_CROSS_SOURCE"
    assert got["p001"] == ("POSSIBLE_DUPLICATE", 0.95, [scoped, "EXACT_NAME_IN_SCOPE", open_])
    assert got["p003"] == ("POSSIBLE_DUPLICATE", 1.0, [scoped, "SINGLETON_NAME", open_])
    assert got["p004"] == ("MERGED", 0.99, ["EXACT_NAME_IN_SCOPE"])
    assert got["e003"] == ("NEW_CANONICAL", 1.0, ["SINGLETON_NAME"])


def test_golden_artifacts(written):
    out, done = written
    assert done["violations"] == {} and done["counts"] == {"entity_assignments.jsonl": 13, "canonical_entities.jsonl": 10, "possible_duplicates.jsonl": 3, "fact_assignments.jsonl": 6, "canonical_edges.jsonl": 3}
    edges = {r["canonical_edge_id"]: r for r in lines(out / "canonical_edges.jsonl")}
    assert set(edges) == {"cedge_aec73491541c449dcd3a", "cedge_671818e32edea29f82d5", "cedge_fa42c2193b35191811d7"}
    both = edges["cedge_aec73491541c449dcd3a"]
    assert (both["confidence"], both["confidence_mean"], both["contributing_fact_count"], both["chunk_ids"]) == (0.9, 0.85, 2, ["chunk_a1", "chunk_a2"])
    assert "object_value" not in both
    dropped = {r["candidate_fact_id"]: r for r in lines(out / "fact_assignments.jsonl") if r["disposition"] == "DROPPED_INVALID"}
    assert {k: v["reason_codes"] for k, v in dropped.items()} == {"cfact_f004": ["SELF_LOOP_AFTER_CANONICALIZATION"], "cfact_f006": ["CROSS_SCOPE_ENDPOINTS"]}
    assert all("canonical_edge_id" in r and r["canonical_edge_id"] is None for r in dropped.values())
    assert [(r["confidence"], r["evidence_candidate_entity_ids"]) for r in lines(out / "possible_duplicates.jsonl")] == [
        (0.5, ["cent_p001", "cent_p003"]), (0.5, ["cent_p002", "cent_p003"]), (0.4, ["cent_a001", "cent_e001", "cent_e002"]),
    ]
    report = done["report"]
    assert report["components"]["entity_decisions"] == {"NEW_CANONICAL": 6, "MERGED": 4, "POSSIBLE_DUPLICATE": 3}
    assert report["components"]["size_percentiles"] == {"p50": 1, "p90": 2, "p95": 2, "p99": 2, "max": 2}
    assert report["components"]["isolated_canonical_entities"] == {"numerator": 5, "denominator": 10, "rate": 0.5}
    assert report["components"]["edges"]["consolidation_rate"] == 0.25
    assert all(m["rate"] == 1.0 for m in report["coverage"].values())
    assert (out / "entity_assignments.jsonl").read_text().splitlines()[0].startswith('{"candidate_entity_id":"cent_a001","canonical_entity_id":"canon_')


@pytest.mark.parametrize("seed", [1, 2])
def test_row_order_does_not_matter(spark, written, tmp_path, seed):
    files = package.rows()
    for i, name in enumerate(files):
        random.Random(seed + i).shuffle(files[name])
    done = runs.run(spark, Settings(input_dir=package.write(tmp_path / "in", files), output_dir=str(tmp_path / "out")))
    assert done["sha256"] == written[1]["sha256"]


def test_alias_merging(inputs):
    one = resolved(inputs, merge_on_alias=True, alias_min_support=1)
    assert "a001 e001 e002" in members(one).values()
    codes = {r.candidate_entity_id: r.reason_codes for r in one.assignments.collect()}
    assert codes["cent_a001"] == ["EXACT_NAME_IN_SCOPE", "SOURCE_LOCAL_ALIAS"]
    assert members(resolved(inputs, merge_on_alias=True, alias_min_support=2)) == GOLDEN


def test_global_scope_is_found_out(spark, folder, tmp_path):
    done = runs.run(spark, Settings(Policy(one_token_person_scope="global"), folder, str(tmp_path)))
    assert done["violations"] == {"prohibited_one_token_person_components": 1}


def test_kept_self_loops_are_found_out(spark, folder, tmp_path):
    done = runs.run(spark, Settings(Policy(drop_self_loops=False), folder, str(tmp_path)))
    assert done["violations"] == {"self_loop_edges": 1}


def test_budget_leaves_the_question_open(inputs):
    result = resolved(inputs)
    rows = pairs.members(result)
    plan = pairs.budget_plan(pairs.pair_counts(rows), 1)
    assert [r.taken for r in plan.collect()] == [False]
    assert pairs.unresolved_pairs(rows, plan).count() == 0
    left = pairs.truncated_groups(rows, plan).collect()
    assert [r.evidence_candidate_entity_ids for r in left] == [["cent_p001", "cent_p003"]]


def test_large_groups_are_joined_by_salt(inputs, monkeypatch):
    rows = pairs.members(resolved(inputs))
    want = sorted((r.left_id, r.right_id) for r in pairs.unresolved_pairs(rows, pairs.pair_counts(rows)).collect())
    monkeypatch.setattr(pairs, "BROADCAST_MEMBERS", 0)
    assert sorted((r.left_id, r.right_id) for r in pairs.unresolved_pairs(rows, pairs.pair_counts(rows)).collect()) == want


def test_budget_skips_and_goes_on(spark):
    counts = spark.createDataFrame([("o", "w", n, t, 2, p) for n, t, p in (("a", 10, 5), ("b", 10, 8), ("c", 4, 4), ("d", 3, 3))], "org_id string, workspace_id string, name_key string, occurrences long, events long, pairs long")
    taken = {r.name_key: r.taken for r in pairs.budget_plan(counts, 9).collect()}
    assert taken == {"a": True, "b": False, "c": True, "d": False}


def test_fact_reasons(spark, inputs):
    base = {"object_candidate_id": "cent_e001", "object_value": None, "source_event_id": "event_alpha", "chunk_id": "", "confidence": 0.5}
    extra = [
        base | {"candidate_fact_id": "cfact_1", "subject_candidate_id": "cent_nobody", "predicate": "P"},
        base | {"candidate_fact_id": "cfact_2", "subject_candidate_id": "cent_p001", "predicate": ""},
        base | {"candidate_fact_id": "cfact_3", "subject_candidate_id": "cent_p001", "predicate": "P", "object_candidate_id": "cent_nobody"},
        base | {"candidate_fact_id": "cfact_4", "subject_candidate_id": "cent_p001", "predicate": "P", "object_candidate_id": None},
        base | {"candidate_fact_id": "cfact_5", "subject_candidate_id": "cent_p001", "predicate": "P", "object_candidate_id": None, "object_value": "7"},
    ]
    facts = spark.createDataFrame(extra, "candidate_fact_id string, subject_candidate_id string, predicate string, object_candidate_id string, object_value string, source_event_id string, chunk_id string, confidence double")
    done = project(facts, resolved(inputs).assignments, Policy(), ids.portable)
    got = {r.candidate_fact_id: r.reason_codes[0] for r in done.assignments.collect()}
    assert got == {"cfact_1": "UNRESOLVED_SUBJECT", "cfact_2": "MISSING_PREDICATE", "cfact_3": "UNRESOLVED_OBJECT", "cfact_4": "UNRESOLVED_OBJECT", "cfact_5": "ENDPOINTS_RESOLVED"}
    edge = done.edges.first()
    assert edge.object_value == "7" and edge.object_canonical_entity_id is None and edge.chunk_ids == []


FAULTS = {
    "duplicate id": lambda f: f["candidate_entities"].append(dict(f["candidate_entities"][0])),
    "unknown source event": lambda f: f["candidate_entities"][0].update(source_event_id="event_none"),
    "organization contradicts": lambda f: f["candidate_entities"][0].update(org_id="org_beta"),
    "duplicate source_event_id": lambda f: f["source_ledger"].append(dict(f["source_ledger"][0])),
    "malformed id": lambda f: f["candidate_facts"][0].update(candidate_fact_id="fact 1"),
    "incomplete row": lambda f: f["source_ledger"][0].update(workspace_id=""),
}


@pytest.mark.parametrize("message", sorted(FAULTS))
def test_faulty_packages_are_fatal(spark, tmp_path, message):
    files = package.rows()
    FAULTS[message](files)
    with pytest.raises(jsonl.InputError, match=message):
        jsonl.load_package(spark, package.write(tmp_path, files))


def test_malformed_line_is_told_by_number(spark, tmp_path):
    folder = package.write(tmp_path)
    with open(tmp_path / "candidate_facts.jsonl", "a", encoding="utf-8") as out:
        out.write("{broken\n")
    with pytest.raises(jsonl.InputError, match=r"candidate_facts.jsonl:13"):
        jsonl.load_package(spark, folder)


def test_missing_file_is_fatal(spark, tmp_path):
    folder = package.write(tmp_path)
    (tmp_path / "source_ledger.jsonl").unlink()
    with pytest.raises(jsonl.InputError, match="source_ledger.jsonl"):
        jsonl.load_package(spark, folder)


def test_lineage(spark, inputs, tmp_path):
    assert integrity.lineage_violations(inputs).count() == 0
    files = package.rows()
    files["candidate_entities"][0]["chunk_id"] = "chunk_b1"
    files["extraction_artifacts"][0]["chunks"].append({"chunk_id": "chunk_b1", "source_event_id": "event_beta"})
    files["candidate_facts"][0]["object_candidate_id"] = "cent_none"
    broken = jsonl.load_package(spark, package.write(tmp_path, files), check=False)
    checks = {(r.file, r.check) for r in integrity.lineage_violations(broken).collect()}
    assert {("extraction_artifacts", "duplicate chunk_id"), ("extraction_artifacts", "chunk of another event"), ("candidate_facts", "unknown object")} <= checks


def test_verifier_accepts(spark, folder, written):
    assert acceptance.verify(spark, folder, str(written[0]))["status"] == "PASS"


def _edit(name, change):
    def apply(out):
        rows = lines(out / name)
        changed = change(rows)
        (out / name).write_text("".join(json.dumps(r) + "\n" for r in (rows if changed is None else changed)), encoding="utf-8")

    return apply


def _set(rows, where, **values):
    next(r for r in rows if where(r)).update(values)


ASSIGNED, ENTITIES, DUPLICATES, FACTS, EDGES = (f"{n}.jsonl" for n in ("entity_assignments", "canonical_entities", "possible_duplicates", "fact_assignments", "canonical_edges"))
CORRUPTIONS = {
    "dropped assignment": (_edit(ASSIGNED, lambda r: r[1:]), "entity assignment coverage"),
    "doubled assignment": (_edit(ASSIGNED, lambda r: r + r[:1]), "unknown/duplicate candidate_entity_id"),
    "dropped fact": (_edit(FACTS, lambda r: r[1:]), "fact assignment coverage"),
    "doubled fact": (_edit(FACTS, lambda r: r + r[:1]), "unknown/duplicate fact"),
    "dropped entity": (_edit(ENTITIES, lambda r: r[1:]), "canonical membership coverage"),
    "member twice": (_edit(ENTITIES, lambda r: r[0]["member_candidate_entity_ids"].append(r[1]["member_candidate_entity_ids"][0])), "members appear in multiple"),
    "misdeclared scope": (_edit(ENTITIES, lambda r: r[0].update(org_id="org_other")), "declared scope"),
    "projected without edge": (_edit(FACTS, lambda r: _set(r, lambda x: x["canonical_edge_id"], canonical_edge_id=None)), "projected fact missing edge"),
    "dropped with edge": (_edit(FACTS, lambda r: _set(r, lambda x: not x["canonical_edge_id"], canonical_edge_id="cedge_x")), "dropped fact must have null"),
    "dangling edge": (_edit(EDGES, lambda r: r[0].update(object_canonical_entity_id="canon_none")), "unknown object"),
    "no value key": (_edit(EDGES, lambda r: r[0].update(object_canonical_entity_id=None)), "missing object endpoint"),
    "stripped provenance": (_edit(EDGES, lambda r: r[0].update(source_candidate_fact_ids=[])), "invalid source facts"),
    "one evidence": (_edit(DUPLICATES, lambda r: r[0].update(evidence_candidate_entity_ids=["cent_p001"])), "invalid evidence"),
    "unknown pair": (_edit(DUPLICATES, lambda r: r[0].update(left_canonical_entity_id="canon_none")), "invalid canonical pair"),
    "no reasons": (_edit(ASSIGNED, lambda r: r[0].update(reason_codes=[])), "missing canonical ID or reason"),
    "invented decision": (_edit(ASSIGNED, lambda r: r[0].update(decision="PERHAPS")), "invalid decision"),
    "missing report key": (lambda out: (out / "quality_report.json").write_text("{}"), "missing keys"),
    "missing file": (lambda out: (out / "quality_report.json").unlink(), "missing output files"),
}


@pytest.mark.parametrize("name", sorted(CORRUPTIONS))
def test_verifier_rejects(spark, folder, written, tmp_path, name):
    corrupt, message = CORRUPTIONS[name]
    out = tmp_path / "out"
    shutil.copytree(written[0], out)
    corrupt(out)
    with pytest.raises(acceptance.VerificationError, match=message):
        acceptance.verify(spark, folder, str(out))


def test_nothing_is_published_on_failure(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "build_report", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run(spark, Settings(input_dir=folder, output_dir=str(tmp_path)))
    assert list(tmp_path.iterdir()) == []


def test_labels_are_scored(spark, folder, tmp_path):
    asked = [("p001", "p002", "MERGE"), ("p003", "p001", "POSSIBLE_DUPLICATE"), ("e001", "e003", "NO_MERGE"), ("p004", "nobody", "MERGE")]
    labels = tmp_path / "labels.jsonl"
    labels.write_text("".join(json.dumps({"left_candidate_entity_id": f"cent_{a}", "right_candidate_entity_id": f"cent_{b}", "label": c}) + "\n" for a, b, c in asked))
    quality = runs.run(spark, Settings(input_dir=folder, output_dir=str(tmp_path / "out")), str(labels))["report"]["identity_quality"]
    assert quality["missing_assignments"] == 1 and quality["per_class"]["MERGE"]["recall"] == 0.5 and quality["per_class"]["POSSIBLE_DUPLICATE"]["f1"] == 1.0
    assert quality["confusion_matrix"]["MERGE"]["NO_MERGE"] == 1


def test_profile_and_lineage_command(spark, folder):
    found = runs.profile(spark, Settings(input_dir=folder))
    assert found["occurrences"] == 13 and found["one_token_person_source_scoped_components"] == 2 and found["top_predicates"]["WorksAt"] == 4
    assert runs.validate(spark, folder)["status"] == "PASS"


def test_names(spark):
    cases = [("quill-fa1308d761", 1), ("quill-fa1308d761 orin-9ac6abe97a", 2), ("date-2030-02-16", 1), ("amount-usd-1200.00", 2), ("o'brien-aabbccddee", 1), ("", 0), ("   ", 0), ("naïve é", 2), ("नमस्ते", 3)]
    rows = spark.createDataFrame(cases, "name string, n int").select("name", "n", names.token_count(F.col("name")).alias("got"))
    import regex

    for r in rows.collect():
        assert r.got == len(regex.findall(names.TOKEN, r.name))
        if r.name.isascii():
            assert r.got == r.n


def test_pair_confidence(spark):
    got = {r.n: r.c for r in spark.createDataFrame([(n,) for n in (1, 2, 3, 1507)], "n long").select("n", names.pair_confidence(F.col("n")).alias("c")).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 0.3869, 1507: 0.0865}


def test_settings(tmp_path):
    assert Policy().fingerprint() != Policy(drop_self_loops=False).fingerprint()
    for wrong in ({"one_token_person_scope": "x"}, {"alias_min_support": 0}, {"possible_duplicate_pair_budget": -1}, {"min_fact_confidence": 2.0}):
        with pytest.raises(PolicyError):
            Policy(**wrong)
    path = tmp_path / "c.toml"
    path.write_text('[resolution]\nmerge_on_alias = true\n[runtime]\ninput_dir = "x"\n')
    assert load_settings(path, output_dir=None) == Settings(Policy(merge_on_alias=True), "x")
    path.write_text("[resolution]\nunheard = 1\n")
    with pytest.raises(PolicyError, match="unheard"):
        load_settings(path)


def test_command_line_codes(tmp_path, capsys):
    from idloom import cli

    assert cli.main(["config"]) == 0
    assert json.loads(capsys.readouterr().out)["configuration_fingerprint"] == Policy().fingerprint()
    (tmp_path / "bad.toml").write_text("[resolution]\nalias_min_support = 0\n")
    assert cli.main(["--config", str(tmp_path / "bad.toml"), "config"]) == 2
    assert cli.main(["profile", "--input-dir", str(tmp_path)]) == 3
