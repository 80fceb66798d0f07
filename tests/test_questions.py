"""What open questions are read from: only the occurrences that they are about."""

from pyspark.sql import functions as F

from idloom.operators import pairs
from idloom.operators.resolve import concerned, questions, resolve
from idloom.plans import catalogue
from idloom.policy import Policy
from idloom.sources import tables

SMALL = "/root/testdata/sf0.001"
SHAPE = "candidate_entity_id string, source_event_id string, chunk_id string, type string, name string, name_key string, aliases array<string>, confidence double, org_id string, workspace_id string"


def row(i, event, kind, name, aliases=(), workspace="w"):
    return (f"c{i:02}", event, f"k{i}", kind, name, name.lower(), list(aliases), 0.9, "o", workspace)


ROWS = [
    row(1, "e1", "Person", "Ann", ["Ann Lee"]), row(2, "e2", "Person", "Ann"), row(3, "e3", "person", "Ann"), row(4, "e1", "Person", "Ann Lee"), row(5, "e4", "Person", "Ann Lee"),
    row(6, "e1", "Org", "Acme", ["ACME Inc", "", "acme"]), row(7, "e2", "Org", "Acme"), row(8, "e3", "Org", "Acme Inc"), row(9, "e9", "Org", "Acme Inc", workspace="v"),
    row(10, "e1", "Org", "Other"), row(11, "e2", "Topic", "Acme"), row(12, "e3", "Topic", "Thing", ["Nothing"]), row(13, "e5", "Person", "Bo"), row(14, "e6", "Person", "Bob Ray"),
    row(15, "e2", "Person", "Ray", ["Bob Ray"]), row(16, "e7", "Person", "Ray"), row(17, "e7", None, "Acme", ["Acme Inc"]),
]


def found(result):
    return [sorted(map(str, x.collect())) for x in (result.links, result.members, pairs.alias_questions(result), pairs.possible_duplicates(result, None).drop("pair_order"))]


def test_concerned_occurrences_answer_as_all_do(spark, monkeypatch):
    scoped = spark.createDataFrame(ROWS, SHAPE)
    kept = {r.candidate_entity_id for r in concerned(scoped).collect()}
    assert kept == {f"c{i:02}" for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 13, 14, 15, 16)}
    for policy in (Policy(), Policy(one_token_person_scope="global"), Policy(merge_on_alias=True, alias_min_support=1)):
        want = found(resolve(scoped, policy))
        assert want[0] or policy.merge_on_alias
        assert found(questions(concerned(scoped), policy)) == want
    monkeypatch.setattr("idloom.operators.resolve.FEW_TYPES", 0)
    monkeypatch.setattr("idloom.operators.resolve.BROADCAST_NAMES", 0)
    assert found(questions(concerned(scoped))) == found(resolve(scoped))


def test_possible_duplicates_writes_no_occurrence_that_no_question_is_about(spark, monkeypatch):
    """All occurrences were written, and before that sent with all their columns."""
    written, put = {}, catalogue.materialize
    monkeypatch.setattr(catalogue, "materialize", lambda df, name, keep=True: written.setdefault(name, put(df, name, keep)))
    catalogue.QUERIES["possible_duplicates"](spark, SMALL)
    kinds = {r.type for r in written["scoped"][0].where(F.size("aliases") == 0).where("type <> 'Person'").select("type").distinct().collect()}
    inputs = tables.star_inputs(spark, SMALL)
    assert kinds == {"LegalEntity"}
    assert 0 < written["scoped"][0].count() < tables.scoped(inputs.occurrences, inputs.ledger).count() / 2


def test_evidence_is_in_order_with_nulls_last(spark):
    ids = [("b", "a"), ("a", "b"), (None, "a"), ("a", None)]
    made = [("o", "w", f"n{i}", f"e{k}", c, f"canon_{i}_{k}") for i, two in enumerate(ids) for k, c in enumerate(two)]
    members = spark.createDataFrame(made, "org_id string, workspace_id string, name_key string, source_event_id string, candidate_entity_id string, canonical_entity_id string")
    base = questions(spark.createDataFrame([], SHAPE))
    result = type(base)(base.links, base.spots, members)
    rows = pairs.possible_duplicates(result, None)
    assert sorted(map(str, (r.evidence_candidate_entity_ids for r in rows.collect()))) == ["['a', 'b']", "['a', 'b']", "['a', None]", "['a', None]"]
    assert "array_sort(array(" not in rows.where("level = 0")._jdf.queryExecution().optimizedPlan().toString()
