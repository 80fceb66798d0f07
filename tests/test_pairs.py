"""How pairs of large groups are dealt."""

import pytest

from idloom.operators import pairs
from idloom.plans import catalogue

GROUP = "org_id string, workspace_id string, name_key string"


@pytest.fixture
def rows(spark):
    """One name with 60 members from 40 events, and one with 2."""
    made = [("o", "w", "big", f"event_{i % 40:02}", f"cent_{i:02}", f"canon_{i * 7 % 40:02}") for i in range(60)]
    made += [("o", "w", "small", f"event_{i}", f"cent_s{i}", f"canon_s{i}") for i in range(2)]
    return spark.createDataFrame(made, f"{GROUP}, source_event_id string, candidate_entity_id string, canonical_entity_id string")


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_blocks_give_every_pair_once(rows, monkeypatch, broadcast):
    monkeypatch.setattr(pairs, "BROADCAST_MEMBERS", broadcast)
    monkeypatch.setattr(pairs, "BLOCK", 7)
    got = sorted((r.left_id, r.right_id, r.left_canonical_entity_id, r.right_canonical_entity_id) for r in pairs.unresolved_pairs(rows, pairs.pair_counts(rows)).collect())
    all_ = rows.collect()
    want = sorted(
        (a.candidate_entity_id, b.candidate_entity_id, *sorted((a.canonical_entity_id, b.canonical_entity_id)))
        for a in all_ for b in all_
        if a.name_key == b.name_key and a.source_event_id < b.source_event_id and a.canonical_entity_id != b.canonical_entity_id
    )
    assert got == want


def test_members_are_not_multiplied_where_groups_are_small(rows, monkeypatch):
    """Both sides of the join of blocks hold each member once; the salted join sent one side sixteen times."""
    monkeypatch.setattr(pairs, "BROADCAST_MEMBERS", 0)
    plan = pairs.unresolved_pairs(rows, pairs.pair_counts(rows))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [org_id" in plan and "left_block" in plan and "salt" not in plan


def test_possible_duplicates_puts_no_entity_together(spark, monkeypatch):
    """Entities and assignments of all occurrences were written for it, though only members and links are read."""
    written, put = [], catalogue.materialize
    monkeypatch.setattr(catalogue, "materialize", lambda df, name, keep=True: (written.append(name), put(df, name, keep))[1])
    catalogue.QUERIES["possible_duplicates"](spark, "/root/testdata/sf0.001")
    assert written == ["scoped", "links", "members"]
