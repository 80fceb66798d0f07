"""How invariants are counted."""

import pytest

from idloom.plans import catalogue
from tests.compare import SMALL


@pytest.mark.parametrize("name", ["entity_invariants", "entity_invariants_global_scope"])
def test_no_table_of_occurrences_is_broadcast(spark, name):
    plan = catalogue.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [candidate_entity_id" in plan and "BroadcastHashJoin [candidate_entity_id" not in plan
