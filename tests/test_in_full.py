"""The artifact of possible duplicates without a budget."""

from idloom.plans import catalogue

FOLDER = "/root/testdata/sf0.01"


def test_possible_duplicates_leaves_no_pair_out(spark):
    found = catalogue.QUERIES["possible_duplicates"](spark, FOLDER)
    total = catalogue.QUERIES["enumeration_stats"](spark, FOLDER).first().unresolved_pairs_total
    assert found.where("level = 0").count() == total > catalogue.BUDGET
