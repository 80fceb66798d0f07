"""Every registered query of the engine against its SQL."""

import pytest

from idloom.plans import catalogue
from tests.compare import SMALL, database, same_rows


@pytest.fixture(scope="module")
def con():
    return database()


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, con, name):
    same_rows(catalogue.QUERIES[name](spark, SMALL).toPandas(), con.execute(catalogue.ORACLES[name]).df())


def test_every_query_but_the_phone_scan_has_sql():
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"hygiene_phones"}


def test_phone_scan_equals_python(spark):
    import re

    from idloom.operators import hygiene

    texts = ["call +44 20 7946 0958 now", "1234567890", "Amount-USD-1200.00", "+1-202-555-0199", "x1234567890", "12.34.56.78-90", "", None, "Date-2030-02-16 and 2030-02-16 10:00"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.nonfiction_phone_hits for r in hygiene.text_hits(rows).collect()}
    for i, text in enumerate(texts):
        for pattern in (hygiene.DATE, hygiene.AMOUNT, hygiene.PSEUDONYM, hygiene.FICTION_PHONE):
            text = re.sub(pattern, "", text or "")
        assert got[i] == len(re.findall(hygiene.PHONE, text))
