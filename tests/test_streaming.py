"""Streams end where a batch does."""

import json

from pyspark.sql import functions as F

from idloom.operators.resolve import resolve
from idloom.sources.tables import scoped
from idloom.streaming import incremental
from tests import package


def test_stream_equals_batch_and_repeats_do_no_harm(spark, tmp_path):
    files = package.rows()
    ledger = spark.createDataFrame(files["source_ledger"])
    inbox, state = tmp_path / "inbox", str(tmp_path / "state")
    inbox.mkdir()
    for i, part in enumerate((files["candidate_entities"][:5], files["candidate_entities"][3:9], files["candidate_entities"][8:])):
        (inbox / f"{i}.json").write_text("".join(json.dumps(x) + "\n" for x in part))
        incremental.start(incremental.occurrence_stream(spark, str(inbox)), state, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    got = incremental.current(spark, state, ledger)
    rows = spark.createDataFrame(files["candidate_entities"], incremental.OCCURRENCES + ", evidence_text string").drop("evidence_text")
    want = resolve(scoped(rows, ledger))
    for a, b in ((got.entities.drop("rep"), want.entities.drop("rep")), (got.assignments, want.assignments)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_windows_with_late_rows(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    rows = [("Person", "a", "2030-01-01 10:05:00"), ("Person", "b", "2030-01-01 10:40:00"), ("Topic", "t", "2030-01-01 11:10:00")]
    (inbox / "0.json").write_text("".join(json.dumps(dict(zip(("type", "normalized_name", "observed_at"), r))) + "\n" for r in rows))
    stream = spark.readStream.schema("type string, normalized_name string, observed_at timestamp").json(str(inbox))
    query = incremental.mention_counts(stream).writeStream.format("memory").queryName("mentions").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    found = {(r.type, r.h): r.occurrences for r in spark.table("mentions").select("type", F.hour("window.start").alias("h"), "occurrences").collect()}
    assert found == {("Person", 10): 2, ("Topic", 11): 1}
