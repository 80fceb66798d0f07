"""Sinks through the file system that Spark uses."""

import hashlib
import os

import pytest

from idloom.sources import files, jsonl


def test_a_sorted_table_is_one_file_and_replaces_another(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as name").repartition(4)
    out = f"file://{tmp_path}/out"
    for folder in ("staging", "out"):
        files.make_folder(spark, f"file://{tmp_path}/{folder}")
    (tmp_path / "out" / "t.jsonl").write_text("old")
    assert jsonl.write_sorted(rows, ["id"], f"file://{tmp_path}/staging", "t.jsonl") == 1000
    jsonl.publish(spark, f"file://{tmp_path}/staging", out, ["t.jsonl"])
    text = (tmp_path / "out" / "t.jsonl").read_bytes()
    assert text == b"".join(b'{"id":%d,"name":"%d"}\n' % (i, i % 7) for i in range(1000))
    assert os.listdir(tmp_path / "out") == ["t.jsonl"] and os.listdir(tmp_path / "staging") == []
    assert files.sha256(spark, f"{out}/t.jsonl") == hashlib.sha256(text).hexdigest() and files.size(spark, f"{out}/t.jsonl") == len(text)


def test_parts_stay_apart_if_no_single_file_is_wanted(spark, tmp_path):
    assert jsonl.write_sorted(spark.range(10), ["id"], str(tmp_path), "t.jsonl", single=False) == 10
    assert spark.read.text(str(tmp_path / "t.jsonl")).count() == 10


def test_empty_tables_and_missing_files(spark, tmp_path):
    assert jsonl.write_sorted(spark.range(0), ["id"], str(tmp_path), "t.jsonl") == 0
    assert (tmp_path / "t.jsonl").read_bytes() == b""
    assert not files.exists(spark, str(tmp_path / "none")) and not files.is_file(spark, str(tmp_path))
    files.remove(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("text", ["", "plain", "ä\n漢"])
def test_small_texts_come_back(spark, tmp_path, text):
    files.write_text(spark, str(tmp_path / "a"), text)
    assert files.read_text(spark, str(tmp_path / "a")) == text and os.listdir(tmp_path) == ["a"]
