"""Listing of trees by tasks, splits by bytes, and reading of splits."""

import os

import pytest
from pyspark.sql import functions as F

from kilnwork.sources import files, trees


@pytest.fixture
def tree(tmp_path):
    sizes = {"a.txt": 3, "b/c d.txt": 0, "b/é%20.bin": 500, "b/deep/er/x": 70, "b/deep/y=1/z": 10, "_ok=1/kept": 4}
    sizes |= {f"many/{i:03}": i for i in range(200)}
    for name, size in {**sizes, "_skipped": 1, ".hidden/x": 2, "b/_temporary/y": 3}.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(bytes(i % 251 for i in range(size)))
    return str(tmp_path / "in"), sizes


def test_trees_listed_by_tasks_equal_sparks_listing(spark, tree):
    root, sizes = tree
    for uri in (root, root + "/", f"file://{root}", f"file:{root}"):
        got = trees.list_tree(spark, uri, folders_per_task=2)
        # Spark's file source leaves empty files out.
        assert sorted(map(tuple, got.select("key", "size", "modified").filter("size > 0").collect())) == sorted(map(tuple, files.inventory(spark, root).collect()))
        assert got.filter("error is not null").count() == 0 and got.count() == len(sizes)


@pytest.mark.parametrize("split", [1, 100, 1 << 20])
def test_splits_hold_their_bytes_and_are_read_whole(spark, tree, split):
    root, sizes = tree
    listed = trees.packed(trees.list_tree(spark, root), split)
    rows = listed.collect()
    by = {}
    for r in rows:
        by.setdefault(r["split"], []).append(r["size"])
    assert all(sum(s) <= split or sum(1 for x in s if x) == 1 for s in by.values()) and len(rows) == len(sizes)
    read = trees.read_packed(listed, root).collect()
    assert {r["key"].split("/in/")[1]: len(r["bytes"]) for r in read} == sizes and all(r["error"] is None for r in read)


def test_missing_folders_and_files_are_rows(spark, tmp_path):
    got = trees.list_tree(spark, str(tmp_path / "none")).collect()
    assert len(got) == 1 and "FileNotFound" in got[0]["error"] and got[0]["size"] is None
    (tmp_path / "in").mkdir()
    assert trees.list_tree(spark, str(tmp_path / "in")).count() == 0
    (tmp_path / "in" / "x").write_text("abc")
    listed = trees.packed(trees.list_tree(spark, str(tmp_path / "in"))).collect()
    os.remove(tmp_path / "in" / "x")
    again = spark.createDataFrame([(r["key"], r["size"], r["split"]) for r in listed], "key string, size long, split long")
    read = trees.read_packed(again, str(tmp_path / "in")).first()
    assert read["bytes"] is None and "FileNotFound" in read["error"]


def test_files_too_large_for_a_value_are_errors(spark, tmp_path, monkeypatch):
    (tmp_path / "x").write_text("abc")
    listed = trees.packed(trees.list_tree(spark, str(tmp_path))).withColumn("size", F.lit(1 << 31).cast("long"))
    assert "more than" in trees.read_packed(listed, str(tmp_path)).first()["error"]
