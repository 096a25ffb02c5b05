"""Versions of several tables: loads that fail, loads side by side, emptied partitions, old versions, vacuum."""

import os

import pytest
from gathered import rows
from pyspark.sql import functions as F

from touchline.sources import snapshots

SCHEMA = "n int, league_code string, season_code string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def folders(root):
    return sorted(os.listdir(os.path.join(root, "data", "a")))


def test_versions(spark, tmp_path):
    root = str(tmp_path / "root")
    a = [(1, "x", "2023"), (2, "x", "2024"), (3, "y", None)]
    assert snapshots.commit(root, {"a": frame(spark, a), "b": frame(spark, [(9, "x", "2023")])}) == 1
    loaded = spark.createDataFrame([("x", "2024"), ("x", "2023")], "league_code string, season_code string")
    assert snapshots.commit(root, {"a": frame(spark, [(5, "x", "2024")]), "b": frame(spark, [])}, loaded) == 2
    assert rows(snapshots.read_table(spark, root, "a")) == rows(frame(spark, [(5, "x", "2024"), (3, "y", None)]))
    assert rows(snapshots.read_table(spark, root, "b")) == [] and snapshots.read_table(spark, root, "b").columns == ["n", "league_code", "season_code"]
    assert rows(snapshots.read_table(spark, root, "a", 1)) == rows(frame(spark, a))
    with pytest.raises(KeyError):
        snapshots.read_table(spark, root, "c")
    assert snapshots.vacuum(spark, root) == 2  # b's loads, the second one without rows; both of a's are in use
    assert snapshots.versions(spark, root) == [2] and len(folders(root)) == 2
    assert rows(snapshots.read_table(spark, root, "a")) == rows(frame(spark, [(5, "x", "2024"), (3, "y", None)]))


def test_a_load_that_fails_between_the_tables_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "root")
    snapshots.commit(root, {"a": frame(spark, [(1, "x", "1")]), "b": frame(spark, [(2, "x", "1")])})
    broken = frame(spark, [(4, "x", "1")]).withColumn("n", F.raise_error(F.lit("gone")).cast("int"))
    with pytest.raises(Exception, match="gone"):
        snapshots.commit(root, {"a": frame(spark, [(3, "x", "1")]), "b": broken})
    assert snapshots.versions(spark, root) == [1] and len(folders(root)) == 1
    assert rows(snapshots.read_table(spark, root, "a")) == [(1, "x", "1")] and rows(snapshots.read_table(spark, root, "b")) == [(2, "x", "1")]


def test_a_crash_before_the_rename_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    snapshots.commit(root, {"a": frame(spark, [(1, "x", "1")])})
    folder = tmp_path / "root" / "data" / "a" / "load=crashed" / "league_code=x" / "season_code=1"
    folder.mkdir(parents=True)  # what a driver that died leaves behind
    (tmp_path / "root" / "versions" / "_half").write_text("{")
    assert rows(snapshots.read_table(spark, root, "a")) == [(1, "x", "1")]
    assert snapshots.vacuum(spark, root) == 1 and rows(snapshots.read_table(spark, root, "a")) == [(1, "x", "1")]


def test_loads_side_by_side(spark, tmp_path, monkeypatch):
    root, publish = str(tmp_path / "root"), snapshots._publish
    snapshots.commit(root, {"a": frame(spark, [(1, "x", "1"), (2, "y", "1")])})

    def other_first(other):
        def run(*arguments):
            monkeypatch.setattr(snapshots, "_publish", publish)
            snapshots.commit(root, {"a": frame(spark, other)})  # takes the number that the first load wants
            return publish(*arguments)

        monkeypatch.setattr(snapshots, "_publish", run)

    other_first([(20, "y", "1")])
    assert snapshots.commit(root, {"a": frame(spark, [(10, "x", "1")])}) == 3
    assert rows(snapshots.read_table(spark, root, "a")) == [(10, "x", "1"), (20, "y", "1")]
    other_first([(11, "x", "1")])
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(root, {"a": frame(spark, [(12, "x", "1")])})
    assert rows(snapshots.read_table(spark, root, "a")) == [(11, "x", "1"), (20, "y", "1")]
