import random

import pytest

from touchline.operators import name_index, serving
from touchline.session import scratch_path
from touchline.sources import snapshots

SCHEMA = "league_code string, season_code string, player_id int, player_name string, Pos string"


def players(rnd, leagues, n):
    return [(league, str(2020 + i % 2), i, rnd.choice([None, "", "Al", "".join(rnd.choice("aábN %_") for _ in range(rnd.randint(3, 9)))]), "FW") for league in leagues for i in range(n)]


@pytest.mark.parametrize("n", [8, 300])
def test_index_equals_scan_before_and_after_a_refresh(spark, n):
    rnd, root = random.Random(n), scratch_path(spark, "names")
    old = players(rnd, ["x", "y", None], n)
    new = players(rnd, ["y"], n // 2)
    name_index.index_names(spark.createDataFrame(old, SCHEMA), root, buckets=3)
    y = spark.createDataFrame([r for r in old if r[0] == "y"], SCHEMA)
    now = old
    for round_ in range(2):
        table = spark.createDataFrame(now, SCHEMA)
        for text in ("aáb", "NB %", "b_a", "al", "", "nothing like it", "áá"):
            got = name_index.search_names(spark, root, text, 15, buckets=3).collect()
            assert got == serving.search_players(table, text, 15).collect(), text
        if not round_:
            name_index.index_names(spark.createDataFrame(new, SCHEMA), root, y, buckets=3)
            now = [r for r in old if r[0] != "y"] + new


def test_search_reads_the_buckets_of_its_triples(spark):
    root = scratch_path(spark, "names")
    table = spark.createDataFrame([("x", "2020", i, f"name {i:04}", "FW") for i in range(500)], SCHEMA)
    name_index.index_names(table, root)
    read = snapshots.read_table(spark, root, "postings")
    found = name_index.search_names(spark, root, "e 0042")
    assert [r["player_uuid"] for r in found.collect()] == [42]
    read_files = {f for f in found.inputFiles() if "/postings/" in f}
    assert len(read.inputFiles()) >= len(read_files)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan
