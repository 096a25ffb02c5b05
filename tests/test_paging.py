import pytest
from pyspark.sql import functions as F

from touchline.operators import paging
from touchline.session import scratch_path


@pytest.mark.parametrize("n, range_rows", [(0, 10), (1, 10), (95, 10), (3000, 170)])
def test_pages_in_order(spark, n, range_rows):
    data = [(i, None if i % 7 == 0 else (i * 37) % 11, f"r{i}") for i in range(n)]
    df = spark.createDataFrame(data, "id int, v int, r string").repartition(5)
    path = scratch_path(spark, "ranks")
    paging.store_ranks(df, [F.col("v").desc_nulls_last(), F.col("id")], path, range_rows)
    plain = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    last = paging.page_count(spark, path, 9)
    assert last == -(-n // 9)
    for number in {1, 2, max(1, last // 2), max(1, last), last + 1}:
        got = paging.page_seek(spark, path, df.schema, number, 9).collect()
        assert [tuple(r)[:3] for r in got] == plain[(number - 1) * 9 : number * 9]
        assert all(r["total"] == n and r["page"] == number for r in got)
    if n == 3000:
        assert spark.read.parquet(f"{path}/ranges").agg(F.max("n")).first()[0] < 2 * range_rows
        whole = paging.page_seek(spark, path, df.schema, 1, 3000)
        assert [r["id"] for r in whole.collect()] == [r[0] for r in plain]


def test_a_page_reads_its_ranges_only(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    path = scratch_path(spark, "ranks")
    paging.store_ranks(df, [F.col("k")], path, 100)
    page = paging.page_seek(spark, path, df.schema, 77, 25)
    assert len(page.inputFiles()) <= 20 and [r["k"] for r in page.collect()] == list(range(1900, 1925))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_range" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        paging.page_seek(spark, path, df.schema, 0)
