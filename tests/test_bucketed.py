import uuid

import pytest
from pyspark.sql import functions as F

from gathered import rows
from touchline.operators import market
from touchline.session import scratch_path
from touchline.sources import writers


def stored(spark, df, buckets):
    return writers.write_bucketed(df, f"t_{uuid.uuid4().hex}", scratch_path(spark, "bucketed"), buckets)


@pytest.mark.parametrize("n", [0, 30, 4000])
def test_joins_without_a_shuffle(spark, n):
    facts = spark.createDataFrame([(i % 900 if i % 13 else None, str(i % 3), "c", float(i)) for i in range(n)], "player_id int, season_code string, club string, latest_mv_eur double")
    matrix = spark.createDataFrame([(i % 900, str(i % 3), "c", [float(i)]) for i in range(0, n, 2)], "player_id int, season_code string, club string, features array<double>")
    a, b = stored(spark, matrix, 4), stored(spark, facts, 4)
    joined = market.training_rows_bucketed(a, b)
    assert rows(joined.select("player_id", "latest_mv_eur", "features")) == rows(
        market.training_rows(matrix, facts).select("player_id", "latest_mv_eur", "features")
    )
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    one = b.filter(F.col("player_id") == 7)
    assert "EqualTo(player_id,7)" in one._jdf.queryExecution().executedPlan().toString()
    assert rows(one) == rows(facts.filter("player_id = 7"))
