"""Expected market value from playing statistics, and the players priced below it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.operators.columns import col
from touchline.operators.skew import skew_join
from touchline.session import bound_batches, materialize, scratch_path

TREES, SEED, KEPT = 100, 42, 200
LEAST_MATCHES, LEAST_VALUE = 5, 100_000
RANKED = {
    "player_id": "player_uuid",
    "player_name": "full_name",
    "pos": "primary_position",
    "club": "team_name",
    "league_name": "league_name",
    "age": "age",
    "season_code": "season_code",
    "actual_value_eur": "actual_value_eur",
    "predicted_value_eur": "predicted_value_eur",
    "value_diff_eur": "value_diff_eur",
    "value_ratio": "value_ratio",
    "MatchesPlayed": "MatchesPlayed",
}


def valued_players(view: DataFrame, pos: str = "pos", matches: str = "MatchesPlayed", value: str = "latest_mv_eur") -> DataFrame:
    """Field players with enough matches and a known value above the floor; unknown positions are left out."""
    return view.filter((col(pos) != "GK") & (col(matches) >= LEAST_MATCHES) & (col(value) > LEAST_VALUE))


def training_rows(matrix: DataFrame, players: DataFrame, on: Sequence[str] = ("player_id", "season_code", "club")) -> DataFrame:
    """Features joined to the facts of the same player, season and club, with the log of the value as ``label``."""
    joined = skew_join(players, matrix, list(on), "inner")
    return joined.withColumn("label", F.log1p(F.col("latest_mv_eur")))


def training_rows_bucketed(matrix: DataFrame, players: DataFrame, on: Sequence[str] = ("player_id", "season_code", "club")) -> DataFrame:
    """``training_rows`` of two tables stored by ``write_bucketed`` with the keys ``on``: buckets are merged with each other, nothing is
    shuffled."""
    return players.hint("merge").join(matrix, list(on)).withColumn("label", F.log1p(F.col("latest_mv_eur")))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def _as_vector(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_vector", array_to_vector(F.col(features)))


def fit_values(rows: DataFrame, features: str = "features", trees: int = TREES, depth: int = 10, seed: int = SEED) -> RandomForestRegressionModel:
    """Forest on ``label``. All features are tried at every split; deeper trees fit their own rows more closely.

    Each row keeps the node that it has come to in every tree, so that no level walks all rows down from the roots again.
    """
    forest = RandomForestRegressor(
        featuresCol="_vector", labelCol="label", predictionCol="predicted_log", numTrees=trees, maxDepth=depth,
        featureSubsetStrategy="all", seed=seed, maxMemoryInMB=512, cacheNodeIds=True,
    )
    return forest.fit(_as_vector(rows, features).select("_vector", "label"))


def predict_values(rows: DataFrame, model: RandomForestRegressionModel, features: str = "features") -> DataFrame:
    return model.transform(_as_vector(rows, features)).drop("_vector")


def predict_out_of_fold(rows: DataFrame, fold: Column, folds: int = 5, **fit) -> DataFrame:
    """Each row is scored by a forest that has not seen its fold; fold players, not rows, so no player is on both sides."""
    numbered = materialize(rows.withColumn("_fold", F.pmod(F.xxhash64(fold), F.lit(folds))), "folds")
    scored = None
    for i in range(folds):
        model = fit_values(numbered.filter(F.col("_fold") != i), **fit)
        part = predict_values(numbered.filter(F.col("_fold") == i), model)
        scored = part if scored is None else scored.unionByName(part)
    return scored.drop("_fold")


def log_rmse(scored: DataFrame, label: str = "label", predicted: str = "predicted_log") -> DataFrame:
    return scored.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(predicted), 2))).alias("rmse"))


def value_gaps(scored: DataFrame, value: str = "latest_mv_eur") -> DataFrame:
    """Predicted and actual value in EUR, their difference and ratio."""
    gaps = scored.withColumns(
        {"actual_value_eur": F.col(value).cast("double"), "predicted_value_eur": F.expm1("predicted_log")}
    )
    return gaps.withColumns(
        {
            "value_diff_eur": F.col("predicted_value_eur") - F.col("actual_value_eur"),
            "value_ratio": F.col("predicted_value_eur") / (F.col("actual_value_eur") + 1),
        }
    )


def undervalued(gaps: DataFrame, n: int = KEPT, columns: dict[str, str] = RANKED, tie: str = "player_id") -> DataFrame:
    """The players whose prediction exceeds their value the most: a top-n, with the serving names."""
    best = gaps.filter(F.col("value_diff_eur") > 0).orderBy(F.col("value_diff_eur").desc(), tie).limit(n)
    return best.select(*[col(c).alias(a) for c, a in columns.items() if c in gaps.columns])


def importances(spark, model: RandomForestRegressionModel, features: Sequence[str]) -> DataFrame:
    """Share of each feature in the forest's splits; one row per feature."""
    shares = [(name, float(share)) for name, share in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(shares, "feature string, importance double")


def attributions(rows: DataFrame, model: RandomForestRegressionModel, names: Sequence[str], keys: Sequence[str], features: str = "features") -> DataFrame:
    """``keys, feature, contribution``: the prediction minus the prediction with that feature at its mean.

    The means are those of the scored rows: these may be fewer than the rows that the features were scaled over. All
    variants of a row are scored in one pass.
    """
    means = rows.agg(F.array(*[F.coalesce(F.avg(F.col(features)[i]), F.lit(0.0)) for i in range(len(names))]).alias("m")).scalar()

    def at_mean(at: int) -> Column:
        return F.transform(F.col(features), lambda v, i: F.when(i == at, F.col("_means")[at]).otherwise(v))

    variants = F.array(*[F.struct(F.lit(name).alias("feature"), at_mean(i).alias("changed")) for i, name in enumerate(names)])
    base = predict_values(rows.select(*keys, features), model, features).withColumn("_means", means)
    wide = base.select(*keys, "predicted_log", F.explode(variants).alias("v")).select(
        *keys, F.col("predicted_log").alias("_base"), "v.feature", "v.changed"
    )
    return predict_values(wide, model, "changed").select(
        *keys, "feature", (F.col("_base") - F.col("predicted_log")).alias("contribution")
    )


# Up to this number of nodes, some 50 bytes each, a task holds the forest and walks its rows down; larger forests are joined by a shuffle.
BROADCAST_NODES = 500_000


def forest_nodes(spark, model: RandomForestRegressionModel) -> DataFrame:
    """The forest as a table, a row per node: tree, node (0 is the root), its mean as ``value``, and where it splits."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["prediction"].alias("value"), node["leftChild"].alias("below"),
        node["rightChild"].alias("above"), node["split"]["featureIndex"].alias("feature"), F.get(node["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"),
    )


def _node_credits(nodes: DataFrame, depth: int, n_features: int) -> DataFrame:
    """Per leaf the change of the mean on the way from the root, by the feature that each split asks for.

    The ways grow by one split per join; those that have come to a leaf stay there, where nothing changes.
    """
    ways = nodes.filter("node = 0").select("*", F.col("value").alias("base"), F.array_repeat(F.lit(0.0), n_features).alias("credits"))
    for _ in range(depth):
        following = F.when(F.col("below") < 0, F.array("node")).otherwise(F.array("below", "above"))
        steps = ways.select("tree", "base", "credits", F.col("value").alias("_from"), F.col("feature").alias("_by"), F.explode(following).alias("node"))
        change = F.transform("credits", lambda v, i: F.when(i == F.col("_by"), v + F.col("value") - F.col("_from")).otherwise(v))
        ways = steps.join(nodes, ["tree", "node"]).select(*nodes.columns, "base", change.alias("credits"))
    return ways.select("tree", "node", "base", "credits")


def _walk(forest: pd.DataFrame, depth: int, n_features: int):
    """Rows with the mean over the trees of ``base`` and of the credits of the leaf that they come to. ``forest`` has the nodes in
    order, those of a tree numbered from 0."""
    starts = np.searchsorted(forest["tree"].to_numpy(), np.unique(forest["tree"]))
    first, own = starts[np.unique(forest["tree"], return_inverse=True)[1]], np.arange(len(forest))
    leaf = forest["below"].to_numpy() < 0
    below, above = (np.where(leaf, own, first + forest[c].to_numpy()) for c in ("below", "above"))
    by, threshold = np.where(leaf, 0, forest["feature"].to_numpy()).astype("int64"), forest["threshold"].fillna(0.0).to_numpy("float64")
    # nodes that are no leaf have no credits, and no row ends there
    credits = np.array([c if c is not None else [0.0] * n_features for c in forest["credits"]], dtype="float64")
    base = float(forest["value"].to_numpy()[starts].mean())

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([v if v is not None else np.full(n_features, np.nan) for v in batch["_features"]], dtype="float64").reshape(len(batch), -1)
            total, row = np.zeros((len(batch), n_features)), np.arange(len(batch))
            for start in starts if len(batch) else []:
                at = np.full(len(batch), start)
                for _ in range(depth):
                    at = np.where(x[row, by[at]] <= threshold[at], below[at], above[at])
                total += credits[at]
            yield batch.drop(columns="_features").assign(base=base, credits=list(total / len(starts)))

    return step


def path_attributions(
    rows: DataFrame, model: RandomForestRegressionModel, names: Sequence[str], keys: Sequence[str], features: str = "features"
) -> DataFrame:
    """``keys, feature, contribution, base``: a row's contributions and ``base`` add up to its prediction.

    Each row walks down every tree; a split's change of the mean counts for its feature. ``base`` is the mean of the roots.
    ``keys`` must tell the rows apart.
    """
    spark, trees = rows.sparkSession, model.getNumTrees
    nodes = materialize(forest_nodes(spark, model), "forest-nodes")
    depth = max(t.depth for t in model.trees)
    credits = materialize(_node_credits(nodes, depth, len(names)), "node-credits")
    means = [F.avg(F.col("credits")[i]).alias(f"_c{i}") for i in range(len(names))]
    if model.totalNumNodes <= BROADCAST_NODES:
        bound_batches(spark)
        forest = nodes.join(credits, ["tree", "node"], "left").orderBy("tree", "node").toPandas()
        wanted = rows.select(*keys, F.col(features).cast("array<double>").alias("_features"))
        schema = T.StructType([*wanted.drop("_features").schema.fields, T.StructField("base", T.DoubleType()), T.StructField("credits", T.ArrayType(T.DoubleType()))])
        reached = wanted.mapInPandas(_walk(forest, depth, len(names)), schema)
    else:
        splits = nodes.select("tree", "node", "below", "above", "feature", "threshold")
        walk = rows.select(*keys, features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
        for _ in range(depth):
            goes_below = F.get(F.col(features), F.col("feature")) <= F.col("threshold")
            following = F.when(F.col("below") < 0, F.col("node")).when(goes_below, F.col("below")).otherwise(F.col("above"))
            walk = walk.join(splits, ["tree", "node"]).select(*keys, features, "tree", following.alias("node"))
        reached = walk.join(credits, ["tree", "node"])
    summed = reached.groupBy(*keys).agg(F.avg("base").alias("base"), *means)
    parts = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(f"_c{i}").alias("contribution")) for i, name in enumerate(names)])
    return summed.select(*keys, "base", F.explode(parts).alias("p")).select(*keys, "p.feature", "p.contribution", "base")


def save_model(model: RandomForestRegressionModel | PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> RandomForestRegressionModel:
    return RandomForestRegressionModel.load(path)
