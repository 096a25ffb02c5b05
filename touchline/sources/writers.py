"""DataFrames to files and tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.operators.columns import ensure_unique, storable

PARTITION = ("league_code", "season_code")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet with unique column names and storable types."""
    storable(ensure_unique(df)).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", bom: bool = False, encoding: str = "UTF-8") -> None:
    """CSV with header; blanks at the ends of text are kept. ``bom`` puts a byte order mark before each file's header, as
    spreadsheets want it."""
    options = {"header": True, "sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "encoding": encoding}
    if bom:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode(mode).options(**options).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_raw(df: DataFrame, root: str, kind: str) -> None:
    """Raw zone: one folder per source, league and season, so that no load overwrites another."""
    rebalanced = df.hint("rebalance", "source", "league", "season")
    rebalanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "source", "league", "season"
    ).parquet(f"{root.rstrip('/')}/{kind}")


def replace_table(df: DataFrame, path: str) -> None:
    """Full replacement; an empty frame leaves an empty table with its schema."""
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, keys: Sequence[str] = ("player_id", "season_code", "club")) -> DataFrame:
    """Store a table in ``buckets`` files by a hash of the keys, sorted, with a Bloom filter on the first key; returns it as read back.

    Tables of as many buckets join on all these keys without a shuffle. Spark shuffles again where a join has more keys than the
    buckets, so they are dealt by all; a search for one player passes over the row groups whose filter rules it out.
    """
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    dealt.option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").saveAsTable(table, path=path)
    return df.sparkSession.table(table)


def refresh_partitions(df: DataFrame, path: str, refreshed: DataFrame | None = None, partition: Sequence[str] = PARTITION) -> None:
    """Replace the partitions of ``df`` and leave all others; running it twice equals running it once.

    ``refreshed`` lists all partitions being loaded: those without rows now are emptied.
    """
    refresh_together({path: df}, refreshed, partition)


def refresh_together(frames: dict[str, DataFrame], refreshed: DataFrame | None = None, partition: Sequence[str] = PARTITION) -> None:
    """``refresh_partitions`` of several tables, path to rows, as one load.

    All tables are first written to staging folders beside them, each frame once; only when every one is complete are
    the partition folders exchanged, which takes renames only. A load that fails while it computes changes no table. The
    rebalance hint splits a partition that holds much of the data over several files.
    """
    staged = {}
    for path, df in frames.items():
        staging = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex}"
        ordered = df.select(*[c for c in df.columns if c not in partition], *partition)
        ordered.hint("rebalance", *partition).write.partitionBy(*partition).parquet(staging)
        staged[path] = staging
    for path, staging in staged.items():
        spark = frames[path].sparkSession
        folders = _partition_folders(spark, staging, partition)
        emptied = _named_folders(refreshed, partition) if refreshed is not None else set()
        _exchange(spark, staging, path.rstrip("/"), folders, emptied - folders)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _partition_folders(spark: SparkSession, path: str, partition: Sequence[str]) -> set[str]:
    """The partition folders of a table relative to it; a load has one per league and season, so the list is short."""
    root, files = _hadoop(spark, path)
    pattern, _ = _hadoop(spark, "/".join([path, *[f"{c}=*" for c in partition]]))
    base = files.makeQualified(root).toString().rstrip("/")
    return {status.getPath().toString().removeprefix(f"{base}/") for status in files.globStatus(pattern) or []}


def _named_folders(rows: DataFrame, partition: Sequence[str]) -> set[str]:
    """The folders of the listed partitions, named as Spark names them; null and the empty text share the default name."""
    utils = rows.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    default = utils.DEFAULT_PARTITION_NAME()
    named = rows.select(*[F.col(c).cast("string") for c in partition]).distinct().collect()
    return {"/".join(f"{c}={utils.escapePathName(v) if v else default}" for c, v in zip(partition, row)) for row in named}


def _exchange(spark: SparkSession, staging: str, path: str, folders: set[str], emptied: set[str]) -> None:
    """Puts the staged folders in the place of the table's and removes the emptied ones."""
    source, files = _hadoop(spark, staging)
    if not files.exists(_hadoop(spark, path)[0]):
        files.rename(source, _hadoop(spark, path)[0])
        return
    for folder in sorted(folders | emptied):
        target = _hadoop(spark, f"{path}/{folder}")[0]
        files.delete(target, True)
        if folder in folders:
            files.mkdirs(target.getParent())
            if not files.rename(_hadoop(spark, f"{staging}/{folder}")[0], target):
                raise OSError(f"could not move {staging}/{folder} to {path}")
    files.delete(source, True)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Rows to a database in batches; address and credentials come from the caller."""
    df.write.mode(mode).option("batchsize", 1000).jdbc(url, table, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return spark.read.option("fetchsize", 1000).jdbc(url, table, properties=properties)


def observed(df: DataFrame, name: str):
    """The frame with row, keeper and field counts gathered while it is written; no extra job."""
    from pyspark.sql import Observation

    watch = Observation(name)
    counts = [F.count(F.lit(1)).alias("n_rows")]
    if "IsGK" in df.columns:
        counts += [F.count_if(F.col("IsGK")).alias("n_keepers"), F.count_if(~F.col("IsGK")).alias("n_field")]
    return df.observe(watch, *counts), watch
