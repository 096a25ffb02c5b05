"""Several partitioned tables under one version: a load replaces partitions of all of them in one step, or of none.

Every load writes new folders beside those in use. A version is a small file that names, for each table, the folder of each
partition; it comes into being by one rename that fails if the number is taken. Readers take the newest version, or one they
name, and see its folders only, whatever is written meanwhile. A load that fails, in the first table or between two, leaves no
version; a crash leaves folders that no version names, which ``vacuum`` removes.

The list of partitions is short, one per league and season, and passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from touchline.sources.writers import PARTITION, _hadoop, _named_folders, _partition_folders

_DIGITS = 20


class Conflict(RuntimeError):
    """Another load has replaced the same partitions meanwhile."""


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, rising."""
    pattern, files = _hadoop(spark, f"{root.rstrip('/')}/versions/{'[0-9]' * _DIGITS}.json")
    return sorted(int(s.getPath().getName().removesuffix(".json")) for s in files.globStatus(pattern) or [])


def _file(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/versions/{number:0{_DIGITS}}.json"


def manifest(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, dict]:
    """A version, the newest unless named, and its tables: schema, and the load of each partition folder."""
    if number is None:
        number = max(versions(spark, root), default=0)
    if number == 0:
        return 0, {}
    path, files = _hadoop(spark, _file(root, number))
    stream = files.open(path)
    try:
        return number, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, root: str, number: int, tables: dict) -> bool:
    """Writes a version under a passing name and gives it its number by one rename; false if that number is taken."""
    target, files = _hadoop(spark, _file(root, number))
    passing, _ = _hadoop(spark, f"{root.rstrip('/')}/versions/_{uuid.uuid4().hex}")
    out = files.create(passing, False)
    out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE  # never over a file that is there
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(passing), files.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        files.delete(passing, False)
        if files.exists(target):
            return False
        raise error


def commit(root: str, frames: dict[str, DataFrame], refreshed: DataFrame | None = None, partition: Sequence[str] = PARTITION) -> int:
    """Replace the partitions of all frames, table name to rows, in one version; returns its number.

    ``refreshed`` lists all partitions being loaded: those without rows now are emptied in every table. Partitions of other
    loads stay; a load that meets another one's changes of its own partitions raises ``Conflict`` and changes nothing.
    """
    spark = next(iter(frames.values())).sparkSession
    base, before = manifest(spark, root)
    load, written = f"load={uuid.uuid4().hex}", {}
    try:
        emptied = _named_folders(refreshed, partition) if refreshed is not None else set()
        for name, df in frames.items():
            path = f"{root.rstrip('/')}/data/{name}/{load}"
            ordered = df.select(*[c for c in df.columns if c not in partition], *partition)
            written[name] = path, ordered.schema
            ordered.hint("rebalance", *partition).write.partitionBy(*partition).parquet(path)
        folders = {name: _partition_folders(spark, path, partition) for name, (path, _) in written.items()}
        while True:
            number, tables = manifest(spark, root)
            for name, (_, schema) in written.items():
                now, then = (t.get(name, {}).get("folders", {}) for t in (tables, before))
                touched = folders[name] | emptied
                if number != base and any(now.get(f) != then.get(f) for f in touched):
                    raise Conflict(f"{name} was refreshed by another load since version {base}")
                kept = {f: at for f, at in now.items() if f not in touched}
                tables[name] = {"schema": schema.jsonValue(), "folders": kept | dict.fromkeys(sorted(folders[name]), load)}
            if _publish(spark, root, number + 1, tables):
                return number + 1
    except BaseException:
        for path, _ in written.values():
            target, files = _hadoop(spark, path)
            files.delete(target, True)
        raise


def read_table(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A table as of a version, the newest unless named."""
    number, tables = manifest(spark, root, number)
    if name not in tables:
        raise KeyError(f"no table {name} in version {number} of {root}")
    return _rows(spark, root, name, StructType.fromJson(tables[name]["schema"]), tables[name]["folders"])


def changed_rows(spark: SparkSession, root: str, name: str, old: int, new: int) -> DataFrame:
    """All rows of the partitions that loads between two versions have replaced, as they were and as they are."""
    none = {"folders": {}}
    was, now = (manifest(spark, root, number)[1].get(name, none) for number in (old, new))
    schema = StructType.fromJson(now.get("schema") or was["schema"])
    replaced = {f for f in was["folders"] | now["folders"] if was["folders"].get(f) != now["folders"].get(f)}
    sides = [_rows(spark, root, name, schema, {f: at for f, at in t["folders"].items() if f in replaced}) for t in (was, now)]
    return sides[0].unionByName(sides[1])


def _rows(spark: SparkSession, root: str, name: str, schema: StructType, folders: dict[str, str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/data/{name}"
    paths = [f"{base}/{load}/{folder}" for folder, load in sorted(folders.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Removes all versions but the newest ``keep`` and the load folders that none of these names; returns how many folders. Not to be
    run beside a load."""
    numbers = versions(spark, root)
    kept = [manifest(spark, root, n)[1] for n in numbers[-keep:]]
    used = {(name, load) for tables in kept for name, table in tables.items() for load in table["folders"].values()}
    for n in numbers[:-keep]:
        path, files = _hadoop(spark, _file(root, n))
        files.delete(path, False)
    pattern, files = _hadoop(spark, f"{root.rstrip('/')}/data/*/load=*")
    removed = 0
    for status in files.globStatus(pattern) or []:
        path = status.getPath()
        if (path.getParent().getName(), path.getName()) not in used:
            removed += files.delete(path, True)
    return removed
