"""Landed files to DataFrames."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from touchline.functions.parse import all_of, checked_season_start
from touchline.operators.columns import existing, unique_names

_FILE = r"join_([^_/]+)(?:_([^/]*))?_mv\.csv(?:/[^/]*)?$"


def read_stat_tables(
    spark: SparkSession, root: str, kinds: Sequence[str], source: str | None = None, schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """One DataFrame per table kind from ``root/<kind>/source=/league=/season=``; all leagues and seasons at once.

    A schema per kind spares reading the footers of all files; without it the columns of all files are merged.
    """
    tables = {}
    for kind in kinds:
        known = (schemas or {}).get(kind)
        reader = spark.read.schema(known) if known else spark.read.option("mergeSchema", "true")
        df = reader.parquet(f"{root.rstrip('/')}/{kind}")
        tables[kind] = df.filter(F.col("source") == source) if source and "source" in df.columns else df
    return tables


def _text_schema(header: str, sep: str) -> T.StructType:
    """Text columns by the header, read as a CSV line; names that differ only in case are told apart, as Spark does not
    distinguish them."""
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")], delimiter=sep), [])]
    lowered = unique_names([n.lower() for n in names])
    return T.StructType([T.StructField(n + low[len(n):], T.StringType()) for n, low in zip(names, lowered)])


def _separator(header: str) -> str:
    return ";" if header.count(";") > header.count(",") else ","


def file_headers(spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None) -> DataFrame:
    """The first line of every file and its encoding, in one pass over all files: ``file``, ``header``, ``encoding``.

    Without a given encoding a file is UTF-8 if all its lines are, else Latin-1.
    """
    text = spark.read.option("encoding", encoding).text(paths) if encoding else spark.read.text(paths)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), "value", F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at")
    )
    found = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"), F.every(F.is_valid_utf8("value")).alias("is_utf8"))
    if encoding:
        return found.select("file", "header", F.lit(encoding).alias("encoding"))
    latin = F.decode(F.col("header").cast("binary"), "ISO-8859-1")
    return found.select(
        "file", F.when(F.col("is_utf8"), F.col("header")).otherwise(latin).alias("header"), F.when(F.col("is_utf8"), "UTF-8").otherwise("ISO-8859-1").alias("encoding")
    )


def _grouped(spark: SparkSession, paths: str | Sequence[str], encoding: str | None) -> dict[tuple[str, str], list[str]]:
    """Files by (header, encoding): as many groups as there are kinds of files. A file without any text is left out."""
    groups: dict[tuple[str, str], list[str]] = {}
    for row in file_headers(spark, paths, encoding).orderBy("file").collect():
        if row.header:
            groups.setdefault((row.header, row.encoding), []).append(row.file)
    return groups


def read_csv(
    spark: SparkSession, path: str | Sequence[str], sep: str | None = None, encoding: str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV files with headers as text columns, matched by name where the files' headers differ.

    Separator and encoding (UTF-8 or Latin-1) are found per file when not given. ``multi_line`` reads quoted line breaks;
    such a file is read by one task.
    """
    parts = []
    for (header, own), files in _grouped(spark, path, encoding).items():
        cut = sep or _separator(header)
        options = {"header": True, "sep": cut, "encoding": own, "mode": "PERMISSIVE", "enforceSchema": True, "escape": '"', "multiLine": multi_line}
        parts.append(spark.read.options(**options).schema(_text_schema(header, cut)).csv(files))
    if not parts:
        raise FileNotFoundError(f"no header in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_reporting(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rows with a value that does not fit its type: as text, with their file (``_file``).

    The types are checked on the text, since the CSV reader checks only the columns a query happens to use.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.options(header=True, sep=sep, escape='"').schema(text).csv(path)
    misfit = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema.fields]
    bad = ~all_of([~m for m in misfit])
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.filter(~bad).select(*typed), rows.filter(bad).select("*", F.col("_metadata.file_path").alias("_file"))


def file_league(path: Column) -> Column:
    """``join_bel_2025_2026_mv.csv`` -> ``bel``; null for other names. Spark's folders of part files count as files."""
    code = F.regexp_extract(F.lower(path), _FILE, 1)
    return F.when(code != "", code)


def file_season(path: Column) -> Column:
    """``join_bel_2025_2026_mv.csv`` -> ``2025-2026``."""
    season = F.replace(F.regexp_extract(F.lower(path), _FILE, 2), F.lit("_"), F.lit("-"))
    return F.when(file_league(path).isNotNull(), season)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders a pattern matches; one per league and season, so the list is short."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def read_joined_files(spark: SparkSession, folder: str, pattern: str = "join_*_mv.csv", sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All matching files as text, with league and season taken from the file names; other names are skipped.

    Files with the same header are read together; those with other columns are joined to them by column name.
    """
    paths = list_paths(spark, f"{folder.rstrip('/')}/{pattern}")
    groups = _grouped(spark, paths, encoding) if paths else {}
    if not groups:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    options = {"header": True, "sep": sep, "escape": '"', "encoding": encoding}
    parts = [spark.read.options(**options).schema(_text_schema(header, sep)).csv(files) for (header, _), files in groups.items()]
    file = F.col("_metadata.file_path")
    named = [df.withColumns({"league_code": file_league(file), "season_code": file_season(file)}) for df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named).filter(F.col("league_code").isNotNull())


def unprocessed(paths: Sequence[str]) -> list[str]:
    """Joined files that are not outputs themselves and have none yet."""
    done = {p for p in paths if p.lower().endswith("_mv.csv")}
    return [p for p in paths if p not in done and re.sub(r"\.csv$", "_mv.csv", p) not in done]


def work_list(spark: SparkSession, leagues: dict[str, Sequence[str | int]], sources: Sequence[str] = ("fbref", "transfermarkt")) -> DataFrame:
    """``league, season, season_start, source``: one row per season to load. A configuration, hence small."""
    rows = [(code, [str(s) for s in seasons], list(sources)) for code, seasons in leagues.items()]
    for _, seasons, _ in rows:
        for season in seasons:
            checked_season_start(season)
    table = spark.createDataFrame(rows, "league string, seasons array<string>, sources array<string>")
    return table.select("league", F.explode("seasons").alias("season"), "sources").select(
        "league", "season", F.substring("season", 1, 4).cast("int").alias("season_start"), F.explode("sources").alias("source")
    )


def read_ids(spark: SparkSession, path: str, name: str = "player_id") -> DataFrame:
    """Ids from JSON files, each one array of ids, with their place in the array."""
    lists = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>").alias("ids"))
    return lists.select(F.posexplode("ids").alias("at", name))


def team_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Team ids per league and season, typed; a small configuration table."""
    teams = read_csv(spark, path, ",", "UTF-8")
    return teams.withColumns({"team_id": F.col("team_id").try_cast("long"), "season": F.trim("season")})


def pruned(df: DataFrame, *candidates: Sequence[str]) -> DataFrame:
    """The wanted columns the table has, and no others, so that the scan reads nothing else."""
    return df.select(*existing(df, [c for group in candidates for c in group]))
