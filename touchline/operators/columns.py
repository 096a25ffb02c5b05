"""Column selection, naming, ordering and typing. All of it is plan-time work: no data moves."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, count

from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.functions.parse import number_or_null, number_or_zero, text_or_empty


def col(name: str) -> Column:
    """Column by its literal name; source names hold ``%``, ``/``, ``.``, ``#`` and blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def flatten(df: DataFrame) -> DataFrame:
    """Struct columns to ``outer_inner`` columns, one level, empty parts left out."""
    picked = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            for inner in field.dataType.names:
                picked.append(col(field.name)[inner].alias("_".join(x for x in (field.name, inner) if x)))
        else:
            picked.append(col(field.name))
    return df.select(*picked)


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeated names get ``__dup1``, ``__dup2``, ... skipping names already taken."""
    numbers: dict[str, Iterator[int]] = defaultdict(lambda: count(1))
    given: dict[str, None] = {}  # in order
    for name in names:
        numbered = (f"{name}__dup{i}" for i in numbers[name])
        given[next(n for n in chain([name], numbered) if n not in given)] = None
    return list(given)


def ensure_unique(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(df.columns))


def first_of_each(df: DataFrame) -> DataFrame:
    """Of columns sharing a name only the first stays."""
    by_position = [f"c{i}" for i in range(len(df.columns))]
    first = {}
    for position, name in zip(by_position, df.columns):
        first.setdefault(name, position)
    return df.toDF(*by_position).select(*[F.col(p).alias(name) for name, p in first.items()])


def add_prefix(df: DataFrame, prefix: str, keep: Iterable[str] = ("Player",)) -> DataFrame:
    """Prefix bare column names with the table's own most frequent prefix, else with ``prefix``; ties go by alphabet."""
    keep = set(keep)
    found = Counter(m.group(1).lower() for c in df.columns if c not in keep and (m := re.match(r"([A-Za-z]+)_", c)))
    chosen = min(found, key=lambda p: (-found[p], p)) if found else prefix
    return df.toDF(*[c if c in keep or re.match(r"[A-Za-z]+_", c) else f"{chosen}_{c}" for c in df.columns])


def _by_ending(names: Sequence[str]) -> dict[str, str]:
    """What follows any underscore of a name -> the first name with that ending."""
    endings: dict[str, str] = {}
    for name in names:
        rest = name
        while "_" in rest:
            rest = rest.partition("_")[2]
            endings.setdefault(rest, name)
    return endings


def resolve_names(available: Sequence[str], wanted: dict[str, str]) -> dict[str, str]:
    """Target name -> source column: the name itself where it exists, else a column of another table prefix.

    Two targets that would read the same source through the fallback are an error.
    """
    exact = dict.fromkeys(available)
    endings = _by_ending(available)
    sources = {target: source if source in exact else endings.get(source.partition("_")[2] or source) for source, target in wanted.items()}
    resolved = {target: source for target, source in sources.items() if source is not None}
    if len(set(resolved.values())) < len(resolved):
        shared = sorted(source for source, n in Counter(resolved.values()).items() if n > 1)
        raise ValueError(f"several targets would read the same column: {shared}")
    return resolved


def existing(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    return [c for c in candidates if c in df.columns]


def ensure_columns(df: DataFrame, schema: T.StructType | dict[str, str]) -> DataFrame:
    """Add missing columns as typed nulls."""
    kinds = schema if isinstance(schema, dict) else {f.name: f.dataType.simpleString() for f in schema.fields}
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order and type; bad values become null."""
    full = ensure_columns(df, schema)
    kinds = {f.name: f.dataType for f in full.schema.fields}
    picked = []
    for field in schema.fields:
        value = col(field.name)
        if kinds[field.name] != field.dataType:
            if isinstance(field.dataType, T.IntegralType):
                value = number_or_null(value).try_cast(field.dataType)
            else:
                value = value.try_cast(field.dataType)
        picked.append(value.alias(field.name))
    return full.select(*picked)


def order_columns(df: DataFrame, front: Sequence[str]) -> DataFrame:
    """Front columns first, where present, then the rest as they are."""
    head = existing(df, front)
    return df.select(*[col(c) for c in head], *[col(c) for c in df.columns if c not in head])


def coerce_numbers(df: DataFrame, text: Sequence[str]) -> DataFrame:
    """Text columns: null to empty. All others: to number, anything unreadable to 0."""
    return df.select(*[(text_or_empty if c in text else number_or_zero)(col(c)).alias(c) for c in df.columns])


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named columns, where present, to number; anything unreadable to null."""
    return df.withColumns({c: number_or_null(col(c)) for c in existing(df, columns)})


def storable(df: DataFrame) -> DataFrame:
    """Nested, binary and interval columns as text; plain columns untouched; null stays null."""
    plain = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    picked = []
    for field in df.schema.fields:
        value = col(field.name)
        if isinstance(field.dataType, T.BinaryType):
            value = F.replace(F.make_valid_utf8(value.cast("string")), F.lit("\ufffd"), F.lit(""))
        elif not isinstance(field.dataType, plain):
            value = F.to_json(value) if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")
        picked.append(value.alias(field.name))
    return df.select(*picked)
