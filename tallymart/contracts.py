"""Contracts: the fields, keys and grain of a table as data, and the Spark schema they stand for."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, types as T

SIMPLE = {"string": T.StringType(), "integer": T.IntegerType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(), "decimal": T.DecimalType(38, 18)}
#: What a processed table carries besides its own fields.
RUN_FIELDS = {"batch_id": "string", "source_file_id": "string", "ingestion_timestamp": "timestamp", "processing_timestamp": "timestamp", "contract_version": "integer"}


def spark_type(name: str) -> T.DataType:
    """A logical type name; decimal(p,s) may carry parameters. Anything else raises ValueError."""
    if name in SIMPLE:
        return SIMPLE[name]
    if m := re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", name):
        return T.DecimalType(int(m[1]), int(m[2]))
    raise ValueError(f"no such type: {name}")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = False
    source: str | None = None

    @property
    def source_name(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    grain: tuple[str, ...] = ()
    tracked: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.source_name, T.StringType()) for f in self.fields])

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, spark_type(f.type), f.nullable) for f in self.fields])


def contract(name: str, fields: str, key: str = "", grain: str = "", tracked: str = "") -> Contract:
    """A contract from text: `name type`, `name type?` if nullable, `source>name type` if renamed; comma-separated."""
    made = []
    for part in re.split(r",\s*(?![^(]*\))", fields.strip()):
        column, kind = part.strip().split(" ", 1)
        source, _, canonical = column.rpartition(">")
        made.append(Field(canonical, kind.rstrip("?"), kind.endswith("?"), source or None))
    return Contract(name, tuple(made), tuple(key.split()), tuple((grain or key).split()), tuple(tracked.split()))


class SchemaMismatch(ValueError):
    """Columns or types are not those of the contract."""


def assert_schema(df: DataFrame, expected: Contract, run_fields: bool = False) -> DataFrame:
    """df itself if its ordered names and types are the contract's; nullability is a matter of content."""
    want = [(f.name, spark_type(f.type).simpleString()) for f in expected.fields]
    want += [(n, spark_type(t).simpleString()) for n, t in RUN_FIELDS.items()] if run_fields else []
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if got != want:
        raise SchemaMismatch(f"{expected.name}: {[x for x in got if x not in want]} instead of {[x for x in want if x not in got]}")
    return df
