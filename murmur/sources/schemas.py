"""Schema inference and evolution for NDJSON: what each run's files hold is written to a log, and the
table's schema is the join of all of it.

The evidence for a field is the set of kinds its values had, as bits; evidence is merged by OR, which is
associative, so tasks merge their lines, Spark the tasks and the log its runs, in any order and as often
as they like. New fields are added, vanished ones stay, conflicting kinds widen (long to double,
anything else to text), and a later run never narrows a field."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType

BOOL, LONG, DOUBLE, TEXT, OBJECT, LIST = (1 << k for k in range(6))
NUMBER = LONG | DOUBLE
#: The step of a path into a list's elements.
ELEMENT = "[]"
_EVIDENCE = pa.schema([("path", pa.list_(pa.string())), ("kinds", pa.int64()), ("n_values", pa.int64())])


def _see(value, path: tuple, seen: dict) -> None:
    kind = (BOOL if isinstance(value, bool) else (LONG if -2**63 <= value < 2**63 else DOUBLE) if isinstance(value, int) else DOUBLE
            if isinstance(value, float) else TEXT if isinstance(value, str) else OBJECT if isinstance(value, dict) else LIST if isinstance(value, list) else 0)
    kinds, n = seen.get(path, (0, 0))
    seen[path] = (kinds | kind, n + 1)
    if kind == OBJECT:
        for k, v in value.items():
            _see(v, (*path, k), seen)
    elif kind == LIST:
        for v in value:
            _see(v, (*path, ELEMENT), seen)


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}
    for b in batches:
        for line in b.column(0).to_pylist():
            try:
                value = json.loads(line)
            except ValueError:
                continue  # corrupt lines are no evidence
            if isinstance(value, dict):
                for k, v in value.items():
                    _see(v, (k,), seen)
    yield pa.RecordBatch.from_arrays([pa.array(list(map(list, seen)), pa.list_(pa.string())), pa.array([v[0] for v in seen.values()], pa.int64()),
                                      pa.array([v[1] for v in seen.values()], pa.int64())], schema=_EVIDENCE)


def merged(evidence: DataFrame) -> DataFrame:
    """(path, kinds, n_values): one row per field."""
    return evidence.groupBy("path").agg(F.bit_or("kinds").alias("kinds"), F.sum("n_values").alias("n_values"))


def crawl(spark: SparkSession, path: str, log: str, run: int) -> None:
    """Add the evidence of the NDJSON files under ``path`` to the log as that of ``run`` (a replay writes it
    again). Only the run's own files are read."""
    lines = spark.read.text(path)
    merged(lines.mapInArrow(_evidence, "path array<string>, kinds bigint, n_values bigint")).coalesce(1).write.mode("overwrite").parquet(f"{log}/run={run}")


def read_log(spark: SparkSession, log: str, upto: int | None = None) -> DataFrame:
    d = spark.read.schema("path array<string>, kinds bigint, n_values bigint, run int").parquet(log)
    return d if upto is None else d.filter(F.col("run") <= upto)


def type_name(kinds: Column) -> Column:
    """The type that holds values of all these kinds."""
    return (F.when(kinds == BOOL, "boolean").when(kinds == LONG, "bigint").when(kinds.isin(DOUBLE, NUMBER), "double")
            .when(kinds == OBJECT, "struct").when(kinds == LIST, "array").otherwise("string"))


def _type(kinds: int, path: tuple, fields: dict) -> DataType:
    if kinds == BOOL:
        return BooleanType()
    if kinds and kinds | NUMBER == NUMBER:
        return DoubleType() if kinds & DOUBLE else LongType()
    if kinds == LIST:
        element = (*path, ELEMENT)
        return ArrayType(_type(fields[element], element, fields) if element in fields else StringType())
    if kinds == OBJECT:
        own = _struct(path, fields)
        return own if own.fields else StringType()
    return StringType()  # text, a conflict, or nothing but nulls; other values are read as their JSON text


def _struct(path: tuple, fields: dict) -> StructType:
    own = sorted(p for p in fields if len(p) == len(path) + 1 and p[:-1] == path)
    return StructType([StructField(p[-1], _type(fields[p], p, fields)) for p in own])


def schema_of(spark: SparkSession, log: str, upto: int | None = None) -> StructType:
    """The schema after all runs, or after run ``upto``. One row per field reaches the driver."""
    return _struct((), {tuple(r["path"]): r["kinds"] for r in merged(read_log(spark, log, upto)).collect()})


def changes(spark: SparkSession, log: str) -> DataFrame:
    """(run, field, old_type, new_type): the fields that each run added (no old type) or widened."""
    upto = Window.partitionBy("path").orderBy("run")
    d = read_log(spark, log).withColumn("new_type", type_name(F.bit_or("kinds").over(upto)))
    d = d.withColumn("old_type", F.lag("new_type").over(upto))
    return d.filter(~F.col("new_type").eqNullSafe(F.col("old_type"))).select("run", F.array_join("path", ".").alias("field"), "old_type", "new_type")


def read_evolving_json(spark: SparkSession, path: str, log: str) -> DataFrame:
    """All NDJSON under ``path`` with the merged schema: missing fields are null, widened ones converted."""
    return spark.read.schema(schema_of(spark, log)).json(path)
