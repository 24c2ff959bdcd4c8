"""Registered queries: a name, a Spark plan and, where SQL can say it, its oracle."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgauge.plans.inputs import DERIVED, Tables
from tollgauge.plans.oracle_parts import PARTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_inputs(needs: str, body: str) -> str:
    """Oracle text: needed inputs and shared parts as table expressions, then the query."""
    order: list[str] = []

    def visit(name: str) -> None:
        deps = DERIVED[name][0] if name in DERIVED else PARTS[name][0] if name in PARTS else None
        if deps is None or name in order:
            return
        for dep in deps:
            visit(dep)
        order.append(name)

    for name in needs.split():
        visit(name)
    parts = []
    for name in order:
        if name in DERIVED:
            deps, text = DERIVED[name]
            text = text.format(**{d: d for d in deps})
        else:
            text = PARTS[name][1]
        parts.append(f"{name} AS MATERIALIZED ({text})")
    head, recursive = body.strip(), ""
    if head.upper().startswith("WITH RECURSIVE "):
        head, recursive = "," + head[len("WITH RECURSIVE"):], "RECURSIVE "
    elif head.upper().startswith("WITH "):
        head = "," + head[len("WITH"):]
    if not parts:
        return body.strip()
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + head


def query(name: str, needs: str = "", sql: str | None = None):
    """Register ``fn(tables)`` under a name; ``needs`` names the oracle's inputs."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(fn(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = with_inputs(needs, sql)
        return fn
    return register


def plain(df: DataFrame) -> DataFrame:
    """Flat columns of simple types, so that any reader sees the same values."""
    cols = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("bigint" if kind.scale == 0 else "double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.FloatType):
            col = col.cast("double")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            col = F.array_join(col, "|")
        cols.append(col.alias(field.name))
    return df.select(*cols)
