"""Data-metric functions with expectations (row count, NULL and duplicate keys).

Each table is measured in a single aggregate pass; expectations are SQL
expressions over a ``VALUE`` column (``VALUE > 0``), evaluated by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telvault.schemas import primary_key


@dataclass(frozen=True)
class MetricSpec:
    name: str                  # ROW_COUNT | NULL_COUNT | DUPLICATE_COUNT
    argument: str | None       # column, or None for table-level metrics
    expectation: str           # expectation name
    expression: str            # e.g. "VALUE > 0"


def default_metrics(table: str, pk: str) -> list[MetricSpec]:
    """Default per-table metrics: rows present, key never NULL, key unique."""
    return [MetricSpec("ROW_COUNT", None, f"{table}_has_rows", "VALUE > 0"),
            MetricSpec("NULL_COUNT", pk, f"{pk}_not_null", "VALUE = 0"),
            MetricSpec("DUPLICATE_COUNT", pk, f"{pk}_unique", "VALUE = 0")]


def _measure(m: MetricSpec):
    if m.name == "ROW_COUNT":
        return F.count(F.lit(1))
    if m.name == "NULL_COUNT":
        return F.count_if(F.col(m.argument).isNull())
    raise ValueError(f"unknown metric {m.name}")


def _keyed_measure(m: MetricSpec):
    """The same from rows (__k, __n): a value of the key and how often it occurs."""
    n, null = F.col("__n"), F.col("__k").isNull()
    if m.name == "ROW_COUNT":
        return F.sum(n)
    if m.name == "NULL_COUNT":
        return F.sum(F.when(null, n))
    # non-NULL rows beyond the first occurrence of each value
    return F.sum(F.when(~null, n - 1))


def _measured(df: DataFrame, specs: list[MetricSpec]) -> list[tuple[DataFrame, list[int]]]:
    """One-row frames of the metrics ``__m<number>``, and which they hold. A column whose duplicates are counted is
    grouped alone, once, and gives the counts of rows and of its NULLs too: in one aggregate with other counters, a
    distinct count would carry every counter through its shuffle."""
    out, left = [], list(range(len(specs)))
    for key in dict.fromkeys(s.argument for s in specs if s.name == "DUPLICATE_COUNT"):
        mine = [i for i in left if specs[i].argument == key or specs[i].name == "ROW_COUNT"]
        grouped = df.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        out.append((grouped.agg(*[F.coalesce(_keyed_measure(specs[i]), F.lit(0)).cast("bigint").alias(f"__m{i}") for i in mine]), mine))
        left = [i for i in left if i not in mine]
    if left:
        out.append((df.agg(*[_measure(specs[i]).cast("bigint").alias(f"__m{i}") for i in left]), left))
    return out


def data_metrics(tables: dict[str, DataFrame], config: dict[str, list[MetricSpec]] | None = None) -> DataFrame:
    """(table_name, metric, argument, value, expectation, expression, passed).

    ``config`` overrides the default metric list of a table.
    """
    config = config or {}
    frames = []
    for t, df in tables.items():
        specs = config.get(t) or default_metrics(t, primary_key(t, df.columns))
        rows = reduce(lambda a, b: a.unionByName(b), [m.select(F.inline(F.array(*[
            F.struct(F.lit(specs[i].name).alias("metric"), F.lit(specs[i].argument).cast("string").alias("argument"),
                     F.col(f"__m{i}").alias("value"), F.lit(specs[i].expectation).alias("expectation"),
                     F.lit(specs[i].expression).alias("expression"), F.lit(i).alias("__i"))
            for i in held]))) for m, held in _measured(df, specs)])
        # every expectation is an expression over VALUE; pick the row's own
        passed = F.lit(False)
        for i, s in enumerate(specs):
            passed = F.when(F.col("__i") == i, F.coalesce(F.expr(s.expression), F.lit(False))).otherwise(passed)
        frames.append(rows.select(F.lit(t).alias("table_name"), "metric", "argument", "value", "expectation",
                                  "expression", passed.alias("passed")))
    return reduce(lambda a, b: a.unionByName(b), frames)
