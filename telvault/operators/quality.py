"""Data tests, quality rules, schema checks, reconciliation and freshness.

Every check yields report rows rather than raising, so a run can publish
its own verdict. Checks over one table are fused into one aggregate pass
where the semantics allow (all NULL counts of a table in one ``agg``; all
unique tests of a table in one scan, with its not_null tests).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.functions.windows import as_timestamp
from telvault.session import materialize

TABLES_AT_ONCE = 4  # tables whose jobs run side by side
TEST_REPORT_SCHEMA = "target string, column_name string, test string, failures bigint, passed boolean"


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union report frames of one schema (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def require(tables, names) -> None:
    """Refuse a check of tables that are not given: leaving them out would look like a pass."""
    absent = sorted({t for t in names if t not in tables})
    if absent:
        raise KeyError(f"tables to check are absent: {', '.join(absent)}")


def _test_row(target: str, column: str, test: str, failures) -> list:
    f = failures if not isinstance(failures, (int, type(None))) else F.lit(failures)
    return [F.lit(target).alias("target"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
            f.cast("bigint").alias("failures"), (f.cast("bigint") == 0).alias("passed")]


def _rows(one_row: DataFrame, structs: list) -> DataFrame:
    """Explode a one-row aggregate into report rows without re-running it per row."""
    return one_row.select(F.inline(F.array(*structs)))


def _test_struct(target: str, column: str, test: str, failures):
    return F.struct(*_test_row(target, column, test, failures))


# ---- dbt-style column tests ---------------------------------------------------
def repeated_values(df: DataFrame, columns: list[str], not_null: list[str] = (), hash_bits: int = 64) -> dict[str, tuple[int, int]]:
    """{column: (values that occur more than once, NULL rows)} of ``columns``, and the NULL rows of ``not_null``, in one scan.

    The scan counts pairs of a column number and the hash of its value, combined in each input partition; no
    column gets a shuffle of its own, and the counters of one do not travel with the keys of another. Only hashes
    met several times are written. Where there are any, a second scan counts the values behind these hashes
    exactly, so a collision is told from a repetition. One row a column comes to the driver.
    """
    names = [*columns, *[c for c in not_null if c not in columns]]
    hashes = [F.when(F.col(c).isNotNull(), F.shiftright(F.xxhash64(F.col(c)), 64 - hash_bits) if k < len(columns) else F.lit(0))
              for k, c in enumerate(names)]
    cells = df.select(F.posexplode(F.array(*[h.cast("bigint") for h in hashes])).alias("k", "h"))
    cells = cells.where((F.col("k") < len(columns)) | F.col("h").isNull())  # of the others only NULLs are counted
    met = cells.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"))
    several = (F.col("n") > 1) & F.col("h").isNotNull()
    first = {r["k"]: r for r in met.groupBy("k").agg(F.sum(F.when(F.col("h").isNull(), F.col("n"))).alias("nulls"),
                                                     F.count_if(several).alias("several")).collect()}
    repeated: dict[int, int] = {}
    if any(r["several"] for r in first.values()):
        # of the columns concerned: the hashes, written, so that Spark knows how few they are, and the values behind them
        some = sorted(k for k, r in first.items() if r["several"])
        hits = materialize(met.where(several & F.col("k").isin(some)).select("k", "h"))
        pairs = F.array(*[F.struct(F.lit(k).alias("k"), hashes[k].cast("bigint").alias("h"), F.col(names[k]).cast("string").alias("v")) for k in some])
        cells = df.select(F.inline(pairs)).join(hits, ["k", "h"], "left_semi")
        exact = cells.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        repeated = {r["k"]: r["n"] for r in exact.collect()}
    return {c: (repeated.get(k, 0), (first[k]["nulls"] or 0) if k in first else 0) for k, c in enumerate(names)}


def column_test_rows(df: DataFrame, target: str, tests: list[tuple[str, tuple[str, ...]]]) -> list[tuple]:
    """Report rows of the tests of one table that has unique tests, from the scan of ``repeated_values``."""
    found = repeated_values(df, [c for c, t in tests if "unique" in t], [c for c, t in tests if "not_null" in t])
    rows = [(target, c, k, found[c][k == "not_null"]) for c, t in tests for k in ("unique", "not_null") if k in t]
    return [(*r, r[-1] == 0) for r in rows]


def column_tests(df: DataFrame, target: str, tests: list[tuple[str, tuple[str, ...]]]) -> DataFrame:
    """unique / not_null tests of one table.

    * ``unique``: number of non-NULL values that occur more than once.
    * ``not_null``: number of NULL rows.
    With a unique test all columns share the scan of ``repeated_values``; else one ``agg`` counts the NULLs.
    """
    if any("unique" in t for _, t in tests):
        return df.sparkSession.createDataFrame(column_test_rows(df, target, tests), TEST_REPORT_SCHEMA).coalesce(1)
    nulls = [c for c, _ in tests]
    nn = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in nulls])
    return _rows(nn, [_test_struct(target, c, "not_null", F.col(c)) for c in nulls])


def test_unique(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    return column_tests(df, target, [(c, ("unique",)) for c in columns])


def test_not_null(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    return column_tests(df, target, [(c, ("not_null",)) for c in columns])


def test_relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                       target: str) -> DataFrame:
    """Orphan child rows (non-NULL key without a parent).

    Child rows are first counted per key (partial aggregation: one row per
    key and input partition crosses the shuffle, so a hot key costs nothing
    extra), the per-key counts are anti-joined with the parent keys, and the
    orphan counts are summed -- the same number as counting orphan rows.
    """
    per_key = (child.filter(F.col(child_col).isNotNull())
               .groupBy(F.col(child_col).alias("__k")).agg(F.count(F.lit(1)).alias("__n")))
    parents = parent.select(F.col(parent_col).alias("__pk")).filter(F.col("__pk").isNotNull())
    o = per_key.join(parents, F.col("__k") == F.col("__pk"), "left_anti")
    return o.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n")).select(
        *_test_row(target, child_col, "relationships", F.col("n")))


def test_accepted_values(df: DataFrame, column: str, values, target: str) -> DataFrame:
    """Distinct non-NULL values outside the accepted list (one failing row each)."""
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return bad.agg(F.count_distinct(F.col(column)).alias("n")).select(
        *_test_row(target, column, "accepted_values", F.col("n")))


def run_column_tests(tables: dict[str, DataFrame], tests, kinds=("unique", "not_null")) -> DataFrame:
    """Run the listed (table, column, tests); a table that is not there is an error, not a pass."""
    by_table: dict[str, list] = {}
    for t, c, ks in tests:
        ks = tuple(k for k in ks if k in kinds)
        if ks:
            by_table.setdefault(t, []).append((c, ks))
    require(tables, by_table)
    keyed = {t: cols for t, cols in by_table.items() if any("unique" in k for _, k in cols)}
    frames = [column_tests(tables[t], t, cols) for t, cols in by_table.items() if t not in keyed]
    if keyed:
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:  # each table is a job of its own
            rows = [r for found in pool.map(lambda t: column_test_rows(tables[t], t, keyed[t]), keyed) for r in found]
        frames.append(next(iter(tables.values())).sparkSession.createDataFrame(rows, TEST_REPORT_SCHEMA).coalesce(1))
    return union_all(frames)


def run_relationship_tests(tables: dict[str, DataFrame], relationships) -> DataFrame:
    require(tables, [t for c, _, p, _ in relationships for t in (c, p)])
    return union_all([test_relationships(tables[c], cc, tables[p], pc, c) for c, cc, p, pc in relationships])


# ---- contract quality rules ---------------------------------------------------
@dataclass(frozen=True)
class Rule:
    id: str
    type: str            # completeness | uniqueness | valid_values | accuracy
    selector: str
    threshold: float
    operator: str = ">="
    severity: str = "error"
    values: tuple = field(default_factory=tuple)


_OPS = {">=": lambda a, b: a >= b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b,
        "<": lambda a, b: a < b, "=": lambda a, b: a == b, "==": lambda a, b: a == b,
        "!=": lambda a, b: a != b}

RULE_REPORT_COLUMNS = ["target", "rule_id", "rule_type", "selector", "value", "threshold", "operator",
                       "severity", "passed"]


def _rule_measure(r: Rule):
    """Aggregate expression of a rule's measured value (double).

    completeness = non-NULL share of rows; uniqueness = distinct / non-NULL;
    valid_values = share of non-NULL values inside the list; accuracy = the
    value that decides whether all values hold against the threshold: the
    minimum for >= and >, the maximum for <= and <, the value furthest from
    the threshold for =, and for != the threshold if it occurs. An empty
    input measures 1.0 (vacuously complete/unique/valid); accuracy over no
    values is NULL and passes.
    """
    c = F.col(r.selector)
    if r.type == "completeness":
        v = F.try_divide(F.count(c), F.count(F.lit(1)))
    elif r.type == "uniqueness":
        v = F.try_divide(F.count_distinct(c), F.count(c))
    elif r.type == "valid_values":
        v = F.try_divide(F.count_if(c.isin(list(r.values))), F.count(c))
    elif r.type == "accuracy":
        low, high, at = F.min(c).cast("double"), F.max(c).cast("double"), F.lit(float(r.threshold))
        if r.operator in ("<=", "<"):
            return high
        if r.operator in ("=", "=="):
            return F.when(F.abs(low - at) > F.abs(high - at), low).otherwise(high)
        if r.operator == "!=":
            return F.max(F.when(c.cast("double") == at, at)).cast("double")
        return low
    else:
        raise ValueError(f"unknown rule type {r.type}")
    return F.coalesce(v.cast("double"), F.lit(1.0))


def evaluate_rules(df: DataFrame, rules: list[Rule], target: str) -> DataFrame:
    """All rules of one frame in a single aggregate; one report row per rule."""
    m = df.agg(*[_rule_measure(r).alias(f"__r{i}") for i, r in enumerate(rules)])
    rows = []
    for i, r in enumerate(rules):
        v = F.col(f"__r{i}")
        rows.append(F.struct(
            F.lit(target).alias("target"), F.lit(r.id).alias("rule_id"), F.lit(r.type).alias("rule_type"),
            F.lit(r.selector).alias("selector"), v.alias("value"),
            F.lit(float(r.threshold)).alias("threshold"), F.lit(r.operator).alias("operator"),
            F.lit(r.severity).alias("severity"),
            # no non-NULL value (accuracy) violates nothing: vacuously passed
            F.coalesce(_OPS[r.operator](v, F.lit(float(r.threshold))), F.lit(r.type == "accuracy"))
            .alias("passed")))
    return _rows(m, rows)


class QualityError(RuntimeError):
    pass


def assert_quality(report: DataFrame) -> DataFrame:
    """Raise if any error-severity rule failed; warnings are only reported.

    All failing rows are named; a report has one row per rule.
    """
    bad = report.filter((F.col("severity") == "error") & ~F.col("passed")).select("target", "rule_id").collect()
    if bad:
        raise QualityError("quality rules failed: " + ", ".join(f"{b.target}.{b.rule_id}" for b in bad))
    return report


# ---- schema contract checks ---------------------------------------------------
# fixed values: contract logical type -> accepted Spark type families
_FAMILIES = {
    "STRING": (T.StringType,),
    "NUMBER": (T.DecimalType, T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "INTEGER": (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    "DATE": (T.DateType,),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
    "BOOLEAN": (T.BooleanType,),
}

SCHEMA_REPORT_SCHEMA = ("column_name string, expected_type string, actual_type string, required boolean, "
                        "null_count bigint, status string, passed boolean")


def schema_differences(schema: T.StructType, contract: list[tuple[str, str, bool]]) -> list[tuple[str, str]]:
    """(column, added | removed | retyped) of a schema against a contract, without a job."""
    actual = {f.name.lower(): f for f in schema.fields}
    expected = {n.lower(): (n, t.upper()) for n, t, _ in contract}
    out = [(n, "removed") for k, (n, _) in expected.items() if k not in actual]
    out += [(n, "retyped") for k, (n, t) in expected.items()
            if k in actual and not isinstance(actual[k].dataType, _FAMILIES.get(t, (T.StringType,)))]
    return out + [(f.name, "added") for k, f in actual.items() if k not in expected]


def check_schema(df: DataFrame, contract: list[tuple[str, str, bool]], strict: bool = True,
                 target: str | None = None) -> DataFrame:
    """Strict schema check against (name, logical type, required) entries.

    One row per contract or frame column: ``ok``, ``added`` (in the frame
    only), ``removed`` (in the contract only), ``retyped`` (type family
    differs) or ``required_null`` (required column holding NULLs; a failure
    when ``strict``, otherwise informational). Names compare
    case-insensitively. NULL counts of all required columns come from one
    aggregate over the frame.
    """
    actual = {f.name.lower(): f for f in df.schema.fields}
    expected = {n.lower(): (n, t.upper(), req) for n, t, req in contract}
    req_cols = [actual[k].name for k, (_, _, req) in expected.items() if req and k in actual]
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"__n_{c.lower()}") for c in req_cols])
    rows = []
    for k, (name, typ, req) in expected.items():
        if k not in actual:
            rows.append(F.struct(F.lit(name).alias("column_name"), F.lit(typ).alias("expected_type"),
                                 F.lit(None).cast("string").alias("actual_type"), F.lit(req).alias("required"),
                                 F.lit(None).cast("bigint").alias("null_count"), F.lit("removed").alias("status"),
                                 F.lit(False).alias("passed")))
            continue
        f = actual[k]
        fam_ok = isinstance(f.dataType, _FAMILIES.get(typ, (T.StringType,)))
        nulls = F.col(f"__n_{k}") if req else F.lit(None).cast("bigint")
        if not fam_ok:
            status, passed = F.lit("retyped"), F.lit(False)
        elif req:
            status = F.when(nulls > 0, "required_null").otherwise("ok")
            passed = (nulls == 0) | F.lit(not strict)
        else:
            status, passed = F.lit("ok"), F.lit(True)
        rows.append(F.struct(F.lit(name).alias("column_name"), F.lit(typ).alias("expected_type"),
                             F.lit(f.dataType.simpleString()).cast("string").alias("actual_type"),
                             F.lit(req).alias("required"), nulls.cast("bigint").alias("null_count"),
                             status.alias("status"), passed.alias("passed")))
    for k, f in actual.items():
        if k not in expected:
            rows.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(None).cast("string").alias("expected_type"),
                                 F.lit(f.dataType.simpleString()).cast("string").alias("actual_type"),
                                 F.lit(False).alias("required"), F.lit(None).cast("bigint").alias("null_count"),
                                 F.lit("added").alias("status"), F.lit(not strict).alias("passed")))
    out = _rows(counts, rows)
    return out if target is None else out.select(F.lit(target).alias("target"), "*")


def check_table_drift(spark, table_name: str, contract, strict: bool = True) -> DataFrame:
    """Drift of an existing catalog table against its contract (schema check on the table)."""
    return check_schema(spark.table(table_name), contract, strict)


# ---- reconciliation and freshness ---------------------------------------------
def row_counts(tables: dict[str, DataFrame], label: str = "rows") -> DataFrame:
    """(table_name, <label>) for every frame; one job, one aggregate per input."""
    return union_all([df.agg(F.count(F.lit(1)).alias(label)).select(F.lit(t).alias("table_name"), label)
                   for t, df in tables.items()])


def reconcile_counts(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Row counts of source vs target per table; ``matched`` false on any mismatch or absence."""
    s = row_counts(source, "source_rows")
    t = row_counts(target, "target_rows")
    return (s.join(t, "table_name", "full")
            .select("table_name", "source_rows", "target_rows",
                    F.coalesce(F.col("source_rows") == F.col("target_rows"), F.lit(False)).alias("matched")))


def freshness(tables: dict[str, DataFrame], fields: dict[str, str], as_of, slo_hours: float) -> DataFrame:
    """Per table: max(loaded_at_field), lag to ``as_of`` in hours, within SLO?

    A table whose field is all NULL has no measurable freshness and fails.
    """
    now = as_timestamp(as_of)
    frames = []
    require(tables, fields)
    for t, col in fields.items():
        m = tables[t].agg(F.max(F.col(col).cast("timestamp_ntz")).alias("latest"))
        lag = F.timestamp_diff("MICROSECOND", F.col("latest"), now) / F.lit(3.6e9)
        frames.append(m.select(F.lit(t).alias("table_name"), F.lit(col).alias("loaded_at_field"), "latest",
                               lag.alias("lag_hours"), F.lit(float(slo_hours)).alias("slo_hours"),
                               F.coalesce(lag <= F.lit(float(slo_hours)), F.lit(False)).alias("passed")))
    return union_all(frames)


class ReconciliationError(RuntimeError):
    pass


def assert_reconciled(report: DataFrame) -> DataFrame:
    """Raise when any table's counts disagree (report of ``reconcile_counts``)."""
    bad = report.filter(~F.col("matched")).collect()   # one row per table
    if bad:
        raise ReconciliationError("row counts differ: " + ", ".join(
            f"{b.table_name} ({b.source_rows} vs {b.target_rows})" for b in bad))
    return report


def verify_manifest(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare a declared manifest with the files found: (table, file, rows, sha256) both sides.

    Files are matched by table and base name. Returns one row per file with
    ``status`` in ok / missing / unexpected / rows_differ / hash_differs.
    """
    def keyed(df, tag):
        return df.select(F.col("table_name").alias("table_name"),
                         F.element_at(F.split("file", "/"), -1).alias("file_name"),
                         F.col("rows").cast("bigint").alias(f"{tag}_rows"), F.col("sha256").alias(f"{tag}_sha256"))
    j = keyed(declared, "declared").join(keyed(actual, "actual"), ["table_name", "file_name"], "full")
    status = (F.when(F.col("actual_rows").isNull(), "missing")
              .when(F.col("declared_rows").isNull(), "unexpected")
              .when(F.col("declared_rows") != F.col("actual_rows"), "rows_differ")
              .when(F.col("declared_sha256") != F.col("actual_sha256"), "hash_differs")
              .otherwise("ok"))
    return j.withColumn("status", status).withColumn("passed", F.col("status") == "ok")
