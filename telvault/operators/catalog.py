"""Column catalog, value-pattern classification, tag propagation and masking.

The catalog is one row per column: name-based governance tags (semantic
type, sensitivity, identifier role, table grain) joined with measured
column statistics (NULL and non-NULL counts from one aggregate per table).
Classification measures, per string column, the share of values that
match each value pattern -- one aggregate pass per table, JVM regexes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telvault.schemas import primary_key

# --- fixed values: record grain of tables ------------------------------------
EVENT_TABLES = ("usage_event", "app_event", "customer_interaction", "service_lifecycle_event")
DOCUMENT_TABLES = ("invoice", "invoice_charge", "payment", "agreement", "service_order", "trouble_ticket")
ASSIGNMENT_TABLES = ("contact_medium", "party_role", "subscription", "product_inventory", "resource", "sim_card")

# --- fixed values: semantic type by exact column name (first match wins;
# anything else is category_code) ---------------------------------------------
SEMANTIC_TYPES: list[tuple[tuple[str, ...], str]] = [
    (("address_id",), "address_identifier"),
    (("street_name", "city", "region_code", "postal_code", "country_code"), "address_attribute"),
    (("contact_medium_id",), "contact_identifier"),
    (("medium_value",), "contact_value"),
    (("party_role_id",), "role_identifier"),
    (("role_type",), "role_type"),
    (("product_offering_id", "product_id"), "product_identifier"),
    (("resource_id",), "resource_identifier"),
    (("resource_type", "resource_name"), "resource_attribute"),
    (("ticket_id",), "ticket_identifier"),
    (("charge_id",), "charge_identifier"),
    (("charge_description",), "narrative_text"),
    (("severity",), "priority_code"),
    (("party_id", "individual_id"), "party_identifier"),
    (("account_id",), "account_identifier"),
    (("account_number",), "account_number"),
    (("date_of_birth",), "birth_date"),
    (("agreement_id",), "contract_identifier"),
    (("created_at", "assigned_at", "activated_at", "registered_at"), "created_timestamp"),
    (("invoice_date", "due_date", "payment_date", "signed_date", "effective_date", "termination_date",
      "start_date", "end_date", "renewal_date", "valid_from", "valid_to", "charge_date"), "date_value"),
    (("price_chf", "total_amount_chf", "amount_chf"), "currency_amount"),
    (("device_id",), "device_identifier"),
    (("email",), "email_handle"),
    (("usage_id", "app_event_id", "interaction_id", "lifecycle_event_id"), "event_identifier"),
    (("updated_at", "terminated_at", "event_timestamp", "interaction_timestamp", "opened_at", "resolved_at",
      "order_date", "fulfillment_date"), "event_timestamp"),
    (("invoice_id",), "invoice_identifier"),
    (("order_id",), "order_identifier"),
    (("payment_id",), "payment_identifier"),
    (("first_name", "last_name"), "person_name"),
    (("msisdn",), "phone_number"),
    (("name", "model", "manufacturer", "event_reason"), "product_attribute"),
    (("service_id",), "service_identifier"),
    (("sim_id",), "sim_identifier"),
    (("status", "rating_status", "resource_status"), "status_code"),
    (("quantity", "session_minutes", "data_limit_gb", "voice_limit_min", "preference_rank"), "usage_measure"),
]
DEFAULT_SEMANTIC_TYPE = "category_code"

# --- fixed values: sensitivity and identifier-role name lists -------------------
RESTRICTED_CONTACT = ("first_name", "last_name", "email", "date_of_birth", "medium_value", "street_name", "city",
                      "region_code", "postal_code", "country_code", "msisdn")
RESTRICTED_IDENTIFIER = ("account_number", "imei", "iccid", "invoice_number")  # plus every *_id column
PUBLIC_SYNTHETIC = ("name", "category", "data_limit_gb", "voice_limit_min", "price_chf")
NATURAL_KEYS = ("account_number", "email", "msisdn", "iccid", "imei", "invoice_number")

# --- fixed values: value patterns for classification (priority order) ----------
VALUE_PATTERNS: list[tuple[str, str]] = [
    ("email", r"^[^@\s]+@[^@\s]+\.[^@\s]+$"),
    ("uuid", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"),
    ("imei", r"^[0-9]{15}$"),
    ("iccid", r"^89[0-9]{17,18}$"),
    ("phone", r"^(\+|0)[0-9]{8,15}$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("number", r"^-?[0-9]+(\.[0-9]+)?$"),
]
CLASSIFY_MIN_CONFIDENCE = 0.8


def _pattern_guard(value_class: str, v: Column) -> Column | None:
    """A cheap necessary condition of a value pattern (exact: never drops a match).

    Evaluated before the regex with short-circuit AND, so most values skip
    the regex engine entirely.
    """
    n = F.length(v)
    return {
        "email": v.contains("@"),
        "uuid": n == 36,
        "imei": n == 15,
        "iccid": (n >= 19) & (n <= 20) & v.startswith("89"),
        "phone": (n >= 9) & (n <= 16) & (v.startswith("+") | v.startswith("0")),
        "date": n == 10,
    }.get(value_class)


def _matches(value_class: str, pattern: str, v: Column) -> Column:
    guard = _pattern_guard(value_class, v)
    return v.rlike(pattern) if guard is None else (guard & v.rlike(pattern))


def _first_match(name: Column, table: list[tuple[tuple[str, ...], str]], default: str) -> Column:
    expr = F.lit(default)
    for names, value in reversed(table):
        expr = F.when(name.isin(list(names)), F.lit(value)).otherwise(expr)
    return expr


def semantic_type(name: Column) -> Column:
    return _first_match(name, SEMANTIC_TYPES, DEFAULT_SEMANTIC_TYPE)


def sensitivity(name: Column) -> Column:
    return (F.when(name.isin(list(RESTRICTED_CONTACT)), "restricted_contact")
            .when(name.endswith("_id") | name.isin(list(RESTRICTED_IDENTIFIER)), "restricted_identifier")
            .when(name.isin(list(PUBLIC_SYNTHETIC)), "public_synthetic")
            .otherwise("internal_operational"))


def identifier_role(name: Column, pk: Column) -> Column:
    return (F.when(name == pk, "primary_key")
            .when(name.isin(list(NATURAL_KEYS)), "natural_key")
            .when(name.endswith("_id"), "foreign_key")
            .otherwise("descriptive"))


def record_grain(table: Column) -> Column:
    return (F.when(table.isin(list(EVENT_TABLES)), "event_level")
            .when(table.isin(list(DOCUMENT_TABLES)), "document_level")
            .when(table.isin(list(ASSIGNMENT_TABLES)), "assignment_level")
            .otherwise("entity_level"))


def _column_stats(df: DataFrame, table: str) -> DataFrame:
    """Per column: (table_name, column_name, ordinal, data_type, null_count, non_null_count) and the table's row
    count, from one plain aggregate."""
    cols = df.columns
    m = df.agg(F.count(F.lit(1)).alias("__rows"),
               *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    meta = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                              F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                              F.col(f"__n{i}").alias("null_count")) for i, c in enumerate(cols)])
    return (m.select("__rows", F.inline(meta))
            .select(F.lit(table).alias("table_name"), "column_name", "ordinal", "data_type",
                    F.col("null_count").cast("bigint").alias("null_count"),
                    (F.col("__rows") - F.col("null_count")).cast("bigint").alias("non_null_count"),
                    F.lit(primary_key(table, cols)).alias("__pk"), F.col("__rows").cast("bigint").alias("table_rows")))


def _key_stats(df: DataFrame, table: str) -> DataFrame:
    """(table_name, pk_null_count, pk_duplicate_count) from a grouping of the key alone: in one aggregate with the
    NULL counters, a distinct count would carry every counter through the key's shuffle."""
    per_key = df.groupBy(F.col(primary_key(table, df.columns)).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    rows = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("bigint")
    return per_key.agg(rows(F.col("__k").isNull(), F.col("__n")).alias("pk_null_count"),
                       rows(F.col("__k").isNotNull(), F.col("__n") - 1).alias("pk_duplicate_count")
                       ).select(F.lit(table).alias("table_name"), "pk_null_count", "pk_duplicate_count")


def column_catalog(tables: dict[str, DataFrame], overrides: dict[tuple[str, str], dict] | None = None,
                   with_table_metrics: bool = False) -> DataFrame:
    """One row per column with governance tags and measured NULL counts.

    ``overrides`` maps (table, column) to hand-written tags, which win over
    the name rules. ``with_table_metrics`` adds the table's ROW_COUNT and key
    NULL / DUPLICATE counts.
    """
    stats = reduce(lambda a, b: a.unionByName(b), [_column_stats(df, t) for t, df in tables.items()])
    if with_table_metrics:
        stats = stats.join(reduce(lambda a, b: a.unionByName(b), [_key_stats(df, t) for t, df in tables.items()]), "table_name")
    name, table = F.col("column_name"), F.col("table_name")
    extra = ["table_rows", "pk_null_count", "pk_duplicate_count"] if with_table_metrics else []
    out = stats.select(
        "table_name", "column_name", "ordinal", "data_type",
        semantic_type(name).alias("semantic_type"), sensitivity(name).alias("sensitivity"),
        identifier_role(name, F.col("__pk")).alias("identifier_role"), record_grain(table).alias("record_grain"),
        "null_count", "non_null_count", *extra)
    for (t, c), tags in (overrides or {}).items():
        hit = (table == t) & (name == c)
        for k, v in tags.items():
            out = out.withColumn(k, F.when(hit, F.lit(v)).otherwise(F.col(k)))
    return out


def classify_columns(tables: dict[str, DataFrame], min_confidence: float = CLASSIFY_MIN_CONFIDENCE) -> DataFrame:
    """Per string column: best-matching value class and its share of non-NULL values.

    Every row is measured. A table's string cells are numbered by column and
    counted by that number: a wide aggregate of every column and pattern
    would outgrow generated code. Partial aggregation leaves one row per
    column and input partition to shuffle. Below ``min_confidence`` the class
    is ``unclassified``.
    """
    reports = []
    for t, df in tables.items():
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if not cols:
            continue
        v = F.col("v")
        counted = (df.select(F.posexplode(F.array(*cols)).alias("i", "v")).groupBy("i")
                   .agg(F.count(v).alias("non_null"),
                        *[F.count_if(_matches(k, pat, v)).alias(f"__m{j}") for j, (k, pat) in enumerate(VALUE_PATTERNS)]))
        names = F.array(*[F.lit(c) for c in cols])
        reports.append(counted.select(F.lit(t).alias("table_name"), F.element_at(names, F.col("i") + 1).alias("column_name"),
                                      "non_null", *[f"__m{j}" for j in range(len(VALUE_PATTERNS))]))
    counts = reduce(lambda a, b: a.unionByName(b), reports)
    nn = F.col("non_null")
    scored = F.array(*[F.struct(F.when(nn > 0, F.col(f"__m{j}") / nn).otherwise(F.lit(0.0)).alias("ratio"),
                                F.lit(-j).alias("neg_priority"), F.lit(k).alias("value_class"))
                       for j, (k, _) in enumerate(VALUE_PATTERNS)])
    best = F.array_max(scored)   # highest ratio, then earliest pattern
    conf = best["ratio"]
    return counts.select("table_name", "column_name",
                         F.when(conf >= min_confidence, best["value_class"]).otherwise("unclassified")
                         .alias("value_class"),
                         F.round(conf, 6).alias("confidence"), nn.cast("bigint").alias("non_null_values"))


# ---- tag propagation and masking ------------------------------------------------
TAG_KEY = "sensitivity"


def tag_columns(df: DataFrame, tags: dict[str, str], key: str = TAG_KEY) -> DataFrame:
    """Attach a tag to columns as StructField metadata (kept by the catalog and by parquet)."""
    return df.select([F.col(c).alias(c, metadata={**df.schema[c].metadata, key: tags[c]}) if c in tags
                      else F.col(c) for c in df.columns])


def propagate_tags(upstream: DataFrame, downstream: DataFrame, key: str = TAG_KEY) -> DataFrame:
    """Copy tags from upstream columns to downstream columns of the same name."""
    tags = {f.name.lower(): f.metadata[key] for f in upstream.schema.fields if key in f.metadata}
    return tag_columns(downstream, {c: tags[c.lower()] for c in downstream.columns if c.lower() in tags}, key)


def mask(df: DataFrame, values=("pii",), key: str = TAG_KEY) -> DataFrame:
    """Replace tagged columns by their SHA-256 hex digest (NULL stays NULL)."""
    hit = {f.name for f in df.schema.fields if f.metadata.get(key) in values}
    return df.select([F.sha2(F.col(c).cast("string"), 256).alias(c, metadata=df.schema[c].metadata) if c in hit
                      else F.col(c) for c in df.columns])


def auto_tag(df: DataFrame, classification: DataFrame, table: str, key: str = "value_class") -> DataFrame:
    """Tag a frame's columns with their detected value class (classification auto-tag).

    ``classification`` is the output of :func:`classify_columns`; only its
    rows for ``table`` are read -- one small row per column, bounded by the
    schema width, never by the data.
    """
    rows = (classification.filter((F.col("table_name") == table) & (F.col("value_class") != "unclassified"))
            .select("column_name", "value_class").collect())
    return tag_columns(df, {r.column_name: r.value_class for r in rows if r.column_name in df.columns}, key)


def column_profile(tables: dict[str, DataFrame], overrides: dict[tuple[str, str], dict] | None = None) -> DataFrame:
    """Column catalogue joined with the table metrics and the value classification.

    One row per column: governance tags and NULL counts (catalogue), the
    table's ROW_COUNT / NULL_COUNT(pk) / DUPLICATE_COUNT(pk) from the same
    pass, and for string columns the detected value class (a join of two
    report-sized frames on (table, column)).
    """
    cat = column_catalog(tables, overrides, with_table_metrics=True)
    cls = classify_columns(tables).select("table_name", "column_name", "value_class", "confidence")
    return cat.join(cls, ["table_name", "column_name"], "left")
