"""Product runs: build -> strict schema gate -> publish -> quality and freshness report.

The contract lifecycle of a data product, as Spark jobs: nothing is
written when the built frame drifts from the contract schema; after the
write, the contract's rules and freshness objective are measured on the
published table (read back, so the report describes what consumers see).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from telvault.operators import quality
from telvault.plans import contracts
from telvault.plans.silver import Silver, support_posture
from telvault.sinks.publish import publish, target_name


@dataclass(frozen=True)
class Expose:
    """One published table of a product: name, contract schema, rules, freshness objective."""
    alias: str
    schema: list
    rules: list
    freshness_hours: float | None          # None: the contract states no freshness objective
    time_column: str = "snapshot_at"


# --- fixed values: published table names of the products ----------------------
CORE_EXPOSE = Expose("SUBSCRIBER360_CORE_V1", contracts.CORE_SCHEMA, contracts.CORE_RULES,
                     contracts.SILVER_FRESHNESS_HOURS)
SCORECARD_EXPOSE = Expose("SUBSCRIBER_HEALTH_SCORECARD_V1", contracts.SCORECARD_SCHEMA, contracts.SCORECARD_RULES,
                          contracts.SILVER_FRESHNESS_HOURS)
POSTURE_EXPOSE = Expose("TELCO_SUBSCRIBER_SUPPORT_POSTURE", contracts.POSTURE_SCHEMA, [], None)


class ContractViolation(RuntimeError):
    pass


def gate_schema(df: DataFrame, expose: Expose) -> None:
    """Refuse to publish on added / removed / retyped columns (strict policy).

    NULLs in required columns are reported by the rules, not here: the
    model's left joins allow them (the contract documents the mismatch).
    """
    bad = quality.schema_differences(df.schema, expose.schema)
    if bad:
        raise ContractViolation(f"{expose.alias}: " + ", ".join(f"{c}:{status}" for c, status in bad))


def publish_expose(df: DataFrame, expose: Expose, schema: str, as_of, mode: str = "amend-and-build",
                   allow_data_loss: bool = False, bucket_by: tuple[int, str] | None = None) -> dict[str, DataFrame]:
    """Gate, publish and measure one expose; returns its reports."""
    gate_schema(df, expose)
    name = target_name(expose.alias.lower(), schema)
    diff = publish(df, name, mode, allow_data_loss, bucket_by=bucket_by)
    table = df.sparkSession.table(name)
    rules = (quality.evaluate_rules(table, expose.rules, expose.alias) if expose.rules else None)
    fresh = (quality.freshness({expose.alias: table}, {expose.alias: expose.time_column}, as_of,
                               expose.freshness_hours) if expose.freshness_hours is not None else None)
    return {"table": table, "schema_diff": diff, "rules": rules, "freshness": fresh}


def run_silver_product(silver: Silver, schema: str, mode: str = "amend-and-build", allow_data_loss: bool = False,
                       buckets: int | None = None) -> dict[str, dict[str, DataFrame]]:
    """Publish the core and scorecard exposes of one silver build.

    The support-health satellite feeds both: it is checkpointed once
    (shared checkpoint folder) before either table is written. With
    ``buckets`` the tables are bucketed by service for co-located joins.
    """
    silver = silver.materialized()
    bucket = (buckets, "service_id") if buckets else None
    return {
        "core": publish_expose(silver.subscriber360_core, CORE_EXPOSE, schema, silver.as_of, mode,
                               allow_data_loss, bucket),
        "scorecard": publish_expose(silver.health_scorecard, SCORECARD_EXPOSE, schema, silver.as_of, mode,
                                    allow_data_loss, bucket),
    }


def run_posture_product(inputs: dict[str, DataFrame], as_of, schema: str, mode: str = "replace-and-build",
                        allow_data_loss: bool = False) -> dict[str, DataFrame]:
    """Create or replace the support-posture table; replacing one needs ``allow_data_loss=True``."""
    return publish_expose(support_posture(inputs, as_of), POSTURE_EXPOSE, schema, as_of, mode, allow_data_loss)


CUSTOMER_360_EXPOSE = Expose("CUSTOMER_360_CDP_V1", contracts.CUSTOMER_360_SCHEMA, contracts.CUSTOMER_360_RULES,
                             contracts.GOLD_FRESHNESS_HOURS)


def run_gold_product(products: list[Silver], schema: str, mode: str = "replace-and-build",
                     allow_data_loss: bool = False, pii_columns=("account_number",)) -> dict[str, DataFrame]:
    """Compose silver products into the gold customer 360 and publish it.

    PII tags travel with the column (field metadata, persisted by the
    catalog), so consumers can mask by tag.
    """
    from telvault.operators.catalog import tag_columns
    from telvault.plans.silver import customer_360

    mats = [p.materialized() for p in products]
    gold = tag_columns(customer_360(mats), {c: "pii" for c in pii_columns})
    return publish_expose(gold, CUSTOMER_360_EXPOSE, schema, mats[0].as_of, mode, allow_data_loss)
