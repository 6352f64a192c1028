"""Command line: ``python -m telvault {build,test,metrics} --sf-dir DIR [...]``.

* ``build``  : silver (two window settings) + gold customer 360 + support posture,
               published to ``--schema`` with rules and freshness reports.
* ``test``   : dbt-style column and relationship tests over the landing tables,
               mart tests and contract rules; exit code 1 on a failing test or error-severity rule.
* ``metrics``: data metrics (row count, NULL / duplicate keys) per landing table.

Inputs are the star tables of ``--sf-dir`` mapped onto the landing tables
(``telvault.sources.star``); clocks default to the star data's clocks.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F


def _show(title: str, df) -> list:
    """Print and return a report: its rows are bounded by the number of rules, tests or tables."""
    rows = df.collect()
    print(f"== {title} ({len(rows)})")
    for r in rows:
        print("  ", ", ".join(f"{k}={v}" for k, v in r.asDict().items()))
    return rows


def main(argv: list[str] | None = None) -> int:
    from telvault.operators import metrics, quality
    from telvault.plans import contracts, product
    from telvault.plans.silver import Windows, build_silver
    from telvault.schemas import COLUMN_TESTS, RELATIONSHIPS, RISK_BANDS
    from telvault.session import get_spark
    from telvault.sources.star import BILLING_AS_OF, EVENT_AS_OF, StarSource

    ap = argparse.ArgumentParser(prog="telvault")
    ap.add_argument("command", choices=["build", "test", "metrics"])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--schema", default="telvault")
    ap.add_argument("--as-of", default=EVENT_AS_OF.isoformat())
    ap.add_argument("--billing-as-of", default=BILLING_AS_OF.isoformat())
    ap.add_argument("--mode", default="replace-and-build",
                    choices=["dry-run", "create-only", "amend", "amend-and-build", "replace", "replace-and-build"])
    ap.add_argument("--allow-data-loss", action="store_true", help="consent to replacing tables that exist")
    ap.add_argument("--master", default=None)
    ap.add_argument("--warehouse", default=None, help="spark.sql.warehouse.dir for the published tables")
    a = ap.parse_args(argv)
    as_of, billing = dt.datetime.fromisoformat(a.as_of), dt.datetime.fromisoformat(a.billing_as_of)

    spark = get_spark(a.master, extra={"spark.sql.warehouse.dir": a.warehouse} if a.warehouse else None)
    tables = StarSource(spark, a.sf_dir).tables()
    if a.command == "metrics":
        _show("data metrics", metrics.data_metrics(tables))
        return 0
    if a.command == "test":
        tests = quality.union_all([quality.run_column_tests(tables, COLUMN_TESTS),
                                   quality.run_relationship_tests(tables, RELATIONSHIPS)])
        failed = _show("failing data tests", tests.filter(~F.col("passed")))
        s = build_silver(tables, as_of, billing, materialize=True)
        core, sc = s.subscriber360_core, s.health_scorecard
        accepted = _show("mart accepted values", quality.union_all([
            quality.test_accepted_values(core, "support_risk_band", RISK_BANDS, "subscriber360_core"),
            quality.test_accepted_values(sc, "support_risk_band", RISK_BANDS, "health_scorecard")]))
        rules = quality.union_all([quality.evaluate_rules(core, contracts.CORE_RULES, "subscriber360_core"),
                                   quality.evaluate_rules(sc, contracts.SCORECARD_RULES, "health_scorecard")])
        _show("contract rules", rules)
        try:
            quality.assert_quality(rules)
        except quality.QualityError as e:
            print(e)
            return 1
        return int(bool(failed) or any(not r.passed for r in accepted))
    # build
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {a.schema}")
    b1 = build_silver(tables, as_of, billing, materialize=True)
    b2 = build_silver(tables, as_of, billing, Windows(interactions=3, tickets=10), materialize=True)
    silver = product.run_silver_product(b1, a.schema, a.mode, allow_data_loss=a.allow_data_loss)
    gold = product.run_gold_product([b1, b2], a.schema, a.mode, allow_data_loss=a.allow_data_loss)
    posture = product.run_posture_product(tables, as_of, a.schema, a.mode, allow_data_loss=a.allow_data_loss)
    for name, out in (("core", silver["core"]), ("scorecard", silver["scorecard"]), ("customer_360", gold),
                      ("posture", posture)):
        if out.get("rules") is not None:
            _show(f"{name} rules", out["rules"])
        if out.get("freshness") is not None:
            _show(f"{name} freshness", out["freshness"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
