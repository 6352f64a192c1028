"""Telco landing tables derived from the TPC-H-like star tables.

The test data holds customer / orders / lineitem / part / events, not telco
tables. This module maps them onto the landing schemas so every product in
the package runs over those tables and grows with them:

=====================  =======================================================
telco table            derived from
=====================  =======================================================
party, account         customer (one party and one account per customer)
product_offering       part
service                orders (one service per order)
subscription           lineitem grouped by order (one per order with lines)
usage_event            events purchase / signup
customer_interaction   events click / view
trouble_ticket         events error
service_lifecycle_ev.  events, every type
invoice                orders (one invoice per order)
invoice_charge         lineitem (one charge per line)
individual, device,    customer (one of each per customer)
sim_card
app_event              events, every type
payment, agreement,    orders (one of each per order)
service_order
=====================  =======================================================

Events reach a service through the account's lowest order key. Categorical
attributes that the star tables lack (ticket severity and status, NULL
service on interactions) are derived from ``event_id`` arithmetic; that picks
a value per row and never drops a row. All ids are strings, money is
decimal, timestamps are TIMESTAMP_NTZ, exactly as the landing schemas say.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.schemas import SCHEMAS

# --- fixed values: the clocks of the star data ------------------------------
EVENT_AS_OF = dt.datetime(2024, 1, 31)     # events span 2024-01-01 .. 2024-01-30
BILLING_AS_OF = dt.datetime(1998, 6, 1)    # line items span 1995 .. 2001

# --- fixed values: code mappings of the star adapter ------------------------
ORDER_STATUS_TO_SERVICE = {"O": "active", "P": "suspended", "F": "terminated"}
LINESTATUS_TO_SUBSCRIPTION = {"O": "active", "F": "cancelled"}
RETURNFLAG_TO_CHARGE = {"N": "recurring_charge", "R": "usage_charge", "A": "equipment_fee"}
EVENT_TO_USAGE = {"purchase": "data_mb", "signup": "voice_min"}
EVENT_TO_LIFECYCLE = {"signup": "activation", "purchase": "upgrade", "error": "suspension",
                      "view": "activation", "click": "activation"}
SEVERITY_BY_MOD4 = ("low", "medium", "high", "critical")     # event_id % 4
TICKET_STATUS_BY_MOD5 = ("resolved", "resolved", "resolved", "in_progress", "open")  # event_id % 5


def _case(col: str, mapping: dict) -> str:
    """SQL ``CASE col WHEN k THEN v ... END`` from a fixed mapping."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _pick(index_sql: str, values: tuple) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index_sql} {whens} END"


def _conform(df: DataFrame, table: str, exprs: dict[str, str]) -> DataFrame:
    """One projection: every landing column, in declared order, cast to its declared type.

    ``exprs`` maps column -> SQL expression over ``df``; absent columns are
    typed NULLs. A single ``selectExpr`` keeps plan construction cheap.
    """
    cols = []
    for f in SCHEMAS[table].fields:
        e = exprs.get(f.name, "NULL")
        cols.append(f"CAST({e} AS {f.dataType.simpleString()}) AS {f.name}")
    return df.selectExpr(*cols)


class LazyTables(Mapping):
    """Read-only mapping of table name -> DataFrame, each derived on first access.

    A job that needs three tables does not pay for deriving (and analysing)
    the other eight.
    """

    def __init__(self, names, build):
        self._names = tuple(names)
        self._build = build
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = self._build(name)
        return self._cache[name]

    def __contains__(self, name) -> bool:   # membership must not build the table
        return name in self._names

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class StarSource:
    """Lazily derived telco landing tables over one star-schema folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One scan definition per star table (file listing and footer read happen once)."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    # ---- entities -------------------------------------------------------
    _ACCOUNT_STATUS = "CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END"

    def party(self) -> DataFrame:
        return _conform(self.raw("customer"), "party", {
            "party_id": "CAST(c_custkey AS STRING)", "party_type": "'individual'", "status": self._ACCOUNT_STATUS})

    def account(self) -> DataFrame:
        return _conform(self.raw("customer"), "account", {
            "account_id": "CAST(c_custkey AS STRING)", "party_id": "CAST(c_custkey AS STRING)",
            "account_number": "c_name", "account_type": "c_mktsegment", "status": self._ACCOUNT_STATUS})

    def product_offering(self) -> DataFrame:
        return _conform(self.raw("part"), "product_offering", {
            "product_offering_id": "CAST(p_partkey AS STRING)", "name": "p_name", "category": "p_type",
            "data_limit_gb": "p_size", "voice_limit_min": "p_size * 100", "price_chf": "p_retailprice",
            "status": "'active'"})

    def service(self) -> DataFrame:
        return _conform(self.raw("orders"), "service", {
            "service_id": "CAST(o_orderkey AS STRING)", "account_id": "CAST(o_custkey AS STRING)",
            "service_type": "o_orderpriority", "status": _case("o_orderstatus", ORDER_STATUS_TO_SERVICE),
            "activated_at": "o_orderdate"})

    def subscription(self) -> DataFrame:
        """One subscription per order with lines; (orderkey, linenumber) is not unique."""
        g = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("l_partkey"), F.max("l_linestatus").alias("l_linestatus"),
            F.min("l_shipdate").alias("first_ship"))
        return _conform(g, "subscription", {
            "subscription_id": "'S' || CAST(l_orderkey AS STRING)", "service_id": "CAST(l_orderkey AS STRING)",
            "product_offering_id": "CAST(l_partkey AS STRING)",
            "status": _case("l_linestatus", LINESTATUS_TO_SUBSCRIPTION),
            "start_date": "to_date(first_ship)", "created_at": "first_ship"})

    # ---- events ---------------------------------------------------------
    def _account_service(self) -> DataFrame:
        """The service an account's events are booked to: its lowest order key."""
        return (self.raw("orders").groupBy("o_custkey")
                .agg(F.min("o_orderkey").alias("svc_key")))

    def _events(self, types: list[str] | None) -> DataFrame:
        e = self.raw("events").select("event_id", "ts", "user_id", "event_type", "value")
        if types is not None:
            e = e.filter(F.col("event_type").isin(types))
        a = self._account_service()
        return e.join(a, e.user_id == a.o_custkey, "left")

    def usage_event(self) -> DataFrame:
        return _conform(self._events(list(EVENT_TO_USAGE)), "usage_event", {
            "usage_id": "CAST(event_id AS STRING)", "account_id": "CAST(user_id AS STRING)",
            "service_id": "CAST(svc_key AS STRING)", "usage_type": _case("event_type", EVENT_TO_USAGE),
            "quantity": "value", "event_timestamp": "ts", "rating_status": "'rated'"})

    def customer_interaction(self) -> DataFrame:
        return _conform(self._events(["click", "view"]), "customer_interaction", {
            "interaction_id": "CAST(event_id AS STRING)", "account_id": "CAST(user_id AS STRING)",
            "service_id": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(svc_key AS STRING) END",
            "channel": "CASE WHEN event_type = 'click' THEN 'app' ELSE 'web' END",
            "interaction_type": "event_type", "outcome": "'completed'", "interaction_timestamp": "ts"})

    def trouble_ticket(self) -> DataFrame:
        return _conform(self._events(["error"]), "trouble_ticket", {
            "ticket_id": "CAST(event_id AS STRING)", "account_id": "CAST(user_id AS STRING)",
            "service_id": "CAST(svc_key AS STRING)", "ticket_category": "'technical'",
            "severity": _pick("event_id % 4", SEVERITY_BY_MOD4),
            "status": _pick("event_id % 5", TICKET_STATUS_BY_MOD5), "opened_at": "ts"})

    def service_lifecycle_event(self) -> DataFrame:
        return _conform(self._events(None), "service_lifecycle_event", {
            "lifecycle_event_id": "CAST(event_id AS STRING)", "service_id": "CAST(svc_key AS STRING)",
            "event_type": _case("event_type", EVENT_TO_LIFECYCLE), "event_reason": "event_type",
            "actor_type": "'customer'", "event_timestamp": "ts"})

    # ---- billing --------------------------------------------------------
    def invoice(self) -> DataFrame:
        return _conform(self.raw("orders"), "invoice", {
            "invoice_id": "CAST(o_orderkey AS STRING)", "account_id": "CAST(o_custkey AS STRING)",
            "invoice_number": "'INV-' || CAST(o_orderkey AS STRING)", "invoice_date": "to_date(o_orderdate)",
            "due_date": "date_add(to_date(o_orderdate), 30)", "total_amount_chf": "o_totalprice",
            "status": "CASE WHEN o_orderstatus = 'P' THEN 'overdue' ELSE 'paid' END", "created_at": "o_orderdate"})

    def invoice_charge(self) -> DataFrame:
        return _conform(self.raw("lineitem"), "invoice_charge", {
            "charge_id": "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING))",
            "invoice_id": "CAST(l_orderkey AS STRING)", "charge_type": _case("l_returnflag", RETURNFLAG_TO_CHARGE),
            "charge_description": "'line ' || CAST(l_linenumber AS STRING)", "quantity": "l_quantity",
            "amount_chf": "l_quantity", "charge_date": "to_date(l_shipdate)"})

    # ---- people, devices, further documents -----------------------------
    def individual(self) -> DataFrame:
        return _conform(self.raw("customer"), "individual", {
            "individual_id": "'I' || CAST(c_custkey AS STRING)", "party_id": "CAST(c_custkey AS STRING)",
            "first_name": "'Customer'", "last_name": "CAST(c_custkey AS STRING)",
            "email": "'customer' || CAST(c_custkey AS STRING) || '@example.com'"})

    def device(self) -> DataFrame:
        return _conform(self.raw("customer"), "device", {
            "device_id": "'D' || CAST(c_custkey AS STRING)", "account_id": "CAST(c_custkey AS STRING)",
            "device_type": "'phone'", "model": "c_mktsegment", "imei": "lpad(CAST(c_custkey AS STRING), 15, '0')",
            "status": self._ACCOUNT_STATUS})

    def sim_card(self) -> DataFrame:
        return _conform(self.raw("customer"), "sim_card", {
            "sim_id": "'M' || CAST(c_custkey AS STRING)", "account_id": "CAST(c_custkey AS STRING)",
            "device_id": "'D' || CAST(c_custkey AS STRING)",
            "msisdn": "'+41' || lpad(CAST(c_custkey AS STRING), 9, '0')",
            "iccid": "'89' || lpad(CAST(c_custkey AS STRING), 17, '0')", "status": self._ACCOUNT_STATUS})

    def app_event(self) -> DataFrame:
        return _conform(self.raw("events"), "app_event", {
            "app_event_id": "CAST(event_id AS STRING)", "account_id": "CAST(user_id AS STRING)",
            "device_id": "'D' || CAST(user_id AS STRING)", "event_type": "event_type", "session_minutes": "value",
            "event_timestamp": "ts"})

    def payment(self) -> DataFrame:
        return _conform(self.raw("orders"), "payment", {
            "payment_id": "'P' || CAST(o_orderkey AS STRING)", "invoice_id": "CAST(o_orderkey AS STRING)",
            "amount_chf": "o_totalprice", "payment_method": "o_orderpriority",
            "payment_date": "date_add(to_date(o_orderdate), 20)",
            "status": "CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'settled' END", "created_at": "o_orderdate"})

    def agreement(self) -> DataFrame:
        return _conform(self.raw("orders"), "agreement", {
            "agreement_id": "'A' || CAST(o_orderkey AS STRING)", "account_id": "CAST(o_custkey AS STRING)",
            "agreement_type": "o_orderpriority", "status": _case("o_orderstatus", ORDER_STATUS_TO_SERVICE),
            "signed_date": "to_date(o_orderdate)", "effective_date": "date_add(to_date(o_orderdate), 1)",
            "created_at": "o_orderdate"})

    def service_order(self) -> DataFrame:
        return _conform(self.raw("orders"), "service_order", {
            "order_id": "CAST(o_orderkey AS STRING)", "account_id": "CAST(o_custkey AS STRING)",
            "order_type": "o_orderpriority", "status": _case("o_orderstatus", ORDER_STATUS_TO_SERVICE),
            "order_date": "o_orderdate"})

    TABLES = ("party", "account", "product_offering", "service", "subscription", "usage_event",
              "customer_interaction", "trouble_ticket", "service_lifecycle_event", "invoice", "invoice_charge",
              "individual", "device", "sim_card", "app_event", "payment", "agreement", "service_order")

    def table(self, name: str) -> DataFrame:
        if name not in self.TABLES:
            raise KeyError(f"no star counterpart for landing table {name!r}")
        return getattr(self, name)()

    def tables(self) -> LazyTables:
        if not hasattr(self, "_tables"):
            self._tables = LazyTables(self.TABLES, self.table)
        return self._tables

