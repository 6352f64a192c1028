"""Silver build: landing tables -> DV staging -> vault -> marts.

Python function calls order the models (no template engine, no DAG
runner). Everything stays lazy except the support-health satellite when
``materialize=True``: it feeds both marts, so it is checkpointed once into
the shared checkpoint folder (the "table" materialization).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from telvault.operators import features, marts, vault
from telvault.operators.staging import dv_stage
from telvault.session import materialize as _materialize

REQUIRED_INPUTS = ("account", "service", "subscription", "product_offering", "usage_event",
                   "customer_interaction", "trouble_ticket", "invoice", "invoice_charge")


@dataclass(frozen=True)
class Windows:
    """Trailing-window lengths in days (the reference uses 30 everywhere)."""
    usage: int = 30
    interactions: int = 30
    tickets: int = 30
    charges: int = 30


def require_ports(inputs: dict[str, DataFrame], ports) -> None:
    """Input ports: every declared port must be bound to a DataFrame."""
    missing = [p for p in ports if p not in inputs]
    if missing:
        raise KeyError(f"unbound input ports: {missing}")


class Silver:
    """Lazily built silver products over one set of landing tables."""

    def __init__(self, inputs: dict[str, DataFrame], as_of, billing_as_of=None,
                 windows: Windows = Windows(), materialize: bool = False, merge_null_groups: bool = False):
        """``materialize``: checkpoint the support-health satellite (it feeds both marts)."""
        require_ports(inputs, REQUIRED_INPUTS)
        self.inputs = inputs
        self.as_of = as_of
        self.billing_as_of = billing_as_of if billing_as_of is not None else as_of
        self.windows = windows
        self.materialize = materialize
        self.merge_null_groups = merge_null_groups

    def materialized(self) -> "Silver":
        """This build, or an equal one whose satellite is checkpointed."""
        if self.materialize:
            return self
        return Silver(self.inputs, self.as_of, self.billing_as_of, self.windows, materialize=True,
                      merge_null_groups=self.merge_null_groups)

    # DV staging
    @cached_property
    def dv_account(self) -> DataFrame:
        return dv_stage(self.inputs["account"], "account", self.as_of)

    @cached_property
    def dv_service(self) -> DataFrame:
        return dv_stage(self.inputs["service"], "service", self.as_of)

    @cached_property
    def dv_subscription(self) -> DataFrame:
        return dv_stage(self.inputs["subscription"], "subscription", self.as_of)

    @cached_property
    def dv_product_offering(self) -> DataFrame:
        return dv_stage(self.inputs["product_offering"], "product_offering", self.as_of)

    # features
    @cached_property
    def usage(self) -> DataFrame:
        return features.usage_30d(self.inputs["usage_event"], self.as_of, self.windows.usage)

    @cached_property
    def interactions(self) -> DataFrame:
        return features.interactions_30d(self.inputs["customer_interaction"], self.as_of, self.windows.interactions)

    @cached_property
    def tickets(self) -> DataFrame:
        return features.ticket_status_30d(self.inputs["trouble_ticket"], self.as_of, self.windows.tickets)

    @cached_property
    def ticket_parts(self) -> DataFrame:
        return features.ticket_parts_30d(self.inputs["trouble_ticket"], self.as_of, self.windows.tickets)

    @cached_property
    def charges(self) -> DataFrame:
        return features.charges_30d(self.inputs["invoice_charge"], self.inputs["invoice"], self.inputs["service"],
                                    self.inputs["subscription"], self.billing_as_of, self.windows.charges,
                                    snapshot_as_of=self.as_of)

    # raw vault
    @cached_property
    def hub_account(self) -> DataFrame:
        return vault.hub(self.dv_account, "hk_account", "account_id")

    @cached_property
    def hub_service(self) -> DataFrame:
        return vault.hub(self.dv_service, "hk_service", "service_id")

    @cached_property
    def hub_subscription(self) -> DataFrame:
        return vault.hub(self.dv_subscription, "hk_subscription", "subscription_id")

    @cached_property
    def hub_product_offering(self) -> DataFrame:
        return vault.hub(self.dv_product_offering, "hk_product_offering", "product_offering_id")

    @cached_property
    def link_account_service(self) -> DataFrame:
        return vault.link_account_service(self.dv_service, self.dv_account)

    @cached_property
    def link_service_subscription(self) -> DataFrame:
        return vault.link_service_subscription(self.dv_subscription, self.dv_service)

    # business vault
    @cached_property
    def sat_account_profile(self) -> DataFrame:
        return vault.sat_account_profile(self.dv_account)

    @cached_property
    def sat_service_support_health(self) -> DataFrame:
        tickets = self.ticket_parts if self.merge_null_groups else self.tickets
        df = vault.sat_service_support_health(self.dv_service, self.usage, self.interactions, tickets,
                                              self.charges, self.as_of, self.merge_null_groups)
        return _materialize(df) if self.materialize else df

    @cached_property
    def mart_health(self) -> DataFrame:
        """The satellite's columns that the marts read. A checkpoint has only these, unless the whole one is there."""
        if not self.materialize or "sat_service_support_health" in self.__dict__:
            return self.sat_service_support_health
        lazy = Silver(self.inputs, self.as_of, self.billing_as_of, self.windows, merge_null_groups=self.merge_null_groups)
        if "charges" in self.__dict__:
            lazy.charges = self.charges
        return _materialize(lazy.sat_service_support_health.select(*marts.HEALTH_COLUMNS))

    # marts
    @cached_property
    def subscriber360_core(self) -> DataFrame:
        return marts.subscriber360_core(self.sat_account_profile, self.dv_service, self.dv_subscription,
                                        self.dv_product_offering, self.mart_health,
                                        self.dv_account)

    @cached_property
    def health_scorecard(self) -> DataFrame:
        return marts.health_scorecard(self.mart_health)


def build_silver(inputs: dict[str, DataFrame], as_of, billing_as_of=None, windows: Windows = Windows(),
                 materialize: bool = False, merge_null_groups: bool = False) -> Silver:
    return Silver(inputs, as_of, billing_as_of, windows, materialize, merge_null_groups)


def support_posture(inputs: dict[str, DataFrame], as_of, days: int = 30) -> DataFrame:
    """The support-posture product over landing tables."""
    require_ports(inputs, ("service", "subscription", "product_offering", "usage_event", "customer_interaction",
                           "trouble_ticket", "service_lifecycle_event"))
    return marts.support_posture(inputs["service"], inputs["subscription"], inputs["product_offering"],
                                 inputs["usage_event"], inputs["customer_interaction"], inputs["trouble_ticket"],
                                 inputs["service_lifecycle_event"], as_of, days)


def share_charges(products: list[Silver]) -> None:
    """Products over the same inputs, clocks and billing window have the same charges: these are written once and read by
    each, instead of aggregated from all charge lines again for each."""
    alike: dict[tuple, list[Silver]] = {}
    for p in products:
        alike.setdefault((id(p.inputs), str(p.as_of), str(p.billing_as_of), p.windows.charges), []).append(p)
    for same in alike.values():
        if len(same) > 1:
            charges = _materialize(same[0].charges)
            for p in same:
                p.charges = charges


def prepare(products: list[Silver]) -> list[Silver]:
    """Materialize the satellites of independent products concurrently.

    Each checkpoint is its own Spark job; submitting them from separate
    driver threads lets the cluster run them side by side instead of one
    after the other. Products built without ``materialize`` are left lazy.
    """
    from concurrent.futures import ThreadPoolExecutor

    todo = [p for p in products if p.materialize]
    share_charges(todo)
    if len(todo) > 1:
        with ThreadPoolExecutor(max_workers=len(todo)) as ex:
            list(ex.map(lambda p: p.mart_health, todo))
    return products


def customer_360(products: list[Silver]) -> DataFrame:
    """Gold: compose silver products (first has priority) into account-level 360."""
    prepare(products)
    return marts.customer_360([p.subscriber360_core for p in products], [p.health_scorecard for p in products])
