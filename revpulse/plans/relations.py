"""Every named relation of the warehouse, its layer, and how it is derived."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from revpulse.operators import customer, marts, product, revenue, staging, support
from revpulse.params import Params, Policy
from revpulse.schemas import ENTITIES

LAYERS = ("raw", "staging", "intermediate", "marts")


@dataclass(frozen=True)
class Relation:
    name: str
    layer: str
    derive: Callable[["Warehouse"], DataFrame]
    entity: str | None = None  # of a staging relation: what it takes its rows from

    @property
    def kind(self) -> str:
        return "BASE TABLE" if self.layer in ("raw", "marts") else "VIEW"


def _raw(entity):
    return Relation(entity, "raw", lambda w: w.sources[entity])


def _staging(name, entity, op, timed=False):
    if timed:
        return Relation(name, "staging", lambda w: op(w[entity], w.params), entity)
    return Relation(name, "staging", lambda w: op(w[entity]), entity)


def _mid(name, derive):
    return Relation(name, "intermediate", derive)


def _mart(name, derive):
    return Relation(name, "marts", derive)


def _settlement(w: "Warehouse") -> DataFrame:
    return revenue.subscription_settlement(
        w["stg_billing__subscriptions"], w["int_revenue__invoice_payment_summary"], w.params
    )


# Relation names that reports and dashboards select from.
RELATIONS: dict[str, Relation] = {
    r.name: r
    for r in (
        *(_raw(e) for e in ENTITIES),
        _staging("stg_crm__accounts", "crm_accounts", staging.stg_accounts),
        _staging("stg_crm__contacts", "crm_contacts", staging.stg_contacts),
        _staging("stg_crm__deals", "crm_deals", staging.stg_deals),
        _staging("stg_billing__customers", "billing_customers", staging.stg_billing_customers),
        _staging("stg_billing__subscriptions", "billing_subscriptions", staging.stg_subscriptions),
        _staging("stg_billing__invoices", "billing_invoices", staging.stg_invoices),
        _staging("stg_billing__payments", "billing_payments", staging.stg_payments),
        _staging("stg_product__events", "product_events", staging.stg_events),
        _staging("stg_support__tickets", "support_tickets", staging.stg_tickets, timed=True),
        _mid(
            "int_revenue__invoice_payment_summary",
            lambda w: revenue.invoice_payment_summary(
                w["stg_billing__invoices"], w["stg_billing__payments"], w.params
            ),
        ),
        _mid(
            "int_revenue__subscriptions_enriched",
            lambda w: revenue.subscriptions_enriched(_settlement(w), w["stg_crm__accounts"]),
        ),
        _mid(
            "int_customer__account_base",
            lambda w: customer.account_base(
                w["stg_crm__accounts"],
                w["stg_crm__contacts"],
                w["stg_crm__deals"],
                w["stg_billing__customers"],
                w["stg_billing__subscriptions"],
            ),
        ),
        _mid(
            "int_product__account_usage",
            lambda w: product.account_usage(w.recent_events, w.params, w.policy),
        ),
        _mid(
            "int_support__account_ticket_summary",
            lambda w: support.account_ticket_summary(w["stg_support__tickets"], w.params, w.policy),
        ),
        _mid(
            "int_customer__health_signals",
            lambda w: customer.health_signals(
                w["int_customer__account_base"],
                revenue.revenue_by_account(w.subscription_facts),
                w["int_product__account_usage"],
                w["int_support__account_ticket_summary"],
                w.policy,
            ),
        ),
        _mart("mart_customer_health", lambda w: marts.mart_customer_health(w["int_customer__health_signals"])),
        _mart("mart_account_360", lambda w: marts.mart_account_360(w["mart_customer_health"], w.policy)),
        _mart("mart_churn_risk", lambda w: marts.mart_churn_risk(w["mart_account_360"], w.policy)),
        _mart("mart_revenue_retention", lambda w: marts.mart_revenue_retention(w["mart_account_360"])),
        _mart("mart_product_adoption", lambda w: marts.mart_product_adoption(w["mart_account_360"])),
        _mart("mart_support_operations", lambda w: marts.mart_support_operations(w["mart_account_360"])),
    )
}


ENTITY_OF = {r.name: r.entity for r in RELATIONS.values() if r.entity}


def in_layer(*layers: str) -> list[str]:
    return [r.name for r in RELATIONS.values() if r.layer in layers]


class Warehouse(Mapping):
    """All relations over one set of sources, each a lazy DataFrame.

    ``stored`` holds relations that were written out; everything downstream
    of them reads the stored copy.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        params: Params = Params(),
        policy: Policy = Policy(),
        stored: Mapping[str, DataFrame] | None = None,
    ):
        self.sources, self.params, self.policy = sources, params, policy
        self._written: dict[str, DataFrame] = dict(stored or {})
        self.paths: dict[str, str] = {}  # of derived relations that a run wrote
        self._frames: dict[str, DataFrame] = dict(self._written)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = RELATIONS[name].derive(self)
        return self._frames[name]

    def __iter__(self):
        return iter(RELATIONS)

    def __len__(self):
        return len(RELATIONS)

    def store(self, name: str, frame: DataFrame) -> None:
        """Read ``name`` from a written copy; relations derived later start from it."""
        self._written[name] = frame
        self._frames = dict(self._written)

    def written(self, without: str | None = None) -> dict[str, DataFrame]:
        return {n: df for n, df in self._written.items() if n != without}

    @property
    def recent_events(self) -> DataFrame:
        """Staged events from which those of the usage window can be taken.

        Published sources keep events by month, so only the months of the window are opened.
        """
        between = getattr(self.sources, "between", None)
        if between is None or "stg_product__events" in self._written:
            return self["stg_product__events"]
        return staging.stg_events(between("product_events", self.params.window_start, self.params.as_of_date))

    @property
    def subscription_facts(self) -> DataFrame:
        """Settled subscriptions without account names, which account totals do not need.

        A stored ``int_revenue__subscriptions_enriched`` is used when there is one.
        """
        enriched = self._written.get("int_revenue__subscriptions_enriched")
        return enriched if enriched is not None else _settlement(self)
