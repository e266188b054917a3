"""The nine source entities: column types, keys, references and value domains."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT, DATE, STAMP = T.StringType(), T.DateType(), T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


@dataclass(frozen=True)
class Entity:
    name: str
    description: str
    key: str
    columns: dict
    references: dict = field(default_factory=dict)
    required_dates: tuple = ()
    amounts: tuple = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns.items()])


# Entity names, their columns in file order, keys and references.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "crm_accounts",
            "One row per account known to the CRM",
            "account_id",
            {
                "account_id": TEXT,
                "account_name": TEXT,
                "industry": TEXT,
                "segment": TEXT,
                "employee_band": TEXT,
                "country": TEXT,
                "created_at": DATE,
                "account_owner": TEXT,
            },
            required_dates=("created_at",),
        ),
        Entity(
            "crm_contacts",
            "People attached to an account",
            "contact_id",
            {
                "contact_id": TEXT,
                "account_id": TEXT,
                "email": TEXT,
                "full_name": TEXT,
                "role": TEXT,
                "created_at": DATE,
            },
            references={"account_id": ("crm_accounts", "account_id")},
        ),
        Entity(
            "crm_deals",
            "Sales opportunities",
            "deal_id",
            {
                "deal_id": TEXT,
                "account_id": TEXT,
                "deal_name": TEXT,
                "pipeline": TEXT,
                "deal_stage": TEXT,
                "deal_amount_usd": MONEY,
                "expected_mrr_usd": MONEY,
                "plan": TEXT,
                "created_at": DATE,
                "close_date": DATE,
            },
            references={"account_id": ("crm_accounts", "account_id")},
            required_dates=("created_at",),
            amounts=("deal_amount_usd", "expected_mrr_usd"),
        ),
        Entity(
            "billing_customers",
            "Billing-side identity of an account",
            "billing_customer_id",
            {
                "billing_customer_id": TEXT,
                "account_id": TEXT,
                "customer_name": TEXT,
                "created_at": DATE,
                "country": TEXT,
            },
            references={"account_id": ("crm_accounts", "account_id")},
        ),
        Entity(
            "billing_subscriptions",
            "Recurring contracts",
            "subscription_id",
            {
                "subscription_id": TEXT,
                "billing_customer_id": TEXT,
                "account_id": TEXT,
                "plan": TEXT,
                "status": TEXT,
                "billing_cycle": TEXT,
                "start_date": DATE,
                "canceled_at": DATE,
                "mrr_usd": MONEY,
                "arr_usd": MONEY,
            },
            references={"account_id": ("crm_accounts", "account_id")},
            required_dates=("start_date",),
            amounts=("mrr_usd", "arr_usd"),
        ),
        Entity(
            "billing_invoices",
            "Invoices raised for a subscription",
            "invoice_id",
            {
                "invoice_id": TEXT,
                "subscription_id": TEXT,
                "billing_customer_id": TEXT,
                "account_id": TEXT,
                "invoice_date": DATE,
                "due_date": DATE,
                "amount_due_usd": MONEY,
                "status": TEXT,
            },
            references={"subscription_id": ("billing_subscriptions", "subscription_id")},
            required_dates=("invoice_date",),
            amounts=("amount_due_usd",),
        ),
        Entity(
            "billing_payments",
            "Payments received against an invoice",
            "payment_id",
            {
                "payment_id": TEXT,
                "invoice_id": TEXT,
                "billing_customer_id": TEXT,
                "account_id": TEXT,
                "payment_date": DATE,
                "amount_paid_usd": MONEY,
                "payment_method": TEXT,
            },
            references={"invoice_id": ("billing_invoices", "invoice_id")},
            required_dates=("payment_date",),
            amounts=("amount_paid_usd",),
        ),
        Entity(
            "product_events",
            "Product usage events",
            "event_id",
            {
                "event_id": TEXT,
                "account_id": TEXT,
                "subscription_id": TEXT,
                "user_id": TEXT,
                "event_type": TEXT,
                "occurred_at": STAMP,
            },
            references={"subscription_id": ("billing_subscriptions", "subscription_id")},
            required_dates=("occurred_at",),
        ),
        Entity(
            "support_tickets",
            "Support requests",
            "ticket_id",
            {
                "ticket_id": TEXT,
                "account_id": TEXT,
                "subscription_id": TEXT,
                "created_at": STAMP,
                "resolved_at": STAMP,
                "status": TEXT,
                "severity": TEXT,
                "category": TEXT,
            },
            references={"subscription_id": ("billing_subscriptions", "subscription_id")},
            required_dates=("created_at",),
        ),
    )
}

# Labels whose exact text other systems read.
EVENT_TYPES = (
    "login",
    "dashboard_viewed",
    "report_created",
    "integration_connected",
    "user_invited",
    "export_downloaded",
)
CONTACT_ROLES = ("Admin", "Executive Sponsor", "Finance", "Operations", "Analyst", "Technical Owner")
PLANS = ("Starter", "Growth", "Scale", "Enterprise")
TICKET_CATEGORIES = ("billing", "bug", "how_to", "integration", "performance", "feature_request")
PAYMENT_METHODS = ("card", "bank_transfer", "wire")


def source_catalog() -> dict[str, Entity]:
    """Name to entity for every source the warehouse reads."""
    return dict(ENTITIES)


def catalog_rows() -> list[tuple]:
    """The catalogue as rows of ``CATALOG``: a row for each column of each source."""
    return [
        (e.name, e.description, place, column, dtype.simpleString(), column == e.key, *e.references.get(column, (None, None)))
        for e in source_catalog().values()
        for place, (column, dtype) in enumerate(e.columns.items(), 1)
    ]


CATALOG = (
    "source_name string, description string, position int, column_name string, data_type string, is_key boolean, "
    "references_source string, references_column string"
)
