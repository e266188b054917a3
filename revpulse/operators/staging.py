"""Source rows renamed, typed and given their status flags; one projection per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from revpulse.params import Params
from revpulse.schemas import ENTITIES


def _typed(df: DataFrame, name: str, dtype: T.DataType, alias: str) -> str:
    """Expression for a source column as its declared type; empty text means no value.

    A column that already has the type passes through as it is, so a filter on it
    still reaches the scan.
    """
    found = df.schema[name].dataType
    if found == dtype:
        return f"{name} AS {alias}"
    source = f"nullif({name}, '')" if isinstance(found, T.StringType) else name
    return f"CAST({source} AS {dtype.simpleString()}) AS {alias}"


#: New names of source columns.
RENAMED = {
    "crm_contacts": {"role": "contact_role"},
    "billing_subscriptions": {"status": "subscription_status"},
    "billing_invoices": {"status": "invoice_status"},
    "support_tickets": {"status": "ticket_status"},
}


def _flags(column: str, **labels: str) -> list[str]:
    """A boolean per label; an unknown or missing label leaves all of them false."""
    return [f"coalesce({column} = '{label}', false) AS {name}" for name, label in labels.items()]


def _ticket_columns(params: Params) -> list[str]:
    as_of = f"DATE'{params.as_of_date.isoformat()}'"
    done, waiting = "ticket_status IN ('resolved', 'closed')", "ticket_status IN ('open', 'pending')"
    created, resolved = "CAST(created_at AS DATE)", "CAST(resolved_at AS DATE)"
    return [
        "ticket_id",
        "account_id",
        "subscription_id",
        "created_at",
        f"{created} AS created_date",
        "resolved_at",
        f"{resolved} AS resolved_date",
        "ticket_status",
        "severity",
        "category",
        f"coalesce({done} AND {resolved} <= {as_of}, false) AS is_resolved",
        f"coalesce({created} <= {as_of} AND ({waiting} OR coalesce({resolved} > {as_of}, false)), false) AS is_open",
        "coalesce(severity IN ('high', 'critical'), false) AS is_high_priority",
        "CAST(extract(DAY FROM resolved_at - created_at) AS INT) AS resolution_days",
    ]


def _derived_columns(entity: str, params: Params) -> list[str]:
    """Expressions over the typed columns of an entity; without any the typed columns are all."""
    if entity == "billing_subscriptions":
        return ["*", *_flags("subscription_status", is_active="active", is_canceled="canceled", is_past_due="past_due")]
    if entity == "billing_invoices":
        return ["*", *_flags("invoice_status", is_paid="paid", is_open="open")]
    if entity == "product_events":
        return ["*", "CAST(occurred_at AS DATE) AS event_date"]
    return _ticket_columns(params) if entity == "support_tickets" else []


def _staged(raw: DataFrame, entity: str, params: Params = Params()) -> DataFrame:
    columns, renamed = ENTITIES[entity].columns, RENAMED.get(entity, {})
    typed = raw
    if renamed or [(f.name, f.dataType) for f in raw.schema] != list(columns.items()):
        typed = raw.selectExpr(*(_typed(raw, name, dtype, renamed.get(name, name)) for name, dtype in columns.items()))
    derived = _derived_columns(entity, params)
    return typed.selectExpr(*derived) if derived else typed


def staging_sql(entity: str, source: str, params: Params = Params()) -> str:
    """The staging relation of an entity as SQL over a table of its declared types."""
    renamed = RENAMED.get(entity, {})
    typed = ", ".join(f"{name} AS {renamed.get(name, name)}" for name in ENTITIES[entity].columns)
    derived = _derived_columns(entity, params)
    return f"SELECT {', '.join(derived) if derived else '*'} FROM (SELECT {typed} FROM {source})"


def stg_accounts(raw: DataFrame) -> DataFrame:
    return _staged(raw, "crm_accounts")


def stg_contacts(raw: DataFrame) -> DataFrame:
    return _staged(raw, "crm_contacts")


def stg_deals(raw: DataFrame) -> DataFrame:
    return _staged(raw, "crm_deals")


def stg_billing_customers(raw: DataFrame) -> DataFrame:
    return _staged(raw, "billing_customers")


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return _staged(raw, "billing_subscriptions")


def stg_invoices(raw: DataFrame) -> DataFrame:
    return _staged(raw, "billing_invoices")


def stg_payments(raw: DataFrame) -> DataFrame:
    return _staged(raw, "billing_payments")


def stg_events(raw: DataFrame) -> DataFrame:
    return _staged(raw, "product_events")


def stg_tickets(raw: DataFrame, params: Params = Params()) -> DataFrame:
    """Tickets with their state as of the observation date.

    A ticket marked resolved without a resolution time is neither open nor
    resolved, and ``resolution_days`` looks past the observation date.
    """
    return _staged(raw, "support_tickets", params)
