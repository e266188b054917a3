"""Recurring-revenue account analytics expressed as Spark DataFrame operators."""

from revpulse.params import Params, Policy

__all__ = ["Params", "Policy"]
