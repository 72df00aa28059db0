"""Trace, log and metric analytics as plain DataFrame operators."""

from telesift.session import configure

__all__ = ["configure"]
