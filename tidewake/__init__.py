"""Reservation analytics on PySpark: reports, business rules and audits as DataFrame functions."""

__version__ = "0.1.0"
