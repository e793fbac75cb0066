"""Booking accounts: what was charged, voided, paid and paid back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.operators.common import first_violation, union_all, violation_list
from tidewake.operators.rules import cancellation_amounts
from tidewake.operators.running import Running, running
from tidewake.sources.tables import Tables

# Own wording; payments are declared, but nothing reads them.
UNKNOWN_ACCOUNT = "Payment names no booking."
UNDERPAID = "Booking is not fully paid."
OVERPAID = "Booking is overpaid."
KINDS = ("charge", "payment", "void", "penalty", "refund")


def _entries(rows: DataFrame, kind: str, at: str, amount: Column, key: str) -> DataFrame:
    """``kind_no`` orders entries of one moment: a charge before its payment, a void before its penalty."""
    return rows.select(
        "BookingID",
        F.lit(kind).alias("Kind"),
        F.lit(KINDS.index(kind)).alias("KindNo"),
        F.col(at).alias("At"),
        F.col(key).alias("EntryID"),
        amount.cast("decimal(12,2)").alias("Amount"),
    )


def ledger(t: Tables) -> DataFrame:
    """All entries of all accounts; the sum of an account's amounts is what its customer still owes.

    A booking is charged its total; a cancellation voids that, charges the penalty and pays the refund
    back. Only payments with status 'Paid' count.
    """
    cancelled = cancellation_amounts(t, t["BookingCancellation"])
    paid = t["Payment"].filter(F.col("PaymentStatus") == "Paid")
    when, key = "CancellationDateTime", "CancellationID"
    known = cancelled.filter("TotalAmount IS NOT NULL")
    return union_all(
        [
            _entries(t["Booking"], "charge", "BookingDate", F.col("TotalAmount"), "BookingID"),
            _entries(paid, "payment", "PaymentDateTime", -F.col("Amount"), "PaymentID"),
            _entries(known, "void", when, -F.col("TotalAmount"), key),
            _entries(known, "penalty", when, F.col("PenaltyAmount"), key),
            _entries(known, "refund", when, F.col("RefundAmount"), key),
        ]
    )


def account_balances(t: Tables) -> DataFrame:
    """Per account the sum of each kind of entry, the balance, and what is wrong with it.

    Every ledger is one branch of a union that is summed once, so that accounts known to one side only
    stay, as in a full outer join, and an account with very many payments is one row per task.
    """
    zero = F.lit(0).cast("decimal(38,2)")
    sums = [F.coalesce(F.sum(F.when(F.col("Kind") == k, F.col("Amount"))), zero).cast("decimal(38,2)").alias(f"_{k}") for k in KINDS]
    accounts = ledger(t).groupBy("BookingID").agg(F.max(F.col("Kind") == "charge").alias("_known"), *sums)
    balance = sum((F.col(f"_{k}") for k in KINDS[1:]), F.col("_charge"))
    accounts = accounts.withColumn("Balance", balance.cast("decimal(38,2)"))
    accounts = accounts.withColumn(
        "violations",
        violation_list(
            (~F.col("_known"), UNKNOWN_ACCOUNT),
            (F.col("_known") & (F.col("Balance") > 0), UNDERPAID),
            (F.col("_known") & (F.col("Balance") < 0), OVERPAID),
        ),
    )
    return accounts.select(
        "BookingID",
        F.col("_charge").alias("Charged"),
        (-F.col("_void")).alias("Voided"),
        F.col("_penalty").alias("Penalty"),
        (-F.col("_payment")).alias("Paid"),
        F.col("_refund").alias("Refunded"),
        "Balance",
        "violations",
        first_violation(F.col("violations")).alias("first_violation"),
    )


def account_statement(t: Tables) -> DataFrame:
    """Every entry with the account's balance after it, in time order."""
    order = [F.asc("At"), F.asc("KindNo"), F.asc("EntryID")]
    rows = running(ledger(t), ["BookingID"], order, {"Balance": Running(F.col("Amount"))})
    return rows.select("BookingID", "At", "Kind", "EntryID", "Amount", F.col("Balance").cast("decimal(38,2)").alias("Balance"))
