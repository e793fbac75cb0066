"""Chains of rescheduled bookings: each names the booking it replaced."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.operators.common import first_violation, violation_list
from tidewake.session import stage
from tidewake.sources.tables import Tables

# Own wording; the column is declared, but nothing follows it.
UNKNOWN_ORIGINAL = "Original booking does not exist."
CIRCULAR = "Reschedule chain runs in a circle."


def walk_to_root(links: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, hops) of every node with a parent; root is NULL where the parents run in a circle.

    Pointer doubling: every open node jumps to where its target has jumped, so chains of length n end
    after log2(n) + 1 rounds, each a join of the open nodes on a written table. A chain has nodes of
    every depth up to its own, so in each round some open node of a chain ends; when none does, all
    that are open lead into circles.
    """
    state = links.select(F.col(node).alias("node"), F.col(parent).alias("at"), F.lit(1).cast("bigint").alias("hops"))
    unfinished = stage(state, "chain-links")
    finished: list[DataFrame] = []
    while True:
        known = reduce(DataFrame.union, [*finished, unfinished.withColumn("done", F.lit(False))])
        target = known.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("hops").alias("_hops"), "done")
        jumped = unfinished.join(target, "at", "left").select(
            "node",
            F.coalesce("_at", "at").alias("at"),
            (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            F.coalesce("done", F.lit(True)).alias("done"),
        )
        jumped = stage(jumped, "chain-jumps")
        ended = jumped.filter("done")
        unfinished = jumped.filter("NOT done").drop("done")
        if not ended.limit(1).count():
            break
        finished.append(ended)
    circular = unfinished.select("node", F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("hops"))
    whole = reduce(DataFrame.union, [f.drop("done") for f in finished], circular)
    return whole.select(F.col("node").alias(node), F.col("at").alias("root"), "hops")


def reschedule_chains(t: Tables) -> DataFrame:
    """Per booking: first booking of its chain, reschedules since, and the chain's latest booking.

    A booking whose original is unknown starts a chain of its own and is a violation. One whose chain
    runs in a circle, or leads into one, is a violation and has no root, depth or latest booking. Where
    several bookings replace one, the latest is the one of most reschedules, then of the latest booking
    date, then of the highest id. Only bookings with an original are walked.
    """
    bookings = t["Booking"].select("BookingID", "OriginalBookingID", "BookingDate")
    replaced = bookings.filter("OriginalBookingID IS NOT NULL")
    ids = bookings.select(F.col("BookingID").alias("OriginalBookingID"))
    links = replaced.join(ids, "OriginalBookingID", "left_semi").select("BookingID", "OriginalBookingID")
    walked = stage(walk_to_root(links, "BookingID", "OriginalBookingID").withColumn("_linked", F.lit(True)), "chains")
    linked = F.coalesce("_linked", F.lit(False))
    placed = bookings.join(walked, "BookingID", "left").select(
        "BookingID",
        "OriginalBookingID",
        "BookingDate",
        F.when(linked, F.col("root")).otherwise(F.col("BookingID")).alias("RootBookingID"),
        F.when(linked, F.col("hops")).otherwise(F.lit(0)).cast("bigint").alias("Depth"),
        (F.col("OriginalBookingID").isNotNull() & ~linked).alias("_unknown"),
        (linked & F.col("root").isNull()).alias("_circular"),
    )
    # Chains of one booking need no aggregate: only those with a reschedule are grouped.
    moved = placed.filter("Depth > 0")
    newest = F.max(F.struct("Depth", "BookingDate", "BookingID"))
    latest = moved.groupBy("RootBookingID").agg(newest["BookingID"].alias("_latest"))
    judged = placed.join(latest, "RootBookingID", "left").withColumn(
        "violations", violation_list((F.col("_unknown"), UNKNOWN_ORIGINAL), (F.col("_circular"), CIRCULAR))
    )
    return judged.select(
        "BookingID",
        "OriginalBookingID",
        "RootBookingID",
        "Depth",
        F.coalesce("_latest", "RootBookingID").alias("LatestBookingID"),
        "violations",
        first_violation(F.col("violations")).alias("first_violation"),
    )
