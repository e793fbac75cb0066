"""Lookup operators: route endpoints, effective-dated rules, bands, thresholds, neighbours.

In the dated lookup distinct probe values are taken first, which collapses a hot key on the map
side; only those are joined to the rules by equality on the keys with the range as a residual; the
best rule per probe is an aggregate (no sort of candidates); the answer goes back to the rows by
equality, where AQE can broadcast it or split a skewed partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tidewake.operators.common import BROADCAST_ROWS, is_small

MAX_BUCKETS = 10_000


def route_endpoints(
    stops: DataFrame, key: str = "RouteID", seq: str = "StopSequence", place: str = "PortID"
) -> DataFrame:
    """First stop (sequence 1), last stop (highest sequence) and number of stops per route.

    One aggregate, so one shuffle, and partial aggregation keeps a route with very many stops cheap.
    """
    return stops.groupBy(key).agg(
        F.max(F.when(F.col(seq) == 1, F.col(place))).alias("FirstPortID"),
        F.max_by(place, seq).alias("LastPortID"),
        F.count(F.lit(1)).alias("Stops"),
    )


def dated_candidates(
    probes: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    date_col: str,
    take: Sequence[str],
    start: str = "EffectiveFrom",
    end: str = "EffectiveTo",
) -> DataFrame:
    """All rules in force per distinct (keys, date) of the probes, with their start."""
    wanted = probes.select(*keys, date_col).distinct()
    return (
        wanted.join(rules.select(*keys, start, end, *take), list(keys))
        .filter((F.col(start) <= F.col(date_col)) & (F.col(end).isNull() | (F.col(end) >= F.col(date_col))))
        .drop(end)
    )


def effective_prices(
    probes: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    date_col: str,
    take: Sequence[str],
    extra_keys: Sequence[str] = (),
    start: str = "EffectiveFrom",
    end: str = "EffectiveTo",
) -> DataFrame:
    """Rule in force per distinct (keys, date): the latest start on or before the date, not ended.

    ``extra_keys`` are rule columns that multiply the answer (one rule per value) without being part
    of the probe. A rule's start is unique within its keys, so the picks are deterministic.
    """
    candidates = dated_candidates(probes, rules, keys, date_col, [*extra_keys, *take], start, end)
    return candidates.groupBy(*keys, *extra_keys, date_col).agg(
        *[F.max_by(c, start).alias(c) for c in take]
    )


def effective_rule(
    facts: DataFrame,
    rules: DataFrame,
    keys: Sequence[str],
    date_col: str,
    take: Sequence[str],
    start: str = "EffectiveFrom",
    end: str = "EffectiveTo",
) -> DataFrame:
    """``facts`` with the columns ``take`` of the rule in force on ``date_col``; NULL where there is none.

    ``facts`` is read twice: once for its distinct (keys, date), once to attach the answer. Pass a
    staged or cheap frame, or attach the result of ``effective_prices`` to a smaller one.
    """
    prices = effective_prices(facts, rules, keys, date_col, take, start=start, end=end)
    return facts.join(prices, [*keys, date_col], "left")


def band_lookup(
    df: DataFrame,
    bands: DataFrame,
    value: str,
    low: str,
    high: str,
    bucket_width: int = 1024,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of each row to the band [low, high] holding ``value``; a NULL high end is open.

    Values and ends are numbers, dates or timestamps. The result has the columns of both frames, also those
    that share a name; a NULL value or low end meets nothing. A band table of checked size is broadcast. A
    larger one is cut at fixed bucket borders inside the range of values that are present and joined by
    equality on the bucket; buckets are at least ``bucket_width`` wide (days for dates), and at most
    MAX_BUCKETS in number.
    """
    # Names of their own, so that none is ambiguous.
    side = bands.toDF(*[f"_band{i}" for i in range(len(bands.columns))])
    first, last = (F.col(f"_band{bands.columns.index(c)}") for c in (low, high))
    named = [F.col(f"_band{i}").alias(c) for i, c in enumerate(bands.columns)]
    v = F.col(value)
    inside = (v >= first) & (last.isNull() | (v <= last))
    if is_small(bands, max_broadcast_rows):
        return df.join(F.broadcast(side), inside, "left").select(*[F.col(c) for c in df.columns], *named)

    dated = isinstance(df.schema[value].dataType, (DateType, TimestampType, TimestampNTZType))

    def number(c: Column) -> Column:
        return F.unix_date(c.cast("date")).cast("double") if dated else c.cast("double")

    edges = df.agg(F.struct(F.min(number(v)).alias("low"), F.max(number(v)).alias("high")).alias("edges")).scalar()
    width = F.greatest(F.lit(float(bucket_width)), (edges["high"] - edges["low"]) / MAX_BUCKETS)

    def bucket(c: Column) -> Column:
        return F.floor(c / width).cast("bigint")

    begin = F.greatest(number(first), edges["low"])
    end = F.least(F.coalesce(number(last), edges["high"]), edges["high"])
    cut = side.filter(first.isNotNull() & (begin <= end)).withColumn("_bucket", F.explode(F.sequence(bucket(begin), bucket(end))))
    keyed = df.withColumn("_at", bucket(number(v)))
    joined = keyed.join(cut, (F.col("_at") == F.col("_bucket")) & inside, "left")
    return joined.select(*[F.col(c) for c in df.columns], *named)


def threshold_policy(
    facts: DataFrame,
    policies: DataFrame,
    hours_col: str,
    key: str = "OperatorID",
) -> DataFrame:
    """``facts`` with the policy of the smallest threshold at or above ``hours_col``.

    Without such a policy the penalty is ('Percentage', 0). Equal thresholds fall to the lower policy id.

    Each policy covers the hours above the next lower threshold of its operator up to its own. The
    intervals do not overlap, so one equality join with a range residual finds the policy: the facts
    are read once and nothing is aggregated afterwards.
    """
    ladder = Window.partitionBy(key).orderBy("HoursBeforeDeparture")
    steps = (
        policies.groupBy(key, "HoursBeforeDeparture")
        .agg(F.min_by(F.struct("PenaltyType", "PenaltyValue"), "PolicyID").alias("_policy"))
        .withColumn("_above", F.lag("HoursBeforeDeparture").over(ladder))
        .withColumnRenamed(key, "_key")
    )
    hours = F.col(hours_col)
    inside = (hours <= F.col("HoursBeforeDeparture")) & (F.col("_above").isNull() | (hours > F.col("_above")))
    return facts.join(steps, (F.col(key) == F.col("_key")) & inside, "left").select(
        *[facts[c] for c in facts.columns],
        F.coalesce("_policy.PenaltyType", F.lit("Percentage")).alias("PenaltyType"),
        F.coalesce(F.col("_policy.PenaltyValue"), F.lit(0).cast("decimal(10,2)")).alias("PenaltyValue"),
    )


def guardian_nearby(
    guardians: DataFrame,
    edges: DataFrame,
    place: str = "CabinID",
    neighbour: str = "AdjacentCabinID",
    scope: str = "VoyageID",
) -> DataFrame:
    """Distinct (scope, place) that have a guardian in a neighbouring place of the same scope."""
    seats = guardians.select(F.col(scope), F.col(place).alias(neighbour)).distinct()
    return seats.join(edges.select(place, neighbour), neighbour).select(scope, place).distinct()
