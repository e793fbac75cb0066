"""Data-quality audits: one generic job per kind of constraint, driven by the catalogue.

Every audit returns rows (constraint, table, key, detail). Keys are counted before anything is
joined, so a value that repeats in a third of the rows is one row from the map side on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.catalogue import (
    DEFAULTS,
    Reference,
    RowCheck,
    Unique,
    key_of,
    not_null_columns,
)
from tidewake.operators.common import union_all
from tidewake.sources.tables import Tables


# Rows of a partition in which keys are counted, and into how many a repeated key is dealt at most.
KEYS_DEALT = 524_288
SALTS = 8


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _found(df: DataFrame, constraint: str, table: str, key: str) -> DataFrame:
    """Counted values as audit rows."""
    return df.selectExpr(
        f"{_quoted(constraint)} AS `constraint`",
        f"{_quoted(table)} AS `table`",
        f"{key} AS `key`",
        "concat(count, ' rows') AS detail",
    )


def _row_counts(t: Tables, tables: Iterable[str]) -> dict[str, int]:
    """Rows of each table, in one job; plain Parquet tables are counted from their footers."""
    counts = [t[x].agg(F.count(F.lit(1)).alias("n")).selectExpr(f"{_quoted(x)} AS name", "n") for x in dict.fromkeys(tables)]
    return {r["name"]: r["n"] for r in union_all(counts).collect()}


def audit_unique(t: Tables, constraints: Iterable[Unique]) -> DataFrame:
    """Values that occur more than once. A NULL in a primary key is reported, in another key skipped.

    The rows are dealt into partitions of bounded size, by number: AQE joins other partitions by their compressed
    bytes, which are few for keys, and a task would hold millions of them. The source partition is part of the
    first deal, so that a value that fills much of a table is counted in several tasks.
    """
    constraints = list(constraints)
    sizes = _row_counts(t, [c.table for c in constraints])
    parts = []
    for c in constraints:
        names = list(c.columns)
        has_null = " OR ".join(f"{x} IS NULL" for x in names)
        bad = f"count > 1 OR {has_null}" if c.primary else "count > 1"
        key = ", ".join(f"coalesce(CAST({x} AS STRING), 'NULL')" for x in names)
        rows = t[c.table].select(*names)
        rows = rows if c.primary else rows.filter(f"NOT ({has_null})")
        dealt = 1 + sizes[c.table] // KEYS_DEALT
        if dealt == 1:
            counts = rows.groupBy(*names).count()
        else:
            salted = rows.withColumn("_salt", F.spark_partition_id() % SALTS).repartition(dealt, *names, "_salt")
            some = salted.groupBy(*names, "_salt").count().drop("_salt")
            counts = some.repartition(dealt, *names).groupBy(*names).agg(F.sum("count").alias("count"))
        parts.append(_found(counts.filter(bad), c.name, c.table, f"concat_ws('|', {key})"))
    return union_all(parts)


def audit_references(t: Tables, references: Iterable[Reference]) -> DataFrame:
    """Values without a parent row, with the number of rows that carry them; NULL is no reference.

    A child table is read once for all its references and a parent once for all that name it: their rows
    are (parent, value) pairs, so one join settles all references together. References and parents go by
    number. The join is an outer one, since Spark moves an anti join into the union, where every child
    table would read all parents again.
    """
    references = list(references)
    numbers = {name: i for i, name in enumerate(dict.fromkeys(r.parent for r in references))}
    children, parents = [], []
    for table in dict.fromkeys(r.table for r in references):
        mine = [
            f"named_struct('ref', {i}, 'parent', {numbers[r.parent]}, 'value', CAST({r.column} AS BIGINT))"
            for i, r in enumerate(references)
            if r.table == table
        ]
        spread = t[table].selectExpr(f"inline(array({', '.join(mine)}))").filter("value IS NOT NULL")
        children.append(spread.groupBy("ref", "parent", "value").count())
    for parent, column in dict.fromkeys((r.parent, r.parent_column) for r in references):
        parents.append(t[parent].selectExpr(f"{numbers[parent]} AS parent", f"CAST({column} AS BIGINT) AS value", "true AS _known"))
    joined = union_all(children).join(union_all(parents), ["parent", "value"], "left")
    constraint, table = (f"element_at(array({', '.join(_quoted(x) for x in names)}), ref + 1)" for names in zip(*[(r.name, r.table) for r in references]))
    return joined.filter("_known IS NULL").selectExpr(
        f"{constraint} AS `constraint`", f"{table} AS `table`", "CAST(value AS STRING) AS `key`", "concat(`count`, ' rows') AS detail"
    )


def _flagged(df: DataFrame, table: str, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """All row conditions (name, condition that is broken, detail) of a table in one scan.

    The filter keeps only rows with a failure, and its comparisons reach the scan, where row groups
    without one are skipped by their statistics. A row's failures are then spread out.
    """
    broken = ", ".join(
        f"IF({bad}, named_struct('constraint', {_quoted(name)}, 'detail', {_quoted(detail)}), NULL)"
        for name, bad, detail in checks
    )
    return (
        df.filter(" OR ".join(f"({bad})" for _, bad, _ in checks))
        .selectExpr(f"CAST({key_of(table)} AS STRING) AS `key`", f"inline(array_compact(array({broken})))")
        .selectExpr("`constraint`", f"{_quoted(table)} AS `table`", "`key`", "detail")
    )


def audit_rows(t: Tables, checks: Iterable[RowCheck]) -> DataFrame:
    """Rows that break a condition; an unknown condition passes."""
    by_table = sorted(checks, key=lambda c: c.table)
    parts = []
    for table, group in groupby(by_table, key=lambda c: c.table):
        parts.append(_flagged(t[table], table, [(c.name, f"NOT ({c.condition})", c.condition) for c in group]))
    return union_all(parts)


def audit_not_null(t: Tables, tables: Iterable[str] | None = None) -> DataFrame:
    """NULLs in columns that must have a value."""
    parts = []
    for table in tables or t:
        tests = [(f"NN_{table}_{c}", f"{c} IS NULL", c) for c in not_null_columns(table)]
        parts.append(_flagged(t[table], table, tests))
    return union_all(parts)


def fill_defaults(
    df: DataFrame,
    table: str,
    as_of: dt.datetime | str,
    defaults: Mapping[str, Mapping[str, str]] = DEFAULTS,
) -> DataFrame:
    """NULLs replaced by the declared defaults; ``as_of`` stands for the current moment."""
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {
        column: F.coalesce(F.col(column), F.lit(str(as_of) if value == "now" else value).cast(types[column]))
        for column, value in defaults.get(table, {}).items()
        if column in types
    }
    return df.withColumns(filled) if filled else df


def audit_symmetric(
    edges: DataFrame,
    table: str = "CabinAdjacency",
    a: str = "CabinID",
    b: str = "AdjacentCabinID",
) -> DataFrame:
    """Edges whose reverse is missing."""
    pairs = edges.groupBy(a, b).count()
    reverse = edges.selectExpr(f"{b} AS {a}", f"{a} AS {b}")
    lone = pairs.join(reverse, [a, b], "left_anti")
    return _found(lone, f"SYM_{table}", table, f"concat_ws('|', CAST({a} AS STRING), CAST({b} AS STRING))")
