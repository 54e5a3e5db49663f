"""Aggregates per parent, each one grouped pass over the children."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions import fixed
from loadstone.session import settle


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def with_child_values(
    parents: DataFrame, children: DataFrame, key: str, values: dict[str, Column], zero: Sequence[str] = (), child_key: str | None = None
) -> DataFrame:
    """Parents with aggregates over their children, all in one grouped pass.

    ``values`` are aggregate columns; those named in ``zero`` are 0 instead of
    null for a parent without children.
    """
    per_parent = children.groupBy(F.col(child_key or key).alias("_parent")).agg(
        *[v.alias(f"_c_{n}") for n, v in values.items()]
    )
    joined = parents.join(per_parent, parents[key] == per_parent["_parent"], "left")
    out = [
        (F.coalesce(F.col(f"_c_{n}"), F.lit(0)) if n in zero else F.col(f"_c_{n}")).alias(n) for n in values
    ]
    return joined.select(*[c for c in parents.columns if c not in values], *out)


def join_children(
    parents: DataFrame, parts: dict[str, tuple[DataFrame, dict[str, Column]]], key: str, zero: Sequence[str] = (), steps: bool = False
) -> DataFrame:
    """Aggregates over several child tables of one parent key, one row per parent that has any child.

    ``parents`` holds the keys; ``parts`` are child tables with the aggregates over their rows. Each table is
    grouped by itself, in rows as narrow as its own columns, and all of them are partitioned by the key, so that
    the joins need no further exchange. Columns named in ``zero`` are 0 for a parent without rows in their table.
    In ``steps`` what comes of each table is settled, so the exchanges of one table go before those of the next.
    """
    joined = parents.select(key).distinct()
    for name, (rows, values) in parts.items():
        grouped = rows.groupBy(key).agg(*[v.alias(n) for n, v in values.items()], F.lit(True).alias(f"_has_{name}"))
        grouped = settle(grouped) if steps else grouped
        joined = joined.join(grouped, key, "left")
    any_child = reduce(Column.__or__, [F.col(f"_has_{name}").isNotNull() for name in parts])
    names = [n for _, values in parts.values() for n in values]
    return joined.filter(any_child).select(
        key, *[(F.coalesce(F.col(n), F.lit(0)).alias(n) if n in zero else F.col(n)) for n in names]
    )


def payment_rows(payments: DataFrame, details: DataFrame, name: str = "project_id", only: DataFrame | None = None) -> DataFrame:
    """(project, payment_type_id, total_amount) of own payments and of the payments hanging below them.

    A payment counts by its latest detail, on its first installment and outside
    the excluded states. ``only`` names the projects wanted; their own payments are looked up first,
    then what hangs below those, so nothing else is joined.
    """
    details = details.select(
        F.col("payment_detail_id").alias("most_recent_detail_id"), "parent_payment_id", F.col("component_project_id").alias(name),
        "payment_type_id", "payment_status_id", "installment_number", "total_amount",
    )
    payments = payments.select("payment_id", "most_recent_detail_id")
    counts = (F.col("installment_number") == 1) & ~F.col("payment_status_id").isin(*fixed.PAYMENT_EXCLUDED)
    of_projects = details.filter(F.col(name).isNotNull())
    if only is not None:
        of_projects = of_projects.join(only.select(F.col(only.columns[0]).alias(name)), name, "left_semi")
    own = payments.join(of_projects, "most_recent_detail_id")
    parents = own.select(F.col("payment_id").alias("parent_payment_id"), name)
    below = details.filter(counts).drop(name).join(parents, "parent_payment_id").join(
        payments.select("most_recent_detail_id"), "most_recent_detail_id"
    )
    columns = (name, "payment_type_id", "total_amount")
    return own.filter(counts).select(*columns).unionByName(below.select(*columns))


def cost_columns(classes: dict[str, Sequence[int] | None]) -> dict[str, Column]:
    """Sums over payment rows; ``classes`` maps a column to payment types (None: all)."""
    amount = F.col("total_amount")
    return {
        column: F.coalesce(
            F.sum(amount if types is None else F.when(F.col("payment_type_id").isin(*types), amount)), F.lit(0).cast("decimal(18,2)")
        )
        for column, types in classes.items()
    }


def payment_costs(
    payments: DataFrame, details: DataFrame, classes: dict[str, Sequence[int] | None], name: str = "project_id",
    only: DataFrame | None = None,
) -> DataFrame:
    """Cost columns per project, see ``payment_rows`` and ``cost_columns``."""
    rows = payment_rows(payments, details, name, only)
    return rows.groupBy(name).agg(*[v.alias(n) for n, v in cost_columns(classes).items()])


def tri_state_count(known: Column, counted: Column) -> Column:
    """Null when no row is known, else the number of counted rows."""
    return F.when(F.count(F.when(known, 1)) > 0, count_where(counted))


def cutoff_max(
    events: DataFrame, key: str, value: Column, counted: Column, limit: Column, limiting: Column, name: str
) -> DataFrame:
    """Per key the greatest value of the counted rows that is not after the smallest limit
    of the limiting rows; null without a limit."""
    limits = events.filter(limiting).groupBy(key).agg(F.min(limit).alias("_limit"))
    rows = events.filter(counted).withColumn("_value", value)
    return rows.join(limits, key).groupBy(key).agg(
        F.max(F.when(F.col("_value") <= F.col("_limit"), F.col("_value"))).alias(name)
    )


def points_ledger(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per key of (amount, is_potential, taxable, placed, final_score) rows.

    Potential points are kept apart from awarded ones; the placed results are
    summed up (count, best place, best score) and stay rows of their own.
    """
    potential = F.coalesce(F.col("is_potential"), F.lit(False))
    awarded, taxable = ~potential, F.coalesce(F.col("taxable"), F.lit(False))
    placed = F.coalesce(F.col("placed"), F.lit(0)) > 0
    zero = F.lit(0).cast("decimal(18,2)")
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("amount"))), zero)
    return points.groupBy(*keys).agg(
        total(awarded).alias("initial_points"),
        total(awarded).alias("final_points"),
        total(awarded & taxable).alias("taxable_points"),
        total(potential).alias("potential_points"),
        F.count(F.when(placed, 1)).alias("placed_results"),
        F.min(F.when(placed, F.col("placed"))).alias("best_place"),
        F.max(F.when(placed, F.col("final_score"))).alias("best_score"),
    )


def daily_stats(projects: DataFrame) -> DataFrame:
    """Cost, minutes, completed and total projects per direct project, category and day of completion."""
    counted = projects.filter(
        F.col("complete_date").isNotNull() & (F.col("tc_direct_project_id") > 0) & F.col("posting_date").isNotNull()
    )
    minutes = F.timestamp_diff("MINUTE", F.col("posting_date"), F.col("complete_date"))
    return counted.groupBy(
        F.col("tc_direct_project_id").alias("direct_project_id"),
        "project_category_id",
        F.date_trunc("day", "complete_date").cast("timestamp_ntz").alias("stat_date"),
    ).agg(
        F.sum(F.col("admin_fee").cast("decimal(18,2)") + F.col("contest_prizes_total").cast("decimal(18,2)")).alias("cost"),
        F.sum(minutes).alias("duration"),
        count_where(F.col("status_id") == fixed.STATUS_COMPLETED).alias("fulfillment"),
        F.count(F.lit(1)).alias("total_project"),
    )
