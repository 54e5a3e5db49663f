"""Incremental change capture by a high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions import fixed

EPOCH = datetime(1970, 1, 1)


def _mark(hwm) -> Column:
    return F.lit(hwm).cast("timestamp_ntz")


def high_water_marks(run_log: DataFrame) -> DataFrame:
    """Mark per log type: the timestamp of its row with the largest log id."""
    return run_log.groupBy("log_type_id").agg(F.max_by("log_timestamp", "log_id").alias("log_timestamp"))


def read_hwm(run_log: DataFrame, log_type: int = fixed.DEFAULT_LOG_TYPE) -> datetime | None:
    """The mark of one log type; an error if that type never ran."""
    row = high_water_marks(run_log.filter(F.col("log_type_id") == log_type)).first()
    if row is None:
        raise LookupError(f"no run of log type {log_type} in the run log")
    return row["log_timestamp"]


def commit_hwm(run_log: DataFrame, calendar: DataFrame, start: datetime, log_type: int = fixed.DEFAULT_LOG_TYPE) -> DataFrame:
    """The one run-log row that records a finished run by its start time.

    The start day has to be in the calendar.
    """
    day = calendar.filter(
        (F.col("year") == start.year) & (F.col("month_numeric") == start.month) & (F.col("day_of_month") == start.day)
    ).agg(F.max("calendar_id").alias("calendar_id"))
    checked = day.select(
        F.coalesce(
            F.col("calendar_id"), F.raise_error(F.lit(f"no calendar row for {start:%Y-%m-%d}")).cast("int")
        ).alias("calendar_id")
    ).first()["calendar_id"]
    row = run_log.agg(F.coalesce(F.max("log_id") + 1, F.lit(1)).alias("log_id")).select(
        "log_id",
        F.lit(checked).alias("calendar_id"),
        _mark(start).alias("log_timestamp"),
        F.lit(log_type).alias("log_type_id"),
    )
    types = {f.name: f.dataType for f in run_log.schema}
    return row.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in row.columns])


def mark_or_epoch(hwm: datetime | None) -> datetime:
    return hwm if hwm is not None else EPOCH


def is_changed(hwm, *stamps: str | Column, inclusive: Sequence[str | Column] = ()) -> Column:
    """True where any stamp is after the mark (at or after it for the inclusive ones).

    Plain comparisons joined with OR, which a scan takes as a pushed filter. Null,
    which a filter takes as false, where a stamp is missing and no other is late.
    """
    column = lambda stamp: F.col(stamp) if isinstance(stamp, str) else stamp
    parts = [column(s) > _mark(hwm) for s in stamps] + [column(s) >= _mark(hwm) for s in inclusive]
    condition = parts[0]
    for part in parts[1:]:
        condition = condition | part
    return condition


def needs_migrated(hwm, cutover: str = fixed.MIGRATION_CUTOVER) -> bool:
    """True as long as rows of the old system may still be missing."""
    return hwm is None or hwm < datetime.fromisoformat(cutover)


def not_migrated(
    hwm, *users: str | Column, marker: str = fixed.MIGRATION_USER, cutover: str = fixed.MIGRATION_CUTOVER
) -> Column:
    """Extra condition while the migration is open: a row the migration did not write."""
    condition = F.lit(False)
    if needs_migrated(hwm, cutover):
        for user in users:
            col = F.col(user) if isinstance(user, str) else user
            condition = condition | F.coalesce(col != marker, F.lit(False))
    return condition


def changed_rows(df: DataFrame, hwm, *stamps: str) -> DataFrame:
    return df.filter(is_changed(hwm, *stamps))


def changed_keys(sources: Sequence[tuple[DataFrame, str, Sequence[str]]], hwm, name: str) -> DataFrame:
    """Distinct keys touched in any source; each is (frame, key column, its stamps).

    Each branch reads its own key and stamps only. The stamp comparisons are
    joined with OR rather than ``greatest`` so that they reach the scan.
    """
    parts = []
    for frame, key, stamps in sources:
        condition = F.lit(False)
        for stamp in stamps:
            condition = condition | (F.col(stamp) > _mark(hwm))
        parts.append(frame.filter(condition).select(F.col(key).alias(name)))
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part)
    return keys.filter(F.col(name).isNotNull()).distinct()


def changed_by_child(parent: DataFrame, child: DataFrame, key: str, child_key: str, stamp: str, hwm) -> DataFrame:
    """Parents whose latest child stamp is after the mark."""
    latest = child.groupBy(F.col(child_key).alias(key)).agg(F.max(stamp).alias("_latest"))
    return parent.join(latest.filter(F.col("_latest") > _mark(hwm)), key, "left_semi")


def is_first_run(target: DataFrame) -> bool:
    return target.isEmpty()
