"""Run loads in order and move the high-water mark when all of them are through."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import datetime, timezone
from importlib import import_module

from pyspark.sql import SparkSession

from loadstone.functions import fixed
from loadstone.operators import changes
from loadstone.operators.report import LoadReport
from loadstone.plans.core import LOADS, Load, LoadContext
from loadstone.session import scratch
from loadstone.sources import Source, Warehouse

log = logging.getLogger("loadstone")


def all_loads() -> dict[str, Load]:
    """Every declared load by name."""
    for module in ("dimensions", "projects", "reviews", "results", "derived"):
        import_module(f"loadstone.plans.{module}")
    return dict(LOADS)


def run_loads(
    spark: SparkSession,
    source: Source,
    warehouse: Warehouse,
    names: Iterable[str] | None = None,
    log_type: int = fixed.DEFAULT_LOG_TYPE,
    start: datetime | None = None,
    options: dict | None = None,
) -> list[LoadReport]:
    """Run the named loads (all by default) by stage.

    Loads of one stage read only tables of earlier stages or their own. The
    mark is the start time and is written last, so after a failed load the
    next run picks up the same changes again.
    """
    start = start or datetime.now(timezone.utc).replace(tzinfo=None)
    hwm = changes.read_hwm(warehouse.table("update_log"), log_type)
    ctx = LoadContext(source.table, warehouse.table, hwm, start, options or {}, warehouse.near)
    known = all_loads()
    chosen = [known[name] for name in names] if names is not None else list(known.values())
    reports = []
    for item in sorted(chosen, key=lambda entry: entry.stage):
        with scratch(spark):
            # All tables of a load are computed before one is replaced: they may read each other.
            done = []
            for table, write in item.run(ctx).items():
                report = LoadReport(table)
                staged = warehouse.stage(table, report.watch(write.rows), write.mode, write.touched)
                report.written = staged is not None
                log.info("%s", report.finish())
                done.append(staged)
                reports.append(report)
            for staged in filter(None, done):
                warehouse.commit(staged)
    row = changes.commit_hwm(warehouse.table("update_log"), warehouse.table("calendar"), start, log_type)
    warehouse.write("update_log", row, "append")
    return reports
