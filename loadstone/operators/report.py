"""Rows and seconds of a load."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class LoadReport:
    """Counts rows while they are written, without another pass over them."""

    name: str
    seconds: float = 0.0
    written: bool = True
    _observation: Observation = field(default_factory=Observation)
    _start: float = field(default_factory=time.monotonic)

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"))

    def finish(self) -> "LoadReport":
        self.seconds = time.monotonic() - self._start
        return self

    @property
    def rows(self) -> int:
        # What was never written was never counted, and asking would wait for it.
        return int(self._observation.get["rows"]) if self.written else 0

    def __str__(self) -> str:
        return f"loaded {self.rows} records of {self.name} in {self.seconds:.1f} seconds"


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of several frames in one result."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in frames.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
