"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes is summed to signed deltas per key (+1 document and its tokens for an
insert, the opposite for a delete, the difference for a revised count) and committed
under its batch id: written beside the table, then moved into place in one step that
fails if the id is there. So a batch that is applied again, by a retry or twice at once,
changes nothing. Committed batches are folded into a base of totals that names the batches
it holds, in one step as well: totals are the base and the deltas of what it
does not hold. No document is ever read again, and no batch more than once or twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm.tokens import count_ordinary

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, docs long, tokens long"
# Batches beside the base after which they are folded into it.
FOLD_AFTER = 16


def signed(changes: DataFrame) -> DataFrame:
    """Signed deltas (source, lang, version, docs, tokens) of changes.

    ``changes``: source, lang, version, ``op`` ("insert", "delete" or "revise"), ``tokens`` (the new
    count) and ``old_tokens`` (the count taken back by a delete or revised). A null
    count is 0, null keys are a key of their own, any other ``op`` fails the job.
    Repeated rows count as often as they occur. Other columns are not read.
    """
    new, old = F.coalesce("tokens", F.lit(0)).cast("long"), F.coalesce("old_tokens", F.lit(0)).cast("long")
    docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0).otherwise(
        F.raise_error(F.concat(F.lit("unknown change "), F.coalesce(F.col("op").cast("string"), F.lit("null"))))
    )
    tokens = F.when(F.col("op") == "insert", new).when(F.col("op") == "delete", -old).otherwise(new - old)
    return changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))


class TokenRollup:
    """The rollup in a folder on any file system all executors share."""

    def __init__(self, spark: SparkSession, root: str, fold_after: int = FOLD_AFTER):
        self.spark, self.root, self.fold_after = spark, root.rstrip("/"), fold_after
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Names of the committed batches, as folders."""
        files, folder = self._files(), self._path("committed")
        return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit a batch; False if it was committed before, then nothing is computed."""
        name = f"batch={quote(str(batch_id), safe='')}"
        files, final = self._files(), self._path(f"committed/{name}")
        if files.exists(final):
            return False
        staged = f"staged/{uuid4()}"
        signed(changes).write.parquet(f"{self.root}/{staged}")
        if not self._move(staged, "committed", name):
            return False  # somebody else committed the batch meanwhile
        if len(self.batches()) - len(self._base()[1]) >= self.fold_after:
            self.fold()
        return True

    def _move(self, staged: str, folder: str, name: str) -> bool:
        """Move a staged folder into place; False if the place is taken."""
        files, final = self._files(), self._path(f"{folder}/{name}")
        files.mkdirs(self._path(folder))
        context = self._hadoop.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(staged), final, none)
        except Exception:
            if not files.exists(final):
                raise
            files.delete(self._path(staged), True)
            return False
        return True

    def _base(self) -> tuple[str | None, set[str]]:
        """Folder of the latest base and the batches it holds."""
        files, folder = self._files(), self._path("base")
        names = [int(s.getPath().getName()) for s in files.listStatus(folder)] if files.exists(folder) else []
        if not names:
            return None, set()
        latest = f"{self.root}/base/{max(names)}"
        return latest, {r.batch for r in self.spark.read.schema("batch string").parquet(f"{latest}/batches").collect()}

    def _sums(self, base: str | None, rest: list[str]) -> DataFrame:
        parts = ([f"{base}/totals"] if base else []) + [f"{self.root}/committed/{b}" for b in rest]
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        deltas = self.spark.read.schema(SCHEMA).parquet(*parts)
        return deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def fold(self) -> bool:
        """Fold the batches beside the base into a new one; False if another run was first or there are none."""
        base, held = self._base()
        known = self.batches()
        rest = [b for b in known if b not in held]
        if not rest:
            return False
        number, staged = int(base.rpartition("/")[2]) + 1 if base else 0, f"staged/{uuid4()}"
        self._sums(base, rest).write.parquet(f"{self.root}/{staged}/totals")
        names = self.spark.createDataFrame([(b,) for b in sorted(held | set(rest))], "batch string")
        names.coalesce(1).write.parquet(f"{self.root}/{staged}/batches")
        return self._move(staged, "base", str(number))

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over all committed batches; keys without documents and tokens are left out."""
        base, held = self._base()
        return self._sums(base, [b for b in self.batches() if b not in held]).filter("docs <> 0 OR tokens <> 0")


def count_tokens(texts: DataFrame, versions: dict[str, str]) -> DataFrame:
    """All columns of ``texts`` but ``text``, and for each tokenizer version a column with the number of tokens of ``text``.

    ``versions``: name -> path of a rank file. A null or empty text has no tokens.
    """
    kept = [f for f in texts.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{v}` long" for v in versions])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros((len(versions), batch.num_rows), dtype=np.int64)
            for i, text in enumerate(batch.column("text")):
                value = text.as_py()
                for k, path in enumerate(versions.values()):
                    counts[k, i] = count_ordinary(value, path) if value else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(row, pa.int64()) for row in counts],
                names=[f.name for f in kept] + list(versions),
            )

    return texts.mapInArrow(run, schema)
