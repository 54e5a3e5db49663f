"""Table sources and sinks.

A warehouse table is a folder of Parquet files, partitioned by a bucket of the key where
the table is large. New rows of a table are staged before anything is replaced, as a load may read the
table it writes: a whole table is swapped for its staged folder, touched buckets are
overwritten by Spark's dynamic partition overwrite. A load that fails leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from loadstone.session import files_of, settle


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """One table from files or, with ``fmt="jdbc"``, from a database.

    A JDBC read takes ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to be split over tasks; ``path`` is then the table name.
    """
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "jdbc":
        return reader.option("dbtable", path).load()
    return reader.load(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Write a table; ``mode="replace_partitions"`` overwrites only the partitions in ``df``."""
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "replace_partitions":
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").save(path)
    else:
        writer.mode(mode).save(path)


class Source:
    """Tables of one or more source systems, told apart by a namespace.

    ``add`` registers a namespace with a reader of its table names; ``table``
    takes ``namespace.table``. ``register`` makes them SQL views named
    ``namespace__table`` for queries over several systems.
    """

    def __init__(self, spark: SparkSession, default: str = "main"):
        self.spark = spark
        self.default = default
        self._readers: dict[str, Callable[[str], DataFrame]] = {}

    def add(self, namespace: str, reader: Callable[[str], DataFrame]) -> "Source":
        self._readers[namespace] = reader
        return self

    def add_folder(self, namespace: str, folder: str, fmt: str = "parquet", suffix: str = ".parquet", **options) -> "Source":
        return self.add(
            namespace, lambda name: read_table(self.spark, f"{folder.rstrip('/')}/{name}{suffix}", fmt, **options)
        )

    def add_database(self, namespace: str, url: str, **options) -> "Source":
        return self.add(namespace, lambda name: read_table(self.spark, name, "jdbc", url=url, **options))

    def table(self, name: str) -> DataFrame:
        namespace, _, table = name.rpartition(".")
        return self._readers[namespace or self.default](table)

    def register(self, *names: str) -> None:
        for name in names:
            self.table(name).createOrReplaceTempView(name.replace(".", "__"))


BUCKET = "_bucket"


@dataclass
class Staged:
    """New rows of a table, computed but not yet visible: a folder to swap in, or rows for some buckets."""

    name: str
    mode: str
    folder: str | None = None
    rows: DataFrame | None = None
    buckets: list[int] | None = None


class Warehouse:
    """Target tables under one folder on any file system Spark can reach.

    ``buckets`` maps tables to (key columns, number of buckets): their rows lie in
    partitions by a hash of the key. A write that says which keys it touched rewrites
    their buckets only, and ``near`` reads these only.
    """

    def __init__(
        self, spark: SparkSession, root: str, schemas: dict | None = None, buckets: dict[str, tuple[Sequence[str], int]] | None = None
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas or {}
        self.buckets = buckets or {}

    def _path(self, name: str) -> str | None:
        """Folder of a table; the one set aside if a swap was cut short."""
        for path in (f"{self.root}/{name}", f"{self.root}/_old_{name}"):
            folder, files = files_of(self.spark, path)
            if files.exists(folder):
                return path
        return None

    def _schema(self, name: str) -> StructType | None:
        schema = self.schemas.get(name)
        return StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _bucket(self, name: str, frame: DataFrame):
        keys, count = self.buckets[name]
        return F.pmod(F.xxhash64(*[frame[k].cast("string") for k in keys]), F.lit(count)).cast("int")

    def exists(self, name: str) -> bool:
        return self._path(name) is not None

    def _read(self, name: str) -> DataFrame:
        """The table with its bucket column, if it has buckets."""
        path, schema = self._path(name), self._schema(name)
        if schema is not None and name in self.buckets:
            schema = StructType(list(schema.fields)).add(BUCKET, IntegerType())
        if path is None:
            if schema is None:
                raise LookupError(f"no table {name} in {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        return (reader if schema is None else reader.schema(schema)).parquet(path)

    def table(self, name: str) -> DataFrame:
        """The whole table; an empty one if it was never written and its schema is known."""
        return self._read(name).drop(BUCKET)

    def near(self, name: str, touched: DataFrame) -> DataFrame:
        """The rows in the buckets of the touched keys, by a partition filter; all rows of a table without buckets.

        ``touched`` has the key columns of the table.
        """
        if name not in self.buckets:
            return self.table(name)
        return self._read(name).filter(F.col(BUCKET).isin(self._hit(name, touched))).drop(BUCKET)

    def _hit(self, name: str, touched: DataFrame) -> list[int]:
        """Buckets of the touched keys: at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in touched.select(self._bucket(name, touched)).distinct().collect())

    def stage(self, name: str, df: DataFrame, mode: str = "snapshot", touched: DataFrame | None = None) -> Staged | None:
        """Compute new rows without making them visible; ``commit`` does.

        ``snapshot`` replaces the table by ``df``, ``append`` adds its rows. ``touched`` names (in its key columns)
        all keys whose rows may differ from the current ones; of a table in buckets only their buckets are then
        taken from ``df``, which need not hold others. None if there are none.
        """
        df = self._typed(name, df)
        if name in self.buckets:
            df = df.withColumn(BUCKET, self._bucket(name, df))
            if mode != "append" and touched is not None and self.exists(name):
                hit = self._hit(name, touched)
                return Staged(name, mode, rows=settle(df.filter(F.col(BUCKET).isin(hit))), buckets=hit) if hit else None
        if mode == "append":
            return Staged(name, mode, rows=settle(df))
        folder = f"{self.root}/_staged_{name}-{uuid4()}"
        write_table(df, folder, "errorifexists", self._partitions(name))
        return Staged(name, mode, folder=folder)

    def _partitions(self, name: str) -> list[str]:
        return [BUCKET] if name in self.buckets else []

    def commit(self, staged: Staged) -> None:
        final = f"{self.root}/{staged.name}"
        if staged.folder is not None:
            self._swap(staged.folder, staged.name)
        elif staged.mode == "append":
            write_table(staged.rows, final, "append", self._partitions(staged.name))
        else:
            write_table(staged.rows, final, "replace_partitions", [BUCKET])
            # Overwriting leaves a bucket alone that has no rows any more.
            filled = {r[0] for r in staged.rows.select(BUCKET).distinct().collect()}
            for bucket in set(staged.buckets) - filled:
                folder, files = files_of(self.spark, f"{final}/{BUCKET}={bucket}")
                files.delete(folder, True)

    def _swap(self, staged: str, name: str) -> None:
        new, files = files_of(self.spark, staged)
        final, _ = files_of(self.spark, f"{self.root}/{name}")
        old, _ = files_of(self.spark, f"{self.root}/_old_{name}")
        if files.exists(final):
            files.delete(old, True)
            if not files.rename(final, old):
                raise OSError(f"{name} was not set aside")
        if not files.rename(new, final):
            raise OSError(f"{name} was not put in place")
        files.delete(old, True)

    def write(self, name: str, df: DataFrame, mode: str = "snapshot", touched: DataFrame | None = None) -> bool:
        """Stage and commit; False if no key was touched, then nothing is written."""
        staged = self.stage(name, df, mode, touched)
        if staged is not None:
            self.commit(staged)
        return staged is not None

    def _typed(self, name: str, df: DataFrame) -> DataFrame:
        """Columns in the types the table declares, so that all its files agree."""
        schema = self._schema(name)
        if schema is None:
            return df
        types = {f.name: f.dataType for f in schema}
        return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])

    def split(self, rows: DataFrame, parts: dict[str, Sequence[str]], keys: Sequence[str] = ()) -> dict[str, DataFrame]:
        """One set of rows feeding several tables: a projection each."""
        return {name: rows.select(*columns) for name, columns in parts.items()}
