"""Write modes as snapshots: (old target, changes) -> new target.

Nothing here writes. The target is read once or twice but exchanged as little
as possible: the joins are left joins and left anti joins with the changes on
the right, so a small change set is broadcast by its measured size and a
large one falls back to a sort-merge join that splits hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.operators.sequences import same_keys
from loadstone.session import settle


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one greatest by ``order`` (then by the other columns).

    An aggregate rather than a window: a key with many rows is reduced to one
    before the exchange.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    lead = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*lead, *[F.col(c) for c in rest])).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def last_per_settled(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``last_per_key`` of settled rows whose keys seldom repeat: the keys alone are counted, and only rows of repeated keys are grouped."""
    names = {k: f"_r_{k}" for k in keys}
    repeated = settle(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select(*[F.col(k).alias(n) for k, n in names.items()])
    )
    if repeated.isEmpty():
        return df
    on = same_keys(df, repeated, keys, names)
    return df.join(repeated, on, "left_anti").unionByName(last_per_key(df.join(repeated, on, "left_semi"), keys, order))


def _like(df: DataFrame, target: DataFrame) -> DataFrame:
    """Columns and types of the target; what is missing becomes null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema
    ])


# Keys above which a set of changes is never sent to all tasks, however few bytes they take in files.
MANY_KEYS = 1_000_000


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    update: Sequence[str] | None = None,
    settled: bool = False,
) -> DataFrame:
    """Update rows by key, insert the rest; of several changes of a key the last by ``order`` wins.

    ``update`` names the columns a match overwrites. Columns the changes do
    not have keep their value on a match and are null on an insert. ``settled`` says that
    reading the changes several times costs little.
    """
    keys = list(keys)
    # Sizes of settled files say little of the rows: many keys in few bytes would be sent to the driver and all tasks.
    many = settled and changes.count() > MANY_KEYS
    changed_keys = changes.select(*keys).hint("merge") if many else changes.select(*keys)
    changes = (last_per_settled if settled else last_per_key)(changes, keys, order)
    settable = [c for c in target.columns if c not in keys and c in changes.columns]
    update = settable if update is None else list(update)
    if set(update) == set(target.columns) - set(keys):
        kept = target.join(changed_keys, keys, "left_anti").select(*target.columns)
        return kept.unionByName(_like(changes, target))
    new_values = changes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in update], F.lit(True).alias("_hit")
    )
    new_values = new_values.hint("merge") if many else new_values
    on = [target[k] == new_values[f"_k_{k}"] for k in keys]
    types = {f.name: f.dataType for f in target.schema}
    updated = target.join(new_values, on, "left").select(*[
        F.when(F.col("_hit"), F.col(f"_n_{c}").cast(types[c])).otherwise(target[c]).alias(c) if c in update else target[c]
        for c in target.columns
    ])
    present = target.select(*keys).join(changed_keys, keys, "left_semi")
    inserted = changes.join(present, keys, "left_anti")
    return updated.unionByName(_like(inserted, target))


def upsert_guarded(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], parent: DataFrame, on: Sequence[str], **options
) -> DataFrame:
    """Upsert of the changes whose parent is already in the warehouse."""
    on = list(on)
    return upsert(target, changes.join(parent.select(*on), on, "left_semi"), keys, **options)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail while the rows are read if a key occurs twice; else pass the rows on.

    Meant for update-exactly-one-row checks on a key: rows are compared by the
    number of rows of their key, which is pre-aggregated.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
    checked = df.join(counts, keys, "left")
    return checked.filter(
        F.when(F.col("_times") > 1, F.raise_error(F.lit("more than one row for a key")).cast("boolean")).otherwise(True)
    ).select(*df.columns)


def replace_by_key(
    target: DataFrame, new_rows: DataFrame, keys: Sequence[str], touched: DataFrame | None = None, few: int = 0
) -> DataFrame:
    """Drop all target rows of the touched keys and add the new rows.

    Without ``touched`` the keys of the new rows count, so a key that lost all
    its rows keeps the old ones. Up to ``few`` touched keys, settled, are sent to the target, whose rows stay where they are.
    """
    keys = list(keys)
    gone = (new_rows if touched is None else touched).select(*keys).distinct()
    if few and touched is not None and touched.count() <= few:
        gone = F.broadcast(gone)
    return target.join(gone, keys, "left_anti").select(*target.columns).unionByName(_like(new_rows, target))


def delete_keys(target: DataFrame, gone: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Drop target rows whose ``column`` is among the given keys."""
    key = key or gone.columns[0]
    return target.join(gone.select(F.col(key).alias(column)).distinct(), column, "left_anti").select(*target.columns)


def cascade_delete(
    tables: dict[str, DataFrame], rules: Iterable[tuple[str, str]], gone: DataFrame
) -> dict[str, DataFrame]:
    """Drop the keys from every (table, column) of the rules; other tables stay."""
    result = dict(tables)
    for table, column in rules:
        if table in result:
            result[table] = delete_keys(result[table], gone, column)
    return result


def append_new(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to append: those not in the target yet, each once. Null keys compare as equal."""
    rows = rows.dropDuplicates(list(keys))
    return _like(rows.join(target, same_keys(rows, target, keys), "left_anti"), target)


def backfill(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill new columns of all rows from the source, but only while no row has the first of them.

    Rows the source does not know keep what they have.
    """
    keys, columns = list(keys), list(columns)
    return upsert_columns(target, source, keys, columns) if is_unfilled(target, columns[0]) else target


def is_unfilled(target: DataFrame, column: str) -> bool:
    """True while no row has a value in the column; ask before computing what would fill it."""
    return target.filter(F.col(column).isNotNull()).isEmpty()


def upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Overwrite columns of the rows whose key the source has; ``source`` is unique by key."""
    new = source.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    types = {f.name: f.dataType for f in target.schema}
    return target.join(new, [target[k] == new[f"_k_{k}"] for k in keys], "left").select(*[
        F.when(F.col("_hit"), F.col(f"_n_{c}").cast(types[c])).otherwise(target[c]).alias(c) if c in columns else target[c]
        for c in target.columns
    ])


def annotate(target: DataFrame, values: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set columns of every row from ``values`` (unique by key); a row without values gets null."""
    keys = list(keys)
    kept = [c for c in target.columns if c not in columns]
    return target.select(*kept).join(values.select(*keys, *columns), keys, "left").select(
        *dict.fromkeys([*target.columns, *columns])
    )


def set_where(target: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """Set columns of the rows that meet the condition; the others keep theirs (null if new)."""
    met = F.coalesce(condition, F.lit(False))
    return target.withColumns({
        name: F.when(met, value).otherwise(F.col(name) if name in target.columns else F.lit(None))
        for name, value in values.items()
    })
