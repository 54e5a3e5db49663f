"""Joins of the loads: lookups, attribute pivots, ranges, related rows.

No broadcast hints: Spark broadcasts a side by its measured size and otherwise
sort-merges with run-time skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstone.functions.scalar import operation_amount
from loadstone.operators.sequences import scan
from loadstone.session import settle


def pivot_attributes(
    attributes: DataFrame, key: str, names: dict[str, int], type_column: str, value_column: str = "value"
) -> DataFrame:
    """Attribute rows to one row per key with a column per named attribute id.

    One pass and one pre-aggregated exchange for any number of attributes;
    of several values of an attribute the greatest text is taken.
    """
    wanted = attributes.filter(F.col(type_column).isin(*names.values()))
    return wanted.groupBy(key).agg(*[
        F.max(F.when(F.col(type_column) == attribute, F.col(value_column))).alias(name)
        for name, attribute in names.items()
    ])


# A sieve spends 8 to 16 bits on a key, in sets of 64 words of 64 bits; it takes 64 MB at most.
SIEVE_SETS = 2**17


@dataclass(frozen=True)
class Sieve:
    """Leaves out most rows of a table that a later join on some keys would drop, before they are exchanged.

    The keys are kept as bits at the places their hashes name. Every row whose key is among them passes, and about
    1 in 10 of the others (more where there are so many keys that the sieve is at its largest), so an exact join
    still has to follow. Spark's own runtime filter is planned for sources behind a filter only.
    """

    sets: DataFrame
    power: int

    @staticmethod
    def of(keys: DataFrame) -> Sieve:
        """Sieve of the one column of settled rows."""
        key = F.col(keys.columns[0])
        number, power = keys.count(), 1
        while 2**power < SIEVE_SETS and 2**power * 64 * 64 < 8 * number:
            power += 1
        # One number a key is exchanged, to the task that makes its set.
        places = keys.filter(key.isNotNull()).select(_place(key, power).alias("_place")).withColumn("_set", F.shiftright("_place", 12))
        words = places.repartition("_set").groupBy("_set", _word("_place").alias("_word")).agg(F.bit_or(_bit("_place")).alias("_bits"))
        kept = words.groupBy("_set").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_by_word"))
        every = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda word: F.coalesce(F.element_at("_by_word", word), F.lit(0).cast("bigint")))
        return Sieve(settle(kept.select("_set", every.alias("_words"))), power)

    def rows(self, df: DataFrame, column: str) -> DataFrame:
        """Rows of the table whose column may be among the keys."""
        place = _place(F.col(column), self.power)
        held = F.element_at("_words", _word(place) + 1).bitwiseAND(_bit(place)) != 0
        return df.join(F.broadcast(self.sets), (F.shiftright(place, 12) == F.col("_set")) & held, "left_semi")


def passing(df: DataFrame, where: Column, sieves: Sequence[tuple[str, Sieve]]) -> DataFrame:
    """Rows where the condition holds or a column may be among the keys of its sieve."""
    rows, held = df, F.coalesce(where, F.lit(False))
    for i, (column, sieve) in enumerate(sieves):
        place = _place(F.col(column), sieve.power)
        sets = sieve.sets.select(F.col("_set").alias(f"_set{i}"), F.col("_words").alias(f"_words{i}"))
        rows = rows.join(F.broadcast(sets), F.shiftright(place, 12) == F.col(f"_set{i}"), "left")
        held = held | F.coalesce(F.element_at(f"_words{i}", _word(place) + 1).bitwiseAND(_bit(place)) != 0, F.lit(False))
    return rows.filter(held).select(*df.columns)


def _place(key: Column, power: int) -> Column:
    """Number of the bit that stands for an id, a whole number of whatever type."""
    return F.shiftrightunsigned(F.xxhash64(key.cast("bigint")), 64 - 12 - power)


def _word(place: Column | str) -> Column:
    place = F.col(place) if isinstance(place, str) else place
    return F.shiftright(place, 6).bitwiseAND(F.lit(63)).cast("int")


def _bit(place: Column | str) -> Column:
    place = F.col(place) if isinstance(place, str) else place
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def lookup(
    df: DataFrame, table: DataFrame, on: dict[str, str], columns: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Add columns of a lookup table; ``on`` maps own column to lookup column,
    ``columns`` maps result name to lookup column."""
    side = table.select(
        *[F.col(theirs).alias(f"_l_{own}") for own, theirs in on.items()],
        *[F.col(theirs).alias(f"_v_{name}") for name, theirs in columns.items()],
    )
    joined = df.join(side, [df[own] == side[f"_l_{own}"] for own in on], how)
    kept = [F.col(c) for c in df.columns if c not in columns]
    return joined.select(*kept, *[F.col(f"_v_{name}").alias(name) for name in columns])


def calendar_lookup(df: DataFrame, calendar: DataFrame, columns: dict[str, str], strict: bool = False) -> DataFrame:
    """Calendar ids of timestamps; ``columns`` maps result name to timestamp column.

    Days are matched by year, month and day of month. A null timestamp stays
    null; a day the calendar lacks is null too, or an error if ``strict``.
    """
    days = calendar.select(
        F.make_date("year", "month_numeric", "day_of_month").alias("_day"), F.col("calendar_id").alias("_id")
    )
    for name, stamp in columns.items():
        side = days.select(F.col("_day").alias(f"_day_{name}"), F.col("_id").alias(f"_id_{name}"))
        df = df.join(side, F.to_date(df[stamp]) == side[f"_day_{name}"], "left").drop(f"_day_{name}")
        df = _resolved(df, name, f"_id_{name}", stamp, strict)
    return df


def time_lookup(df: DataFrame, times: DataFrame, columns: dict[str, str], strict: bool = False) -> DataFrame:
    """Time-of-day ids of timestamps, matched by hour and minute."""
    for name, stamp in columns.items():
        side = times.select(
            F.col("hour_24").alias(f"_h_{name}"), F.col("minute").alias(f"_m_{name}"), F.col("time_id").alias(f"_id_{name}")
        )
        on = (F.hour(df[stamp]) == side[f"_h_{name}"]) & (F.minute(df[stamp]) == side[f"_m_{name}"])
        df = df.join(side, on, "left").drop(f"_h_{name}", f"_m_{name}")
        df = _resolved(df, name, f"_id_{name}", stamp, strict)
    return df


def _resolved(df: DataFrame, name: str, found: str, stamp: str, strict: bool) -> DataFrame:
    value = F.col(found)
    if strict:
        missing = F.raise_error(F.concat(F.lit(f"no {name} for "), F.col(stamp).cast("string"))).cast("int")
        value = F.when(F.col(stamp).isNotNull() & value.isNull(), missing).otherwise(value)
    return df.withColumn(name, value).drop(found)


# Shortest cells of a range join, as a power of two in microseconds (some 18 minutes).
FINEST_LEVEL = 30


def _micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp"))


def range_join(
    points: DataFrame,
    spans: DataFrame,
    point: str,
    start: str,
    end: str,
    on: Sequence[str] = (),
    how: str = "left",
    few: int = 0,
) -> DataFrame:
    """Join points to the spans they fall in, both ends included.

    Time is cut into cells of a power of two at several levels. A span lies on the level whose
    cells are about as long as itself, so it takes two or three cells whether it lasts a minute or
    500 years; a point is looked up once on each level that spans lie on. That
    turns the range into an equality plus a check that at most some cells' worth of spans fail.
    ``on`` adds equal columns; ``how`` is "left" or "inner". Up to ``few`` cells of spans are sent to the points, which stay where
    they are then, with all that the spans make of them.
    """
    on = list(on)
    own = [c for c in spans.columns if c not in on]
    low, high = _micros(F.col(start)), _micros(F.col(end))
    # Even levels only: half as many look-ups for cells at most four times a span.
    level = F.greatest(F.lit(FINEST_LEVEL), (2 * F.ceil(F.log2((high - low + 1).cast("double")) / 2)).cast("int"))
    cells = F.sequence(F.call_function("shiftright", low, F.col("_span_level")), F.call_function("shiftright", high, F.col("_span_level")))
    side = settle(
        spans.filter(F.col(start) <= F.col(end)).select(*[F.col(k).alias(f"_on_{k}") for k in on], *own, level.alias("_span_level"))
        .withColumn("_span_cell", F.explode(cells))
    )
    # At most as many numbers as a time stamp has bits.
    levels = sorted(r[0] for r in side.select("_span_level").distinct().collect()) or [FINEST_LEVEL]
    if few and side.count() <= few:
        side = F.broadcast(side)
    left = how == "left"
    if left and len(levels) > 1:
        points = settle(points.withColumn("_point", F.monotonically_increasing_id()))
    names = [c for c in points.columns if c != "_point"]
    keyed = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0]))
    keyed = keyed.withColumn("_cell", F.call_function("shiftright", _micros(F.col(point)), F.col("_level")))
    condition = (keyed["_cell"] == side["_span_cell"]) & (keyed["_level"] == side["_span_level"])
    condition = condition & (keyed[point] >= side[start]) & (keyed[point] <= side[end])
    for key in on:
        condition = condition & (keyed[key] == side[f"_on_{key}"])
    if not left or len(levels) == 1:
        return keyed.join(side, condition, how).select(*[keyed[c] for c in names], *[side[c] for c in own])
    found = settle(keyed.join(side, condition).select("_point", *[keyed[c] for c in names], *[side[c] for c in own]))
    alone = points.join(found.select("_point").distinct(), "_point", "left_anti")
    nothing = [F.lit(None).cast(side.schema[c].dataType).alias(c) for c in own]
    return found.drop("_point").unionByName(alone.select(*names, *nothing))


def spans_with_points(spans: DataFrame, points: DataFrame, point: str, start: str, end: str) -> DataFrame:
    """Distinct spans in which at least one point falls, both ends included.

    Points are counted up to both ends of a span in one ordered pass, so the work does not grow
    with the number of points in a span.
    """
    ends = [
        spans.filter(F.col(start) <= F.col(end)).select(*spans.columns, _micros(F.col(column)).alias("_moment"), F.lit(kind).alias("_side"), F.lit(0).alias("_one"))
        for column, kind in ((start, 0), (end, 2))
    ]
    marks = points.filter(F.col(point).isNotNull()).select(_micros(F.col(point)).alias("_moment"), F.lit(1).alias("_side"), F.lit(1).alias("_one")).distinct()
    rows = ends[0].unionByName(ends[1]).unionByName(marks, allowMissingColumns=True)
    counted = scan(rows, [], ["_moment", "_side", *spans.columns], sums={"_seen": F.col("_one")}).filter(F.col("_side") != 1)
    found = counted.groupBy(*spans.columns).agg(F.min("_seen").alias("_before"), F.max("_seen").alias("_through"))
    return found.filter(F.col("_through") > F.col("_before")).select(*spans.columns)


def first_related(
    children: DataFrame, parent: str, order: str, columns: dict[str, str]
) -> DataFrame:
    """Per parent the values of its child with the smallest ``order``."""
    picked = F.struct(F.col(order).alias("_o"), *[F.col(c).alias(n) for n, c in columns.items()])
    return children.groupBy(parent).agg(F.min(picked).alias("_first")).select(
        parent, *[F.col(f"_first.{n}").alias(n) for n in columns]
    )


def latest_detail(headers: DataFrame, details: DataFrame, pointer: str, detail_id: str) -> DataFrame:
    """Headers with the one detail they point to."""
    shared = [c for c in details.columns if c in headers.columns and c != detail_id]
    return headers.join(details.drop(*shared), headers[pointer] == details[detail_id])


def parent_value(
    df: DataFrame, key: str, reference: str, value: str, name: str, when: Column, parents: DataFrame | None = None
) -> DataFrame:
    """Value of the row that ``reference`` points to in the same table, where the condition
    holds (null if there is no such row); 0 elsewhere. ``parents`` is the whole table
    where ``df`` is a part of it."""
    parents = (df if parents is None else parents).select(F.col(key).alias("_p"), F.col(value).alias("_pv"))
    # Only rows that point somewhere are joined: the others, without a key, would all meet in one task.
    points = F.coalesce(when, F.lit(False)) & F.col(reference).isNotNull()
    pointed = df.filter(points)
    joined = pointed.join(parents, pointed[reference] == parents["_p"], "left").drop("_p")
    others = df.filter(~points).withColumn("_pv", F.lit(None).cast(parents.schema["_pv"].dataType))
    return joined.unionByName(others).withColumn(name, F.when(when, F.col("_pv")).otherwise(F.lit(0))).drop("_pv")


def with_parent_amount(points: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Points whose percentage operations are resolved against the referenced points."""
    joined = parent_value(
        points, "dr_points_id", "reference_id", "amount", "parent_amount", F.col("dr_points_reference_type_id") == 2, parents
    )
    return joined.withColumn("amount", operation_amount("dr_points_operation_id", "amount", "parent_amount")).drop("parent_amount")


def linked(
    df: DataFrame, links: DataFrame, key: str, source: str, target: str, columns: dict[str, str], partner: Column | None = None
) -> DataFrame:
    """Rows with columns of the row a link table connects them to in the same table."""
    partners = df if partner is None else df.filter(partner)
    side = partners.select(F.col(key).alias("_t"), *[F.col(c).alias(n) for n, c in columns.items()])
    pairs = links.select(F.col(source).alias("_s"), F.col(target).alias("_d"))
    return df.join(pairs, df[key] == pairs["_s"]).join(side, F.col("_d") == F.col("_t")).drop("_s", "_d", "_t")


def exists_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """1 where the keys occur in the other frame, else 0."""
    on = list(on)
    marks = keys.select(*[F.col(k).alias(f"_e_{k}") for k in on]).distinct().withColumn("_found", F.lit(1))
    joined = df.join(marks, [df[k] == marks[f"_e_{k}"] for k in on], "left")
    return joined.withColumn(name, F.coalesce(F.col("_found"), F.lit(0))).select(*dict.fromkeys([*df.columns, name]))


def excluding(df: DataFrame, keys: DataFrame, on: dict[str, str], null_aware: bool = False) -> DataFrame:
    """Rows without a match. ``null_aware`` keeps the rule of NOT IN: one null key
    in the list rejects every row."""
    own, theirs = next(iter(on.items()))
    side = keys.select(F.col(theirs).alias("_x")).distinct()
    if not null_aware:
        return df.join(side, df[own] == side["_x"], "left_anti")
    if not side.filter(F.col("_x").isNull()).isEmpty():
        return df.filter(F.lit(False))
    return df.filter(F.col(own).isNotNull()).join(side, df[own] == side["_x"], "left_anti")


def left_where(df: DataFrame, right: DataFrame, on: Sequence[str], where: Column | None = None) -> DataFrame:
    """Left join to the filtered right side: conditions on the optional side never drop rows."""
    side = right if where is None else right.filter(where)
    return df.join(side, list(on), "left")
