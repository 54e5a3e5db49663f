"""Ordered work inside groups: numbering, running sums, lags, runs, ranks, streaks.

A window puts a whole group into one task, which fails once one group holds a
large part of the table. ``scan`` therefore range partitions the rows by group and
order, once, so that a group spreads over as many pieces as it needs. Each piece is worked on
by itself. Only its first and its last group can go on in other pieces, so these are
summed up: rows, sums, last values, first row, start of the last run. The summaries
combine from piece to piece, and the groups at the borders get what their pieces
before them add up to. There is one path for groups of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstone.functions import fixed
from loadstone.session import settle


def _cols(items) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], right_names: dict[str, str] | None = None):
    """Null-safe equality on the keys."""
    names = right_names or {}
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[names.get(key, key)])
    return condition


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


# What a row is to its piece.
FIRST_OF_PIECE, LAST_OF_FIRST_GROUP, LAST_OF_PIECE = 1, 2, 4


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    *,
    number: str | None = None,
    sums: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    runs: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ordered columns per group of ``keys``; ``order`` must be total within a group.

    ``number``: 1-based position. ``lags``: value of the row before, null on the first.
    ``sums``: running sum up to and including the row (null adds nothing).
    ``totals``: sum over the whole group. ``runs``: number of the row that began the row's
    run; a run begins with the group and where the condition holds. Sums, totals and
    runs may refer to the columns that ``lags`` adds. No keys means one group.
    The rows are spread over the session's shuffle partitions.
    """
    sums, lags, totals, runs = sums or {}, lags or {}, totals or {}, runs or {}
    keys, order = list(keys), _cols(order)
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values, first = {**sums, **totals}, F.col("_number") == 1
    through = Window.partitionBy("_piece").orderBy(*keys, *order)
    group = Window.partitionBy("_piece", *keys)
    ordered = group.orderBy(*order)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The second exchange only hands each piece on as it is; both windows share its one sort.
    rows = df.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id())
    rows = rows.repartitionById(pieces, "_piece").select(
        "*", F.row_number().over(through).alias("_at"), F.lead(F.lit(1)).over(through).isNull().alias("_end")
    ).select(
        "*", F.row_number().over(ordered).cast("bigint").alias("_number"), F.count(F.lit(1)).over(group).alias("_size"),
        *[F.lag(value).over(ordered).alias(name) for name, value in lags.items()],
    )
    edge = [
        (F.col("_at") == 1, FIRST_OF_PIECE), ((F.col("_at") == F.col("_number")) & (F.col("_number") == F.col("_size")), LAST_OF_FIRST_GROUP),
        (F.col("_end"), LAST_OF_PIECE),
    ]
    rows = rows.select(
        *df.columns, "_piece", "_number", *lags, sum((F.when(c, v).otherwise(0) for c, v in edge), F.lit(0)).alias("_edge"),
        *[_zero(value).alias(f"_value_{n}") for n, value in values.items()],
        *[F.when(first | F.coalesce(starts, F.lit(False)), F.col("_number")).alias(f"_start_{n}") for n, starts in runs.items()],
    )
    # Settled, as a range exchange that runs again may put the borders elsewhere.
    local = settle(rows.select(
        *df.columns, "_piece", "_number", *lags, "_edge",
        *[F.sum(f"_value_{n}").over(running).alias(f"_sum_{n}") for n in sums],
        *[F.sum(f"_value_{n}").over(group).alias(f"_sum_{n}") for n in totals],
        *[F.max(f"_start_{n}").over(running).alias(f"_from_{n}") for n in runs],
    ))

    # At most two rows per piece from here on: the last rows of its first and of its last group.
    carry = local.filter(F.col("_edge") >= LAST_OF_FIRST_GROUP)
    whole = Window.partitionBy(*keys)
    by_piece = whole.orderBy("_piece")
    before = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(
        *keys, "_piece", _zero(F.sum("_number").over(before)).alias("_done"), *[f"_sum_{n}" for n in values],
        *[F.lag(value).over(by_piece).alias(f"_prev_{n}") for n, value in lags.items()],
        *[f"_from_{n}" for n in runs], F.col("_edge").bitwiseAND(LAST_OF_FIRST_GROUP).alias("_heads"),
    )
    if lags and (values or runs):
        # The first row of a piece is judged anew, with the value of the piece before.
        heads = local.filter(F.col("_edge") % 2 == FIRST_OF_PIECE).select(
            F.col("_piece").alias("_head_piece"), *[c for c in df.columns if c not in keys], F.lit(True).alias("_head")
        )
        carry = carry.join(F.broadcast(heads), (F.col("_piece") == F.col("_head_piece")) & (F.col("_heads") > 0), "left")
        nothing = [F.lit(None).cast(local.schema[n].dataType).alias(n) for n in lags]
        carry = carry.select("*", *nothing)
        carry = carry.select("*", *[_zero(v).alias(f"_alone_{n}") for n, v in values.items()]).withColumns({n: F.col(f"_prev_{n}") for n in lags})
        moved = {n: F.when(F.col("_head"), _zero(v) - F.col(f"_alone_{n}")).otherwise(0) for n, v in values.items()}
    else:
        moved = {n: F.lit(0) for n in values}
    one, opens = F.col("_done") + 1, F.col("_done") == 0
    carry = carry.select(
        *keys, "_piece", "_done", *[F.col(f"_prev_{n}") for n in lags],
        *[m.alias(f"_move_{n}") for n, m in moved.items()], *[(F.col(f"_sum_{n}") + m).alias(f"_sum_{n}") for n, m in moved.items()],
        *[F.when(opens | F.coalesce(starts, F.lit(False)), one).alias(f"_opens_{n}") for n, starts in runs.items()],
        *[f"_from_{n}" for n in runs],
    ).select(
        "*", *[F.when(F.col(f"_from_{n}") > 1, F.col("_done") + F.col(f"_from_{n}")).otherwise(F.col(f"_opens_{n}")).alias(f"_latest_{n}") for n in runs]
    )
    carry = carry.select(
        *[F.col(k).alias(f"_key_{k}") for k in ["_piece", *keys]], "_done", *[f"_prev_{n}" for n in lags],
        *[(_zero(F.sum(f"_sum_{n}").over(before)) + F.col(f"_move_{n}")).alias(f"_add_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"_total_{n}") for n in totals],
        *[F.coalesce(f"_opens_{n}", F.last(f"_latest_{n}", ignorenulls=True).over(before)).alias(f"_since_{n}") for n in runs],
    )

    on = same_keys(local, carry, ["_piece", *keys], {k: f"_key_{k}" for k in ["_piece", *keys]})
    joined = local.join(F.broadcast(carry), on, "left")
    out = [(F.col("_number") + _zero(F.col("_done"))).alias(number)] if number else []
    out += [F.when(first, F.col(f"_prev_{n}")).otherwise(F.col(n)).alias(n) for n in lags]
    out += [(F.col(f"_sum_{n}") + _zero(F.col(f"_add_{n}"))).alias(n) for n in sums]
    out += [F.coalesce(f"_total_{n}", f"_sum_{n}").alias(n) for n in totals]
    out += [
        F.when(F.col(f"_from_{n}") == 1, F.coalesce(f"_since_{n}", F.lit(1)))
        .otherwise(F.col(f"_from_{n}") + _zero(F.col("_done"))).cast("bigint").alias(n)
        for n in runs
    ]
    return joined.select(*[F.col(c) for c in df.columns], *out)


# --- ranks ---------------------------------------------------------------------


def _percentile(rank: str, size: str) -> Column:
    return 100 * ((F.col(size) - F.col(rank)).cast("double") / F.col(size))


def _ranked(df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str | Column], rank: str, size: str, number: str | None) -> DataFrame:
    """Competition rank, size of the group and, by ``ties``, the place without ties, all from one scan."""
    differs = ~F.col(value).eqNullSafe(F.col("_before"))
    return scan(
        df, keys, [F.col(value).desc(), *ties], number=number,
        lags={"_before": F.col(value)}, runs={rank: differs}, totals={size: F.lit(1)},
    ).drop("_before")


def rank_with_ties(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    rank: str = "rank",
    size: str | None = None,
    percentile: str | None = None,
) -> DataFrame:
    """Competition rank by descending value: equal values share the first position.

    The rank is the number of the row that began the run of equal values. Equal values
    are spread by a hash of their rows, so neither a large group nor a value half the rows share
    lands in one task. ``percentile`` is 100 * (size - rank) / size.
    """
    ranked = _ranked(df, list(keys), value, [F.xxhash64(*df.columns)], rank, size or "_size", None)
    if percentile:
        ranked = ranked.withColumn(percentile, _percentile(rank, size or "_size"))
    return ranked if size else ranked.drop("_size")


def _rank_types() -> Column:
    """Overall for everybody, active for active users."""
    both = F.array(F.lit(fixed.RANK_OVERALL), F.lit(fixed.RANK_ACTIVE))
    return F.when(F.col("active") == 1, both).otherwise(F.array(F.lit(fixed.RANK_OVERALL)))


def rating_ranks_by(ratings: DataFrame, sets: dict[str, tuple[Sequence[str], Column | None]], position: str = "rank_no_tie") -> dict[str, DataFrame]:
    """Ranks of (user_id, rating, active) rows for several sets of keys, from one pass over the rows.

    ``sets`` names each set's keys and which rows belong to it (None: all). As in grouping
    sets a row counts once per set and rank type, with the keys of the other sets left out.
    ``position`` is the place without ties, by user id where ratings are equal.
    """
    columns = list(dict.fromkeys(k for keys, _ in sets.values() for k in keys))
    types = {f.name: f.dataType for f in ratings.schema}
    members = [
        F.when(F.lit(True) if where is None else where, F.struct(
            F.lit(name).alias("_set"),
            *[(F.col(c) if c in keys else F.lit(None).cast(types[c])).alias(f"_set_{c}") for c in columns],
        ))
        for name, (keys, where) in sets.items()
    ]
    rows = ratings.select("*", F.explode(F.array_compact(F.array(*members))).alias("_member")).select(
        *ratings.columns, "_member.*", F.explode(_rank_types()).alias("user_rank_type_id")
    )
    groups = ["_set", *[f"_set_{c}" for c in columns], "user_rank_type_id"]
    ranked = _ranked(rows, groups, "rating", ["user_id"], "rank", "_size", position)
    ranked = ranked.withColumn("percentile", F.round(_percentile("rank", "_size"), 4)).drop("_size", *groups[1:-1])
    if len(sets) > 1:
        ranked = settle(ranked)
    return {name: ranked.filter(F.col("_set") == name).drop("_set") for name in sets}


def rating_ranks(ratings: DataFrame, keys: Sequence[str], *, position: str | None = None) -> DataFrame:
    """Ranks of (user_id, rating, active) rows within ``keys``, for all users and for active ones.

    Both rank types come out of one pass: an active user's row counts once in
    each. ``position`` adds the place without ties (by user id where equal).
    """
    ranked = rating_ranks_by(ratings, {"all": (keys, None)}, position or "_position")["all"]
    return ranked if position else ranked.drop("_position")


def active_users(ratings: DataFrame, projects: DataFrame, as_of, days: int = 180) -> DataFrame:
    """(user_id, phase_id) whose last rated project of the phase was posted in the last ``days`` days."""
    recent = projects.filter(
        F.col("posting_date") > F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
    ).select(F.col("project_id").alias("last_rated_project_id"), "phase_id")
    return ratings.select("user_id", "phase_id", "last_rated_project_id").join(
        recent, ["last_rated_project_id", "phase_id"], "left_semi"
    ).select("user_id", "phase_id").distinct()


def high_low(df: DataFrame, keys: Sequence[str], value: str, high: str, low: str) -> DataFrame:
    """Highest and lowest value per key."""
    return df.groupBy(*keys).agg(F.max(value).alias(high), F.min(value).alias(low))


# --- sequences -----------------------------------------------------------------


def number_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "sort"
) -> DataFrame:
    """0-based position in the group."""
    return scan(df, keys, order, number=name).withColumn(name, F.col(name) - 1)


def surrogate_keys(df: DataFrame, order: Sequence[str | Column], name: str, last: int = 0) -> DataFrame:
    """Running ids above ``last`` for a whole batch, in the given total order."""
    return scan(df, [], order, number=name).withColumn(name, F.col(name) + F.lit(last))


# Some 60 MB of numbers.
FEW_BLOCKS = 2_000_000


def block_keys(df: DataFrame, blocks: Sequence[str], order: Sequence[str | Column], name: str, last: int = 0) -> DataFrame:
    """Running ids above ``last`` in the order of ``blocks``, then ``order``: as ``surrogate_keys``, for many rows in small blocks.

    Only the sizes of the blocks are put in order; the rows are exchanged once, by block. A block is numbered
    in one task, so it has to fit there, and its columns must not be null. ``df`` is read twice. Up to ``FEW_BLOCKS``
    blocks are sent to the rows: rows that are dealt by one of the columns already are not exchanged at all.
    """
    blocks = list(blocks)
    sizes = df.groupBy(*blocks).agg(F.count(F.lit(1)).alias("_rows"))
    through = scan(sizes, [], blocks, sums={"_through": F.col("_rows")})
    offsets = settle(through.select(*blocks, (F.col("_through") - F.col("_rows") + F.lit(last)).alias("_offset")))
    if offsets.count() <= FEW_BLOCKS:
        offsets = F.broadcast(offsets)
    place = F.row_number().over(Window.partitionBy(*blocks).orderBy(*_cols(order)))
    return df.join(offsets, blocks).withColumn(name, F.col("_offset") + place).select(*df.columns, name)


def prior_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counts: Column,
    name: str,
) -> DataFrame:
    """Number of counted rows up to the row itself, itself included where it counts.

    A row whose first order column is null has no earlier rows and is itself
    never an earlier one.
    """
    dated = F.col(order[0]).isNotNull()
    own = F.when(counts, 1).otherwise(0)
    seen = scan(df, keys, order, sums={name: F.when(dated, own).otherwise(0)})
    return seen.withColumn(name, F.when(dated, F.col(name)).otherwise(own).cast("bigint"))


def assign_slots(df: DataFrame, parent: str, member: str, slot: str, free: int = 4) -> DataFrame:
    """One slot per member of a parent: a fixed slot below ``free`` stays, others get free, free + 1, ..."""
    members = df.groupBy(parent, member).agg(F.min(slot).alias(slot))
    fixed_slots = members.filter(F.col(slot) < free).select(parent, member, F.col(slot).cast("bigint").alias(slot))
    open_slots = scan(
        members.filter(F.col(slot) >= free).select(parent, member), [parent], [member], number=slot
    ).withColumn(slot, F.col(slot) + (free - 1))
    return fixed_slots.unionByName(open_slots)


def place_gaps(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Ordered list of places per key with the expected place and a flag where they differ."""
    ordered = scan(df, keys, [place], number="expected_place")
    differs = F.coalesce(F.col(place) != F.col("expected_place"), F.lit(False))
    return ordered.withColumn("gap", F.when(differs, 1).otherwise(0))


def streaks(
    results: DataFrame,
    *,
    user: str = "user_id",
    phase: str = "phase_id",
    project: str = "project_id",
    order: Sequence[str] = ("rating_order", "project_id"),
    placed: str = "placed",
    rating: str = "rating",
) -> DataFrame:
    """Runs longer than one of won, paid, rising and falling results per user and phase.

    Gaps and islands: a row that does not extend a run starts the next island.
    All four kinds share one ordered pass and are told apart only when the
    islands are summed up.
    """
    keys = [user, phase]
    place, points = F.coalesce(F.col(placed), F.lit(0)), F.coalesce(F.col(rating), F.lit(0))
    known = F.col("_prev") >= 0
    kinds = {
        fixed.STREAK_WON: place == 1,
        fixed.STREAK_PAID: place.isin(1, 2),
        fixed.STREAK_RATING_UP: F.coalesce(known & (points > F.col("_prev")), F.lit(False)),
        fixed.STREAK_RATING_DOWN: F.coalesce(known & (points < F.col("_prev")), F.lit(False)),
    }
    breaks = {kind: F.when(accept, 0).otherwise(1) for kind, accept in kinds.items()}
    islands = scan(
        results.select(*dict.fromkeys([*keys, project, *order, placed, rating])), keys, order, number="_at", lags={"_prev": points},
        sums={f"_island{kind}": value for kind, value in breaks.items()}, totals={f"_end{kind}": value for kind, value in breaks.items()},
    )
    rows = islands.select(
        *keys, project, "_at",
        F.explode(F.array(*[
            F.struct(
                F.lit(kind).alias("streak_type_id"),
                accept.alias("accept"),
                F.col(f"_island{kind}").alias("island"),
                (F.col(f"_island{kind}") == F.col(f"_end{kind}")).cast("int").alias("is_current"),
            )
            for kind, accept in kinds.items()
        ])).alias("run"),
    ).filter("run.accept")
    return (
        rows.groupBy(*keys, "run.streak_type_id", "run.island")
        .agg(
            F.min_by(project, "_at").alias("start_project_id"),
            F.max_by(project, "_at").alias("end_project_id"),
            F.count(F.lit(1)).alias("length"),
            F.max("run.is_current").alias("is_current"),
        )
        .filter("length > 1")
        .drop("island")
    )
