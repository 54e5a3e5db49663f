"""Scalar rules of the loads as Column -> Column functions.

Everything here stays a built-in expression, so whole-stage code generation
covers it and filters on the results can still be reordered by the optimizer.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadstone.functions import fixed

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(item) for item in chain(*values.items())])


# --- text to timestamp -------------------------------------------------------

# One pattern per accepted text form, in the order they are tried, and where
# its groups go: year month day hour minute second clock zone. Trailing text is
# ignored and fields may overflow (month 13 is January of next year).
_CLOCK = r"\s*(\d+):(\d+)"
_TEXT_FORMS = (
    (r"^\s*(\d+)/(\d+)/(\d+) " + _CLOCK, "$3 $1 $2 $4 $5 0 AM UTC"),
    (r"^\s*(\d+)\.(\d+)\.(\d+) " + _CLOCK + r"\s*([AaPp][Mm])(?![A-Za-z])", "$3 $1 $2 $4 $5 0 $6 UTC"),
    (
        r"^(?:[Ss]un|[Mm]on|[Tt]ue|[Ww]ed|[Tt]hu|[Ff]ri|[Ss]at)[a-z]* ([A-Za-z]{3})[a-z]* \s*(\d+) "
        + _CLOCK
        + r":(\d+) (\S+) \s*(\d+)",
        "$7 $1 $2 $3 $4 $5 24 $6",
    ),
    (r"^\s*(\d+)\.(\d+)\.(\d+) " + _CLOCK + r" (\S+)", "$3 $1 $2 $4 $5 0 24 $6"),
    (r"^\s*(\d+)-(\d+)-(\d+) " + _CLOCK + r":(\d+)", "$1 $2 $3 $4 $5 $6 24 UTC"),
)


def _zone_minutes(zone: Column) -> Column:
    offset = r"^(?:GMT|UTC)?([+-])(\d{1,2}):?(\d{2})$"
    sign = F.when(F.regexp_extract(zone, offset, 1) == "-", -1).otherwise(1)
    numeric = sign * (
        F.regexp_extract(zone, offset, 2).try_cast("int") * 60
        + F.regexp_extract(zone, offset, 3).try_cast("int")
    )
    named = (F.element_at(_literal_map(fixed.ZONE_HOURS), F.upper(zone)) * 60).cast("int")
    return F.coalesce(named, numeric)


def _to_utc(wall: Column, zone: Column) -> Column:
    """A wall clock time in UTC: by offset or abbreviation, else by the rules of any zone Spark knows."""
    minutes = _zone_minutes(zone)
    # Only a zone that is neither is tried by name; failing to make a time with it is slow.
    other = minutes.isNull() & wall.isNotNull() & zone.isNotNull()
    known = F.try_make_timestamp(*[F.lit(n) for n in (2000, 1, 1, 0, 0, 0)], zone).isNotNull()
    region = F.when(other, F.when(known, F.to_utc_timestamp(wall.cast("timestamp"), zone).cast("timestamp_ntz")))
    return F.when(minutes.isNotNull(), F.timestamp_add("MINUTE", -minutes, wall)).otherwise(region)


def parse_timestamp(text) -> Column:
    """Timestamp of a text in one of five forms, null for any other text or an unknown zone.

    ``01/31/2009 09:30`` (12-hour clock, no half of day given: morning),
    ``01.31.2009 09:30 PM``, ``Sat Jan 31 09:30:15 EST 2009``,
    ``01.31.2009 21:30 EST`` and ``2009-01-31 21:30:15``.
    """
    text = _col(text)
    plain = F.lit(None).cast("string")
    for pattern, order in reversed(_TEXT_FORMS):
        plain = F.when(text.rlike(pattern), F.regexp_replace(text, "(?s)" + pattern + ".*$", order)).otherwise(plain)
    # All fields come from one split of the rearranged text, read in every row,
    # so that generated code splits it once.
    parts = F.split(plain, " ")
    number = lambda index: F.get(parts, F.lit(index)).try_cast("int")
    named_month = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.get(parts, F.lit(1)))).cast("int"), F.lit(0))
    month = F.coalesce(number(1), named_month)
    clock = F.upper(F.get(parts, F.lit(6)))
    hour = F.when((clock != "24") & (number(3) == 12), 0).otherwise(number(3)) + F.when(clock == "PM", 12).otherwise(0)
    date = F.date_add(F.add_months(F.make_date(number(0), F.lit(1), F.lit(1)), month - 1), number(2) - 1)
    seconds = hour * 3600 + number(4) * 60 + number(5)
    return _to_utc(F.timestamp_add("SECOND", seconds, date.cast("timestamp_ntz")), F.get(parts, F.lit(7)))


# --- review answers ----------------------------------------------------------


def evaluation_id(question_type, answer) -> Column:
    """Evaluation id of an answer; null where the answer has none.

    Type 1 is a scale to 4 whose other answers are read on the scale to 10
    of type 2; type 3 has no evaluation; type 4 is yes or no; every other
    type takes the answer as the id itself.
    """
    question_type, answer = _col(question_type), _col(answer)

    def scale(top: int, base: int) -> Column:
        values = {}
        for step in range(1, top + 1):
            values[str(step)] = base + step
            values[f"{step}/{top}"] = base + step
        return F.element_at(_literal_map(values), answer)

    of_four, of_ten = scale(4, 0), scale(10, 10)
    number = F.when(answer.rlike(r"^[+-]?[0-9]+$"), answer.try_cast("int"))
    value = (
        F.when(answer.isNull() | (F.trim(answer) == ""), None)
        .when(question_type == 1, F.coalesce(of_four, of_ten))
        .when(question_type == 2, of_ten)
        .when(question_type == 3, None)
        .when(question_type == 4, F.when(answer.isin("Yes", "1"), 5).otherwise(6))
        .otherwise(number)
    )
    return F.nullif(value, F.lit(0))


def ratio_part(text, part: int, checked: bool = True) -> Column:
    """Part 1 (passed) or 2 (total) of ``passed/total``; 1 where it is no ratio.

    ``checked`` falls back to 1 when either part is not a whole number; else
    such a part becomes null.
    """
    parts = F.split(F.regexp_replace(_col(text), r"/+$", ""), "/")
    number = lambda i: F.when(
        F.get(parts, F.lit(i)).rlike(r"^[+-]?[0-9]+$"), F.get(parts, F.lit(i)).try_cast("int")
    )
    usable = F.size(parts) >= 2
    if checked:
        usable = usable & number(0).isNotNull() & number(1).isNotNull()
    return F.when(F.coalesce(usable, F.lit(False)), number(part - 1)).otherwise(F.lit(1))


def success_flag(text) -> Column:
    """Null stays null, ``Succeeded`` is 1, any other text 0."""
    text = _col(text)
    return F.when(text.isNull(), None).when(text == "Succeeded", 1).otherwise(0)


# --- text --------------------------------------------------------------------


def header_cut(text, width: int = 250) -> Column:
    """Head of a long text for display, with ``...`` where it was cut.

    Cut after the last line break that starts at or before ``width``, else at
    the last blank there; a text with neither is left as it is.
    """
    text = _col(text)
    to_break = F.regexp_extract(text, rf"(?s)^(.{{0,{width}}}\n)", 1)
    blank = rf"(?s)^(.{{0,{width}}}) "
    return (
        F.when(to_break != "", F.concat(to_break, F.lit("...")))
        .when(text.rlike(blank), F.concat(F.regexp_extract(text, blank, 1), F.lit("...")))
        .otherwise(text)
    )


def path_prefix(path, prefix: str) -> Column:
    """Put the folder before a path that names none (no slash, or a leading one)."""
    path = _col(path)
    folder = prefix if prefix.endswith("/") else prefix + "/"
    return F.when(F.instr(path, "/") <= 1, F.concat(F.lit(folder), path)).otherwise(path)


def pad_code(code, width: int = 3) -> Column:
    """Zero-padded code; null becomes the empty text."""
    code = _col(code)
    return F.when(code.isNull(), F.lit("")).otherwise(F.lpad(F.trim(code), width, "0"))


def text_or_empty(text) -> Column:
    return F.coalesce(_col(text), F.lit(""))


# --- numbers -----------------------------------------------------------------


def to_long(value) -> Column:
    """Whole number from text, null where it is none."""
    return _col(value).try_cast("bigint")


def to_money(value) -> Column:
    return _col(value).try_cast("decimal(18,2)")


def or_zero(value) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def positive_or_null(value) -> Column:
    value = _col(value)
    return F.when(value > 0, value)


def duration_minutes(start, end) -> Column:
    """Whole minutes from start to end; null when negative or an end is missing."""
    start, end = _col(start), _col(end)
    seconds = F.timestamp_diff("SECOND", start, end)
    return F.when(end >= start, F.floor(seconds / 60))


def flag(value, *accepted: str) -> Column:
    """1 for one of the accepted texts, else 0 (null too)."""
    return F.when(_col(value).isin(*accepted), 1).otherwise(0)


def admin_fee(status, fixed_fee, percentage, prize_total) -> Column:
    """Fixed fee, or a share of the prizes where a percentage is set.

    Cancelled states carry no fixed fee.
    """
    status, fixed_fee = _col(status), or_zero(fixed_fee)
    percentage, prize_total = or_zero(percentage), or_zero(prize_total)
    base = F.when(status.isin(*fixed.FEE_FREE_STATUSES), 0).otherwise(fixed_fee)
    return F.when(percentage < 1e-5, base).otherwise(percentage * prize_total)


def operation_amount(operation, amount, parent_amount) -> Column:
    """Operation 2 takes ``amount`` as a percentage of the parent's amount."""
    amount = _col(amount)
    return F.when(_col(operation) == 2, or_zero(parent_amount) * amount / 100).otherwise(amount)


def placement_points(total, placements, place) -> Column:
    """Points of a place: its share of the total, rounded half up to cents."""
    total, placements, place = _col(total), _col(placements), _col(place)
    table = F.array(*[F.array(*[F.lit(v) for v in row]) for row in fixed.PLACEMENT_SHARES])
    valid = (total > 0) & place.between(1, 5) & (placements > 0)
    row = F.least(placements, F.lit(5)).cast("int") - 1
    share = F.get(F.get(table, row), place.cast("int") - 1)
    return F.when(valid, F.floor(total * share * 100.0 + 0.5) / 100.0).otherwise(F.lit(0.0))


def taxable_share(prize, taxable_points, final_points) -> Column:
    return _col(prize) * F.try_divide(_col(taxable_points), _col(final_points))


def rating_key(rating) -> Column:
    """Id of a rating in the rating dimension; an unrated result is -2."""
    return F.coalesce(_col(rating), F.lit(-2))


def billing_id(text) -> Column:
    """Billing account id; ``0`` and non-positive values mean none."""
    return positive_or_null(to_long(text))


def pick_by_code(code, columns: dict[int, str]) -> Column:
    """The column a code points to; zero, missing and unknown codes give null."""
    code = _col(code)
    picked = reduce(
        lambda acc, item: acc.when(code == item[0], F.col(item[1])),
        columns.items(),
        F.when(F.lit(False), F.lit(None).cast("bigint")),
    )
    return positive_or_null(picked)
