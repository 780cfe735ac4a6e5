"""Typing, coding and ranking of raw measurement attributes."""

from functools import reduce

from pyspark.sql import Column, functions as F

from ..schema import RECORD_TYPES, SLEEP_IN_BED, SLEEP_STAGE_WORDS, SOURCE_RANKING

# What counts as a plain decimal number: optional sign, digits that may be
# grouped by single underscores, fraction, exponent, or inf / nan.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)\s*$"
)
# A whole ISO date or date-time, dashed or bare: date parts, clock parts; fraction and offset only have to be well-formed.
_OFFSET = r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2}(?:\.[0-9]+)?)?)?)?"
_ISO = (
    rf"^([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}})(?:T([0-9]{{2}})(?::([0-9]{{2}})(?::([0-9]{{2}})(?:[.,][0-9]+)?)?)?{_OFFSET})?$",
    rf"^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})(?:T([0-9]{{2}})(?:([0-9]{{2}})(?:([0-9]{{2}})(?:[.,][0-9]+)?)?)?{_OFFSET})?$",
)
_WALL_CLOCK = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def number(text: Column) -> Column:
    """Text to double, NULL where the text is not a plain number."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), "_", ""), "(?i)^[+-]nan$", "NaN")
    return F.when(text.rlike(_NUMBER), bare.try_cast("double"))


def measure_value(text: Column) -> Column:
    """Value of a quantity record; missing or unreadable text counts as 0.0."""
    return F.coalesce(number(text), F.lit(0.0))


def workout_number(text: Column) -> Column:
    """Workout attribute: missing or empty is 0.0, unreadable text is NULL."""
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(number(text))


def local_timestamp(text: Column) -> Column:
    """Wall-clock time of ``yyyy-MM-dd HH:mm:ss +hhmm``; the offset is dropped.

    Text without a space is read as a whole ISO date or date-time, dashed or
    bare; a fraction of a second is cut off. Unreadable text, or text with
    anything more in it, gives NULL, so times always stay on whole seconds.
    """
    clock = F.substring_index(text, " ", 2)
    found = F.when(clock.rlike(_WALL_CLOCK), clock.try_cast("timestamp_ntz"))
    for pattern in _ISO:
        year, month, day, hour, minute, second = (F.regexp_extract(text, pattern, i) for i in range(1, 7))
        parts = [F.when(part == "", "00").otherwise(part) for part in (hour, minute, second)]
        plain = F.concat_ws(" ", F.concat_ws("-", year, month, day), F.concat_ws(":", *parts))
        found = found.when(text.rlike(pattern), plain.try_cast("timestamp_ntz"))
    return found


def map_record_type(identifier: Column, names: dict[str, str] = RECORD_TYPES) -> Column:
    """Short metric name of a vendor identifier, NULL when it is not mapped."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), identifier)


def classify_sleep(stage: Column) -> Column:
    """Numeric sleep stage of a category text (case-sensitive word search)."""
    chain = F
    for words, code in SLEEP_STAGE_WORDS:
        hit = reduce(lambda a, b: a | b, [stage.contains(word) for word in words])
        chain = chain.when(hit, F.lit(code))
    return chain.otherwise(F.lit(SLEEP_IN_BED))


def source_priority(source: Column, ranking: tuple[str, ...] = SOURCE_RANKING) -> Column:
    """Rank of a source name, 1 is best; names matching no pattern come last."""
    chain = F
    for rank, pattern in enumerate(ranking, start=1):
        chain = chain.when(source.like(pattern), F.lit(rank))
    return chain.otherwise(F.lit(len(ranking) + 1))


def minutes_between(start: Column, end: Column) -> Column:
    """Length of an interval in minutes, fractions kept."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def round_half_away(value: Column, digits: int) -> Column:
    """Scale, round to a whole number (halves away from zero), scale back."""
    scale = F.lit(float(10 ** digits))
    return F.round(value * scale) / scale
