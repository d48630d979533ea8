"""Row-local conversions: timestamps, identifiers, numbers, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY_US = 86_400 * MICROS

# Accepted timestamp shape and the "never set" forms of a session time.
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$"
OPTIONAL_SHAPE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"
SENTINEL_PREFIX = "0001-01-01"
SENTINEL_TEXTS = ("1/1/0001 12:00:00 am", "01/01/0001 12:00:00 am")
LENIENT_SENTINELS = ("0001-01-01 00:00:00", "00010101")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def _wall_clock(text: Column, shape: str) -> Column:
    """Wall clock of an ISO text: the offset is dropped, the fraction cut to microseconds.

    The text appears once, so a derived column is not evaluated repeatedly.
    """
    return F.regexp_extract(F.trim(text), shape, 0).try_cast("timestamp_ntz")


def strict_timestamp(text: Column) -> Column:
    """NULL unless the text has exactly the accepted shape and names a real instant."""
    return _wall_clock(text, TIMESTAMP_SHAPE)


def optional_timestamp(text: Column) -> Column:
    return _wall_clock(text, OPTIONAL_SHAPE)


def lenient_timestamp(text: Column) -> Column:
    return F.trim(text).try_cast("timestamp_ntz")


def optional_timestamp_status(text: Column) -> Column:
    """missing / sentinel / unparseable / ok."""
    plain = F.trim(text)
    spaced = F.replace(F.lower(plain), F.lit("t"), F.lit(" "))
    return (
        F.when(plain.isNull() | (plain == ""), "missing")
        .when(spaced.startswith(SENTINEL_PREFIX) | spaced.isin(*SENTINEL_TEXTS), "sentinel")
        .when(optional_timestamp(text).isNull(), "unparseable")
        .when(F.year(optional_timestamp(text)) <= 1, "sentinel")
        .otherwise("ok")
    )


def plausible_session_text(text: Column) -> Column:
    """The trimmed text when it is a usable session time of 2000 or later, else NULL."""
    plain = F.trim(text)
    return F.when(
        (plain != "") & ~plain.isin(*LENIENT_SENTINELS) & (F.year(lenient_timestamp(text)) >= 2000), plain
    )


def optional_int(text: Column, kind: str = "bigint") -> Column:
    return blank_to_null(text).try_cast("double").try_cast(kind)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 on the wall clock, independent of the session time zone."""
    elapsed = (ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
    return (elapsed.cast("decimal(20,6)") * MICROS).cast("bigint")


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def clock_us(us: Column) -> Column:
    """Microseconds since midnight."""
    return F.pmod(us, F.lit(DAY_US))


def day_number(us: Column) -> Column:
    return F.floor((us - clock_us(us)) / F.lit(DAY_US)).cast("bigint")


def parse_clock(text: str) -> int:
    """'HH:MM' or 'HH:MM:SS' as microseconds since midnight."""
    parts = text.strip().split(":")
    if len(parts) not in (2, 3) or not all(p.isdigit() for p in parts):
        raise ValueError(f"expected HH:MM or HH:MM:SS, got {text!r}")
    hour, minute, second = (*map(int, parts), 0)[:3]
    if hour > 23 or minute > 59 or second > 59:
        raise ValueError(f"no such time of day: {text!r}")
    return ((hour * 60 + minute) * 60 + second) * MICROS


def capped(value: Column, cap: float) -> Column:
    number = value.try_cast("double")
    return F.when(number <= cap, number)


def safe_name(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\s+", "_"), r"[^0-9A-Za-z_]", "")


def clock_label(minutes: Column) -> Column:
    """Signed HH:MM on a 24-hour clock, rounding half to even."""
    whole = F.bround(minutes).cast("bigint")
    clock = F.pmod(F.abs(whole), F.lit(1440))
    return F.concat(
        F.when(whole < 0, "-").otherwise(""),
        F.lpad(F.floor(clock / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(F.pmod(clock, F.lit(60)).cast("string"), 2, "0"),
    )


def warning_category(text: Column) -> Column:
    return F.coalesce(F.nullif(F.get(F.split(text, ":", 3), 1), F.lit("")), F.lit("uncategorized"))


def require_columns(df, names) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def first_present(df, names) -> Column:
    """First existing column among synonyms."""
    present = [n for n in names if n in df.columns]
    if not present:
        raise ValueError(f"none of the columns {list(names)} is present")
    return F.coalesce(*[F.col(n) for n in present])
