"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000

#: Date, time, fraction and offset of an ISO-8601 instant, basic or extended, in upper case.
_ISO = (
    r"\A(\d{4})-?(\d{2})-?(\d{2})[T ]+(\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?\s*"
    r"(Z|UTC|[+-]\d{2})(?::?(\d{2}))?\z"
)


def instant(text: Column) -> Column:
    """The instant of an ISO-8601 text with an explicit offset, or null.

    The engine's own cast covers the usual spellings; only what it refuses (basic format, lower
    case, a comma before the fraction, an offset without colon) is rewritten and cast again.
    """
    tidy = F.upper(F.trim(text))
    part = lambda i: F.regexp_extract(tidy, _ISO, i)
    seconds = F.when(part(6) == "", "00").otherwise(part(6))
    fraction = F.when(part(7) == "", "").otherwise(F.concat(F.lit("."), F.substring(part(7), 1, 6)))
    minutes = F.when(part(9) == "", "00").otherwise(part(9))
    offset = F.when(part(8).isin("Z", "UTC"), "+00:00").otherwise(F.concat(part(8), F.lit(":"), minutes))
    rewritten = F.concat(
        part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit("T"),
        part(4), F.lit(":"), part(5), F.lit(":"), seconds, fraction, offset,
    )
    return F.coalesce(text.try_cast("timestamp"), F.when(tidy.rlike(_ISO), rewritten).try_cast("timestamp"))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp; independent of the session's time zone."""
    return F.unix_micros(ts.cast("timestamp"))


def utc_day_number(us: Column) -> Column:
    """Days since 1970 of an instant in microseconds, by floor."""
    return F.call_function("div", us - F.pmod(us, F.lit(DAY_US)), F.lit(DAY_US)).cast("int")


def day_text(day_number: Column) -> Column:
    return F.date_from_unix_date(day_number).cast("string")


def arrival(ingestion: str = "ingestion_time", publish: str = "publish_time") -> Column:
    """When a stored row arrived: its ingestion time, or its publish time where that is null."""
    return F.coalesce(F.col(ingestion).cast("timestamp"), F.col(publish).cast("timestamp"))


def trimmed(text: Column) -> Column:
    """Text without white space of any kind around it."""
    return F.regexp_replace(text, r"\A[\s ]+|[\s ]+\z", "")


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with underscores appended until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
