"""Column expressions that clean, type and key raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the incoming text and the separator inside surrogate keys.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEY_SEPARATOR = "||"
KEY_TIMES = ("_event_ts", "_ingest_ts")


def lower_text(name: str) -> Column:
    return F.lower(F.trim(name))


def upper_text(name: str) -> Column:
    return F.upper(F.trim(name))


def title_text(name: str) -> Column:
    return F.initcap(F.trim(name))


def as_date(name: str) -> Column:
    """Malformed dates become NULL instead of ending the run."""
    return F.try_to_date(F.col(name), DATE_FORMAT)


def as_timestamp(name: str) -> Column:
    return F.try_to_timestamp(F.col(name), F.lit(TIMESTAMP_FORMAT))


def as_type(name: str, type_name: str) -> Column:
    """Malformed values become NULL instead of ending the run."""
    return F.col(name).try_cast(type_name)


def surrogate_key(*names: str) -> Column:
    """SHA-256 over the text of the columns; NULLs are skipped, as ``concat_ws`` does."""
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[F.col(n).cast("string") for n in names]), 256)


def version_key(key: str) -> Column:
    """The surrogate key of staged rows. Its 64 letters hardly compress, so where rows are shuffled
    it is better made afterwards, from columns that are there anyway."""
    return surrogate_key(key, *KEY_TIMES)


def key_parts() -> Column:
    """What ``version_key`` takes besides the key, for rows that are still to be shuffled."""
    return F.struct(*KEY_TIMES)


def key_from_parts(key: str, parts: str) -> Column:
    """``version_key`` from the key and a column of ``key_parts``; NULL without the parts."""
    text = surrogate_key(key, *[f"{parts}.{name}" for name in KEY_TIMES])
    return F.when(F.col(parts).isNotNull(), text)
