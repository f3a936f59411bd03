"""Column functions: buckets, times, literal search, ids, validity. All stay inside generated code."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BUCKETS


def bucket(key: Column, n: int = BUCKETS) -> Column:
    """The hash bucket of a key: the first 32 bits of its MD5, modulo n. Null keys go to bucket 0."""
    return F.coalesce(F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(n)), F.lit(0)).cast("long")


def bucket_of(key: str, n: int = BUCKETS) -> int:
    """bucket() of one value, for the driver."""
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) % n


#: White space at either end of a text, of any alphabet.
_ENDS = r"(?U)^\s+|\s+$"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, _ENDS, "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (stripped(c) == "")


def matches(pred: Column) -> Column:
    """A predicate as update and delete read it: null is no match."""
    return F.coalesce(pred, F.lit(False))


def contains_any(phrase: str, columns: list[str]) -> Column:
    """Literal, case-sensitive substring in any of the columns: % and _ stand for themselves."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.contains(F.col(c), F.lit(phrase)), F.lit(False))
    return out


def has_tags(tags: list[str], column: str = "tags") -> Column:
    """Every tag is required; a null list has none."""
    out = F.lit(True)
    for t in tags:
        out = out & F.coalesce(F.array_contains(column, t), F.lit(False))
    return out


def day_of_seconds(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def parse_time(text: Column) -> Column:
    """Epoch milliseconds of digits (10**10 and more are milliseconds, less are seconds) or of an ISO time (UTC if it says nothing)."""
    digits = F.rlike(text, F.lit(r"^\d+$"))
    number = F.try_to_number(text, F.lit("9" * 18)).cast("long")
    iso = F.unix_millis(F.try_to_timestamp(F.replace(text, F.lit("Z"), F.lit("+00:00"))))
    return F.when(digits, F.when(number >= 10**10, number).otherwise(number * 1000)).otherwise(iso)


def iso_time(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def content_id(canonical: Column) -> Column:
    return F.concat(F.lit("evt_"), F.substring(F.md5(canonical), 1, 16))


def event_id() -> Column:
    """A new id: seconds and eight random hex digits."""
    return F.concat(F.lit("evt_"), F.unix_timestamp().cast("string"), F.lit("_"), F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 8))


def valid_id(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False))


def checkpoint_identity(*parts: str) -> Column:
    return F.concat_ws("|", *[F.col(p).cast("string") for p in parts])


def safe_filename(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))


def job_tags(job_id: Column) -> Column:
    """The first four trimmed #-parts of a job id, if there are four and none is blank; else null."""
    four = F.slice(F.transform(F.split(job_id, "#"), stripped), 1, 4)
    return F.when((F.size(four) == 4) & F.forall(four, lambda x: x != ""), four)


def joined_text(*columns: Column) -> Column:
    """The non-blank values, one a line; null if all are blank."""
    return F.nullif(F.concat_ws("\n", *[F.when(~is_blank(c), c) for c in columns]), F.lit(""))


def changed(name: str, before: Column, after: Column) -> Column:
    """The column's name where the two differ (null equals null, NaN equals NaN), else null."""
    return F.when(~before.eqNullSafe(after), F.lit(name))
