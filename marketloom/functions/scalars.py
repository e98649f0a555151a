"""Scalar helpers as plain column expressions (no Python UDFs)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# The epoch seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z.
EPOCH_MIN, EPOCH_MAX = -62135596800, 253402300799

# Literals the JVM parser accepts that are no numbers here: NaN, hexadecimal
# floats and a trailing d/f type suffix.
_NOT_A_NUMBER = r"(?i)^\s*[+-]?(?:0x|nan)|[0-9.][df]\s*$"


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- tolerant parsing -------------------------------------------------------
def nan_to_null(c: ColumnLike) -> Column:
    """A missing number is NULL everywhere in this package, never NaN."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def int_or_null(c: ColumnLike) -> Column:
    """Nullable integer out of a float column with missing values."""
    return nan_to_null(c).cast("bigint")


def to_double(c: ColumnLike) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    text = col(c).cast("string")
    return F.when(~text.rlike(_NOT_A_NUMBER), text.try_cast("double"))


def epoch_to_timestamp(c: ColumnLike) -> Column:
    """Epoch seconds (text or number) to timestamp; bad input becomes NULL."""
    seconds = col(c).try_cast("bigint")
    return F.when(seconds.between(EPOCH_MIN, EPOCH_MAX), F.timestamp_seconds(seconds))


def epoch_to_timestamp_strict(c: ColumnLike) -> Column:
    """Epoch seconds to timestamp; empty or zero is NULL, bad text is an error."""
    text = col(c).cast("string")
    return F.when(~text.isin("", "0"), F.timestamp_seconds(text.cast("bigint")))


def cast_to(c: ColumnLike, to: str, strict: bool = True) -> Column:
    return col(c).cast(to) if strict else col(c).try_cast(to)


# --- maps and JSON ----------------------------------------------------------
def dynamic_volume(ticker: ColumnLike) -> Column:
    """Text of the first ``vol_*`` entry of a ticker that is not ``vol_idr``."""
    volumes = F.map_filter(col(ticker), lambda k, _: k.startswith("vol_") & (k != "vol_idr"))
    return F.try_element_at(F.map_values(volumes), F.lit(1))


def map_or_empty(c: ColumnLike, key: str = "string", value: str = "string") -> Column:
    return F.coalesce(col(c), F.create_map().cast(f"map<{key},{value}>"))


def json_string(c: ColumnLike, key: str) -> Column:
    """Text of a top-level key of a JSON document."""
    return F.get_json_object(col(c), f"$.{key}")


def as_variant(c: ColumnLike) -> Column:
    return F.parse_json(col(c))


def to_json_text(c: ColumnLike) -> Column:
    return F.to_json(col(c))


def section_profile(c: ColumnLike) -> Column:
    """Entry count and one sample entry of a map section."""
    entries = F.map_entries(col(c))
    first = F.try_element_at(entries, F.lit(1))
    return F.struct(
        F.size(entries).cast("bigint").alias("entries"),
        first["key"].alias("sample_key"),
        first["value"].cast("string").alias("sample_value"),
    )


# --- arithmetic -------------------------------------------------------------
def guarded_pct(part: ColumnLike, base: ColumnLike) -> Column:
    """``part / base * 100`` as double where ``base`` is positive, else NULL."""
    part, base = col(part).cast("double"), col(base).cast("double")
    return F.when((base > 0) & ~F.isnan(base), part / base * 100)


def pct_change(current: ColumnLike, previous: ColumnLike) -> Column:
    return guarded_pct(col(current) - col(previous), previous)


def prior_price(last: ColumnLike, change_pct: ColumnLike) -> Column:
    """Earlier price implied by a percentage change; NULL for a change of -100."""
    factor = 1 + col(change_pct).cast("double") / 100
    return F.when(factor != 0, col(last).cast("double") / factor)


def is_close(a: ColumnLike, b: ColumnLike, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Approximate equality; two missing values are equal."""
    a, b = col(a), col(b)
    near = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.coalesce(a.eqNullSafe(b) | near, F.lit(False))


# --- time -------------------------------------------------------------------
def as_timestamp(c: ColumnLike) -> Column:
    return col(c).cast("timestamp")


def as_date(c: ColumnLike) -> Column:
    return F.to_date(col(c))


def date_key(c: ColumnLike) -> Column:
    """Date or timestamp to its ``yyyymmdd`` integer."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def ingestion_date(c: ColumnLike) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def ingestion_hour(c: ColumnLike) -> Column:
    return F.date_format(col(c), "HH")


def run_stamp(c: ColumnLike) -> Column:
    return F.date_format(col(c), "yyyyMMdd'T'HHmmss'Z'")


def iso_text(c: ColumnLike) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def isoformat(c: ColumnLike) -> Column:
    """ISO-8601 text with offset; microseconds only where there are any."""
    c = col(c).cast("timestamp")
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")
    parts = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(c) % 1_000_000 == 0, whole).otherwise(parts)


def file_stem(path: ColumnLike) -> Column:
    """Run name of a landing file: ``.../pairs_<stamp>.json`` gives ``pairs_<stamp>``.

    A run written by Spark is a folder of that name holding part files.
    """
    return F.regexp_extract(col(path), r"([^/]+)\.json(?:/[^/]*)?$", 1)


def file_captured_at(path: ColumnLike) -> Column:
    """Timestamp held in the run stamp that ends a landing file's stem."""
    stamp = F.regexp_extract(file_stem(path), r"([^_]+)$", 1)
    return F.to_timestamp(stamp, "yyyyMMdd'T'HHmmssX")


def order_key(at: ColumnLike, tie: ColumnLike | None = None, whole: bool = False) -> Column:
    """Sort key of an instant, optionally with a tie-break column.

    Without a tie-break the key is one bigint, with a whole-number tie-break
    (``whole=True``) one decimal that holds both: a microsecond is worth more
    than all 64-bit numbers. ``min_by``/``max_by`` over either run as a hash
    aggregation. Any other tie-break makes it a struct, which needs a sort-based
    one. A missing instant or tie-break sorts first.
    """
    micros = F.unix_micros(col(at).cast("timestamp"))
    if tie is None:
        return micros
    if not whole:
        return F.struct(micros.alias("at"), col(tie).alias("tie"))
    instant = F.coalesce(micros.cast("decimal(18,0)"), F.lit(-(10**18 - 1)).cast("decimal(18,0)"))
    rank = F.coalesce(col(tie).cast("decimal(20,0)") + F.lit(str(2**63 + 1)).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (instant * F.lit(str(10**20)).cast("decimal(21,0)") + rank).cast("decimal(38,0)")


def utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)
