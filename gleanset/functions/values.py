"""Small value conversions, all as built-in column expressions.

None depends on the session time zone: instants are counted from the epoch as
zone-less timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address that relative post links are resolved against.
POST_BASE_URL = "https://www.reddit.com"

# The years 1 to 9999, in microseconds from the epoch.
_FIRST_MICRO = -62_135_596_800_000_000
_LAST_MICRO = 253_402_300_799_999_999

_DIGITS = r"\d(?:_?\d)*"
_NUMBER = (
    rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))\s*$"
)


def null_to_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def author_text(author: Column) -> Column:
    """Name of a nested author; a removed author, or one without a name, is null."""
    name = author.getField("name")
    return F.when(name != "", name)


def permalink_url(permalink: Column, base_url: str = POST_BASE_URL) -> Column:
    return F.concat(F.lit(base_url), permalink)


def name_in(value: Column) -> Column:
    """A setting as it is compared: blanks around it and case do not count."""
    return F.lower(F.trim(value))


def numeric_cast(value: Column) -> Column:
    """Text to double, null when it is no number.

    Underscores may part digits; type suffixes that Spark's own cast accepts
    (``1d``, ``1.0f``) are refused.
    """
    text = value.cast("string")
    plain = F.regexp_replace(F.trim(text), "_", "")
    return F.when(text.rlike(_NUMBER), plain.try_cast("double"))


def epoch_micros(seconds: Column) -> Column:
    """Epoch seconds to whole microseconds, halves to even; null when no calendar date.

    Whole seconds and fraction are rounded apart, because the product of a full
    epoch value and 1e6 has already lost the digits that decide the rounding.
    """
    whole = F.floor(seconds)
    fraction = F.rint((seconds - whole) * F.lit(1_000_000.0)).cast("bigint")
    in_range = (seconds > -62_135_596_801.0) & (seconds < 253_402_300_801.0)
    micros = F.when(in_range, whole.cast("bigint") * 1_000_000 + fraction)
    return F.when(micros.between(_FIRST_MICRO, _LAST_MICRO), micros)


def epoch_to_iso(seconds: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; the fraction only when it is not zero."""
    micros = epoch_micros(seconds)
    part = F.pmod(micros, F.lit(1_000_000))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    instant = F.substring(F.timestamp_add("MICROSECOND", micros, epoch).cast("string"), 1, 19)
    fraction = F.when(part == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))
    )
    return F.concat(F.translate(instant, " ", "T"), fraction, F.lit("+00:00"))


def epoch_text(seconds: Column) -> Column:
    """A double in plain notation with the fewest digits that give it back: ``1972857600.0``."""
    digits = seconds.cast("double").cast("string").cast("decimal(38,12)").cast("string")
    trimmed = F.regexp_replace(digits, "0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def body_digest(text: Column) -> Column:
    """SHA-256 of the exact bytes: 44 characters stand for a body in shuffles and joins."""
    return F.base64(F.unhex(F.sha2(text, 256)))


# body_digest of the empty text.
EMPTY_DIGEST = "47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU="


def window_hours(newest: Column, oldest: Column) -> Column:
    """Hours between two epoch values; an empty group spans zero hours."""
    return F.coalesce((newest - oldest) / F.lit(3600.0), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole * F.lit(100.0))
