"""Column functions shared by the operators. Every one returns a Column and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of the site's date format, in calendar order (fixed values).
MONTHS = [
    "januar", "februar", "mars", "april", "mai", "juni",
    "juli", "august", "september", "oktober", "november", "desember",
]

# Characters counted as white space by the text rules: Unicode separators and the control blanks.
BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


# The same characters as a plain list, for trimming.
BLANK_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(value: Column | str) -> Column:
    """Trim every kind of white space, not only the plain blank. Reads only the two ends."""
    return F.btrim(as_column(value), F.lit(BLANK_CHARS))


def non_empty(value: Column | str) -> Column:
    """NULL in place of an empty string."""
    return F.nullif(as_column(value), F.lit(""))


def digits_text(value: Column | str) -> Column:
    return non_empty(F.regexp_replace(as_column(value), "[^0-9]", ""))


def digits_int(value: Column | str) -> Column:
    """All digits of a text read as one integer; NULL if there are none or they do not fit."""
    return digits_text(value).try_cast("int")


def all_digits(value: Column | str) -> Column:
    return F.coalesce(as_column(value).rlike("^[0-9]+$"), F.lit(False))


def first_year(value: Column | str) -> Column:
    """First run of four digits, '' if there is none."""
    return F.regexp_extract(as_column(value), r"(\d{4})", 1)


def absolute_url(href: Column | str, base: str) -> Column:
    """Links starting with '/' get the base; all others stay as they are."""
    href = as_column(href)
    return F.when(href.startswith("/"), F.concat(F.lit(base), href)).otherwise(href)


def next_page_url(href: Column | str, current: Column | str) -> Column:
    """Resolve a next-page link against the page it was found on; other link forms give NULL."""
    href, current = as_column(href), as_column(current)
    origin = F.regexp_extract(current, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(current, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return (
        F.when(href.startswith("?"), F.concat(origin, path, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("http"), href)
    )


def url_tail_id(url: Column | str) -> Column:
    """Last path segment of a link when it is made of digits only."""
    return non_empty(F.regexp_extract(as_column(url), r"(?:^|/)([0-9]+)/*$", 1))


def url_unquoted(value: Column | str) -> Column:
    """Percent decoding that leaves '+' alone; text that cannot be decoded is returned unchanged."""
    value = as_column(value)
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def parsed_timestamp(value: Column | str) -> Column:
    """ISO-8601 text (a missing zone means UTC) or epoch seconds, else NULL.

    Epoch seconds count only when the text is a bare number of at least nine digits or has a
    fraction, since ``2024`` alone is an ISO year to Spark.
    """
    value = strip(value)
    epoch = F.when(value.rlike(r"^-?[0-9]{9,}(\.[0-9]+)?$"), value).try_cast("double")
    iso = F.when(
        value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"),
        value,
    )
    has_zone = iso.rlike(r"[0-9]{2}:[0-9]{2}.*(Z|[+-][0-9]{2}:?[0-9]{2})$")
    seconds = F.when(iso.rlike("[T ][0-9]{2}:[0-9]{2}$"), ":00").otherwise("")
    midnight = F.when(iso.contains(":"), "").otherwise("T00:00:00")
    iso = F.when(has_zone, iso).otherwise(F.concat(iso, seconds, midnight, F.lit("Z")))
    return F.coalesce(F.timestamp_seconds(epoch), iso.try_cast("timestamp"))


def localised_date(value: Column | str) -> Column:
    """'10. august 2025, 21:23' as a UTC timestamp; a missing time is midnight, garbage is NULL."""
    text = F.lower(strip(F.replace(as_column(value), F.lit("\u00a0"), F.lit(" "))))
    tokens = F.split(strip(F.regexp_replace(F.split_part(text, F.lit(","), F.lit(1)), r"\.", "")), r"\s+")
    clock = F.split_part(text, F.lit(","), F.lit(2))
    hour = F.regexp_extract(clock, r"^\s*(\d{1,2})\s*(?::.*)?$", 1)
    minute = F.regexp_extract(clock, r"^\s*\d{1,2}\s*:\s*(\d{1,2})\s*(?::.*)?$", 1)
    hour, minute = (F.coalesce(part.try_cast("int"), F.lit(0)) for part in (hour, minute))
    month = F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.try_element_at(tokens, F.lit(2))), F.lit(0))
    return F.try_make_timestamp(
        F.try_element_at(tokens, F.lit(3)).try_cast("int"),
        month.cast("int"),
        F.try_element_at(tokens, F.lit(1)).try_cast("int"),
        hour,
        minute,
        F.lit(0).cast("decimal(8,6)"),
        F.lit("UTC"),
    )


def shortened(value: Column | str, width: int = 200) -> Column:
    """Cut a long text to ``width`` characters plus an ellipsis."""
    value = as_column(value)
    return F.when(F.length(value) > width, F.concat(F.substring(value, 1, width), F.lit("..."))).otherwise(value)


def keyword_in_context(text: Column | str, keyword: Column | str, around: int = 160) -> Column:
    """First case-insensitive hit with ``around`` characters on both sides, NULL without a hit."""
    text, keyword = as_column(text), F.lower(strip(keyword))
    at = F.position(keyword, F.lower(text))
    start = F.greatest(F.lit(1), at - around)
    end = at + F.length(keyword) - 1 + around
    return F.when((at > 0) & (F.length(keyword) > 0), F.substring(text, start, end - start + 1))


def any_contains(items: Column | str, needle: str) -> Column:
    """Does any element of a string array contain ``needle``, ignoring case?"""
    return F.coalesce(F.exists(as_column(items), lambda x: F.contains(F.lower(x), F.lit(needle.lower()))), F.lit(False))


def is_stale(last: Column | str, as_of: Column, age: str) -> Column:
    """True when never seen or last seen before ``as_of - age``; ``age`` is an interval like '24 hours'."""
    last = as_column(last)
    return last.isNull() | (last < as_of - F.expr(f"INTERVAL {age}"))


def is_changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)


def share_of_ids(key: Column | str, share: float) -> Column:
    """Deterministic sample of keys: true for about ``share`` of them, the same ones on every run."""
    bucket = F.conv(F.substring(F.md5(as_column(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return bucket < int(share * 2**32)


def similarity_of_distance(distance: Column | str) -> Column:
    """Cosine distance (0 to 2) as a similarity between 0 and 1."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - as_column(distance) / F.lit(2.0))

