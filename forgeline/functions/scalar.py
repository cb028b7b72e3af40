"""Scalar Column expressions.  All are built-in Spark expressions (codegen, no Python)."""

from __future__ import annotations

import datetime as _dt
import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgeline.contracts import MIN_VALID_YEAR, ROW_REFERENCE_HEX_CHARS, ROW_REFERENCE_PREFIX


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ISO-8601 as accepted by Python's datetime.fromisoformat for the common forms:
# extended date with an optional time after one non-digit separator (hour, minute,
# second, fraction of 1-9 digits after '.' or ','), optional 'Z' or +/-HH[[:]MM] offset;
# or the basic forms YYYYMMDD[THH[MM[SS]]].  Reduced dates (2026, 2026-01), one-digit
# fields, padded text, week dates and 5+ digit years are rejected.
_ISO_EXTENDED = (r"^\d{4}-\d{2}-\d{2}"
                 r"(?:[^0-9]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$")
_ISO_BASIC = r"^\d{8}(?:T\d{2}(?:\d{2}(?:\d{2})?)?)?$"
_CLOCK = r"^(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?)"
_ZONE = r"(Z|[+-]\d{2}(?::?\d{2})?)$"


def ntz_lit(value: _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on the session or process time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


_PLAIN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}$"
_EPOCH_NTZ = _dt.datetime(1970, 1, 1)


def is_plain_timestamp(c) -> Column:
    """Is the text in the plainest and by far most common form, which ``plain_timestamp`` reads?"""
    return _c(c).rlike(_PLAIN)


def plain_timestamp(c) -> Column:
    """``parse_timestamp`` of text in the plainest form: it needs no rewriting, the cast alone decides."""
    return F.when(F.substring(_c(c), 1, 4).try_cast("int") >= MIN_VALID_YEAR, _c(c).try_cast("timestamp_ntz"))


def parse_timestamp(c) -> Column:
    """Text -> TIMESTAMP_NTZ, or NULL when unparsable or the written year is before 2000.

    One guard regex decides the form; Spark's own string-to-timestamp cast does the
    parsing (and rejects impossible dates and clock values).  A zone offset is applied,
    giving UTC wall-clock time: ``2026-01-01T01:00:00+02:00`` -> ``2025-12-31 23:00:00``.
    """
    s = _c(c)
    day = F.substring(s, 1, 10)
    clock = F.substring(s, 12, 64)
    # extended form: separator -> 'T', decimal comma -> point
    ext = F.when(F.length(s) > 10, F.concat(day, F.lit("T"), F.translate(clock, ",", "."))).otherwise(s)
    has_offset = (F.length(s) > 10) & (clock.contains("+") | clock.contains("-") | clock.endswith("Z"))
    # with a zone, Spark needs the seconds: pad HH / HH:MM to HH:MM:SS.  Only this
    # branch pays for the extraction (rows without a zone never evaluate it).
    hms = F.regexp_extract(clock, _CLOCK, 1)
    padded = (F.when(F.length(hms) == 2, F.concat(hms, F.lit(":00:00")))
              .when(F.length(hms) == 5, F.concat(hms, F.lit(":00"))).otherwise(hms))
    zoned = F.concat(day, F.lit("T"), F.translate(padded, ",", "."), F.regexp_extract(clock, _ZONE, 1))
    with_offset = F.timestamp_add(
        "MICROSECOND", F.unix_micros(zoned.try_cast("timestamp")), ntz_lit(_EPOCH_NTZ))
    extended = F.when(has_offset, with_offset).otherwise(ext.try_cast("timestamp_ntz"))
    # basic form -> extended text
    n = F.length(s)
    basic_text = F.concat(
        F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 7, 2),
        F.when(n >= 11, F.concat(F.lit("T"), F.substring(s, 10, 2))).otherwise(F.lit("")),
        F.when(n >= 13, F.concat(F.lit(":"), F.substring(s, 12, 2))).otherwise(F.lit("")),
        F.when(n >= 15, F.concat(F.lit(":"), F.substring(s, 14, 2))).otherwise(F.lit("")),
    )
    parsed = (F.when(is_plain_timestamp(s), s.try_cast("timestamp_ntz"))
              .when(s.rlike(_ISO_EXTENDED), extended)
              .when(s.rlike(_ISO_BASIC), basic_text.try_cast("timestamp_ntz")))
    return F.when(F.substring(s, 1, 4).try_cast("int") >= MIN_VALID_YEAR, parsed)


# The characters Python's int() strips around a number (str.isspace minus
# the four information separators U+001C-U+001F).
PY_WHITESPACE = r"[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_EDGE_SPACE = rf"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$"
_INT_CORE = r"^[+-]?\d+(_\d+)*$"


@functools.cache
def unicode_decimal_digits() -> tuple[str, str]:
    """Every non-ASCII Unicode decimal digit (category Nd) and its ASCII digit, built from
    the Unicode database behind Python's int(), which reads all of them."""
    src, dst = [], []
    for cp in range(0x80, 0x110000):
        d = unicodedata.decimal(chr(cp), None)
        if d is not None:
            src.append(chr(cp))
            dst.append(str(d))
    return "".join(src), "".join(dst)


def quantity_text(c) -> Column:
    """The text as int() reads it: the whitespace it ignores removed from both ends and
    every decimal digit in ASCII.  Compute it once as a column when several rules read
    it (one regex pass and one translate per row)."""
    src, dst = unicode_decimal_digits()
    return F.translate(F.regexp_replace(_c(c), _EDGE_SPACE, ""), src, dst)


def integer_text_ok(stripped) -> Column:
    """Is the text from ``quantity_text`` an integer literal as Python's int() reads it?"""
    return F.coalesce(_c(stripped).rlike(_INT_CORE), F.lit(False))


def integer_text_value(stripped) -> Column:
    """Stripped integer text -> DECIMAL(38,0); NULL when not an integer or beyond 38 digits."""
    return F.when(integer_text_ok(stripped),
                  F.regexp_replace(_c(stripped), "_", "").try_cast("decimal(38,0)"))


def integer_text_nonpositive(stripped) -> Column:
    """For integer text: value <= 0 (also for negatives too long for DECIMAL(38,0))."""
    return integer_text_ok(stripped) & F.coalesce(integer_text_value(stripped) <= 0,
                                                  _c(stripped).startswith("-"))


def quantity_is_integer(c) -> Column:
    return integer_text_ok(quantity_text(c))


def parse_quantity(c) -> Column:
    return integer_text_value(quantity_text(c))


def quantity_is_nonpositive(c) -> Column:
    return integer_text_nonpositive(quantity_text(c))


def is_blank(c) -> Column:
    """NULL or empty text (the test ``not row.get(field)`` on a CSV row)."""
    return F.coalesce(_c(c), F.lit("")) == ""


def canonical_json(cols: list[str]) -> Column:
    """Row as JSON with keys in sorted order and NULLs kept."""
    return F.to_json(F.struct(*[F.col(x) for x in sorted(cols)]), {"ignoreNullFields": "false"})


def row_json(cols: list[str]) -> Column:
    """Row as JSON with the original column order and names, NULLs kept."""
    return F.to_json(F.struct(*[F.col(x) for x in cols]), {"ignoreNullFields": "false"})


def row_reference(id_col: str | None, cols: list[str]) -> Column:
    """Natural id if non-empty, else 'hash:' + first 16 hex chars of SHA-256 of the row."""
    digest = F.concat(F.lit(ROW_REFERENCE_PREFIX),
                      F.substring(F.sha2(canonical_json(cols), 256), 1, ROW_REFERENCE_HEX_CHARS))
    if id_col is None:
        return digest
    return F.coalesce(F.nullif(F.col(id_col), F.lit("")), digest)


def machine_day_key(machine, day) -> Column:
    """machine || '_' || date as text (NULL-propagating like SQL ||)."""
    return F.concat(_c(machine), F.lit("_"), _c(day).cast("string"))


def duration_hours(start, end) -> Column:
    """(end - start) in hours, microsecond-exact; may be negative."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(3600000000.0)


def defect_rate(fail, checked) -> Column:
    """round(fail / checked, 4) half-up in exact decimal; NULL (never 0) when nothing checked."""
    ratio = _c(fail).cast("decimal(20,0)") / _c(checked).cast("decimal(20,0)")
    return F.when(_c(checked) > 0, F.round(ratio, 4)).cast("double")


def safe_ratio(fail, checked) -> Column:
    """fail / checked as double, 0.0 when nothing was checked (a model feature)."""
    return F.when(_c(checked) == 0, F.lit(0.0)).otherwise(_c(fail).cast("double") / _c(checked))
