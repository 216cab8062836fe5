"""Text → typed value coercions.

Every function maps a raw STRING Column to a typed Column with built-in
expressions only, so it runs inside whole-stage codegen.  A parse failure is
NULL; ``*_invalid`` companions say whether a *non-empty* input failed, which
is what the rule engine reports as a ``type`` error.

Python's parsers (the reference's semantics) and Spark's differ at the edges,
so each parser is guarded by a regex of the accepted shapes:

* numbers: ``float()`` accepts ``1.``, ``.5``, ``1e3``, ``nan``, ``inf``; Spark
  casts would also accept ``1.5d`` — the guard rejects it.  ``1_0`` (accepted
  by Python) is rejected on purpose.
* ISO datetimes: ``fromisoformat`` rejects ``2024``, ``2024-1-5``, ``T10:00``
  that Spark's cast accepts; it accepts ``20240105`` that Spark's cast rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_NAN = ("nan", "+nan", "-nan")
_POS_INF = ("inf", "+inf", "infinity", "+infinity")
_NEG_INF = ("-inf", "-infinity")

_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_ISO_TS = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,6})?)?)?"
           r"(Z|[+-][0-9]{2}:?[0-9]{2})?$")
_BASIC_DATE = r"^[0-9]{8}$"
_BASIC_TS = r"^[0-9]{8}T[0-9]{6}$"
_AMPM = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2} [AaPp][Mm]$"

# Accepted boolean spellings of the reference's type check.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
# Source types of the reference's enum; others become 'unknown'.
SOURCE_TYPES = ("csv", "api", "excel")


def _s(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """NULL or empty text (before trimming, as the reference's first check)."""
    c = _s(c)
    return c.isNull() | (c == "")


def _float_text(c: Column) -> Column:
    return F.lower(F.trim(c))


def _parse_float_text(t: Column) -> Column:
    return (F.when(t.isin(*_NAN), F.lit(float("nan")))
             .when(t.isin(*_POS_INF), F.lit(float("inf")))
             .when(t.isin(*_NEG_INF), F.lit(float("-inf")))
             .when(t.rlike(_NUM), t.cast("double")))


def european_float(c) -> Column:
    """Decimal comma → point; blank → NULL; unparseable → NULL."""
    c = _s(c)
    t = F.replace(_float_text(c), F.lit(","), F.lit("."))
    return F.when(~is_blank(c) & (F.trim(c) != ""), _parse_float_text(t))


def european_float_invalid(c) -> Column:
    c = _s(c)
    return ~is_blank(c) & (F.trim(c) != "") & european_float(c).isNull()


def int_from_float(c) -> Column:
    """``int(float(text))`` — truncation toward zero; no comma handling."""
    c = _s(c)
    f = _parse_float_text(_float_text(c))
    ok = f.isNotNull() & ~F.isnan(f) & (F.abs(f) < F.lit(9.2e18))
    return F.when(~is_blank(c) & (F.trim(c) != "") & ok, f.cast("long"))


def int_from_float_invalid(c) -> Column:
    c = _s(c)
    return ~is_blank(c) & (F.trim(c) != "") & int_from_float(c).isNull()


def _has_ampm(t: Column) -> Column:
    low = F.lower(t)
    return low.contains("am") | low.contains("pm")


def _iso_wall_time(t: Column) -> Column:
    """Offset dropped (wall time kept), comma fraction → point, hour-only time → ``HH:00``."""
    x = F.regexp_replace(F.regexp_replace(t, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", ""), ",", ".")
    return F.when(x.rlike(r"[T ][0-9]{2}$"), F.concat(x, F.lit(":00"))).otherwise(x)


def _iso_timestamp(t: Column) -> Column:
    return (F.when(t.rlike(_ISO_DATE), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")))
             .when(t.rlike(_ISO_TS), _iso_wall_time(t).try_cast("timestamp_ntz"))
             .when(t.rlike(_BASIC_DATE), F.try_to_timestamp(t, F.lit("yyyyMMdd")))
             .when(t.rlike(_BASIC_TS), F.try_to_timestamp(t, F.lit("yyyyMMdd'T'HHmmss"))))


def datetime_ampm(c) -> Column:
    """``M/d/yyyy h:mm:ss AM`` when the text has am/pm, else ISO-8601 (TIMESTAMP_NTZ)."""
    t = F.trim(_s(c))
    amp = F.when(t.rlike(_AMPM), F.try_to_timestamp(t, F.lit("M/d/yyyy h:m:s a")))
    return F.when(_has_ampm(t), amp).otherwise(_iso_timestamp(t)).cast("timestamp_ntz")


def date_ampm(c) -> Column:
    """D3: date part; the am/pm form reads the hour as 24-hour and ignores the marker."""
    t = F.trim(_s(c))
    parts = F.regexp_extract_all(t, F.lit(r"([0-9]+)"), 1)
    hour_ok = F.element_at(parts, 4).cast("int") <= 23
    ymd = F.concat_ws("-", F.element_at(parts, 3), F.element_at(parts, 1), F.element_at(parts, 2))
    amp = F.when(t.rlike(_AMPM) & hour_ok & (F.element_at(parts, 5).cast("int") <= 59)
                 & (F.element_at(parts, 6).cast("int") <= 61),
                 F.to_date(F.try_to_timestamp(ymd, F.lit("yyyy-M-d"))))
    return F.when(_has_ampm(t), amp).otherwise(F.to_date(_iso_timestamp(t)))


def parse_invalid(raw, parsed: Column) -> Column:
    """Non-empty input whose parse failed (generic ``type`` error predicate)."""
    raw = _s(raw)
    return raw.isNotNull() & (raw != "") & parsed.isNull()


def bool_text(c) -> Column:
    """true/1/yes/y and false/0/no/n, case-insensitive; else NULL."""
    low = F.lower(F.trim(_s(c)))
    return F.when(low.isin(*TRUE_WORDS), F.lit(True)).when(low.isin(*FALSE_WORDS), F.lit(False))


def time_text(c) -> Column:
    """``H:M:S`` clock time (24-hour) → seconds of day; NULL if invalid."""
    t = F.trim(_s(c))
    parts = F.split(t, ":")
    h, m, s = (F.element_at(parts, i).cast("int") for i in (1, 2, 3))
    ok = t.rlike(r"^[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$") & (h <= 23) & (m <= 59) & (s <= 61)
    return F.when(ok, h * 3600 + m * 60 + s)


def iso_datetime(c) -> Column:
    """ISO datetime check/parse of the older validator."""
    return _iso_timestamp(F.trim(_s(c))).cast("timestamp_ntz")


def iso_date(c) -> Column:
    """``%Y-%m-%d`` date."""
    t = F.trim(_s(c))
    return F.when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.to_date(F.try_to_timestamp(t, F.lit("yyyy-M-d"))))


def int_text(c) -> Column:
    """``int(text)`` — optional sign and digits (surrounding blanks allowed)."""
    t = F.trim(_s(c))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))


def float_text(c) -> Column:
    """``float(text)`` without decimal-comma handling."""
    return _parse_float_text(_float_text(_s(c)))


def strip(c) -> Column:
    """Whitespace strip of text fields."""
    return F.trim(_s(c))


def uuid_text(c) -> Column:
    """UUID normalisation to lower-case 8-4-4-4-12; NULL if not a UUID."""
    t = F.lower(F.regexp_replace(F.trim(_s(c)), r"^(urn:uuid:)|[{}-]", ""))
    ok = t.rlike(r"^[0-9a-f]{32}$")
    return F.when(ok, F.concat_ws("-", F.substring(t, 1, 8), F.substring(t, 9, 4), F.substring(t, 13, 4),
                                  F.substring(t, 17, 4), F.substring(t, 21, 12)))


def nan_to_null(c) -> Column:
    """NaN and ±Inf → NULL for floating columns."""
    c = _s(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def source_type(c) -> Column:
    """Known source types kept, anything else (or NULL) → 'unknown'."""
    c = _s(c)
    return F.when(c.isin(*SOURCE_TYPES), c).otherwise(F.lit("unknown"))
