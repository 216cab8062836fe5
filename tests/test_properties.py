"""Property tests: Spark expressions against Python models of the documented semantics."""

import math
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pasture.functions import coerce as C
from pasture.functions.numeric import ratio_units


def py_european_float(v):
    """Model of D1: blank → None; strip; comma → point; float() or error (underscores excluded)."""
    if v is None or v == "":
        return None
    v = v.strip()
    if v == "":
        return None
    try:
        return float(v.replace(",", "."))
    except ValueError:
        return "error"


TEXT = st.text(alphabet="0123456789.,+-eE nafity", max_size=7)


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_european_float_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    got = df.select(C.european_float("raw"), C.european_float_invalid("raw")).collect()
    for v, (val, bad) in zip(values, got):
        exp = py_european_float(v)
        if exp == "error":
            assert bad and val is None, v
        elif exp is None:
            assert val is None and not bad, v
        elif math.isnan(exp):
            assert val is not None and math.isnan(val), v
        else:
            assert val == exp and not bad, v


def half_away(num, den, dp):
    q = Fraction(num, den) * 10 ** dp
    d = Decimal(q.numerator) / Decimal(q.denominator)
    return int(d.quantize(Decimal(1), rounding=ROUND_HALF_UP))     # HALF_UP on Decimal = away from zero


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=50),
       st.integers(0, 6))
def test_ratio_rounding_is_exact(spark, pairs, dp):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio_units(F.col("n"), F.col("d"), dp)).collect()]
    assert got == [half_away(n, d, dp) for n, d in pairs]


def py_datetime(v):
    """Model of D2: am/pm → '%m/%d/%Y %I:%M:%S %p', else ISO-8601 (offset dropped, wall time kept)."""
    import datetime as dt
    v = v.strip()
    try:
        if "am" in v.lower() or "pm" in v.lower():
            return dt.datetime.strptime(v, "%m/%d/%Y %I:%M:%S %p")
        return dt.datetime.fromisoformat(v).replace(tzinfo=None)
    except ValueError:
        return None


AMPM = st.builds(lambda mo, d, y, h, mi, s, ap: f"{mo}/{d}/{y} {h}:{mi:02d}:{s:02d} {ap}",
                 st.integers(0, 13), st.integers(0, 32), st.integers(1990, 2030), st.integers(0, 13),
                 st.integers(0, 61), st.integers(0, 61), st.sampled_from(["AM", "PM", "am", "pm"]))
ISO = st.builds(lambda y, mo, d, h, mi, s, sep, off: f"{y:04d}-{mo:02d}-{d:02d}{sep}{h:02d}:{mi:02d}:{s:02d}{off}",
                st.integers(1990, 2030), st.integers(0, 13), st.integers(0, 32), st.integers(0, 24),
                st.integers(0, 60), st.integers(0, 60), st.sampled_from(["T", " "]),
                st.sampled_from(["", "Z", "+02:00", "-0530", ".5", ".123456"]))
SHORT = st.builds(lambda y, mo, d, h, sep, tail: f"{y:04d}-{mo:02d}-{d:02d}{sep}{h:02d}{tail}",
                  st.integers(1990, 2030), st.integers(1, 12), st.integers(1, 28), st.integers(0, 24),
                  st.sampled_from(["T", " "]), st.sampled_from(["", ":30", ":30:15,25", "+02:00", "Z"]))
BASIC = st.builds(lambda y, mo, d: f"{y:04d}{mo:02d}{d:02d}", st.integers(1990, 2030), st.integers(0, 13),
                  st.integers(0, 32))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(AMPM, ISO, SHORT, BASIC), min_size=1, max_size=60))
def test_datetime_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    got = [r[0] for r in df.select(C.datetime_ampm("raw")).collect()]
    for v, g in zip(values, got):
        assert g == py_datetime(v), v
