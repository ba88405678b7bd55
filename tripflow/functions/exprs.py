"""Column expressions with the reference engine's numeric and text semantics.

Every function here returns a ``Column`` built only from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; nothing runs in Python per row.

The reference engine differs from Spark in five places the trip models depend on:

* double -> text (surrogate keys hash text): shortest digits, exponent form only
  when the decimal exponent is below -4 or at least 16 (``1e+16``, ``5e-05``);
  Spark switches to ``1.0E7`` style already at 1e7 and below 1e-3.
* double -> integer rounds half to even (2.5 -> 2, 3.5 -> 4); Spark truncates.
* ``round(x, n)`` scales, rounds half away from zero and unscales in binary
  floating point; Spark rounds the decimal text of ``x``.
* ``datediff(unit, a, b)`` counts unit boundaries crossed; Spark's
  ``timestampdiff`` counts whole elapsed units.
* ISO day of week is Monday=1 .. Sunday=7; Spark's ``dayofweek`` is Sunday=1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The surrogate-key macro's NULL sentinel and field separator.
KEY_NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip_fraction_zeros(text: Column) -> Column:
    """'12.3400' -> '12.34', '10.000' -> '10.0'."""
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ".0")


def _shortest_exponent_text(x: Column, s: Column) -> Column:
    """``-d.ddde+XX`` of a double with as few digits as read back as the same double.

    ``s`` is Spark's text (``-d.dddE-XX``), whose digits read back, but which may have more of them than are
    needed. For each number of digits the two neighbours of these digits are tried, the nearer first,
    and the first one that reads back is taken.
    """
    digits = F.regexp_replace(F.regexp_extract(s, r"^-?([0-9.]+)E", 1), r"\.", "")
    power = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).cast("int")
    a = F.abs(x)
    # whole numbers are taken exactly, in two halves of 63 bits: Spark's own digits of these are rounded
    half = float(1 << 63)
    high = F.floor(a / half)
    low = (a - high.cast("double") * half).cast("bigint")
    held = (a >= 1e16) & (a < 8e34)
    whole = F.when(held, high.cast("decimal(17,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)") + low.cast("decimal(20,0)"))
    long_text = whole.cast("string")
    power = F.when(held, F.length(long_text) - 1).otherwise(power)
    digits = F.when(held, long_text).otherwise(digits)
    # normal numbers need 15 to 17 digits, or fewer and zeros; those near zero any number
    sizes = F.when(a < 2.3e-308, F.sequence(F.lit(1), F.lit(17))).otherwise(F.array(F.lit(15), F.lit(16), F.lit(17)))
    # each step is bound to a name (an array of one), so that it is computed once
    parts = F.array(F.struct(digits.alias("d"), power.alias("p"), a.alias("a"), sizes.alias("n")))

    def neighbours(part: Column) -> Column:
        def cut(n: Column) -> Column:
            k = F.least(n, F.length(part["d"]))
            low = F.substr(part["d"], F.lit(1), k).cast("bigint")
            up = F.when(F.substr(part["d"], k + 1, F.lit(1)) >= "5", 1).otherwise(0)
            # the nearer first
            return F.transform(F.array(low + up, low + 1 - up), lambda v: F.concat(v.cast("string"), F.lit("E"), (part["p"] - k + 1).cast("string")))
        return F.filter(F.flatten(F.transform(part["n"], cut)), lambda t: t.cast("double") == part["a"])

    best = F.get(F.flatten(F.transform(parts, neighbours)), F.lit(0))
    return F.get(F.transform(F.array(best), lambda t: _exponent_form(t, s)), F.lit(0))


def _exponent_form(best: Column, s: Column) -> Column:
    """``123000E5`` -> ``1.23e+10``, with the sign of ``s``."""
    # the digits without trailing zeros, and the power of the first of them
    whole = F.regexp_extract(best, r"^([0-9]+)E", 1)
    first = F.regexp_extract(best, r"E(-?[0-9]+)$", 1).cast("int") + F.length(whole) - 1
    kept = F.regexp_replace(whole, "0+$", "")
    tail = F.substr(kept, F.lit(2))
    mantissa = F.concat(F.substr(kept, F.lit(1), F.lit(1)), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)))
    sign = F.when(first < 0, "e-").otherwise("e+")
    return F.concat(F.when(s.startswith("-"), "-").otherwise(""), mantissa, sign, 
                    F.when(F.abs(first) < 10, "0").otherwise(""), F.abs(first).cast("string"))


def double_text(c: Column | str) -> Column:
    """Text of a double as the reference engine prints it.

    Spark prints the same shortest round-trip digits, but uses plain notation
    only for 1e-3 <= |x| < 1e7 and ``1.5E20`` otherwise; the target uses plain
    notation for decimal exponents -4..15 and ``1.5e+20`` / ``5e-05`` beyond.
    The two ranges where only the target is plain go through an exact decimal
    cast (a double becomes a decimal through its shortest text); the
    exponent form is rewritten by pattern. Each branch runs only for its range.
    """
    x = _col(c).cast("double")
    s = x.cast("string")
    a = F.abs(x)
    sci = _shortest_exponent_text(x, s)
    # most values: told by the number alone, so that the costly text is made once
    return (F.when(((a >= F.lit(1e-3)) & (a < F.lit(1e7))) | (x == 0), s)
            .when(x.isNull(), F.lit(None).cast("string"))
            .when(~s.contains("E"),
                   F.when(s == "NaN", F.lit("nan"))
                   .when(s == "Infinity", F.lit("inf"))
                   .when(s == "-Infinity", F.lit("-inf"))
                   .otherwise(s))
            .when((a >= F.lit(1e7)) & (a < F.lit(1e16)),
                  _strip_fraction_zeros(x.cast("decimal(38,10)").cast("string")))
            .when((a >= F.lit(1e-4)) & (a < F.lit(1e-3)),
                  _strip_fraction_zeros(x.cast("decimal(38,24)").cast("string")))
            .otherwise(sci))


def key_text(c: Column | str, dtype: T.DataType) -> Column:
    """Text of a raw value as it enters a surrogate key (NULL stays NULL)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return double_text(_col(c).cast("double"))
    return _col(c).cast("string")


def surrogate_key(cols: list[tuple[str, T.DataType]]) -> Column:
    """md5 over the separator-joined key texts; a NULL field becomes the sentinel.

    ``concat_ws`` is not usable: it skips NULL fields instead of writing the sentinel.
    """
    parts: list[Column] = []
    for i, (name, dtype) in enumerate(cols):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(F.coalesce(key_text(name, dtype), F.lit(KEY_NULL_SENTINEL)))
    return F.md5(F.concat(*parts))


def to_int_half_even(c: Column | str) -> Column:
    """``cast(double as integer)`` with half-to-even rounding (2.5 -> 2, 3.5 -> 4)."""
    return F.rint(_col(c)).cast("int")


def round_half_away(c: Column | str, digits: int) -> Column:
    """``round(x, n)`` on doubles: scale, round half away from zero, unscale.

    The scaled value is rounded at scale 0, where Spark's rounding of the
    shortest decimal text agrees with binary half-away rounding.
    """
    scale = float(10 ** digits)
    return F.round(_col(c) * F.lit(scale), 0) / F.lit(scale)


def _epoch_seconds(c: Column) -> Column:
    # unix_timestamp on timestamp_ntz reads the wall clock as UTC, whatever the session zone
    return F.unix_timestamp(c)


def boundaries_between(unit: str, start: Column | str, end: Column | str) -> Column:
    """``datediff(unit, start, end)``: number of unit boundaries crossed (BIGINT).

    00:00:59 -> 00:01:01 is 1 minute here, 0 with Spark's ``timestampdiff``.
    """
    width = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.lower()]
    s, e = _epoch_seconds(_col(start)), _epoch_seconds(_col(end))
    w = F.lit(width).cast("bigint")
    # floor division also for instants before 1970
    return F.floor(e / w).cast("bigint") - F.floor(s / w).cast("bigint")


def iso_dow(c: Column | str) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7 (INT)."""
    return (F.weekday(_col(c)) + F.lit(1)).cast("int")


def pct_deviation(value: Column | str, base: Column | str) -> Column:
    """``abs(a - b) / nullif(abs(b), 0) * 100``; NULL when the base is 0 or NULL."""
    v, b = _col(value), _col(base)
    return F.abs(v - b) / F.nullif(F.abs(b), F.lit(0.0)) * F.lit(100.0)
