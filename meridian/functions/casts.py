"""Scalar conform rules of the staging model: E1-E5.

All are compositions of built-in Spark expressions, so they stay inside
whole-stage codegen. ``lenient_int`` reproduces the embedded engine's
``try_cast(text as int)`` rules rather than Spark's strict ANSI cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text-to-int rules the staging model relies on.
#   whitespace trimmed around numbers: tab, newline, vertical tab, form feed, carriage return, space
#   a single "_" between two digits is a digit separator ("1_000" is 1000)
#   fractions and exponents round half away from zero ("2.5" is 3, "-2.5" is -3, "1e2" is 100)
#   "0x" / "0b" prefixes (either case) read hex / binary; leading whitespace allowed, trailing not
#   an exponent must lie in -32768..32767; within it a zero mantissa is 0 ("0e999" is 0)
#   before an exponent the whole digits must fit 64 bits ("9223372036854775808e-10" is NULL)
#   one "." may follow the exponent digits ("1e2." is 100)
#   anything else (other characters, non-ASCII digits, NaN, inf, overflow) is NULL
_WS = "\\t\\n\\x0B\\f\\r "
_ALLOWED_TEXT = f"\\A[{_WS}\\x21-\\x7E]*\\z"
_HEX = f"\\A[{_WS}]*0[xX][0-9a-fA-F]+(_[0-9a-fA-F]+)*\\z"
_BIN = f"\\A[{_WS}]*0[bB][01]+(_[01]+)*\\z"
_DIGIT_SEPARATOR = "(?<=[0-9])_(?=[0-9])"
_EXP_MIN, _EXP_MAX = -32768, 32767
# sign, whole digits, fraction digits and exponent of decimal text
_DECIMAL = f"\\A[{_WS}]*([+-]?)([0-9]*)(?:\\.([0-9]*))?(?:[eE]([+-]?[0-9]+)\\.?)?[{_WS}]*\\z"
_SEP = "\x01"  # outside the allowed characters
_INT_TEXT = f"\\A[{_WS}]*[+-]?[0-9]+[{_WS}]*\\z"


# Characters the staging engine's trim() removes - the Unicode space
# separators (category Zs); tabs and newlines are not among them.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def trimmed(col: Column | str) -> Column:
    """E1 ``trim(x)``: strips space separators from both ends; tabs and newlines stay."""
    return F.trim(_c(col), F.lit(SPACE_SEPARATORS))


def blank_to_null(col: Column | str) -> Column:
    """E2 ``nullif(trim(x), '')``."""
    return F.nullif(trimmed(col), F.lit(""))


def yes_no(col: Column | str) -> Column:
    """E4 'Yes' -> true, 'No' -> false, anything else -> NULL."""
    c = _c(col)
    return F.when(c == "Yes", F.lit(True)).when(c == "No", F.lit(False))


def y_only(col: Column | str) -> Column:
    """E5 'Y' -> true, anything else -> NULL (never false)."""
    return F.when(_c(col) == "Y", F.lit(True))


def _rounded(text: Column) -> Column:
    """The int nearest to decimal text, decided on its digits: only the first digit behind the (shifted)
    point tells whether to round away from zero, so neither length nor exponent loses anything."""

    def number(x: Column) -> Column:
        sign, whole, fraction, exponent = (F.get(x, F.lit(i)) for i in range(4))
        shift = F.when(exponent == "", 0).otherwise(exponent.try_cast("int"))
        digits, point = F.concat(whole, fraction), F.length(whole) + shift
        kept = F.concat(sign, F.rpad(F.substring(digits, F.lit(1), point), point, "0")).try_cast("bigint")
        away = F.when(F.substring(digits, point + 1, F.lit(1)) < "5", 0).when(sign == "-", -1).otherwise(1)
        fits = shift.between(_EXP_MIN, _EXP_MAX) & (
            (exponent == "") | (whole == "") | F.concat(sign, whole).try_cast("bigint").isNotNull())
        return F.when(fits & (digits != ""), F.when(point < 0, 0).otherwise(F.try_add(
            F.when(point == 0, 0).otherwise(kept), F.when(point < F.length(digits), away).otherwise(0))).try_cast("int"))

    # bound by transform, so that the text is taken apart once a row
    parts = F.split(F.regexp_replace(text, _DECIMAL, _SEP.join(f"${i}" for i in range(1, 5))), _SEP)
    return F.get(F.transform(F.array(parts), lambda x: F.when(F.size(x) == 4, number(x))), F.lit(0))


def lenient_int(col: Column | str) -> Column:
    """E3 ``try_cast(x as int)`` with the staging engine's text rules (see fixed values above).

    Decimal text is rounded half away from zero on its digits, at any length and exponent;
    hex and binary go through ``conv``. Overflow of int gives NULL.
    """
    c = _c(col).cast("string")

    digits = F.regexp_replace(F.regexp_replace(c, "_", ""), f"\\A[{_WS}]*0[xXbB]0*(?=.)", "")
    # conv raises on 64-bit overflow under ANSI; more than 8 hex / 32 binary digits is not an int
    prefixed = F.when(c.rlike(_HEX) & (F.length(digits) <= 8), F.conv(digits, 16, 10).try_cast("int")).when(
        c.rlike(_BIN) & (F.length(digits) <= 32), F.conv(digits, 2, 10).try_cast("int"))
    plain = F.when(F.contains(c, F.lit("_")), F.regexp_replace(c, _DIGIT_SEPARATOR, "")).otherwise(c)
    # fast paths: integer-shaped text (the common case) goes to the native cast, which agrees
    # with the rules above on such text (overflow is NULL in both); text without a digit
    # (sentinels) is NULL at once. The native cast is only called on integer-shaped text:
    # on other text it takes a slow error path.
    return (
        F.when(c.rlike(_INT_TEXT), c.try_cast("int"))
        .when(~c.rlike("[0-9]") | ~c.rlike(_ALLOWED_TEXT), F.lit(None).cast("int"))
        .when(c.rlike("0[xXbB]"), prefixed)
        .otherwise(_rounded(plain))
    )


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
