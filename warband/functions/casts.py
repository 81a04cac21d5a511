"""Column expressions for typing raw attribute strings.

All of them are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number with optional exponent and surrounding blanks. Spark alone would also
# accept Java suffixes such as '1d' or '2f'; the match-log typing rejects them.
_NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_SPECIAL = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_double(c) -> Column:
    """String → double; junk, empty and suffixed forms become NULL."""
    s = _col(c).cast("string")
    ok = s.rlike(_NUMERIC) | F.lower(F.trim(s)).isin(_SPECIAL)
    return F.when(ok, s.try_cast("double"))


def lenient_int(c) -> Column:
    """String → int that rounds fractional and exponent forms ('1.5' → 2, '1e3' → 1000).

    Half-way values round away from zero; out-of-range and junk become NULL.
    """
    d = strict_double(c)
    return F.round(d).try_cast("int")


def win_flag(c) -> Column:
    """'1'/'true' → 1, '0'/'false' → 0 (any case), anything else NULL."""
    s = F.lower(_col(c).cast("string"))
    return (F.when(s.isin("1", "true"), F.lit(1))
            .when(s.isin("0", "false"), F.lit(0))
            .otherwise(F.lit(None).cast("int")))


def word_match(c, word: str) -> Column:
    """True when ``word`` occurs with ASCII word boundaries on both sides."""
    return _col(c).rlike(f"(?<![0-9A-Za-z_]){word}(?![0-9A-Za-z_])")


def short_id(c, length: int) -> Column:
    """Cut an id to ``length`` characters plus an ellipsis when it is longer."""
    x = _col(c)
    return F.when(F.length(x) > length, F.concat(F.substring(x, 1, length), F.lit("…"))).otherwise(x)


def elapsed_seconds(start, end) -> Column:
    """Seconds from ``start`` to ``end`` at microsecond precision, as double.

    ``timestamp_diff`` works on both timestamp types without a time-zone shift.
    """
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / F.lit(1e6)
