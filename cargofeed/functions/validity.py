"""Master air-waybill number checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source job's:
#   WT rule: exactly 11 characters, all of them digits 0-9
#   CW rule: more than 10 characters
WT_MAWB_LENGTH = 11
CW_MAWB_MIN_LENGTH = 11
# \A and \z anchor the whole input (^...$ would accept a trailing newline)
WT_MAWB_PATTERN = r"\A[0-9]{11}\z"


def valid_mawb(c: Column | str, rule: str = "wt") -> Column:
    """True when ``c`` is a usable MAWB number under ``rule`` ('wt' or 'cw').

    NULL input gives NULL, which a filter treats as false.
    """
    c = F.col(c) if isinstance(c, str) else c
    if rule == "wt":
        return (F.length(c) == WT_MAWB_LENGTH) & c.rlike(WT_MAWB_PATTERN)
    if rule == "cw":
        return F.length(c) >= CW_MAWB_MIN_LENGTH
    raise ValueError(f"unknown MAWB rule {rule!r}")


def is_code(c: Column | str, *codes: str) -> Column:
    """True when ``c`` is one of ``codes``, trailing blanks aside.

    ``rtrim(c) = code`` alone reaches no scan; the prefix test beside it is
    implied by it and is pushed down.
    """
    c = F.col(c) if isinstance(c, str) else c
    starts = reduce(lambda a, b: a | b, [c.startswith(code) for code in codes])
    return starts & F.rtrim(c).isin(list(codes))


def non_empty(c: Column | str) -> Column:
    """The export-side guard: a non-empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.length(c) > 0
