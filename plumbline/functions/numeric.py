"""Text to integer without errors under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks and control characters around a number are ignored.
_EDGE = r"[\x00-\x20\x7f]*"
_WITH_FRACTION = rf"^{_EDGE}([+-]?[0-9]+)[.][0-9]*{_EDGE}$"
_FRACTION_ONLY = rf"^{_EDGE}[+-]?[.][0-9]*{_EDGE}$"


def safe_int(text: Column) -> Column:
    """Integer value of a string column, NULL where there is none.

    Blanks are trimmed and a fraction is cut off (``'-2.9'`` is -2, ``'.5'`` is
    0); exponents, other text and values beyond 32 bits give NULL. Plain
    integers take the first branch and never meet a regular expression.
    """
    return F.coalesce(
        text.try_cast("int"),
        F.regexp_extract(text, _WITH_FRACTION, 1).try_cast("int"),
        F.when(text.rlike(_FRACTION_ONLY), F.lit(0)),
    )
