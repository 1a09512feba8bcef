"""Key building: composite string keys the way the SQL layer spells them."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def padded(number, width: int) -> Column:
    """``%0<width>d`` of a number: a formatter parses its form for every row, so it is
    asked only for what it spells in its own way (negative numbers, NULL)."""
    n = _c(number)
    digits = n.cast("string")
    return F.when(n >= 0, F.when(n < 10 ** width, F.lpad(digits, width, "0")).otherwise(digits)) \
        .otherwise(F.format_string(f"%0{width}d", n))


def seq4(seq) -> Column:
    """zero-padded to four digits (wider numbers keep all their digits); NULL stays NULL."""
    s = _c(seq)
    return F.when(s.isNotNull(), padded(s, 4))


def joined(*parts) -> Column:
    """``a || '_' || b``; NULL if any part is NULL (unlike concat_ws)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("_"))
        cols.append(_c(p))
    return F.concat(*cols)


def entry_id(case_id, seq) -> Column:
    """``incident_id || '_' || to_char(seq, 'FM0000')``."""
    return joined(case_id, seq4(seq))


def case_id(category: str, number) -> Column:
    """``CAT-000001`` style id, number zero-padded to six digits."""
    n = _c(number)
    return F.when(n.isNotNull(), F.format_string("%s-%06d", F.lit(category), n))
