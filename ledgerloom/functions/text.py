"""String helpers with the NULL rules of the source system: '' is NULL and NULL adds nothing to a string."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def cat(*parts) -> Column:
    """Concatenate; NULL parts vanish and an all-empty result is NULL."""
    return F.nullif(F.concat_ws("", *[as_col(p) for p in parts]), F.lit(""))


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def decode(column: Column, pairs: Sequence[tuple], default=None) -> Column:
    """First pair whose key equals the column wins; NULL matches NULL; no default gives NULL."""
    branches = [(column.eqNullSafe(as_col(key)), as_col(value)) for key, value in pairs]
    chain = F.when(*branches[0])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain if default is None else chain.otherwise(as_col(default))


def any_null(*names: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def strip_breaks(column: Column) -> Column:
    return F.translate(column, "\r\n", "")


def length_is_one_of(code: Column, lengths: Sequence[int], strict: bool = False) -> Column:
    """Test on the length of a code. The loose form looks for any of the digits inside the length
    (14 and 16 pass for 4|6|8); the strict form compares exactly. NULL code gives NULL."""
    if strict:
        return F.length(code).isin(*lengths)
    return F.length(code).cast("string").rlike("|".join(str(n) for n in lengths))


def given_or_column(column: Column, value) -> Column:
    """Optional filter `column = nvl(value, column)`: with no value it still drops NULL columns."""
    return column.isNotNull() if value is None else column == F.lit(value)
