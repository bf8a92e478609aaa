"""Casts that lose nothing unseen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Types = Mapping[str, T.DataType]


def fitted(types: Types) -> list[Column]:
    """The named columns in the given types; a value that does not fit becomes NULL."""
    return [F.col(name).try_cast(kind).alias(name) for name, kind in types.items()]


def lost(name: str, kind: T.DataType) -> Column:
    """Whether ``fitted`` makes a value of the column NULL."""
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def lost_count(types: Types) -> Column:
    """How many values of all the columns ``fitted`` makes NULL, as an aggregate."""
    return sum((F.count_if(lost(*item)) for item in types.items()), F.lit(0).cast("long"))


def common_id_type(keys: Iterable[tuple[DataFrame, str]]) -> T.DataType:
    """A type that holds every id of these columns.

    Integers meet in the wider one. Integers and text meet as long integers if all of
    the text is whole numbers, which only reading it can tell, and else as text. Other
    mixtures meet as text.
    """
    keys = list(keys)
    types = [df.select(name).schema[0].dataType for df, name in keys]
    if all(kind == types[0] for kind in types):
        return types[0]
    number = [isinstance(kind, T.IntegralType) for kind in types]
    text = [isinstance(kind, T.StringType) for kind in types]
    if all(number):
        return T.LongType()
    if not all(a or b for a, b in zip(number, text)):
        return T.StringType()
    for (df, name), own in zip(keys, text):
        if own and not df.filter(lost(name, T.LongType())).limit(1).isEmpty():
            return T.StringType()
    return T.LongType()


def canonical_id(key: Column) -> Column:
    """An id as text that is the same for a number and for its spellings.

    Whole numbers lose blanks around them, a plus sign and leading zeros; all else stays as
    it is. So 7, '007' and '+7' meet, '-0' is 0, and 'C1' and '007a' are themselves.
    """
    text = key.cast("string")
    plain = F.regexp_replace(F.trim(text), r"^\+?(-?)0*(\d+)$", "$1$2")
    number = F.when(plain == "-0", "0").otherwise(plain)
    return F.when(F.trim(text).rlike(r"^[+-]?\d+$"), number).otherwise(text)
