"""Text columns as one text, and back: shuffled, many short columns take a multiple of their characters.

An empty field is a NULL. A row with an empty text, or with a separator in a text, is kept as an array beside it, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SEPARATOR = "|"
_ODD = "_odd"


def text_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if f.dataType == StringType() and f.name not in but]


def pack(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` with the text columns, two at least, as one column ``name`` and that of odd rows, after all others."""
    values, rest = [F.col(c) for c in columns], [c for c in df.columns if c not in columns]
    empty = F.least(*[F.octet_length(v) for v in values]) == 0
    cut = F.greatest(*[F.instr(v, _SEPARATOR) for v in values]) > 0
    text = F.concat_ws(_SEPARATOR, *[F.coalesce(v, F.lit("")) for v in values])
    return df.select(*rest, text.alias(name), F.when(empty | cut, F.array(*values)).alias(name + _ODD))


def unpack(df: DataFrame, packed: dict[str, Sequence[str]], order: Sequence[str]) -> DataFrame:
    """The columns in ``order``; ``packed``: what each column made by :func:`pack` holds. Of a NULL, all are NULL."""
    rest = [c for c in df.columns if c not in packed]
    fields = df.select(*rest, *[F.split(name, "\\" + _SEPARATOR, -1).alias(name) for name in packed])
    made = {}
    for name, columns in packed.items():
        for i, c in enumerate(columns):
            plain = F.nullif(F.get(name, F.lit(i)), F.lit(""))
            made[c] = F.when(F.col(name + _ODD).isNull(), plain).otherwise(F.get(name + _ODD, F.lit(i))).alias(c)
    return fields.select(*[made.get(c, F.col(c)) for c in order])
