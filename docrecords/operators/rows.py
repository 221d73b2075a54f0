"""Two row-level building blocks that keep costly expressions from being repeated.

The optimizer moves filters below the projection that computes a column and
repeats the expression there, and it adds a non-empty filter, again with the whole
expression, below every inner explode. Neither happens across the forms used here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pin(df: DataFrame, *names: str) -> DataFrame:
    """The same rows; the named columns are computed once, whatever filter follows.

    They become the output of a generator with exactly one row per input row.
    """
    others = [c for c in df.columns if c not in names]
    one = F.inline(F.array(F.struct(*[F.col(n).alias(n) for n in names])))
    return df.select(*others, one).select(*df.columns)


def unnest(df: DataFrame, array: str, keep: Sequence[str], position: str | None = None) -> DataFrame:
    """One row per element of an array of structs: ``keep``, then the struct's fields.

    With ``position`` the element's place, from 0, is added. NULL elements are rows
    of NULLs; NULL and empty arrays give no row.
    """
    element = df.schema[array].dataType.elementType
    rows = df.select(*keep, F.posexplode_outer(array).alias("_pos", "_element")).filter(F.col("_pos").isNotNull())
    fields = (
        [F.col(f"_element.{f.name}").alias(f.name) for f in element.fields]
        if isinstance(element, T.StructType)
        else [F.col("_element").alias(array)]
    )
    place = [] if position is None else [F.col("_pos").alias(position)]
    return rows.select(*keep, *place, *fields)
