"""Turning dirty cells into typed values or NULL, never into an error."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schema import NA_TOKENS

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def blank_to_null(c: Column, tokens=NA_TOKENS) -> Column:
    return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)


# These three are written as SQL text: one expression per column instead of a dozen
# calls keeps building a plan over a wide record quick.


def parsed(name: str, source: T.DataType) -> Column:
    """The column as doubles; text that is not a plain number is NULL.

    Java reads "5d", "5f" and hexadecimal as doubles, which a data file does not.
    """
    cell = f"`{name}`"
    if not isinstance(source, T.StringType):
        return F.expr(f"CAST({cell} AS DOUBLE)")
    odd = [f"contains({cell}, '{x}')" for x in "xX"] + [f"endswith({cell}, '{x}')" for x in "dDfF"]
    return F.expr(f"CASE WHEN NOT ({' OR '.join(odd)}) THEN try_cast({cell} AS DOUBLE) END")


def narrowed(name: str, target: T.DataType) -> Column:
    """A parsed double in its declared type; NULL when it does not fit exactly."""
    cell, kind = f"`{name}`", target.simpleString()
    if isinstance(target, _INTEGRAL):
        return F.expr(f"CASE WHEN {cell} = floor({cell}) THEN try_cast({cell} AS {kind}) END")
    return F.expr(f"CAST(CASE WHEN abs({cell}) < double('Infinity') THEN {cell} END AS {kind})")


def conformed(df: DataFrame, declared: Mapping[str, T.DataType]) -> DataFrame:
    """Cast the declared columns, in two projections so each cell is parsed once."""
    steps = {}
    for f in df.schema:
        want = declared.get(f.name, f.dataType)
        if isinstance(f.dataType, _INTEGRAL) and isinstance(want, _INTEGRAL):
            steps[f.name] = (F.col(f.name), F.col(f.name).try_cast(want))
        elif isinstance(want, T.NumericType) and f.name in declared:
            steps[f.name] = (parsed(f.name, f.dataType), narrowed(f.name, want))
        else:
            steps[f.name] = (F.col(f.name) if f.dataType == want else F.col(f.name).cast(want), F.col(f.name))
    once = df.select(*[first.alias(name) for name, (first, _) in steps.items()])
    return once.select(*[second.alias(name) for name, (_, second) in steps.items()])
