"""Evaluating what may raise, row by row."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def null_if_raised(value: Column) -> Column:
    """The value, or null where computing it raises; a value of its own should not be null.

    Spark has the `try_` form of many functions but not of all, nor of conditions made of them. This
    is the expression that several of these are made of. It stands around a lambda, whose body Spark
    never evaluates ahead of time as a part that several expressions share: such a part would raise
    outside. Python UDFs cannot be inside.
    """
    jvm = SparkSession.active()._jvm
    convert = jvm.org.apache.spark.sql.classic.ExpressionUtils
    tried = jvm.org.apache.spark.sql.catalyst.expressions.TryEval
    alone = F.transform(F.array(F.lit(0)), lambda _: value)
    return F.get(type(alone)(convert.column(tried(convert.expression(alone._jc)))), F.lit(0))
