"""Run many independent parts as one Spark plan and find the ones that break it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Row, SparkSession

Part = TypeVar("Part")

#: What the rows, the schema or the files of a table can cause. See :func:`raise_if_lost`.
TABLE_ERRORS = (PySparkException, Py4JJavaError, OSError, ValueError)


def raise_if_lost(spark: SparkSession, error: Exception) -> None:
    """Raise ``error`` again if the cluster is gone: no table or rule is to blame for that."""
    if isinstance(error, ConnectionError) or _stopped(spark):
        raise error


def _stopped(spark: SparkSession) -> bool:
    context = spark.sparkContext._jsc
    return context is None or context.sc().isStopped()


def run_isolated(
    parts: Sequence[Part],
    run: Callable[[Sequence[Part]], list[Row]],
    on_error: Callable[[Part, Exception], list[Row]],
    errors: type[Exception] | tuple[type[Exception], ...] = Exception,
    suspects: Callable[[Sequence[Part], Exception], list[Part]] = lambda parts, error: [],
) -> list[Row]:
    """Rows of all parts. Normally one run.

    After an error the parts that ``suspects`` names run apart from the others; without a suspect
    the halves do, so one bad part among n costs about 2 log2(n) more runs and the good ones keep
    sharing theirs.
    """
    if not parts:
        return []
    try:
        return run(parts)
    except errors as error:
        if len(parts) == 1:
            return on_error(parts[0], error)
        named = suspects(parts, error)
    if 0 < len(named) < len(parts):
        split = [p for p in parts if p not in named], named
    else:
        middle = len(parts) // 2
        split = parts[:middle], parts[middle:]
    return [row for part in split for row in run_isolated(part, run, on_error, errors, suspects)]
