"""Session settings that jobs need while they run."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from typing import Any

from pyspark.sql import SparkSession

# The JVM compiles no method above 8000 bytes. A whole stage over a wide table easily gets one
# and then runs interpreted; with this limit Spark splits such stages into small methods.
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Keep generated methods within what the JVM compiles; a lower user setting stays."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def compiled(job: Callable[..., Any]) -> Callable[..., Any]:
    """Run a job whose first argument is a session under :func:`compiled_methods`."""

    @wraps(job)
    def run(spark: SparkSession, *args: Any, **options: Any) -> Any:
        with compiled_methods(spark):
            return job(spark, *args, **options)

    return run
