"""All queries of the core and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairloom.plans import files, ingest, layout, layout_sql, metrics


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for module in (ingest, layout, metrics, files) for f in module.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**ingest.ORACLES, **layout_sql.ORACLES, **metrics.ORACLES, **files.ORACLES}
