"""Read staged Parquet."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from starloom import schemas

logger = logging.getLogger(__name__)

ENTITIES = list(schemas.STAGING)


def read_staged(spark: SparkSession, source_dir: str, entity: str) -> DataFrame | None:
    """The current batch of an entity: every Parquet file below ``source_dir/entity``.

    Only the declared columns are read, in their declared order and types. A missing entity gives
    None and a warning, and its merge is to be skipped.
    """
    path = f"{source_dir.rstrip('/')}/{entity}"
    try:
        found = spark.read.option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        logger.warning("no parquet found for %s, skipping", entity)
        return None
    return schemas.conform(found, schemas.STAGING[entity])
