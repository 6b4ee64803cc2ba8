"""Places for intermediate datasets."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: executors of a cluster would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/tablehaul/{name}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tablehaul-")
