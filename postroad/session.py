"""Session settings and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Runtime settings that the operators' results depend on.
SETTINGS = {
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings, and let workers run this package without installing it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    cloudpickle.register_pickle_by_value(sys.modules["postroad"])
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder that the cluster shares between its nodes.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session may
    go without one; it then gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all nodes can reach")
        root = tempfile.mkdtemp(prefix="postroad-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
