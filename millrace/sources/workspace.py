"""Folders for written intermediates and streaming checkpoints."""

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may do without it.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder")
        shared = tempfile.mkdtemp(prefix="millrace-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
