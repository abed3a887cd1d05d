"""Session settings the models rely on, and the scratch folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings; cluster sizing (executors, memory, shuffle partitions) stays with the caller.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot customers, plans or invoices: split oversized join partitions even where the split
    # costs a further shuffle above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A query's shuffle files go when it ends, not when the driver happens to collect its garbage: jobs that store
    # their steps hold the files of one step at a time. A DataFrame that is collected twice shuffles again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="retentia-")


def _run_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_folder().name
    return f"{shared.rstrip('/')}/retentia-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``, in one folder per application.

    Only a local master without that setting (tests, notebooks) gets a machine-local folder, which is removed
    when the process ends.
    """
    return f"{_run_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove all that this application has put below :func:`scratch_dir`; says whether there was anything.

    For the end of a job: results that were not written elsewhere still read from there, and fail afterwards.
    Nothing that another application wrote is touched.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
