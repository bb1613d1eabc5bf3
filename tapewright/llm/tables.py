"""Intermediate tables in the shared folder, which cut lineage and survive lost executors."""

from tapewright.session import scratch_dir


def stored(frame, name):
    """``frame`` written once as Parquet below ``spark.checkpoint.dir`` and read back.

    Later steps read the files instead of repeating the work, on any executor. Cleaning up that folder is left to
    the cluster, as for checkpoints, because lazy results still refer to the files.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
