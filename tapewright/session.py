"""Session helpers: local sessions for tests, streaming sessions, shared scratch folders."""

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus="*", app="tapewright", **conf):
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # No Python call sites in query errors; recording them slows every Column call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def streaming_session(spark, shuffle_partitions=None, state_provider=ROCKSDB_PROVIDER):
    """A sibling session whose settings suit stateful streams.

    A stream keeps the number of shuffle partitions of its first run for good, so it is set here
    and not inherited by accident. RocksDB keeps state off the heap, so it may outgrow memory.
    """
    session = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(key, spark.conf.get(key))
    if shuffle_partitions is None:
        shuffle_partitions = spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if state_provider:
        session.conf.set("spark.sql.streaming.stateStore.providerClass", state_provider)
        # A batch then stores its changes and not a snapshot of the whole state.
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def scratch_dir(spark, name):
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
