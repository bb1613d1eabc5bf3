"""Message sources, as a stream or as a table, with the format chosen by the caller."""

# Fixed value: rows of one archive flush when the caller names none.
FLUSH_ROWS = 500
# End of fixed value.

KAFKA_COLUMNS = ["key", "value", "partition", "offset"]


def is_directory(spark, path):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def kafka_options(brokers, topic, max_offsets_per_trigger=None):
    """Options for a topic read from its start; a stream resumes from its checkpoint after that."""
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark, brokers, topic, stream=True, max_offsets_per_trigger=None):
    """Topic rows as text with partition and offset, the version of a message within its key.

    Needs the Spark Kafka package on the class path.
    """
    reader = spark.readStream if stream else spark.read
    options = kafka_options(brokers, topic, max_offsets_per_trigger if stream else None)
    return (
        reader.format("kafka")
        .options(**options)
        .load()
        .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "partition", "offset")
    )


def read_kafka_flushes(spark, brokers, topic, rows_per_flush=FLUSH_ROWS):
    """The log as a stream for the archive: a trigger takes at most ``rows_per_flush`` messages, so a backlog is many
    flushes.

    Files grow with that number; on a large log raise it to what one flush should hold.
    """
    return read_kafka(spark, brokers, topic, stream=True, max_offsets_per_trigger=rows_per_flush)


def read_messages(spark, path, stream=False, max_files_per_trigger=None):
    """Recorded messages, one JSON text per line, in a ``value`` column."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_parquet(spark, path, schema, max_files_per_trigger=None):
    """A Parquet file or folder as a stream; a folder picks up files added later."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_directory(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)
