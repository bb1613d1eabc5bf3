"""Candle and trade tables kept in a relational database."""

from pyspark.sql import functions as F


def read_jdbc(spark, url, table, schema, properties=None, bounds=None):
    """The columns of ``schema`` from a table; filters and column choice are sent to the database.

    ``bounds`` = (column, lowest, highest, partitions) reads in parallel slices of that column; without
    it one task reads all, which suits lookups by symbol only.
    """
    reader = spark.read
    if bounds:
        column, lowest, highest, partitions = bounds
        rows = reader.jdbc(
            url, table, column=column, lowerBound=lowest, upperBound=highest, numPartitions=partitions,
            properties=properties,
        )
    else:
        rows = reader.jdbc(url, table, properties=properties)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
