"""Stream sources and sinks.

The reference reads a TCP socket and a Kafka topic.  Both are available as
builders here; tests drive the same pipelines from the file source because
no broker runs and no port may be opened.  Sinks: console (the reference's),
a parquet file sink (exactly-once through its commit log) and an idempotent
``foreachBatch`` table of versions used for update/complete output modes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def socket_source(spark: SparkSession, host: str = "localhost", port: int = 8989) -> DataFrame:
    """Unbounded text lines (column ``value``) from a TCP socket."""
    return (spark.readStream.format("socket").option("host", host).option("port", port)
            .load())


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  group_id: str | None = None, fail_on_data_loss: bool = True,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    Offsets are tracked in the query's checkpoint (the reference disabled
    auto-commit for the same reason); ``group_id`` only names the consumer
    group for monitoring.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """Records with string ``key``/``value`` and the broker ``timestamp``."""
    raw = spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, **kw))
    try:
        df = raw.load()
    except Exception as e:  # the connector jar is a deployment choice
        raise RuntimeError("the Kafka source needs the spark-sql-kafka package on the "
                           "classpath") from e
    return df.selectExpr("cast(key as string) as key", "cast(value as string) as value",
                         "timestamp")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving at ``path`` as an unbounded table (schema required).

    ``path`` is a folder of files or one file; ``glob`` keeps only files of
    matching names in a folder that holds others too.  A replay of many files
    is one micro-batch per ``max_files_per_trigger`` of them.
    """
    # The source takes a plain path for a folder only; a single file is named
    # by a pattern that matches nothing but itself.
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(where) and files.getFileStatus(where).isFile():
        path = f"{path[:-1]}[{path[-1]}]"
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def console_sink_options(num_rows: int = 50, truncate: bool = False) -> dict[str, str]:
    return {"numRows": str(num_rows), "truncate": str(truncate).lower()}


def console_sink(df: DataFrame, output_mode: str = "update", num_rows: int = 50,
                 truncate: bool = False):
    """The reference's sink: print each micro-batch (``numRows`` rows) on the driver."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .options(**console_sink_options(num_rows, truncate)))


#: The columns of Spark's Kafka source.
KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
                "timestampType int")


def delivered_once(records: DataFrame, watermark: str) -> DataFrame:
    """Kafka-shaped stream rows, each (topic, partition, offset) once.

    A producer's retry or a rewound consumer delivers a record again; its
    place in the topic is the same.  State holds one place per record and is
    dropped ``watermark`` after the record's own timestamp, so a repeat must
    come within that time.
    """
    return records.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])
