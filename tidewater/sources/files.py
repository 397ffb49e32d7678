"""File and topic sources.

The broker connector is not on the classpath offline, so every topic reader
takes a ``format``: ``kafka`` on a cluster, or a file format whose folder
plays the topic (one sub-folder per topic keeps the topic as a column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of a broker record; file topics are written with the same columns.
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


def read_event_stream(spark: SparkSession, topics, *, fmt: str = "kafka", path: str | None = None,
                      schema: T.StructType | None = None, starting: str = "latest",
                      max_per_trigger: int | None = None, max_bytes: int | None = None, fail_on_data_loss: bool = False,
                      bootstrap: str | None = None) -> DataFrame:
    """Streaming source for one or many topics.

    ``max_per_trigger`` bounds a micro-batch by offsets (broker) or files, ``max_bytes``
    by the bytes of the files, so batches follow the data, not its layout.

    ``topics`` is a name or a list.  With ``fmt='kafka'`` the topic column
    comes from the broker; with a file format each topic is a sub-folder of
    ``path`` and the topic column comes from the folder name.
    """
    names = [topics] if isinstance(topics, str) else list(topics)
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", ",".join(names))
             .option("startingOffsets", starting)
             .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return r.load()
    r = spark.readStream.format(fmt).schema(schema or TOPIC_RECORD)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    frames = [r.load(f"{path.rstrip('/')}/{t}").withColumn("topic", F.lit(t)) for t in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_in_order(df: DataFrame, path: str, order_cols, files: int) -> None:
    """Add ``files`` files to a file topic such that a stream reads the rows in order:
    ranges of the order, one after the other, with file times that follow the names
    (a file stream takes the oldest files first).  Rows that agree in ``order_cols`` stay
    in one file.  For file systems whose times can be set."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names() -> set[str]:
        found = fs.listStatus(folder) if fs.exists(folder) else []
        return {f.getPath().toString() for f in found if f.getPath().getName().startswith("part-")}

    before = names()
    (df.repartitionByRange(files, *order_cols).sortWithinPartitions(*order_cols)
     .write.mode("append").parquet(path))
    written = sorted(names() - before)
    now = max([fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f)).getModificationTime() for f in before | set(written)], default=0)
    for i, name in enumerate(written):  # times go on from the newest file there is
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), now + i + 1, -1)


def stored_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and bytes of the files in a folder, hidden ones left out; none if there is no folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(folder) if f.isFile()] if fs.exists(folder) else []
    return [(n, size) for n, size in found if not n.startswith((".", "_"))]


def read_bounded(spark: SparkSession, topics, *, fmt: str = "kafka", path: str | None = None,
                 schema: T.StructType | None = None, bootstrap: str | None = None) -> DataFrame:
    """Everything currently in the topic(s), from the earliest record."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if fmt == "kafka":
        return (spark.read.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap)
                .option("subscribe", ",".join(names))
                .option("startingOffsets", "earliest").load())
    frames = [spark.read.format(fmt).schema(schema or TOPIC_RECORD)
              .load(f"{path.rstrip('/')}/{t}").withColumn("topic", F.lit(t)) for t in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a header row and a declared schema (S6); no inference pass."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet dataset."""
    return spark.read.parquet(path)


def read_json_documents(spark: SparkSession, path: str,
                        schema: T.StructType | str | None = None) -> DataFrame:
    """A landed JSON array document (API response) as a table."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def inline_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Small literal rows as a table."""
    return spark.createDataFrame(rows, schema)
