"""Choices that depend on measured sizes: spreading input, broadcasting, salting, cutting lineage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
#: Text of a task that makes tokens of it, which take some hundred times that room once they have features.
TASK_BYTES = 1 << 20


def task_count(rows: DataFrame) -> int:
    """Tasks that a table of texts is dealt to: one per core at least, and one per ``TASK_BYTES`` of measured values."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-data_bytes(rows) // TASK_BYTES))


def spread(scan: DataFrame) -> DataFrame:
    """Give an input of few splits one partition per ``task_count``; leave an input of as many splits alone."""
    wanted = task_count(scan)
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted)


def by_sentence(sentences: DataFrame, tasks: int | None = None) -> DataFrame:
    """Hash-partition compact sentence rows, so that exploded tokens can be regrouped without a shuffle.

    Takes a table that has not been shuffled yet. It gets ``tasks`` partitions, by default its ``task_count``, and if it has more
    splits than there are cores the configured number of shuffle partitions at least. A Python function that is applied later
    loses the partitioning, so what it finds must be there before.
    """
    spark = sentences.sparkSession
    few = sentences.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    wanted = tasks or task_count(sentences)
    return sentences.repartition(wanted if few else max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))), "sid")


def _bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(field.name)
    elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
        size = F.octet_length(F.array_join(field.name, " "))
    elif isinstance(field.dataType, T.ArrayType):
        size = 8 * F.size(field.name)
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(0)) + 8


def data_bytes(df: DataFrame) -> int:
    """Size of a table's values: one aggregate, nothing is moved."""
    sizes = [_bytes(f) for f in df.schema.fields]
    total = sizes[0]
    for other in sizes[1:]:
        total = total + other
    return df.agg(F.sum(total.cast("long")).alias("n")).first()["n"] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return data_bytes(df) <= limit


def lookup_join(
    rows: DataFrame, table: DataFrame, on: str | list[str], row_id: Sequence[str], how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join many rows to a lookup table, whatever the row counts per key.

    The table is written once, then measured. Within ``limit`` it is broadcast and the rows do not move. Beyond it,
    both sides are shuffled; keys that hold more than a task's share of the rows are counted first, their rows are
    salted by a hash of their identity and only their table rows are repeated.
    """
    keys = [on] if isinstance(on, str) else list(on)
    table = settle(table)
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), keys, how)
    heavy = heavy_keys(rows, keys)
    salts = F.coalesce("_salts", F.lit(1))
    salted = rows.join(heavy, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*row_id), salts).cast("int")).drop("_salts")
    repeated = table.join(heavy, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def heavy_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more rows than a shuffle partition's even share, with the number ``_salts`` of parts to split them into.

    There are fewer of them than partitions, so the result is broadcast.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = settle(rows.groupBy(*keys).agg(F.count("*").alias("_n")))
    share = max(1, (counts.agg(F.sum("_n")).first()[0] or 0) // parts)
    return F.broadcast(counts.filter(F.col("_n") > share).select(*keys, F.ceil(F.col("_n") / share).cast("int").alias("_salts")))


_roots: dict[tuple[str, str], str] = {}


def _scratch_root(spark: SparkSession, shared: str) -> str:
    """A folder for one application, which the JVM removes when it ends."""
    context = spark.sparkContext
    key = (context.applicationId, shared)
    if key not in _roots:
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{shared.rstrip('/')}/tagloom-{key[0]}-{uuid.uuid4().hex}")
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _roots[key] = folder.toString()
    return _roots[key]


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``, gone when the application ends.

    The setting is required. Only a local session, where driver and tasks are one process, may leave it out; it then gets the
    JVM's own temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = spark.sparkContext._jvm.System.getProperty("java.io.tmpdir")
    return f"{_scratch_root(spark, shared)}/{uuid.uuid4().hex}"


def settle(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a table to shared storage and read it back: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(table: DataFrame, column: str) -> tuple[DataFrame, int]:
    """``column, id`` with ids 0..n-1 in the order of ``column``, and n.

    The rows are written first, so that every later read numbers the same rows the same way; only the
    row count per partition comes to the driver.
    """
    kept = settle(table.select(column).orderBy(column))
    placed = kept.select(column, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = placed.groupBy("_file").agg(F.count("*").alias("n")).orderBy("_file").collect()
    starts, total = [], 0
    for r in counts:
        starts.append((r["_file"], total))
        total += r["n"]
    # one row per file, which are named in the order of their partitions
    offsets = F.broadcast(table.sparkSession.createDataFrame(starts, "_file string, _first long"))
    return settle(placed.join(offsets, "_file").select(column, (F.col("_first") + F.col("_row")).alias("id"))), total
