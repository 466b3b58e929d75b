"""Session settings and the one place that decides where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Everything here holds at 100 TB as well as locally; partition counts are left to AQE, which
# coalesces from the initial number down to advisory-sized partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE puts partitions together but never parts one: from a small spark.sql.shuffle.partitions,
    # tasks would grow with the input until they spill.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "960",
    # Stored layers compress to a few bytes a row: 128 MB of facets are fifty million rows, which one
    # task would sort. The second value widens the splits again where there are very many.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.maxPartitionNum": "400000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Aggregates over strings keep hashing instead of sorting after 128 keys.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # HotSpot never compiles a method above 8000 bytes of bytecode; wide rows run faster when such
    # a stage is split into smaller methods than fused into one that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build(app: str = "estatelens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Set the runtime-changeable settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: ``spark.checkpoint.dir``, which every executor sees.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="estatelens-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut lineage by writing a Parquet table to the shared folder and reading it back.

    Computed once, columnar, pruned on read, and it outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
