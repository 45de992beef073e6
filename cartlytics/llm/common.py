"""Helpers shared by the operators: tables, shared scratch space, hashing.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``.  Only a local master may fall back to a temporary
folder; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FULL = 0.5  # share of its heap from which the driver's JVM is collected


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    shared = tempfile.mkdtemp(prefix="llm-scratch-")
    spark.sparkContext.setCheckpointDir(shared)
    return shared


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage.
    ``options`` are the Parquet writer's.  The shuffle files of the write go as
    soon as it ends, whenever the driver collects its garbage.  The driver's JVM
    keeps the plans of finished jobs and takes more heap before it looks for
    them: once it has ``FULL`` of it, they go with the write."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    if heap_share(spark) > FULL:
        free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def heap_share(spark: SparkSession) -> float:
    """How much of the heap it may have the driver's JVM has taken."""
    runtime = spark.sparkContext._jvm.Runtime.getRuntime()
    return runtime.totalMemory() / runtime.maxMemory()


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go when the driver collects its garbage,
    which a small driver program may not do for long."""
    gc.collect()  # Python's handles first: they hold the driver's plans
    spark.sparkContext._jvm.System.gc()


def forget(df: DataFrame) -> None:
    """Delete a table of ``save`` that nothing reads any more."""
    files, jvm = df.inputFiles(), df.sparkSession._jvm
    if files:
        path = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of a few megabytes (a session
    setting): the default of 10,000 rows a batch does not bound memory."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        spark.conf.set(key, str(most))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % modulus


def text_bytes(column: str = "text") -> Column:
    """A text column as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def words(data: bytes) -> list[bytes]:
    """A-Z lower-cased; words are runs of bytes other than 0x20, 0x09-0x0D."""
    return data.lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a word sequence;
    a shorter non-empty sequence is one shingle."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(size, n)
    with np.errstate(over="ignore"):
        acc = np.full(n - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n - width + 1 + k])
    return np.unique(acc)
