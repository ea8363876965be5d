"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning: small partitions are merged, skewed ones split, and a join turns
# into a broadcast only when the measured side is below Spark's own size threshold.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A side that is dealt out by one of the join's keys need not be shuffled again for all of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(shuffled_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for a given shuffle volume: partitions of 256 MB, at least two per core.

    The narrow per-key shuffles of the reports are a few per cent of the input, so
    100 TB of ledgers needs some 20,000 partitions; adaptive execution merges the rest.
    """
    partitions = max(2 * total_cores, -(-shuffled_bytes // PARTITION_BYTES))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def local_session(cores: int = 8, app: str = "ledgerproof") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def setting_in_bytes(value: str) -> int:
    """A size setting such as ``128MB`` or ``134217728`` as a number of bytes."""
    digits, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", value.strip().lower()).groups()
    return int(digits) * 1024 ** " kmgtp".index(unit or " ")


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="ledgerproof-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return os.path.join(base, "ledgerproof", f"{purpose}-{uuid.uuid4().hex[:12]}")
