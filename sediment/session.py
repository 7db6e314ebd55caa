"""One place that starts a Spark session and names the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Timestamps are parsed and truncated in the session zone, so it is fixed. The next three
# are Spark's defaults, stated because the plans rely on them (runtime broadcast, split of
# hot join keys, split of hot partitions before a write).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(
    app_name: str = "sediment",
    master: str | None = None,
    options: Mapping[str, str] | None = None,
) -> SparkSession:
    """Start (or fetch) a session.

    `options` carries everything that belongs to one deployment: object-store access,
    a table-format catalog, shuffle sizing. What they or spark-submit set stays; `DEFAULTS`
    fill in the rest. `master` stays unset on a cluster, where spark-submit decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in (options or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Give a session the settings above where it has none of its own."""
    for name, value in DEFAULTS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


@contextmanager
def configured(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold inside the block only; what is planned and run in it sees them."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="sediment-")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for staged data, under the folder named by spark.checkpoint.dir.

    Executors on other machines must be able to read it, so a machine-local temporary
    folder is used only when the whole session runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
