"""Datasets that are replaced at once: versions in folders of their own, and a pointer file renamed over the old one."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that the pointer names; null if there is none."""
    fs, p = _place(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    found = fs.open(p)
    try:
        return f"{path}/{spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(found, 'UTF-8').strip()}"
    finally:
        found.close()


def publish(rows: DataFrame, path: str, kind: str = "parquet", grace: float = 3600) -> str:
    """Writes rows as a new version and points to it; a reader meets the old version or the new one, never neither.

    Versions that are neither the new one nor the one before go once they are `grace` seconds old, so readers that have
    begun can end. Of two writers at once the later pointer holds.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    name = f"v-{uuid.uuid4().hex}"
    rows.write.format(kind).save(f"{path}/{name}")
    before = current(spark, path)
    fs, made = _place(spark, f"{path}/_next-{uuid.uuid4().hex}")
    out = fs.create(made)
    out.write(bytearray(name.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri() if made.toUri().getScheme() else fs.getUri(), conf)
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(option, 1)
    how[0] = option.OVERWRITE
    context.rename(fs.makeQualified(made), fs.makeQualified(_place(spark, f"{path}/{POINTER}")[1]), how)
    held = {name, before.rsplit("/", 1)[-1] if before else name}
    for x in fs.listStatus(_place(spark, path)[1]):
        own = x.getPath().getName()
        if own.startswith("v-") and own not in held and time.time() - x.getModificationTime() / 1000 > grace:
            fs.delete(x.getPath(), True)
    return f"{path}/{name}"
