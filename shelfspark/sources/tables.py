"""Archive and corpus readers and the JSON writers (SRC2, SRC3, SRC5, SNK1-SNK3)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfspark.operators.archive import bucket_of, last_writes, not_stored, storable, with_keys
from shelfspark.operators.export import record_json
from shelfspark.operators.groups import extreme_rows

ARCHIVE_PARTITIONS = ("site", "crawl_date")
#: Buckets of each site and day, by fingerprint; all writers and readers of one archive use the same number.
SPREAD = 16
#: Files are sorted by fingerprint. Short pages let the page index skip bodies, and bloom filters whole row groups.
ARCHIVE_OPTIONS = {
    "parquet.bloom.filter.enabled#fingerprint": "true", "parquet.bloom.filter.adaptive.enabled": "true", "parquet.page.row.count.limit": "200"}


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_archive(
        spark: SparkSession, path: str, sites: list[str], dates: list[str], fingerprints: DataFrame | None = None, spread: int = SPREAD) -> DataFrame:
    """Stored responses of some sites and days (SRC2); both prune partitions.

    ``fingerprints`` narrows the scan to the wanted requests: a few of them choose buckets, row groups and pages.
    """
    rows = spark.read.parquet(path).where(F.col("site").isin(sites) & F.col("crawl_date").isin([F.lit(d).cast("date") for d in dates]))
    return (rows if fingerprints is None else with_keys(rows, fingerprints, spread)).drop("bucket")


def append_archive(responses: DataFrame, path: str, archive: DataFrame | None = None, spread: int = SPREAD) -> None:
    """Append fresh 200 responses the archive lacks (SRC3), partitioned by site, day and bucket, sorted by fingerprint.

    One answer per fingerprint is stored, the last one by ``put_ts`` where the rows have it. A site with much of the crawl is
    written by as many tasks as it has buckets.
    """
    rows = storable(responses)
    if archive is not None:
        rows = not_stored(rows, archive)
    columns = rows.columns
    if "put_ts" in columns:
        rows = last_writes(rows)
    else:
        rows = extreme_rows(rows.withColumn("_any", F.lit(0)), ["fingerprint"], "_any")
    folders = [*ARCHIVE_PARTITIONS, "bucket"]
    rows = rows.select(*columns).withColumn("bucket", bucket_of(F.col("fingerprint"), spread))
    rows = rows.repartition(*folders).sortWithinPartitions(*folders, "fingerprint")
    rows.write.options(**ARCHIVE_OPTIONS).partitionBy(*folders).mode("append").parquet(path)


def commit_run(spark: SparkSession, path: str, run: str, write: Callable[[str], None]) -> bool:
    """Have ``write`` fill a folder of its own below ``path``, then name that folder in the run's manifest; whether it came to that.

    A run with a manifest is not written again. One that broke off has none; its files are never read, and the next attempt
    writes others. The manifest is created only if it is absent, so of two attempts at a time one counts.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    manifest = jvm.Path(f"{path}/commits/{run}")
    files = manifest.getFileSystem(spark._jsc.hadoopConfiguration())

    def named() -> bool:
        # An empty manifest is one whose writer broke off in between.
        return files.exists(manifest) and files.getFileStatus(manifest).getLen() > 0

    if named():
        return False
    attempt = f"run={run}/attempt={uuid.uuid4().hex}"
    write(f"{path}/runs/{attempt}")
    if named():
        return False
    out = files.create(manifest, files.exists(manifest))
    out.writeBytes(f"{attempt}\n")
    out.close()
    return True


def committed(spark: SparkSession, path: str) -> list[str]:
    """Folders that manifests name, one per run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return sorted(f"{path}/runs/{r.value}" for r in spark.read.text(f"{path}/commits").distinct().collect())


def write_export(
        records: DataFrame, path: str, day: Column, run: str | None = None, marketplace: DataFrame | None = None, compression: str = "none") -> bool:
    """JSON Lines under year, month and day (SNK1): item fields without nulls, and every key of the record.

    ``run`` names the run (of letters, digits, ``-`` and ``_``); repeated under the same name, it writes nothing, and broken off, it
    leaves nothing that ``read_export`` reads. ``marketplace`` are further parts of long lists, committed with the records. Empty
    partitions write no file; Spark names the files. Records repeat their keys and sellers, so ``compression`` (``gzip``) makes files
    of a fraction of the size, which every JSON Lines reader opens by their ending.
    """
    dated = records.select(record_json(records).alias("value"), *[F.date_format(day, f).alias(n) for n, f in (("y", "yyyy"), ("m", "MM"), ("d", "dd"))])

    def write(folder: str) -> None:
        dated.write.partitionBy("y", "m", "d").option("compression", compression).text(f"{folder}/table=records")
        if marketplace is not None:
            marketplace.write.option("compression", compression).json(f"{folder}/table=marketplace")

    return commit_run(records.sparkSession, path, run or uuid.uuid4().hex, write)


def read_export(spark: SparkSession, path: str, schema: str, part: str = "records") -> DataFrame:
    """Exported rows of all committed runs; records have the columns ``y``, ``m`` and ``d`` as well if ``schema`` names them."""
    files = spark._jvm.org.apache.hadoop.fs
    folders = [f"{folder}/table={part}" for folder in committed(spark, path)]
    folders = [f for f in folders if files.Path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(files.Path(f))]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/runs").json(folders)
    return rows.select(StructType.fromDDL(schema).names)


def write_messages(messages: DataFrame, path: str) -> None:
    """Result messages as text lines per queue (SNK2); ``value`` is already JSON."""
    messages.select("queue", "value").write.partitionBy("queue").mode("append").text(path)


def write_job_logs(log: DataFrame, path: str) -> None:
    """One JSON record per job (SNK3)."""
    log.write.mode("append").option("ignoreNullFields", "true").json(path)
