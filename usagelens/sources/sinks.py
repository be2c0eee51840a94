"""Table writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.temporal import at
from usagelens.session import scratch_path

_PUBLISHED = "_PUBLISHED"


def with_audit(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumn("updated_at", at(as_of))


def write_table(df: DataFrame, location: str, partition_by: Sequence[str] = ()) -> None:
    """Full replace of a mart table. Plain overwrite: readers must not be running."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in location:
        writer.parquet(location)
    else:
        writer.saveAsTable(location)


def append(df: DataFrame, location: str) -> None:
    writer = df.write.mode("append")
    if "/" in location:
        writer.parquet(location)
    else:
        writer.saveAsTable(location)


def append_audit(rows: DataFrame, location: str, key: str | None = None) -> None:
    """All audit rows of a change in one batch write.

    With ``key``, rows whose key the log holds already are not written again, so a run that is
    repeated adds nothing.
    """
    spark = rows.sparkSession
    if key is not None and "/" in location:
        known = table_or_none(spark, location, rows.schema)
        if known is not None:
            rows = rows.join(known.select(key), key, "left_anti").select(*rows.columns)
    append(rows, location)


def overwrite_partitions(batch: DataFrame, location: str, part_col: str | Sequence[str]) -> None:
    """Replace exactly the partitions present in ``batch``.

    The rebalance hint lets adaptive execution split a partition value that holds a
    large share of the rows over several files and tasks.
    """
    columns = [part_col] if isinstance(part_col, str) else list(part_col)
    (
        batch.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(location)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def table_or_none(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame | None:
    """The table read with its declared schema, or None before its first row.

    A folder that an empty load or a write that died has left without data files is a table
    without rows: the next load is a first run.
    """
    if not path_exists(spark, location):
        return None
    table = spark.read.schema(schema).parquet(location)
    return None if table.isEmpty() else table


# Buckets of the key index; a search reads those its keys fall into.
KEY_BUCKETS = 32


def _located(df: DataFrame, key: Sequence[str], part_col: str | None = None) -> DataFrame:
    """Distinct (bucket, key_hash), and the partition, of the rows whose key has no NULL."""
    digest = F.xxhash64(*key)
    bucket = F.pmod(digest, F.lit(KEY_BUCKETS)).cast("int").alias("bucket")
    rest = [] if part_col is None else [part_col]
    return df.dropna(subset=list(key)).select(bucket, digest.alias("key_hash"), *rest).distinct()


def _key_index(spark: SparkSession, location: str, target: DataFrame, key: Sequence[str], part_col: str) -> DataFrame:
    """Where keys have been stored: (bucket, key_hash, partition), a table beside the target.

    Built from the target where there is none yet. Entries are only ever added, so it may name
    partitions a key has left, which costs a look into them, but it misses none.
    """
    path = f"{location.rstrip('/')}_keys"
    if not path_exists(spark, path):
        _note_keys(location, target, key, part_col)
    kind = T.StructType.fromDDL("key_hash long, bucket int")
    schema = T.StructType([kind["key_hash"], target.schema[part_col], kind["bucket"]])
    return spark.read.schema(schema).parquet(path)


def _note_keys(location: str, rows: DataFrame, key: Sequence[str], part_col: str) -> None:
    entries = _located(rows, key, part_col).hint("rebalance", "bucket")
    entries.write.mode("append").partitionBy("bucket").parquet(f"{location.rstrip('/')}_keys")


def partitions_holding(
    spark: SparkSession,
    location: str,
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    part_col: str,
    since=None,
) -> DataFrame:
    """Partitions of ``target`` that may hold a key of ``batch``, from the key index alone.

    Only the buckets of the batch's keys are read, and no partition of the target is.
    """
    wanted = _located(batch, key)
    # At most KEY_BUCKETS values.
    buckets = [row[0] for row in wanted.select("bucket").distinct().collect()]
    index = _key_index(spark, location, target, key, part_col).where(F.col("bucket").isin(buckets))
    if since is not None:
        index = index.where(F.col(part_col) >= F.lit(since))
    return index.join(wanted.drop("bucket"), "key_hash", "left_semi").select(part_col).distinct()


def replace_keys(
    spark: SparkSession,
    location: str,
    batch: DataFrame,
    key: Sequence[str],
    part_col: str,
    since=None,
) -> list:
    """Delete the batch's keys from a partitioned table and insert the batch.

    Only partitions that hold one of the keys, now or after, are read and rewritten; an index
    of key hashes names them, looked up from ``since`` on when the caller knows that no earlier
    partition can hold a key of the batch. The new content is staged before anything is
    replaced, and keys are noted before their rows are written, so a write that dies half-way
    can be run again. Returns the partition values rewritten.
    """
    target = table_or_none(spark, location, batch.schema)
    if target is None:
        _note_keys(location, batch, key, part_col)
        overwrite_partitions(batch, location, part_col)
        return []
    keys = batch.select(*key).distinct()
    holding = partitions_holding(spark, location, target, batch, key, part_col, since)
    touched = [
        row[0] for row in holding.unionByName(batch.select(part_col)).distinct().collect()
    ]
    in_touched = F.col(part_col).isin([value for value in touched if value is not None])
    if None in touched:
        in_touched = in_touched | F.col(part_col).isNull()
    affected = target.where(in_touched)
    kept = affected.join(keys, list(key), "left_anti").select(*batch.columns)
    staged = scratch_path(spark, "replace-keys")
    overwrite_partitions(kept.unionByName(batch), staged, part_col)
    fresh = spark.read.schema(batch.schema).parquet(staged)
    _note_keys(location, batch, key, part_col)
    overwrite_partitions(fresh, location, part_col)
    left = {row[0] for row in fresh.select(part_col).distinct().collect()}
    for value in touched:
        if value not in left:
            _drop_partition(spark, location, part_col, value)
    return touched


def _drop_partition(spark: SparkSession, location: str, part_col: str, value) -> None:
    """Remove a partition whose rows have all moved elsewhere: a write cannot empty it."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    name = utils.getPartitionPathString(part_col, None if value is None else str(value))
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/{name}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class VersionedTable:
    """Parquet table replaced as a whole, readers never see a half-written version.

    Every version is its own directory. A version becomes current when an empty marker
    file appears in it, which is atomic on file systems and object stores alike.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        hadoop_path = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self._spark._jsc.hadoopConfiguration()
        return hadoop_path.getFileSystem(conf), hadoop_path

    def _versions(self) -> list[int]:
        fs, root = self._fs(self.root)
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        return sorted(int(name[2:]) for name in names if name.startswith("v="))

    def _path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def _is_published(self, version: int) -> bool:
        fs, marker = self._fs(f"{self._path(version)}/{_PUBLISHED}")
        return fs.exists(marker)

    def current_version(self) -> int | None:
        for version in reversed(self._versions()):
            if self._is_published(version):
                return version
        return None

    def read(self) -> DataFrame | None:
        version = self.current_version()
        return None if version is None else self._spark.read.parquet(self._path(version))

    def swap(
        self, df: DataFrame, validate: Callable[[DataFrame], bool] | None = None
    ) -> DataFrame:
        """Write a new version, check it, then make it current.

        A version that fails ``validate`` stays unpublished and the old one current.
        """
        version = max(self._versions(), default=0) + 1
        path = self._path(version)
        df.write.mode("overwrite").parquet(path)
        written = self._spark.read.parquet(path)
        if validate is not None and not validate(written):
            raise ValueError(f"{path}: validation failed, version not published")
        fs, marker = self._fs(f"{path}/{_PUBLISHED}")
        fs.create(marker, True).close()
        return written

    def roll_back(self) -> None:
        """Withdraw the current version; the one before becomes current again."""
        version = self.current_version()
        if version is not None:
            fs, marker = self._fs(f"{self._path(version)}/{_PUBLISHED}")
            fs.delete(marker, False)

    def vacuum(self, keep: int = 3) -> None:
        """Delete all but the newest ``keep`` published versions, and what failed before them.

        Keep enough for readers that started on an earlier version to finish.
        """
        published = [v for v in self._versions() if self._is_published(v)]
        if len(published) > keep:
            for version in self._versions():
                if version < published[-keep]:
                    fs, path = self._fs(self._path(version))
                    fs.delete(path, True)
