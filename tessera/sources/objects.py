"""Objects in storage: raw files, listings, retention, sinks and their verification."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from . import registry

#: Days that objects are kept, by prefix; canonical chunks have no end.
RETENTION_DAYS = {"ingestion/": 14, "processed/": 3}


def key_below(root: str) -> Column:
    """An object's key: its path behind the root folder."""
    tail = root.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(F.col("path"), f"/{tail}/", -1)


def raw_files(spark: SparkSession, root: str, *submissions: str) -> DataFrame:
    """(key, submissionId, fileId, content, modificationTime) of all files below root/ingestion, or of some submissions'.

    Only the submissions' own folders are listed, unless a name would be read as a pattern or a folder isn't there.
    """
    plain = bool(submissions) and all(re.fullmatch(r"[\w.@=+ -]+", s) for s in submissions)
    folders = [f"{root}/ingestion/{s}" for s in submissions]
    plain = plain and (len(folders) == 1 or all(exists(spark, f) for f in folders))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders if plain else f"{root}/ingestion")
    placed = files.withColumn("key", key_below(root))
    named = placed.select("key", keys.submission_of(F.col("key")).alias("submissionId"), keys.file_of(F.col("key")).alias("fileId"), "content", "modificationTime")
    return named.where(F.col("submissionId").isin(*submissions)) if submissions else named


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def files_in(spark: SparkSession, path: str) -> int:
    """How many files a folder has; 0 if it isn't there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(1 for f in system.listStatus(where) if f.getPath().getName().endswith(".parquet")) if system.exists(where) else 0


def listed(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """(key, path, modificationTime) of the objects below a prefix; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{prefix}")
    return files.select(key_below(root).alias("key"), "path", "modificationTime")


def listing(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Keys below a prefix; contents are not read."""
    return listed(spark, root, prefix).select("key").distinct()


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes one object, as fixtures and uploads do, to any file system that Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Writes an object with all its content unless it is there; False if it is. Of several that try, one succeeds.

    The object is written beside its place and put there by a step that refuses to replace: a hard link in a local
    file system, else a rename without overwriting, which HDFS does atomically. A store in which a rename copies
    (plain object stores) does not give that, and wants one writer.
    """
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    put(spark, beside, content.encode())
    jvm = spark.sparkContext._jvm
    where, held = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(beside)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        if where.getFileSystem(conf).getUri().getScheme() == "file":
            os.link(held.toUri().getPath(), where.toUri().getPath())
        else:
            rename_new(spark, beside, path)
    except FileExistsError:
        return False
    finally:
        remove(spark, beside)
    return True


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Renames an object; FileExistsError if there is one at its new place."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(hadoop.Path(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    plain[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(hadoop.Path(source), hadoop.Path(target), plain)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            raise FileExistsError(target) from error
        raise


def texts(spark: SparkSession, path: str, suffix: str, known: dict[str, str]) -> dict[str, str]:
    """Contents of the small objects of a folder by name, of names with the suffix; those that are known are not read again."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = dict(known)
    for f in system.listStatus(where) if system.exists(where) else ():
        name = f.getPath().getName()
        if name.endswith(suffix) and name not in found:
            stream = system.open(f.getPath())
            try:
                found[name] = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
    return found


def text_of(content: Column) -> Column:
    """Strict UTF-8."""
    return F.decode(content, "UTF-8")


def expired(key: Column, modified: Column, now: Column) -> Column:
    """Whether the retention of an object's prefix is over."""
    found = F.lit(False)
    for prefix, days in RETENTION_DAYS.items():
        found = found | (key.startswith(prefix) & (modified < now - F.make_dt_interval(F.lit(days))))
    return found


def live(objects: DataFrame, key: str, modified: str, now: Column) -> DataFrame:
    """Objects that their prefix's retention still keeps."""
    return objects.where(~expired(F.col(key), F.col(modified), now))


def delete_all(paths: DataFrame) -> DataFrame:
    """Deletes objects (column path) in the executors; adds whether this attempt removed them. Again, it does no harm."""
    return paths.select("path").mapInPandas(delete_files, "path string, removed boolean")


def delete_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    systems: dict[str, tuple[fs.FileSystem, str]] = {}
    for batch in batches:
        removed = []
        for path in batch["path"]:
            scheme, store, name = re.fullmatch(r"(?:(\w+):)?(?://([^/]*))?(/.*)", path, re.S).groups()
            if (home := f"{'s3' if scheme == 's3a' else scheme}://{store or ''}/") not in systems:
                systems[home] = (fs.LocalFileSystem(), "") if scheme in (None, "file") else fs.FileSystem.from_uri(home)
            system, base = systems[home]
            try:
                system.delete_file(base.rstrip("/") + name)
                removed.append(True)
            except FileNotFoundError:
                removed.append(False)
        yield batch.assign(removed=removed)


def write_processed(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("submissionId").parquet(path)


#: Folders of the chunk store.
CHUNK_BUCKETS = 256


def write_chunks(rows: DataFrame, path: str) -> None:
    """Chunks of a document lie together, in one of CHUNK_BUCKETS folders, however many documents there are."""
    registry.write_bucketed(rows, "documentId", CHUNK_BUCKETS, path, "append")


def missing_keys(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(actual.select(key).distinct(), key, "left_anti")


def verified(expected: DataFrame, list_actual, repair, key: str, shown: int = 10) -> None:
    """Checks that a sink has every key, repairs once, and raises with the first missing keys if that didn't help."""
    gone = missing_keys(expected, list_actual(), key)
    if gone.isEmpty():
        return
    repair(expected.join(gone, key, "left_semi"))
    gone = missing_keys(expected, list_actual(), key)
    if first := [r[key] for r in gone.orderBy(key).limit(shown).collect()]:
        raise RuntimeError(f"{gone.count()} chunk objects are missing, the first of them: {', '.join(first)}")
