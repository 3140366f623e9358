"""The log of warehouse versions.

A version is one folder ``_manifests/version=<N>``. Its rows name the parquet
folders that make up every table, so a new version may add a folder to a
table, replace one part of it, or name folders of earlier versions again;
folders are never written twice. A version comes into being by one rename of
a finished manifest to its place, which fails where another writer was first.
"""

from __future__ import annotations

import datetime as _dt
import errno
import os
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "table_name string, part string, folder string, row_count long, published_at string, version int"
PART = "__part"
#: A table with more folders than this has its small ones merged.
MAX_FOLDERS = 16


class VersionConflict(RuntimeError):
    """Another writer committed the version first; the work has to start again from that version."""


@dataclass(frozen=True)
class Entry:
    """One folder of a table. ``part`` is the part of the table that it holds, None where a table has no parts."""

    table_name: str
    part: str | None
    folder: str
    row_count: int
    published_at: str


def read_if_written(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The parquet table at ``path``, None where nothing was written yet; any other failure is raised."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        # no such folder, or one in which no write was ever finished
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def manifests(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of all versions, None where no version was committed."""
    return read_if_written(spark, os.path.join(root, "_manifests"), MANIFEST)


def current_version(spark: SparkSession, root: str) -> int:
    """Latest committed version (0 if none). Reads only the small manifest table."""
    m = manifests(spark, root)
    return 0 if m is None else int(m.agg(F.max("version").alias("v")).first().v or 0)


def entries(spark: SparkSession, root: str, version: int) -> list[Entry]:
    """The folders of a version: at most ``MAX_FOLDERS`` and one load more for each table or part."""
    if version == 0:
        return []
    rows = manifests(spark, root).where(F.col("version") == version).collect()
    return [Entry(r.table_name, r.part, r.folder, r.row_count, r.published_at) for r in rows]


def read(spark: SparkSession, root: str, found: Sequence[Entry]) -> DataFrame:
    """The rows of the given folders, which are of one table."""
    return spark.read.parquet(*[os.path.join(root, e.folder) for e in found])


def new_load(version: int) -> str:
    """A folder name that no other load uses."""
    return f"{version}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, root: str, name: str, load: str, part_col: str | None = None) -> list[Entry]:
    """Write the rows to folders of this load alone: one, or one per value of ``part_col`` (a whole number).

    Row counts come from the file footers. A frame without rows becomes one folder that keeps the schema.
    """
    spark, now = df.sparkSession, _dt.datetime.now(_dt.timezone.utc).isoformat()
    folder = os.path.join("tables", name, load)
    path = os.path.join(root, folder)
    if part_col is None or df.isEmpty():
        df.write.mode("errorifexists").parquet(path)
        return [Entry(name, None, folder, spark.read.parquet(path).count(), now)]
    df.withColumn(PART, F.col(part_col).cast("long")).repartition(PART) \
        .write.mode("errorifexists").partitionBy(PART).parquet(path)
    counted = spark.read.parquet(path).groupBy(F.col(PART).cast("string").alias("part")).count().collect()
    return [Entry(name, r.part, os.path.join(folder, f"{PART}={r.part}"), r["count"], now) for r in counted]


def put_if_absent(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename the folder ``src`` to ``dst`` in one step; False where ``dst`` is there already.

    On a local file system rename(2) refuses a target that holds files. Elsewhere it is the file system's
    rename without overwriting, atomic on HDFS and on stores with an atomic rename; on a store that renames
    by copying, two writers at the same instant aren't told apart.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    a, b = hadoop.Path(src), hadoop.Path(dst)
    fs = b.getFileSystem(conf)
    fs.mkdirs(b.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            os.rename(a.toUri().getPath(), b.toUri().getPath())
            return True
        except OSError as e:
            if e.errno in (errno.ENOTEMPTY, errno.EEXIST):
                return False
            raise
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(a), fs.makeQualified(b), keep)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def commit(spark: SparkSession, root: str, version: int, found: Iterable[Entry]) -> int:
    """Make the folders visible as ``version``; raises ``VersionConflict`` where that version exists."""
    rows = [(e.table_name, e.part, e.folder, e.row_count, e.published_at) for e in found]
    staged = os.path.join(root, "_staged", new_load(version))
    schema = MANIFEST.removesuffix(", version int")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(staged)
    if not put_if_absent(spark, staged, os.path.join(root, "_manifests", f"version={version}")):
        raise VersionConflict(f"version {version} under {root} was committed by another writer")
    return version


def by_table(found: Iterable[Entry]) -> dict[str, list[Entry]]:
    out: dict[str, list[Entry]] = {}
    for e in found:
        out.setdefault(e.table_name, []).append(e)
    return out


def small_folders(found: Sequence[Entry], max_folders: int = MAX_FOLDERS) -> list[Entry]:
    """The folders to merge: none up to ``max_folders``, else the smallest ones, and larger ones as long as
    each is at most twice what is merged already. A row is so rewritten about log(rows) times in all."""
    if len(found) <= max_folders:
        return []
    order = sorted(found, key=lambda e: (e.row_count, e.folder))
    n, rows = 0, 0
    for e in order:
        if n > len(order) - max_folders and e.row_count > 2 * rows:
            break
        n, rows = n + 1, rows + e.row_count
    return order[:n]


def compact(spark: SparkSession, root: str, max_folders: int = MAX_FOLDERS) -> int:
    """Merge the small folders of every table with too many; the rows stay the same. Returns the version."""
    version = current_version(spark, root)
    groups: dict[tuple[str, str], list[Entry]] = {}
    for e in entries(spark, root, version):
        groups.setdefault((e.table_name, e.part or ""), []).append(e)
    load, kept, changed = new_load(version + 1), [], False
    for (name, part), found in sorted(groups.items()):
        merge = small_folders(found, max_folders)
        kept += [e for e in found if e not in merge]
        if merge:
            changed = True
            sub = load if not part else os.path.join(load, f"{PART}={part}")
            done = stage(read(spark, root, merge), root, name, sub)[0]
            if done.row_count != sum(e.row_count for e in merge):
                raise RuntimeError(f"{name}: {done.row_count} rows after the merge of {sum(e.row_count for e in merge)}")
            kept.append(Entry(name, part or None, done.folder, done.row_count, done.published_at))
    return commit(spark, root, version + 1, kept) if changed else version
