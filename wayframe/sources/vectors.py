"""The vector table: Parquet folders of frame vectors under snapshots.

A store has its rows in folders below ``data`` and a list of the folders that make it up
below ``snapshots``, one file per version. Rows are written to a new folder first; then the
next version's list is put in place by a rename that fails if that version exists, and the
writer that lost the race reads the newer list and tries again. Readers take the newest list,
so that they see an append or a compaction as a whole or not at all, and go on reading their
own folders while the store moves on. A failed write leaves a folder that no list names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayframe.schemas import FRAME_VECTORS


def _filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a store, oldest first."""
    filesystem, where = _filesystem(spark, f"{path}/snapshots")
    if not filesystem.exists(where):
        return []
    names = (entry.getPath().getName() for entry in filesystem.listStatus(where))
    return sorted(int(n) for n in names if n.isdigit())


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[str]]:
    """A version of the store, the newest unless told otherwise, and its folders; (0, []) without a store."""
    if version is None:
        version = max(versions(spark, path), default=0)
        if not version:
            return 0, []
    filesystem, where = _filesystem(spark, f"{path}/snapshots/{version}")
    stream = filesystem.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, text.split()


def _commit(spark: SparkSession, path: str, version: int, folders: list[str]) -> bool:
    """Make ``folders`` the given version; False when that version has been made by another."""
    filesystem, draft = _filesystem(spark, f"{path}/drafts/{uuid.uuid4().hex}")
    stream = filesystem.create(draft, False)
    try:
        stream.write(bytearray("\n".join(folders), "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    place = jvm.Path(f"{path}/snapshots/{version}")
    filesystem.mkdirs(place.getParent())
    # Without an option to overwrite, a rename onto a version that is there is refused.
    none = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    context = jvm.FileContext.getFileContext(filesystem.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, place, none)
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        filesystem.delete(draft, False)
        return False
    return True


def _change(spark: SparkSession, path: str, changed) -> None:
    """Commit ``changed(folders)`` as the next version, over whatever is the newest by then."""
    while True:
        version, folders = snapshot(spark, path)
        if _commit(spark, path, version + 1, changed(folders)):
            return


def store_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def open_store(spark: SparkSession, path: str, *, create: bool = False, version: int | None = None) -> DataFrame:
    """The store as a frame, of its newest version unless told otherwise.

    A missing one is an error unless ``create`` is set.
    """
    _, folders = snapshot(spark, path, version)
    if not folders:
        if not create:
            raise FileNotFoundError(f"no vector store at {path}")
        append(spark.createDataFrame([], FRAME_VECTORS), path)
        return open_store(spark, path)
    return spark.read.option("mergeSchema", len(folders) > 1).parquet(*[f"{path}/data/{f}" for f in folders])


def _written(rows: DataFrame, path: str) -> str:
    """Write rows to a new folder; sorting inside files keeps token lookups to few row groups."""
    folder = uuid.uuid4().hex
    order = [c for c in ("scene_name", "sample_data_token") if c in rows.columns]
    rows.sortWithinPartitions(*order).write.mode("errorifexists").parquet(f"{path}/data/{folder}")
    return folder


def append(rows: DataFrame, path: str) -> None:
    """Add rows: all of them are in the next version, or none."""
    folder = _written(rows, path)
    _change(rows.sparkSession, path, lambda folders: [*folders, folder])


def drop_store(spark: SparkSession, path: str) -> None:
    filesystem, where = _filesystem(spark, path)
    if filesystem.exists(where):
        filesystem.delete(where, True)


def compact(spark: SparkSession, path: str, files: int) -> None:
    """Replace a store's files by about ``files`` files, ranged by token, in one step.

    Rows that others append meanwhile stay beside them. Readers of older versions go on
    reading the old folders until :func:`vacuum` removes them.
    """
    _, old = snapshot(spark, path)
    rows = open_store(spark, path).repartitionByRange(files, "sample_data_token")
    folder = _written(rows, path)

    def changed(folders: list[str]) -> list[str]:
        if not {*old} <= {*folders}:
            raise RuntimeError(f"{path} was compacted by another")
        return [folder, *[f for f in folders if f not in old]]

    _change(spark, path, changed)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove folders and versions that none of the last ``keep`` versions needs; the names of the folders.

    For times without writers: an append that is not committed yet looks like a failed one.
    """
    kept = versions(spark, path)[-keep:]
    needed = {f for v in kept for f in snapshot(spark, path, v)[1]}
    filesystem, data = _filesystem(spark, f"{path}/data")
    gone = [e.getPath() for e in filesystem.listStatus(data) if e.getPath().getName() not in needed]
    for version in set(versions(spark, path)) - {*kept}:
        filesystem.delete(_filesystem(spark, f"{path}/snapshots/{version}")[1], False)
    for folder in gone:
        filesystem.delete(folder, True)
    return sorted(f.getName() for f in gone)


def of_other_dimension(store: DataFrame, dim: int) -> DataFrame:
    """Rows whose vector does not have ``dim`` entries (should be none)."""
    return store.filter(F.size("vector") != dim)
