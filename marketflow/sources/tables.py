"""Parquet tables: rebuild, upsert, append, range replacement and retention.

A change touches only the partitions that hold affected rows. The new content of
these partitions is first written beside the table; publishing replaces the
partitions from there. A job that died in between is completed by the next one,
so a lost driver or executor loses no rows.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from datetime import date, datetime

from py4j.java_gateway import JavaObject
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.operators.merge import same_key, upsert


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _path(spark, path)
    return fs.exists(location)


def _delete(spark: SparkSession, path: str) -> None:
    fs, location = _path(spark, path)
    fs.delete(location, True)


@contextmanager
def persisted(df: DataFrame):
    """Keep ``df`` on the executors while several jobs read it."""
    ours = not df.is_cached
    if ours:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if ours:
            df.unpersist()


#: Folder name of the partition whose value is missing (fixed value of the format).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _pending(path: str) -> str:
    return path.rstrip("/") + "__pending"


def _write(df: DataFrame, path: str, partition: str, spread: bool = False) -> None:
    """Replace the partitions that occur in ``df``; rows are spread evenly over the files, unless they are ``spread`` already."""
    (
        (df if spread else df.hint("rebalance", partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def recover(spark: SparkSession, path: str) -> None:
    """Finish a publication or rebuild that an earlier job left behind; drop one that is incomplete."""
    if exists(spark, _next(path) + "/_SUCCESS"):
        _switch(spark, path)
    _delete(spark, _next(path))
    if exists(spark, _pending(path) + "/_SUCCESS"):
        _move(spark, path)
    _delete(spark, _pending(path))


def _move(spark: SparkSession, path: str) -> None:
    """Put each staged partition in the place of the table's; what was moved before a job died is not there any more."""
    fs, location = _path(spark, _pending(path))
    for status in fs.listStatus(location):
        if status.isDirectory() and "=" in status.getPath().getName():
            _, target = _path(spark, f"{path.rstrip('/')}/{status.getPath().getName()}")
            fs.delete(target, True)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"cannot move {status.getPath()} to {target}")


def _publish(df: DataFrame, path: str, partition: str) -> None:
    spark = df.sparkSession
    df.hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(partition).parquet(_pending(path))
    _move(spark, path)
    _delete(spark, _pending(path))


def _next(path: str) -> str:
    return path.rstrip("/") + "__next"


def _switch(spark: SparkSession, path: str) -> None:
    fs, location = _path(spark, path)
    fs.delete(location, True)
    _, fresh = _path(spark, _next(path))
    if not fs.rename(fresh, location):
        raise OSError(f"cannot move {fresh} to {location}")


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table; while a rebuild is being switched in, its complete new version."""
    if not exists(spark, path) and exists(spark, _next(path) + "/_SUCCESS"):
        path = _next(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def rebuild(df: DataFrame, path: str, time_col: str | None = None, allow_shrink: bool = False) -> None:
    """Replace the whole table by ``df``.

    The new version is complete before the old one goes. With ``time_col`` a rebuild
    is refused when it would lose older history than ``df`` reaches back to.
    """
    spark = df.sparkSession
    recover(spark, path)
    if time_col and not allow_shrink and exists(spark, path):
        old = spark.read.parquet(path).agg(F.min(time_col)).first()[0]
        new = df.agg(F.min(time_col)).first()[0]
        if old is not None and (new is None or new > old):
            raise ValueError(f"rebuild of {path} would drop rows before {new}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_next(path))
    _switch(spark, path)


def newest(spark: SparkSession, path: str, partition: str, time_col: str):
    """The greatest time in the table's last partition, the only one that is read; None if there is none."""
    fs, location = _path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{partition}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
    if not values:
        return read_table(spark, path).agg(F.max(time_col)).first()[0]
    last = max(values, key=lambda v: (not v.startswith("-"), len(v), v))
    return read_table(spark, path).filter(F.col(partition).cast("string") == last).agg(F.max(time_col)).first()[0]


def affected(updates: DataFrame, path: str, partition: str) -> DataFrame:
    """The stored rows in partitions that have updates; no other partition is read.

    The partition values of the updates, one per day or range, go into the plan
    as literals. A join with them would leave the pruning to the optimizer,
    which does not prune by a side without a filter.
    """
    touched = [row[0] for row in updates.select(partition).distinct().collect()]
    target = read_table(updates.sparkSession, path, updates.schema)
    wanted = F.col(partition).isin([value for value in touched if value is not None])
    return target.filter(wanted | F.col(partition).isNull() if None in touched else wanted)


def upsert_table(updates: DataFrame, path: str, keys: list[str], partition: str) -> None:
    """Merge ``updates`` into the table: new versions replace stored ones.

    ``partition`` names a column of ``updates`` that is a function of the keys
    (a date of the key's time, a range of its id), so all versions of a row lie
    in one partition. ``updates`` must hold each key once; missing parts of a key
    are equal to one another, and a missing partition is one like any other.
    """
    spark = updates.sparkSession
    recover(spark, path)
    if not exists(spark, path):
        _write(updates, path, partition)
        return
    with persisted(updates):
        merged = upsert(affected(updates, path, partition), updates, keys)
        _publish(merged.select(*updates.columns), path, partition)


def insert_first(
    updates: DataFrame, path: str, keys: list[str], partition: str, order: str = "ingest_time", spread: bool = False
) -> None:
    """Merge rows of which the first version by ``order`` counts.

    Usually the stored version is the first: then only rows with new keys are
    appended and nothing is rewritten. A partition is rewritten only when an
    earlier version of a stored row turns up. ``updates`` must hold each key
    once; ``partition`` is a function of the keys. Missing parts of a key are equal
    to one another. ``spread``: ``updates`` are dealt by ``partition`` already, as a new table wants it.
    """
    spark = updates.sparkSession
    recover(spark, path)
    if not exists(spark, path):
        _write(updates, path, partition, spread)
        return
    with persisted(updates):
        known = affected(updates, path, partition).select(
            *(F.col(k).alias(f"_new_{k}") for k in keys), F.struct(F.col(order).alias("at")).alias("_stored")
        )
        # one look at the stored keys tells both what is new and what came earlier
        with persisted(updates.join(known, same_key(keys), "left").select(*updates.columns, "_stored")) as met:
            came_before = F.col(order) < F.col("_stored.at")
            # told before the table changes: then Spark drops what is kept of it, and the join would run again
            some_earlier = met.agg(F.coalesce(F.bool_or(came_before), F.lit(False))).first()[0]
            earlier = met.filter(came_before).select(*updates.columns)
            fresh = met.filter("_stored IS NULL").select(*updates.columns)
            # a repeated job finds what it has already appended among the known keys
            fresh.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)
            if some_earlier:
                merged = upsert(affected(earlier, path, partition), earlier, keys)
                _publish(merged.select(*updates.columns), path, partition)


def partition_marks(spark: SparkSession, path: str, partition: str) -> dict[str, str]:
    """A mark per partition that changes whenever files are added, replaced or removed there.

    It comes from the listing (names and sizes), so no row is read.
    """
    fs, location = _path(spark, path)
    found = {}
    for folder in [s.getPath() for s in fs.listStatus(location) if s.isDirectory()]:
        if folder.getName().startswith(f"{partition}="):
            files = sorted(f"{s.getPath().getName()}:{s.getLen()}" for s in fs.listStatus(folder) if s.isFile())
            found[folder.getName().split("=", 1)[1]] = hashlib.sha256("\n".join(files).encode()).hexdigest()
    return found


def replace_partitions(df: DataFrame, path: str, partition: str, names: list[str]) -> None:
    """Put the rows of ``df`` in the place of the partitions ``names`` (folder names after ``=``); those that ``df`` has no row of go.

    ``df`` must have no rows of other partitions.
    """
    spark = df.sparkSession
    recover(spark, path)
    if not exists(spark, path):
        _write(df, path, partition)
        return
    df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(_pending(path))
    fs, staged = _path(spark, _pending(path))
    fresh = {s.getPath().getName() for s in fs.listStatus(staged) if s.isDirectory()}
    _move(spark, path)
    _delete(spark, _pending(path))
    for name in names:
        if f"{partition}={name}" not in fresh:
            fs.delete(_path(spark, f"{path.rstrip('/')}/{partition}={name}")[1], True)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int, unit: str = "day") -> int:
    """Append a streaming batch; writing the same batch again replaces it. Rows put in place.

    Rows lie by receipt date (or its month or year), so retention removes whole
    folders, and their number doesn't grow with that of the batches. The batch is
    written beside the table; its files are then moved into the folders of their
    dates under names that begin with the batch. A repeated batch holds the same
    rows and meets its earlier files by name: each is replaced, and those beyond
    the new number go, whose names follow on; the folder is never listed.
    """
    spark, staged = df.sparkSession, path.rstrip("/") + "__batch"
    dated = df.withColumn("ingest_date", F.to_date(F.date_trunc(unit, "ingest_time")))
    dated.hint("rebalance", "ingest_date").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("ingest_date").parquet(staged)
    fs, location = _path(spark, staged)
    days = [s.getPath() for s in fs.listStatus(location) if s.isDirectory() and "=" in s.getPath().getName()]
    rows = spark.read.schema(dated.schema).parquet(staged).count() if days else 0
    for day in days:
        _, folder = _path(spark, f"{path.rstrip('/')}/{day.getName()}")
        fs.mkdirs(folder)

        def named(number: int) -> JavaObject:
            return _path(spark, f"{folder}/batch-{batch_id}-{number:05d}.parquet")[1]

        parts = [s.getPath() for s in fs.listStatus(day)]
        for number, part in enumerate(parts):
            fs.delete(named(number), False)
            if not fs.rename(part, named(number)):
                raise OSError(f"cannot move {part} to {folder}")
        number = len(parts)
        while fs.delete(named(number), False):
            number += 1
    _delete(spark, staged)
    return rows


def compact(spark: SparkSession, path: str, partition: str, until: str, file_bytes: int = 128 << 20) -> list[str]:
    """Rewrite partitions below ``until`` that lie in more files than their size needs; their names.

    For closed partitions: a batch that is run again finds its rows by the names of
    its files, which are lost here, so ``until`` must lie before any partition that
    the stream's next batch can bring rows of. Each partition is replaced by the publishing step of
    the other changes, a stage of few partitions at a time, so that a job that
    died is completed by the next one and readers see each row once.
    """
    recover(spark, path)
    fs, location = _path(spark, path)
    crowded = {}
    for folder in [s.getPath() for s in fs.listStatus(location) if s.isDirectory()]:
        name = folder.getName().removeprefix(f"{partition}=")
        if folder.getName().startswith(f"{partition}=") and name < until:
            sizes = [s.getLen() for s in fs.listStatus(folder) if s.isFile()]
            wanted = max(1, -(-sum(sizes) // file_bytes))
            if len(sizes) > wanted:
                crowded[name] = wanted
    for name, wanted in sorted(crowded.items()):
        rows = read_table(spark, path).filter(F.col(partition).cast("string") == name)
        rows.repartition(wanted).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(_pending(path))
        _move(spark, path)
        _delete(spark, _pending(path))
    return sorted(crowded)


def _drop_dates(spark: SparkSession, path: str, partition: str, wanted) -> None:
    fs, location = _path(spark, path)
    for status in fs.listStatus(location):
        name = status.getPath().getName()
        if name.startswith(f"{partition}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            if wanted(date.fromisoformat(name.split("=", 1)[1])):
                fs.delete(status.getPath(), True)


def purge_table(
    spark: SparkSession, path: str, time_col: str, cutoff: datetime, partition: str
) -> None:
    """Remove rows older than ``cutoff`` from a table partitioned by the date of ``time_col``.

    Older days go as folders; only the day of the cut-off is rewritten.
    """
    recover(spark, path)
    day = cutoff.date()
    edge = read_table(spark, path).filter(F.col(partition) == F.lit(day))
    kept = edge.filter(F.col(time_col) >= F.lit(cutoff).cast("timestamp_ntz"))
    if kept.isEmpty():
        _drop_dates(spark, path, partition, lambda d: d <= day)
    else:
        _publish(kept, path, partition)
        _drop_dates(spark, path, partition, lambda d: d < day)


def replace_range_table(
    updates: DataFrame, path: str, time_col: str, start: datetime, partition: str
) -> None:
    """Replace all rows from ``start`` on in a table partitioned by the date of ``time_col``."""
    spark = updates.sparkSession
    recover(spark, path)
    if not exists(spark, path):
        _write(updates, path, partition)
        return
    edge = read_table(spark, path, updates.schema).filter(F.col(partition) == F.lit(start.date()))
    kept = edge.filter(F.col(time_col) < F.lit(start).cast("timestamp_ntz"))
    with persisted(kept.unionByName(updates)) as merged:
        # one value per day of the replaced span
        fresh = {row[0] for row in merged.select(partition).distinct().toLocalIterator()}
        _publish(merged, path, partition)
    _drop_dates(spark, path, partition, lambda d: d >= start.date() and d not in fresh)
