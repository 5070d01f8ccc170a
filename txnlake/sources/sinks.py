"""Table sinks: append-only Bronze, partition-replacing Silver / Gold.

Tables are parquet folders partitioned by a date column. Rewrites use dynamic
partition overwrite, so a run for some days replaces exactly those days and
leaves every other partition in place (a daily run never wipes history, and a
re-run of the same days is idempotent). Write metrics come from an
``Observation`` on the written frame, so no second job recounts the output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import schemas


def _metrics(obs: Observation, names: Sequence[str], df: DataFrame) -> dict:
    """Observed values. An input that is empty may be folded away with its
    observation and reports zeros; any other lost observation is an error."""
    try:
        return dict(obs.get)
    except Exception:
        if not df.isEmpty():
            raise
        return {n: 0 for n in names}


def _partitions(partition_by: str | Sequence[str] | None) -> list[str]:
    if partition_by is None:
        return []
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _partition_files(
    spark: SparkSession, path: str, column: str, chosen: Callable[[str | None], bool]
) -> dict[str, frozenset[str]]:
    """File names by partition folder, of the first partition column's values
    (text, None for NULL) that ``chosen`` takes. A table not written yet: none."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return {}
    out = {}
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        if not entry.isDirectory() or not name.startswith(column + "="):
            continue
        value = unquote(name.split("=", 1)[1])
        if chosen(None if value == NULL_PARTITION else value):
            found, names = fs.listFiles(entry.getPath(), True), set()
            while found.hasNext():
                names.add(found.next().getPath().getName())
            out[entry.getPath().toString()] = frozenset(names)
    return out


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), root


def drop_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders (or files) with all they hold; missing ones are left out."""
    for folder in folders:
        fs, p = _file_system(spark, folder)
        fs.delete(p, True)


def escape_partition(value: str) -> str:
    """A partition value as Spark writes it in a folder name."""
    return "".join(
        f"%{ord(c):02X}" if ord(c) < 0x20 or ord(c) == 0x7F or c in "\"#%'*/:=?\\{[]^" else c
        for c in value
    )


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing an earlier one."""
    fs, p = _file_system(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_texts(spark: SparkSession, folder: str) -> dict[str, str]:
    """The small files of a folder by name; none where it does not exist."""
    fs, root = _file_system(spark, folder)
    if not fs.exists(root):
        return {}
    out = {}
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        if entry.isDirectory() or name.startswith((".", "_")):
            continue
        out[name] = read_text(spark, entry.getPath().toString())
    return out


def partition_folders(
    spark: SparkSession, path: str, column: str, chosen: Callable[[str | None], bool]
) -> list[str]:
    """Folders of the partitions whose value ``chosen`` takes."""
    return sorted(_partition_files(spark, path, column, chosen))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was written at ``path``."""
    fs, root = _file_system(spark, path)
    return fs.exists(root)


def drop_partitions(
    spark: SparkSession, path: str, column: str, chosen: Callable[[str | None], bool]
) -> list[str]:
    """Delete the partitions whose value ``chosen`` takes; their folders."""
    gone = partition_folders(spark, path, column, chosen)
    drop_folders(spark, gone)
    return gone


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` computed once, for jobs that read it several times: a copy at ``path``,
    deleted afterwards. One that a lost run left is replaced."""
    spark = df.sparkSession
    try:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_folders(spark, [path])


def append(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    fmt: str = "parquet",
) -> dict:
    """Append rows; new columns are added to the table's schema (``sources.schemas``)."""
    schemas.grow(df.sparkSession, path, df.schema, _partitions(partition_by))
    obs = Observation("append")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_written"))
    parts = _partitions(partition_by)
    if parts:
        observed = observed.hint("rebalance", *parts)
    writer = observed.write.mode("append").format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)
    return _metrics(obs, ["rows_written"], df)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] = "_date",
    fmt: str = "parquet",
    metrics: dict | None = None,
    replaces: Callable[[str | None], bool] | None = None,
) -> dict:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    ``metrics`` maps names to extra aggregate Columns observed on the same pass.
    ``replaces`` tells which values of the first partition column (text, None for
    NULL) the frame stands for: those that got no rows are deleted after the
    write, so nothing of an earlier run is left in them.
    """
    metrics = metrics or {}
    spark, first = df.sparkSession, _partitions(partition_by)[0]
    schemas.grow(spark, path, df.schema, _partitions(partition_by))
    before = _partition_files(spark, path, first, replaces) if replaces else {}
    obs = Observation("overwrite")
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows_written"),
        *[c.alias(n) for n, c in metrics.items()],
    )
    parts = _partitions(partition_by)
    # REBALANCE (AQE) groups rows by partition value but splits a large day
    # over several tasks and merges small ones, so files stay near the
    # advisory size instead of one task per day or one file per task and day.
    (
        observed.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*parts)
        .save(path)
    )
    if before:
        now = _partition_files(spark, path, first, replaces)
        drop_folders(spark, [f for f, names in before.items() if now.get(f) == names])
    return _metrics(obs, ["rows_written", *metrics], df)


def store_failures(violations: DataFrame, path: str, check: str, run_id: str) -> dict:
    """Keep the rows of a failed check (one folder per check and run)."""
    tagged = violations.withColumns({"_check": F.lit(check), "_run_id": F.lit(run_id)})
    out = overwrite_partitions(tagged, path, ["_check", "_run_id"])
    if not out["rows_written"]:  # the check passes now
        drop_partitions(violations.sparkSession, f"{path}/_check={check}", "_run_id", run_id.__eq__)
    return out


def read_table(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by its kept schema, which saves reading file footers for it."""
    schema = schemas.stored_schema(spark, path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)
