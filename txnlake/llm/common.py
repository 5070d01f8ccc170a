"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# ASCII white space that separates words; everything else belongs to a word.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder, read by Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back,
    so that later branches neither recompute it nor depend on one executor.
    ``options`` are the writer's."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once all that reads them is stored itself."""
    for df in tables:
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, limit: int
) -> DataFrame:
    """(id_, text, y) of at most ``limit`` labelled training documents.

    Labels are taken only from ids whose fold is not 0 and that ``docs`` holds.
    The bounded sample is the ``limit`` such ids with the smallest hash, so it is
    the same in every run; null ids, null labels are left out, repeated ids count
    once, in the labels (largest label) and in the documents (smallest text).
    Only the bounded id list is broadcast.
    """
    texts = docs.select(F.col("doc_id").alias("id_"), F.col("text"))
    ids = (
        labels.select(F.col("doc_id").alias("id_"), F.col(label).cast("int").alias("y"))
        .filter(F.col("id_").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id_")) != 0))
        .groupBy("id_")
        .agg(F.max("y").alias("y"))
        .join(texts.select("id_").distinct(), "id_", "left_semi")
        .orderBy(F.xxhash64("id_"), "id_")
        .limit(limit)
    )
    return (
        texts.join(F.broadcast(ids), "id_")
        .groupBy("id_", "y")
        .agg(F.min("text").alias("text"))
        .select("id_", "text", "y")
    )
