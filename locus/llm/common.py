"""Helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.session import materialize, scratch_path

__all__ = [
    "SPACE", "WORD", "ascii_lower", "attach_salted", "documents", "give_back", "lean", "materialize",
    "remove", "scratch_path", "shuffle_partitions", "text_of", "written",
]

#: ASCII white space and words as the contracts define them.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would change other letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a superseded scratch folder through Spark's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``materialize``, with the folder, for a table that is removed once superseded."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def give_back() -> None:
    """Return freed memory to the machine. A Python worker waits for its next
    task with all it ever took, and an executor has several that wait."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a mapInArrow, whose task gives freed memory back at its end."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def attach_salted(rows: DataFrame, groups: DataFrame, keys: list[str], spread: Column,
                  salts: int = 16) -> DataFrame:
    """Left join ``groups`` (one row per key) to ``rows`` without sending a hot
    key's rows to one task: every group row is repeated once per salt and a
    row joins under the salt that ``spread`` (any hashable column) gives it."""
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = groups.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated, [*keys, "_salt"], "left").drop("_salt")
