from pyspark.sql import functions as F
from pyspark.sql import types as T

from locus.operators.dml import conform, patch_rows, upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def base(spark, data):
    return spark.createDataFrame(data, "k int, d int, v string")


def test_upsert_overlap_disjoint_identical_duplicates_empty(spark):
    final = base(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")])
    inc = base(spark, [(1, 2, "B"), (3, 1, "x"), (3, 1, "x")])  # overlap + new + in-batch duplicate
    assert rows(upsert(final, inc, ["k", "d"])) == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c"), (3, 1, "x")]
    assert rows(upsert(final, final, ["k", "d"])) == rows(final)  # identical batch
    empty = base(spark, [])
    assert rows(upsert(final, empty, ["k", "d"])) == rows(final)
    assert rows(upsert(empty, inc, ["k", "d"])) == [(1, 2, "B"), (3, 1, "x")]


def test_upsert_is_idempotent(spark):
    final = base(spark, [(1, 1, "a"), (2, 1, "c")])
    inc = base(spark, [(2, 1, "C"), (4, 4, "z")])
    once = upsert(final, inc, ["k", "d"])
    assert rows(upsert(once, inc, ["k", "d"])) == rows(once)


def test_null_key_never_deletes(spark):
    final = base(spark, [(None, 1, "a")])
    inc = base(spark, [(None, 1, "b")])
    assert rows(upsert(final, inc, ["k", "d"])) == [(None, 1, "a"), (None, 1, "b")]


def test_patch_rows(spark):
    df = base(spark, [(84036061, 1, "New York"), (5, 1, "x")])
    out = patch_rows(df, F.col("k") == 84036061, {"v": "New York City"})
    assert rows(out) == [(5, 1, "x"), (84036061, 1, "New York City")]


def test_conform_rounds_before_narrowing(spark):
    df = spark.createDataFrame([(2.5, 2.7, 3.5)], "a double, b double, c double")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "c")]
                          + [T.StructField("pad", T.StringType())])
    assert rows(conform(df, schema)) == [(2, 3, 4, None)]  # half-even, padding NULL
