"""Scratch scopes of jobs that run side by side."""

import threading

from locus.plans.jobs import together
from locus.session import materialize, path_exists, scratch_path, scratch_scope


def test_scopes_side_by_side_keep_their_own_tables(spark):
    """The first scope ends while the second still reads its table."""
    first_done, second_wrote = threading.Event(), threading.Event()

    def first():
        with scratch_scope(spark):
            second_wrote.wait(60)
            materialize(spark.range(3), "first")
        first_done.set()

    def second():
        with scratch_scope(spark):
            df = materialize(spark.range(5), "second")
            second_wrote.set()
            first_done.wait(60)
            return df.count()

    assert together({"first": first, "second": second})["second"] == 5


def test_worker_threads_write_into_the_scope_that_started_them(spark):
    with scratch_scope(spark):
        path = together({"a": lambda: scratch_path(spark, "inner")})["a"]
        spark.range(1).write.parquet(path)
        assert path_exists(spark, path)
    assert not path_exists(spark, path)
