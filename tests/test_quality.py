import pytest

from locus.operators.quality import assert_quality, quality_report


def test_quality_report(spark):
    s = "location_identifier int, file_date string"
    tables = {
        "clean": spark.createDataFrame([(1, "a"), (2, "a")], s),
        "empty": spark.createDataFrame([], s),
        "nulls": spark.createDataFrame([(None, "a"), (1, None), (1, "a")], s),
        "dups": spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], s),
    }
    keys = {n: ["location_identifier", "file_date"] for n in tables}
    rep = {(r["table_name"], r["check_name"]): (r["value"], r["passed"])
           for r in quality_report(tables, keys).collect()}
    assert rep[("clean", "has_rows")] == (2, True)
    assert rep[("empty", "has_rows")] == (0, False)
    assert rep[("nulls", "check_nulls")] == (2, False)
    assert rep[("nulls", "check_duplicates")] == (0, True)
    assert rep[("dups", "check_duplicates")] == (1, False)
    with pytest.raises(ValueError, match="check_duplicates of dups gave 1"):
        assert_quality(quality_report(tables, keys))
    assert_quality(quality_report({"clean": tables["clean"]}, keys))
