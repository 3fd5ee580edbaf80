from locus.functions.recode import ADMIN2_RULES, recode


def test_all_rules_conditions_null_unmatched(spark):
    data = [(r.value, r.when_value or "Texas") for r in ADMIN2_RULES]
    data += [("Out-of-state", "Ohio"), ("Lake and Peninsula", "Texas"), ("Unknown", "Utah"),
             (None, "Texas"), ("Kings", "New York")]
    df = spark.createDataFrame(data, "admin2 string, province_state string")
    out = [r["admin2"] for r in recode(df).collect()]
    assert out[: len(ADMIN2_RULES)] == [r.replacement for r in ADMIN2_RULES]
    assert out[len(ADMIN2_RULES):] == ["Out-of-state", "Lake and Peninsula", "Unknown", None, "Kings"]
    assert "Dona Ana" in out  # non-ASCII source value matched exactly


def test_case_sensitive(spark):
    df = spark.createDataFrame([("new york", None)], "admin2 string, province_state string")
    assert recode(df).first()["admin2"] == "new york"
