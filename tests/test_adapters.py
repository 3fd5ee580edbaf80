import datetime as dt

from locus.plans.adapters import TEST_TABLES, Adapters


def test_line_items_are_shuffled_for_orders_and_suppliers_only(spark, tmp_dir):
    day = dt.datetime(2020, 5, 1)
    rows = {
        "region": [(0, "ASIA"), (1, "AMERICA")], "nation": [(0, "N0", 0), (1, "NATION_1", 1)],
        "customer": [(1, "c1", 0, 0.0, "m"), (2, "c2", 1, 0.0, "m"), (3, "c3", 9, 0.0, "m"), (1, "c1b", 1, 0.0, "m")],
        "supplier": [(7, "s7", 0, 0.0)],
        "orders": [(10, 1, "F", 1.0, day, "1-URGENT"), (11, 2, "F", 1.0, day, "5-LOW"), (12, 3, "F", 1.0, day, "5-LOW"),
                   (13, None, "F", 1.0, day, "5-LOW"), (11, 2, "O", 1.0, day, "5-LOW")],
        "lineitem": [(o, 97, 7 if n else 8, n, 1.0, 2.0, 0.1, 0.2, "N", "O", day) for o in (10, 11, 12, 13, None)
                     for n in (0, 1, 2, 4, 6)],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, TEST_TABLES[name]).write.parquet(f"{tmp_dir}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moves = Adapters(spark, tmp_dir).google_mobility_data_staging
        plan = moves._jdf.queryExecution().executedPlan().toString().splitlines()
        got = moves.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # an order of a customer that is there twice and an order that is there twice, each with four line items
    assert len(got) == 16 and {(r["country_region"], r["sub_region_2"]) for r in got} == {
        ("ASIA", None), ("ASIA", "c1"), ("ASIA", "s7"), ("US", None), ("US", "c1b"), ("US", "c2"), ("US", "s7")}
    # the exchanges above the scan of the line items
    at = next(i for i, line in enumerate(plan) if "FileScan" in line and "l_orderkey" in line)
    depth, above = len(plan[at]) - len(plan[at].lstrip(" :+-*")), []
    for line in reversed(plan[:at]):
        own = len(line) - len(line.lstrip(" :+-*"))
        if own < depth:
            depth = own
            if "Exchange hashpartitioning" in line:
                above.append(line.split("hashpartitioning(")[1].split("#")[0])
    assert above == ["l_orderkey", "l_suppkey"]
