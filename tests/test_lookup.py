from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from ledgerloom.functions.scalars import normalize_id
from ledgerloom.operators import lookup as L
from ledgerloom.operators.reconcile import reconcile, reconcile_totals
from ledgerloom.sources.shapes import literal_table


def test_duplicate_keys_are_reported(spark):
    rates = spark.createDataFrame([("2024", "BRL", 5.0), ("2024", "BRL", 5.1), ("2024", "USD", 1.0), (None, "BRL", 1.0), (None, "BRL", 2.0)],
                                  "Year string, Currency string, Value double")
    got = L.duplicate_keys(rates, ["Year", "Currency"])
    assert rows(got) == [(None, "BRL", 2), ("2024", "BRL", 2)]


def test_lookup_normalised_keys_fan_out_and_nulls(spark, join_path):
    facts = spark.createDataFrame([(1, "7.1-k"), (2, "9"), (3, None), (4, "8")], "id int, client string")
    dim = spark.createDataFrame([("71K", "A"), ("8", "B"), ("8", "C"), (None, "N")], "tax string, name string")
    key = [L.Key("client", "tax", left_by=normalize_id, right_by=normalize_id)]
    assert rows(L.lookup(facts, dim, key, ["name"]), "id", "name") == [(1, "A"), (2, None), (3, None), (4, "B"), (4, "C")]
    assert rows(L.lookup(facts, dim, key, ["name"], how="inner"), "id", "name") == [(1, "A"), (4, "B"), (4, "C")]
    safe = [L.Key("client", "tax", null_safe=True)]
    assert (3, "N") in rows(L.lookup(facts, dim, safe, {"name": "label"}), "id", "label")


def test_lookup_of_a_hot_key_spreads_over_tasks(spark, join_path):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    facts = spark.range(0, 9000, 1, 12).select("id", hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    dim = spark.range(0, 9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = L.lookup(facts, dim, [L.Key("k", "k")], ["v"])
    assert joined.count() == 9000
    assert joined.filter(F.col("v") != F.col("k") * 2).count() == 0
    # So that the small test partitions count as large ones and are not merged again.
    scale = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in scale}
    for k, v in scale.items():
        spark.conf.set(k, v)
    try:
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.sum((F.col("k") == 0).cast("int")).alias("n"), F.max("pad"))
        counts = [r["n"] for r in per_task.collect() if r["n"]]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(counts) == 3000 and len(counts) > 1 and max(counts) < 3000


def test_null_keys_of_a_left_join_spread_over_tasks(spark):
    facts = spark.range(0, 9000, 1, 12).select("id", F.when(F.col("id") < 0, F.col("id")).alias("k"))
    dim = spark.range(0, 9000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        joined = L.lookup(facts, dim, [L.Key("k", "k")], ["v"])
        tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == 9000 and len(tasks) > 3 and max(tasks) < 6000


def test_filter_after_a_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(100).selectExpr("id", "id % 7 AS k", "id * 1.5D AS amount", "CAST(id AS STRING) AS v", "'wide' AS w").write.parquet(path)
    dim = spark.range(7).selectExpr("id AS k", "id + 1 AS label")
    joined = L.lookup(spark.read.parquet(path), dim, [L.Key("k", "k")], ["label"]).filter("v = '3'").select("id", "label")
    scan = next(line for line in joined._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "EqualTo(v,3)" in scan and "w:string" not in scan
    assert rows(joined) == [(3, 4)]
    kept = L.without_matches(spark.read.parquet(path), dim.select("k"), ["k"], F.col("amount") > 30).filter("v = '3'")
    assert "EqualTo(v,3)" in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(kept, "id") == [(3,)]


def test_build_side_is_neither_copied_nor_forced(spark):
    small = literal_table(spark, [(1, "a"), (2, None)], "k int, v string").groupBy("k").agg(F.max("v").alias("v"))
    big = spark.range(10**8).select(F.col("id").alias("k"), F.col("id").alias("v"))
    for dim, copies in ((small, 1), (big, 0)):  # the literal table itself unfolds one array
        plan = L.lookup(spark.range(10), dim, [L.Key("id", "k")], ["v"])._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate") == copies and "strategy=broadcast" not in plan


GROUPS = [  # id, holding, month, stream, country, type
    (1, "A", 1, "EB", "CL", "Provision"), (2, "A", 1, "EB", "MX", "Invoice"),
    (3, "B", 1, "EB", "CL", "Provision"), (4, "B", 1, "EB", "CL", "Provision write-off"),
    (5, "C", 1, "EB", "CL", "Memo"), (6, "C", 1, "EB", "CL", None),
    (7, None, 1, "EB", "CL", "Provision"), (8, None, 1, "EB", "CL", "Bill"),
    (9, None, 2, "EB", "CL", "Provision"), (10, "D", 1, "EB", "CL", "Credit Note"),
    (11, "D", 1, "EB", "CL", "Memo"), (12, "D", 1, "CB", "CL", "Provision"),
]


def test_reconcile(spark, join_path):
    df = spark.createDataFrame(GROUPS, "id int, holding string, month int, stream string, country string, document_type string")
    with_country = reconcile(df, ["holding", "month", "stream", "country"])
    assert rows(with_country, "id", "document_binary") == [
        (1, 0), (2, 1), (3, 0), (4, 0), (8, 1), (9, 0), (10, 1), (12, 0)]
    # Without the country, the invoice in MX settles the provision in CL.
    without = reconcile(df, ["holding", "month", "stream"])
    assert rows(without, "id") == [(2,), (3,), (4,), (8,), (9,), (10,), (12,)]


def test_reconcile_totals_lets_reconciled_sources_through(spark):
    df = spark.createDataFrame(
        [("A", 0, 1), ("A", 1, 2), ("B", 0, 3), ("A", None, 4)], "holding string, cls int, id int")
    assert rows(reconcile_totals(df, ["holding"], "cls"), "id") == [(2,), (3,)]
    assert rows(reconcile_totals(df, ["holding"], "cls", keep_unclassed=True), "id") == [(2,), (3,), (4,)]


def test_group_value_equals_window(spark, join_path):
    df = spark.createDataFrame([(1, "a", 2), (2, "a", 5), (3, None, 1), (4, None, 7), (5, "b", None)], "id int, k string, v int")
    got = L.group_value(df, ["k"], {"top": F.max("v")})
    want = df.withColumn("top", F.max("v").over(Window.partitionBy("k")))
    assert rows(got) == rows(want)


def test_latest_version_keeps_ties_and_uses_all_versions(spark, join_path):
    df = spark.createDataFrame(
        [("d1", 1, "x"), ("d1", 2, "x"), ("d1", 2, "y"), ("d2", 5, "z"), ("d3", None, "n")], "deal string, ts int, v string")
    assert rows(L.latest_by(df, "deal", "ts")) == [("d1", 2, "x"), ("d1", 2, "y"), ("d2", 5, "z")]
    early = df.filter("ts < 2")
    assert rows(L.latest_by(early, "deal", "ts", versions=df)) == []


def test_first_row_flag(spark, join_path):
    df = spark.createDataFrame(
        [("K", 2024, 2, "b"), ("K", 2024, 2, "a"), ("K", 2023, 9, "c"), (None, 2024, 1, "d"), (None, 2024, 1, "e"),
         ("J", 2024, 1, "f")], "company string, y int, m int, deal string")
    got = {r["deal"]: r["is_first"] for r in L.first_row_flag(df, "company", ["y", "m", "deal"]).collect()}
    assert got == {"a": False, "b": False, "c": True, "d": True, "e": True, "f": True}


def test_running_flag_equals_running_max(spark, join_path):
    df = spark.createDataFrame(
        [("A", "1", "x"), ("A", "2", "hit"), ("A", "2", "x"), ("A", "3", "x"), ("B", "1", "x"), (None, "1", "hit"),
         (None, "0", "x"), ("C", None, "hit"), ("C", "1", "x"), ("D", None, "x"), ("D", "1", "hit")],
        "g string, o string, v string")
    got = L.running_flag(df, ["g"], "o", F.col("v") == "hit", "seen")
    w = Window.partitionBy("g").orderBy("o").rangeBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("seen", F.max(F.when(F.col("v") == "hit", 1).otherwise(0)).over(w))
    assert rows(got) == rows(want)


def test_share_of_total(spark, join_path):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", -5.0), (None, 2.0)], "k string, v double")
    got = rows(L.share_of_total(df, ["k"], "v", "share"), "k", "v", "share")
    assert got == [(None, 2.0, 1.0), ("a", 1.0, 0.25), ("a", 3.0, 0.75), ("b", -5.0, None), ("b", 5.0, None)]
