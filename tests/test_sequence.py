import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from nightjar.operators.sequence import bucketed_lag, with_bucket


def frame(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for vin in ("a", "b", "c"):
        t = 0
        for _ in range(n // 3):
            t += rnd.choice([1, 5, 60_000, 3_600_000, 7_200_000, 30_000_000])
            x = None if rnd.random() < 0.1 else rnd.random()
            rows.append(("v", vin, t, x, rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "vendor string, vin string, eventat long, x double, m int")


def test_bucketed_lag_equals_plain_lag(spark):
    df = frame(spark)
    w = Window.partitionBy("vendor", "vin").orderBy("eventat")
    plain = df.select("vin", "eventat",
                      F.coalesce(F.lag("x").over(w), F.when(F.lag("eventat").over(w).isNull(), F.col("x")))
                       .alias("self_default"),
                      F.lag("x", 1, 0.0).over(w).alias("zero_default"))
    got = bucketed_lag(with_bucket(df, "eventat"), ["vendor", "vin"], "eventat",
                       {"self_default": ("x", F.col("x")), "zero_default": ("x", F.lit(0.0))})
    a = {(r.vin, r.eventat, r.self_default, r.zero_default) for r in plain.collect()}
    b = {(r.vin, r.eventat, r.self_default, r.zero_default)
         for r in got.select("vin", "eventat", "self_default", "zero_default").collect()}
    assert a == b


def test_bucketed_lag_keeps_null_previous_value(spark):
    rows = [("v", "a", 1, 1.0), ("v", "a", 2, None), ("v", "a", 3_600_001, 3.0)]
    df = spark.createDataFrame(rows, "vendor string, vin string, eventat long, x double")
    got = bucketed_lag(with_bucket(df, "eventat"), ["vendor", "vin"], "eventat", {"p": ("x", F.lit(0.0))})
    assert [r.p for r in got.orderBy("eventat").collect()] == [0.0, 1.0, None]


def test_bucketed_island_ids_equal_plain(spark):
    from nightjar.operators.sequence import bucketed_island_ids
    df = frame(spark, n=900, seed=5)
    w = Window.partitionBy("vendor", "vin").orderBy("eventat")
    start = F.when((F.col("m") == 1) & (F.lag("m", 1, 0).over(w) == 0), 1).otherwise(0)
    plain = df.withColumn("st", start).withColumn("s", F.sum("st").over(w))
    a = {(r.vin, r.eventat, r.s) for r in plain.collect()}
    got = bucketed_island_ids(with_bucket(df, "eventat"), ["vendor", "vin"], "eventat", "m", "s")
    assert a == {(r.vin, r.eventat, r.s) for r in got.collect()}


def plain_and_cut(spark, df, least_rows, ties=("x", "m")):
    """Rows with LAGs and island ids by whole-vehicle windows, and by ranges."""
    from nightjar.operators.sequence import every_row, island_ids, lagged, ordered
    w = Window.partitionBy("vendor", "vin").orderBy("eventat", *ties)
    started = F.when((F.col("f") == 1) & (F.lag("f", 1, 0).over(w) == 0), 1).otherwise(0)
    flag = F.when(F.col("x") > F.coalesce(F.col("p"), F.lit(-1.0)), 1).otherwise(0)
    plain = (df.withColumn("p", F.lag("x").over(w)).withColumn("p0", F.lag("x", 1, 0.0).over(w)).withColumn("f", flag)
             .withColumn("st", started).withColumn("s", F.sum("st").over(
                 Window.partitionBy("vendor", "vin").orderBy("eventat"))).drop("st"))
    o = lagged(ordered(df, ["vendor", "vin"], "eventat", ties, least_rows),
               {"p": ("x", None), "p0": ("x", F.lit(0.0))})
    from dataclasses import replace
    o = island_ids(replace(o, rows=o.rows.withColumn("f", flag)), "f", "s")
    cols = ["vendor", "vin", "eventat", "x", "m", "p", "p0", "f", "s"]
    return plain.select(cols), every_row(o).select(cols), o


def bag(df):
    return sorted(map(str, df.collect()))


def test_no_heavy_key_takes_the_plain_window(spark):
    plain, cut, o = plain_and_cut(spark, frame(spark), 50_000)
    assert not o.split and bag(plain) == bag(cut)
    text = cut._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text


def test_ranges_of_heavy_vehicles_equal_the_plain_window(spark):
    for seed in (1, 2):
        plain, cut, o = plain_and_cut(spark, frame(spark, 900, seed), 20)
        assert o.split and bag(plain) == bag(cut)


def test_hot_instants_equal_the_plain_window(spark):
    rnd = random.Random(9)
    rows = []
    for vin, n in (("a", 700), ("b", 30), ("c", 1)):
        for _ in range(n):
            t = rnd.choice([5, 7, 7, 7, 7, 9, 40, rnd.randint(-50, 90)])
            rows.append(("v", vin, t, rnd.choice([None, 0.25, 0.5, rnd.random()]), rnd.randint(0, 2)))
    rows += [("v", "a", 50, 0.75, 1)] * 3000                     # equal readings
    df = spark.createDataFrame(rows, "vendor string, vin string, eventat long, x double, m int").repartition(3)
    plain, cut, o = plain_and_cut(spark, df, 20)
    assert o.hot and o.weighted and bag(plain) == bag(cut)
    # Equal readings need no order: two rows stand for them.
    assert o.rows.where("vin = 'a' AND eventat = 50 AND x = 0.75").count() == 2
    sizes = [r["count"] for r in o.rows.groupBy("vin", "_range").count().collect()]
    assert max(sizes) < 3 * df.count() / (8 * 4) and len(sizes) > 6


def test_a_vehicle_with_a_third_of_all_rows_in_one_hour_gives_even_tasks(spark):
    from nightjar.operators.sequence import ordered
    tasks = 16
    hot = spark.range(200_000).selectExpr("'v' AS vendor", "'hot' AS vin", "1800000 + (id * 7919) % 3600000 AS eventat",
                                          "id / 3.0 AS x", "CAST(id % 2 AS INT) AS m")
    instant = spark.range(100_000).selectExpr("'v' AS vendor", "'stuck' AS vin", "CAST(77 AS LONG) AS eventat",
                                              "id / 3.0 AS x", "CAST(id % 2 AS INT) AS m")
    rest = spark.range(300_000).selectExpr("'v' AS vendor", "CAST(id % 3000 AS STRING) AS vin", "id * 1000 AS eventat",
                                           "id / 3.0 AS x", "CAST(id % 2 AS INT) AS m")
    df = hot.unionByName(instant).unionByName(rest)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        o = ordered(df, ["vendor", "vin"], "eventat", ["x", "m"], least_rows=1000)
        per_task = [r["count"] for r in o.rows.repartition(tasks, "vendor", "vin", "_range")
                    .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == 600_000 and len(per_task) == tasks
    assert max(per_task) <= 3 * sorted(per_task)[tasks // 2]
