"""Exact distinct counts by bitmaps: equal to sets, and no task holds a hot key's values."""

from pyspark.sql import functions as F

from clickpath.operators import distincts as D
from clickpath.operators import sessions as S

from helpers import ev, events_df


def hot_events(spark, n, products):
    """One key with ``n`` events over ten days and ``products`` distinct products, beside 200 small keys."""
    hot = spark.range(n).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") * 864_000 / n)).alias("event_time"),
        F.when(F.col("id") % 50 == 0, "purchase").otherwise("view").alias("event_type"), (F.col("id") % products * 1_000_003).alias("product_id"),
        (F.col("id") % 300).alias("category_id"), F.lit(None).cast("string").alias("category_code"),
        F.concat(F.lit("b"), F.col("id") % 40).alias("brand"), (F.col("id") % 9).cast("double").alias("price"), F.lit(1).cast("long").alias("user_id"),
        F.lit("hot").alias("user_session"))
    cold = hot.limit(4000).withColumn("user_session", F.concat(F.lit("s"), F.col("product_id") % 200)).withColumn("brand", F.lit(None).cast("string"))
    return hot.unionByName(cold)


def same(a, b):
    columns = sorted(a.columns)
    return a.select(columns).exceptAll(b.select(columns)).count() == 0 and b.select(columns).exceptAll(a.select(columns)).count() == 0


def test_bitmap_mode_equals_exact(spark):
    events = hot_events(spark, 30_000, 7_000)
    for gap in ("30 minutes", "12 hours"):
        assert same(S.sessionize(events, gap, distinct="bitmap", heavy_events=500), S.sessionize(events, gap, distinct="exact"))
    assert same(S.session_features(events, distinct="bitmap"), S.session_features(events, distinct="exact"))  # no key is heavy


def test_bitmap_mode_of_odd_rows(spark):
    rows = [ev(0, "purchase", session="p"), ev(1, None, session="p"), ev(10, session="a"), ev(11, brand=None, product=None, session="a"),
            ev(5000, "purchase", product=9, session="a"), ev(None, session="a"), ev(3, session=None)]
    events = events_df(spark, rows * 3)
    assert same(S.sessionize(events, distinct="bitmap", heavy_events=2), S.sessionize(events, distinct="exact"))
    assert S.sessionize(events.limit(0), distinct="bitmap").count() == 0


def test_a_hot_key_of_a_million_products_is_spread(spark):
    n = 1_000_000
    values = spark.range(n).select(F.lit("hot").alias("k"), F.lit(0).alias("kind"), (F.col("id") * 7919).cast("string").alias("value"))
    bitmaps = D.value_bitmaps(values, ["k"]).cache()
    assert D.count_bitmaps(bitmaps, ["k"], {0: "n"}).first()["n"] == n
    sizes = bitmaps.select(F.bitmap_count("bitmap").alias("n")).collect()
    assert len(sizes) >= 31 and max(r.n for r in sizes) <= 32_768 < n / 10  # the largest group of the final aggregate
    # the rows of the id join: one (key, bucket) is read by SALTS tasks
    ids = spark.createDataFrame([("hot", 1)], "k string, _sid int")
    joined = D.with_ids(values, ids, ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [r["count"] for r in joined.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
        assert sum(tasks) == n and len(tasks) > 1
        salts = [r["count"] for r in values.groupBy(F.pmod(F.xxhash64("kind", "value"), F.lit(D.SALTS))).count().collect()]
        assert max(salts) < 0.1 * n
        dictionary = [r["count"] for r in D.number_values(values).groupBy(F.col("n") % D.SHARDS).count().collect()]
        assert max(dictionary) < 0.1 * n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        bitmaps.unpersist()


def test_bitmaps_merge_by_or(spark):
    values = spark.range(5000).select((F.col("id") % 7).alias("day"), F.lit(0).alias("kind"), (F.col("id") % 900).cast("string").alias("value"))
    daily = D.value_bitmaps(values, ["day"])
    per_day = {r.day: r.n for r in D.count_bitmaps(daily, ["day"], {0: "n"}).collect()}
    assert per_day == {r.day: r.n for r in values.groupBy("day").agg(F.count_distinct("value").alias("n")).collect()}
    whole = D.merge_bitmaps(daily.withColumn("all", F.lit(1)), ["all"])
    assert D.count_bitmaps(whole, ["all"], {0: "n"}).first()["n"] == 900


def test_bitmaps_of_small_groups_take_few_bytes(spark):
    values = spark.range(2000).select(F.col("id").alias("k"), F.lit(0).alias("kind"), (F.col("id") % 90).cast("string").alias("value"))
    bitmaps = D.value_bitmaps(values, ["k"])
    assert bitmaps.agg(F.max(F.octet_length("bitmap"))).first()[0] <= 64  # 4,096 a group took GBs of a task's memory
    assert D.count_bitmaps(bitmaps, ["k"], {0: "n"}).filter("n <> 1").count() == 0
    # every bit of a word, the sign bit included, survives a merge
    merged = D.merge_bitmaps(bitmaps.withColumn("all", F.lit(1)), ["all"])
    again = D.merge_bitmaps(merged, ["all"])
    assert [D.count_bitmaps(x, ["all"], {0: "n"}).first()["n"] for x in (merged, again)] == [90, 90]
    full = spark.range(64).select(F.lit(1).alias("all"), F.lit(0).alias("kind"), F.lit(0).alias("chunk"),
                                  F.unhex(F.lpad(F.hex(F.expr("shiftleft(1L, cast(id as int))")), 16, "0")).alias("bitmap"))
    assert D.count_bitmaps(D.merge_bitmaps(full, ["all"]), ["all"], {0: "n"}).first()["n"] == 64
