"""Numbering, paging and joining when one key owns most rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.operators import relational as rl
from cartloom.operators import skew as sk
from cartloom.plans import push as ps


def hot_table(spark, rows=3000):
    """Key 1 owns about two thirds of the rows, NULL owns some, the rest are small."""
    i = F.col("id")
    key = F.when(i % 3 < 2, F.lit(1)).when(i % 30 == 2, F.lit(None)).otherwise(i % 50 + 2).cast("bigint")
    return spark.range(rows).select(
        key.alias("k"), F.concat(F.lit("é"), (F.xxhash64(i) % 1000).cast("string")).alias("o1"),
        F.when(i % 7 != 0, i * 31 % 997).alias("o2"), i.alias("o3"),
    )


def plain(df, keys):
    w = Window.partitionBy(*keys).orderBy("o1", "o2", "o3")
    return df.withColumn("n", F.row_number().over(w).cast("bigint"))


def as_set(df):
    return sorted(map(repr, df.collect()))


def test_group_numbers_equal_a_window(spark):
    df = hot_table(spark)
    for ranges in (2, 7, 64):
        got = sk.number_rows(df, ["k"], ["o1", "o2", "o3"], "n", ranges)
        assert as_set(got) == as_set(plain(df, ["k"]))


def test_global_numbers_equal_a_window(spark):
    df = hot_table(spark)
    got = sk.number_rows(df, [], ["o1", "o2", "o3"], "n", 16)
    assert as_set(got) == as_set(plain(df, []))


def test_ranges_are_even_and_cut_the_hot_key(spark):
    df = hot_table(spark).withColumn("__tie", F.xxhash64("k", "o1", "o2", "o3"))
    columns = ["k", "o3", "__tie"]
    placed = sk._place(df, columns, sk._boundaries(df, columns, 20), 20)
    sizes = [r["count"] for r in placed.groupBy("__range").count().collect()]
    assert 15 <= len(sizes) <= 21 and max(sizes) < 400
    assert placed.where("k = 1").select("__range").distinct().count() >= 10


def test_ties_are_numbered_apart_and_alike_on_a_rerun(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), F.lit(0).alias("o"), F.col("id").alias("v"))
    first = sk.number_rows(df, ["k"], ["o"], "n", 8)
    again = sk.number_rows(df.repartition(5), ["k"], ["o"], "n", 8)
    assert as_set(first) == as_set(again)
    assert first.select("k", "n").distinct().count() == 500 and first.agg(F.max("n")).first()[0] == 250


def test_equal_rows_an_empty_table_and_nulls_are_numbered(spark):
    same = spark.range(300).select(F.lit(None).cast("long").alias("k"), F.lit("x").alias("o"))
    assert sorted(r["n"] for r in sk.number_rows(same, ["k"], ["o"], "n", 8).collect()) == list(range(1, 301))
    assert sk.number_rows(same.limit(0), ["k"], ["o"], "n", 8).collect() == []


def test_rank_runs_no_job_while_planning(spark):
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("planning", "planning")
    sk.number_rows(hot_table(spark), ["k"], ["o3"], "n")
    sk.lookup_hot(hot_table(spark), hot_table(spark).dropDuplicates(["k"]).select("k"), ["k"])
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", before)


def test_pages_are_bounded_and_whole(spark):
    df = hot_table(spark)
    paged = sk.page_rows(df, ["k"], ["o1", "o2", "o3"], 64, ranges=20)
    sizes = paged.groupBy("k", "page").count()
    assert sizes.agg(F.max("count")).first()[0] == 64
    assert paged.count() == df.count()
    assert paged.where("k = 1").agg(F.max("page")).first()[0] == 32


def test_lookup_hot_matches_a_plain_join(spark):
    facts = hot_table(spark).select("k", "o3")
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        for buckets in (1, 3, 1 << 14):
            got = sk.lookup_hot(facts, dim, ["k"], how, rows_per_salt=50, buckets=buckets)
            assert as_set(got) == as_set(facts.join(dim, ["k"], how))


def test_lookup_hot_with_ten_thousand_hot_keys(spark):
    facts = spark.range(40_000).select((F.col("id") % 10_000).alias("k"), F.col("id").alias("v"))
    dim = spark.range(10_500).select(F.col("id").alias("k"), (F.col("id") * 3).alias("w"))
    got = sk.lookup_hot(facts, dim, ["k"], "inner", rows_per_salt=1)
    assert as_set(got) == as_set(facts.join(dim, ["k"]))


def test_a_hot_key_meets_several_salts(spark):
    facts = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    table = sk.salt_table(facts, ["k"], rows_per_salt=100, buckets=16)
    salts = spark.range(1).select(table.alias("s")).first()["s"]
    assert sorted(salts) == [1] * 15 + [10]


def test_nest_splits_a_large_parent(spark):
    df = hot_table(spark).where("k is not null")
    parents = df.select("k").distinct().union(spark.range(900, 901))
    nested = rl.nest(parents, df, ["k"], ["o3"], ["o3"], "children", 100, ranges=10)
    assert nested.where("k = 1").count() == 20
    assert nested.agg(F.max(F.size("children"))).first()[0] == 100
    total = nested.select(F.explode("children").alias("c"), "k").agg(F.count("*"), F.countDistinct("c.o3")).first()
    assert total[0] == total[1] == df.count()
    assert nested.where("k = 900").select("part", "children").collect() == [(1, None)]


def test_tree_parts_hold_every_leaf_once(spark):
    rows = spark.range(1000).select(
        F.lit("root").alias("r"), (F.col("id") % 3).alias("a"), (F.col("id") % 21).alias("b"), F.col("id").alias("c")
    )
    tree = rl.nest_tree(rows, [("as", ["a"]), ("bs", ["b"]), ("cs", ["c"])], ["r"], 90, ranges=10)
    leaves = tree.select("part", F.explode("as").alias("x")).select("part", F.explode("x.bs").alias("y")).select(
        "part", F.explode("y.cs").alias("z")
    )
    assert tree.count() == 12 and leaves.select("z.c").distinct().count() == 1000 == leaves.count()


def test_batches_are_full_but_the_last(spark):
    df = spark.range(1003).select(F.col("id").alias("inventory_item_id"), F.lit(5).alias("location_id"), F.lit(1).alias("available"))
    batches = ps.to_batches(df, 250, ["inventory_item_id"], ranges=10)
    assert [r["count"] for r in batches.groupBy("batch").count().orderBy("batch").collect()] == [250, 250, 250, 250, 3]
    payload = ps.quantity_payload(batches).orderBy("batch").collect()
    assert [p["items"] for p in payload] == [250, 250, 250, 250, 3]
    assert '"inventoryItemId":"gid://shopify/InventoryItem/1000"' in payload[4]["payload"]


def test_text_list_parts(spark):
    rows = spark.range(25).select(F.lit("a").alias("g"), F.format_string("%02d", "id").alias("v"))
    got = rl.text_list(rows, ["g"], "v", ",", 10).orderBy("part").collect()
    assert [r["v_list"].count(",") for r in got] == [9, 9, 4] and got[0]["v_list"].startswith("00,01")
