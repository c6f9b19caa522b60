"""Shapes that keep time, memory and moved bytes in step with the input, and the results they must not change."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from cartloom.config import PartyConfig
from cartloom.operators import relational as rl
from cartloom.plans import stock as st
from cartloom.plans.places import resolve_location
from cartloom.queries.registry import SCHEMAS, order_texts
from cartloom.sources.tables import from_stored


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_catalogue_pairs_are_distinct_without_a_distinct_over_them(spark):
    catalogue = spark.createDataFrame([(1, "A", 5), (1, "A", 5), (2, None, 5)], "inventory_item_id long, sku string, location_id long")
    shops = spark.createDataFrame([(5, None), (5, None), (5, "W0")], "location_id long, warehouse string")
    stock = spark.createDataFrame(
        [("A", "V", None), ("A", "W", 0), ("A", "X", 4), ("A", "Y", 4)], "sku string, warehouse string, available int"
    )
    pairs = st.catalogue_stock(catalogue, shops, stock, "W0", match_warehouse=False)
    rows = [(1, "A", 5, "W0", 0), (1, "A", 5, "W0", 4), (2, None, 5, "W0", 0)]
    assert sorted(map(tuple, pairs.collect())) == rows
    text = plan(pairs)
    assert "Aggregate" not in text[: text.index("Join")]


def test_stored_documents_are_told_readable_by_their_struct(spark):
    texts = spark.createDataFrame(
        [(1, '{"name": "a", "customer": {"email": "x"}}'), (2, "{}"), (3, "[1]"), (4, '"s"'), (5, "null"), (6, '{"name": '), (7, None),
         (8, '{"customer": 3}')], "id long, document string",
    )
    stored = texts.withColumn("stored", F.try_parse_json("document"))
    read = from_stored(stored, "name string, customer struct<email: string>")
    got = {r.id: (r.reject_reason, r.doc and r.doc.name, r.doc and r.doc.customer and r.doc.customer.email) for r in read.collect()}
    bad = ("unreadable document", None, None)
    assert got == {1: (None, "a", "x"), 2: (None, None, None), 3: bad, 4: bad, 5: bad, 6: bad, 7: bad, 8: (None, None, None)}
    text = plan(read.where("reject_reason is null and doc.name = 'a' and doc.customer.email = 'x'"))
    assert "schema_of_variant" not in text and text.count("variantget") + text.count("variant_get") == 1


def write(spark, folder, **tables):
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def small_shop(spark, folder):
    day = datetime(2024, 1, 2)
    write(
        spark, folder, region=[(1, "ASIA")], nation=[(3, "N3", 1), (4, "N4", 9)],
        customer=[(1, "c", 3, 0.0, "m"), (1, "c", 3, 0.0, "m"), (2, "c", 4, 0.0, "m"), (5, "c", None, 0.0, "m"), (None, "c", 3, 0.0, "m")],
        orders=[(10, 1, "F", 0.0, day, "5-LOW"), (11, 2, "P", 0.0, day, "5-LOW"), (12, None, "P", 0.0, day, "5-LOW"), (13, 5, "O", 0.0, day, "5-LOW")],
        lineitem=[(k, 7, 1, n, 2.0, 10.0, d, t, "A", "F", day) for k in (10, 11, 13) for n, d, t in ((1, 0.1, 0.08), (2, None, None), (3, 0.0, 0.07))],
    )


def test_orders_meet_their_customers_while_narrow(spark, tmp_path):
    small_shop(spark, tmp_path)
    texts = order_texts(spark, str(tmp_path))
    rows = sorted((r.o_orderkey, r.document) for r in texts.collect())
    # Two rows of customer 1 give two documents; a customer whose nation has no region, a null one and an unknown one give none.
    assert [k for k, _ in rows] == [10, 10, 11, 12, 13]
    docs = {k: json.loads(d) for k, d in rows}
    assert docs[10]["customer"]["default_address"]["province"] == "N3"
    assert all("name" not in docs[k]["shipping_address"] for k in (11, 12, 13))
    amounts = {i["id"]: [a["amount"] for a in i["discount_allocations"]] for i in docs[10]["line_items"]}
    assert amounts == {"1": ["1.00", "0.10"], "2": [], "3": ["0.10"]}
    # The lists of lines are joined once, to orders that carry keys only.
    text = plan(texts)
    assert text.index("o_orderkey") < text.index("c_nationkey") and "Calle" not in text[text.index("collect_list"):]
    joins = [line for line in text.splitlines() if "Join" in line and "o_custkey" in line]
    assert joins and all(text.index(j) > text.index("l_orderkey") for j in joins)


def test_places_are_asked_once(spark):
    orders = spark.createDataFrame([("a", "C", "S", "T")], "order_id string, country string, state string, city string")
    calls = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda c: (calls.add(1), c)[1], "string").asNondeterministic()
    known = spark.createDataFrame([("C", "S", "T", "1", "2", "3")], "country_name string, state_name string, city_name string, country_id string, state_id string, city_id string")
    asked = orders.withColumn("country", seen("country"))
    out = resolve_location(asked, known, "country", "state", "city", PartyConfig().defaults)
    assert [(r.country_id, r.state_id, r.city_id) for r in out.collect()] == [("1", "2", "3")]
    assert calls.value <= 2


def test_the_filter_of_anchors_grows_with_them(spark):
    def filtered(n):
        anchors = spark.range(n).select(F.xxhash64("id").alias("__anchor"))
        known = rl._filter_bits(anchors, rl.FILTER_BITS)
        asked = spark.range(4 * n).select("id", F.xxhash64("id").alias("h"), F.size(known).alias("n"))
        wanted = rl._bits(F.col("h"))
        hits = asked.where(F.get(known, F.pmod("h", F.col("n")).cast("int")).bitwiseAND(wanted) == wanted)
        return hits.agg(F.count_if(F.col("id") < n), F.count_if(F.col("id") >= n), F.max("n")).first()

    assert filtered(3)[2] <= 4
    known, others, numbers = filtered(40_000)
    assert known == 40_000 and others < 0.03 * 120_000 and 10_000 <= numbers <= 40_000


def test_a_piece_that_all_texts_hold_is_spread(spark):
    texts = spark.createDataFrame([(i, f"OrderId: v{i % 3} end", "x") for i in range(9)] + [(3, "OrderId: v0 end", "x")], "id long, notes string, more string")
    needles = spark.createDataFrame([("OrderId: v1",), ("OrderId:",), (None,)], "needle string")
    found = rl.contains_join(texts, needles, "notes", "id", "needle")
    assert sorted((r.id, r.needle) for r in found.collect()) == sorted([(i, "OrderId:") for i in range(9)] + [(i, "OrderId: v1") for i in (1, 4, 7)])
    text = plan(found)
    assert any("__salt" in line and "__anchor" in line for line in text.splitlines() if "Join" in line)
    # The filter is part of a condition, not a column that every row carries.
    assert "__bits" not in text and "Filter" in text
