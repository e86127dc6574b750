"""DataFrame operators: results on small rows, plans, and the balanced path for hot keys."""

import json

import pytest
from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.operators import catalogue, clean, conform, dedupe, ids, listing_html, product_page, reviews, skew
from bazaarlake.plans import catalogue as catalogue_of_queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def skewed(spark):
    """9000 rows, a third of them on key 7, many of them copies."""
    return spark.range(9000, numPartitions=6).selectExpr("if(id % 3 = 0, 7, id % 500) AS k", "id % 5 AS v")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_lookup_equals_plain_join(spark, skewed, no_broadcast, how):
    lookup = spark.range(0, 400).selectExpr("id AS k", "id * 10 AS w")
    salted = skew.lookup_join(skewed, lookup, "k", how, salts=4)
    assert "_salt" in plan_of(salted)
    assert tuples(salted) == tuples(skewed.join(lookup, "k", how))


def test_salting_spreads_the_hot_key(spark, skewed, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.lookup_join(skewed, spark.range(500).selectExpr("id AS k", "id AS w"), "k", salts=4)
        sizes = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1


@pytest.mark.parametrize("name", ["best_offer", "enrich_by_url", "model_table", "skip_processed", "review_counts"])
def test_building_a_plan_starts_no_job(spark, sf_dir, no_broadcast, name):
    spark.sparkContext.setJobGroup(f"build {name}", "")
    try:
        catalogue_of_queries.QUERIES[name](spark, sf_dir)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Reading a Parquet footer is a job of one task.
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build {name}")]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    assert all(s.numTasks == 1 and "parquet" in s.name for s in stages if s)


def test_lookup_join_refuses_different_key_types(spark, skewed):
    with pytest.raises(TypeError):
        skew.lookup_join(skewed, spark.range(9).selectExpr("cast(id AS int) AS k"), "k")


def test_composite_keys_and_null_keys(spark, no_broadcast):
    left = spark.sql("select * from values (1L,'a'),(1L,null),(null,'a'),(1L,'a') t(k, s)")
    lookup = spark.sql("select 1L k, 'a' s, 5 w")
    assert tuples(skew.lookup_join(left, lookup, ["k", "s"])) == tuples(left.join(lookup, ["k", "s"], "left"))


def test_best_offer_ties_and_nulls(spark):
    rows = spark.sql(
        """select * from values ('a', 5L, 'y'), ('a', 5L, 'x'), ('a', 1L, 'w'), ('b', null, 'q'), ('b', null, 'p')
        t(product_name, price, shop)"""
    )
    assert tuples(dedupe.best_offer(rows)) == [("a", 5, "x"), ("b", None, "p")]
    again = dedupe.best_offer(dedupe.best_offer(rows))
    assert tuples(again) == tuples(dedupe.best_offer(rows))


def test_best_offer_limits_groups_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("string(id % 2) AS product_name", "id AS price")
    plan = plan_of(dedupe.best_offer(rows))
    assert plan.count("WindowGroupLimit") == 2


def test_rows_that_may_be_best_give_the_same_best_offers(spark):
    offers = spark.range(3000).selectExpr(
        "if(id % 11 = 0, null, concat('p', id % 40)) AS product_name", "if(id % 7 = 0 OR id % 40 = 5, null, id * 37 % 50021) AS price", "concat('k', id % 900) AS shop"
    )
    left = dedupe.may_be_best(offers, offers)
    assert left.columns == offers.columns and left.count() < 200
    assert tuples(dedupe.best_offer(left)) == tuples(dedupe.best_offer(offers))
    assert dedupe.may_be_best(offers, offers.filter("false")).count() == 0


def test_offers_are_dropped_before_their_texts_are_made_and_ranked(spark, sf_dir):
    for name in ("dashboard_table", "model_table"):
        plan = catalogue_of_queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan[plan.index("WindowGroupLimit") :].split("Join Inner, ((getbit(", 1)
        assert "Aggregate" not in above and "bitmap_construct_agg" in below
        # The key is made once for each row: no filter makes it again.
        assert "isnotnull(coalesce" not in below and "isnotnull(static_invoke" not in below


def test_fill_with_mean(spark):
    rows = spark.sql(
        "select * from values (1, cast(null as double), 3.0D), (3, null, null), (null, null, 5.0D) "
        "t(num_sold, shop_rating, avg_rating)"
    )
    filled = conform.fill_with_mean(rows)
    assert [f.dataType.simpleString() for f in filled.schema.fields] == ["double"] * 3
    assert tuples(filled) == [(1.0, None, 3.0), (2.0, None, 5.0), (3.0, None, 4.0)]
    assert filled.agg(F.avg("num_sold")).first()[0] == 2.0


def test_fill_with_mean_has_no_window_and_does_not_shuffle_rows(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").withColumnRenamed("p_size", "num_sold")
    main = plan_of(conform.fill_with_mean(parts)).split("Subquery")[0]
    assert "Exchange" not in main and "Window" not in main and "CartesianProduct" not in main


def test_fill_and_validate(spark):
    rows = spark.sql(
        """select * from values
        (1L, 'a', 's', 'd', '  ', null, null), (null, 'a', 's', 'd', 'x', 'f', 'z'), (1L, '', 's', 'd', 'x', 'f', 'z'),
        (1L, 'b', null, 'd', 'x', 'f', 'z'), (1L, 'c', 's', null, 'x', 'f', 'z')
        t(price, product_name, shop_name, description, brand, first_category, country)"""
    )
    kept = conform.valid_listings(rows)
    assert kept.count() == 1
    filled = conform.fill_with_no_info(conform.fill_with_blank(kept, ["country"]), ["first_category"]).first()
    assert (filled.brand, filled.first_category, filled.country) == ("no info", "no info", "")


def test_to_schema_makes_bad_values_null(spark):
    large = conform.to_schema(spark.sql("select '3000000000' price"), schemas.INDEX_DOCUMENT).first()
    assert large.price == 3_000_000_000
    row = conform.to_schema(
        spark.sql("select 'x' price, '2' shop_like_tier, '1.5' avg_rating"), schemas.INDEX_DOCUMENT
    ).first()
    assert (row.price, row.shop_like_tier, row.avg_rating, row.brand) == (None, 2, 1.5, None)
    assert len(row) == 24


def test_align_stores_keeps_all_rows_and_columns(spark):
    a, b = spark.createDataFrame([], schemas.CLEAN_A), spark.createDataFrame([], schemas.CLEAN_B)
    assert set(conform.align_stores(a, b).columns) == set(a.columns) | set(b.columns)


def test_clean_of_null_listing(spark):
    empty = spark.createDataFrame([(None,) * 10], schemas.RAW_A)
    row = clean.clean_store_a(empty).first().asDict()
    assert row["second_category"] == "no info" and row["shop_like_tier"] == "0"
    assert row["shop_creation_time"] == 0 and row["price"] is None
    assert clean.clean_store_a(empty).schema.simpleString() != ""
    assert {f.name: f.dataType for f in clean.clean_store_a(empty).schema} == {
        f.name: f.dataType for f in schemas.CLEAN_A
    }
    both = clean.clean_store_b(spark.createDataFrame([(None,) * 10], schemas.RAW_B))
    assert {f.name: f.dataType for f in both.schema} == {f.name: f.dataType for f in schemas.CLEAN_B}


@pytest.mark.parametrize("n", [1, 7, 3000])
def test_dense_ids_have_no_gaps_and_follow_the_key(spark, n):
    keys = spark.range(n, numPartitions=5).selectExpr("id * id AS k")
    got = ids.dense_ids(keys, "k", F.lit(100)).orderBy("k").collect()
    assert [r.id for r in got] == list(range(101, 101 + n))


def page(**fields):
    return json.dumps({"data": {"root": {"fields": fields}}})


PAGE = page(
    product={"title": "", "highlights": "  ", "desc": "<p>x</p>"},
    seller={"name": "S", "sellerId": 5},
    review={"averageRating": 4.5, "reviews": 10, "contentedNum": 3},
    skuInfos={
        "0": {"skuId": "A-12", "price": {"salePrice": {"text": "₫1"}}, "quantity": {"limit": {"max": 3}}},
        "1": {"skuId": 34, "price": {"salePrice": {"text": ""}, "text": "₫2"}, "stock": "x", "inventory": "9"},
        "2": {"skuId": "  "},
        "3": {"skuId": "56"},
    },
    productOption={
        "skuBase": {
            "properties": [{"pid": "1", "values": [{"vid": "5", "name": "Xanh"}, {"vid": "6", "name": ""}]}],
            "skus": [
                {"skuId": "12", "propPath": "1:5; 2:L;"},
                {"skuId": "x12", "propPath": "9:9"},
                {"skuId": "34", "propPath": "1:6"},
                {"skuId": "34", "skuPropPath": "plain"},
            ],
        }
    },
    specifications={"A-12": {"m": "c"}},
)


def test_product_page(spark):
    pages = spark.createDataFrame([("u/p-i1", PAGE), ("bad", "{"), ("empty", page())], "url string, state string")
    rows = {r.url: r for r in product_page.flatten_products(pages).collect()}
    good = rows["u/p-i1"]
    assert good.product_name == "Unknown title" and good.default_sku_id == "A-12"
    assert good.highlights_text is None and good.description_text_or_html == "<p>x</p>"
    assert good.specifications_default == {"m": "c"} and good.specifications_by_sku is None
    assert [(v.sku_id, v.variant, v.price) for v in good.variants] == [
        ("56", "Mặc định", "---"),
        ("A-12", "Xanh - L", "₫1"),
        ("34", "plain", "₫2"),
    ]
    assert (good.seller_info.name, good.seller_info.sellerId, good.total_variants) == ("S", "5", 3)
    assert rows["bad"].variants == [] and rows["empty"].total_variants == 0
    stocks = {r.sku_id: r.stock for r in product_page.variant_rows(pages).collect()}
    assert stocks == {"A-12": 3, "34": 9, "56": 0}


def test_sales_share(spark, no_broadcast):
    pages = spark.createDataFrame([("u/p-i1", PAGE), ("u/p-i2", PAGE), ("e/p-i1", page())], "url string, state string")
    texts = spark.createDataFrame(
        [("1", "Màu:Xanh, Size:L")] * 2 + [("1", "L - Xanh"), ("1", "Plain"), ("1", "other"), ("2", "zzz")],
        "item_id string, option_text string",
    )
    counts = reviews.sum_by_match_key(reviews.count_option_texts(texts))
    products = product_page.flatten_products(pages)
    rows = {r.url: r for r in reviews.with_sales_share(products, counts).collect()}
    shares = {v.variant: (v.sold_sample, v.sold_ratio) for v in rows["u/p-i1"].variants}
    assert shares == {"Mặc định": (0, 0.0), "Xanh - L": (3, 75.0), "plain": (1, 25.0)}
    assert rows["u/p-i1"].review_sample_size == 4 and rows["u/p-i2"].review_sample_size == 0
    assert rows["e/p-i1"].variants == []


def test_catalogue(spark):
    items = spark.sql("select * from values ('u', 'b', '1'), ('u', 'a', '2'), ('w', 'c', null) t(url, category, sold)")
    products = spark.sql("select * from values ('u', 1), ('x', 2) t(url, n)")
    assert tuples(catalogue.enrich_by_url(products, items)) == [("u", 1, "a", "2"), ("x", 2, None, None)]
    assert tuples(catalogue.not_processed(products, items, "url")) == [("x", 2)]
    offered = spark.sql("select 1 id, array('a','b') x, cast(array() as array<int>) y")
    assert tuples(catalogue.option_combinations(offered, ["x", "y"])) == [(1, "a", None), (1, "b", None)]
    gaps = spark.sql("select * from values ('u', null, '9'), ('u', 'shoes', '3'), ('u', 'hats', null) t(url, category, sold)")
    assert tuples(catalogue.one_item_per_url(gaps)) == [("u", "shoes", "3")]
    words = spark.sql("select ' a  b\ta ' text union all select null")
    assert tuples(catalogue.word_count(words)) == [("a", 2), ("b", 1)]


def test_listing_html(spark):
    pages = spark.createDataFrame(
        [(1, "c", '<a href="//h/x">1</a><a href="/y">2</a>'), (2, "c", "none")],
        "id int, category string, html string",
    )
    assert tuples(listing_html.product_links(pages, host="k")) == [
        (1, "c", "https://h/x"),
        (1, "c", "https://k/y"),
    ]
    mixed = """<a class="x>y" href='/1?a=1&amp;b=2'>1</a><A id=i\nHREF = "/2">2</A><a href=/3>3</a><abbr href="/4">no</abbr><a name="n">no</a>"""
    one = spark.createDataFrame([(mixed, "c")], "html string, category string")
    assert sorted(r.url for r in listing_html.product_links(one, host="k").collect()) == [
        "https://k/1?a=1&b=2", "https://k/2", "https://k/3",
    ]
    html = F.lit("<titles>no</titles><Title a='b'>T</title><p class='big price now'>5 <b>x</b></p><p class=\"prices\">no</p>")
    row = spark.range(1).select(
        listing_html.element_text(html, "title"), listing_html.text_by_class(html, "price"), listing_html.text_by_class(html, "none")
    ).first()
    assert tuple(row) == ("T", "5 <b>x</b>", None)
    elements = "array<struct<name:string,value:string>>"
    one = spark.createDataFrame([([("a", "1"), ("b", None), ("a", "2")],)], f"e {elements}")
    assert one.select(listing_html.attribute_map(F.col("e"))).first()[0] == {"a": "2", "b": None}
    named = spark.sql("select 'n' product_name")
    record = named.select(listing_html.raw_record(named, "b"))
    assert list(json.loads(record.first()[0])) == schemas.RAW_B.fieldNames()


def test_text_cleaning_stays_in_the_jvm(spark):
    raw = spark.createDataFrame([], schemas.RAW_A)
    assert "Python" not in plan_of(clean.clean_store_a(raw))


def test_valid_listings_parse_no_description(spark, sf_dir):
    from bazaarlake.plans import tables

    found = tables.valid_listings(spark, sf_dir)
    assert "<flex" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = conform.valid_listings(tables.both_stores(spark, sf_dir)).select(found.columns)
    assert found.count() > 0 and found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_text_rules_stay_out_of_fused_methods(spark):
    """The JVM compiles methods of up to 8000 bytes only, and a fused stage is one method."""
    from bazaarlake import schemas
    from bazaarlake.operators import clean

    for rows, cleaner in ((schemas.RAW_A, clean.clean_store_a), (schemas.RAW_B, clean.clean_store_b)):
        raw = spark.createDataFrame([], rows)
        frame = cleaner(raw.unionByName(raw).repartition(2))
        # Adaptive plans fuse when they run, so the plan is asked without them.
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        ruled = [line for line in plan if "regexp_replace" in line and "Project" in line]
        assert ruled and not [line for line in ruled if line.lstrip(" :+-").startswith("*")]


def test_free_text_equals_the_words_behind_the_marker_of_the_normalised_text(spark):
    import random

    from bazaarlake.functions import fields, text
    from bazaarlake.vocabulary import STORE_A

    draw = random.Random(7)
    bits = ["mô", "tả", "sản", "phẩm", " ", "  ", "/", "-\n", " ", "#", "é", "ñ", "x", "mô tả sản phẩm", "mô/tả sản\nphẩm", "mô  tả"]
    rows = [(i, "".join(draw.choices(bits, k=draw.randint(0, 9)))) for i in range(3000)] + [(3000, None)]
    df = spark.createDataFrame(rows, "i int, t string")
    whole = text.squeeze(F.regexp_extract(text.letters_only(F.col("t")), f"{STORE_A.description}(.*)", 1))
    assert df.filter(whole != "").count() > 100
    assert df.filter(~fields.free_text(F.col("t")).eqNullSafe(whole)).collect() == []


def test_price_without_points_needs_no_decimal_rule(spark):
    from bazaarlake.functions import text

    shown = ["₫1.000 - ₫2.500", "₫7", "9.9.", ".", "", "Liên hệ", " 5 ", "₫1\n₫2", "a₫\n3", None]
    df = spark.createDataFrame([(s,) for s in shown], "s string")
    old = F.regexp_replace(F.replace(F.regexp_replace("s", ".*₫", ""), F.lit("."), F.lit("")), r"\.[0-9]*$", "").try_cast("bigint")
    assert df.filter(~text.price_a(F.col("s")).eqNullSafe(old)).collect() == []


def test_may_match_keeps_all_matches_and_repeats_and_drops_most_others(spark):
    pages = spark.range(20_000).selectExpr("if(id % 100 = 7, null, concat('u', id % 10000)) AS url", "id AS state")
    keys = spark.range(60).selectExpr("if(id % 6 = 0, null, concat('u', id * 50)) AS url").unionByName(spark.createDataFrame([("u1",), ("u1",)], "url string"))
    for slots in (1 << 26, 1 << 16, 8):
        left = skew.may_match(pages, keys, "url", slots)
        assert left.columns == pages.columns
        want = sorted(tuple(r) for r in pages.join(keys.distinct(), "url", "left_semi").collect())
        assert sorted(tuple(r) for r in left.join(keys.distinct(), "url", "left_semi").collect()) == want and len(want) > 90
        assert slots == 8 or left.count() < len(want) + 100
    assert skew.may_match(pages, keys.filter("false"), "url").count() == 0


def test_products_for_urls_are_written_compressed(spark, tmp_path):
    from pathlib import Path

    from bazaarlake.streaming import jobs

    lines = [("url", bytearray(b"k"), bytearray(('{"url": "u%d", "category": "c"}' % i).encode())) for i in range(5)]
    spark.createDataFrame(lines, schemas.ENVELOPE).write.parquet(str(tmp_path / "records"))
    records = spark.readStream.schema(schemas.ENVELOPE).parquet(str(tmp_path / "records"))
    pages = spark.createDataFrame([(f"u{i}", '{"data": {"root": {"fields": {"product": {"title": "t"}}}}}') for i in (1, 3, 9)], "url string, state string")
    jobs.products_for_urls(records, pages, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    found = spark.read.schema("url string, category string, product_name string").json(str(tmp_path / "out")).drop("epoch")
    assert sorted(map(tuple, found.collect())) == [("u1", "c", "t"), ("u3", "c", "t")]
    files = [f.name for f in Path(tmp_path / "out").rglob("part-*")]
    assert files and all(f.endswith(".json.gz") for f in files)
