"""Source and sink queries: files written to a shared folder from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.operators import clean, ids
from bazaarlake.operators.listing_html import detail_fields_b, raw_record
from bazaarlake.operators.skew import lookup_join, read_table
from bazaarlake.plans import listings, truth
from bazaarlake.plans.registry import query, shared_folder
from bazaarlake.sinks import documents as document_table
from bazaarlake.sinks import files as file_sinks
from bazaarlake.sources import files, streams


@query(
    """SELECT CASE WHEN event_id % 50 <> 0 THEN event_id END AS event_id,
      CASE WHEN event_id % 50 <> 0 THEN replace(props, ' ', '') END AS props,
      CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type
    FROM events"""
)
def json_value_expand(spark, sf_dir):
    """Broker records decoded and expanded: nested objects become compact JSON text, bad values NULLs."""
    records = read_table(spark, sf_dir, "events").selectExpr(
        "event_type AS topic",
        "cast(cast(event_id as string) as binary) AS key",
        """cast(if(event_id % 50 = 0, '{"event_id": ', concat('{"event_id": ', event_id, ', "props": ', props,
           ', "event_type": "', event_type, '"}')) as binary) AS value""",
    )
    schema = "event_id bigint, props string, event_type string"
    return streams.expand_json(streams.decode(records), schema)


@query(
    """SELECT page_id % 7 AS kind, 'item' AS outcome,
      CASE page_id % 7 WHEN 5 THEN 'phones' ELSE 'seeds' END AS category, url,
      CASE page_id % 7 WHEN 5 THEN CAST(page_id AS VARCHAR) END AS sold, NULL::VARCHAR AS line
    FROM pages WHERE page_id % 7 IN (4, 5, 6)
    UNION ALL SELECT page_id % 7, 'rejected', NULL, NULL, NULL,
      CASE page_id % 7 WHEN 1 THEN '{bad ' || page_id WHEN 2 THEN '[' || page_id || ']'
        ELSE '{"url": ' || page_id || '}' END
    FROM pages WHERE page_id % 7 IN (1, 2, 3)"""
)
def tolerant_ndjson(spark, sf_dir):
    """URL lists with blank, malformed, non-object and url-less lines; rejected lines are returned too."""
    folder = shared_folder(spark, "url-lines")
    pages = read_table(spark, sf_dir, "pages").selectExpr(
        """case page_id % 7 when 0 then '   ' when 1 then concat('{bad ', page_id)
           when 2 then concat('[', page_id, ']') when 3 then concat('{"url": ', page_id, '}')
           when 4 then concat('{"url": " ', url, ' ", "sold": null}')
           when 5 then concat('{"url": "', url, '", "category": "phones", "sold": "', page_id, '"}')
           else concat('  {"category": "", "url": "', url, '"}') end AS value""",
        "page_id % 7 AS kind",
    )
    pages.write.partitionBy("kind").text(folder)
    lines = spark.read.text(folder)
    both = [
        side.withColumn("outcome", F.lit(name))
        for side, name in zip(files.split_url_lines(lines, "seeds", ["kind"]), ("item", "rejected"), strict=True)
    ]
    return (
        both[0]
        .unionByName(both[1].withColumnRenamed("value", "line"), allowMissingColumns=True)
        .withColumn("kind", F.col("kind").cast("bigint"))
    )


@query(
    """SELECT 'tree/kind=' || page_id % 3 AS category, url, CAST(page_id AS VARCHAR) AS sold FROM pages"""
)
def url_tree_scan(spark, sf_dir):
    """A tree of URL files without categories: the folder below the root is the category."""
    folder = shared_folder(spark, "url-tree")
    lines = read_table(spark, sf_dir, "pages").selectExpr(
        """concat('{"url": "', url, '", "sold": "', page_id, '"}') AS value""", "page_id % 3 AS kind"
    )
    lines.write.partitionBy("kind").text(f"{folder}/tree")
    return files.read_url_tree(spark, folder)[0]


@query(
    """SELECT n_name AS cat_1_name, 'https://a.example/' || n_name || '-cat.' || n_nationkey AS cat_1_url,
      'seeds/region=' || r_name AS category
    FROM nation JOIN region ON r_regionkey = n_regionkey"""
)
def category_seed_scan(spark, sf_dir):
    """One pretty-printed JSON array per region folder; the category is the folder below the root."""
    folder = shared_folder(spark, "seeds")
    region = read_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    seeds = lookup_join(read_table(spark, sf_dir, "nation"), region, "n_regionkey", "inner")
    # nation has 25 rows at every scale, so an array of a region's nations stays small.
    arrays = seeds.groupBy(F.col("r_name").alias("region")).agg(
        F.concat_ws(
            ",\n",
            F.collect_list(
                F.expr(
                    """concat('  {"cat_1_name": "', n_name, '",\n   "cat_1_url": "https://a.example/', n_name,
                    '-cat.', n_nationkey, '"}')"""
                )
            ),
        ).alias("body")
    )
    text = arrays.select("region", F.concat(F.lit("[\n"), "body", F.lit("\n]")).alias("value"))
    text.write.partitionBy("region").text(f"{folder}/seeds")
    return files.read_category_seeds(spark, folder)


def _blank_is_null(columns: str) -> str:
    return ", ".join(f"nullif({c}, '') AS {c}" for c in columns.split())


@query(
    f"""WITH {truth.BOTH} SELECT offer_key, avg_rating, num_review, num_sold, price, url, country, brand, stock,
      {_blank_is_null("product_name attrs shipping first_category second_category description")},
      shop_name, shop_like_tier, shop_rating, ship_on_time, shop_reply_percentage, shop_num_follower
    FROM u"""
)
def csv_roundtrip(spark, sf_dir):
    """Both clean tables through CSV: columns bound by name, blank text comes back as NULL."""
    parts = []
    for name, cleaned, schema in (
        ("clean-a", clean.clean_store_a(listings.raw_a(spark, sf_dir)), schemas.CLEAN_A),
        ("clean-b", clean.clean_store_b(listings.raw_b(spark, sf_dir)), schemas.CLEAN_B),
    ):
        folder = shared_folder(spark, name)
        file_sinks.write_csv(cleaned, folder)
        typed = schemas.with_text_column(schema, "offer_key")
        parts.append(files.read_csv(spark, folder, typed))
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return both.select(
        *"""offer_key avg_rating num_review num_sold price url country brand stock product_name attrs
        shipping first_category second_category description shop_name shop_like_tier shop_rating
        ship_on_time shop_reply_percentage shop_num_follower""".split()
    )


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, 'say "' || p_brand || '", or' AS remark
    FROM part"""
)
def csv_text_scan(spark, sf_dir):
    """CSV with header and quotes inside text, all columns read as text."""
    folder = shared_folder(spark, "part-csv")
    part = read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", """concat('say "', p_brand, '", or') AS remark"""
    )
    file_sinks.write_csv(part, folder)
    return files.read_csv(spark, folder)


UPSERTED = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS state,
    o_totalprice FROM orders"""


def _upserted(spark, sf_dir):
    folder = shared_folder(spark, "documents")
    orders = read_table(spark, sf_dir, "orders")
    first = orders.selectExpr("o_orderkey AS id", "'old' AS state", "o_totalprice")
    second = orders.filter("o_orderkey % 3 = 0").selectExpr("o_orderkey AS id", "'new' AS state", "o_totalprice")
    for epoch, batch in ((0, first), (1, second), (1, second)):  # the second batch is replayed
        document_table.upsert(batch, folder, epoch)
    return folder


@query(UPSERTED)
def upsert_sink(spark, sf_dir):
    """Two overlapping batches, the second one written twice, then compacted."""
    target = shared_folder(spark, "compacted")
    document_table.compact(spark, _upserted(spark, sf_dir), target)
    return document_table.documents(spark, target)


@query(f"{UPSERTED} ORDER BY o_orderkey LIMIT 100")
def index_readback(spark, sf_dir):
    """The first 100 documents of a document table."""
    return document_table.read_back(spark, _upserted(spark, sf_dir))


@query(
    "SELECT o_orderkey AS doc, true AS is_above, 1::BIGINT AS n_with_id FROM orders"
)
def increasing_ids(spark, sf_dir):
    """Unique ids above the highest one in use, without a shuffle."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    top = ids.last_id(orders, "o_orderkey").scalar()
    numbered = ids.increasing_ids(orders, top)
    return numbered.select(
        F.col("o_orderkey").alias("doc"),
        (F.col("id") > top).alias("is_above"),
        F.count("*").over(Window.partitionBy("id")).alias("n_with_id"),
    )


@query(
    """WITH d AS (SELECT 'logstash-' || strftime(ts, '%Y.%m.%d') AS index_name, count(*) AS n_rows,
        CAST(ts AS DATE) AS day FROM events GROUP BY ALL)
    SELECT index_name, n_rows, day < CAST((SELECT max(ts) FROM events) AS DATE) - 2 AS is_expired FROM d"""
)
def retention_window(spark, sf_dir):
    """Daily index folders written and listed, with those older than two days marked as expired."""
    folder = shared_folder(spark, "daily")
    events = read_table(spark, sf_dir, "events")
    file_sinks.write_daily_index(events, folder)
    stored = spark.read.schema("event_id bigint, index_name string").json(folder)
    return file_sinks.retention(stored, events.agg(F.max("ts")).scalar())


@query(
    """WITH d AS (SELECT 'logstash-' || strftime(ts, '%Y.%m.%d') AS index_name, count(*) AS n_rows, CAST(ts AS DATE) AS day
      FROM events GROUP BY ALL),
    o AS (SELECT 'audit-' || strftime(ts, '%Y.%m.%d') AS index_name, count(*) AS n_rows FROM events WHERE event_id % 10 = 0 GROUP BY ALL),
    last AS (SELECT CAST(max(ts) AS DATE) AS day FROM events)
    SELECT 'left' AS state, index_name, n_rows FROM d, last WHERE d.day >= last.day - 2
    UNION ALL SELECT 'dropped', index_name, n_rows FROM d, last WHERE d.day < last.day - 2
    UNION ALL SELECT 'left', index_name, n_rows FROM o"""
)
def retention_applied(spark, sf_dir):
    """What a retention run drops, and what is on disk after a second run; indices with another prefix stay."""
    folder = shared_folder(spark, "daily-table")
    events = read_table(spark, sf_dir, "events")
    file_sinks.write_daily_table(events, folder)
    file_sinks.write_daily_table(events.filter("event_id % 10 = 0"), folder, prefix="audit-")
    as_of = F.lit(events.agg(F.max("ts").alias("t")).first().t)
    first = file_sinks.apply_retention(spark, folder, events.schema, as_of)
    again = file_sinks.apply_retention(spark, folder, events.schema, as_of)
    left = file_sinks.daily_counts(spark, folder, events.schema).withColumn("state", F.lit("left"))
    dropped = first.union(again).filter("is_expired").select("index_name", "n_rows", F.lit("dropped").alias("state"))
    return left.unionByName(dropped).select("state", "index_name", "n_rows")


@query(
    f"""WITH {truth.LINES} SELECT p_name AS product_name, l_extendedprice AS price, offer_key,
      (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY p_name, l_extendedprice DESC, offer_key) AS id
    FROM o"""
)
def ordered_document_ids(spark, sf_dir):
    """Dense ids above the highest one in use, in the order of repeated names, falling prices and keys."""
    lines = listings.order_lines(spark, sf_dir).select(
        F.col("p_name").alias("product_name"), F.col("l_extendedprice").alias("price"), "offer_key"
    )
    top = ids.last_id(read_table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").scalar()
    order = [F.col("product_name").asc(), F.col("price").desc(), F.col("offer_key").asc()]
    return ids.ordered_ids(lines, order, top, shared_folder(spark, "ordered"))


@query(
    """SELECT 'https://b.example/' || p_partkey AS url, p_name AS product_name, p_type AS category,
      CAST(p_size AS VARCHAR) AS sold FROM part UNION ALL
    SELECT 'https://b.example/' || p_partkey, p_name, p_type, CAST(p_size AS VARCHAR) FROM part"""
)
def append_products(spark, sf_dir):
    """Products appended to the same NDJSON folder twice."""
    folder = shared_folder(spark, "products")
    products = read_table(spark, sf_dir, "part").selectExpr(
        "concat('https://b.example/', p_partkey) AS url",
        "p_name AS product_name",
        "p_type AS category",
        "cast(p_size as string) AS sold",
    )
    file_sinks.append_ndjson(products, folder)
    file_sinks.append_ndjson(products, folder)
    return spark.read.schema(products.schema).json(folder)


@query(
    f"""WITH {truth.LINES}, {truth.CLEAN_A} SELECT *, 10 AS n_fields FROM a"""
)
def raw_record_assembly(spark, sf_dir):
    """Raw listing records as JSON text with all ten fields, parsed and cleaned again."""
    raw = listings.raw_a(spark, sf_dir)
    records = raw.select("offer_key", raw_record(raw, "a").alias("value"))
    parsed = records.select(
        "offer_key",
        F.size(F.json_object_keys("value")).alias("n_fields"),
        F.from_json("value", schemas.RAW_A).alias("r"),
    ).select("offer_key", "n_fields", "r.*")
    return clean.clean_store_a(parsed)


@query(f"WITH {truth.LINES}, {truth.CLEAN_B} SELECT * FROM b")
def detail_page_record_b(spark, sf_dir):
    """Store-B detail pages to raw records as JSON text, parsed and cleaned."""
    pages = detail_fields_b(listings.detail_pages_b(spark, sf_dir), listings.DETAIL_CLASSES)
    records = pages.select("offer_key", raw_record(pages, "b").alias("value"))
    parsed = records.select("offer_key", F.from_json("value", schemas.RAW_B).alias("r")).select("offer_key", "r.*")
    return clean.clean_store_b(parsed)


@query(
    """SELECT p_partkey, p_name || ' of ' || p_brand AS product_name, '₫' || p_size AS price,
      CASE WHEN p_partkey % 4 <> 0 THEN (p_size % 5) || '.5' END AS avg_rating, p_brand AS brand_name,
      (p_partkey % 7) || ' <votes>' AS num_review, 'shop box ' || p_size AS shop_info, 'box ' || p_size || '/' || p_type AS category,
      2::INTEGER AS n_attrs, 'c' || p_size AS colour, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS size,
      '<div>' || p_type || '<br><div>deep</div></div>' AS product_desc
    FROM part"""
)
def detail_page_nested_b(spark, sf_dir):
    """Fields of detail pages whose elements hold others of their own tag."""
    pages = detail_fields_b(listings.nested_pages_b(spark, sf_dir), listings.NESTED_CLASSES)
    return pages.select(
        "p_partkey", "product_name", "price", "avg_rating", "brand_name", "num_review", "shop_info", "category",
        F.size("attrs").alias("n_attrs"), F.col("attrs")["Colour"].alias("colour"), F.col("attrs")["Size"].alias("size"), "product_desc",
    )
