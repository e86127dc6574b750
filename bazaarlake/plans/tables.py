"""Union, gap filling, validation, dedupe, catalogue and id queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.functions import keys, numbers
from bazaarlake.operators import catalogue, clean, conform, dedupe, ids, listing_html
from bazaarlake.operators.skew import read_table, spread_scan
from bazaarlake.plans import listings, truth
from bazaarlake.plans.registry import query, shared_folder
from bazaarlake.sinks.seen_keys import SeenKeys


def both_stores(spark, sf_dir):
    """Clean listings of both stores in one table."""
    return conform.align_stores(
        clean.clean_store_a(listings.raw_a(spark, sf_dir)),
        clean.clean_store_b(listings.raw_b(spark, sf_dir)),
    )


def rounded_means(df):
    """Mean-filled columns rounded, because a mean's last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in schemas.MEAN_FILLED})


def model_rows(spark, sf_dir):
    """Imputed, validated and filled listings with text features, one offer per product.

    Means are those of all listings. Name and price decide before any other text is parsed.
    """
    named_a, named_b = clean.name_and_price_a(listings.raw_a(spark, sf_dir)), clean.name_and_price_b(listings.raw_b(spark, sf_dir))
    # heads_of_both drops missing names and prices; a filter on them here would make both once more for each row.
    whole = [n.filter("shop_info IS NOT NULL AND product_desc IS NOT NULL").select("product_name", "price") for n in (named_a, named_b)]
    offers = whole[0].unionByName(whole[1])
    best_a = listings.raw_a(spark, sf_dir, lambda named: dedupe.may_be_best(clean.name_and_price_a(named), offers))
    best_b = listings.raw_b(spark, sf_dir, lambda named: dedupe.may_be_best(clean.name_and_price_b(named), offers))
    kept = clean.details_of_both(dedupe.best_offer(clean.heads_of_both(best_a, best_b), tiebreak=["offer_key"]))
    best = conform.fill_with_mean(kept, of=both_stores(spark, sf_dir))
    # Texts are joined for the offers that are kept, so that the shuffle carries each text once.
    best = conform.add_text_features(conform.fill_with_no_info(conform.fill_with_blank(best)))
    return best.drop(*schemas.MODEL_DROPPED)


@query(f"WITH {truth.BOTH} SELECT * FROM u")
def align_stores_union(spark, sf_dir):
    return both_stores(spark, sf_dir)


@query(f"WITH {truth.IMPUTED} SELECT offer_key, {', '.join(truth.MEAN_COLUMNS)} FROM i")
def impute_means(spark, sf_dir):
    filled = rounded_means(conform.fill_with_mean(both_stores(spark, sf_dir)))
    return filled.select("offer_key", *schemas.MEAN_FILLED)


@query(
    f"""WITH {truth.BOTH} SELECT offer_key, coalesce(shipping, '') AS shipping,
      coalesce(country, '') AS country, coalesce(origin, '') AS origin,
      CASE WHEN trim(coalesce(brand, '')) = '' THEN 'no info' ELSE brand END AS brand,
      {", ".join(f"coalesce({c}, 'no info') AS {c}" for c in schemas.NO_INFO_FILLED)},
      coalesce(num_sold, 0) AS num_sold, coalesce(ship_on_time, 0) AS ship_on_time
    FROM u"""
)
def fill_defaults(spark, sf_dir):
    df = conform.fill_with_no_info(conform.fill_with_blank(both_stores(spark, sf_dir)))
    return conform.fill_with_zero(df, ["num_sold", "ship_on_time"]).select(
        "offer_key", *schemas.BLANK_FILLED, "brand", *schemas.NO_INFO_FILLED, "num_sold", "ship_on_time"
    )


@query(f"WITH {truth.BOTH} SELECT offer_key, product_name, price, shop_name FROM u WHERE {truth.VALID}")
def valid_listings(spark, sf_dir):
    """Whether a description is there is told by the text that it is cut from, so none is parsed."""
    heads = clean.heads_of_both(listings.raw_a(spark, sf_dir), listings.raw_b(spark, sf_dir))
    return clean.shops_of_both(heads).select("offer_key", "product_name", "price", "shop_name")


TEXT_FEATURES = """concat_ws(' ', product_name, description) AS name_description,
    concat_ws(' ', product_name, description, shipping, country) AS augmented_description"""


@query(f"WITH {truth.BOTH} SELECT offer_key, {TEXT_FEATURES} FROM u")
def text_features_concat(spark, sf_dir):
    featured = conform.add_text_features(both_stores(spark, sf_dir))
    return featured.select("offer_key", "name_description", "augmented_description")


@query(
    f"""WITH {truth.IMPUTED}, v AS (SELECT * FROM i WHERE {truth.VALID}),
    f AS (SELECT * REPLACE (
        {", ".join(f"coalesce({c}, '') AS {c}" for c in schemas.BLANK_FILLED)},
        CASE WHEN trim(coalesce(brand, '')) = '' THEN 'no info' ELSE brand END AS brand,
        {", ".join(f"coalesce({c}, 'no info') AS {c}" for c in schemas.NO_INFO_FILLED)}) FROM v),
    t AS (SELECT *, {TEXT_FEATURES} FROM f)
    SELECT * EXCLUDE ({", ".join(schemas.MODEL_DROPPED)}) FROM t {truth.BEST}"""
)
def model_table(spark, sf_dir):
    return rounded_means(model_rows(spark, sf_dir))


@query(
    f"""WITH {truth.LINES}, {truth.CLEAN_A}
    SELECT * REPLACE (shop_like_tier::INTEGER AS shop_like_tier) FROM a
    {truth.BEST}"""
)
def dashboard_table(spark, sf_dir):
    """One document per product; descriptions are parsed only for the offers that are kept."""
    named = clean.name_and_price_a(listings.raw_a(spark, sf_dir))
    best = listings.raw_a(spark, sf_dir, lambda rows: dedupe.may_be_best(clean.name_and_price_a(rows), named))
    details = clean.details_a(dedupe.best_offer(clean.name_and_price_a(best), tiebreak=["offer_key"]))
    typed = conform.to_schema(details, schemas.with_text_column(schemas.INDEX_DOCUMENT, "offer_key"))
    return typed.drop("id")


@query(
    """SELECT l_orderkey AS id, l_linenumber AS num_sold,
      CASE WHEN l_linenumber % 2 = 0 THEN 3000000000 + l_partkey END::BIGINT AS price, l_quantity AS avg_rating,
      l_returnflag AS shop_name, NULL::INTEGER AS shop_like_tier, NULL::VARCHAR AS brand
    FROM lineitem"""
)
def conform_target_schema(spark, sf_dir):
    """Text columns onto index types: numbers parsed, unusable and missing ones NULL."""
    lines = read_table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) AS id",
        "cast(l_linenumber as string) AS num_sold",
        "if(l_linenumber % 2 = 0, cast(3000000000 + l_partkey as string), 'Liên hệ') AS price",
        "cast(l_quantity as string) AS avg_rating",
        "l_returnflag AS shop_name",
        "'none' AS shop_like_tier",
    )
    return conform.to_schema(lines, schemas.INDEX_DOCUMENT).select(
        "id", "num_sold", "price", "avg_rating", "shop_name", "shop_like_tier", "brand"
    )


@query(
    """WITH i AS (SELECT 'https://a.example/p-i' || l_partkey || '.' || l_suppkey AS url,
        min(p_type || '/' || p_brand) AS category, min(CAST(p_size AS VARCHAR)) AS sold
      FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'N' GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice,
      'https://a.example/p-i' || l_partkey || '.' || l_suppkey AS url,
      CAST(l_partkey AS VARCHAR) AS item_id, category, sold
    FROM lineitem l LEFT JOIN i ON i.url = 'https://a.example/p-i' || l_partkey || '.' || l_suppkey"""
)
def enrich_by_url(spark, sf_dir):
    """Listings with category and sold count of the URL list, which holds repeated URLs."""
    lines = listings.order_lines(spark, sf_dir).withColumn(
        "url", F.expr("concat('https://a.example/p-i', l_partkey, '.', l_suppkey)")
    )
    items = lines.filter("l_returnflag = 'N'").selectExpr(
        "url", "concat_ws('/', p_type, p_brand) AS category", "cast(p_size as string) AS sold"
    )
    products = lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "url", keys.item_id(F.col("url")).alias("item_id")
    )
    return catalogue.enrich_by_url(products, items)


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_processed(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return catalogue.not_processed(docs, read_table(spark, sf_dir, "labels"), "doc_id")


@query(
    """SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END::INTEGER AS batch
    FROM documents"""
)
def skip_processed_batches(spark, sf_dir):
    """Documents that come in three overlapping batches, each processed once: even ids, multiples of three, then all."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    seen, path = SeenKeys(spark, shared_folder(spark, "seen"), slots=1 << 24, fanout=2), shared_folder(spark, "processed")
    for batch, coming in enumerate(("doc_id % 2 = 0", "doc_id % 3 = 0", "true")):
        seen.missing(docs.filter(coming), "doc_id").write.parquet(f"{path}/batch={batch}")
        seen.add(spark.read.parquet(f"{path}/batch={batch}"), "doc_id", batch)
        seen.compact()
    return spark.read.parquet(path)


@query(
    """SELECT lang AS category, count(*) AS n_products, count(CASE WHEN n_chars > 500 THEN 1 END) AS n_with_url,
      count(*) = count(CASE WHEN n_chars > 500 THEN 1 END) AS is_complete
    FROM documents GROUP BY lang"""
)
def category_completeness(spark, sf_dir):
    """Products with and without a URL per category."""
    found = read_table(spark, sf_dir, "documents").selectExpr(
        "lang AS category", "if(n_chars > 500, concat('https://a.example/', doc_id), null) AS url"
    )
    return catalogue.category_completeness(found)


@query(
    """SELECT source, doc_id, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5"""
)
def top_pages_per_category(spark, sf_dir):
    """The first five pages of every category."""
    docs = read_table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return dedupe.first_per_group(docs, "source", ["doc_id"], 5)


@query(
    """SELECT p_partkey, CAST(unnest([p_size, p_size + 1, p_size + 2]) AS INTEGER) AS size, flag,
      p_type AS kind, 2::INTEGER AS n_attrs, true AS has_null
    FROM part CROSS JOIN (VALUES ('A'), ('N')) AS flags(flag)"""
)
def option_combinations(spark, sf_dir):
    """Every size and flag of a listing, with its attribute map (repeated names, missing values)."""
    offered = read_table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "array(p_size, p_size + 1, p_size + 2) AS size",
        "array('A', 'N') AS flag",
        """array(struct('Kind' AS name, p_brand AS value), struct('Colour' AS name, null AS value),
           struct('Kind' AS name, p_type AS value)) AS elements""",
    )
    attrs = offered.withColumn("attrs", listing_html.attribute_map(F.col("elements"))).drop("elements")
    return catalogue.option_combinations(attrs, ["size", "flag"]).select(
        "p_partkey",
        "size",
        "flag",
        F.col("attrs")["Kind"].alias("kind"),
        F.size("attrs").alias("n_attrs"),
        (F.map_contains_key("attrs", "Colour") & F.col("attrs")["Colour"].isNull()).alias("has_null"),
    )


@query(
    """SELECT o_orderkey, (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')
      + row_number() OVER (ORDER BY o_orderkey) AS id,
      (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F') AS top_id
    FROM orders WHERE o_orderstatus <> 'F'"""
)
def sink_next_id(spark, sf_dir):
    """Orders that are not in the table yet get the ids after the highest one in use."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stored = orders.filter("o_orderstatus = 'F'").withColumn("id", F.col("o_orderkey"))
    fresh = orders.filter("o_orderstatus != 'F'").drop("o_orderstatus")
    numbered = ids.dense_ids(fresh, "o_orderkey", ids.last_id(stored).scalar())
    return numbered.withColumn("top_id", ids.top_document(stored).select("id").scalar())


@query(
    """SELECT event_id,
      strftime(ts, '%m%Y') || '_' || (day(ts) // 7 + 1) AS raw_week, strftime(ts, '%d%m%Y') AS day_key,
      'logstash-' || strftime(ts, '%Y.%m.%d') AS index_name
    FROM events"""
)
def week_day_partitions(spark, sf_dir):
    ts = F.col("ts")
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        keys.raw_week(ts).alias("raw_week"),
        keys.day_key(ts).alias("day_key"),
        keys.daily_index(ts).alias("index_name"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, log10(l_extendedprice) AS log_price,
      round(l_extendedprice, 2) AS price, log10(l_extendedprice) AS log_base10,
      round(100.0 * l_quantity / 50, 1) AS share
    FROM lineitem"""
)
def price_logs(spark, sf_dir):
    """log10 of the price, back again, and a share in percent."""
    lines = spread_scan(read_table(spark, sf_dir, "lineitem"))
    price = F.col("l_extendedprice")
    log = numbers.log_price(price)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_partkey",
        log.alias("log_price"),
        F.round(numbers.unlog_price(log), 2).alias("price"),
        numbers.log_base10(price).alias("log_base10"),
        numbers.share_percent(F.col("l_quantity"), F.lit(50)).alias("share"),
    )
