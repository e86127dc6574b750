"""Raw listings to typed listings. The same transforms serve batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake import vocabulary as V
from bazaarlake.functions import fields, numbers, text


def name_and_price_a(raw: DataFrame) -> DataFrame:
    """The two columns that decide which offer of a product is kept."""
    return raw.withColumns(
        {"product_name": text.name_a(F.col("product_name")), "price": text.price_a(F.col("price"))}
    )


def details_a(df: DataFrame, labels: V.StoreALabels = V.STORE_A) -> DataFrame:
    """Every other store-A column; extra columns pass through."""
    shop = F.col("shop_info")
    # Text that several columns read is its own column, so that it is cut out once.
    reduced = df.withColumns(
        {
            "_desc": text.markup_a(F.col("product_desc")),
            "_reviews": fields.line_after(shop, labels.reviews),
            "_followers": fields.last_line_after(shop, labels.followers),
            "_joined": text.unfused(fields.line_after(shop, labels.joined)),
        }
    )
    parsed = reduced.withColumns(
        {
            "_header": fields.header_text(F.col("_desc"), labels),
            "_path": text.unfused(fields.breadcrumb_path(F.col("_desc"), labels)),
        }
    )
    header, path = F.col("_header"), F.col("_path")
    return parsed.withColumns(
        {
            "attrs": text.attrs_a(F.col("attrs")),
            "avg_rating": text.unfused(numbers.to_double(F.col("avg_rating"))),
            "num_review": numbers.abbreviated_count(F.col("num_review")),
            "num_sold": numbers.abbreviated_count(F.col("num_sold")),
            "shipping": text.shipping_fee(F.col("shipping")),
            "country": fields.labelled_words(header, labels.country),
            "brand": fields.labelled_words(header, labels.brand, "-/"),
            "stock": fields.labelled_words(header, labels.stock),
            "origin": fields.labelled(header, labels.origin),
            "first_category": fields.breadcrumb_top(F.col("_desc"), labels),
            "second_category": fields.path_levels(path, "-", 2),
            "third_category": fields.path_levels(path, "-", 3),
            "description": fields.free_text(F.col("_desc"), labels),
            "shop_name": fields.shop_name_a(shop, labels),
            "shop_like_tier": fields.badge_tier(shop, labels),
            "shop_num_review": numbers.abbreviated_count(F.col("_reviews")),
            "shop_reply_percentage": fields.percent_after(shop, labels.reply_rate),
            "shop_reply_time": fields.line_after(shop, labels.reply_time),
            "shop_creation_time": fields.age_months(F.col("_joined"), labels),
            "shop_num_follower": numbers.abbreviated_count(F.col("_followers")),
        }
    ).drop("product_desc", "shop_info", "_desc", "_header", "_path", "_reviews", "_followers", "_joined")


def clean_store_a(raw: DataFrame, labels: V.StoreALabels = V.STORE_A) -> DataFrame:
    return details_a(name_and_price_a(raw), labels)


def name_and_price_b(raw: DataFrame) -> DataFrame:
    """The two columns that decide which offer of a product is kept."""
    return raw.withColumns({"product_name": text.name_b(F.col("product_name")), "price": text.price_b(F.col("price"))})


def details_b(df: DataFrame, labels: V.StoreBLabels = V.STORE_B) -> DataFrame:
    """Every other store-B column; extra columns pass through."""
    category, shop = F.col("category"), F.col("shop_info")
    return (
        df.withColumns(
            {
                "avg_rating": text.unfused(numbers.to_double(F.col("avg_rating"))),
                "brand_name": text.brand_b(F.col("brand_name"), labels),
                "num_review": text.review_count_b(F.col("num_review"), labels),
                "attrs": text.attrs_b(F.col("attrs")),
                "product_desc": text.markup_b(F.col("product_desc")),
                "first_category": fields.path_top(category),
                "second_category": fields.path_levels(category, "/", 2),
                "third_category": fields.path_levels(category, "/", 3),
                "shop_name": fields.shop_name_b(shop),
                "shop_rating": fields.percent_after(shop, labels.seller_ratings),
                "ship_on_time": fields.percent_after(shop, labels.ship_on_time),
                "shop_reply_percentage": fields.percent_after(shop, labels.chat_response),
            }
        )
        .withColumnsRenamed({"brand_name": "brand", "product_desc": "description"})
        .drop("shop_info", "category")
    )


def clean_store_b(raw: DataFrame, labels: V.StoreBLabels = V.STORE_B) -> DataFrame:
    return details_b(name_and_price_b(raw), labels)


def heads_of_both(raw_a: DataFrame, raw_b: DataFrame, key: str = "offer_key") -> DataFrame:
    """Name, price and key of the listings of both stores that valid_listings would keep, with their other columns as they came.

    A shop name or a description is missing exactly where the text that it is cut from is missing.
    """

    def heads(named: DataFrame, store: str) -> DataFrame:
        whole = named.filter("price IS NOT NULL AND product_name <> '' AND shop_info IS NOT NULL AND product_desc IS NOT NULL")
        decisive = ["product_name", "price", key]
        return whole.select(*decisive, F.struct(*(c for c in named.columns if c not in decisive)).alias(store))

    both = heads(name_and_price_a(raw_a), "_raw_a"), heads(name_and_price_b(raw_b), "_raw_b")
    return both[0].unionByName(both[1], allowMissingColumns=True)


def shops_of_both(heads: DataFrame, labels: V.StoreALabels = V.STORE_A) -> DataFrame:
    """Rows of heads_of_both with the shop's name, cut by the rules of the row's own store; nothing else is parsed."""
    shop_a, shop_b = F.col("_raw_a.shop_info"), F.col("_raw_b.shop_info")
    shop = F.when(F.col("_raw_a").isNotNull(), fields.shop_name_a(shop_a, labels)).otherwise(fields.shop_name_b(shop_b))
    return heads.withColumn("shop_name", shop).drop("_raw_a", "_raw_b")


def details_of_both(heads: DataFrame) -> DataFrame:
    """Rows of heads_of_both with every column of clean listings, each parsed with the rules of its own store."""
    decisive, nested, names = [c for c in heads.columns if c not in ("_raw_a", "_raw_b")], heads, []
    for raw, details in (("_raw_a", details_a), ("_raw_b", details_b)):
        opened = details(nested.select("*", f"{raw}.*"))
        own = [c for c in opened.columns if c not in nested.columns]
        clean = F.when(F.col(raw).isNotNull(), F.struct(*own)).alias(f"_clean{raw}")
        nested, names = opened.select(*nested.columns, clean), [*names, own]
    places = [{c: F.col(f"_clean{raw}.{c}") for c in own} for raw, own in zip(("_raw_a", "_raw_b"), names, strict=True)]
    every = dict.fromkeys(c for place in places for c in place)
    return nested.select(*decisive, *(F.coalesce(*(p[c] for p in places if c in p)).alias(c) for c in every))
