"""Declared schemas of raw, clean and published listings (fixed values: names and types)."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _fields(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec.items()])


RAW_A = _fields(
    {
        "attrs": STRING,
        "avg_rating": STRING,
        "num_review": STRING,
        "num_sold": STRING,
        "price": STRING,
        "product_desc": STRING,
        "product_name": STRING,
        "shipping": STRING,
        "shop_info": STRING,
        "url": STRING,
    }
)

RAW_B = _fields(
    {
        "product_name": STRING,
        "avg_rating": STRING,
        "price": STRING,
        "brand_name": STRING,
        "num_review": STRING,
        "attrs": T.MapType(STRING, STRING),
        "category": STRING,
        "shop_info": STRING,
        "product_desc": STRING,
        "url": STRING,
    }
)

CLEAN_A = _fields(
    {
        "attrs": STRING,
        "avg_rating": DOUBLE,
        "num_review": INT,
        "num_sold": INT,
        "price": LONG,
        "product_name": STRING,
        "shipping": STRING,
        "url": STRING,
        "country": STRING,
        "brand": STRING,
        "stock": STRING,
        "origin": STRING,
        "first_category": STRING,
        "second_category": STRING,
        "third_category": STRING,
        "description": STRING,
        "shop_name": STRING,
        "shop_like_tier": STRING,
        "shop_num_review": INT,
        "shop_reply_percentage": DOUBLE,
        "shop_reply_time": STRING,
        "shop_creation_time": INT,
        "shop_num_follower": INT,
    }
)

CLEAN_B = _fields(
    {
        "product_name": STRING,
        "avg_rating": DOUBLE,
        "price": LONG,
        "brand": STRING,
        "num_review": INT,
        "attrs": STRING,
        "description": STRING,
        "url": STRING,
        "first_category": STRING,
        "second_category": STRING,
        "third_category": STRING,
        "shop_name": STRING,
        "shop_rating": DOUBLE,
        "ship_on_time": DOUBLE,
        "shop_reply_percentage": DOUBLE,
    }
)

# Search-index document: a clean store-A listing with an integer tier plus a long id.
INDEX_DOCUMENT = T.StructType(
    [T.StructField("id", LONG)]
    + [
        T.StructField(f.name, INT) if f.name == "shop_like_tier" else f
        for f in CLEAN_A.fields
    ]
)

URL_ITEM = _fields({"category": STRING, "url": STRING, "sold": STRING})

ENVELOPE = _fields({"topic": STRING, "key": T.BinaryType(), "value": T.BinaryType()})

CATEGORY_SEED = _fields({"cat_1_name": STRING, "cat_1_url": STRING})

_PRICE_TEXT = _fields({"text": STRING})
_SKU_INFO = _fields(
    {
        "skuId": STRING,
        "price": _fields(
            {
                "salePrice": _PRICE_TEXT,
                "promotionPrice": _PRICE_TEXT,
                "originalPrice": _PRICE_TEXT,
                "text": STRING,
            }
        ),
        "quantity": _fields({"limit": _fields({"max": STRING}), "max": STRING}),
        "stock": STRING,
        "inventory": STRING,
    }
)
_PROPERTY = _fields(
    {"pid": STRING, "values": T.ArrayType(_fields({"vid": STRING, "name": STRING}))}
)
_LISTED_SKU = _fields({"skuId": STRING, "propPath": STRING, "skuPropPath": STRING})
_PAGE_FIELDS = _fields(
    {
        "product": _fields({"title": STRING, "highlights": STRING, "desc": STRING}),
        "seller": _fields({"name": STRING, "sellerId": STRING}),
        "review": _fields(
            {
                "averageRating": DOUBLE,
                "reviews": LONG,
                "contentedNum": LONG,
                "scores": T.ArrayType(LONG),
            }
        ),
        "skuInfos": T.MapType(STRING, _SKU_INFO),
        "productOption": _fields(
            {
                "skuBase": _fields(
                    {"properties": T.ArrayType(_PROPERTY), "skus": T.ArrayType(_LISTED_SKU)}
                )
            }
        ),
        "specifications": T.MapType(STRING, T.MapType(STRING, STRING)),
    }
)
PAGE_STATE = _fields({"data": _fields({"root": _fields({"fields": _PAGE_FIELDS})})})



def with_text_column(schema: T.StructType, name: str) -> T.StructType:
    """A copy of a schema with one more text column."""
    return T.StructType([*schema.fields, T.StructField(name, STRING)])


# Columns whose gaps are filled with the table-wide mean.
MEAN_FILLED = (
    "avg_rating",
    "shop_rating",
    "ship_on_time",
    "shop_reply_percentage",
    "num_review",
    "num_sold",
    "shop_num_review",
    "shop_creation_time",
    "shop_num_follower",
)
BLANK_FILLED = ("shipping", "country", "origin")
NO_INFO_FILLED = (
    "first_category",
    "second_category",
    "third_category",
    "shop_like_tier",
    "shop_reply_time",
)
MODEL_DROPPED = ("url", "attrs", "shipping", "country", "stock")
