"""Listing-shaped views over the given tables.

Every row is built from one order line and the part and supplier it names, so the text grows with the
tables and the cleaned value is known from the numbers it was written from. ``offer_key`` identifies
an order line and decides ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.operators.skew import lookup_join, read_table, spread_scan


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with part and supplier columns, ``cents`` and ``offer_key``."""
    lines = spread_scan(read_table(spark, sf_dir, "lineitem"))
    part = read_table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    supplier = read_table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    joined = lookup_join(lookup_join(lines, part, "l_partkey", "inner"), supplier, "l_suppkey", "inner")
    return joined.withColumn(
        "cents", F.expr("cast(round(l_extendedprice * 100) as bigint)")
    ).withColumn(
        "offer_key",
        F.expr(
            "concat_ws('-', lpad(l_orderkey, 12, '0'), l_linenumber, lpad(l_suppkey, 9, '0'),"
            " lpad(l_partkey, 10, '0'), lpad(cents, 12, '0'))"
        ),
    )


def _grouped(number: str, mark: str) -> str:
    return f"translate(format_number({number}, 0), ',', '{mark}')"


RAW_A_EXPRESSIONS = {
    "attrs": """concat('{"size":', p_size, ',"flag":"', l_returnflag, '"}')""",
    "avg_rating": """if(l_partkey % 5 = 0, null,
        concat(3 + (l_suppkey % 20) div 10, '.', l_suppkey % 10))""",
    "num_review": "if(l_partkey % 7 = 0, null, cast(l_partkey % 500 as string))",
    "num_sold": """if(l_orderkey % 20000 < 1000, cast(l_orderkey % 20000 as string),
        concat((l_orderkey % 20000) div 1000, ',', (l_orderkey % 1000) div 100, 'k'))""",
    "price": f"""if(l_partkey % 41 = 0, 'Liên hệ', concat(
        '₫', {_grouped('cast(floor(0.9 * l_extendedprice) as bigint)', '.')},
        ' - ₫', {_grouped('cast(floor(l_extendedprice) as bigint)', '.')}))""",
    "product_desc": """if(l_partkey % 50 = 3, null, concat(
        '<div class="page"><div class="crumbs"><a class="c" href="/">Shopee</a>',
        '<svg viewBox="0 0 6 11"><path d="M1"></path></svg><a class="c" href="/t">', p_type,
        '</a><a class="c" href="/b">', p_brand, '</a><a class="c" href="/n">', p_name,
        '</a></div></div><div class="f"><label class="l">Thương Hiệu</label><a class="b" href="/x">',
        p_brand, '</a></div><div class="f"><label class="l">Xuất Xứ</label><div>Nation ',
        s_nationkey, '</div></div><div class="f"><label class="l">Kho Hàng</label><div>',
        cast(l_quantity as int), '</div></div><div class="f"><label class="l">Gửi Từ</label><div>Kho ',
        p_size, '</div></div><div class="h">MÔ TẢ SẢN PHẨM</div><p class="t">', p_name, ' &amp; ',
        s_name, ': ', l_returnflag, '!</p>'))""",
    "product_name": """if(l_partkey % 97 = 0, '[Sale] !!', concat(
        case l_suppkey % 3 when 1 then 'Yêu Thích\n' when 2 then 'Yêu Thích+\n' else '' end,
        '[Sale ', l_linenumber, '] ', upper(p_name), '!!  ', p_brand, ' ', p_type))""",
    "shipping": f"""if(l_tax = 0, null, concat('₫',
        {_grouped('cast(round(l_tax * 100000) as bigint)', '.')}, ' - ₫99.000'))""",
    "shop_info": """if(l_suppkey % 10 = 9, null, concat_ws('\n',
        case l_suppkey % 3 when 1 then 'Yêu Thích' when 2 then 'Yêu Thích+' end,
        s_name, 'Online', 'Đánh Giá', concat(l_suppkey % 90 + 10, ',5k'),
        'Tỉ Lệ Phản Hồi', concat(l_suppkey % 101, '%'), 'Thời Gian Phản Hồi', 'trong vài giờ',
        'Tham Gia', concat(l_suppkey % 9 + 1, if(l_suppkey % 2 = 0, ' năm trước', ' tháng trước')),
        'Người Theo Dõi', cast(l_suppkey * 7 as string)))""",
    "url": "concat('https://a.example/p-i', l_partkey, '.', l_suppkey)",
}

RAW_B_EXPRESSIONS = {
    "product_name": "concat(p_name, ' (promo) [x] ', p_brand)",
    "avg_rating": "if(l_partkey % 5 = 1, null, concat(2 + (l_suppkey % 30) div 10, '.', l_suppkey % 10))",
    "price": f"""if(l_partkey % 41 = 1, 'Liên hệ', concat('₫',
        {_grouped('cast(floor(l_extendedprice) as bigint)', ',')}))""",
    "brand_name": "if(l_partkey % 6 = 0, 'No Brand', p_brand)",
    "num_review": "if(l_partkey % 4 = 0, 'No Ratings', concat(l_partkey % 900, ' Ratings'))",
    "attrs": "map('Size', cast(p_size as string), 'Flag', l_returnflag)",
    "category": "if(l_partkey % 9 = 0, r_name, concat_ws('/', r_name, n_name, p_type))",
    "shop_info": """if(l_suppkey % 10 = 8, null, concat_ws('\n', 'Sold by', s_name,
        'Seller Ratings', concat(l_suppkey % 100, '%'), 'Ship On Time', concat(l_suppkey % 90 + 10, '%'),
        'Chat Response', concat(l_suppkey % 80 + 20, '%'), 'Visit store'))""",
    "product_desc": """concat('<article><h2 class="t">', p_name, '</h2><p class="d">', s_name,
        ' &amp; ', p_type, '</p></article>')""",
    "url": "concat('https://b.example/p-i', l_partkey, '.', l_suppkey)",
}


def _select(df: DataFrame, expressions: dict[str, str], *extra: str, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The texts of the lines, or of those that ``only`` leaves of the lines with their raw product_name and price."""
    if only is not None:
        df = only(df.withColumns({name: F.expr(expressions[name]) for name in ("product_name", "price")})).drop("product_name", "price")
    return df.select(*extra, *(F.expr(e).alias(name) for name, e in expressions.items()))


def raw_a(spark: SparkSession, sf_dir: str, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Raw store-A listings: every order line, keyed 'a-...'; ``only`` drops lines by name and price before other text is made."""
    lines = order_lines(spark, sf_dir).withColumn("offer_key", F.expr("concat('a-', offer_key)"))
    return _select(lines, RAW_A_EXPRESSIONS, "offer_key", only=only)


def raw_b(spark: SparkSession, sf_dir: str, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Raw store-B listings: every order line, keyed 'b-...'; ``only`` as in raw_a."""
    nation = read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    region = read_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    lines = order_lines(spark, sf_dir).withColumn("offer_key", F.expr("concat('b-', offer_key)"))
    placed = lookup_join(lookup_join(lines, nation, "s_nationkey", "inner"), region, "n_regionkey", "inner")
    return _select(placed, RAW_B_EXPRESSIONS, "offer_key", only=only)


# Class of the element that holds each field of a store-B detail page.
DETAIL_CLASSES = {
    "product_name": "title", "avg_rating": "score", "price": "price", "brand_name": "brand", "num_review": "reviews",
    "shop_info": "seller", "category": "crumb", "attr_name": "attr-name", "attr_value": "attr-value", "product_desc": "detail",
}


def detail_pages_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(offer_key, url, html): the detail page of every store-B listing; elements without a value are missing."""
    element = lambda tag, kind, field: f"concat('<{tag} id=\"x\" class=\"{kind}\">', {field}, '</{tag}>')"
    html = F.expr(
        f"""concat_ws('\n', '<html><body>', {element("h1", "big title", "product_name")}, {element("b", "score", "avg_rating")},
        {element("span", "price now", "price")}, {element("i", "brand", "brand_name")}, {element("a", "reviews", "num_review")},
        array_join(transform(split(category, '/'), c -> concat('<a class=''crumb''>', c, '</a>')), ' '),
        array_join(transform(map_entries(attrs), e -> concat('<dt class="attr-name">', e.key,
          '</dt><dd class="attr-value">', e.value, '</dd>')), ''),
        {element("pre", "seller", "shop_info")}, {element("div", "html detail", "product_desc")}, '</body></html>')"""
    )
    return raw_b(spark, sf_dir).select("offer_key", "url", html.alias("html"))


NESTED_CLASSES = {
    "product_name": "name", "avg_rating": "score", "price": "now", "brand_name": "brand", "num_review": "reviews",
    "shop_info": "seller", "category": "crumb", "product_desc": "detail", "option": "option", "value": "sku-name",
    "scale": "tabpath", "sized": "selected", "scale_text": "Int",
}


def nested_pages_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, html): a detail page of every part, whose elements hold others of their own tag, comments and void tags."""
    size = """concat('<div class="option"><div><h6>Size</h6></div><div class="tabpath"><div>', if(p_size % 3 = 0, 'EU', ' Int '),
      '</div></div><div class="box"><div class="box selected">', p_size, '</div></div></div>')"""
    html = F.expr(
        f"""concat('<!DOCTYPE html><html><head><title>1 > 0</title><script>var x = "<div class=name>no</div>" < 1;</script></head><body>
        <!-- <div class="name">not this</div> --><div class="page"><br/><img src="a>b.png"><div data-x="</div>" class="big name"><div><i>',
        p_name, '</i></div><br><div> of <!-- </div> -->', p_brand, '</div></div><DIV CLASS=''price now''><div>₫</div><div>', p_size, '</div></DIV>',
        if(p_partkey % 4 = 0, '', concat('<div class=score><div><div>', p_size % 5, '</div>.5</div></div>')),
        '<div class="brand"><div>', p_brand, '</div></div><div class="reviews"><div>', p_partkey % 7, '</div> &lt;votes&gt;</div>',
        '<ul class="crumbs"><li class="crumb"><ul><li>', 'box ', p_size, '</li></ul></li><li class="crumb">', p_type, '</li></ul>',
        '<div class="option"><h6>Colour</h6><div class="choice"><div class="sku-name"><div>c', p_size, '</div></div></div></div>', {size},
        '<div class="seller"><div>shop</div> <div>', 'box ', p_size, '</div></div><hr class="detail-line">',
        '<div class="html detail"><div>', p_type, '<br><div>deep</div></div>', if(p_partkey % 5 = 0, '', '</div></div><p>after</p></body></html>'))"""
    )
    return spread_scan(read_table(spark, sf_dir, "part")).select("p_partkey", html.alias("html"))


# Variant numbers of a page: 3 has a blank SKU id; 0 is called "9" on pages without a default SKU.
PAGE_EXPRESSION = """
to_json(named_struct('data', named_struct('root', named_struct('fields', named_struct(
  'product', named_struct('title', if(l_partkey % 13 = 0, '', p_name),
    'highlights', if(l_partkey % 4 = 0, '  ', concat('<ul><li>', p_brand, '</li></ul>')),
    'desc', if(l_partkey % 6 = 0, null, concat('<p>', p_type, '</p>'))),
  'seller', named_struct('name', s_name, 'sellerId', l_suppkey),
  'review', named_struct('averageRating', 3 + (l_suppkey % 20) / 10D, 'reviews', l_partkey % 500,
    'contentedNum', l_partkey % 100, 'scores', array(l_partkey % 5, l_partkey % 3)),
  'skuInfos', map(
    if(l_orderkey % 4 = 0, '9', '0'), named_struct('skuId', concat(sku, '-0'),
      'price', named_struct('salePrice', named_struct('text', concat('₫', cents)),
        'promotionPrice', named_struct('text', '₫1'), 'originalPrice', null_text, 'text', '₫2'),
      'quantity', named_struct('limit', named_struct('max', cast(cast(l_quantity as int) as string)), 'max', '1'),
      'stock', '2', 'inventory', '3'),
    '1', named_struct('skuId', concat(sku, '-1'),
      'price', named_struct('salePrice', null_text,
        'promotionPrice', named_struct('text', concat('₫', cents + 1)), 'originalPrice', null_text,
        'text', '₫2'),
      'quantity', named_struct('limit', null_max, 'max', 'many'), 'stock', '7', 'inventory', '3'),
    '2', named_struct('skuId', concat(' ', sku, '-2 '),
      'price', named_struct('salePrice', named_struct('text', ''), 'promotionPrice', null_text,
        'originalPrice', named_struct('text', concat('₫', cents + 2)), 'text', '₫2'),
      'quantity', named_struct('limit', null_max, 'max', '5'), 'stock', null, 'inventory', '3'),
    '3', named_struct('skuId', ' ',
      'price', named_struct('salePrice', null_text, 'promotionPrice', null_text,
        'originalPrice', null_text, 'text', null),
      'quantity', named_struct('limit', null_max, 'max', null), 'stock', null, 'inventory', null),
    '4', named_struct('skuId', concat(sku, '-4'),
      'price', named_struct('salePrice', null_text, 'promotionPrice', null_text,
        'originalPrice', null_text, 'text', null),
      'quantity', named_struct('limit', null_max, 'max', null), 'stock', null, 'inventory', null)),
  'productOption', named_struct('skuBase', named_struct(
    'properties', array(
      named_struct('pid', '1', 'values', array(
        named_struct('vid', cast(p_size as string), 'name', cast(p_size as string)),
        named_struct('vid', cast(p_size + 1 as string), 'name', cast(p_size + 1 as string)))),
      named_struct('pid', '2', 'values', array(
        named_struct('vid', '1', 'name', l_returnflag), named_struct('vid', '2', 'name', 'R')))),
    'skus', array(
      named_struct('skuId', concat(listed, '-0'),
        'propPath', if(l_orderkey % 10 = 0, '', concat('1:', p_size, ';2:1')), 'skuPropPath', null),
      named_struct('skuId', concat(listed, '-1'), 'propPath', null,
        'skuPropPath', concat('1:', if(l_orderkey % 11 = 0, 999, p_size + 1), '; 2:1;')),
      named_struct('skuId', concat(listed, '-2'), 'propPath', concat('1:', p_size, ';2:2'),
        'skuPropPath', null),
      named_struct('skuId', concat(listed, '-4'), 'propPath', concat('2:1;1:', p_size),
        'skuPropPath', null)))),
  'specifications', map(concat(sku, '-0'), map('material', p_type),
    concat(sku, '-1'), map('material', p_brand))
)))))"""


def page_states(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """(url, state): one structured product page per order line, with up to five SKU entries; extra columns of the line too."""
    lines = order_lines(spark, sf_dir).withColumnRenamed("offer_key", "sku").withColumns(
        {
            # Every third page lists its SKUs with a prefix, so only the digits match.
            "listed": F.expr("if(l_orderkey % 3 = 0, concat('SKU ', sku), sku)"),
            "null_text": F.expr("cast(null as struct<text:string>)"),
            "null_max": F.expr("cast(null as struct<max:string>)"),
        }
    )
    return lines.select(
        F.expr("concat('https://b.example/p-i', l_partkey, '.', sku, '.html')").alias("url"),
        F.expr(PAGE_EXPRESSION).alias("state"),
        *extra,
    )


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, option_text): one review per order line."""
    return order_lines(spark, sf_dir).selectExpr(
        "cast(l_partkey as string) AS item_id",
        "concat('Flag:', l_returnflag, ', Size:', p_size) AS option_text",
    )


def envelopes_a(spark: SparkSession, sf_dir: str, topic: str = "store_a") -> DataFrame:
    """Store-A listings as (topic, key, value) records; whole-currency prices get malformed JSON."""
    listings = raw_a(spark, sf_dir)
    value = F.to_json(F.struct(*(c for c in listings.columns if c != "offer_key")))
    broken = F.substring("offer_key", -2, 2) == "00"
    return listings.select(
        F.lit(topic).alias("topic"),
        F.col("offer_key").cast("binary").alias("key"),
        F.when(broken, F.concat(F.lit("{"), value)).otherwise(value).cast("binary").alias("value"),
    )
