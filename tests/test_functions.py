"""Column functions on hand-written edge rows."""

import pytest
from pyspark.sql import functions as F

from bazaarlake import vocabulary as V
from bazaarlake.functions import fields, keys, numbers, text


def values(spark, function, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (
            numbers.abbreviated_count,
            {"3,2k": 3200, "15k": 15000, "1,234": 1234, "0": 0, "": None, None: None, "1,25k": 1250, "2tr": None},
        ),
        (
            text.price_a,
            {"₫99.000": 99000, "₫100.000 - ₫200.000": 200000, "99.000₫": None, None: None, "₫3.000.000.000": 3000000000},
        ),
        (text.price_b, {"₫1,234,000": 1234000, "Liên hệ": None, None: None}),
        (text.review_count_b, {"No Ratings": 0, "12 Ratings": 12, "1 Rating": None, None: None}),
        (text.brand_b, {"No Brand": "no info", "L'Oréal  Paris": "l oréal paris", None: None}),
        (
            text.name_a,
            {
                "Yêu Thích+\nÁO [50%] Thun--Nam": "áo thun nam",
                "yêu thích\nx": "x",
                "[a] [b]": "",
                "日本 tee_1": "tee_1",
                None: None,
            },
        ),
        (text.name_b, {"A (x) [y] B": "a b", "Straße ñ": "stra e"}),
        (text.attrs_a, {'{"Màu":"Đỏ"}': "màu đỏ", '{"a": null}': "a  null"}),
        (text.shipping_fee, {"₫15.000 - ₫30.000": "15000", "Miễn phí": "", None: None}),
        (lambda c: fields.path_levels(c, "/", 2), {"a/b/c": "a / b", "a": "no info", None: "no info"}),
        (lambda c: fields.path_levels(c, "/", 3), {"a/b/c": "a / b / c", "a/b": "no info"}),
        (fields.path_top, {"a/b": "a", "a": "", None: None}),
        (
            fields.badge_tier,
            {"Yêu Thích+\nshop": "2", "Yêu Thích\nshop": "1", "shop": "0", None: "0"},
        ),
        (
            lambda c: fields.age_months(fields.line_after(c, V.STORE_A.joined)),
            {"x\nTham Gia\n3 năm trước\ny": 36, "Tham Gia\n5 tháng\n": 5, "Tham Gia\n12 ngày\n": 0, None: 0},
        ),
        (
            lambda c: fields.percent_after(c, V.STORE_A.reply_rate),
            {"Tỉ Lệ Phản Hồi\n97%\n": 0.97, "none": None, None: None},
        ),
        (
            lambda c: numbers.abbreviated_count(fields.last_line_after(c, V.STORE_A.followers)),
            {"Người Theo Dõi\n1,5k": 1500, "Người Theo Dõi\n12\nmore": 12, "": None},
        ),
        (fields.shop_name_a, {"Yêu Thích\nMy Shop\nOnline": "My Shop", "My Shop\n": "My Shop", "one": ""}),
        (fields.shop_name_b, {"Sold by\nMy Shop\nx": "My Shop"}),
        (
            lambda c: F.to_json(fields.rating_lines(c)),
            {
                "4.9\n12\nĐánh Giá\n3k\nĐã Bán\n?": '{"avg_rating":"4.9","num_review":"12","num_sold":"3k"}',
                "a\nb\nc\n3k": '{"num_sold":"3k"}',
                "1\n2\n3\n4\n5": "{}",
            },
        ),
        (
            keys.match_key,
            {
                "Màu:Xanh, Size:L": "l_xanh",
                "Xanh - L": "l_xanh",
                "": "default",
                None: "default",
                "---": "",
                "Size: 5:6; A": "56_a",
            },
        ),
        (keys.digits_only, {"SKU-12a3": "123", "x": "", None: None}),
        (keys.item_id, {"https://x/p-i123-s4.html": "123", "https://x": ""}),
        (
            lambda c: keys.absolute_url(c, host="h"),
            {"//x/y": "https://x/y", "/y": "https://h/y", "http://z": "http://z"},
        ),
        (text.non_blank, {"  ": None, "a": "a", "\n": None}),
        (text.strip, {" \t a \n": "a"}),
    ],
)
def test_text_cases(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


def test_special_characters_equal_the_declared_alphabet(spark):
    """The class split for speed keeps and replaces exactly what the declared pattern does."""
    characters = [chr(i) for i in range(1, 0x2000)]
    samples = characters + ["a!é#ß日b", "x" + "#日" * 20000 + "y", "đ" * 10]
    rows = spark.createDataFrame([(s,) for s in samples], "v string")
    wrong = rows.filter(text.letters_only(F.col("v")) != F.regexp_replace("v", V.SPECIAL, " "))
    assert wrong.count() == 0


def test_markup_gives_breadcrumb_and_fields(spark):
    html = (
        '<div class="p"><div><a class="c" href="/">Shopee</a><svg w="1"><path d="M"></path></svg>'
        '<a href="/x">Áo</a><a href="/y">Vớ/Tất</a></div></div><div><label class="l">Thương Hiệu</label>'
        '<a href="/b">No#1</a></div><div><label>Kho Hàng</label><div>12</div></div>'
        "<div>MÔ TẢ SẢN PHẨM</div><p class='t'>Đẹp &amp; rẻ\nXuất xứ: Mỹ</p>"
    )
    df = spark.createDataFrame([(html,)], "v string").select(text.markup_a(F.col("v")).alias("d"))
    d = F.col("d")
    header = fields.header_text(d)
    row = df.select(
        fields.breadcrumb_top(d),
        fields.path_levels(fields.breadcrumb_path(d), "-", 2),
        fields.path_levels(fields.breadcrumb_path(d), "-", 3),
        fields.labelled_words(header, V.STORE_A.brand, "-/"),
        fields.labelled_words(header, V.STORE_A.stock),
        fields.labelled(header, V.STORE_A.origin),
        fields.free_text(d),
    ).first()
    assert list(row) == ["áo", "áo / vớ, tất", "no info", "no 1", "12", "", "đẹp rẻ xuất xứ mỹ"]


def test_share_percent_rounds_half_up(spark):
    rows = spark.createDataFrame([(0, 0), (1, 8), (49, 400), (1, 3), (3, 3)], "p bigint, t bigint")
    got = [r[0] for r in rows.select(numbers.share_percent(F.col("p"), F.col("t"))).collect()]
    assert got == [0.0, 12.5, 12.3, 33.3, 100.0]


def test_normalise_is_idempotent(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(text.name_b(F.col("text")).alias("v"))
    assert docs.filter(text.name_b(F.col("v")) != F.col("v")).count() == 0


def test_first_number_takes_digit_strings(spark):
    row = spark.sql("select 'many' a, cast(null as string) b, '7' c, 'x' d").select(
        numbers.first_number(F.col("a"), F.col("b"), F.col("c")), numbers.first_number(F.col("a"))
    )
    assert list(row.first()) == [7, 0]


def test_log_price_guards_non_positive(spark):
    rows = spark.createDataFrame([(100.0,), (0.0,), (-1.0,)], "p double")
    assert [r[0] for r in rows.select(numbers.log_price(F.col("p"))).collect()] == [2.0, None, None]
