"""SQL for the cleaned values of the listing views, computed from the numbers behind the text."""

OFFER_KEY = (
    "lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber || '-' ||"
    " lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 10, '0')"
    " || '-' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), 12, '0')"
)

LINES = f"""
o AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, {OFFER_KEY} AS offer_key
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)
"""

CLEAN_A = """
a AS (
  SELECT 'a-' || offer_key AS offer_key,
    'size ' || p_size || ' flag ' || lower(l_returnflag) AS attrs,
    CASE WHEN l_partkey % 5 <> 0 THEN (30 + l_suppkey % 20) / 10.0 END::DOUBLE AS avg_rating,
    CASE WHEN l_partkey % 7 <> 0 THEN l_partkey % 500 END::INTEGER AS num_review,
    (CASE WHEN l_orderkey % 20000 < 1000 THEN l_orderkey % 20000
      ELSE (l_orderkey % 20000) // 100 * 100 END)::INTEGER AS num_sold,
    CASE WHEN l_partkey % 41 <> 0 THEN floor(l_extendedprice) END::BIGINT AS price,
    CASE WHEN l_partkey % 97 = 0 THEN ''
      ELSE lower(p_name) || ' brand ' || substr(p_brand, 7) || ' ' || lower(p_type) END AS product_name,
    CASE WHEN l_tax <> 0 THEN CAST(CAST(round(l_tax * 100000) AS BIGINT) AS VARCHAR) END AS shipping,
    'https://a.example/p-i' || l_partkey || '.' || l_suppkey AS url,
    CASE WHEN l_partkey % 50 <> 3 THEN 'nation ' || s_nationkey END AS country,
    CASE WHEN l_partkey % 50 <> 3 THEN 'brand ' || substr(p_brand, 7) END AS brand,
    CASE WHEN l_partkey % 50 <> 3 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS stock,
    CASE WHEN l_partkey % 50 <> 3 THEN 'kho ' || p_size END AS origin,
    CASE WHEN l_partkey % 50 <> 3 THEN lower(p_type) END AS first_category,
    CASE WHEN l_partkey % 50 <> 3 THEN lower(p_type) || ' / ' || lower(p_brand)
      ELSE 'no info' END AS second_category,
    CASE WHEN l_partkey % 50 <> 3 THEN lower(p_type) || ' / ' || lower(p_brand) || ' / ' || lower(p_name)
      ELSE 'no info' END AS third_category,
    CASE WHEN l_partkey % 50 <> 3 THEN lower(p_name) || ' supplier ' || substr(s_name, 10) || ' '
      || lower(l_returnflag) END AS description,
    CASE WHEN l_suppkey % 10 <> 9 THEN s_name END AS shop_name,
    CASE WHEN l_suppkey % 10 <> 9 THEN CAST(l_suppkey % 3 AS VARCHAR) ELSE '0' END AS shop_like_tier,
    CASE WHEN l_suppkey % 10 <> 9 THEN (l_suppkey % 90 + 10) * 1000 + 500 END::INTEGER AS shop_num_review,
    CASE WHEN l_suppkey % 10 <> 9 THEN (l_suppkey % 101) / 100.0 END::DOUBLE AS shop_reply_percentage,
    CASE WHEN l_suppkey % 10 <> 9 THEN 'trong vài giờ' END AS shop_reply_time,
    (CASE WHEN l_suppkey % 10 = 9 THEN 0
      ELSE (l_suppkey % 9 + 1) * (CASE WHEN l_suppkey % 2 = 0 THEN 12 ELSE 1 END) END)::INTEGER
      AS shop_creation_time,
    CASE WHEN l_suppkey % 10 <> 9 THEN l_suppkey * 7 END::INTEGER AS shop_num_follower
  FROM o)
"""

CLEAN_B = """
b AS (
  SELECT 'b-' || offer_key AS offer_key,
    lower(p_name) || ' brand ' || substr(p_brand, 7) AS product_name,
    CASE WHEN l_partkey % 5 <> 1 THEN (20 + l_suppkey % 30) / 10.0 END::DOUBLE AS avg_rating,
    CASE WHEN l_partkey % 41 <> 1 THEN floor(l_extendedprice) END::BIGINT AS price,
    CASE WHEN l_partkey % 6 = 0 THEN 'no info' ELSE 'brand ' || substr(p_brand, 7) END AS brand,
    (CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE l_partkey % 900 END)::INTEGER AS num_review,
    'size ' || p_size || ' flag ' || lower(l_returnflag) AS attrs,
    lower(p_name) || ' supplier ' || substr(s_name, 10) || ' ' || lower(p_type) AS description,
    'https://b.example/p-i' || l_partkey || '.' || l_suppkey AS url,
    CASE WHEN l_partkey % 9 = 0 THEN '' ELSE r_name END AS first_category,
    CASE WHEN l_partkey % 9 = 0 THEN 'no info' ELSE r_name || ' / ' || n_name END AS second_category,
    CASE WHEN l_partkey % 9 = 0 THEN 'no info'
      ELSE r_name || ' / ' || n_name || ' / ' || p_type END AS third_category,
    CASE WHEN l_suppkey % 10 <> 8 THEN s_name END AS shop_name,
    CASE WHEN l_suppkey % 10 <> 8 THEN (l_suppkey % 100) / 100.0 END::DOUBLE AS shop_rating,
    CASE WHEN l_suppkey % 10 <> 8 THEN (l_suppkey % 90 + 10) / 100.0 END::DOUBLE AS ship_on_time,
    CASE WHEN l_suppkey % 10 <> 8 THEN (l_suppkey % 80 + 20) / 100.0 END::DOUBLE AS shop_reply_percentage
  FROM o JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)
"""

BOTH = f"{LINES}, {CLEAN_A}, {CLEAN_B}, u AS (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b)"

MEAN_COLUMNS = (
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

FILLED = ", ".join(
    f"round(coalesce({c}::DOUBLE, (SELECT avg({c}) FROM u)), 6) AS {c}" for c in MEAN_COLUMNS
)
IMPUTED = f"{BOTH}, i AS (SELECT * REPLACE ({FILLED}) FROM u)"

VALID = "price IS NOT NULL AND product_name <> '' AND shop_name IS NOT NULL AND description IS NOT NULL"

BEST = "QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY price DESC NULLS LAST, offer_key) = 1"
