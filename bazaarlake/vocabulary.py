"""Fixed values of the two marketplaces' listing text.

Everything here has to equal what the sites write, so it is kept as plain text in one place; every
function that uses a label takes it from one of the two ``Labels`` objects.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed value: letters that survive normalisation besides ASCII letters, digits, "_" and space.
ACCENTED = "àáãạảăắằẳẵặâấầẩẫậèéẹẻẽêềếểễệđìíĩỉịòóõọỏôốồổỗộơớờởỡợùúũụủưứừửữựỳỵỷỹý"
SPECIAL = f"[^a-z0-9A-Z_ {ACCENTED}{ACCENTED.upper()}]+"

# Markers used across columns.
NO_INFO = "no info"
CURRENCY = "₫"
LEVEL_SEPARATOR = " / "
NO_PRICE = "---"
DEFAULT_VARIANT = "Mặc định"
DEFAULT_MATCH_KEY = "default"
UNKNOWN_TITLE = "Unknown title"

# Fixed values: (pattern, replacement) pairs, applied in order, that reduce description HTML.
# "</div>" ends up as "/", "</a>" as "-", "</label>" as ": ".
MARKUP_RULES = (
    (" &amp;", ","),
    (r'<svg.*?</svg>|<div>|div|class=|"|<label.*?>|<flex.*?>| href=/', ""),
    ("</a>", "-"),
    ("</label>", ": "),
    ("< ", "<"),
    (r"/.*?>", "/>"),
    ("<a ", "<"),
    ("<p ", "<"),
)
# Category names that contain a slash, rewritten so they do not look like levels.
SLASHED_CATEGORIES = (
    ("vớ/ tất", "vớ, tất"),
    ("vớ/tất", "vớ, tất"),
    ("quần dài/quần âu", "quần dài, quần âu"),
    ("quần dài/ quần âu", "quần dài, quần âu"),
)


@dataclass(frozen=True)
class StoreALabels:
    """Labels in the text of a store-A listing (description labels in lower case)."""

    breadcrumb_root: str = "shopee"
    description: str = "mô tả sản phẩm"
    country: str = "xuất xứ"
    brand: str = "thương hiệu"
    stock: str = "kho hàng"
    origin: str = "gửi từ"
    badge: str = "Yêu Thích"
    reviews: str = "Đánh Giá"
    reply_rate: str = "Tỉ Lệ Phản Hồi"
    reply_time: str = "Thời Gian Phản Hồi"
    joined: str = "Tham Gia"
    followers: str = "Người Theo Dõi"
    year: str = "năm"
    month: str = "tháng"


@dataclass(frozen=True)
class StoreBLabels:
    """Labels in the text of a store-B listing (brand and review labels in lower case)."""

    no_brand: str = "no brand"
    no_ratings: str = "no ratings"
    ratings: str = " ratings"
    seller_ratings: str = "Seller Ratings"
    ship_on_time: str = "Ship On Time"
    chat_response: str = "Chat Response"


STORE_A = StoreALabels()
STORE_B = StoreBLabels()
