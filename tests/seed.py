"""The seed of the store database and the wide orders it gives.

Fixed values: five transactions, their eleven items and the products they use.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tillwright import schemas

PRODUCTS = [
    ("OEMNGD1673", "4 can nước giặt D-nee Thái Lan 3L", 676000),
    ("THE001", "150 cái Bao đựng thẻ nhân viên 108", 169000),
    ("OEMST661", "Đừng phê bình tôi", 23000),
    ("OEMST716", "Trò chuyện với cõi vô hình", 219000),
    ("OEMKS224", "Kệ sắt để chậu hoa trang trí", 340000),
    ("OEMTM421", "2 lọ Tẩy mốc đa năng của Hàn Quốc", 119000),
    ("BS101", "Hộp 12 cái Bút sơn Toyo SA101", 127000),
    ("SC_MS1947", "Bộ vợt & bẫy muỗi 2 trong 1", 299000),
    ("OEMMD945", "Mũ Fedora Floppy dạ nỉ, vành nhỏ", 143000),
    ("SC_F2024", "Chảo chiên SUPER CHEF hợp kim tráng men đáy từ 24cm", 293000),
    ("ERKLT080-10", "Combo 8 chai Nước giặt chống phai màu Kolortex", 549000),
]

TRANSACTIONS = [
    (1, 5, "0901234567", datetime(2025, 10, 28, 9, 30), "cash", Decimal("0.00"), 560000, 56),
    (2, 5, "0902345678", datetime(2025, 10, 29, 10, 15), "card", Decimal("5.00"), 980000, 98),
    (3, 5, "0903456789", datetime(2025, 10, 30, 14, 20), "e-wallet", Decimal("0.00"), 450000, 45),
    (4, 5, "0904567890", datetime(2025, 10, 31, 18, 5), "cash", Decimal("10.00"), 1500000, 150),
    (5, 5, "0905678901", datetime(2025, 11, 1, 11, 10), "card", Decimal("0.00"), 320000, 32),
]

ITEMS = [
    (1, "OEMNGD1673", 1), (1, "THE001", 1),
    (2, "SC_F2024", 2), (2, "OEMST661", 1),
    (3, "OEMTM421", 3), (3, "OEMMD945", 1),
    (4, "ERKLT080-10", 1), (4, "OEMST716", 2), (4, "OEMKS224", 1),
    (5, "BS101", 2), (5, "SC_MS1947", 1),
]

WIDE = {
    1: ["OEMNGD1673", 1, "THE001", 1, None, None],
    2: ["OEMST661", 1, "SC_F2024", 2, None, None],
    3: ["OEMMD945", 1, "OEMTM421", 3, None, None],
    4: ["ERKLT080-10", 1, "OEMKS224", 1, "OEMST716", 2],
    5: ["BS101", 2, "SC_MS1947", 1, None, None],
}


def transactions(spark):
    return spark.createDataFrame(TRANSACTIONS, schemas.TRANSACTIONS)


def items(spark):
    return spark.createDataFrame(ITEMS, schemas.TRANSACTION_ITEM)


def products(spark):
    return spark.createDataFrame(PRODUCTS, schemas.PRODUCTS)
