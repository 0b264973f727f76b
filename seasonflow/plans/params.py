"""Parameters of the catalogue queries on the driver tables.

Fixed values: the reference's literals mapped onto the driver data
(PRODUCT1/PRODUCT2 -> PROMO/SMALL, region A01 -> AFRICA, cap 700000 -> 300,
year 2016 -> 2000, train/test split 201630 -> 200026).
"""

CAP = 300
PRODUCTS = ("PROMO", "SMALL")
REGION = "AFRICA"
MIN_YEAR = 2000
BAD_WEEK = 53
SQL_BAD_WEEK = 52
ORDER = 17
ODD_ORDER = 5
EVEN_ORDER = 4
LONG_ORDER = 338  # longer than some series
CHUNK_ROWS = 100
FOLD_BASE = 7
SPLIT_YEARWEEK = 200026
YEARWEEK_FROM = "199801"
YEARWEEK_TO = "200052"
UPLIFT = 1.2
DISCOUNT = 0.2
DIGITS = 6
TOP_K = 10
