"""Small tables with answers that can be worked out by hand. All of them are fixed values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

RAW_ORDERS = (
    "id bigint, customer_id bigint, amount decimal(18,2), status string, created_at date",
    [
        (101, 1, D("42.00"), "paid", dt.date(2024, 1, 10)),
        (102, 2, D("18.50"), "paid", dt.date(2024, 1, 12)),
        (103, 1, D("99.00"), "refunded", dt.date(2024, 1, 15)),
        (104, 3, D("12.75"), "paid", dt.date(2024, 2, 1)),
        (105, 4, D("55.00"), "paid", dt.date(2024, 2, 4)),
        (106, 2, D("8.00"), "pending", dt.date(2024, 2, 9)),
    ],
)
USERS = (
    "id bigint, name string, age int, city string, country string",
    [
        (1, "Alice Johnson", 28, "New York", "US"),
        (2, "Bob Smith", 34, "Toronto", "CA"),
        (3, "Carol Williams", 22, "London", "UK"),
        (4, "Dave Brown", 45, "Berlin", "DE"),
        (5, "Eve Davis", 31, "Sydney", "AU"),
        (6, "Frank Miller", 29, "Chicago", "US"),
        (7, "Grace Wilson", 38, "Vancouver", "CA"),
        (8, "Heidi Clark", 26, "Paris", "FR"),
    ],
)
LAB_ORDERS = (
    "order_id bigint, user_id bigint, amount decimal(18,2), status string, created_at timestamp_ntz",
    [
        (101, 1, D("142.50"), "COMPLETED", dt.datetime(2024, 1, 10, 10, 0)),
        (102, 2, D("89.00"), "COMPLETED", dt.datetime(2024, 1, 12, 11, 30)),
        (103, 1, D("220.00"), "PENDING", dt.datetime(2024, 1, 15, 14, 15)),
        (104, 3, D("45.25"), "COMPLETED", dt.datetime(2024, 1, 18, 9, 45)),
        (105, 4, D("310.00"), "CANCELLED", dt.datetime(2024, 1, 20, 16, 20)),
        (106, 2, D("65.50"), "COMPLETED", dt.datetime(2024, 1, 22, 13, 10)),
        (107, 5, D("180.00"), "COMPLETED", dt.datetime(2024, 1, 25, 15, 40)),
        (108, 1, D("95.00"), "COMPLETED", dt.datetime(2024, 1, 28, 17, 5)),
    ],
)
PRODUCTS = (
    "product_id bigint, name string, category string, price decimal(18,2), inventory_count int",
    [
        (101, "Ultra Wireless Headphones", "Electronics", D("129.99"), 450),
        (102, "Ergonomic Mechanical Keyboard", "Electronics", D("89.50"), 1200),
        (103, "Ceramic Pour-Over Kettle", "Kitchen", D("45.00"), 800),
        (104, "Organic Cold Brew 12-Pack", "Groceries", D("29.99"), 2500),
        (105, "Noise Cancelling Earbuds", "Electronics", D("79.99"), 650),
        (106, "Cast Iron Skillet 10-inch", "Kitchen", D("38.50"), 300),
    ],
)
PAYMENTS = (
    "id bigint, order_id bigint, payment_method string, amount_cents bigint",
    [
        (1, 101, "credit_card", 4200),
        (2, 102, "bank_transfer", 1850),
        (3, 103, "credit_card", 9900),
        (4, 104, "gift_card", 1275),
        (5, 105, "credit_card", 5500),
        (6, 106, "bank_transfer", 800),
    ],
)
DAILY_SALES = (
    "date date, store_id string, sales_amount decimal(18,2)",
    [
        (dt.date(2024, 3, 1), "S01", D("4200.00")),
        (dt.date(2024, 3, 1), "S02", D("3800.50")),
        (dt.date(2024, 3, 2), "S01", D("4500.00")),
        (dt.date(2024, 3, 2), "S02", D("3900.00")),
        (dt.date(2024, 3, 3), "S01", D("5100.25")),
        (dt.date(2024, 3, 3), "S02", D("4100.00")),
    ],
)
DIRTY_USERS = (
    "id bigint, name string, email string, country string",
    [
        (1, "Alice Johnson", "alice@example.com", "US"),
        (2, "Bob Smith", None, "CA"),
        (3, None, "carol@example.com", "UK"),
        (4, "Dave Brown", "dave@example.com", None),
        (5, "Eve Davis", "eve@example.com", "AU"),
        (6, "Frank Miller", None, "US"),
    ],
)
NESTED_USERS = (
    "id bigint, name string, tags array<string>, address struct<city:string,zip:string>, prefs map<string,string>",
    [
        (1, "Alice", ["premium", "engineer"], ("New York", "10001"), {"newsletter": "true", "theme": "dark"}),
        (2, "Bob", ["trial"], ("Toronto", "M5V2T6"), {"newsletter": "false", "theme": "light"}),
        (3, "Carol", ["premium", "designer", "vip"], ("London", "EC1A1BB"), {"newsletter": "true", "theme": "dark"}),
        (4, "Dave", [], ("Berlin", "10115"), {"newsletter": "false", "theme": "system"}),
    ],
)
WEB_LOGS = (
    "log_id bigint, ip_address string, status_code int, endpoint string, response_ms int",
    [
        (1, "192.168.1.10", 200, "/api/v1/products", 42),
        (2, "10.0.0.15", 404, "/api/v1/missing", 18),
        (3, "192.168.1.10", 200, "/api/v1/cart", 65),
        (4, "172.16.0.4", 500, "/api/v1/checkout", 320),
        (5, "10.0.0.15", 200, "/api/v1/products", 35),
        (6, "192.168.1.10", 200, "/api/v1/orders", 88),
        (7, "172.16.0.4", 200, "/api/v1/products", 40),
        (8, "192.168.1.25", 200, "/api/v1/login", 55),
    ],
)
TRANSACTIONS = (
    "tx_id string, user_id string, amount double, merchant string, ts timestamp",
    [
        ("TX1001", "1", 35.50, "CoffeeShop", dt.datetime(2024, 4, 1, 12, 0, 10)),
        ("TX1002", "2", 1200.00, "LuxuryJewelry", dt.datetime(2024, 4, 1, 12, 1, 25)),
        ("TX1003", "1", 14.20, "SubwayTransit", dt.datetime(2024, 4, 1, 12, 3, 0)),
        ("TX1004", "3", 850.00, "ElectronicsSuperstore", dt.datetime(2024, 4, 1, 12, 4, 15)),
        ("TX1005", "4", 4.50, "CornerMart", dt.datetime(2024, 4, 1, 12, 5, 40)),
        ("TX1006", "2", 1450.00, "LuxuryJewelry", dt.datetime(2024, 4, 1, 12, 6, 10)),
        ("TX1007", "5", 62.00, "GasStation", dt.datetime(2024, 4, 1, 12, 7, 5)),
        ("TX1008", "1", 2500.00, "OffshoreTransfer", dt.datetime(2024, 4, 1, 12, 8, 30)),
    ],
)
BLACKLIST = (
    "merchant string, risk_score double, category string",
    [
        ("OffshoreTransfer", 0.98, "HIGH_RISK"),
        ("LuxuryJewelry", 0.75, "MONITORED"),
        ("CryptoExchange", 0.95, "HIGH_RISK"),
        ("UnknownKiosk", 0.85, "SUSPICIOUS"),
    ],
)


def frame(spark, fixture):
    schema, rows = fixture
    return spark.createDataFrame(rows, schema)
