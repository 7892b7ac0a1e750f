"""Small synthetic raw sources carrying the edge cases every fixture set
must have: exact duplicate row, day-first date, empty / zero / negative
quantity, padded mixed-case text, negative and NULL stock, two stock readings
for one key, NULL / 0 / 6 ratings, event type outside the valid set, rows on
the 7 / 30 day boundaries and one second before, a sold pair without stock,
a product without reviews or events, an unknown store, stock 9 / 10 against
sales 5 / 6."""

from __future__ import annotations

from shelfrisk import schemas

ORDERS = [
    # order_id, order_date, customer_id, product_id, store_id, quantity, unit_price, channel
    ("O1", "2024-03-31", "C1", "P1", "S1", "3", "10.0", "web"),
    ("O1", "2024-03-31", "C1", "P1", "S1", "3", "10.0", "web"),      # exact duplicate
    ("O2", "2024-03-24", "C1", "P1", "S1", "4", "10.0", "store"),    # max - 7 d (in 7 d)
    ("O3", "2024-03-23", "C2", "P1", "S1", "5", "10.0", "store"),    # day before 7 d window
    ("O4", "2024-03-01", "C2", "P2", "S1", "2", "", "web"),          # max - 30 d, empty price
    ("O5", "2024-02-29", "C3", "P2", "S1", "100", "1.0", "web"),     # outside 30 d
    ("O6", "15/03/2024", "C3", "P2", "S2", "7", "2.0", "web"),       # day-first date
    ("O7", "2024-03-30", "C4", "P3", "S1", "", "2.0", "web"),        # empty quantity
    ("O8", "2024-03-30", "C4", "P3", "S1", "0", "2.0", "web"),       # zero quantity
    ("O9", "2024-03-30", "C4", "P3", "S1", "-1", "2.0", "web"),      # negative quantity
    ("O10", "2024-03-30", "C5", "P4", "S9", "6", "3.0", "web"),      # unknown store, no stock
    ("O11", "2024-03-28", "C5", "P5", "S2", "6", "3.0", "web"),      # stock 9, sales 6 -> risk
    ("O12", "2024-03-28", "C6", "P6", "S2", "5", "3.0", "web"),      # stock 9, sales 5
    ("O13", "2024-03-28", "C6", "P7", "S2", "6", "3.0", "web"),      # stock 10, sales 6
    (None, "2024-03-28", "C7", "P7", "S2", "6", "3.0", "web"),       # NULL key
]

PRODUCTS = [
    ("P1", "Laptop Pro", " Laptop ", "Acme", "500", "900"),
    ("P2", "Phone X", "smartPhone", " ACME", "200", "400"),
    ("P3", "Cable", "accessory", "Generic", "1", "5"),
    ("P3", "Cable v2", "accessory", "Generic", "1", "6"),           # second row for a key
    ("P4", "Tablet", "Tablet", "Acme", "100", "300"),
    ("P5", "Mouse", "accessory", "Acme", "5", "20"),
    ("P6", "Keyboard", "accessory", "Acme", "10", "40"),
    ("P7", "Screen", "display", "Acme", "50", "150"),
    ("P8", "Unsold", "misc", "Acme", "x", "y"),                      # unparsable prices
]

STORES = [
    ("S1", "Store One", "Lille", " North", "2020-01-15"),
    ("S2", "Store Two", "Nice ", "SOUTH", "15/01/2021"),
]

INVENTORY = [
    ("P1", "S1", 50, "2024-03-01T00:00:00"),
    ("P1", "S1", 8, "2024-03-20T00:00:00"),                          # later reading wins
    ("P1", "S1", 8, "2024-03-20T00:00:00"),                          # exact duplicate
    ("P2", "S1", -3, "2024-03-20T00:00:00"),                         # negative -> 0
    ("P3", "S1", None, "2024-03-20T00:00:00"),                       # NULL -> 0
    ("P5", "S2", 9, "2024-03-20T00:00:00"),
    ("P6", "S2", 9, "2024-03-20T00:00:00"),
    ("P7", "S2", 10, "2024-03-20T00:00:00"),
    ("P7", "S2", 1, "not a time"),                                   # unparsable -> dropped
]

REVIEWS = [
    ("R1", "P1", 4, "good", "2024-03-10"),
    ("R2", "P1", 2, "meh", "2024-03-11"),
    ("R2", "P1", 5, "dup id", "2024-03-12"),                         # duplicate review_id
    ("R3", "P1", None, "no rating", "2024-03-12"),                   # NULL rating
    ("R4", "P2", 0, "zero", "2024-03-12"),                           # out of range
    ("R5", "P2", 6, "six", "2024-03-12"),                            # out of range
]

EVENTS = [
    ("E1", "P1", "view", "2024-03-31 12:00:00", "app"),              # anchor
    ("E2", "P1", " VIEW ", "2024-03-01 12:00:00", " App"),           # exactly anchor - 30 d
    ("E3", "P1", "cart", "2024-03-01 11:59:59", "app"),              # one second before
    ("E4", "P2", "purchase", "2024-03-30 00:00:00", "app"),          # type outside the set
    ("E5", "P2", "wishlist", "2024-03-15 00:00:00", "web"),
    ("E5", "P2", "wishlist", "2024-03-16 00:00:00", "web"),          # duplicate event_id
]


def raw_frames(spark) -> dict:
    return {
        "orders": spark.createDataFrame(ORDERS, schemas.RAW_ORDERS),
        "products": spark.createDataFrame(PRODUCTS, schemas.RAW_PRODUCTS),
        "stores": spark.createDataFrame(STORES, schemas.RAW_STORES),
        "inventory": spark.createDataFrame(INVENTORY, schemas.RAW_INVENTORY),
        "reviews": spark.createDataFrame(REVIEWS, schemas.RAW_REVIEWS),
        "events": spark.createDataFrame(EVENTS, schemas.RAW_EVENTS),
    }


# Expected fact rows (ISO date mode):
# product, store, sales_7d, sales_30d, avg_rating, stock, category, region, web, risk
EXPECTED_FACT = {
    ("P1", "S1", 7, 12, 3.0, 8, "laptop", "north", 2, 1),
    ("P2", "S1", 0, 2, 0.0, 0, "smartphone", "north", 1, 0),
    ("P4", "S9", 6, 6, 0.0, 0, "tablet", None, 0, 1),
    ("P5", "S2", 6, 6, 0.0, 9, "accessory", "south", 0, 1),
    ("P6", "S2", 5, 5, 0.0, 9, "accessory", "south", 0, 0),
    ("P7", "S2", 6, 6, 0.0, 10, "display", "south", 0, 0),
}
# With the day-first repair, O6 adds the pair.
EXPECTED_REPAIRED_EXTRA = ("P2", "S2", 0, 7, 0.0, 0, "smartphone", "south", 1, 0)
