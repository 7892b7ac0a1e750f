"""Independent SQL formulation of every registered query, for DuckDB over the
driver's parquet views.  Written from the operator semantics, not from the
Spark plans: keep-first / latest use window ranks (Spark uses struct
aggregates), the two horizons use two filters, the split uses SQL md5.
"""

from __future__ import annotations

from . import params as P

NORM = r"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"

# Spark datetime pattern -> strptime pattern (fixed values)
STRPTIME = {
    P.ISO_DATE: "%Y-%m-%d",
    P.DAY_FIRST_DATE: "%d/%m/%Y",
    P.ISO_DATETIME: "%Y-%m-%dT%H:%M:%S",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
}
ISO = (P.ISO_DATE,)
BOTH = (P.ISO_DATE, P.DAY_FIRST_DATE)
TS_FORMATS = (P.ISO_DATETIME, "yyyy-MM-dd HH:mm:ss", P.ISO_DATE)
EV = ", ".join(f"'{t}'" for t in P.DRIVER_EVENT_TYPES)


def norm(c: str) -> str:
    return NORM.format(c=c)


def parse_ts(c: str, formats, typed: bool) -> str:
    if typed:
        return f"CAST({c} AS TIMESTAMP)"
    parts = [f"try_strptime({c}, '{STRPTIME[f]}')" for f in formats]
    return parts[0] if len(parts) == 1 else f"coalesce({', '.join(parts)})"


def first_by(src: str, keys: str, cols: list[str], latest: bool = False) -> str:
    direction = "DESC NULLS LAST" if latest else "ASC NULLS FIRST"
    order = ", ".join(f"{c} {direction}" for c in cols)
    return f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


# --- cleaners as SQL ------------------------------------------------------

def clean_orders(src: str, formats, typed: bool) -> str:
    return f"""
  SELECT order_id, order_date, customer_id, product_id, store_id,
         quantity, unit_price, channel
  FROM (SELECT order_id, {parse_ts('order_date', formats, typed)} AS order_date, customer_id,
               product_id, store_id, TRY_CAST(quantity AS DOUBLE) AS quantity,
               TRY_CAST(unit_price AS DOUBLE) AS unit_price, channel
        FROM (SELECT DISTINCT * FROM {src}))
  WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND store_id IS NOT NULL
    AND order_date IS NOT NULL AND quantity > 0"""


def clean_products(src: str) -> str:
    d = first_by(src, "product_id", ["product_name", "category", "brand", "cost_price", "sale_price"])
    return f"""
  SELECT product_id, {norm('product_name')} AS product_name, {norm('category')} AS category,
         {norm('brand')} AS brand, TRY_CAST(cost_price AS DOUBLE) AS cost_price,
         TRY_CAST(sale_price AS DOUBLE) AS sale_price
  FROM ({d}) WHERE product_id IS NOT NULL"""


def clean_stores(src: str, formats, typed: bool) -> str:
    d = first_by(src, "store_id", ["store_name", "city", "region", "opening_date"])
    return f"""
  SELECT store_id, {norm('store_name')} AS store_name, {norm('city')} AS city,
         {norm('region')} AS region, {parse_ts('opening_date', formats, typed)} AS opening_date
  FROM ({d}) WHERE store_id IS NOT NULL"""


def clean_inventory(src: str, typed: bool, clip: bool = True) -> str:
    stock = "CASE WHEN coalesce(sq, 0) < 0 THEN 0 ELSE coalesce(sq, 0) END" if clip else "sq"
    inner = f"""
    SELECT product_id, store_id, {stock} AS stock_qty, lu AS last_update
    FROM (SELECT product_id, store_id, TRY_CAST(TRY_CAST(stock_qty AS DOUBLE) AS BIGINT) AS sq,
                 {parse_ts('last_update', TS_FORMATS, typed)} AS lu FROM {src})
    WHERE product_id IS NOT NULL AND store_id IS NOT NULL AND lu IS NOT NULL"""
    return first_by(f"({inner})", "product_id, store_id", ["last_update", "stock_qty"], latest=True)


def clean_reviews(src: str, formats, typed: bool) -> str:
    d = first_by(src, "review_id", ["product_id", "rating", "comment", "review_date"])
    return f"""
  SELECT * FROM (
    SELECT review_id, product_id, TRY_CAST(TRY_CAST(rating AS DOUBLE) AS BIGINT) AS rating, comment,
           {parse_ts('review_date', formats, typed)} AS review_date FROM ({d}))
  WHERE rating BETWEEN {P.RATING_MIN} AND {P.RATING_MAX} AND product_id IS NOT NULL AND rating IS NOT NULL"""


def clean_events(src: str, typed: bool) -> str:
    d = first_by(src, "event_id", ["product_id", "event_type", "event_ts", "source"])
    return f"""
  SELECT * FROM (
    SELECT event_id, product_id, {norm('event_type')} AS event_type,
           {parse_ts('event_ts', TS_FORMATS, typed)} AS event_ts, {norm('source')} AS source FROM ({d}))
  WHERE event_type IN ({EV}) AND event_id IS NOT NULL AND product_id IS NOT NULL AND event_ts IS NOT NULL"""


def sales(o: str) -> str:
    return f"""
  SELECT product_id, store_id, CAST(SUM(quantity) AS BIGINT) AS sales_30d,
         CAST(SUM(CASE WHEN order_date >= (SELECT max(order_date) FROM {o}) - INTERVAL 7 DAY
                       THEN quantity ELSE 0 END) AS BIGINT) AS sales_7d
  FROM {o} WHERE order_date >= (SELECT max(order_date) FROM {o}) - INTERVAL 30 DAY
  GROUP BY product_id, store_id"""


def reviews_agg(r: str) -> str:
    return f"""
  SELECT product_id, AVG(CAST(rating AS DOUBLE)) AS avg_rating, COUNT(review_id) AS nb_reviews,
         MAX(review_date) AS last_review_date FROM {r} GROUP BY product_id"""


def web(e: str) -> str:
    return f"""
  SELECT product_id, COUNT(*) AS web_signal FROM {e}
  WHERE event_ts >= (SELECT max(event_ts) FROM {e}) - INTERVAL 30 DAY GROUP BY product_id"""


def fact(o: str, p: str, s: str, i: str, r: str, e: str) -> str:
    return f"""
  SELECT sa.product_id, sa.store_id, sa.sales_7d, sa.sales_30d,
         COALESCE(rv.avg_rating, CAST(0 AS DOUBLE)) AS avg_rating,
         CAST(COALESCE(inv.stock_qty, 0) AS BIGINT) AS stock_qty, pr.category, st.region,
         CAST(COALESCE(wb.web_signal, 0) AS BIGINT) AS web_signal,
         CAST((COALESCE(inv.stock_qty, 0) < {P.STOCK_THRESHOLD} AND sa.sales_7d > {P.DEMAND_THRESHOLD}) AS INTEGER)
           AS stockout_risk
  FROM ({sales(o)}) sa
  LEFT JOIN {i} inv ON sa.product_id = inv.product_id AND sa.store_id = inv.store_id
  LEFT JOIN {p} pr ON sa.product_id = pr.product_id
  LEFT JOIN {s} st ON sa.store_id = st.store_id
  LEFT JOIN ({reviews_agg(r)}) rv ON sa.product_id = rv.product_id
  LEFT JOIN ({web(e)}) wb ON sa.product_id = wb.product_id"""


# --- adapters --------------------------------------------------------------

OPENING = ("make_date(CAST(1990 + s_suppkey % 30 AS BIGINT), CAST(1 + s_suppkey % 12 AS BIGINT), "
           "CAST(1 + s_suppkey % 28 AS BIGINT))")

CTES = {
    # typed
    "t_orders": """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         CAST(l_shipdate AS TIMESTAMP) AS order_date, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS store_id,
         l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price,
         l_returnflag AS channel FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "t_products": """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS brand, CAST(NULL AS DOUBLE) AS cost_price, p_retailprice AS sale_price FROM part""",
    "geo": f"""
  SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name, {OPENING} AS od
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "t_stores": """
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name, n_name AS city,
         r_name AS region, CAST(od AS TIMESTAMP) AS opening_date FROM geo""",
    "t_inventory": """
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS store_id,
         CAST(l_quantity AS BIGINT) - 5 AS stock_qty, CAST(l_shipdate AS TIMESTAMP) AS last_update
  FROM lineitem""",
    "t_reviews": """
  SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS product_id,
         CAST(floor(value) AS BIGINT) AS rating, props AS comment, CAST(ts AS TIMESTAMP) AS review_date
  FROM events""",
    "t_events": """
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS product_id, event_type,
         CAST(ts AS TIMESTAMP) AS event_ts, 'web' AS source FROM events""",
    # raw, dirt injected
    "r_orders_b": """
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
         CASE WHEN l.l_orderkey % 17 = 0 THEN strftime(l.l_shipdate, '%d/%m/%Y')
              ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS order_date,
         CAST(o.o_custkey AS VARCHAR) AS customer_id, CAST(l.l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE CAST(l.l_suppkey AS VARCHAR) END AS store_id,
         CASE WHEN l.l_orderkey % 23 = 0 THEN CAST(-CAST(l.l_quantity AS INTEGER) AS VARCHAR)
              WHEN l.l_orderkey % 31 = 0 THEN ''
              WHEN l.l_orderkey % 37 = 0 THEN '0'
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CAST(l.l_extendedprice / l.l_quantity AS VARCHAR) AS unit_price,
         l.l_returnflag AS channel, l.l_orderkey AS _k
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "r_orders": """
  SELECT * EXCLUDE (_k) FROM r_orders_b UNION ALL SELECT * EXCLUDE (_k) FROM r_orders_b WHERE _k % 97 = 0""",
    "r_products_b": """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 7 = 0 THEN '  ' || upper(p_type) || ' '
              WHEN p_partkey % 11 = 0 THEN chr(9) || p_type || chr(10)
              ELSE p_type END AS category,
         CASE WHEN p_partkey % 13 = 0 THEN ' ' || upper(p_brand) ELSE p_brand END AS brand,
         CAST(NULL AS VARCHAR) AS cost_price, CAST(p_retailprice AS VARCHAR) AS sale_price,
         p_partkey AS _k FROM part""",
    "r_products": """
  SELECT * EXCLUDE (_k) FROM r_products_b
  UNION ALL SELECT product_id, product_name || ' (copy)', category, brand, cost_price, sale_price
  FROM r_products_b WHERE _k % 41 = 0""",
    "r_stores_b": f"""
  SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
         CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) || '  ' ELSE n_name END AS city,
         CASE WHEN s_suppkey % 4 = 0 THEN ' ' || lower(r_name) ELSE r_name END AS region,
         CASE WHEN s_suppkey % 17 = 0 THEN strftime(od, '%d/%m/%Y') ELSE strftime(od, '%Y-%m-%d') END
           AS opening_date, s_suppkey AS _k FROM geo""",
    "r_stores": """
  SELECT * EXCLUDE (_k) FROM r_stores_b
  UNION ALL SELECT store_id, store_name || ' (copy)', city, region, opening_date
  FROM r_stores_b WHERE _k % 19 = 0""",
    "r_inventory_b": """
  SELECT CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS store_id,
         CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) - 5 END AS stock_qty,
         CASE WHEN l_orderkey % 43 = 0 THEN 'unknown'
              ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS last_update,
         l_orderkey AS _k FROM lineitem""",
    "r_inventory": """
  SELECT * EXCLUDE (_k) FROM r_inventory_b
  UNION ALL SELECT * EXCLUDE (_k) FROM r_inventory_b WHERE _k % 97 = 0""",
    "r_reviews_b": """
  SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS product_id,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS rating,
         props AS comment, strftime(ts, '%Y-%m-%d') AS review_date, event_id AS _k FROM events""",
    "r_reviews": """
  SELECT * EXCLUDE (_k) FROM r_reviews_b
  UNION ALL SELECT review_id, product_id, rating, comment || ' (edited)', review_date
  FROM r_reviews_b WHERE _k % 89 = 0""",
    "r_events_b": """
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS product_id,
         CASE WHEN event_id % 7 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
         CASE WHEN event_id % 53 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_ts,
         CASE WHEN event_id % 3 = 0 THEN ' App ' ELSE 'web' END AS source, event_id AS _k FROM events""",
    "r_events": """
  SELECT * EXCLUDE (_k) FROM r_events_b
  UNION ALL SELECT event_id, product_id, event_type, event_ts, 'replay' FROM r_events_b WHERE _k % 89 = 0""",
    # cleaned typed
    "c_orders": clean_orders("t_orders", ISO, True),
    "c_products": clean_products("t_products"),
    "c_stores": clean_stores("t_stores", ISO, True),
    "c_inventory": clean_inventory("t_inventory", True),
    "c_reviews": clean_reviews("t_reviews", ISO, True),
    "c_events": clean_events("t_events", True),
    # cleaned raw
    "rc_orders": clean_orders("r_orders", ISO, False),
    "rc_orders_rep": clean_orders("r_orders", BOTH, False),
    "rc_products": clean_products("r_products"),
    "rc_stores": clean_stores("r_stores", ISO, False),
    "rc_stores_rep": clean_stores("r_stores", BOTH, False),
    "rc_inventory": clean_inventory("r_inventory", False),
    "rc_reviews": clean_reviews("r_reviews", ISO, False),
    "rc_events": clean_events("r_events", False),
    # the fact and its derivatives
    "fact": fact("c_orders", "c_products", "c_stores", "c_inventory", "c_reviews", "c_events"),
    "c_sales": sales("c_orders"),
    "split_plan": f"""
  WITH c AS (SELECT stockout_risk, COUNT(*) AS n_class FROM fact WHERE stockout_risk IS NOT NULL GROUP BY stockout_risk),
  t AS (SELECT COUNT(*) AS n_classes, MIN(n_class) AS minority_count, CAST(SUM(n_class) AS BIGINT) AS n_rows FROM c),
  s AS (SELECT *, CASE WHEN n_classes < 2 THEN CAST({P.DEFAULT_TEST_SIZE} AS DOUBLE)
                  ELSE least(greatest(CAST({P.DEFAULT_TEST_SIZE} AS DOUBLE),
                                      CAST({P.MIN_POSITIVE_IN_TEST} AS DOUBLE) / minority_count),
                             CAST({P.MAX_TEST_SIZE} AS DOUBLE)) END AS test_size,
               n_classes > 1 AND minority_count >= 2 AS stratified FROM t),
  w AS (SELECT *, CAST(ceil(round(CASE WHEN stratified THEN test_size ELSE {P.DEFAULT_TEST_SIZE} END * n_rows, 6))
                       AS BIGINT) AS want FROM s),
  r AS (SELECT c.*, w.*, (want * n_class) // n_rows AS low, (want * n_class) % n_rows AS rem FROM c, w)
  SELECT stockout_risk, n_class, n_rows, n_classes, minority_count, stratified, test_size,
         CASE WHEN stratified THEN least(greatest(low + CAST(row_number() OVER (ORDER BY rem DESC, stockout_risk)
                                                            <= want - SUM(low) OVER () AS BIGINT), 1), n_class - 1)
              ELSE greatest(least(want, n_rows - 1), 1) END AS quota
  FROM r""",
    "split_rows": f"""
  SELECT f.*, row_number() OVER (
           PARTITION BY CASE WHEN p.stratified THEN f.stockout_risk END
           ORDER BY substr(md5(concat_ws('|', f.product_id, f.store_id) || '-{P.SEED}'), 1, 8), f.product_id, f.store_id)
         <= p.quota AS is_test
  FROM fact f JOIN split_plan p ON f.stockout_risk = p.stockout_risk""",
    "scored": """
  SELECT *, CAST((stock_qty < 12 AND sales_7d > 4) AS INTEGER) AS prediction FROM split_rows WHERE is_test""",
    "cm": """
  SELECT g.stockout_risk, g.prediction, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
  FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(stockout_risk, prediction)
  LEFT JOIN (SELECT stockout_risk, prediction, COUNT(*) AS n FROM scored GROUP BY 1, 2) c
    ON g.stockout_risk = c.stockout_risk AND g.prediction = c.prediction""",
    # warehouse load (CL7-CL9)
    "l_orders": """
  SELECT order_id, order_date, customer_id, product_id, store_id,
         TRY_CAST(TRY_CAST(quantity AS DOUBLE) AS INTEGER) AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price, channel
  FROM (SELECT * FROM (SELECT DISTINCT * FROM r_orders)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_date NULLS FIRST,
          customer_id NULLS FIRST, product_id NULLS FIRST, store_id NULLS FIRST, quantity NULLS FIRST,
          unit_price NULLS FIRST, channel NULLS FIRST) = 1)""",
    "l_products": """
  SELECT product_id, product_name, category, brand, TRY_CAST(cost_price AS DOUBLE) AS cost_price,
         TRY_CAST(sale_price AS DOUBLE) AS sale_price
  FROM (""" + first_by("r_products", "product_id",
                       ["product_name", "category", "brand", "cost_price", "sale_price"]) + ")",
    "l_stores": first_by("r_stores", "store_id", ["store_name", "city", "region", "opening_date"]),
    "l_inventory": clean_inventory("r_inventory", False, clip=False),
}

PRELUDE = "WITH\n" + ",\n".join(f"{name} AS ({body}\n)" for name, body in CTES.items()) + "\n"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _quality_row(name: str, src: str, ncols: int, keys: list[str]) -> str:
    cols = ["order_id", "product_id", "store_id", "review_id", "event_id"]
    nulls = ", ".join(
        (f"CAST(COUNT_IF({c} IS NULL) AS BIGINT)" if c in keys else "CAST(NULL AS BIGINT)") + f" AS null_{c}" for c in cols)
    return (f"SELECT '{name}' AS dataset, COUNT(*) AS \"rows\", CAST({ncols} AS BIGINT) AS \"columns\", "
            f"CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {src})) AS BIGINT) AS duplicates, "
            f"{nulls} FROM {src}")


_FACT_COLS = P.FACT_COLUMNS


def _final_check() -> str:
    parts = ["SELECT 'rows' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", COUNT(*) AS \"value\" FROM fact",
             f"SELECT 'columns', CAST(NULL AS VARCHAR), CAST({len(_FACT_COLS)} AS BIGINT)"]
    parts += [f"SELECT 'nulls', '{c}', CAST(COUNT_IF({c} IS NULL) AS BIGINT) FROM fact" for c in _FACT_COLS]
    parts.append("SELECT 'duplicate_keys', 'product_id,store_id', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
                 "FROM (SELECT COUNT(*) AS n FROM fact GROUP BY product_id, store_id)")
    parts.append("SELECT 'label_distribution', CAST(stockout_risk AS VARCHAR), COUNT(*) FROM fact "
                 "GROUP BY stockout_risk")
    return _union(parts)


def _fk(name: str, child: str, key: str, parent: str, every: int) -> str:
    renamed = f"CASE WHEN TRY_CAST({key} AS BIGINT) % {every} = 0 THEN 'gone-' || {key} ELSE {key} END"
    return (f"SELECT '{name}' AS fk_name, COUNT(*) AS orphan_keys, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS orphan_rows "
            f"FROM (SELECT {renamed} AS k, COUNT(*) AS n FROM {child} x WHERE {key} IS NOT NULL GROUP BY 1) c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.k)")


def _report() -> str:
    per = """(SELECT c, support, predicted, tp, precision, recall,
               CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall)
                    ELSE CAST(0 AS DOUBLE) END AS f1_score
             FROM (SELECT c, support, predicted, tp,
                     CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE)
                          ELSE CAST(0 AS DOUBLE) END AS precision,
                     CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / CAST(support AS DOUBLE)
                          ELSE CAST(0 AS DOUBLE) END AS recall
                   FROM (SELECT l.c, l.support, p.predicted, t.tp
                         FROM (SELECT stockout_risk AS c, SUM(n) AS support FROM cm GROUP BY 1) l
                         JOIN (SELECT prediction AS c, SUM(n) AS predicted FROM cm GROUP BY 1) p ON l.c = p.c
                         JOIN (SELECT stockout_risk AS c, n AS tp FROM cm WHERE stockout_risk = prediction) t
                           ON l.c = t.c)))"""
    return _union([
        f"SELECT CAST(c AS VARCHAR) AS class_label, precision, recall, f1_score, "
        f"CAST(support AS BIGINT) AS support FROM {per}",
        f"SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
        f"CASE WHEN SUM(support) > 0 THEN CAST(SUM(tp) AS DOUBLE) / CAST(SUM(support) AS DOUBLE) "
        f"ELSE CAST(0 AS DOUBLE) END, CAST(SUM(support) AS BIGINT) FROM {per}",
        f"SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), CAST(SUM(support) AS BIGINT) FROM {per}",
        "SELECT 'weighted avg', " + ", ".join(
            f"CASE WHEN SUM(support) > 0 THEN SUM({m} * support) / CAST(SUM(support) AS DOUBLE) "
            f"ELSE CAST(0 AS DOUBLE) END" for m in ("precision", "recall", "f1_score"))
        + f", CAST(SUM(support) AS BIGINT) FROM {per}",
    ])


def _preview() -> str:
    columns = {"dim_product": "product_id,product_name,category,brand,cost_price,sale_price",
               "dim_store": "store_id,store_name,city,region,opening_date",
               "fact_orders": "order_id,order_date,customer_id,product_id,store_id,quantity,unit_price,channel",
               "fact_inventory": "product_id,store_id,stock_qty,last_update", "fact_stock_risk": ",".join(P.FACT_COLUMNS)}

    def one(name, src, keys):
        key = f"concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)})"
        order = ", ".join(f"{k} ASC NULLS FIRST" for k in keys)
        row = ", ".join(f"'{c}': CAST({c} AS VARCHAR)" for c in columns[name].split(","))
        return (f"SELECT * FROM (SELECT '{name}' AS table_name, {key} AS row_key, "
                f"CAST(to_json({{{row}}}) AS VARCHAR) AS \"row\" FROM {src} ORDER BY {order} LIMIT 5)")
    return _union([one("dim_product", "l_products", ["product_id"]),
                   one("dim_store", "l_stores", ["store_id"]),
                   one("fact_orders", "l_orders", ["order_id", "order_date", "product_id", "store_id"]),
                   one("fact_inventory", "l_inventory", ["product_id", "store_id"]),
                   one("fact_stock_risk", RAW_FACT, ["product_id", "store_id"])])


RAW_FACT = "(" + fact("rc_orders", "rc_products", "rc_stores", "rc_inventory", "rc_reviews", "rc_events") + ")"


def _row_counts(*more: tuple[str, str]) -> str:
    return _union([f"SELECT '{n}' AS table_name, COUNT(*) AS \"rows\" FROM {s}" for n, s in
                   [("dim_product", "l_products"), ("dim_store", "l_stores"), ("fact_orders", "l_orders"),
                    ("fact_inventory", "l_inventory"), ("fact_stock_risk", RAW_FACT), *more]])


def _spoiled(column: str, every: int, value: str) -> str:
    return f"CASE WHEN TRY_CAST(product_id AS BIGINT) % {every} = 0 THEN {value} ELSE {column} END"


def _profile() -> str:
    cols = {
        "orders": "order_id,order_date,customer_id,product_id,store_id,quantity,unit_price,channel",
        "products": "product_id,product_name,category,brand,cost_price,sale_price",
        "stores": "store_id,store_name,city,region,opening_date",
        "inventory": "product_id,store_id,stock_qty,last_update",
        "reviews": "review_id,product_id,rating,comment,review_date",
        "events": "event_id,product_id,event_type,event_ts,source",
    }
    return _union([f"SELECT '{n}' AS dataset, COUNT(*) AS \"rows\", CAST({len(c.split(','))} AS BIGINT) "
                   f"AS \"columns\", '{c}' AS column_list FROM r_{n}" for n, c in cols.items()])


_RAW_ORDER_COLS = ["order_id", "order_date", "customer_id", "product_id", "store_id",
                   "quantity", "unit_price", "channel"]
_LI_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]

FINAL: dict[str, str] = {
    # C
    "dedupe_exact": "SELECT DISTINCT * FROM r_orders",
    "dedupe_exact_by_hash": "SELECT DISTINCT * FROM r_orders",
    "dedupe_by_key_first": first_by("lineitem", "l_orderkey, l_linenumber", _LI_COLS),
    "latest_per_key": first_by("t_inventory", "product_id, store_id", ["last_update", "stock_qty"], latest=True),
    "parse_dates_iso": f"SELECT order_id, {parse_ts('order_date', ISO, False)} AS order_date FROM r_orders",
    "parse_dates_multi": f"SELECT order_id, {parse_ts('order_date', BOTH, False)} AS order_date FROM r_orders",
    "parse_numeric": "SELECT order_id, TRY_CAST(quantity AS DOUBLE) AS quantity, "
                     "TRY_CAST(unit_price AS DOUBLE) AS unit_price FROM r_orders",
    "drop_null_keys": "SELECT * FROM r_orders WHERE order_id IS NOT NULL AND product_id IS NOT NULL "
                      "AND store_id IS NOT NULL",
    "filter_positive": "SELECT * FROM (SELECT order_id, TRY_CAST(quantity AS DOUBLE) AS quantity FROM r_orders) "
                       "WHERE quantity > 0",
    "filter_range": f"SELECT * FROM r_reviews WHERE rating BETWEEN {P.RATING_MIN} AND {P.RATING_MAX}",
    "filter_membership": f"SELECT * FROM t_events WHERE event_type IN ({EV})",
    "normalize_text": f"SELECT product_id, {norm('product_name')} AS product_name, {norm('category')} AS category, "
                      f"{norm('brand')} AS brand, cost_price, sale_price FROM r_products",
    "fill_defaults": "SELECT product_id, store_id, COALESCE(stock_qty, 0) AS stock_qty, last_update FROM r_inventory",
    "clip_lower": "SELECT product_id, store_id, CASE WHEN COALESCE(stock_qty, 0) < 0 THEN 0 "
                  "ELSE COALESCE(stock_qty, 0) END AS stock_qty, last_update FROM r_inventory",
    "clean_orders": "SELECT * FROM rc_orders",
    "clean_orders_repaired": "SELECT * FROM rc_orders_rep",
    "clean_products": "SELECT * FROM rc_products",
    "clean_stores": "SELECT * FROM rc_stores_rep",
    "clean_inventory": "SELECT * FROM rc_inventory",
    "clean_reviews": "SELECT * FROM rc_reviews",
    "clean_events": "SELECT * FROM rc_events",
    "load_orders": "SELECT * FROM l_orders",
    "load_inventory_unclipped": "SELECT * FROM l_inventory",
    "load_products": "SELECT * FROM l_products",
    # A / J1
    "sales_two_horizons": "SELECT * FROM c_sales",
    "sales_outer_merge": "SELECT * FROM c_sales",
    "review_features": reviews_agg("c_reviews"),
    "web_signal": web("c_events"),
    "value_distribution": "SELECT event_type, COUNT(*) AS \"count\" FROM t_events GROUP BY event_type",
    "group_mean": "SELECT store_id, AVG(CAST(quantity AS DOUBLE)) AS mean_quantity FROM c_orders GROUP BY store_id",
    "having_duplicates": "SELECT order_id, COUNT(*) AS nb FROM t_orders GROUP BY order_id HAVING COUNT(*) > 1",
    "distinct_count": "SELECT COUNT(DISTINCT product_id) AS nunique_product_id FROM c_orders",
    "minority_count": "SELECT COUNT(*) AS n_classes, MIN(n) AS minority_count FROM "
                      "(SELECT stockout_risk, COUNT(*) AS n FROM fact WHERE stockout_risk IS NOT NULL GROUP BY 1)",
    "duplicate_row_count": "SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates FROM "
                           f"(SELECT COUNT(*) AS n FROM r_orders GROUP BY {', '.join(_RAW_ORDER_COLS)})",
    "null_counts": "SELECT " + ", ".join(f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS null_{c}" for c in _RAW_ORDER_COLS)
                   + " FROM r_orders",
    # J / D
    "join_stock": "SELECT s.*, i.stock_qty FROM c_sales s LEFT JOIN c_inventory i "
                  "ON s.product_id = i.product_id AND s.store_id = i.store_id",
    "join_product": "SELECT s.*, p.category FROM c_sales s LEFT JOIN c_products p ON s.product_id = p.product_id",
    "join_store": "SELECT s.*, t.region FROM c_sales s LEFT JOIN c_stores t ON s.store_id = t.store_id",
    "join_reviews": f"SELECT s.*, r.avg_rating FROM c_sales s LEFT JOIN ({reviews_agg('c_reviews')}) r "
                    "ON s.product_id = r.product_id",
    "join_web": f"SELECT s.*, w.web_signal FROM c_sales s LEFT JOIN ({web('c_events')}) w "
                "ON s.product_id = w.product_id",
    "fk_orphans": _union([
        _fk(f"{table}.{key}", src, key, parent, every)
        for table, src in (("fact_orders", "l_orders"), ("fact_inventory", "l_inventory"), ("fact_events", "rc_events"),
                           ("agg_reviews", f"({reviews_agg('rc_reviews')})"),
                           ("fact_stock_risk", "(" + fact("rc_orders", "rc_products", "rc_stores", "rc_inventory",
                                                          "rc_reviews", "rc_events") + ")"))
        for key, parent, every in (("product_id", "l_products", 31), ("store_id", "l_stores", 7))
        if key == "product_id" or table not in ("fact_events", "agg_reviews")]),
    "stockout_flag": f"""SELECT s.product_id, s.store_id, CAST(COALESCE(i.stock_qty, 0) AS BIGINT) AS stock_qty,
        s.sales_7d, CAST((COALESCE(i.stock_qty, 0) < {P.STOCK_THRESHOLD} AND s.sales_7d > {P.DEMAND_THRESHOLD})
        AS INTEGER) AS stockout_risk
        FROM c_sales s LEFT JOIN c_inventory i ON s.product_id = i.product_id AND s.store_id = i.store_id""",
    "fact_stock_risk": "SELECT * FROM fact",
    "fact_stock_risk_raw": fact("rc_orders", "rc_products", "rc_stores", "rc_inventory", "rc_reviews", "rc_events"),
    "fact_stock_risk_repaired": fact("rc_orders_rep", "rc_products", "rc_stores_rep", "rc_inventory",
                                     "rc_reviews", "rc_events"),
    # E / Q / V
    "quality_summary": _union([_quality_row("orders", "rc_orders", 8, P.QUALITY_KEYS["orders"]),
                               _quality_row("products", "rc_products", 6, P.QUALITY_KEYS["products"]),
                               _quality_row("stores", "rc_stores", 5, P.QUALITY_KEYS["stores"]),
                               _quality_row("inventory", "rc_inventory", 4, P.QUALITY_KEYS["inventory"]),
                               _quality_row("reviews", "rc_reviews", 5, P.QUALITY_KEYS["reviews"]),
                               _quality_row("events", "rc_events", 5, P.QUALITY_KEYS["events"])]),
    "final_table_check": _final_check(),
    "pk_violations": "SELECT order_id, COUNT(*) AS nb FROM t_orders GROUP BY order_id HAVING COUNT(*) > 1",
    "domain_check": "SELECT 'stockout_risk' AS \"column\", "
                    f"CAST(COUNT_IF(v NOT IN (0, 1) AND v IS NOT NULL) AS BIGINT) AS invalid_rows FROM "
                    f"(SELECT {_spoiled('stockout_risk', 31, '2')} AS v FROM fact)",
    "non_negative_check": _union([f"SELECT '{c}' AS \"column\", CAST(COUNT_IF({_spoiled(c, every, f'-1 - {c}')} < 0) AS BIGINT) "
                                  "AS negative_rows FROM fact"
                                  for c, every in (("sales_7d", 7), ("sales_30d", 11), ("stock_qty", 13), ("web_signal", 17))]),
    "table_row_counts": _row_counts(),
    "table_preview": _preview(),
    "order_duplicates": "SELECT order_id, COUNT(*) AS nb FROM r_orders GROUP BY order_id HAVING COUNT(*) > 1",
    "order_null_counts": "SELECT CAST(COUNT_IF(product_id IS NULL) AS BIGINT) AS null_product_id, "
                         "CAST(COUNT_IF(store_id IS NULL) AS BIGINT) AS null_store_id, "
                         "CAST(COUNT_IF(order_date IS NULL) AS BIGINT) AS null_order_date FROM l_orders",
    "fact_preview": "SELECT * FROM fact ORDER BY product_id, store_id LIMIT 10",
    "risk_distribution": "SELECT stockout_risk, COUNT(*) AS nb FROM fact GROUP BY stockout_risk ORDER BY stockout_risk",
    "fact_duplicates": "SELECT product_id, store_id, COUNT(*) AS nb FROM (SELECT * FROM fact UNION ALL "
                       "SELECT * FROM fact WHERE stockout_risk = 1) GROUP BY product_id, store_id HAVING COUNT(*) > 1",
    "region_avg_sales": "SELECT region, CAST((200 * SUM(sales_30d) + COUNT(sales_30d)) // (2 * COUNT(sales_30d)) "
                        "AS DOUBLE) / CAST(100 AS DOUBLE) AS avg_sales_30d FROM fact GROUP BY region "
                        "ORDER BY avg_sales_30d DESC",
    "at_risk_rows": "SELECT product_id, store_id, stock_qty, sales_7d, stockout_risk FROM fact "
                    "WHERE stockout_risk = 1 ORDER BY sales_7d DESC, stock_qty ASC",
    "chart_risk": "SELECT stockout_risk, COUNT(*) AS \"count\" FROM fact WHERE stockout_risk IS NOT NULL "
                  "GROUP BY stockout_risk ORDER BY 2 DESC",
    "chart_points": "SELECT sales_7d, stock_qty, COUNT(*) AS n FROM fact GROUP BY sales_7d, stock_qty",
    "chart_region": "SELECT region, AVG(CAST(sales_30d AS DOUBLE)) AS mean_sales_30d FROM fact "
                    "WHERE region IS NOT NULL GROUP BY region ORDER BY 2",
    # M
    "label_encode": _union([
        f"SELECT '{c}' AS \"column\", {c} AS \"value\", CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) "
        f"AS \"index\" FROM (SELECT DISTINCT {c} FROM fact WHERE {c} IS NOT NULL)" for c in ("category", "region")]),
    "choose_test_size": "SELECT DISTINCT CAST(n_classes AS BIGINT) AS n_classes, "
                        "CAST(minority_count AS BIGINT) AS minority_count, stratified, test_size FROM "
                        "split_plan",
    "stratified_split": "SELECT * FROM split_rows",
    "class_weights": "SELECT stockout_risk, n_class, CAST(SUM(n_class) OVER () AS DOUBLE) / "
                     "CAST(COUNT(*) OVER () * n_class AS DOUBLE) AS weight FROM "
                     "(SELECT stockout_risk, COUNT(*) AS n_class FROM split_rows "
                     "WHERE NOT is_test GROUP BY stockout_risk)",
    "accuracy": "SELECT AVG(CAST(stockout_risk = prediction AS DOUBLE)) AS accuracy, COUNT(*) AS n FROM scored",
    "confusion_matrix": "SELECT * FROM cm",
    "classification_report": _report(),
    "train_forest_support": "SELECT CAST(stockout_risk AS VARCHAR) AS class_label, COUNT(*) AS support "
                            "FROM split_rows WHERE is_test GROUP BY 1 UNION ALL "
                            "SELECT 'matrix', COUNT(*) FROM split_rows WHERE is_test",
    "training_log": "SELECT CAST(stockout_risk AS VARCHAR) || ':support' AS metric, CAST(COUNT(*) AS DOUBLE) AS \"value\" "
                    "FROM split_rows WHERE is_test GROUP BY stockout_risk UNION ALL SELECT m, CASE WHEN z THEN 0 ELSE n END "
                    "FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM split_rows WHERE is_test), (VALUES "
                    "('macro avg:support', FALSE), ('weighted avg:support', FALSE), ('matrix', FALSE), ('n_rows', FALSE), "
                    "('accuracy_off', TRUE), ('n_differ', TRUE)) AS m(m, z)",
    "class_distribution": "SELECT 'all' AS \"split\", stockout_risk, COUNT(*) AS n FROM "
                          "split_rows GROUP BY stockout_risk UNION ALL "
                          "SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END, stockout_risk, COUNT(*) FROM "
                          "split_rows GROUP BY 1, 2",
    # S / K
    "csv_round_trip": "SELECT * FROM lineitem",
    "json_array_round_trip": "SELECT * FROM r_events",
    "jsonl_round_trip": "SELECT * FROM r_events",
    "corrupt_quarantine": "SELECT 'parsed' AS status, COUNT(*) AS \"rows\", COUNT(DISTINCT event_id) AS ids "
                          "FROM events WHERE event_id % 53 <> 0 UNION ALL "
                          "SELECT 'corrupt', COUNT(*), CAST(0 AS BIGINT) FROM events WHERE event_id % 53 = 0",
    "source_status": _union([
        "SELECT 'good' AS dataset, 'csv' AS format, 'ok' AS status, COUNT(*) AS parsed, CAST(0 AS BIGINT) AS corrupt, "
        "false AS has_error FROM r_orders",
        "SELECT 'lines', 'jsonl', 'ok', COUNT_IF(CAST(event_id AS BIGINT) % 53 <> 0), "
        "COUNT_IF(CAST(event_id AS BIGINT) % 53 = 0), false FROM r_events",
        # a broken array is a failed dataset: its records are not there to be counted
        "SELECT 'array', 'json', 'error', 0, 1, true", "SELECT 'arrays', 'json', 'error', COUNT(*), 1, true FROM r_events",
        "SELECT 'typed', 'json', 'ok', COUNT(*), 0, false FROM r_inventory", "SELECT 'blank', 'json', 'error', 0, 1, true",
        "SELECT 'gzip', 'csv', 'error', NULL, NULL, true",
        "SELECT 'missing', 'csv', 'error', NULL, NULL, true",
        "SELECT 'after', 'jsonl', 'ok', COUNT(*), 0, false FROM r_reviews"]),
    "read_profile": _profile(),
    "overwrite_reload": _row_counts(),
    "run_log": "SELECT '0042' AS run_id, 'etl' AS step, 'rows_written' AS metric, CAST(COUNT(*) AS DOUBLE) AS \"value\" FROM fact",
    "landing_stream": "SELECT *, (SELECT COUNT_IF(CAST(event_id AS BIGINT) % 53 = 0) FROM r_events) AS n_malformed "
                      "FROM r_events WHERE CAST(event_id AS BIGINT) % 53 <> 0",
    "ingest_round_trip": _profile(),
    "etl_run_fact": fact("rc_orders", "rc_products", "rc_stores", "rc_inventory", "rc_reviews", "rc_events"),
    "fact_partitioned_round_trip": "SELECT * REPLACE (CASE region WHEN 'ASIA' THEN '01' WHEN 'EUROPE' THEN '7' "
                                   "ELSE region END AS region) FROM fact",
    "required_columns": _union([f"SELECT 'fact_stock_risk' AS dataset, '{c}' AS \"column\", {c != 'missing_column'} AS present"
                                for c in [*P.FACT_COLUMNS, "missing_column"]]),
    "warehouse_sql_row_counts": _row_counts(("fact_events", "rc_events"),
                                            ("agg_reviews", f"({reviews_agg('rc_reviews')})")),
    "warehouse_statements": _union([
        "SELECT 'order_duplicates' AS statement, order_id AS \"key\", CAST(COUNT(*) AS DOUBLE) AS \"value\" FROM l_orders "
        "GROUP BY order_id HAVING COUNT(*) > 1",
        *(f"SELECT 'order_null_counts', '{c}', CAST(COUNT(*) - COUNT({c}) AS DOUBLE) FROM l_orders"
          for c in ("product_id", "store_id", "order_date")),
        f"SELECT 'risk_distribution', CAST(stockout_risk AS VARCHAR), CAST(COUNT(*) AS DOUBLE) FROM {RAW_FACT} GROUP BY stockout_risk",
        f"SELECT 'fact_duplicates', product_id || '|' || store_id, CAST(COUNT(*) AS DOUBLE) FROM {RAW_FACT} "
        "GROUP BY product_id, store_id HAVING COUNT(*) > 1",
        "SELECT 'region_avg_sales', region, CAST((200 * SUM(sales_30d) + COUNT(sales_30d)) // (2 * COUNT(sales_30d)) "
        f"AS DOUBLE) / CAST(100 AS DOUBLE) FROM {RAW_FACT} GROUP BY region",
        "SELECT 'at_risk_rows', product_id || '|' || store_id || '|' || CAST(stock_qty AS VARCHAR), CAST(sales_7d AS DOUBLE) "
        f"FROM {RAW_FACT} WHERE stockout_risk = 1"]),
    "time_anchors": "SELECT 'orders' AS clock, max(order_date) AS anchor FROM c_orders UNION ALL "
                    "SELECT 'events', max(event_ts) FROM c_events",
    "trailing_window": "SELECT * FROM c_orders WHERE order_date >= "
                       f"(SELECT max(order_date) FROM c_orders) - INTERVAL {P.LONG_WINDOW_DAYS} DAY",
    "encoded_features": """SELECT f.sales_7d, f.sales_30d, f.avg_rating, f.stock_qty,
        CAST(COALESCE(c.idx, (SELECT COUNT(DISTINCT category) FROM fact)) AS DOUBLE) AS category_idx,
        CAST(COALESCE(r.idx, (SELECT COUNT(DISTINCT region) FROM fact)) AS DOUBLE) AS region_idx,
        f.web_signal, f.stockout_risk
      FROM fact f
      LEFT JOIN (SELECT category AS v, dense_rank() OVER (ORDER BY category) - 1 AS idx
                 FROM (SELECT DISTINCT category FROM fact WHERE category IS NOT NULL)) c ON f.category = c.v
      LEFT JOIN (SELECT region AS v, dense_rank() OVER (ORDER BY region) - 1 AS idx
                 FROM (SELECT DISTINCT region FROM fact WHERE region IS NOT NULL)) r ON f.region = r.v
      WHERE f.stockout_risk IS NOT NULL""",
}
FINAL["etl_final_check"] = _final_check().replace("FROM fact", "FROM (" + FINAL["etl_run_fact"] + ")")
FINAL["etl_run_quality"] = FINAL["quality_summary"]
# other ways to the same tables
FINAL["sales_from_daily"] = FINAL["sales_two_horizons"]
FINAL["web_signal_from_daily"] = FINAL["web_signal"]
FINAL["fact_colocated"] = FINAL["fact_stock_risk"]


def oracle_sql() -> dict[str, str]:
    return {name: PRELUDE + final for name, final in FINAL.items()}
