"""Registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the whole driver tables.

Naming follows the inventory keys.  ``typed`` inputs are the curated driver
tables mapped to the retail sources; ``raw`` inputs are the same rows as text
with deterministic dirt (see ``sources.adapters``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import params as P
from .operators import aggregate as A
from .operators import clean as C
from .operators import duplicates as D
from .operators import joins as J
from .operators import ml as M
from .operators import quality as E
from .operators import rollup as R
from .plans import marts as Q
from .plans.colocated import fact_from_pairs, forget, store_pairs
from .plans.etl import clean_sources, fact_from_clean, materialize, without_time_partitions
from .plans.fact import add_stockout_flag
from .plans.statements import declared, run_statements
from .plans.training import reload_differences, run_training
from .plans.warehouse import load_tables, run_load
from .schemas import RAW_EVENTS
from .session import scratch_path, scratch_root, tune
from .sources import adapters as AD
from .sources import files as S
from . import schemas as SCHEMAS
from .plans.etl import run_etl_files
from .sources.reload import current_paths, read_current, reload_tables, stage
from .sources.sinks import append_run_log, create_tables, drop_tables, land, read_fact, read_run_log, write_fact
from .streaming.landing import land_incremental, read_landed, read_malformed

Query = Callable[[SparkSession, str], DataFrame]
EV = P.DRIVER_EVENT_TYPES
BOTH_DATES = (P.ISO_DATE, P.DAY_FIRST_DATE)


# --- shared inputs -----------------------------------------------------------

def typed_clean(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return clean_sources(AD.typed_sources(spark, sf), valid_event_types=EV)


def fact(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    return fact_from_clean(typed_clean(spark, sf))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return A.sales_two_horizons(typed_clean(spark, sf)["orders"])


def fact_checkpointed(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with its lineage cut (reliable checkpoint in the shared
    checkpoint folder), for queries that read it more than once."""
    scratch_root(spark)
    return fact(spark, sf).checkpoint()


def split(spark: SparkSession, sf: str, **kw) -> DataFrame:
    data, _, _ = M.prepare_features(fact_checkpointed(spark, sf))
    return M.stratified_split(data, **kw)


def rule_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows scored by a fixed rule (stock under 12 and 7-day sales over
    4), so the metric operators can be checked against SQL independently of
    the forest."""
    test = split(spark, sf).filter(F.col("is_test"))
    return test.withColumn("prediction", ((F.col("stock_qty") < 12) & (F.col("sales_7d") > 4)).cast("int"))


def raw_clean(spark: SparkSession, sf: str, formats=(P.ISO_DATE,)) -> dict[str, DataFrame]:
    return clean_sources(AD.raw_sources(spark, sf), formats, EV)


def landed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The raw orders as files (K1), for what reads them more than once: they come
    of a join of the two largest tables."""
    return spark.read.parquet(land({"orders": AD.raw_orders(spark, sf)}, scratch_path(spark, "landed"))["orders"])


# --- C: cleaning operators ----------------------------------------------------

def q_dedupe_exact(spark, sf):
    return C.dedupe_exact(AD.raw_orders(spark, sf))


def q_dedupe_exact_by_hash(spark, sf):
    """C1 by row hash: whole rows are shuffled only where a hash repeats."""
    return D.dedupe_exact_by_hash(landed_orders(spark, sf))


def q_dedupe_by_key_first(spark, sf):
    return C.dedupe_by_key_first(AD.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_latest_per_key(spark, sf):
    return C.latest_per_key(AD.typed_inventory(spark, sf), ["product_id", "store_id"],
                            ["last_update", "stock_qty"])


def q_parse_dates_iso(spark, sf):
    return (AD.raw_orders(spark, sf).select("order_id", "order_date")
            .transform(C.parse_timestamps, "order_date", (P.ISO_DATE,)))


def q_parse_dates_multi(spark, sf):
    return (AD.raw_orders(spark, sf).select("order_id", "order_date")
            .transform(C.parse_timestamps, "order_date", BOTH_DATES))


def q_parse_numeric(spark, sf):
    return (AD.raw_orders(spark, sf).select("order_id", "quantity", "unit_price")
            .transform(C.parse_doubles, ["quantity", "unit_price"]))


def q_drop_null_keys(spark, sf):
    return C.drop_null_keys(AD.raw_orders(spark, sf), ["order_id", "product_id", "store_id"])


def q_filter_positive(spark, sf):
    return (AD.raw_orders(spark, sf).select("order_id", "quantity")
            .transform(C.parse_doubles, ["quantity"]).transform(C.filter_positive, "quantity"))


def q_filter_range(spark, sf):
    return C.filter_range(AD.raw_reviews(spark, sf), "rating", P.RATING_MIN, P.RATING_MAX)


def q_filter_membership(spark, sf):
    return C.filter_membership(AD.typed_events(spark, sf), "event_type", EV)


def q_normalize_text(spark, sf):
    return C.normalize_text(AD.raw_products(spark, sf), ["category", "brand", "product_name"])


def q_fill_defaults(spark, sf):
    return C.fill_defaults(AD.raw_inventory(spark, sf), {"stock_qty": 0})


def q_clip_lower(spark, sf):
    return (AD.raw_inventory(spark, sf).transform(C.fill_defaults, {"stock_qty": 0})
            .transform(C.clip_columns, ["stock_qty"], 0))


def q_clean_orders(spark, sf):
    return C.clean_orders(AD.raw_orders(spark, sf))


def q_clean_orders_repaired(spark, sf):
    return C.clean_orders(AD.raw_orders(spark, sf), BOTH_DATES)


def q_clean_products(spark, sf):
    return C.clean_products(AD.raw_products(spark, sf))


def q_clean_stores(spark, sf):
    return C.clean_stores(AD.raw_stores(spark, sf), BOTH_DATES)


def q_clean_inventory(spark, sf):
    return C.clean_inventory(AD.raw_inventory(spark, sf))


def q_clean_reviews(spark, sf):
    return C.clean_reviews(AD.raw_reviews(spark, sf))


def q_clean_events(spark, sf):
    return C.clean_events(AD.raw_events(spark, sf), EV)


def raw_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact of the raw feed, from which the warehouse's other tables come too."""
    return fact_from_clean(raw_clean(spark, sf))


def _load(spark, sf):
    return load_tables(AD.raw_sources(spark, sf), raw_fact(spark, sf))


def _feed(spark, sf):
    """(raw, clean, inventory) of the raw feed, with what is used more than once
    stored once: the raw orders (K1), the loaded inventory (CL8), of which the
    cleaned one (CL4) is made, and the cleaned events, read for their clock too."""
    raw = {**AD.raw_sources(spark, sf), "orders": landed_orders(spark, sf)}
    cl = clean_sources(raw, valid_event_types=EV)
    stored = materialize(spark, {"events": cl["events"], "inventory": C.load_inventory(raw["inventory"])}, "feed")
    return raw, {**cl, "events": stored["events"], "inventory": C.fill_stock(stored["inventory"])}, stored["inventory"]


def _warehouse(spark, sf):
    """K5: the five tables loaded into the shared scratch folder and read
    back, as the SQL checks run against the loaded warehouse."""
    raw, cl, inventory = _feed(spark, sf)
    return run_load(spark, raw, fact_from_clean(cl), scratch_path(spark, "warehouse"), inventory=inventory)


def q_load_orders(spark, sf):
    return _load(spark, sf)["fact_orders"]


def q_load_inventory_unclipped(spark, sf):
    return _load(spark, sf)["fact_inventory"]


def q_load_products(spark, sf):
    return _load(spark, sf)["dim_product"]


# --- A / J1: aggregations ---------------------------------------------------

def q_sales_two_horizons(spark, sf):
    return sales(spark, sf)


def q_sales_outer_merge(spark, sf):
    return A.sales_outer_merge(typed_clean(spark, sf)["orders"])


def _daily(spark, df, ts, keys, value=None):
    """Daily sums of a table that came in two batches, the second one twice."""
    daily = R.DailySums(spark, scratch_path(spark, "daily"), [df.schema[k] for k in keys], ts, value, "month")
    since = df.agg((F.max(ts) - F.make_dt_interval(F.lit(12))).alias("t")).first()["t"]
    daily.add(df.filter(F.col(ts) < F.lit(since)), "first")
    for _ in range(2):
        daily.add(df.filter(F.col(ts) >= F.lit(since)), "second")
    return daily


def q_sales_from_daily(spark, sf):
    """A2 + A4 from daily sums that two batches maintained."""
    daily = _daily(spark, typed_clean(spark, sf)["orders"], "order_date", P.ID_COLUMNS, "quantity")
    return daily.windows({"sales_30d": P.LONG_WINDOW_DAYS, "sales_7d": P.SHORT_WINDOW_DAYS}).drop("n_rows")


def q_web_signal_from_daily(spark, sf):
    """A6 from daily counts that two batches maintained."""
    daily = _daily(spark, typed_clean(spark, sf)["events"], "event_ts", ["product_id"])
    return daily.windows({"web_signal": P.LONG_WINDOW_DAYS}).drop("n_rows")


def q_review_features(spark, sf):
    return A.review_features(typed_clean(spark, sf)["reviews"])


def q_web_signal(spark, sf):
    return A.web_signal(typed_clean(spark, sf)["events"])


def q_value_distribution(spark, sf):
    return A.value_counts(AD.typed_events(spark, sf), "event_type", dropna=False)


def q_group_mean(spark, sf):
    return A.group_mean(typed_clean(spark, sf)["orders"], "store_id", "quantity", "mean_quantity")


def q_having_duplicates(spark, sf):
    return A.having_duplicates(AD.typed_orders(spark, sf), ["order_id"], "nb")


def q_distinct_count(spark, sf):
    return A.distinct_count(typed_clean(spark, sf)["orders"], "product_id", "nunique_product_id")


def q_minority_count(spark, sf):
    return A.minority_count(fact(spark, sf), P.LABEL)


def q_duplicate_row_count(spark, sf):
    found = D.duplicate_profile(landed_orders(spark, sf))
    return spark.createDataFrame([(found["duplicates"],)], "duplicates long")


def q_null_counts(spark, sf):
    return A.null_counts(AD.raw_orders(spark, sf))


# --- J / D: joins and the fact -------------------------------------------------

def q_join_stock(spark, sf):
    return J.join_stock(sales(spark, sf), typed_clean(spark, sf)["inventory"])


def q_join_product(spark, sf):
    return J.join_product(sales(spark, sf), typed_clean(spark, sf)["products"])


def q_join_store(spark, sf):
    return J.join_store(sales(spark, sf), typed_clean(spark, sf)["stores"])


def q_join_reviews(spark, sf):
    cl = typed_clean(spark, sf)
    return J.join_reviews(A.sales_two_horizons(cl["orders"]), A.review_features(cl["reviews"]))


def q_join_web(spark, sf):
    cl = typed_clean(spark, sf)
    return J.join_web(A.sales_two_horizons(cl["orders"]), A.web_signal(cl["events"]))


def _all_tables(spark, sf):
    """The seven warehouse tables of one feed: the raw sources and what is cleaned
    from them, once, into a landed layer that the fact, events and reviews share."""
    raw, cl, inventory = _feed(spark, sf)
    rest = {k: cl[k] for k in ("products", "stores", "reviews")}
    rest["orders"] = C.clean_orders(raw["orders"], dedupe=D.dedupe_exact_by_hash)
    cl = {**cl, **materialize(spark, rest, "clean")}
    return {**load_tables(raw, fact_from_clean(cl), inventory),
            "fact_events": without_time_partitions(cl)["events"], "agg_reviews": A.review_features(cl["reviews"])}


def q_fk_orphans(spark, sf):
    """All declared keys; in each child, every 31st product and every 7th
    store is renamed to one that no dimension has."""
    def renamed(df):
        for c, every in (("product_id", 31), ("store_id", 7)):
            if c in df.columns:
                df = df.withColumn(c, F.when(F.col(c).try_cast("long") % every == 0, F.concat(F.lit("gone-"), c))
                                   .otherwise(F.col(c)))
        return df

    tables = {n: df if n.startswith("dim_") else renamed(df) for n, df in _all_tables(spark, sf).items()}
    return J.fk_report(tables, SCHEMAS.WAREHOUSE)


def q_stockout_flag(spark, sf):
    cl = typed_clean(spark, sf)
    pairs = J.join_stock(A.sales_two_horizons(cl["orders"]), cl["inventory"])
    pairs = pairs.withColumn("stock_qty", F.coalesce("stock_qty", F.lit(0)).cast("long"))
    return add_stockout_flag(pairs).select("product_id", "store_id", "stock_qty", "sales_7d", P.LABEL)


def q_fact_stock_risk(spark, sf):
    return fact(spark, sf)


def q_fact_colocated(spark, sf):
    """D2 from sales and stock that are stored bucketed by their pair (J2 without an exchange)."""
    cl = typed_clean(spark, sf)
    prefix = f"pairs_{uuid.uuid4().hex[:10]}_"
    sides = store_pairs(A.sales_two_horizons(cl["orders"]), cl["inventory"], scratch_path(spark, "pairs"), prefix)
    try:
        return fact_from_pairs(*sides, cl["products"], cl["stores"], cl["reviews"], cl["events"]).checkpoint()
    finally:
        forget(spark, prefix)


def q_fact_stock_risk_raw(spark, sf):
    return fact_from_clean(raw_clean(spark, sf))


def q_fact_stock_risk_repaired(spark, sf):
    return fact_from_clean(raw_clean(spark, sf, BOTH_DATES))


# --- E / Q / V: quality, SQL statements, charts --------------------------------

def q_quality_summary(spark, sf):
    return E.quality_report(raw_clean(spark, sf))


def q_final_table_check(spark, sf):
    return E.final_table_check(fact(spark, sf))


def q_pk_violations(spark, sf):
    return E.pk_violations(AD.typed_orders(spark, sf), ["order_id"])


def _spoiled(spark, sf):
    """The whole fact with faults for the checks to find: by product id, a label
    out of its domain (every 31st) and values turned below zero (every 7th,
    11th, ... by column)."""
    df, number = fact(spark, sf), F.col("product_id").try_cast("long")
    bad = {c: F.when(number % every == 0, -1 - F.col(c)).otherwise(F.col(c))
           for c, every in zip(P.NON_NEGATIVE_COLUMNS, (7, 11, 13, 17))}
    return df.withColumns({**bad, P.LABEL: F.when(number % 31 == 0, 2).otherwise(F.col(P.LABEL))})


def q_domain_check(spark, sf):
    return E.domain_check(_spoiled(spark, sf), P.LABEL, [0, 1])


def q_non_negative_check(spark, sf):
    return E.non_negative_check(_spoiled(spark, sf))


def q_table_row_counts(spark, sf):
    return Q.table_row_counts(_warehouse(spark, sf))


def q_table_preview(spark, sf):
    t = _warehouse(spark, sf)
    return Q.table_previews({
        "dim_product": (t["dim_product"], ["product_id"]),
        "dim_store": (t["dim_store"], ["store_id"]),
        "fact_orders": (t["fact_orders"], ["order_id", "order_date", "product_id", "store_id"]),
        "fact_inventory": (t["fact_inventory"], ["product_id", "store_id"]),
        "fact_stock_risk": (t["fact_stock_risk"], ["product_id", "store_id"]),
    }, 5)


def q_order_duplicates(spark, sf):
    return Q.order_duplicates(AD.raw_orders(spark, sf))


def q_order_null_counts(spark, sf):
    return Q.order_null_counts(_load(spark, sf)["fact_orders"])


def q_fact_preview(spark, sf):
    return Q.preview(fact(spark, sf), 10, P.ID_COLUMNS)


def q_risk_distribution(spark, sf):
    return Q.risk_distribution(fact(spark, sf))


def q_fact_duplicates(spark, sf):
    """Q8 on the fact and, once more, its rows at risk: their keys occur twice."""
    df = fact(spark, sf)
    return Q.fact_duplicates(df.unionByName(df.filter(F.col(P.LABEL) == 1)))


def q_region_avg_sales(spark, sf):
    return Q.region_avg_sales(fact(spark, sf))


def q_at_risk_rows(spark, sf):
    return Q.at_risk_rows(fact(spark, sf))


def q_chart_risk(spark, sf):
    return Q.chart_risk(fact(spark, sf))


def q_chart_points(spark, sf):
    return Q.chart_points(fact(spark, sf))


def q_chart_region(spark, sf):
    return Q.chart_region(fact(spark, sf))


# --- M: machine learning -----------------------------------------------------

def q_label_encode(spark, sf):
    return M.encoding_dictionary(fact(spark, sf), ["category", "region"])


def q_choose_test_size(spark, sf):
    return M.choose_test_size(fact(spark, sf))


def q_stratified_split(spark, sf):
    return split(spark, sf)


def q_class_weights(spark, sf):
    train = split(spark, sf).filter(~F.col("is_test"))
    return M.class_weights(train)


def q_accuracy(spark, sf):
    return M.accuracy(rule_scored(spark, sf))


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(spark, rule_scored(spark, sf))


def q_classification_report(spark, sf):
    return M.classification_report(M.confusion_matrix(spark, rule_scored(spark, sf)))


def q_class_distribution(spark, sf):
    return M.class_distribution(split(spark, sf))


def q_train_forest(spark, sf):
    root = scratch_path(spark, "train")
    out = run_training(spark, fact(spark, sf), model_path=f"{root}/model", log_path=f"{root}/run_log")
    return out["report"]


def q_train_forest_support(spark, sf):
    """What any forest must report: the test rows of each class, and as many in the matrix."""
    out = run_training(spark, fact(spark, sf))
    per = out["report"].filter(F.col("class_label").isin("0", "1")).select("class_label", "support")
    return per.unionByName(out["confusion"].agg(F.lit("matrix").alias("class_label"), F.sum("n").alias("support")))


def q_training_log(spark, sf):
    """K4 + K7: what the training step logged, read back: the supports, the cells of
    the matrix in all, and how far the accuracy is from them; and the saved model,
    loaded and used again on the test rows."""
    root = scratch_path(spark, "train-log")
    out = run_training(spark, fact(spark, sf), model_path=f"{root}/model", log_path=f"{root}/run_log", run_id="0042")
    log = read_run_log(spark, f"{root}/run_log").filter(F.col("run_id") == "0042")
    metric, value = F.col("metric"), F.col("value")
    cells = F.sum(F.when(metric.startswith("matrix:"), value))
    right = F.sum(F.when(metric.isin("matrix:0:0", "matrix:1:1"), value))
    accuracy = F.max(F.when(metric == "accuracy", value))
    test = out["split"].filter("is_test").drop("is_test")
    again = reload_differences(out["model"], f"{root}/model", test)
    supports = log.filter(metric.endswith(":support")).select("metric", "value")
    summary = log.agg(cells.alias("matrix"), F.round(F.abs(accuracy * cells - right), 6).alias("accuracy_off"))
    return (supports.unionByName(summary.unpivot([], ["matrix", "accuracy_off"], "metric", "value"))
            .unionByName(again.select(F.col("n_differ").cast("double"), F.col("n_rows").cast("double"))
                         .unpivot([], ["n_differ", "n_rows"], "metric", "value")))


# --- S / K: sources and sinks ------------------------------------------------

def q_csv_round_trip(spark, sf):
    li = AD.table(spark, sf, "lineitem")
    path = scratch_path(spark, "csv")
    li.write.mode("overwrite").option("header", True).csv(path)
    return S.read_csv(spark, path, li.schema)


def q_json_array_round_trip(spark, sf):
    ev = AD.raw_events(spark, sf)
    path = S.write_json_array(ev, scratch_path(spark, "json-array"))
    return S.read_json_array(spark, path, RAW_EVENTS)


def q_jsonl_round_trip(spark, sf):
    ev = AD.raw_events(spark, sf)
    path = scratch_path(spark, "jsonl")
    ev.write.mode("overwrite").json(path)
    return S.read_jsonl(spark, path, RAW_EVENTS)


def q_corrupt_quarantine(spark, sf):
    """Every 53rd event is written as a truncated JSON line; the read
    keeps the rest and quarantines those lines."""
    ev = AD.typed_events(spark, sf)
    line = F.to_json(F.struct(*ev.columns))
    broken = F.expr("substring(value, 1, length(value) - 1)")
    text = (ev.select(line.alias("value"), F.col("event_id").cast("long").alias("_k"))
              .select(F.when(F.col("_k") % 53 == 0, broken).otherwise(F.col("value")).alias("value")))
    path = scratch_path(spark, "corrupt")
    text.write.mode("overwrite").text(path)
    good, bad = S.quarantine(spark, S.read_jsonl(spark, path, RAW_EVENTS, quarantine=True),
                             scratch_path(spark, "quarantine"))
    return (good.agg(F.lit("parsed").alias("status"), F.count(F.lit(1)).alias("rows"),
                     F.count_distinct("event_id").alias("ids"))
            .unionByName(bad.agg(F.lit("corrupt").alias("status"), F.count(F.lit(1)).alias("rows"),
                                 F.count_distinct("event_id").alias("ids"))))


def q_read_profile(spark, sf):
    return S.read_profile(AD.raw_sources(spark, sf))


def q_overwrite_reload(spark, sf):
    """K5: a load, a second one that is killed before it is published (its
    tables hold one row too many each), and what a reader then sees."""
    root = scratch_path(spark, "warehouse")
    raw, cl, inventory = _feed(spark, sf)
    tables = run_load(spark, raw, fact_from_clean(cl), root, inventory=inventory)
    stage({n: df.unionByName(df.limit(1)) for n, df in tables.items()}, root)
    return Q.table_row_counts(read_current(spark, root))


def q_run_log(spark, sf):
    """K4: the record of a run that was tried twice."""
    root = scratch_path(spark, "etl-out")
    path = write_fact(fact(spark, sf), f"{root}/fact_stock_risk")
    for df in (spark.read.parquet(path).limit(3), spark.read.parquet(path)):
        append_run_log(spark, df, f"{root}/run_log", "etl", run_id="0042")
    return read_run_log(spark, f"{root}/run_log").select("run_id", "step", "metric", "value")


def _event_lines(spark, sf):
    """Raw events as JSON lines, every 53rd without its first character."""
    return AD.raw_events(spark, sf).select(F.when(F.col("event_id").try_cast("long") % 53 == 0, F.expr("substr(to_json(struct(*)), 2)"))
                                           .otherwise(F.to_json(F.struct("*"))).alias("value"))


def q_landing_stream(spark, sf):
    """K1: new files land batch by batch, malformed lines beside the good ones;
    a run with nothing new adds nothing."""
    root = scratch_path(spark, "landing")
    lines = _event_lines(spark, sf).repartition(5, "value")
    lines.write.mode("overwrite").text(f"{root}/in")
    for _ in range(2):
        land_incremental(spark, f"{root}/in", RAW_EVENTS, "jsonl", f"{root}/out", f"{root}/chk", max_files_per_trigger=2)
    bad = read_malformed(spark, f"{root}/out", RAW_EVENTS).agg(F.count("*")).scalar()
    return read_landed(spark, f"{root}/out", RAW_EVENTS).withColumn("n_malformed", bad)


def _exported(spark, sf, compression="none"):
    """The six raw sources as files in their native formats (CSV, JSON array, JSONL)."""
    raw = AD.raw_sources(spark, sf)
    root = scratch_path(spark, "raw-files")
    for name in ("orders", "products", "stores"):
        S.write_csv(raw[name], f"{root}/{name}", compression)
    for name in ("inventory", "events"):
        S.write_json_array(raw[name], f"{root}/{name}", compression)
    raw["reviews"].write.mode("overwrite").option("compression", compression).json(f"{root}/reviews")
    fmt = {"orders": "csv", "products": "csv", "stores": "csv",
           "inventory": "json", "events": "json", "reviews": "jsonl"}
    # product categories hold line breaks; the other files can be split where they are plain
    return [S.SourceSpec(n, f"{root}/{n}", fmt[n], SCHEMAS.RAW[n],
                         (("multi_line", True),) if n == "products" else ())
            for n in ("orders", "products", "stores", "inventory", "reviews", "events")]


def q_ingest_round_trip(spark, sf):
    """Reference entry 4: the exported sources read with the tolerant reader
    (S1-S4), landed as Parquet (K1) and profiled (S5)."""
    frames, _status = S.read_sources(spark, _exported(spark, sf))
    return S.read_profile(frames)


def q_source_status(spark, sf):
    """A good source, one with broken lines, a broken array, good arrays with
    a broken one among them, arrays with values of the wrong type, a file without
    a byte, a file that is no gzip, a missing one, and a good one after them,
    which is still landed.  The files are packed: as plain text they take several
    times the room of their tables."""
    packed = "snappy"
    good = _exported(spark, sf, packed)
    root = scratch_path(spark, "broken")
    ev = AD.raw_events(spark, sf)
    _event_lines(spark, sf).write.option("compression", packed).text(f"{root}/lines")
    cut = spark.range(1).coalesce(1).select(F.lit('[{"event_id": "1"}, {"event_id": "2"').alias("value"))
    cut.write.text(f"{root}/array")
    S.write_json_array(ev, f"{root}/arrays", packed)
    cut.write.mode("append").text(f"{root}/arrays")
    stock = F.col("stock_qty").cast("string")
    S.write_json_array(AD.raw_inventory(spark, sf).withColumn("stock_qty", F.when(F.col("stock_qty") % 5 == 0, "many").otherwise(stock)),
                       f"{root}/typed", packed)
    jvm = spark.sparkContext._jvm
    for name, content in (("orders.csv.gz", b"this is no gzip file"), ("blank/events.json", b"")):
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(content))
        out.close()
    raw = SCHEMAS.RAW
    specs = [S.SourceSpec("good", good[0].path, "csv", raw["orders"], good[0].options),
             S.SourceSpec("lines", f"{root}/lines", "jsonl", raw["events"]),
             S.SourceSpec("array", f"{root}/array", "json", raw["events"]),
             S.SourceSpec("arrays", f"{root}/arrays", "json", raw["events"]),
             S.SourceSpec("typed", f"{root}/typed", "json", raw["inventory"]),
             S.SourceSpec("blank", f"{root}/blank", "json", raw["events"]),
             S.SourceSpec("gzip", f"{root}/orders.csv.gz", "csv", raw["orders"]),
             S.SourceSpec("missing", f"{root}/nothing", "csv", raw["orders"]),
             S.SourceSpec("after", good[4].path, "jsonl", raw["reviews"])]
    _frames, status = S.read_sources(spark, specs)
    return status.select("dataset", "format", "status", "parsed", "corrupt", F.col("error").isNotNull().alias("has_error"))


def _etl(spark, sf):
    """The ETL over packed files: as plain text the sources take several times the
    room of their tables."""
    return run_etl_files(spark, _exported(spark, sf, "gzip"), scratch_path(spark, "etl"),
                         valid_event_types=EV, partition_fact_by="region")


def q_etl_run_fact(spark, sf):
    """D3 end to end from files; the fact as written (K2)."""
    return _etl(spark, sf)["fact_stock_risk"]


def q_etl_run_quality(spark, sf):
    """D3 end to end from files; the quality report as written (K3)."""
    return _etl(spark, sf)["quality_checks"]


def q_etl_final_check(spark, sf):
    """D3 end to end from files; the final check as written."""
    return _etl(spark, sf)["final_check"]


def q_required_columns(spark, sf):
    """E3 on the fact and a column that it lacks."""
    return E.required_columns(spark, fact(spark, sf), "fact_stock_risk", [*P.FACT_COLUMNS, "missing_column"])


def q_fact_partitioned_round_trip(spark, sf):
    """K2 with partitionBy(region), read back; regions that look like numbers keep their text."""
    df = fact(spark, sf).withColumn("region", F.expr("CASE region WHEN 'ASIA' THEN '01' WHEN 'EUROPE' THEN '7' ELSE region END"))
    return read_fact(spark, write_fact(df, scratch_path(spark, "fact-by-region"), "region"))


def q_warehouse_sql_row_counts(spark, sf):
    """K6 + SQL: all seven typed tables declared over the loaded warehouse,
    counted with Spark SQL, and forgotten again."""
    root = scratch_path(spark, "warehouse")
    reload_tables(_all_tables(spark, sf), root)
    prefix = f"wh_{uuid.uuid4().hex[:10]}_"
    tables = create_tables(spark, root, prefix, paths=current_paths(spark, root))
    try:
        return spark.sql(" UNION ALL ".join(
            f"SELECT '{n}' AS table_name, COUNT(*) AS rows FROM {prefix}{n}" for n in SCHEMAS.WAREHOUSE)).checkpoint()
    finally:
        drop_tables(spark, tables)


def q_warehouse_statements(spark, sf):
    """Q4-Q5, Q7-Q10 as Spark SQL over the loaded, declared warehouse."""
    root = scratch_path(spark, "warehouse-sql")
    reload_tables(_all_tables(spark, sf), root)
    with declared(spark, root) as prefix:
        return run_statements(spark, prefix).checkpoint()


def q_time_anchors(spark, sf):
    """A1: the two clocks, max order date and max event time."""
    cl = typed_clean(spark, sf)
    return (cl["orders"].agg(F.lit("orders").alias("clock"), F.max("order_date").alias("anchor"))
            .unionByName(cl["events"].agg(F.lit("events").alias("clock"),
                                          F.max("event_ts").alias("anchor"))))


def q_trailing_window(spark, sf):
    """A2: cleaned orders inside the 30-day window of their own anchor."""
    return A.trailing_window(typed_clean(spark, sf)["orders"], "order_date", P.LONG_WINDOW_DAYS)


def q_encoded_features(spark, sf):
    """M1 + M2: the model's input rows, ids dropped, categories encoded."""
    data, feats, cats = M.prepare_features(fact(spark, sf))
    enc = M.label_encoder(cats).fit(data).transform(data)
    cols = [f"{c}_idx" if c in cats else c for c in feats]
    return enc.select(*cols, P.LABEL)


def _tuned(fn: Query) -> Query:
    """Every query runs with the library's runtime settings (AQE, skew join,
    UTC session zone, so text <-> timestamp_ntz conversions never cross a
    daylight-saving gap)."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    name[2:]: _tuned(fn) for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

# Queries without an SQL oracle (iterative / model-based): rows-only check.
NO_ORACLE = {"train_forest"}
