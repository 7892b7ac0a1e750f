from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import raw_frames
from shelfrisk import params as P
from shelfrisk.operators import joins as J
from shelfrisk.operators import ml as M
from shelfrisk.operators import quality as E
from shelfrisk.plans import marts as Q
from shelfrisk.plans.etl import clean_sources, fact_from_clean


def _fact(spark):
    return fact_from_clean(clean_sources(raw_frames(spark)))


def test_quality_report(spark):
    rep = {r.dataset: r.asDict() for r in E.quality_report(clean_sources(raw_frames(spark))).collect()}
    assert rep["orders"]["rows"] == 9 and rep["orders"]["columns"] == 8
    assert rep["orders"]["duplicates"] == 0 and rep["orders"]["null_order_id"] == 0
    assert rep["orders"]["null_review_id"] is None          # ragged columns stay NULL
    assert rep["inventory"]["rows"] == 6 and rep["events"]["rows"] == 4
    raw = E.quality_summary(raw_frames(spark)["orders"], "orders", ["order_id"]).first()
    assert raw.duplicates == 1 and raw.null_order_id == 1


def test_final_check_and_checks(spark):
    fact = _fact(spark)
    chk = {(r.check, r.column): r.value for r in E.final_table_check(fact).collect()}
    assert chk[("rows", None)] == 6 and chk[("columns", None)] == 10
    assert chk[("nulls", "region")] == 1 and chk[("duplicate_keys", "product_id,store_id")] == 0
    assert chk[("label_distribution", "1")] == 3
    assert E.domain_check(fact, P.LABEL, [0, 1]).first().invalid_rows == 0
    assert {r.column: r.negative_rows for r in E.non_negative_check(fact).collect()} == dict.fromkeys(
        P.NON_NEGATIVE_COLUMNS, 0)
    assert E.pk_violations(fact, P.ID_COLUMNS).count() == 0


def test_required_columns(spark):
    fact = _fact(spark)
    exp = E.required_columns(spark, fact, "fact_stock_risk", P.FACT_COLUMNS + ["missing"])
    got = {r.column: r.present for r in exp.collect()}
    assert got.pop("missing") is False and all(got.values())


def test_fk_orphans(spark):
    raw = raw_frames(spark)
    cl = clean_sources(raw)
    orph = J.fk_orphans(cl["orders"], "store_id", cl["stores"], "store_id", "orders.store_id")
    assert [(r.orphan_key, r.orphan_rows) for r in orph.collect()] == [("S9", 1)]
    summ = J.fk_summary(orph).first()
    assert summ.orphan_keys == 1 and summ.orphan_rows == 1


def test_marts(spark):
    fact = _fact(spark)
    assert [tuple(r) for r in Q.risk_distribution(fact).collect()] == [(0, 3), (1, 3)]
    reg = {r.region: r.avg_sales_30d for r in Q.region_avg_sales(fact).collect()}
    assert reg == {"north": 7.0, "south": round(17 / 3, 2), None: 6.0}
    risk = [(r.product_id, r.store_id) for r in Q.at_risk_rows(fact).collect()]
    assert risk[0] == ("P1", "S1") and len(risk) == 3
    assert Q.chart_region(fact).filter(F.col("region").isNull()).count() == 0
    assert Q.chart_points(fact).agg(F.sum("n")).first()[0] == 6
    assert Q.preview(fact, 2, P.ID_COLUMNS).count() == 2


def test_round_half_up_exact(spark):
    from shelfrisk.functions import round_half_up_ratio
    df = spark.createDataFrame([(2675, 1000), (1, 8), (5, 3)], "n long, d long")
    got = [r[0] for r in df.select(round_half_up_ratio("n", "d", 2)).collect()]
    assert got == [2.68, 0.13, 1.67]


def _labels(spark, counts):
    data = [(f"p{i}", f"s{c}", c) for c, n in counts.items() for i in range(n)]
    return spark.createDataFrame(data, "product_id string, store_id string, stockout_risk int")


def test_choose_test_size(spark):
    one = M.choose_test_size(_labels(spark, {0: 10})).first()
    assert (one.n_classes, one.stratified, one.test_size) == (1, False, 0.2)
    m1 = M.choose_test_size(_labels(spark, {0: 10, 1: 1})).first()
    assert (m1.stratified, m1.test_size) == (False, 0.5)
    m2 = M.choose_test_size(_labels(spark, {0: 113, 1: 2})).first()
    assert (m2.stratified, m2.test_size) == (True, 0.5)
    m5 = M.choose_test_size(_labels(spark, {0: 50, 1: 5})).first()
    assert m5.test_size == 0.2


def test_stratified_split_keeps_a_minority_test_row(spark):
    df = _labels(spark, {0: 113, 1: 2})
    s = M.stratified_split(df)
    dist = {(r.split, r.stockout_risk): r.n for r in M.class_distribution(s).collect()}
    assert dist[("test", 1)] == 1 and dist[("train", 1)] == 1
    assert dist[("test", 0)] == 57 and dist[("train", 0)] == 56
    again = M.stratified_split(df.repartition(5))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, again.collect()))


def test_split_takes_exact_quotas_at_every_size(spark):
    for counts, size, want in (({0: 11, 1: 11}, 0.2, {0: 3, 1: 2}), ({0: 1000, 1: 50}, 0.2, {0: 200, 1: 10}),
                               ({0: 1001, 1: 50}, 0.2, {0: 201, 1: 10}), ({0: 10, 1: 1}, 0.2, None),
                               ({0: 20000, 1: 5000}, 0.2, {0: 4000, 1: 1000}), ({0: 113, 1: 2}, 0.5, {0: 57, 1: 1})):
        s = M.stratified_split(_labels(spark, counts))
        got = {r.stockout_risk: r.n for r in s.filter("is_test").groupBy("stockout_risk").agg(F.count("*").alias("n")).collect()}
        assert s.count() == sum(counts.values())
        if want is None:      # one row of a class: no stratification, the default share of all rows
            assert sum(got.values()) == 3
        else:
            assert got == want, (counts, got)


def test_forest_takes_any_catalogue(spark):
    rows = [(f"p{i}", "s", f"cat{i % 200:03d}", float(i % 7), int(i % 5 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "product_id string, store_id string, category string, x double, stockout_risk int")
    encoder = M.fit_encoder(df, ["category"])
    train = df.filter("category <> 'cat000'")
    model = M.fit_forest(train, ["category", "x"], encoder, num_trees=2, partitions=2)
    out = M.predict(model, df)
    assert out.count() == 400 and out.filter("category = 'cat000'").first().category_idx == 0.0
    assert model.stages[-1].getOrDefault("maxBins") == 201


def test_forest_predicts_in_a_session_that_has_observed_metrics(spark):
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(f"p{i}", "s", float(i % 7), int(i % 7 == 0)) for i in range(70)]
    df = spark.createDataFrame(rows, "product_id string, store_id string, x double, stockout_risk int")
    model = M.fit_forest(df, ["x"], None, num_trees=2, partitions=2)
    got = M.predict(model, df).collect()
    assert len(got) == 70 and all(r.prediction == r.stockout_risk for r in got)


def test_weights_and_metrics(spark):
    df = _labels(spark, {0: 6, 1: 2})
    w = {r.stockout_risk: r.weight for r in M.class_weights(df).collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}
    scored = df.withColumn("prediction", F.lit(0))
    assert M.accuracy(scored).first().accuracy == 0.75
    cm = {(r.stockout_risk, r.prediction): r.n for r in M.confusion_matrix(spark, scored).collect()}
    assert cm == {(0, 0): 6, (0, 1): 0, (1, 0): 2, (1, 1): 0}
    rep = {r.class_label: r for r in M.classification_report(M.confusion_matrix(spark, scored)).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1_score == 0.0
    assert rep["0"].recall == 1.0 and rep["accuracy"].f1_score == 0.75
    assert rep["macro avg"].recall == 0.5 and rep["weighted avg"].support == 8


def test_forest_pipeline_round_trip(spark, tmpdir_fresh):
    fact = _fact(spark).unionByName(_fact(spark).withColumn("store_id", F.concat("store_id", F.lit("b"))))
    data, feats, cats = M.prepare_features(fact)
    assert feats == ["sales_7d", "sales_30d", "avg_rating", "stock_qty", "category", "region", "web_signal"]
    assert cats == ["category", "region"]
    model = M.fit_forest(data, feats, M.fit_encoder(data, cats), num_trees=5)
    path = M.save_model(model, f"{tmpdir_fresh}/model")
    again = M.predict(M.load_model(path), data)
    assert again.count() == 12 and set(again.columns) >= {"prediction", "probability"}
    enc = {(r["column"], r["value"]): r["index"] for r in M.encoding_dictionary(data, cats).collect()}
    assert enc[("category", "accessory")] == 0 and enc[("region", "north")] == 0
    fitted = model.stages[0]
    for c, labels in zip(cats, fitted.labelsArray):
        assert [v for (col, v), _ in sorted(enc.items(), key=lambda kv: kv[1]) if col == c] == list(labels)


def test_run_training_logs_metrics(spark, tmpdir_fresh):
    from shelfrisk.plans.training import run_training
    fact = _fact(spark)
    for i in range(3):
        fact = fact.unionByName(_fact(spark).withColumn("store_id", F.concat("store_id", F.lit(f"-{i}"))))
    out = run_training(spark, fact, model_path=f"{tmpdir_fresh}/m", num_trees=5,
                       log_path=f"{tmpdir_fresh}/log")
    rep = {r.class_label for r in out["report"].collect()}
    assert rep == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    log = spark.read.parquet(f"{tmpdir_fresh}/log")
    got = {r.metric for r in log.collect()}
    assert {"accuracy", "0:support", "1:recall", "matrix:0:0", "matrix:0:1", "matrix:1:0", "matrix:1:1"} <= got
    assert M.load_model(f"{tmpdir_fresh}/m") is not None


def test_training_computes_the_fact_once(spark):
    from shelfrisk.plans.training import run_training
    fact = _fact(spark)
    for i in range(3):
        fact = fact.unionByName(_fact(spark).withColumn("store_id", F.concat("store_id", F.lit(f"-{i}"))))
    rows, seen = fact.collect(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    fact = spark.createDataFrame(rows, fact.schema).mapInPandas(counted, fact.schema)
    out = run_training(spark, fact, num_trees=2)
    assert {r.class_label for r in out["report"].collect()} >= {"0", "1", "accuracy"}
    assert seen.value == len(rows)


def test_separable_table_gives_a_fixed_report(spark, tmpdir_fresh):
    """Where one column tells the classes apart, every figure is 1, also from the saved model."""
    from shelfrisk.plans.training import reload_differences, run_training
    cols = _fact(spark).schema
    rows = [{"product_id": "p1", "store_id": f"s{i}", "category": "c", "region": "north", "avg_rating": 3.0, "web_signal": 1,
             "stockout_risk": int(i % 4 == 0), "sales_7d": 50 if i % 4 == 0 else 2, "sales_30d": 60, "stock_qty": 5 if i % 4 == 0 else 90}
            for i in range(200)]
    fact = spark.createDataFrame([tuple(r[c] for c in cols.names) for r in rows], cols)
    out = run_training(spark, fact, model_path=f"{tmpdir_fresh}/m", num_trees=5)
    rep = {r.class_label: r for r in out["report"].collect()}
    assert all(r.f1_score == 1.0 for r in rep.values())
    assert rep["0"].support == 3 * rep["1"].support and out["accuracy"].first().accuracy == 1.0
    test = out["split"].filter("is_test").drop("is_test")
    assert reload_differences(out["model"], f"{tmpdir_fresh}/m", test).first() == (0, rep["accuracy"].support)


def test_statements_equal_the_marts(spark, tmpdir_fresh):
    from shelfrisk.plans import marts as Q
    from shelfrisk.plans import statements as ST
    from shelfrisk.schemas import WAREHOUSE
    from shelfrisk.sources.reload import read_current, reload_tables
    fact = _fact(spark).unionByName(_fact(spark).limit(2))
    orders = spark.createDataFrame([("o1", None, "c", "p1", "s1", 1, 2.0, "web"), ("o1", None, "c", None, "s1", 1, 2.0, "web"),
                                    ("o2", None, "c", "p2", None, 3, 1.0, None)], WAREHOUSE["fact_orders"][0])
    root = f"{tmpdir_fresh}/wh"
    reload_tables({"fact_orders": orders, "fact_stock_risk": fact}, root)
    with ST.declared(spark, root) as prefix:
        got = {name: [tuple(r) for r in ST.run_statement(spark, name, prefix).collect()] for name in ST.STATEMENTS}
        long = ST.run_statements(spark, prefix).collect()
        tables = [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    assert len(tables) == 2 and not [t for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    for name, (mart, source) in {"order_duplicates": (Q.order_duplicates, orders), "risk_distribution": (Q.risk_distribution, fact),
                                 "fact_duplicates": (Q.fact_duplicates, fact), "at_risk_rows": (Q.at_risk_rows, fact)}.items():
        assert sorted(got[name], key=str) == sorted((tuple(r) for r in mart(source).collect()), key=str), name
    assert got["at_risk_rows"] == sorted(got["at_risk_rows"], key=lambda r: (-r[3], r[2], r[0], r[1]))
    assert dict(got["order_null_counts"]) == {"product_id": 1, "store_id": 1, "order_date": 3}
    means = [(r, float(v)) for r, v in got["region_avg_sales"]]
    assert sorted(means, key=str) == sorted(((r.region, r.avg_sales_30d) for r in Q.region_avg_sales(fact).collect()), key=str)
    assert [v for _, v in means] == sorted((v for _, v in means), reverse=True)
    assert len(long) == sum(map(len, got.values()))


def test_two_trainings_keep_their_own_log(spark, tmpdir_fresh):
    from shelfrisk.plans.training import metrics_rows
    from shelfrisk.sources.sinks import read_run_log, write_run_log
    cm = M.confusion_matrix(spark, _labels(spark, {0: 3, 1: 1}).withColumn("prediction", F.lit(0)))
    for run in ("a", "b", "a"):
        write_run_log(metrics_rows(M.classification_report(cm), cm, run), f"{tmpdir_fresh}/log")
    log = read_run_log(spark, f"{tmpdir_fresh}/log")
    assert {(r.run_id, r["count"]) for r in log.groupBy("run_id").count().collect()} == {("a", 21), ("b", 21)}
