from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fixtures import ORDERS, raw_frames
from shelfrisk import schemas
from shelfrisk.plans.etl import clean_sources, fact_from_clean, run_etl
from shelfrisk.plans.warehouse import run_load
from shelfrisk.sources import files as S
from shelfrisk.sources import reload as R
from shelfrisk.sources.sinks import append_run_log, create_tables, drop_tables, land, read_run_log
from shelfrisk.streaming.landing import land_incremental, read_landed, read_malformed, write_batch


def _write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_csv_json_jsonl_and_status(spark, tmpdir_fresh):
    orders_csv = f"{tmpdir_fresh}/raw/orders.csv"
    _write_csv(orders_csv, schemas.RAW_ORDERS.fieldNames(), ORDERS)
    inv_json = f"{tmpdir_fresh}/raw/inventory.json"
    with open(inv_json, "w") as f:
        json.dump([{"product_id": "P1", "store_id": "S1", "stock_qty": 5,
                    "last_update": "2024-01-01T00:00:00"},
                   {"product_id": "P2", "store_id": "S1", "stock_qty": -3,
                    "last_update": "2024-01-02T00:00:00"}], f, indent=2)
    rev_jsonl = f"{tmpdir_fresh}/raw/reviews.jsonl"
    with open(rev_jsonl, "w") as f:
        f.write('{"review_id": "R1", "product_id": "P1", "rating": 4, "comment": "ok", "review_date": "2024-01-01"}\n')
        f.write('{"review_id": "R2", "product_id": "P1", "rating": \n')          # malformed line
        f.write('{"review_id": "R3", "product_id": "P2", "rating": null, "comment": "x", "review_date": "2024-01-02"}\n')
    specs = [S.SourceSpec("orders", orders_csv, "csv", schemas.RAW_ORDERS),
             S.SourceSpec("inventory", inv_json, "json", schemas.RAW_INVENTORY),
             S.SourceSpec("reviews", rev_jsonl, "jsonl", schemas.RAW_REVIEWS),
             S.SourceSpec("events", f"{tmpdir_fresh}/raw/missing.json", "json", schemas.RAW_EVENTS)]
    frames, status = S.read_sources(spark, specs)
    st = {r.dataset: r.status for r in status.collect()}
    assert {r.dataset: (r.parsed, r.corrupt) for r in status.collect()}["reviews"] == (2, 1)
    assert st == {"orders": "ok", "inventory": "ok", "reviews": "ok", "events": "error"}
    assert frames["events"] is None
    assert frames["orders"].count() == len(ORDERS)
    # CSV empty cell -> NULL
    assert frames["orders"].filter("order_id = 'O7'").first().quantity is None
    assert sorted(r.stock_qty for r in frames["inventory"].collect()) == [-3, 5]
    prof = {r.dataset: (r.rows, r.columns) for r in S.read_profile(frames).collect()}
    assert prof["orders"] == (15, 8) and prof["inventory"] == (2, 4)
    good, bad = S.quarantine(spark, S.read_jsonl(spark, rev_jsonl, schemas.RAW_REVIEWS, quarantine=True),
                             f"{tmpdir_fresh}/landed_reviews")
    assert sorted(r.review_id for r in good.collect()) == ["R1", "R3"]
    assert bad.count() == 1 and bad.first()[S.CORRUPT].startswith('{"review_id": "R2"')


def _events(n, bad=""):
    return [{"event_id": str(i), "product_id": "P1", "event_type": "view", "event_ts": f"2024-01-01T00:00:{i % 60:02d}",
             "source": bad or "web"} for i in range(n)]


def test_broken_arrays_are_failed_datasets(spark, tmpdir_fresh):
    """A truncated array is an error whose files are named; good lines around
    broken ones are kept; each dataset is written once."""
    text = json.dumps(_events(1000))
    files = {"whole/a.json": text, "cut/a.json": text, "cut/b.json": text[:-20], "blank/a.json": "", "none/a.json": "[]",
             "words/a.json": "no array at all", "inner/a.json": '["x", {"event_id": "1"}]'}
    for name, content in files.items():
        os.makedirs(os.path.dirname(f"{tmpdir_fresh}/{name}"), exist_ok=True)
        with open(f"{tmpdir_fresh}/{name}", "w") as f:
            f.write(content)
    names = sorted({f.split("/")[0] for f in files})
    specs = [S.SourceSpec(n, f"{tmpdir_fresh}/{n}", "json", schemas.RAW_EVENTS) for n in names]
    root = f"{tmpdir_fresh}/landed"
    frames, status = S.read_sources(spark, specs, root)
    got = {r.dataset: (r.status, r.parsed, r.corrupt) for r in status.collect()}
    assert got == {"whole": ("ok", 1000, 0), "cut": ("error", 1000, 1), "blank": ("error", 0, 1), "none": ("ok", 0, 0),
                   "words": ("error", 0, 1), "inner": ("error", 0, 1)}
    assert frames["whole"].count() == 1000 and frames["none"].count() == 0 and frames["cut"] is None
    errors = {r.dataset: r.error for r in status.collect()}
    assert "cut/b.json" in errors["cut"] and "a.json" not in errors["cut"]
    cut = next(s for s in specs if s.name == "cut")
    assert [r.file.split("/")[-1] for r in S.broken_files(spark, cut, root).collect()] == ["b.json"]
    assert S.landed(spark, cut, root).filter(f"{S.CORRUPT} IS NOT NULL").first()[S.CORRUPT] == text[:S.HEAD]


def test_wrong_types_spoil_their_own_field(spark, tmpdir_fresh):
    rows = [{"product_id": "P1", "store_id": "S1", "stock_qty": "many", "last_update": "x"}, {"stock_qty": "few"},
            {"product_id": "P2", "store_id": "S1", "stock_qty": 4, "last_update": "y"}]
    for kind, text in (("json", json.dumps(rows)), ("jsonl", "\n".join(map(json.dumps, rows)))):
        with open(f"{tmpdir_fresh}/{kind}", "w") as f:
            f.write(text)
    specs = [S.SourceSpec(k, f"{tmpdir_fresh}/{k}", k, schemas.RAW_INVENTORY) for k in ("json", "jsonl")]
    frames, status = S.read_sources(spark, specs, f"{tmpdir_fresh}/landed")
    got = {r.dataset: (r.status, r.parsed, r.corrupt) for r in status.collect()}
    assert got == {"json": ("ok", 2, 1), "jsonl": ("ok", 1, 2)}      # a record without any field is not kept
    assert sorted((r.product_id, r.stock_qty) for r in frames["json"].collect()) == [("P1", None), ("P2", 4)]
    assert [r.product_id for r in frames["jsonl"].collect()] == ["P2"]


def test_wrong_types_in_a_large_array(spark, tmpdir_fresh):
    """The work on a file with wrong types grows with its size, not with size times records."""
    folder = f"{tmpdir_fresh}/stock of {{a}}"
    os.makedirs(folder)
    rows = [{"product_id": f"P{i}", "store_id": "S1", "stock_qty": "many" if i % 5 == 0 else i, "last_update": "x" * 300} for i in range(40_000)]
    texts = {"typed.json": json.dumps(rows, indent=0), "good.json": json.dumps(rows[1:3]), "none.json": "[]"}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    spec = S.SourceSpec("stock", f"{tmpdir_fresh}/stock of *", "json", schemas.RAW_INVENTORY)
    start = time.monotonic()
    frames, status = S.read_sources(spark, [spec], f"{tmpdir_fresh}/landed")
    assert time.monotonic() - start < 60
    assert [(r.status, r.parsed, r.corrupt) for r in status.collect()] == [("ok", 40_002, 0)]
    assert frames["stock"].agg(F.sum("stock_qty")).first()[0] == sum(i for i in range(40_000) if i % 5) + 3
    states = S.landed(spark, spec, f"{tmpdir_fresh}/landed").groupBy(S.STATE, S.CORRUPT).count().collect()
    assert {(r[0], r[1], r[2]) for r in states} == {("good", None, 2), ("partial", texts["typed.json"][:S.HEAD], 40_000)}


def test_a_broken_array_stops_the_etl(spark, tmpdir_fresh):
    from shelfrisk.plans.etl import run_etl_files

    raw = raw_frames(spark)
    specs = []
    for name, df in raw.items():
        path = S.write_json_array(df.coalesce(1), f"{tmpdir_fresh}/{name}")
        specs.append(S.SourceSpec(name, path, "json", schemas.RAW[name]))
    out = run_etl_files(spark, specs, f"{tmpdir_fresh}/good")
    assert out["fact_stock_risk"].count() == 6
    with open(f"{tmpdir_fresh}/events/extra.json", "w") as f:
        f.write(json.dumps(_events(50))[:-9])
    with pytest.raises(ValueError, match="extra.json"):
        run_etl_files(spark, specs, f"{tmpdir_fresh}/bad")
    status = {r.dataset: r.status for r in spark.read.parquet(f"{tmpdir_fresh}/bad/source_status").collect()}
    assert status == {**dict.fromkeys(raw, "ok"), "events": "error"}
    assert not os.path.exists(f"{tmpdir_fresh}/bad/fact_stock_risk")


def test_na_tokens(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/na.csv"
    _write_csv(p, ["a", "b"], [("NA", "1"), ("x", "n/a"), ("", "null")])
    sch = "a string, b string"
    from pyspark.sql.types import _parse_datatype_string
    df = S.read_csv(spark, p, _parse_datatype_string(sch), na_tokens=S.PANDAS_NA_TOKENS)
    assert [tuple(r) for r in df.collect()] == [(None, "1"), ("x", None), (None, None)]


def test_json_array_writer_round_trip(spark, tmpdir_fresh):
    ev = raw_frames(spark)["events"]
    df = ev.repartition(4)              # some partitions may be empty
    path = S.write_json_array(df, f"{tmpdir_fresh}/arr")
    back = S.read_json_array(spark, path, schemas.RAW_EVENTS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ev.collect()))


def test_streaming_landing_is_incremental(spark, tmpdir_fresh):
    ev = raw_frames(spark)["events"]
    src, out, chk = (f"{tmpdir_fresh}/{x}" for x in ("in", "out", "chk"))

    def land():
        land_incremental(spark, f"{src}/*", schemas.RAW_EVENTS, "jsonl", out, chk)
        return read_landed(spark, out, schemas.RAW_EVENTS).count()

    ev.limit(3).write.json(f"{src}/b1")
    assert land() == 3
    assert land() == 3                                                # nothing new
    ev.write.json(f"{src}/b2")
    with open(f"{src}/b2/bad.json", "w") as f:
        f.write('{"event_id": "E1", \n')
    assert land() == 3 + ev.count()
    assert [tuple(r) for r in read_malformed(spark, out, schemas.RAW_EVENTS).collect()] == [(1, '{"event_id": "E1", ')]


def test_replayed_batch_changes_nothing(spark, tmpdir_fresh):
    """A batch written by a run that died before its commit is written again
    under the same id."""
    ev = raw_frames(spark)["events"].withColumn(S.CORRUPT, F.lit(None).cast("string"))
    bad = ev.limit(1).withColumn(S.CORRUPT, F.lit("{"))
    write_batch(ev, 0, f"{tmpdir_fresh}/out")
    want = sorted(map(str, read_landed(spark, f"{tmpdir_fresh}/out", schemas.RAW_EVENTS).collect()))
    for _ in range(2):
        write_batch(bad, 1, f"{tmpdir_fresh}/out")
        write_batch(ev, 0, f"{tmpdir_fresh}/out")
    assert sorted(map(str, read_landed(spark, f"{tmpdir_fresh}/out", schemas.RAW_EVENTS).collect())) == want
    assert read_malformed(spark, f"{tmpdir_fresh}/out", schemas.RAW_EVENTS).count() == 1


def _five(spark, value, rows=3, fail=None):
    """Five tables whose rows say which load they come from; one may fail while it is written."""
    def table(n):
        v = F.raise_error(F.lit("the job was killed")) if n == fail else F.lit(value)
        return spark.range(rows).select("id", v.cast("string").alias("load"))

    return {n: table(n) for n in ("dim_product", "dim_store", "fact_orders", "fact_inventory", "fact_stock_risk")}


def _loads(spark, root):
    return {n: (df.count(), [r.load for r in df.select("load").distinct().collect()]) for n, df in R.read_current(spark, root).items()}


@pytest.mark.parametrize("fail", ["dim_product", "fact_orders", "fact_stock_risk"])
def test_a_failed_reload_leaves_the_old_tables(spark, tmpdir_fresh, fail):
    root = f"{tmpdir_fresh}/wh"
    R.reload_tables(_five(spark, "old"), root)
    with pytest.raises(Exception, match="killed"):
        R.reload_tables(_five(spark, "new", 5, fail), root)
    assert _loads(spark, root) == dict.fromkeys(_five(spark, ""), (3, ["old"]))
    R.reload_tables(_five(spark, "new", 5), root)
    assert _loads(spark, root) == dict.fromkeys(_five(spark, ""), (5, ["new"]))


def test_a_reload_killed_between_its_steps(spark, tmpdir_fresh):
    """Staged but not published: the old content; published but not cleaned: the
    new; a half-written manifest is none."""
    root = f"{tmpdir_fresh}/wh"
    with pytest.raises(FileNotFoundError):
        R.current_paths(spark, root)
    R.reload_tables(_five(spark, "a"), root)
    name = R.stage(_five(spark, "b"), root)
    with open(f"{root}/manifests/000000000009-{name}.json.part", "w") as f:
        f.write('{"ver')
    assert _loads(spark, root)["fact_orders"] == (3, ["a"])
    R.publish(spark, root, name, list(_five(spark, "")))
    assert _loads(spark, root) == dict.fromkeys(_five(spark, ""), (3, ["b"]))


def test_old_versions_go_and_readers_go_on(spark, tmpdir_fresh):
    root = f"{tmpdir_fresh}/wh"
    first = R.reload_tables(_five(spark, "1"), root)["dim_store"]
    R.reload_tables(_five(spark, "2"), root)
    assert first.count() == 3                                         # still there for its reader
    dead = R.stage(_five(spark, "dead"), root)
    R.reload_tables(_five(spark, "3"), root)
    assert len(R.versions(spark, root)) == 2 and len(os.listdir(f"{root}/data")) == 3
    assert R.drop_old(spark, root, stale_seconds=-60) == [dead]
    assert _loads(spark, root)["dim_store"] == (3, ["3"])


def test_registered_tables_follow_a_reload(spark, tmpdir_fresh):
    raw = raw_frames(spark)
    fact = fact_from_clean(clean_sources(raw))
    root = f"{tmpdir_fresh}/wh"
    run_load(spark, raw, fact, root, register=True, prefix="f_")
    run_load(spark, raw, fact.limit(2), root, register=True, prefix="f_")
    assert spark.sql("SELECT count(*) AS n FROM f_fact_stock_risk").first().n == 2
    drop_tables(spark, [f"f_{n}" for n in ("dim_product", "dim_store", "fact_orders", "fact_inventory", "fact_stock_risk")])
    assert not spark.catalog.tableExists("f_dim_store")
    assert R.read_current(spark, root)["fact_stock_risk"].count() == 2


def test_run_log_is_keyed_by_run(spark, tmpdir_fresh):
    """A retried run replaces its own records, also where its id looks like a number."""
    path = f"{tmpdir_fresh}/log"
    for run_id, step, rows in (("007", "etl", 3), ("1e5", "etl", 4), ("007", "etl", 9), ("007", "train", 2)):
        append_run_log(spark, spark.range(rows), path, step, run_id=run_id)
    got = sorted((r.run_id, r.step, r.metric, r.value) for r in read_run_log(spark, path).collect())
    assert got == [("007", "etl", "rows_written", 9.0), ("007", "train", "rows_written", 2.0), ("1e5", "etl", "rows_written", 4.0)]


def test_run_etl_and_load(spark, tmpdir_fresh):
    raw = raw_frames(spark)
    out = run_etl(spark, raw, f"{tmpdir_fresh}/out", partition_fact_by="region")
    assert out["fact_stock_risk"].count() == 6
    assert out["quality_checks"].count() == 6
    log = spark.read.parquet(f"{tmpdir_fresh}/out/run_log").first()
    assert (log.step, log.metric, log.value) == ("etl", "rows_written", 6.0)
    fact = fact_from_clean(clean_sources(raw))
    t1 = run_load(spark, raw, fact, f"{tmpdir_fresh}/wh", register=True, prefix="t_")
    first = {k: v.count() for k, v in t1.items()}
    t2 = run_load(spark, raw, fact, f"{tmpdir_fresh}/wh")        # reload is idempotent
    assert first == {k: v.count() for k, v in t2.items()}
    spark.catalog.refreshTable("t_fact_stock_risk")
    assert t2["dim_product"].filter("product_id = 'P1'").first().category == " Laptop "
    assert t2["fact_inventory"].filter("product_id = 'P2'").first().stock_qty == -3
    assert spark.sql("SELECT count(*) AS n FROM t_fact_stock_risk").first().n == 6
    assert "t_dim_store" in create_tables(spark, f"{tmpdir_fresh}/wh", "t_", ["dim_store"])
    paths = land(raw, f"{tmpdir_fresh}/landed")
    assert spark.read.parquet(paths["orders"]).count() == len(ORDERS)
    assert spark.read.parquet(f"{tmpdir_fresh}/out/fact_stock_risk").filter(
        F.col("region").isNull()).count() == 1


def test_partitioned_fact_keeps_types_and_order(spark, tmpdir_fresh):
    from shelfrisk import params as P
    from shelfrisk.schemas import FACT_STOCK_RISK
    from shelfrisk.sources.sinks import read_fact, write_fact

    rows = [("p1", "s1", 1, 2, 3.0, 4, "c", r, 5, 0) for r in ("01", "7", "north", None)]
    df = spark.createDataFrame([dict(zip(["product_id", "store_id", "sales_7d", "sales_30d", "avg_rating", "stock_qty",
                                          "category", "region", "web_signal", "stockout_risk"], r)) for r in rows], FACT_STOCK_RISK)
    back = read_fact(spark, write_fact(df, f"{tmpdir_fresh}/fact", "region"))
    assert back.columns == P.FACT_COLUMNS
    assert sorted(str(r.region) for r in back.collect()) == ["01", "7", "None", "north"]


def test_dates_do_not_depend_on_the_session_zone(spark):
    from fixtures import raw_frames
    from shelfrisk.plans.etl import clean_sources

    want = sorted(str(r.order_date) for r in clean_sources(raw_frames(spark))["orders"].collect())
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = sorted(str(r.order_date) for r in clean_sources(raw_frames(spark))["orders"].collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_no_scratch_folder_on_a_cluster_is_an_error():
    from shelfrisk.session import scratch_root

    class Spark:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        scratch_root(Spark)


def test_exports_are_compressed_and_read_back(spark, tmpdir_fresh):
    """JSON arrays written batch by batch, packed: quotes, line breaks, NULLs, an empty partition."""
    import os
    rows = [(str(i), None if i % 3 else 'say "hi",\n[x]', "é", "2024-01-01", "web") for i in range(25_000)]
    df = spark.createDataFrame(rows, schemas.RAW_EVENTS).repartition(3).union(spark.createDataFrame([], schemas.RAW_EVENTS))
    path = S.write_json_array(df, f"{tmpdir_fresh}/packed", "gzip")
    assert all(f.endswith(".gz") for f in os.listdir(path) if f.startswith("part-"))
    back = S.read_json_array(spark, path, schemas.RAW_EVENTS)
    assert back.count() == 25_000 and back.exceptAll(df).isEmpty()


def test_feed_joins_the_orders_once(spark, tmpdir_fresh, monkeypatch):
    """The warehouse's tables come of stored raw orders and of one stored load of the inventory."""
    from shelfrisk import registry
    calls = []
    for name in ("raw_orders", "raw_inventory"):
        plain = getattr(registry.AD, name)
        monkeypatch.setattr(registry.AD, name, lambda s, sf, plain=plain, name=name: (calls.append(name), plain(s, sf))[1])
    ts = "timestamp'2024-01-05 00:00:00'"
    tables = {
        "orders": "select id as o_orderkey, id % 7 as o_custkey from range(200)",
        "lineitem": f"select id % 180 as l_orderkey, id % 20 as l_partkey, id % 5 as l_suppkey, cast(id % 4 as int) as l_linenumber, "
                    f"cast(id % 50 as double) as l_quantity, cast(id as double) as l_extendedprice, 'N' as l_returnflag, "
                    f"cast({ts} as timestamp_ntz) as l_shipdate from range(600)",
        "part": "select id as p_partkey, 'n' as p_name, 't' as p_type, 'b' as p_brand, 1.5D as p_retailprice from range(20)",
        "supplier": "select id as s_suppkey, 's' as s_name, id % 2 as s_nationkey from range(5)",
        "nation": "select id as n_nationkey, 'n' as n_name, id as n_regionkey from range(2)",
        "region": "select id as r_regionkey, 'ASIA' as r_name from range(2)",
        "events": f"select id as event_id, cast({ts} as timestamp_ntz) as ts, id % 20 as user_id, 'view' as event_type, "
                  "cast(id % 6 as double) as value, 'p' as props from range(300)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmpdir_fresh}/{name}.parquet")
    got = registry._all_tables(spark, tmpdir_fresh)
    assert not any("lineitem.parquet" in f for name in ("fact_orders", "fact_inventory", "fact_stock_risk") for f in got[name].inputFiles())
    old = registry._load(spark, tmpdir_fresh)
    for name, df in old.items():
        assert got[name].columns == df.columns
        assert sorted(map(str, got[name].collect())) == sorted(map(str, df.collect()))


def test_status_sources_are_packed(spark, tmpdir_fresh, monkeypatch):
    """All files that the status query exports are packed, its figures are those of the rows."""
    import glob
    import os
    from shelfrisk import registry
    ts = "cast(timestamp'2024-01-05 00:00:00' as timestamp_ntz)"
    tables = {
        "orders": "select id as o_orderkey, id % 7 as o_custkey from range(1, 201)",
        "lineitem": f"select 1 + id % 180 as l_orderkey, id % 20 as l_partkey, id % 5 as l_suppkey, cast(id as int) as l_linenumber, "
                    f"cast(id % 50 as double) as l_quantity, cast(id as double) as l_extendedprice, 'N' as l_returnflag, "
                    f"{ts} as l_shipdate from range(5400)",
        "part": "select id as p_partkey, 'n' as p_name, 't' as p_type, 'b' as p_brand, 1.5D as p_retailprice from range(20)",
        "supplier": "select id as s_suppkey, 's' as s_name, id % 2 as s_nationkey from range(5)",
        "nation": "select id as n_nationkey, 'n' as n_name, id as n_regionkey from range(2)",
        "region": "select id as r_regionkey, 'ASIA' as r_name from range(2)",
        "events": f"select id + 1 as event_id, {ts} as ts, id % 20 as user_id, 'view' as event_type, "
                  "cast(id % 6 as double) as value, 'p' as props from range(1060)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmpdir_fresh}/{name}.parquet")
    monkeypatch.setattr(registry, "scratch_path", lambda s, name: f"{tmpdir_fresh}/{name}")
    got = {r["dataset"]: (r["status"], r["parsed"], r["corrupt"]) for r in registry.q_source_status(spark, tmpdir_fresh).collect()}
    assert got == {
        "good": ("ok", 5430, 0), "lines": ("ok", 1051, 20), "array": ("error", 0, 1), "arrays": ("error", 1071, 1),
        "typed": ("ok", 5430, 0), "blank": ("error", 0, 1), "gzip": ("error", None, None), "missing": ("error", None, None),
        "after": ("ok", 1071, 0)}
    parts = {f: os.path.getsize(f) for f in glob.glob(f"{tmpdir_fresh}/raw-files/*/part-*") + glob.glob(f"{tmpdir_fresh}/broken/*/part-*")}
    assert {os.path.basename(os.path.dirname(f)) for f in parts} == {
        "orders", "products", "stores", "inventory", "reviews", "events", "lines", "array", "arrays", "typed"}
    assert [f for f, size in parts.items() if size > 40 and not f.endswith(".snappy")] == []        # a cut array is all but empty
    plain = registry.S.write_json_array(registry.AD.raw_inventory(spark, tmpdir_fresh), f"{tmpdir_fresh}/plain")
    size = sum(os.path.getsize(f) for f in glob.glob(f"{plain}/part-*"))
    assert sum(s for f, s in parts.items() if "/typed/" in f) < size / 3


def test_arrays_are_written_in_bounded_files(spark, tmpdir_fresh):
    """Every file is an array of its own, full but for the last of its partition; empty partitions are empty arrays."""
    import glob
    import json
    df = spark.range(0, 1000, 1, 3).union(spark.range(0, 200, 1, 2)).union(spark.range(5).where("id > 9")).select(F.col("id").cast("string").alias("k"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        path = S.write_json_array(df, f"{tmpdir_fresh}/arrays", rows_per_file=100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    arrays = [json.loads(open(f).read()) for f in glob.glob(f"{path}/part-*")]
    assert sorted(map(len, arrays)) == sorted([100] * 9 + [33, 33, 34] + [100] * 2 + [0] * (len(arrays) - 14))
    assert sorted(int(r["k"]) for a in arrays for r in a) == sorted([*range(1000), *range(200)])
    assert S.read_json_array(spark, path, df.schema).exceptAll(df).isEmpty()
