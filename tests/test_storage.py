from __future__ import annotations

import time
from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from shopmart.plans import medallion
from shopmart.session import cut_lineage
from shopmart.sources import storage
from shopmart.sources.bronze import SCHEMAS, Bronze, load_csv, read_csv
from shopmart.sources.sample import number_by_parts

FOLDER = "/root/testdata/sf0.001"


def test_csv_keeps_declared_types(spark, shop, tmp_path):
    shop.order("o1", "2018-01-01T10:11:12").item("o1", 1, 1.25).payment("o1", 1, 1.25).review("r", "o1", 5, "1/2/2018 3:04")
    bronze = shop.bronze()
    for field in fields(Bronze):
        storage.write_csv(getattr(bronze, field.name), str(tmp_path / f"{field.name}.csv"))
    back = load_csv(spark, str(tmp_path))
    for field in fields(Bronze):
        want, got = getattr(bronze, field.name), getattr(back, field.name)
        assert got.dtypes == want.dtypes and sorted(map(str, rows(got))) == sorted(map(str, rows(want)))


def test_rating_schema_has_dates(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b,c,d,e\nr1,o1,5,2018-01-02,2018-01-03 04:05:06\n")
    row = rows(read_csv(spark, "order_ratings", str(tmp_path / "r.csv")))[0]
    assert str(row["review_creation_date"]) == "2018-01-02" and "order_ratings" in SCHEMAS


def test_append_skips_stored_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "changed"), (3, "c")], "k int, v string")
    assert storage.append_new(old, path, ["k"]).count() == 2
    assert {(r["k"], r["v"]) for r in rows(storage.append_new(new, path, ["k"]))} == {(1, "a"), (2, "b"), (3, "c")}


def test_append_knows_null_keys_and_repeats(spark, tmp_path):
    batch = spark.createDataFrame([(None, "n"), (1, "a"), (1, "a"), (None, "n")], "k int, v string")
    for _ in range(3):
        stored = storage.append_new(batch, str(tmp_path / "t"), ["k"])
        assert sorted(str(r["k"]) for r in rows(stored)) == ["1", "None"]


LOADED = "k string, v int, t timestamp_ntz, kids array<struct<a: int>>"


def keyed(spark, path):
    return storage.KeyedTable(spark, str(path), spark.createDataFrame([], LOADED).schema, ["k"], "t")


def test_loads_of_nested_rows_by_month(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    jan, feb = at("2018-01-31T23:00:00"), at("2018-02-01T01:00:00")

    def load(name, *data):
        table.load(spark.createDataFrame(data, LOADED), name, ["v"])
        return sorted((str(r["k"]), r["v"]) for r in rows(table.rows()))

    assert load("empty") == []
    assert load("a", ("x", 1, jan, [(1,)]), ("x", 2, jan, None), ("y", 5, None, [])) == [("x", 2), ("y", 5)]
    assert load("b", ("x", 9, jan, None), ("z", 3, feb, [(7,)]), (None, 4, feb, None)) == [("None", 4), ("x", 2), ("y", 5), ("z", 3)]
    assert load("c", ("y", 6, None, None), (None, 8, feb, None)) == [("None", 4), ("x", 2), ("y", 5), ("z", 3)]
    # A load of a known name is not looked at.
    assert load("a", ("new", 1, jan, None)) == [("None", 4), ("x", 2), ("y", 5), ("z", 3)]
    assert sorted(p.name for p in (tmp_path / "t" / "rows").glob("load_month=*")) == [
        "load_month=m2018-01", "load_month=m2018-02", "load_month=none",
    ]


def test_a_load_reads_its_own_months_only(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    months = [(f"k{m}", m, at(f"2018-{m:02}-05"), None) for m in range(1, 10)]
    table.load(spark.createDataFrame(months, LOADED), "all")
    batch = table.winners(spark.createDataFrame([months[3]], LOADED))
    unknown = table.unknown(batch, ["m2018-04"])
    plan = unknown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [(load_month") + plan.count("PartitionFilters: [isnotnull(load_month") >= 2
    read = {f for f in unknown.inputFiles() if "/rows/" in f}
    assert unknown.count() == 0 and len(read) == 9  # the listing knows all, the plan prunes:
    stored = table._stored().where("load_month in ('m2018-04')")
    assert stored.rdd.getNumPartitions() == 1


def test_one_load_at_a_time(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    batch = spark.createDataFrame([("x", 1, None, None)], LOADED)
    with table._locked(), pytest.raises(storage.LoadRunning):
        table.load(batch, "second")
    table.load(batch, "second")
    assert table.rows().count() == 1 and not (tmp_path / "t" / "lock").exists()


def test_a_broken_load_can_be_repeated(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    batch = spark.createDataFrame([("x", 1, None, None), ("y", 2, None, None)], LOADED)
    table.load(batch, "a")
    (tmp_path / "t" / "loads" / "a").unlink()  # as if the driver had died before the last step
    table.load(batch, "a")
    assert table.rows().count() == 2


def test_numbers_are_those_of_one_window_per_order(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    lineitem = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    one = lineitem.withColumn("l_orderkey", lineitem["l_orderkey"] % 3)
    order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    a, b = one.withColumn("item_no", F.row_number().over(order).cast("long")), number_by_parts(one)
    assert a.exceptAll(b.select(a.columns)).count() == 0


def test_pipeline_stores_all_layers(spark, shop):
    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).payment("o1", 1, 10.0).review("r1", "o1", 5, "1/2/2018 3:04")
    stored = medallion.build(spark, shop.bronze(), as_views=frozenset({"sales_kpi"}))
    assert {d.name for d in spark.catalog.listDatabases()} >= set(storage.LAYERS)
    assert spark.table("gold.customer_ltv").count() == 1 and spark.table("gold_sales_kpi").count() == 1
    report = {(r["table"], r["column"], r["rule"]): r["failing_rows"] for r in rows(medallion.quality_report(stored))}
    assert report[("customer_ltv", "predicted_ltv_6m_heuristic", "not_null")] == 1
    assert report[("denormalized_orders", "order_id", "unique")] == 0
    assert {name for name, table in stored.items() if "_ingest_ts" in table.columns} == medallion.STAMPED
    # A second run replaces the tables.
    again = medallion.build(spark, shop.bronze(), buckets=2)
    assert again["customer_metrics"].count() == 1 and rows(again["sales_kpi"])[0]["total_sales"] == 10.0


def test_bucketed_silver_needs_no_shuffle_per_order(spark, shop, capsys):
    from shopmart.operators.silver import Silver, denormalized_orders
    from shopmart.operators.tallies import Tally

    shop.order("o1", "2018-01-01").item("o1", 1, 10.0).payment("o1", 1, 10.0)
    table = storage.replace_table(denormalized_orders(shop.bronze()), "bucketed_silver", "order_id", 2)
    silver = Silver.from_table(table)
    pairs = silver.crossed(
        silver.rows, ["order_status"], Tally("items", ["product_category"], "n"), Tally("payments", ["payment_type"], "m")
    )
    pairs.explain()
    assert "Exchange" not in capsys.readouterr().out


def test_rows_with_keys_of_their_own_are_not_moved(spark, tmp_path):
    rows_ = [("a", "2018-01-02", 1), ("a", "2018-01-02", 2), ("b", "2018-01-02", 1), (None, None, 5), (None, None, 6)]
    batch = spark.createDataFrame(rows_, "k string, day string, v int").withColumn("day", F.col("day").cast("date"))
    table = storage.KeyedTable(spark, str(tmp_path / "t"), batch.schema, ["k"], "day")
    won = table.winners(batch, ["v"])
    assert sorted(map(str, won.select("k", "v").collect())) == ["Row(k='a', v=2)", "Row(k='b', v=1)", "Row(k=None, v=6)"]
    plan = won._jdf.queryExecution().executedPlan().toString()
    single = plan[plan.index("LeftAnti"):plan.index("SortAggregate")]
    assert "hashpartitioning" not in single


def test_stored_reports_read_the_nested_table(spark, monkeypatch):
    from shopmart.operators import rules
    from shopmart.operators.silver import Silver
    from shopmart.plans import catalog
    from shopmart.sources.sample import sample_bronze

    used, form = [], catalog.nested_silver
    monkeypatch.setattr(catalog, "nested_silver", lambda bronze: used.append(1) or form(bronze))
    report = catalog.QUERIES["dq_rule_expression"](spark, FOLDER)
    flat = rules.report(catalog._tables(Silver.from_bronze(sample_bronze(spark, FOLDER))), ("expression",))
    assert used == [1] and sorted(map(str, rows(report))) == sorted(map(str, rows(flat)))


def test_a_written_step_frees_its_shuffles(spark):
    from concurrent.futures import ThreadPoolExecutor

    from shopmart.session import FREES_SHUFFLES, cut_lineage

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before = shuffled()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    with ThreadPoolExecutor(3) as pool:
        written = list(pool.map(lambda k: cut_lineage(df.where(F.col("k") >= k)), range(3)))
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(FREES_SHUFFLES) == "false" and [w.count() for w in written] == [7, 6, 5]
    assert shuffled() - before  # what is not written is left alone


def test_whole_rows_move_for_new_keys_only(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(storage, "cut_lineage", lambda df: written.append(df.columns) or cut_lineage(df))
    schema = "k string, j int, moment timestamp_ntz, wide string"
    jan, feb = at("2018-01-05"), at("2018-02-05")
    table = storage.KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k", "j"], "moment")
    table.load(spark.createDataFrame([("a", 1, jan, "x"), ("a", None, jan, "x"), (None, 1, feb, "x")], schema), "first")
    assert not any("wide" in c for c in written)  # all new, each once
    more = [("a", 1, jan, "y"), ("a", None, jan, "y"), (None, 1, feb, "y"), ("b", 1, feb, "y"), ("b", 1, feb, "z"), ("c", 1, None, "y")]
    table.load(spark.createDataFrame(more, schema), "second", ["wide"])
    assert sum("wide" in c for c in written) == 1
    table.load(spark.createDataFrame(more, schema), "third")
    assert sum("wide" in c for c in written) == 1  # nothing new
    got = sorted((r["k"] or "", r["j"] or 0, r["wide"]) for r in rows(table.rows()))
    assert got == [("", 1, "x"), ("a", 0, "x"), ("a", 1, "x"), ("b", 1, "z"), ("c", 1, "y")]
    assert all(table.is_done(x) for x in ("first", "second", "third"))
