"""Publishing, repeated days, ids at any size, clean-up."""

import pathlib
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemart import session
from tidemart.operators import scd
from tidemart.operators.marts import build_fact_sales
from tidemart.plans import daily, dimension, queries
from tidemart.sources import lake, parts, testdata as td

SF = "/root/testdata/sf0.001"


def fresh(spark, label):
    return session.scratch_dir(spark, label), session.scratch_name(spark, "databases", "t")


def test_publish_keeps_rows_and_columns(spark):
    root, db = fresh(spark, "t-publish")
    name = f"{db}.things"
    key, old = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, n in (("4", 1000), ("16", 1500)):
            spark.conf.set(key, parts)
            df = spark.range(n).withColumn("v", F.col("id") * 2)
            if parts == "16":
                df = df.withColumn("extra", F.lit("x")).select("extra", "v", "id")
            lake.publish_snapshot(df.repartition("id"), root, "things", name, "same-id")
        t = spark.table(name)
        assert t.count() == 1500 == t.groupBy("id").count().count() == t.join(spark.range(1500), "id").count()
        assert t.where("extra = 'x' and v = id * 2").count() == 1500
        lake.publish_snapshot(spark.range(7), root, "things", name, "same-id")  # without the other columns
        assert spark.table(name).where("v is null and extra is null").count() == 7
        with pytest.raises(ValueError, match="column id changes"):
            lake.publish_snapshot(spark.createDataFrame([("a",)], "id string"), root, "things", name)
        assert spark.table(name).count() == 7  # nothing was switched
    finally:
        spark.conf.set(key, old)


def test_a_reader_of_the_old_snapshot_is_not_disturbed(spark):
    root, db = fresh(spark, "t-reader")
    path = lake.publish_snapshot(spark.range(3), root, "t", f"{db}.t")
    old = spark.read.parquet(path)
    lake.publish_snapshot(spark.range(5), root, "t", f"{db}.t")
    assert old.count() == 3 and spark.table(f"{db}.t").count() == 5


def test_a_hot_customer_of_a_published_dimension_is_split(spark, capsys):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    root, db = fresh(spark, "t-hot")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        dim = spark.range(2000).select(F.col("id").alias("customer_id"), F.col("id").alias("customer_sk"),
                                       F.lit("T").alias("loyalty_tier"), F.lit(True).alias("is_current"))
        lake.publish_snapshot(dim, root, "dim", f"{db}.dim")
        orders = spark.range(30000).select(
            F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 2000).alias("customer_id"),
            F.lit("P").alias("order_status"), F.lit(date(2030, 1, 1)).alias("order_date"))
        items = orders.select("order_id", F.col("order_id").cast("string").alias("order_item_id"),
                              F.lit(1).alias("product_id"), F.lit(1).alias("quantity"), F.lit(1.0).alias("unit_price"),
                              F.lit(0.0).alias("discount_pct"), F.lit(1.0).alias("line_total"))
        fact = build_fact_sales(items, orders, spark.table(f"{db}.dim"))
        assert len(fact.collect()) == 30000
        fact.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_sources(spark, quantity=2, tier="gold", seen=datetime(2031, 1, 1)):
    def one(ddl, *row):
        return spark.createDataFrame([row], ddl)
    ntz = "updated_at timestamp_ntz"
    customers = one("customer_id long, first_name string, last_name string, email string, address string, city string, "
                    f"state string, postal_code string, country string, loyalty_tier string, {ntz}",
                    1, "a", "b", "a@b.cd", "r", "c", "s", "p", "o", tier, seen)
    return {
        "customers": customers,
        "products": one(f"product_id long, sku string, {ntz}", 3, "S", seen),
        "orders": one(f"order_id long, customer_id long, order_status string, order_date timestamp_ntz, shipping_cost double, {ntz}",
                      9, 1, "placed", datetime(2031, 1, 1), 1.0, seen),
        "order_items": one("order_item_id string, order_id long, product_id long, quantity int, unit_price decimal(9,2), "
                           "discount_pct decimal(5,2)", "9-1", 9, 3, quantity, Decimal(10), Decimal(0)),
        "inventory": one(f"inventory_id long, product_id long, warehouse_code string, {ntz}", 3, 3, "W", seen),
    }


def test_days_can_be_repeated_and_resumed(spark, monkeypatch):
    root, db = fresh(spark, "t-days")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    report = lambda rows: {(r["loyalty_tier"], r["revenue"]) for r in rows.collect()}
    assert report(daily.run_daily(spark, small_sources(spark), root, "2031-01-02", cat)) == {("GOLD", 20.0)}
    second = small_sources(spark, quantity=3, tier="silver", seen=datetime(2031, 1, 2))
    whole = lake.publish_snapshot

    def broken(df, root, table, *args):
        if table == "gold_fact_sales":
            raise RuntimeError("half-way")
        return whole(df, root, table, *args)

    monkeypatch.setattr(lake, "publish_snapshot", broken)
    with pytest.raises(RuntimeError):
        daily.run_daily(spark, second, root, "2031-01-03", cat)
    monkeypatch.undo()
    for _ in range(2):  # after the failure, and once more
        assert report(daily.run_daily(spark, second, root, "2031-01-03", cat)) == {("SILVER", 30.0)}
    versions = spark.table(cat.name("gold", "dim_customer")).collect()
    assert sorted((r["loyalty_tier"], r["is_current"]) for r in versions) == [("GOLD", False), ("SILVER", True)]
    assert spark.table(cat.name("silver", "order_items")).count() == 1


def test_day_two_reads_its_own_bronze_and_touched_parts(spark):
    root, db = fresh(spark, "t-upkeep")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    products = lambda ids, sku: spark.createDataFrame(
        [(i, sku, datetime(2031, 1, 1)) for i in ids], "product_id long, sku string, updated_at timestamp_ntz")
    other = small_sources(spark)
    for day, rows in (("2031-01-02", products(range(200), "A")), ("2031-01-03", products([5, 900], "B"))):
        daily.run_extract({**other, "products": rows}, root, day)
        daily.run_bronze(spark, root, day)
        if day == "2031-01-03":  # the first day's loads are not read again
            lost = pathlib.Path(f"{root}/bronze/products/_load_date=2031-01-02")
            for f in lost.iterdir():
                f.write_bytes(b"")
        state = daily.run_silver(spark, root, cat, day)["products"]
    found = {r["product_id"]: r["sku"] for r in spark.table(cat.name("silver", "products")).collect()}
    assert found == {**dict.fromkeys(range(200), "A"), 5: "B", 900: "B"}
    assert spark.table(cat.name("silver", "products")).columns == ["product_id", "sku", "updated_at"]
    second = [live for f, live in state.folders.items() if "c=000000002" in f][0]
    assert 1 <= len(second) <= 2 and state.n_parts == 16  # two keys: at most two parts were written


def test_incremental_silver_equals_a_rebuild(spark):
    states = {}
    for label in ("step", "whole"):
        root, db = fresh(spark, f"t-{label}")
        cat = daily.Catalog(prefix=db)
        for layer in ("silver", "gold"):
            session.remember(spark, "databases", f"{db}_{layer}")
        for day, sources in (("2026-05-01", queries.adapter_sources(spark, SF)), ("2026-06-02", td.day_two_sources(spark, SF))):
            daily.run_extract(sources, root, day)
            daily.run_bronze(spark, root, day)
            if label == "step" or day == "2026-06-02":
                daily.run_silver(spark, root, cat, day)
        states[label] = {t: sorted(map(str, spark.table(cat.name("silver", t)).collect())) for t in (
            "customers", "orders", "orders_quarantine", "order_items", "products", "inventory")}
    assert states["step"] == states["whole"]


def test_types_widen_without_loss(spark):
    assert lake.wider(IntegerType(), LongType()) == LongType() == lake.wider(LongType(), IntegerType())
    assert lake.wider(DecimalType(10, 2), DecimalType(9, 4)) == DecimalType(12, 4)
    assert lake.wider(IntegerType(), DecimalType(5, 2)) == DecimalType(12, 2)
    assert lake.wider(LongType(), DoubleType()) is None and lake.wider(StringType(), LongType()) is None
    assert lake.wider(DecimalType(38, 0), DecimalType(38, 10)) is None
    root, db = fresh(spark, "t-wide")
    narrow = spark.createDataFrame([(1, Decimal("2.50"), 1.5)], "id int, price decimal(6,2), f float")
    wide = spark.createDataFrame([(5000000000, Decimal("123456789.1234"), 2.5)], "id long, price decimal(14,4), f double")
    for day, df in (("2031-01-01", narrow), ("2031-01-02", wide), ("2031-01-03", narrow)):
        lake.write_raw(df, root, "t", day)
        lake.load_raw_to_bronze(spark, root, "t", day)
    want = [(1, Decimal("2.5000"), 1.5), (1, Decimal("2.5000"), 1.5), (5000000000, Decimal("123456789.1234"), 2.5)]
    assert sorted((r["id"], r["price"], r["f"]) for r in lake.read_bronze(spark, root, "t").collect()) == want
    for df in (narrow, wide, narrow):
        lake.publish_snapshot(df, root, "t", f"{db}.t")
    assert dict(spark.table(f"{db}.t").dtypes) == {"id": "bigint", "price": "decimal(14,4)", "f": "double"}
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [want[0]]


def test_two_loads_that_add_columns_at_once_both_count(spark):
    root, _ = fresh(spark, "t-race")
    lake.record_schema(spark, root, "raw", "t", spark.range(1).schema)
    stale = lake.stored_schema(spark, root, "raw", "t")
    one, two = spark.range(1).withColumn("a", F.lit(1)).schema, spark.range(1).withColumn("b", F.lit("x")).schema
    lake.record_schema(spark, root, "raw", "t", one)
    merged = lake.merge_schema(stale, two, "t")  # the second load has read the schema before the first wrote its own
    spark.createDataFrame([(merged.json(),)], "value string").write.text(f"{root}/_control/schemas/raw-t/v=1-other")
    assert sorted(lake.stored_schema(spark, root, "raw", "t").fieldNames()) == ["a", "b", "id"]


def test_writes_merge_small_and_split_hot_partitions(spark):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1500k", "spark.sql.shuffle.partitions": "50"}
    old = {k: spark.conf.get(k, None) for k in conf}
    root, _ = fresh(spark, "t-files")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        many = spark.range(0, 2000, 1, 40)
        lake.publish_snapshot(many, root, "small")
        small = len(list(pathlib.Path(root).glob("snapshots/small/*/part-*.parquet")))
        hot = spark.range(100000).withColumn("k", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5)).withColumn(
            "pad", F.sha2(F.col("id").cast("string"), 256))
        lake.balanced(hot, "k").write.partitionBy("k").parquet(f"{root}/hot")
        files = {d.name: sorted(f.stat().st_size for f in d.glob("*.parquet")) for d in pathlib.Path(f"{root}/hot").glob("k=*")}
        assert small <= 3  # not 40
        assert len(files["k=0"]) >= 4 and len(files["k=1"]) <= 3  # the hot value is split, the others are not
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_table_in_parts(spark):
    root, db = fresh(spark, "t-parts")
    rows = spark.range(1000).withColumn("v", F.lit(1))
    state = parts.commit(spark, root, "t", None, rows, None, key=["id"], n_parts=32)
    parts.publish(spark, root, state, f"{db}.t")
    reader = spark.table(f"{db}.t")
    key, old = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, "3")  # rows stay in their parts whatever the session says
    try:
        change = spark.createDataFrame([(7, 2), (8, 2), (5000, 2)], "id long, v int")
        hit = parts.touched(change, state)
        kept = parts.read(spark, state, hit).join(change.select("id"), "id", "left_anti")
        second = parts.commit(spark, root, "t", parts.load(spark, root, "t"), kept.unionByName(change), hit,
                              history=change.limit(0), name="two")
        third = parts.commit(spark, root, "t", second, parts.read(spark, second, hit[:1]).withColumn("w", F.lit("x")), hit[:1],
                             history=spark.createDataFrame([(7, 1)], "id long, v int"), max_folders=2)
    finally:
        spark.conf.set(key, old)
    assert reader.count() == 1000  # a reader of the first state is not disturbed
    written = [live for f, live in second.folders.items() if "c=000000002" in f][0]
    assert set(written) == set(hit) and len(hit) <= 3  # a change of three keys writes at most three of 32 parts
    parts.publish(spark, root, second, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 1001 and spark.table(f"{db}.t").where("v = 2").count() == 3
    assert len(third.folders) == 1 and parts.HISTORY in next(iter(third.folders.values()))  # folded into one folder
    parts.publish(spark, root, third, f"{db}.t", drop=["v"])
    assert spark.table(f"{db}.t").columns == ["id", "w"] and spark.table(f"{db}.t").count() == 1002
    assert parts.load(spark, root, "t") == third and third.names == ("two",)
    fourth = parts.commit(spark, root, "t", third, rows.limit(0), None, keep_history=False)
    parts.publish(spark, root, fourth, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 0 == parts.read(spark, fourth).count()


def test_old_states_are_deleted_after_a_minimum_age(spark):
    root, db = fresh(spark, "t-clean")
    paths = [lake.publish_snapshot(spark.range(n), root, "t", f"{db}.t") for n in (1, 2, 3)]
    assert lake.clean_snapshots(spark, root, "t", f"{db}.t", 1) == []  # too young
    assert lake.clean_snapshots(spark, root, "t", f"{db}.t", -1) == sorted(p.rsplit("/", 1)[1] for p in paths[:2])
    assert spark.table(f"{db}.t").count() == 3 and lake.clean_snapshots(spark, root, "none", f"{db}.none", -1) == []
    state = None
    for n in (10, 20, 30):
        state = parts.commit(spark, root, "p", state, spark.range(n), None, key=["id"], n_parts=4)
    parts.publish(spark, root, state, f"{db}.p")
    assert parts.clean(spark, root, "p", 1) == [] and len(parts.clean(spark, root, "p", -1)) == 4
    assert spark.table(f"{db}.p").count() == 30 and parts.load(spark, root, "p") == state
    assert parts.clean(spark, root, "none", -1) == []


def test_a_dimension_rewrites_the_parts_that_change(spark):
    root, db = fresh(spark, "t-dim")
    columns = ["customer_id", "loyalty_tier", "address", "city", "state", "postal_code", "email", "first_name", "last_name",
               "country"]
    src = spark.range(3000).select(F.col("id").alias("customer_id"), *[F.lit("x").alias(c) for c in columns[1:]])
    first = dimension.merge_dimension(spark, root, "dim", f"{db}.dim", src, date(2026, 1, 1), n_parts=64)
    moved = src.withColumn("loyalty_tier", F.when(F.col("customer_id") < 20, "y").otherwise("x"))
    second = dimension.merge_dimension(spark, root, "dim", f"{db}.dim", moved, date(2026, 2, 1))
    written = [live for f, live in second.folders.items() if f not in first.folders][0]
    assert 10 <= len([p for p in written if p >= 0]) <= 20 and parts.HISTORY in written
    whole = scd.compute_scd2_snapshot(scd.initialize_dimension(src, as_of_date=date(2026, 1, 1)), moved, date(2026, 2, 1))
    assert sorted(map(tuple, spark.table(f"{db}.dim").select(*whole.columns).collect()), key=str) == sorted(
        map(tuple, whole.collect()), key=str)
    assert dimension.newest(second) == (3020, date(2026, 2, 1))
    same = dimension.merge_dimension(spark, root, "dim", f"{db}.dim", moved, date(2026, 3, 1))
    assert same.seq == second.seq  # nothing changes, nothing is written
    with pytest.raises(ValueError, match="before the newest version"):
        dimension.merge_dimension(spark, root, "dim", f"{db}.dim", moved, date(2026, 1, 15))
    assert spark.table(f"{db}.dim").schema == StructType([StructField(f.name, f.dataType, True) for f in scd.dim_schema(
        src.schema).fields])


def test_maxima_come_from_footers(spark, capsys):
    root, _ = fresh(spark, "t-footers")
    df = spark.range(1, 5001).select(F.col("id").alias("customer_sk"), F.date_add(F.lit("2026-01-01").cast("date"), (
        F.col("id") % 50).cast("int")).alias("effective_start_date"), F.lit("x").alias("other"))
    path = lake.publish_snapshot(df, root, "dim")
    scd.dim_maxima(lake.from_footers(spark, path), scd.CUSTOMER_SCD).explain("formatted")
    assert "PushedAggregation: [MAX(customer_sk), MAX(effective_start_date)]" in capsys.readouterr().out
    assert scd.dim_stats(df, scd.CUSTOMER_SCD, path) == (5000, date(2026, 2, 19))
    empty = lake.publish_snapshot(df.limit(0), root, "none")
    assert scd.dim_stats(df.limit(0), scd.CUSTOMER_SCD, empty) == (None, None)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the session's own scans are as before


def test_passthrough_keeps_every_load(spark):
    root, _ = fresh(spark, "t-pass")
    for day in ("2031-01-01", "2031-01-02"):
        lake.write_raw(spark.createDataFrame([(1, "S")], "product_id long, sku string").withColumn(
            "_extracted_at", F.current_timestamp()).withColumn("updated_at", F.lit(day)), root, "products", day)
        lake.load_raw_to_bronze(spark, root, "products", day)
    assert daily.silver_latest(spark, root, "products", passthrough=True).count() == 2
    assert [r["updated_at"] for r in daily.silver_latest(spark, root, "products").collect()] == ["2031-01-02"]


def test_ids_stay_distinct_up_to_ten_billion(spark):
    keys = sorted({0, 1, 99_999, 100_000, 100_001, 999_999, 1_000_000, 10**10, 10**10 - 1, *range(12340, 12350)})
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    skus = [r[0] for r in df.select(td.sku(F.col("k"))).collect()]
    assert len(set(skus)) == len(keys) and "SKU-000001" in skus and f"SKU-{10**10}" in skus
    new = {r[0] for r in df.select(td.new_key(F.col("k"))).collect()}
    assert len(new) == len(keys) and not new & set(keys)


def test_schema_reads_open_no_footers(spark):
    root, _ = fresh(spark, "t-schema")
    lake.write_raw(spark.range(2), root, "t", "2031-01-01")
    lake.write_raw(spark.range(2).withColumn("more", F.lit("x")), root, "t", "2031-01-02")
    for day in ("2031-01-01", "2031-01-02"):
        lake.load_raw_to_bronze(spark, root, "t", day)
    assert lake.stored_schema(spark, root, "raw", "t").fieldNames() == ["id", "more"]
    assert sorted(str(r["more"]) for r in lake.read_bronze(spark, root, "t").collect()) == ["None", "None", "x", "x"]
    with pytest.raises(ValueError):
        lake.write_raw(spark.createDataFrame([("a",)], "id string"), root, "t", "2031-01-03")
    with pytest.raises(FileNotFoundError):
        lake.read_bronze(spark, root, "absent")


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Session())


def test_release_deletes_what_was_made(spark):
    kept = dict(session._MADE.get(spark, {}))
    session._MADE.pop(spark, None)
    try:
        df = session.materialize(spark.range(3), "t-release")
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        name = session.scratch_name(spark, "views", "v")
        df.createOrReplaceTempView(name)
        spark.sql(f"CREATE DATABASE {session.scratch_name(spark, 'databases', 'd')}")
        assert session.path_exists(spark, path)
        assert session.release(spark) == 3
        assert not session.path_exists(spark, path) and not spark.catalog.tableExists(name)
    finally:
        session._MADE[spark] = kept


def test_layers_are_written_as_the_source_is_split(spark):
    root, _ = fresh(spark, "t-splits")
    files = lambda layer: len(list(pathlib.Path(root).glob(f"{layer}/t/**/part-*.parquet")))
    lake.write_raw(spark.range(0, 1000, 1, 5), root, "t", "2031-01-02")
    assert files("raw") == 5  # no exchange has merged them
    lake.load_raw_to_bronze(spark, root, "t", "2031-01-02")
    assert lake.read_bronze(spark, root, "t").count() == 1000


def test_silver_moves_rows_once(spark, monkeypatch):
    root, db = fresh(spark, "t-once")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    plans, kept, balanced = {}, parts.commit, []

    def commit(spark, root, table, state, rows, *args, **kwargs):
        plans.setdefault(table, []).append(rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return kept(spark, root, table, state, rows, *args, **kwargs)

    monkeypatch.setattr(parts, "commit", commit)
    monkeypatch.setattr(lake, "balanced", lambda df, *cols: balanced.append(cols) or df)
    for day, sources in (("2026-05-01", queries.adapter_sources(spark, SF)), ("2026-06-02", td.day_two_sources(spark, SF))):
        daily.run_extract(sources, root, day)
        daily.run_bronze(spark, root, day)
        daily.run_silver(spark, root, cat, day)
    silver = {table: counts for table, counts in plans.items() if table.startswith("silver_")}
    assert not balanced and len(silver) == 5
    assert all(counts[0] == 1 for counts in silver.values())
    assert silver["silver_customers"] == [1, 1]


@pytest.mark.parametrize("slice_rows", [1_000_000, 20])  # without and with a hot key
def test_silver_of_part_of_the_keys_and_a_hot_one(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(parts, "SLICE_ROWS", slice_rows)
    root, db = fresh(spark, "t-kept")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    other = small_sources(spark)
    products = lambda rows: spark.createDataFrame(
        [(i, sku, datetime(2031, 1, 1)) for i, sku in rows], "product_id long, sku string, updated_at timestamp_ntz")
    days = {"2031-01-02": [*((i, "A") for i in range(300)), (None, "N")],
            "2031-01-03": [*((i, "B") for i in range(200)), *((7, f"h{i:04d}") for i in range(1000)), (None, "M")]}
    for day, rows in days.items():
        assert parts.spread(products(rows), ["product_id"], 16).hot == (slice_rows == 20 and day == "2031-01-03")
        daily.run_extract({**other, "products": products(rows)}, root, day)
        daily.run_bronze(spark, root, day)
        daily.run_silver(spark, root, cat, day)
    found = sorted((r["product_id"] or -1, r["sku"]) for r in spark.table(cat.name("silver", "products")).collect() if r["product_id"] != 0)
    want = {i: "B" if i < 200 else "A" for i in range(1, 300)} | {7: "B", -1: "M"}
    assert found == sorted(want.items())


def test_facts_are_written_as_the_join_deals_them(spark, monkeypatch):
    root, db = fresh(spark, "t-facts")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    balanced, whole = [], lake.balanced
    monkeypatch.setattr(lake, "balanced", lambda df, *cols: balanced.append(df.columns) or whole(df, *cols))
    daily.run_daily(spark, small_sources(spark), root, "2031-01-02", cat)
    assert not [c for c in balanced if "line_total" in c]
    assert spark.table(cat.name("gold", "fact_sales")).count() == 1


def test_totals_are_not_moved_to_the_fact_join(spark, monkeypatch):
    root, db = fresh(spark, "t-totals")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    plans, whole = [], lake.publish_snapshot
    monkeypatch.setattr(lake, "publish_snapshot", lambda df, *args: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or whole(df, *args))
    daily.run_daily(spark, queries.adapter_sources(spark, SF), root, "2031-01-02", cat)
    assert len(plans) == 1 and "ReadSchema" in plans[0]
    assert not [line for line in plans[0].splitlines() if "ReadSchema" in line and "line_total" in line]
    fact, items = spark.table(cat.name("gold", "fact_sales")), spark.table(cat.name("silver", "order_items"))
    both = fact.join(items.withColumnRenamed("line_total", "stored"), "order_item_id")
    assert both.count() == fact.count() > 0 and both.filter(~F.col("line_total").eqNullSafe(F.col("stored"))).count() == 0


@pytest.mark.parametrize("earlier", [False, True])  # whether the first day's bronze has changed since
def test_a_day_again_reads_the_runs_that_came_since(spark, monkeypatch, earlier):
    root, db = fresh(spark, "t-again")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    read, kept = {}, parts.spread

    def spread(rows, keys, n_parts):
        read[keys[0]] = rows.count()
        return kept(rows, keys, n_parts)

    monkeypatch.setattr(parts, "spread", spread)
    other = small_sources(spark)
    products = lambda rows: spark.createDataFrame(
        [(i, sku, datetime(2031, 1, 1)) for i, sku in rows], "product_id long, sku string, updated_at timestamp_ntz")

    def load(day, rows, silver=True):
        daily.run_extract({**other, "products": products(rows)}, root, day)
        daily.run_bronze(spark, root, day)
        if silver:
            daily.run_silver(spark, root, cat, day)

    load("2031-01-02", [(i, "A") for i in range(300)])
    load("2031-01-03", [(i, "B") for i in range(200)])
    if earlier:
        load("2031-01-02", [(i, "C") for i in range(250, 310)], silver=False)
    load("2031-01-03", [*((i, "D") for i in range(100, 250)), (400, "D")])
    want = {i: "A" for i in range(300)} | ({i: "C" for i in range(250, 310)} if earlier else {})
    want |= {i: "B" for i in range(200)} | {i: "D" for i in [*range(100, 250), 400]}
    found = lambda: {r["product_id"]: r["sku"] for r in spark.table(cat.name("silver", "products")).collect()}
    assert read["product_id"] == (300 + 60 + 200 + 151 if earlier else 151) and found() == want
    load("2031-01-03", [(5, "E")])
    assert read["product_id"] == 1 and found() == want | {5: "E"}
    daily.run_silver(spark, root, cat)  # without a date: from all of bronze
    assert read["product_id"] > 300 and found() == want | {5: "E"}
    assert spark.table(cat.name("silver", "products")).count() == len(want)


def test_a_day_leaves_no_shuffle_files_and_scratch(spark):
    # they stayed until the driver collected its garbage and until release
    root, db = fresh(spark, "t-freed")
    cat = daily.Catalog(prefix=db)
    for layer in ("silver", "gold"):
        session.remember(spark, "databases", f"{db}_{layer}")
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {f for d in folders for f in pathlib.Path(d).glob("*/shuffle_*.data")}
    scratch = lambda: set((pathlib.Path(root).parent).iterdir())
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf, files, made = spark.conf.get(key), shuffles(), scratch()
    for day, tier, seen in (("2031-01-02", "gold", 1), ("2031-01-03", "silver", 2), ("2031-01-03", "silver", 2)):
        sources = small_sources(spark, tier=tier, seen=datetime(2031, 1, seen))
        daily.run_extract(sources, root, day)
        daily.run_bronze(spark, root, day)
        daily.run_silver(spark, root, cat, day)
        report = daily.run_gold(spark, root, cat, date.fromisoformat(day))
    left = []
    for _ in range(50):  # they are removed in the background
        left = shuffles() - files
        if not left:
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == conf
    assert scratch() - made == {pathlib.Path(root)}
    assert [r["loyalty_tier"] for r in report.collect()] == ["SILVER"] == [r["loyalty_tier"] for r in report.collect()]
