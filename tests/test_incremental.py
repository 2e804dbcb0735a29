import os

from pyspark.sql import functions as F

from stratum.operators import contracts as ct
from stratum.operators.gold import build_monthly_sales_aggregate, build_sales_fact
from stratum.plans import incremental as inc
from stratum.plans import pipelines as pl
from stratum.sources.lake import LakeConfig, write_table

COLS = ["year_month", "store_id", "product_id", "monthly_revenue", "monthly_margin", "transaction_count"]


def sales(spark, rows):
    """rows: (transaction, day, customer, product)"""
    return spark.createDataFrame([(t, d, c, p, 1, 2.0, 3.5) for t, d, c, p in rows],
                                 "transaction_id string, date_key string, customer_id long, product_id long, store_id long, quantity double, unit_price double")


def customers(spark, ids):
    return spark.createDataFrame([(i, "a", "b", f"c{i}@example.com", "S", "NA", True) for i in ids],
                                 "customer_id long, first_name string, last_name string, email string, segment string, region string, is_active boolean")


def products(spark, costs):
    return spark.createDataFrame(list(costs.items()), "product_id long, standard_cost double")


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        part = os.path.relpath(folder, path)
        own = {n for n in names if n.startswith("part-")}
        if own:
            out[part] = own
    return out


def full(spark, cfg):
    s, c, p = (spark.read.parquet(cfg.silver(t)) for t in ("transactions_cleansed", "customers_conformed", "products_conformed"))
    return sorted(map(tuple, build_monthly_sales_aggregate(build_sales_fact(s, c, p)).select(COLS).collect()), key=str)


def check(spark, cfg):
    got = inc.read_monthly(spark, cfg)
    assert got.schema["year_month"].dataType.simpleString() == "string"
    assert sorted(map(tuple, got.select(COLS).collect()), key=str) == full(spark, cfg)


BASE = [("a", "20240101", 1, 1), ("b", "20240101", 2, 1), ("c", "20240115", 1, 2), ("d", "20240203", 3, 1), ("e", "20240305", 2, 2), ("f", "20240306", None, None)]


def setup(spark, scratch):
    root = scratch("inc")
    cfg = LakeConfig.from_mapping({"silver_base_path": f"{root}/silver", "gold_base_path": f"{root}/gold"})
    put(spark, cfg, BASE, [1, 2, 3], {1: 1.0, 2: 2.0})
    return cfg


def put(spark, cfg, rows, ids, costs):
    write_table(sales(spark, rows), cfg.silver("transactions_cleansed"))
    write_table(customers(spark, ids), cfg.silver("customers_conformed"))
    write_table(products(spark, costs), cfg.silver("products_conformed"))


def test_only_touched_days_and_months_are_rewritten(spark, scratch):
    cfg = setup(spark, scratch)
    first = inc.silver_to_gold_incremental(spark, cfg, lineage=True)
    assert first["days"] == ["20240101", "20240115", "20240203", "20240305", "20240306"] and first["dimension"]
    check(spark, cfg)
    again = inc.silver_to_gold_incremental(spark, cfg, lineage=True)
    assert again["days"] == [] and again["months"] == [] and not again["dimension"]

    before = {t: files(cfg.gold(t)) for t in ("fact_sales", "agg_monthly_sales", "lineage_rows", "dim_customer")}
    write_table(sales(spark, [("late", "20240115", 3, 1)]), cfg.silver("transactions_cleansed"), mode="append")
    run = inc.silver_to_gold_incremental(spark, cfg, lineage=True)
    assert run["days"] == ["20240115"] and run["months"] == ["202401"] and not run["dimension"]
    after = {t: files(cfg.gold(t)) for t in before}
    assert {d for d in before["fact_sales"] if before["fact_sales"][d] != after["fact_sales"][d]} == {"date_key=20240115"}
    for t in ("agg_monthly_sales", "lineage_rows"):
        assert {d for d in before[t] if before[t][d] != after[t][d]} == {"year_month=202401"}
    assert before["dim_customer"] == after["dim_customer"]
    check(spark, cfg)
    rows, known, _ = pl.read_lineage(spark, cfg)
    assert rows.count() == 7 and rows.join(known, "source_file_id").count() == 7


def test_dimension_changes_touch_the_days_that_use_them(spark, scratch):
    cfg = setup(spark, scratch)
    inc.silver_to_gold_incremental(spark, cfg)
    put(spark, cfg, BASE, [1, 2, 3], {1: 1.0, 2: 5.0})  # another cost
    assert inc.silver_to_gold_incremental(spark, cfg)["days"] == ["20240115", "20240305"]
    check(spark, cfg)
    put(spark, cfg, BASE, [1, 2, 3, 3, 3], {1: 1.0, 2: 5.0})  # customer 3 repeats
    run = inc.silver_to_gold_incremental(spark, cfg)
    assert run["days"] == ["20240203"] and run["dimension"]
    check(spark, cfg)
    put(spark, cfg, BASE, [1, 2, 3], {1: 1.0})  # repeats no more; a product is gone
    assert inc.silver_to_gold_incremental(spark, cfg)["days"] == ["20240115", "20240203", "20240305"]
    check(spark, cfg)


def test_days_that_lose_their_rows_are_dropped(spark, scratch):
    cfg = setup(spark, scratch)
    inc.silver_to_gold_incremental(spark, cfg)
    put(spark, cfg, [r for r in BASE if r[0] not in "cd"], [1, 2, 3], {1: 1.0, 2: 2.0})
    run = inc.silver_to_gold_incremental(spark, cfg)
    assert run["dropped_days"] == ["20240115", "20240203"] and run["days"] == []
    assert sorted(files(cfg.gold("agg_monthly_sales"))) == ["year_month=202401", "year_month=202403"]
    assert sorted(files(cfg.gold("fact_sales"))) == ["date_key=20240101", "date_key=20240305", "date_key=20240306"]
    check(spark, cfg)


def test_a_run_that_dies_before_its_mark_is_repeated(spark, scratch, monkeypatch):
    cfg = setup(spark, scratch)
    inc.silver_to_gold_incremental(spark, cfg)
    write_table(sales(spark, [("late", "20240203", 3, 1)]), cfg.silver("transactions_cleansed"), mode="append")

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(inc.fs, "write_text", die)
        try:
            inc.silver_to_gold_incremental(spark, cfg)
        except RuntimeError:
            pass
    assert inc.silver_to_gold_incremental(spark, cfg)["days"] == ["20240203"]
    check(spark, cfg)
    assert len(inc._states(spark, cfg.gold(inc.STATE))) == 2


def test_empty_silver_and_gate(spark, scratch):
    import pytest

    cfg = setup(spark, scratch)
    put(spark, cfg, [], [], {})
    run = inc.silver_to_gold_incremental(spark, cfg)
    assert run["days"] == []
    put(spark, cfg, BASE, [1, 1], {1: 1.0, 2: 2.0})
    with pytest.raises(ct.ContractViolation):
        inc.silver_to_gold_incremental(spark, cfg, customer_contract=ct.customer_contract())
    put(spark, cfg, BASE, [1, 2, 3], {1: 1.0, 2: 2.0})
    inc.silver_to_gold_incremental(spark, cfg, customer_contract=ct.customer_contract())
    check(spark, cfg)


def test_fingerprints_see_repeated_rows_and_order(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z")], "k long, v string")
    a = inc.fingerprint(df, "k", ["k", "v"])
    assert inc.changed_keys(a, inc.fingerprint(df.orderBy(F.desc("v")), "k", ["k", "v"]), "k").count() == 0
    other = spark.createDataFrame([(1, "y"), (1, "y"), (2, "y"), (None, "w"), (3, "n")], "k long, v string")
    assert {r.k for r in inc.changed_keys(a, inc.fingerprint(other, "k", ["k", "v"]), "k").collect()} == {1, None, 3}
