import pytest
from pyspark.sql import functions as F

from stratum.functions.expressions import EMAIL_PATTERN
from stratum.operators import contracts as ct

COLS = "customer_id long, email string, region string"


def run(spark, rows, rules):
    return ct.validate(spark.createDataFrame(rows, COLS), rules, "s", "a", fail_on_error=False)


def test_not_null_pass_and_fail(spark):
    assert run(spark, [(1, "x", "NA")], [ct.not_null("customer_id")]).success
    res = run(spark, [(1, "x", "NA"), (None, "x", "NA")], [ct.not_null("customer_id")])
    r = res.results[0]
    assert not res.success and r["unexpected_count"] == 1 and r["unexpected_percent"] == 50.0


def test_unique_counts_every_copy_and_ignores_nulls(spark):
    rows = [(1, "a", "NA"), (1, "b", "NA"), (1, "c", "NA"), (2, "d", "NA"), (None, "e", "NA"), (None, "f", "NA")]
    r = run(spark, rows, [ct.unique("customer_id")]).results[0]
    assert (r["element_count"], r["missing_count"], r["unexpected_count"]) == (6, 2, 3)
    assert r["unexpected_percent"] == 75.0 and not r["success"]
    assert run(spark, [(1, "a", "NA"), (None, "b", "NA"), (None, "c", "NA")], [ct.unique("customer_id")]).success


def test_regex_mostly_and_nulls_excluded(spark):  # C6, Q11
    good = [(i, f"c{i}@example.com", "NA") for i in range(99)]
    rule = ct.match_regex("email", EMAIL_PATTERN, mostly=0.99)
    assert run(spark, good + [(99, "bad", "NA")], [rule]).success          # 99/100 >= 0.99
    assert not run(spark, good[:98] + [(98, "bad", "NA"), (99, "bad", "NA")], [rule]).success
    r = run(spark, good + [(100, None, "NA")] * 50, [rule]).results[0]
    assert r["missing_count"] == 50 and r["unexpected_count"] == 0 and r["success"]


def test_in_set_case_sensitive(spark):
    r = run(spark, [(1, "x", "na"), (2, "x", "EMEA")], [ct.in_set("region", ["NA", "EMEA"])]).results[0]
    assert r["unexpected_count"] == 1


def test_zero_non_null_rows_pass(spark):
    rules = [ct.match_regex("email", EMAIL_PATTERN), ct.in_set("region", ["NA"]), ct.unique("customer_id")]
    res = run(spark, [(None, None, None)], rules)
    assert res.success and all(r["unexpected_percent"] is None for r in res.results)


def test_empty_frame(spark):
    res = run(spark, [], [ct.not_null("customer_id"), ct.unique("customer_id")])
    assert res.success and all(r["element_count"] == 0 for r in res.results)


def test_all_rules_evaluated_and_gate_halts(spark):
    df = spark.createDataFrame([(1, "bad", "MARS"), (1, "bad", "MARS"), (None, None, None)], COLS)
    with pytest.raises(ct.ContractViolation) as err:
        ct.gate(df, ct.customer_contract(), "suite", "asset")
    res = err.value.result
    assert [r["success"] for r in res.results] == [False, False, False, False]
    assert res.statistics["unsuccessful_expectations"] == 4
    assert "nothing was promoted" in str(err.value)


def test_two_unique_columns_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a", "NA"), (1, "a", "NA"), (2, "b", "NA")], COLS)
    res = ct.validate(df, [ct.unique("customer_id"), ct.unique("email"), ct.not_null("region")],
                      fail_on_error=False)
    assert [r["unexpected_count"] for r in res.results] == [2, 2, 0]


def test_registry_replaces_suite(spark):
    reg = ct.ContractRegistry()
    reg.define("s", [ct.not_null("customer_id")])
    reg.define("s", [ct.unique("customer_id")])
    assert [e.expectation_type for e in reg.get("s")] == [ct.UNIQUE]
    with pytest.raises(KeyError):
        reg.get("missing")


def test_contract_counts_equal_direct_counts(spark):
    from tests.conftest import MEDIUM
    from stratum.sources.fixtures import customers_dirty

    df = customers_dirty(spark, MEDIUM)
    res = ct.validate(df, ct.customer_contract(), fail_on_error=False).results
    assert res[0]["unexpected_count"] == df.where("customer_id is null").count()
    assert res[3]["unexpected_count"] == df.where("region is not null and region not in "
                                                  "('NA','EMEA','APAC','LATAM')").count()


def test_flagged_rows_and_split(spark):
    rows = [(1, "a@x.de", "NA"), (1, "b@x.de", "EMEA"), (2, "bad", "NA"), (3, None, "MARS"), (None, "c@x.de", "APAC"), (4, "d@x.de", None)]
    # columns named like the helper's own
    df = spark.createDataFrame(rows, "customer_id long, email string, region string").withColumns(
        {"n": F.lit(1), "key_1": F.lit("k"), "row_rules": F.lit("r"), "_key": F.lit(2)})
    flagged = ct.flag_rows(df, ct.customer_contract())
    assert flagged.columns == [*df.columns, "broken_rules"]
    got = {(r.customer_id, r.email): [b.expectation_index for b in r.broken_rules] for r in flagged.collect()}
    assert got == {(1, "a@x.de"): [1], (1, "b@x.de"): [1], (2, "bad"): [2], (3, None): [3], (None, "c@x.de"): [0], (4, "d@x.de"): []}
    good, bad = ct.split_rows(flagged, [0, 3])  # the other rules hold within their tolerance
    assert {r.customer_id for r in good.collect()} == {1, 2, 4} and good.columns == df.columns
    assert {(r.customer_id, len(r.broken_rules)) for r in bad.collect()} == {(3, 1), (None, 1)}
    with pytest.raises(ValueError):
        ct.flag_rows(df.withColumn("broken_rules", F.lit(1)), ct.customer_contract())


def test_several_unique_rules_find_their_keys_in_one_pass(spark):
    rows = [(1, 1, 1), (1, 2, 1), (2, 2, 2), (3, 3, 2), (None, 4, None), (None, 4, None)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    rules = [ct.unique("a"), ct.unique("b"), ct.expectation(ct.COMPOUND_UNIQUE, column_list=["a", "c"])]
    got = sorted((r.a or 0, r.b, r.expectation_index) for r in ct.contract_violations(df, rules).collect())
    assert got == [(0, 4, 1), (0, 4, 1), (1, 1, 0), (1, 1, 2), (1, 2, 0), (1, 2, 1), (1, 2, 2), (2, 2, 1)]
    hot = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 10).alias("a"))
    assert ct.contract_violations(hot, [ct.unique("a")]).count() == 1334


def test_promote_quarantines_once_and_keeps_history(spark, scratch):
    root = scratch("promote")
    df = spark.createDataFrame([(1, "a@x.de", "NA"), (2, "bad", "NA"), (None, "c@x.de", "APAC")], "customer_id long, email string, region string")
    for _ in range(2):  # the same run again replaces its own rows
        good, info = ct.promote(df, ct.customer_contract(), f"{root}/held", "suite", "asset", "7", f"{root}/history")
        assert [r.customer_id for r in good.collect()] == [1] and info["quarantined"] == 2 and info["failed_rules"] == [0, 2]
    assert spark.read.parquet(f"{root}/held").count() == 2
    history = ct.read_history(spark, f"{root}/history")
    assert history.count() == 4 and {r.run_id for r in history.collect()} == {"7"}
    with pytest.raises(ct.ContractViolation):  # no row to blame
        ct.promote(df, [ct.expectation(ct.ROW_COUNT, min_value=10)], f"{root}/held", run_id="8")
    clean, info = ct.promote(df.where("customer_id = 1"), ct.customer_contract(), f"{root}/held", run_id="9")
    assert clean.count() == 1 and info["quarantined"] == 0


def test_a_halt_is_recorded_too(spark, scratch):
    path = scratch("history")
    df = spark.createDataFrame([(None,)], "customer_id long")
    with pytest.raises(ct.ContractViolation):
        ct.gate(df, [ct.not_null("customer_id")], "s", "a", path, "1")
    assert [r.success for r in ct.read_history(spark, path).collect()] == [False]
