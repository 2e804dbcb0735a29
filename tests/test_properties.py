"""Random small inputs checked against brute-force Python."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions.expressions import money_sum
from stratum.operators import contracts as ct
from stratum.operators.conform import dedup_latest
from stratum.operators.upsert import merge_frames

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(0, 6))
rows = st.lists(st.tuples(keys, st.integers(0, 3), st.sampled_from(["a", "b", "c"])), max_size=12)
COLS = "k int, ts int, v string"


@SETTINGS
@given(target=rows, source=rows)
def test_merge_matches_brute_force(spark, target, source):
    # the source must not repeat a non-null key (the merge would refuse)
    seen, src = set(), []
    for r in source:
        if r[0] is None or r[0] not in seen:
            src.append(r)
            seen.add(r[0])
    got = merge_frames(spark.createDataFrame(target, COLS), spark.createDataFrame(src, COLS), ["k"]).collect()
    src_keys = {r[0] for r in src if r[0] is not None}
    expected = [r for r in target if r[0] is None or r[0] not in src_keys] + src
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@SETTINGS
@given(data=rows)
def test_dedup_latest_matches_brute_force(spark, data):
    got = dedup_latest(spark.createDataFrame(data, COLS).repartition(3), ["k"], ["ts"]).collect()
    best = {}
    for r in data:
        cand = (r[1], r[2])
        if r[0] not in best or cand > best[r[0]]:
            best[r[0]] = cand
    expected = [(k, ts, v) for k, (ts, v) in best.items()]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@SETTINGS
@given(data=st.lists(st.tuples(keys, st.one_of(st.none(), st.sampled_from(["x@y.io", "bad", "q@r.co"])),
                               st.one_of(st.none(), st.sampled_from(["NA", "EMEA", "MARS"]))), max_size=15))
def test_contract_counts_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "customer_id int, email string, region string")
    res = ct.validate(df, ct.customer_contract(), fail_on_error=False).results
    ids = [r[0] for r in data]
    non_null = [i for i in ids if i is not None]
    assert res[0]["unexpected_count"] == ids.count(None)
    assert res[1]["unexpected_count"] == sum(1 for i in non_null if non_null.count(i) > 1)
    assert res[2]["unexpected_count"] == sum(1 for r in data if r[1] == "bad")
    assert res[3]["unexpected_count"] == sum(1 for r in data if r[2] == "MARS")
    for r, exp in zip(res, ct.customer_contract()):
        denom = r["element_count"] - (0 if exp.expectation_type == ct.NOT_NULL else r["missing_count"])
        assert r["success"] == (denom == 0 or (denom - r["unexpected_count"]) / denom >= exp.mostly)


@SETTINGS
@given(amounts=st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=2), min_size=1, max_size=40))
def test_money_sum_is_exact(spark, amounts):
    df = spark.createDataFrame([(float(a),) for a in amounts], "x double").repartition(4)
    got = df.agg(money_sum(F.col("x")).alias("s")).first()["s"]
    assert got == float(sum(amounts, Decimal(0)))


# keys drawn so that one value often dominates (a hot key), plus nulls
skewed = st.one_of(st.none(), st.just(1), st.just(1), st.just(1), st.integers(0, 5))


@SETTINGS
@given(big=st.lists(st.tuples(skewed, st.integers(0, 9)), max_size=30),
       dim=st.lists(st.tuples(skewed, st.sampled_from(["p", "q"])), max_size=8),
       how=st.sampled_from(["left", "inner"]))
def test_salted_join_matches_brute_force(spark, big, dim, how):
    from stratum.operators.joins import skew_join

    b = spark.createDataFrame(big, "k int, x int").repartition(3)
    d = spark.createDataFrame(dim, "k int, v string")
    got = skew_join(b, d, "k", how, max_broadcast_rows=0, salts=4, min_share=0.2).select("k", "x", "v").collect()
    expected = []
    for k, x in big:
        partners = [v for dk, v in dim if k is not None and dk == k]
        expected += [(k, x, v) for v in partners] or ([(k, x, None)] if how == "left" else [])
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@SETTINGS
@given(sales=st.lists(st.tuples(skewed, st.integers(0, 9)), max_size=30),
       customers=st.lists(skewed, max_size=10))
def test_customer_fanout_matches_left_join_multiplicity(spark, sales, customers):
    from stratum.operators.gold import customer_fanout

    s = spark.createDataFrame(sales, "customer_id int, x int")
    c = spark.createDataFrame([(k,) for k in customers], "customer_id int")
    got = customer_fanout(s, c, max_broadcast_rows=0).collect()
    expected = []
    for k, x in sales:
        m = sum(1 for ck in customers if k is not None and ck == k)
        expected += [(k, x)] * max(m, 1)
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@SETTINGS
@given(target=rows, source=rows, bound=st.sampled_from([0, 1000]))
def test_guarded_merge_matches_brute_force(spark, target, source, bound):
    # a keyed table: at most one row per non-null key (null keys may repeat, Q6)
    seen, unique_target = set(), []
    for r in target:
        if r[0] is None or r[0] not in seen:
            unique_target.append(r)
            seen.add(r[0])
    target = unique_target
    got = merge_frames(spark.createDataFrame(target, COLS), spark.createDataFrame(source, COLS), ["k"],
                       on_duplicate="keep", guard="ts", max_broadcast_rows=bound).collect()
    best = {}
    for side, data in ((0, target), (1, source)):
        for k, ts, v in data:
            if k is not None and (k not in best or (ts, side, v) > best[k]):
                best[k] = (ts, side, v)
    expected = [(k, ts, v) for k, (ts, _, v) in best.items()]
    expected += [r for r in target + source if r[0] is None]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
