import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from stratum.llm import filter_audit, queries
from tests.conftest import SMALL
from tests.llm.test_rules_and_mix import duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Every order played out, document by document."""
    flags, out = [], {}
    for doc_id, text, part in docs:
        t = text or ""
        ws = WORD.findall(t)
        copy = doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, _ in docs)
        fails = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": copy}
        own = [lab for lab in labels if lab[0] is not None and lab[0] == doc_id]
        flags.append((part or "", fails, any(q == 1 for _, q, _ in own), any(x == 1 for _, _, x in own)))
    for part in {f[0] for f in flags}:
        mine = [f[1:] for f in flags if f[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, k in enumerate(order, 1):
                lost = [f for f in left if f[0][k]]
                left = [f for f in left if not f[0][k]]
                total[k] += len(lost)
                rows.append((order, step, len(left), len(lost), sum(f[0][k] for f in mine) - len(lost),
                             sum(f[0][k] and sum(f[0].values()) == 1 for f in mine), sum(f[1] for f in lost), sum(f[2] for f in lost)))
        for r in rows:
            out[part, r[0], r[1]] = (*r[2:], total[r[0][r[1] - 1]])
    return out


def cases():
    rng = random.Random(8)
    pool = ["wort", "Eins", "zwei", "DREI", "a#b", "é", "x|y"] + [f"w{i}" for i in range(300)]
    docs = [(d, " ".join(rng.choice(pool[:rng.choice([3, 5, 300])]) for _ in range(rng.choice([0, 5, 199, 200, 260]))), f"s{d % 3}") for d in range(60)]
    docs += [(100 + d, docs[3][1], rng.choice(["s0", None, ""])) for d in range(20)]
    docs += [(3, docs[3][1], "s0")] * 3 + [(3, "other words", "s1"), (None, None, None), (None, "", "s1"), (None, docs[3][1], "s2"), (200, None, "s0"), (201, "", "s0")]
    docs += [(300, "viele verschiedene Worte " * 30_000, "long"), (301, "\n\x0b \t", "s1")]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in range(110)] + [(3, 0, 1), (3, 1, 0), (None, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"part": F.lit(1), "n": F.lit("x"), "quality": F.lit(1), "digest": F.lit(2)})
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def test_equal_to_every_order_played_out(spark):
    docs, labels = cases()
    want = brute(docs, labels)
    out = filter_audit.audit(*frames(spark, docs, labels))
    assert out.columns == [c.split()[0] for c in filter_audit.SCHEMA.split(", ")]
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in out.collect()}
    assert got == want and out.count() == len(want) == 600 * len({s or "" for _, _, s in docs})


def test_whole_table_equals_sql(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted((tuple(r.asDict().items()) for r in filter_audit.audit(docs, labels).collect()), key=str)
    assert rows == duck(spark, queries.ORACLES["op11_filter_audit"], documents=docs, labels=labels)


def test_potential_of_a_known_game():
    import numpy as np

    counts = np.zeros((1, 32), np.int64)
    counts[0, [1, 3, 7, 31, 0]] = [5, 6, 9, 10, 4]
    game = filter_audit.removal_games(counts)
    p = filter_audit.potentials(game)
    # rows that fail k filters are shared equally by these k
    assert (p[0, 31] - p[0, [31 ^ 1 << i for i in range(5)]]).tolist() == [120 * 5 + 60 * 6 + 40 * 9 + 24 * 10, 60 * 6 + 40 * 9 + 24 * 10, 40 * 9 + 24 * 10, 240, 240]
    assert p[0, 31] - p[0, 30] + sum(p[0, 31] - p[0, 31 ^ 1 << i] for i in range(1, 5)) == 120 * 30


def test_empty_tables(spark):
    docs, labels = frames(spark, *cases())
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert {(r.good_lost, r.toxic_lost) for r in filter_audit.audit(docs, labels.limit(0)).collect()} == {(0, 0)}


def test_own_filters(spark):
    docs, labels = frames(spark, *cases())
    out = filter_audit.audit(docs, labels, {"X": F.col("text").isNull()}).collect()
    assert {r.filter_order for r in out} == {"XE", "EX"} and {r.step for r in out} == {1, 2}
