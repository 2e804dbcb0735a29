import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import arrow_text as at
from stratum.llm import substring_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    docs = {d: WORD.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(x for x in docs if x is not None):
        for i in range(len(docs[d]) - width + 1):
            first.setdefault(tuple(docs[d][i:i + width]), (d, i))
    out = {}
    for d, w in docs.items():
        gone = set()
        if d is not None:
            for i in range(len(w) - width + 1):
                if first[tuple(w[i:i + width])] != (d, i):
                    gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in sd.dedup(df, **kw).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "dé", "e.", "\x1c", " "]
    passages = [[rng.choice(words) for _ in range(rng.randrange(3, 15))] for _ in range(5)]
    rows = []
    for d in range(50):
        w = []
        for _ in range(rng.randrange(0, 6)):
            w += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randrange(1000)}" for _ in range(rng.randrange(8))]
        rows.append((d * 3, rng.choice([" ", "\n", " \t"]).join(w)))
    return rows + [(500 + k, rows[7][1] + " " + rows[8][1]) for k in range(20)] + [(900, "x " * 300)]


@pytest.mark.parametrize("cells", [18, 3])
def test_equals_brute_force(spark, cells):
    """With a sketch of eight cells every window passes the prefilter; the result is the same."""
    rows = corpus(cells)
    want = sorted(((d, *v) for d, v in brute(rows, 5).items()), key=str)
    assert got(spark, rows, width=5, log2_cells=cells) == want


def test_chunks_and_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 40)
    rows = corpus(77)
    want = sorted(((d, *v) for d, v in brute(rows, 5).items()), key=str)
    assert got(spark, rows, width=5, log2_cells=14, buckets=3) == want


def test_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    h = np.concatenate([h, h[:1000], h[:10]])
    import pyarrow as pa

    parts = [x for lo in (0, 2500, 5500) for x in sd.partition_sketch(h[lo:{0: 2500, 2500: 5500, 5500: 9999}[lo]], 12)]
    batch = pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names=["block", "cells"])
    bits = dict((b, t) for b, t, _ in sd.merge_sketches(iter([batch]), 12))
    size = (1 << 12) // 8
    whole = b"".join(bits.get(r, bytes(size)) for r in range(2))
    seen = sd.estimated_repeated(h, np.frombuffer(whole, np.uint8), 12)
    values, counts = np.unique(h, return_counts=True)
    assert seen[np.isin(h, values[counts > 1])].all()


def test_rolling_hashes():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    w = at.window_hashes(np.concatenate([h, h[40:90]]), 7)
    assert (w[300:] == w[40:84]).all() and len(np.unique(w[:294])) == 294


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(8))
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, " \n"), (None, text), (5, text), (6, "w0 w1")]
    out = got(spark, rows, width=5)
    none = hashlib.sha256(b"").hexdigest()
    full = hashlib.sha256(text.encode()).hexdigest()
    assert out.count((1, 8, 0, full, text)) == 2 and (5, 8, 8, none, "") in out and (None, 8, 0, full, text) in out
    assert {(2, 0, 0, none, ""), (3, 0, 0, none, ""), (4, 0, 0, none, "")} <= set(out) and len(out) == 8
    empty = spark.createDataFrame([], "doc_id long, text string, n_words string, bucket int")
    assert sd.dedup(empty, log2_cells=10).count() == 0


def test_texts_of_one_bucket_pass_by_in_slices(spark):
    """All runs of a bucket are known to each of its texts, and no call sees more than a slice of them."""
    texts = spark.range(300).select(F.lit(3).cast("long").alias("bucket"), F.col("id").alias("doc_id"), F.repeat(F.lit("abcde "), 10_000).alias("text"))
    texts = texts.unionByName(texts.limit(1).select(F.lit(4).cast("long").alias("bucket"), F.lit(None).cast("long").alias("doc_id"), "text"))
    runs = [(3, bytearray(at.pack(np.array([d]), np.array([7]), np.array([d + 1])))) for d in range(0, 300, 2)] + [(5, bytearray(at.pack(*[np.array([1])] * 3)))]
    gone = spark.createDataFrame(runs, "bucket long, runs binary")

    def cut(known, batch):
        found = [int(sd.runs_of(known, d)[1].sum()) for d in batch.column(0).to_pylist()]
        size = sum(map(len, batch.column(1).to_pylist()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), pa.array([size] * len(found), pa.int64())], names=["doc_id", "found", "size"])

    out = sd.cut_in_stream(texts, gone, cut, "doc_id long, found long, size long").collect()
    assert {r.doc_id: r.found for r in out} == {None: 0} | {d: d + 1 if d % 2 == 0 else 0 for d in range(300)} and len(out) == 301
    assert max(r.size for r in out) <= 3 << 20
