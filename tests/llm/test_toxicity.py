import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import toxicity as tx


def test_subsequences_are_the_gapped_triples():
    code, word = tx.encode(["aBc-d", "", "é9"])
    assert code.tolist() == [62, 1, 2, 3, 4, 63, 62, 63, 62, 37 + ord("é") % 25, 9 + 27, 63] and word.tolist() == [0] * 6 + [1] * 2 + [2] * 4
    found = {}
    for f, w, weight in tx.subsequences(code, word):
        for a, b in zip(f.tolist(), w.tolist(), strict=True):
            found.setdefault((b, a), []).append(weight)
    a, b, c, d = 1, 2, 3, 4
    key = lambda x, y, z: (x * 64 + y) * 64 + z
    assert found[(0, key(a, b, c))] == [pytest.approx(tx.DECAY ** 3)]
    assert found[(0, key(a, c, d))] == [pytest.approx(tx.DECAY ** 4)]
    assert found[(0, key(62, d, 63))] == [pytest.approx(tx.DECAY ** 6)]
    assert not any(w == 1 for w, _ in found)  # a word without letters has none


def test_folded_model_equals_nystroem_kernel():
    rng = random.Random(0)
    pos = ["idiot", "moron", "scumbag", "loserboy"]
    neg = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    model = tx.fit_words(pos, neg, np.ones(len(pos)))
    m = model.margins(pos + neg)
    assert m[:4].min() > 0.3 > m[4:].max()
    near = model.margins(["id-iot", "i.d.i.o.t", "IDIOT!!", "idxiot", "idiiot"])
    assert near[:3].min() > 0.3 and near.min() > np.quantile(m[4:], 0.97)
    one = [model.margins([w])[0] for w in pos]
    assert np.allclose(one, m[:4])


def brute_kernel(x, y):
    """Gap-weighted kernel of two words by enumeration of all character triples within the span."""
    def counts(w):
        chars = "\x02" + "".join(c for c in w.lower() if c.isalnum()) + "\x03"
        out = {}
        for i in range(len(chars)):
            for j in range(i + 1, len(chars)):
                for k in range(j + 1, min(len(chars), i + tx.SPAN)):
                    out.setdefault(chars[i] + chars[j] + chars[k], []).append(tx.DECAY ** (k - i + 1))
        return out
    a, b = counts(x), counts(y)
    norm = lambda c: sum(v * v for vs in c.values() for v in vs) ** 0.5
    return sum(sum(a[t]) * sum(b[t]) for t in a if t in b) / (norm(a) * norm(b))


def test_margins_are_those_of_the_explicit_kernel():
    rng = random.Random(5)
    pos = ["idiot", "moron", "scum"]
    neg = ["".join(rng.choice("abcdeimnort") for _ in range(rng.randrange(3, 9))) for _ in range(60)]
    model = tx.fit_words(pos, neg, np.array([2.0, 1.0, 1.0]))
    marks = list(dict.fromkeys(pos + neg))
    values, vectors = np.linalg.eigh(np.array([[brute_kernel(a, b) for b in marks] for a in marks]))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    nystroem = lambda words: np.array([[brute_kernel(w, m) for m in marks] for w in words]) @ root
    weight = np.r_[np.array([0.5, 0.25, 0.25]), np.full(len(neg), 1 / len(neg))]
    w = tx.fit_svm(nystroem(pos + neg), np.r_[np.ones(3), -np.ones(len(neg))], weight)
    words = [*pos, *neg[:10], "idxiot", "mo-ron", "unrelated"]
    assert np.allclose(model.margins(words), nystroem(words) @ w[:-1] + w[-1], atol=2e-3)


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(2, 1, (50, 3)), rng.normal(-2, 1, (80, 3))])
    y = np.r_[np.ones(50), -np.ones(80)]
    w = tx.fit_svm(x, y, np.full(130, 1 / 130))
    assert ((np.hstack([x, np.ones((130, 1))]) @ w > 0) == (y > 0)).mean() > 0.98


def test_held_out_accuracy_and_rows(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = tx.train(docs.select("doc_id", "text"), labels)
    out = tx.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(tx.held_out(F.col("doc_id"))).select("toxic", "score", "predicted").collect()
    pos, neg = [r for r in out if r.toxic == 1], [r for r in out if r.toxic == 0]
    assert np.mean([r.predicted for r in pos]) > 0.85 and np.mean([r.predicted for r in neg]) < 0.1
    ranks = np.argsort(np.argsort([r.score for r in out]))
    auc = (sum(k for k, r in zip(ranks, out, strict=True) if r.toxic == 1) - len(pos) * (len(pos) - 1) / 2) / (len(pos) * len(neg))
    assert auc > 0.93
    rows = [(1, "you i d i o t there", 3), (2, None, 1), (3, "", 1), (None, "the idiot", 1), (4, "\x00 -- !!", 1), (5, "of the and " * 30000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = {r.doc_id: r for r in tx.score(df, model).collect()}
    assert got[1].predicted == 1 and got[None].predicted == 1 and len(got) == 6
    assert {got[k].predicted for k in (2, 3, 4, 5)} == {0} and all(0 <= r.score <= 1 for r in got.values())


def test_few_labels_and_broken_words(spark):
    """Nine labelled rows, one of them toxic, make a model; an insult broken by a blank is read as one word."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:9]
    texts = ["you are an idiot my friend", *[f"the quiet river flows past house number {w} again" for w in ("one", "two", "three", "four", "five", "six", "seven", "eight")]]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k == 0)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    model = tx.train(docs, labels)
    assert model is not None
    tests = ["such an idiot", "such an id iot", "the river flows", "past the house again"]
    got = [r.score for r in tx.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert min(got[:2]) > max(got[2:])


def test_labels_of_held_out_rows_are_never_seen(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = spark.createDataFrame([(i, "idiot words here") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    assert tx.train(docs, labels) is None  # nothing left to learn from
    assert {r.score for r in tx.score(docs, None).collect()} == {0.0}
    assert tx.score(docs.limit(0), None).count() == 0
