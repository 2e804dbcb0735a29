import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import suffix_dedup as sd


def brute(rows, length):
    """{doc: (n_bytes, n_removed, n_spans, digest)}; rows of one doc count once."""
    docs = dict(rows)
    seen = {}
    for d, t in docs.items():
        if d is None:
            continue
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i:i + length], []).append((d, i))
    gone = {}
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone.setdefault(d, set()).update(range(i, i + length))
    out = {}
    for d, t in docs.items():
        g = gone.get(d, set()) if d is not None else set()
        spans = sum(1 for i in g if i - 1 not in g)
        out[d] = (len(t), len(g), spans, hashlib.sha256(bytes(b for i, b in enumerate(t) if i not in g)).hexdigest())
    return out


def got(spark, rows, length=12, spread=4, step=2, **kw):
    df = spark.createDataFrame([(d, None if t is None else t.decode()) for d, t in rows], "doc_id long, text string")
    out = sd.dedup_bytes(df, length, spread, step, **kw).drop("kept").collect()
    return sorted((tuple(r) for r in out), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=9, max_size=30), min_size=1, max_size=8), st.integers(5, 9), st.integers(0, 16))
def test_sort_equals_python(parts, length, shallow):
    text = np.frombuffer(b"".join(p * 3 for p in parts), np.uint8)
    start = np.arange(len(text) - length + 1)
    order, group = sd.deep_shallow(text, start, length, shallow)
    words = [text[s:s + length].tobytes() for s in start[order]]
    assert words == sorted(words)
    assert [a == b for a, b in zip(words, words[1:])] == [a == b for a, b in zip(group.tolist(), group.tolist()[1:])]


def test_sort_of_long_common_prefixes():
    rng = random.Random(1)
    base = bytes(rng.randrange(4) for _ in range(500))
    texts = [base[:k] + bytes([9]) + base[k + 1:] for k in (50, 120, 121, 300, 399, 450)] + [base] * 3
    text = np.frombuffer(b"".join(texts), np.uint8)
    start = np.concatenate([i * 500 + np.arange(101) for i in range(len(texts))])
    order, group = sd.deep_shallow(text, start, 400)
    words = [text[s:s + 400].tobytes() for s in start[order]]
    assert words == sorted(words) and len(set(words)) == group.max() + 1


@pytest.mark.parametrize("cells,heavy", [(16, 16), (1, 1), (16, 1)])
def test_equals_brute_force(spark, monkeypatch, cells, heavy):
    """Also with a sketch of two cells (everything is a candidate) and with every anchor dealt as frequent."""
    monkeypatch.setattr(sd, "HEAVY", heavy)
    rng = random.Random(cells + heavy)
    shared = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(8, 40))) for _ in range(6)]
    rows = []
    for d in range(60):
        t = b""
        for _ in range(rng.randrange(0, 5)):
            t += rng.choice(shared)[rng.randrange(4):] if rng.random() < 0.6 else bytes(rng.choice(b"abcdefgh") for _ in range(rng.randrange(30)))
        rows.append((d * 7, t))
    rows += [(1000 + k, rows[5][1] + rows[6][1]) for k in range(5)] + [(2000, b"a" * 90), (2001, "é".encode() * 30)]
    want = sorted(((d, *v) for d, v in brute(rows, 12).items()), key=str)
    assert got(spark, rows, log2_cells=cells) == want
    assert got(spark, rows, log2_cells=cells, buckets=1) == want


def test_edges(spark):
    same = b"0123456789abcdef"
    rows = [(1, same), (1, same), (2, b""), (3, None), (None, same), (4, b"short")]
    out = got(spark, rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert out.count((1, 16, 0, 0, hashlib.sha256(same).hexdigest())) == 2  # repeated rows are one document
    assert (2, 0, 0, 0, empty) in out and (3, 0, 0, 0, empty) in out
    assert (None, 16, 0, 0, hashlib.sha256(same).hexdigest()) in out and len(out) == 6
    df = spark.createDataFrame([], "doc_id long, text string, n_bytes string, bucket long")
    assert sd.dedup_bytes(df).count() == 0


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 64)
    monkeypatch.setattr(sd, "CHUNK", 500)
    rng = random.Random(9)
    long = bytes(rng.choice(b"ab") for _ in range(900))
    rows = [(1, long), (2, long[300:700]), (3, bytes(rng.choice(b"abcd") for _ in range(400)))]
    assert got(spark, rows) == sorted(((d, *v) for d, v in brute(rows, 12).items()), key=str)


def test_whole_table_at_400_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    out = {r[0]: tuple(r[1:5]) for r in sd.dedup_bytes(docs).collect()}
    assert out == brute(rows, 400)


@pytest.mark.parametrize("passage", [380, 1000])
def test_hot_passage_with_different_surroundings_is_dealt_out(spark, monkeypatch, tmp_path, passage):
    """No key that has different contents brings ``HEAVY`` of them into one task, as digests or as texts."""
    rng = random.Random(passage)
    draw = lambda n: bytes(rng.choice(b"abcdefghijklmnop") for _ in range(n))
    shared, ends = draw(passage), [draw(30) for _ in range(3)]
    rows = [(d, draw(rng.randrange(40, 120)) + (rng.choice(ends) if d % 3 == 0 else b"") + shared
             + (rng.choice(ends) if d % 2 == 0 else b"") + draw(rng.randrange(40, 120))) for d in range(2000)]
    folder = str(tmp_path)

    def noted(plain, with_text):
        def run(table, *args):
            columns = sd.unpacked(table, with_text)
            if columns is not None:
                _, contents = np.unique(np.unique(np.stack(columns[:2], 1), axis=0)[:, 0], return_counts=True)
                open(f"{folder}/{with_text}-{contents.max()}", "w").close()
            return plain(table, *args)
        return run

    monkeypatch.setattr(sd, "copies", noted(sd.copies, False))
    monkeypatch.setattr(sd, "resolve", noted(sd.resolve, True))
    assert got(spark, rows, 400, sd.SPREAD, sd.STEP) == sorted(((d, *v) for d, v in brute(rows, 400).items()), key=str)
    most = {k: max(int(p.name.split("-")[1]) for p in tmp_path.glob(f"{k}-*")) for k in (False, True)}
    assert most[False] < sd.HEAVY and most[True] < sd.HEAVY
