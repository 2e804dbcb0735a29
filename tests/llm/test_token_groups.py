import random
import re
from pathlib import Path

import numpy as np
import pytest

from stratum.llm import token_groups as tg

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(TABLE))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if d is not None)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted(((d, len(sets[d]), None if d is None else find(d)) for d, _ in rows), key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in tg.join_components(df, **kw).collect()), key=str)


def corpus(seed, n=120, copies=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "b."]
    rows, bases = [], [[rng.choice(vocab) for _ in range(rng.randrange(1, 60))] for _ in range(25)]
    for d in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randrange(2)] = [rng.choice(vocab)]
        rows.append((d * 2 + 1, " ".join(x.upper() if rng.random() < 0.2 else x for x in w)))
    # a chain whose ends are unlike, one large group of copies, near copies of a long text
    chain = [f"c{i}" for i in range(80)]
    rows += [(5000 - k, " ".join(chain[4 * k:4 * k + 44])) for k in range(9)]
    rows += [(6000 + k, "same words in every one of these copies here") for k in range(copies)]
    base = [f"n{i}" for i in range(100)]
    rows += [(7000 + k, " ".join(base[:k % 90] + [f"x{k}"] + base[k % 90 + 1:])) for k in range(copies)]
    return rows


@pytest.mark.parametrize("seed,cells", [(1, 20), (2, 6), (3, 1)])
def test_equals_brute_force(spark, seed, cells):
    """Also with sketches so small that every token seems to occur twice: more is looked up, nothing is lost."""
    rows = corpus(seed)
    assert got(spark, rows, log2_cells=cells) == brute(rows)


def test_big_groups_over_small_pages(spark, monkeypatch):
    monkeypatch.setattr(tg, "PAGE", 4)
    rows = corpus(4, n=60, copies=40)
    assert got(spark, rows, log2_cells=18) == brute(rows)


def test_edges(spark):
    rows = [(5, None), (4, ""), (3, " \t"), (2, "one two"), (1, "One TWO"), (7, "one two"), (7, "one two"), (8, "two one"),
            (None, "one two"), (9, "a b c d e f"), (10, "a b c d e f g")]
    assert got(spark, rows, log2_cells=12) == brute(rows)
    empty = spark.createDataFrame([], "doc_id long, text string, n string, tokens int, cls int")
    assert tg.join_components(empty, log2_cells=8).count() == 0


def test_reach_is_sufficient():
    for n in range(1, 200):
        least = -(-3 * n // 4)
        assert tg.reach(n) == n - least + 1


def test_different_texts_of_one_id(spark):
    """Each row comes once, and the id's texts are of one component, also one that is like no other."""
    words = lambda k, n=30: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(5, words(1)), (5, words(2)), (6, words(1)), (7, words(2)), (8, words(1) + " end"), (8, words(3)),
            (3, words(3)), (9, words(4)), (9, words(1)), (10, words(5))]
    out = got(spark, rows, log2_cells=18)
    assert len(out) == len(rows)
    assert sorted(str(r[2]) for r in out) == ["10"] + ["3"] * 9


def test_sketch_holds_more_tokens_than_cells(spark):
    """Tokens that occur once set no cell, so with as many of them as cells unlike texts still leave at once."""
    rows = [(d, " ".join(f"d{d}w{i}" for i in range(104))) for d in range(200)]
    rows += [(1000 + d, " ".join(f"s{i}" for i in range(104)) + f" end{d}") for d in range(2)]
    slim = spark.createDataFrame(rows, "doc_id long, text string")
    twice, heavy = tg.sketch_bits(slim, 14)  # 20,000 tokens, 16,384 cells
    assert sum(bin(b).count("1") for b in twice) in range(90, 101) and not any(heavy)
    assert got(spark, rows, log2_cells=14) == brute(rows)


def test_packed_tokens_keep_counts_up_to_two():
    rng = np.random.default_rng(5)
    token = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    token = np.concatenate([token, token[:100], token[:50], token[:50]])
    for log2_blocks in (0, 3, 9):
        parts = dict(tg.packed_tokens(token, log2_blocks))
        back = np.concatenate([tg.unpacked_tokens(parts[b]).astype(np.uint64) + (np.uint64(b) << np.uint64(tg.BLOCK_BITS)) for b in sorted(parts)])
        cut = token >> np.uint64(64 - tg.BLOCK_BITS - log2_blocks)
        want, count = np.unique(cut, return_counts=True)
        assert (back == np.repeat(want, np.minimum(count, 2))).all()


def checkpointed(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return sum(p.stat().st_size for p in Path(folder).rglob("part-*"))


def test_copies_and_near_copies_leave_no_token_sets_behind(spark):
    """What is kept between steps grows neither with the copies' tokens nor with the moved sets' tokens."""
    words = [[f"g{g}w{i}" for i in range(1500)] for g in range(4)]
    rows = [(100 * g + k, " ".join(w + [f"x{k % 2}"])) for g, w in enumerate(words) for k in range(40)]
    tg.join_components(spark.createDataFrame(rows[:1], "doc_id long, text string")).count()
    before = checkpointed(spark)
    assert got(spark, rows, log2_cells=20) == sorted(((d, 1497, d // 100 * 100) for d, _ in rows), key=str)
    # 160 texts of 1,497 tokens; their sets hold 1.9 MB
    assert checkpointed(spark) - before < 8 * 1497 * 160 / 4
