import hashlib
import random

from tokenizers import Tokenizer

import corpus_pipeline as cp
from stratum.llm import secrets
from stratum.llm.queries import tokenizer_path
from tests.llm.test_rules_and_mix import WORD, fill
from tests.llm.test_token_groups import brute as brute_groups
from tests.llm.test_token_groups import checkpointed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def fixture(spark, folder):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for d in range(160):
        w = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if d % 8 == 0:
            w[rng.randrange(len(w))] = rng.choice(["idiot", "moron"])
        if d % 9 == 1:
            w.append("token=abcdefgh12345")
        rows.append((d, " ".join(w), "en", f"s{d % 4}", 1))
    rows += [(1000 + k, rows[5][1], "en", "s0", 1) for k in range(30)] + [(2000, None, None, None, None), (2001, "", "en", "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, int(d % 8 == 0)) for d in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    rows = fixture(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "ngram_jaccard", "secret_scan", "source_mix", "bpe"]
    out, before = {}, docs
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, before, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        before = spark.read.parquet(f"{tmp_path}/{k}")
        out[name] = [r.asDict() for r in before.collect()]
        if k < 4:
            assert before.columns == COLUMNS
    clean = {r[0] for r in rows if r[0] >= 160 or r[0] % 8}
    kept = {r["doc_id"] for r in out["toxicity"]}
    assert clean <= kept and len(kept - clean) <= 2
    groups = brute_groups([(r["doc_id"], r["text"]) for r in out["toxicity"]])
    assert sorted(r["doc_id"] for r in out["ngram_jaccard"]) == sorted(d for d, _, c in groups if c == d)
    by = {r["doc_id"]: r for r in out["ngram_jaccard"]}
    for r in out["secret_scan"]:
        text = by[r["doc_id"]]["text"]
        base, more = secrets.scan_text(text)
        assert r["text"] == secrets.redact(text, base + more) and (text is None or r["n_chars"] == len(r["text"]))
    assert len(out["secret_scan"]) == len(by)
    sizes = {}
    for r in out["secret_scan"]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    want = dict(zip(names, fill([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2), strict=True))
    got = {}
    for r in out["source_mix"]:
        got[r["source"]] = got.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    assert all(abs(got.get(s, 0) - want[s]) <= 32 for s in names)
    true = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] or "" for r in out["source_mix"]}
    assert len(out["bpe"]) == len(out["source_mix"])
    for r in out["bpe"]:
        ids = true.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_repeated_and_empty_rows(spark, tmp_path):
    rows = [(1, "a b c d e f", "en", "x", 11)] * 3 + [(None, "a b c d e f", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for d, n in ((docs, [4, 2, 4]), (docs.limit(0), [0, 0, 0])):
        for (_, stage), size in zip(cp.STAGES[:3], n, strict=True):
            got = stage(spark, d, str(tmp_path))
            assert got.count() == size and got.columns == COLUMNS
        assert cp.encode(spark, cp.mix_sources(spark, d, str(tmp_path)), str(tmp_path)).count() >= 0


def test_clashing_columns_come_back_as_they_were(spark, tmp_path):
    rows = [(d, f"some words number {d} and {d * d} more of them {d + 7}", "x", d * 10, d * 2, "a", d + 0.5, 3, [d]) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score long, predicted long, _nth string, mix_size double, c0 int, own_1 array<int>")
    spark.createDataFrame([(d, 1, int(d == 3)) for d in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = docs
    for _, stage in cp.STAGES[:4]:
        before = stage(spark, before, str(tmp_path))
        assert before.columns == docs.columns
        for r in before.collect():
            assert tuple(r)[2:] == rows[r.doc_id][2:]
    assert before.count() > 0


def test_which_row_of_a_repeated_id_stays(spark, tmp_path):
    rows = [(1, "b b b b b b", "x", 1), (1, "a a a a a a", "y", 2), (1, "a a a a a a", "x", 3), (2, None, "x", 4), (2, "z z z z z z", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = {r.doc_id: tuple(r) for r in cp.drop_near_duplicates(spark, docs, str(tmp_path)).collect()}
    assert got == {1: (1, "a a a a a a", "x", 3), 2: (2, None, "x", 4)}


def test_run_drops_the_tables_between(spark, tmp_path, monkeypatch):
    fixture(spark, tmp_path)
    monkeypatch.setattr(cp, "scratch_path", lambda *_: f"{tmp_path}/stages")
    assert cp.run(spark, str(tmp_path)).count() > 0
    assert [d.name for d in sorted((tmp_path / "stages").iterdir())] == ["bpe"]


def test_near_duplicate_stage_leaves_no_token_sets_behind(spark):
    """What the second stage keeps between its steps does not grow with the tokens of copies and near copies."""
    words = [[f"p{g}w{i}" for i in range(1500)] for g in range(4)]
    kept = {}
    for copies in (2, 40):
        rows = [(100 * g + k, " ".join(w + [f"x{k % 2}"]), "en", "s0", 1) for g, w in enumerate(words) for k in range(copies)]
        before = checkpointed(spark)
        out = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(COLUMNS, ["long", *["string"] * 3, "long"], strict=True))), "")
        assert sorted(tuple(r) for r in out.collect()) == rows[::copies]
        kept[copies] = checkpointed(spark) - before
    # the sets of the 152 more texts hold 1.8 MB
    assert kept[40] - kept[2] < 8 * 1497 * 152 / 4
