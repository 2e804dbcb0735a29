import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratum.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRUE = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def enc():
    return bpe.Encoder(bpe.vocabulary(PATH))


def ids(enc, text):
    return [i for part in enc.pieces(text) for i in part]


def check(enc, text):
    want = TRUE.encode(text, add_special_tokens=False).ids
    assert ids(enc, text) == want
    assert "".join(bpe.decode(enc.v, [want])) == TRUE.decode(want, skip_special_tokens=False)


CASES = ["", " ", "  ", "a  b", "it's we'll I've 'S '", "x\n\n y \t z", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
         "<|endoftext", "é ü ß 中文 ½ ² Ⅷ 1234", "\x00\x1c\x1f\x85\xa0x", "🙂🙃 á", "!!'s??'ll", "a" * 500, " " * 300 + "x",
         "'" * 50 + "re", "﻿​x　y"]


@pytest.mark.parametrize("text", CASES)
def test_same_as_the_library(enc, text):
    check(enc, text)


def test_small_windows_change_nothing(enc, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 7)
    monkeypatch.setattr(enc, "block", 2 * enc.v.lookahead)
    rng = random.Random(3)
    for text in CASES:
        check(enc, text)
    for _ in range(60):
        check(enc, "".join(rng.choice([" ", "  ", "'", "ll", "re", "the", "\n", "9", "é", "<|endoftext|>", "!"]) for _ in range(80)))


def test_unsplit_runs_stream(enc):
    """Runs far over the lookahead are cut where the bound says; adversarial pieces of the vocabulary."""
    rng = random.Random(5)
    letters = [b.decode() for b in enc.v.bytes_of.values() if b.isalpha() and b.isascii() and len(b) > 2]
    for _ in range(12):
        run = "".join(rng.choice(letters) for _ in range(6 * enc.v.lookahead // 5))
        streamed = [i for part in enc._run(run, 0, len(run)) for i in part]
        assert streamed == TRUE.encode(run, add_special_tokens=False).ids
    enc2 = bpe.Encoder(enc.v)
    enc2.block = enc.v.lookahead + 8
    for c in ("a", "ab", "the", "=", "-="):
        run = c * (3 * enc.v.lookahead)
        assert [i for part in enc2._run(run, 0, len(run)) for i in part] == TRUE.encode(run, add_special_tokens=False).ids


def test_memory_of_a_long_run_is_bounded(enc):
    held = [len(p) for p in enc._run("ab" * 100_000, 0, 200_000)]
    assert max(held) <= 2 * enc.block


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120))
def test_any_text(text):
    check(bpe.encoder(PATH), text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=5), max_size=12))
def test_state_machine_equals_whole_decode(parts):
    m = bpe.ByteToText()
    got = "".join([m.feed(p) for p in parts]) + m.close()
    assert got == b"".join(parts).decode("utf-8", "replace")


def test_rows(spark):
    rows = [(1, "a b", "x"), (None, None, "y"), (2, "", "x"), (2, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = [tuple(r) for r in bpe.encode_digests(df, PATH).collect()]
    assert sorted(out, key=str)[0][1] == 2 and len(out) == 4 and sum(r[1] for r in out) == 2
    assert bpe.encode_digests(df.limit(0), PATH).count() == 0
    assert bpe.encode_ids(df.limit(1), PATH).first()["ids"] == TRUE.encode("a b").ids
