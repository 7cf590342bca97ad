import random

import pytest
from tokenizers import Tokenizer

from tastegrid.llm import tokens
from tastegrid.llm.queries import TOKENIZERS
from tests.llm.fixtures import odd_rows, table

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def strange_texts(seed=5, n=300):
    rng = random.Random(seed)
    letters = "abcdeABC'stremvlld 0123 .,!?<|>\t\n\x0b\x0c\r\x1c\x85  éÉßẞñÑΣσςİıǅﬁ日本عربי́‍👍🏽²Ⅷ٣\x00_-"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return made + ["<|startoftext|>a<|endoftext|>", "<|END", "don't I'LL they're", "ΟΔΟΣ ΣΑΣ", "é" * 50]


def test_counts_equal_the_library(spark, tokenizer):
    texts = strange_texts()
    docs = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in tokens.count_tokens(table(spark, docs), PATH).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)), repr(t)


def test_steps_and_forgetting(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "STEP", 7)
    monkeypatch.setattr(tokens, "STEP_CHARS", 50)
    monkeypatch.setattr(tokens, "KEPT", 3)
    docs = odd_rows()
    got = tokens.count_tokens(table(spark, docs, clashes=True), PATH, limit=100).collect()
    want = sorted(len(tokenizer.encode(d[1] or "", add_special_tokens=False).ids) for d in docs)
    assert sorted(r["n_tokens"] for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)


def test_proof(tokenizer):
    proved = tokens.proved_whole(open(PATH, encoding="utf-8").read())
    assert {"the", "and", "a"} <= proved
    assert all(len(tokenizer.encode(s, add_special_tokens=False).ids) == 1 for s in list(proved)[:2000])


def test_empty(spark):
    assert tokens.count_tokens(table(spark, []), PATH).count() == 0


def test_every_code_point(tokenizer):
    """Each proved character, alone and beside others, is counted as the library counts it."""
    vocabulary = open(PATH, encoding="utf-8").read()
    split = tokens.PreTokens([])
    proof = tokens.Proof(tokenizer, split)
    assert tokens.is_known(vocabulary)
    rng = random.Random(3)
    every = [chr(c) for c in [*range(0x3100), *range(0xA000, 0xAC00), *range(0xD700, 0xD800), *range(0xF900, 0x1FC00)]]
    proved = [c for c in every if proof.holds(c)]
    assert len(proved) > 15_000 and not proof.holds("\U00018f02") and not proof.holds("\u0558")
    texts = ["".join(rng.choices(proved, k=40)) for _ in range(4000)]
    for t in texts:
        assert proof.pieces(t) == split.listed(t), repr(t)


def test_texts_with_unproved_characters(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "STEP_CHARS", 30)
    rng = random.Random(4)
    texts = ["\u0130\U00018f02", "a\u0558b \ua7cb"] + ["".join(chr(rng.choice((rng.randrange(0x20, 0x30000), 0x20, 0x61))) for _ in range(60)) for _ in range(400)]
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    docs = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(table(spark, docs), PATH).collect()}
    for i, t in enumerate(texts):
        assert got[i] == len(tokenizer.encode(t, add_special_tokens=False).ids), repr(t)


def test_another_vocabulary(spark):
    path = f"{TOKENIZERS}/byte_bpe_50k.json"
    other = Tokenizer.from_file(path)
    assert not tokens.is_known(open(path, encoding="utf-8").read())
    docs = odd_rows()
    got = tokens.count_tokens(table(spark, docs), path).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(other.encode(d[1] or "", add_special_tokens=False).ids) for d in docs)
