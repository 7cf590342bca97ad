import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import fim
from tests.llm.fixtures import hot_rows, odd_rows, table

MIXED = [
    (200, "日本語" * 3000 + "plain words " * 3000 + "é👍" * 2000, "de", "a", 1), (201, "<P> in the text", "en", "a", 1), (202, "ends with <", "en", "a", 1),
    (203, "<P", "en", "a", 1), (204, "M><S<P<M", "en", "a", 1), (205, "one\ntwo\n\nthree", "en", "a", 1),
]


def by_hand(doc_id, text, units):
    """(n, form, prefix, middle, output) where ``units`` are the parts of the text."""
    text, n = text or "", len(units)
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or n == 0 or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def parts(text, pattern):
    """The text in units: a match and the gap before it; the last one takes the rest."""
    if pattern is None:
        return list(text)
    ends = [m.end() for m in re.finditer(pattern, text)]
    if not ends:
        return []
    ends[-1] = len(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


@pytest.mark.parametrize("pattern", [None, fim.WORDS, fim.LINES])
def test_forms(spark, pattern):
    docs = odd_rows() + MIXED
    df = table(spark, docs).withColumn("form", F.lit("own")).withColumn("start", F.lit(1))
    made = fim.fill_in_middle(df, pattern)
    assert made.columns == [*df.drop("form").columns, *fim.ADDED]
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((str(d[0]), d[1] or "", *by_hand(d[0], d[1], parts(d[1] or "", pattern))) for d in docs)
    rows = sorted((str(r["doc_id"]), r["text"] or "", r["n_units"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) for r in got)
    assert rows == want
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {"plain", "psm", "spm"} <= {r["form"] for r in got}


@pytest.mark.parametrize("seed", range(5))
def test_index_is_exact_within_its_bound(seed):
    rng = np.random.default_rng(seed)
    steps = np.where(rng.random(60_000) < rng.choice([0.01, 0.3, 0.9]), rng.integers(1, 40, 60_000), 1)
    steps[20_000:30_000] = 3
    at = np.cumsum(steps)
    index = fim.fit_pieces(at)
    rank = np.arange(len(at))
    assert (index.offset(rank) == at).all()
    assert np.abs(index.predict(rank) - at).max() <= fim.BOUND
    assert len(index.ranks) < len(at) / 20


def test_text_longer_than_a_window(monkeypatch):
    monkeypatch.setattr(fim, "WINDOW", 1000)
    text = ("a" * 700 + "日" * 500 + "é" * 300) * 9
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fim.code_point_index(raw)
    want = np.cumsum([0] + [len(c.encode()) for c in text[:-1]])
    assert (index.offset(np.arange(len(text))) == want).all()
    words = "wörd two  three\n" * 3000
    ends = [len(words[: m.end()].encode()) for m in re.finditer(fim.WORDS, words)]
    assert fim.pattern_index(words, fim.WORDS).offset(np.arange(len(ends))).tolist() == [0, *ends[:-1]]


def test_hot_and_empty(spark):
    rows = hot_rows()
    got = fim.fill_in_middle(table(spark, rows)).collect()
    assert [r["output"] for r in sorted(got, key=lambda r: r["doc_id"])] == [by_hand(d[0], d[1], list(d[1]))[4] for d in sorted(rows)]
    assert fim.fill_in_middle(table(spark, [])).collect() == []


def test_shares(spark):
    made = fim.fill_in_middle(spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text")), rate=50, spm=50)
    n = {r["form"]: r["count"] for r in made.groupBy("form").count().collect()}
    assert abs(n["plain"] - 2000) < 200 and abs(n["spm"] - 1000) < 200
