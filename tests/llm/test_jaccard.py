import random
import re

import pytest

from tastegrid.llm import jaccard
from tests.llm.fixtures import hot_rows, odd_rows, sentence, table

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(docs):
    """(n_shingles, component_id) of each row with a doc_id."""
    rows = [(d[0], shingles(d[1])) for d in docs if d[0] is not None]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    return sorted((doc_id, len(s), smallest[find(i)]) for i, (doc_id, s) in enumerate(rows))


def found(spark, docs):
    out = jaccard.near_duplicates(table(spark, docs, clashes=True)).collect()
    assert len(out) == len(docs)
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is not None)


def chains(seed):
    """Near copies of near copies, so that a component is wider than a link."""
    rng = random.Random(seed)
    docs, i = [], 0
    for _ in range(6):
        words = sentence(rng, 70).split()
        for _ in range(9):
            docs.append((i, " ".join(words), "en", "a", 1))
            i += 3
            words[rng.randrange(len(words))] = f"w{i}"
    common = sentence(rng, 30)
    docs += [(1000 + k, common + " " + sentence(rng, rng.randint(3, 60)), "en", "a", 1) for k in range(50)]
    rng.shuffle(docs)
    return docs


def test_odd_rows(spark):
    assert found(spark, odd_rows()) == brute(odd_rows())


@pytest.mark.parametrize("short,frequent", [(24, 32), (2, 3), (1, 2)])
def test_chains_and_common_passages(spark, monkeypatch, short, frequent):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    assert found(spark, chains(short)) == brute(chains(short))


def test_long_lists_without_star_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 1)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    assert found(spark, chains(7)) == brute(chains(7))


def test_hot_group(spark):
    assert found(spark, hot_rows()) == brute(hot_rows())


def test_empty(spark):
    assert jaccard.near_duplicates(table(spark, [])).count() == 0
    assert jaccard.keep_one(table(spark, [])).count() == 0


def test_keep_one(spark):
    docs = odd_rows()
    out = jaccard.keep_one(table(spark, docs, clashes=True)).collect()
    groups = {c for _, n, c in brute(docs) if n}
    free = [d for d in docs if d[0] is None or not shingles(d[1])]
    assert len(out) == len(groups) + len(free)
    assert {r["doc_id"] for r in out if r["doc_id"] is not None and shingles(r["text"])} == groups
    assert all(r["label"] == "own label" for r in out)


def brute_links(docs):
    """The links between different sets, by hand."""
    sets = sorted({frozenset(shingles(d[1])) for d in docs if d[0] is not None} - {frozenset()}, key=sorted)
    return {(a, b) for i, b in enumerate(sets) for a in sets[:i] if 100 * len(a & b) >= 75 * len(a | b)}


@pytest.mark.parametrize("docs,short,members", [(odd_rows(), 24, 1024), (hot_rows(), 24, 13), (chains(7), 1, 5)])
def test_no_link_is_lost(spark, monkeypatch, docs, short, members):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "MEMBERS", members)
    monkeypatch.setattr(jaccard, "SPREAD", 50)
    want = brute_links(docs)
    degrees = {}
    for link in want:
        for s in link:
            degrees[s] = degrees.get(s, 0) + 1
    texts = table(spark, docs, clashes=True)
    out = jaccard.near_duplicates(texts).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["n_links"]) for r in out if r["doc_id"] is not None)
    assert got == sorted((d[0], len(s), degrees.get(s, 0)) for d in docs if d[0] is not None for s in [frozenset(shingles(d[1]))])
    links = jaccard.similarity_links(texts)[2].collect()
    assert len(links) == len({(r["a"], r["b"]) for r in links}) == len(want)
