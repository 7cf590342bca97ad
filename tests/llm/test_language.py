import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import language
from tastegrid.llm.queries import QUERIES, TOKENIZERS
from tests.conftest import FOLDER
from tests.llm.fixtures import odd_rows, table


@pytest.fixture(scope="module")
def pieces():
    return language.vocabulary_pieces(f"{TOKENIZERS}/piece_bpe_32k.model")


def by_hand(word, numbers, p):
    """All segmentations, summed piece by piece."""
    ways = [np.ones(p.shape[1])] + [np.zeros(p.shape[1]) for _ in word]
    for j in range(1, len(word) + 1):
        for i in range(j):
            k = numbers.get(word[i:j], 0 if j == i + 1 else None)
            if k is not None:
                ways[j] = ways[j] + ways[i] * p[k]
    return ways[-1]


def test_lattice_sums_all_segmentations(pieces):
    words = ["▁the", "▁erthwhnt", "▁élève", "▁a", "▁" + "x" * 31, "▁日本", "▁0123"]
    p = np.random.default_rng(1).random((len(pieces) + 1, 3)) * 1e-3
    lattice = language.Lattice(words, language.PieceIndex(pieces))
    want = np.array([by_hand(w, {x: k for k, x in enumerate(pieces, 1)}, p) for w in words])
    assert np.allclose(lattice.whole(lattice.forward(p)), want, rtol=1e-9)
    assert np.allclose(lattice.backward(p)[0], want, rtol=1e-9)


def test_held_out_accuracy(spark):
    lang = dict(pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "lang"]).to_pandas().itertuples(index=False))
    rows = [r for r in QUERIES["op6_language"](spark, FOLDER).collect() if r["held_out"]]
    assert len(rows) > 20
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in rows) / len(rows) > 0.95


def test_odd_rows(spark, pieces):
    docs = table(spark, odd_rows(), clashes=True).withColumn("held_out", F.lit(False))
    model = language.train(docs, pieces)
    got = language.predict(docs, model).collect()
    assert model.langs == ["de", "en", "es", "fr"] or model.langs == ["de", "en", "es"]
    assert len(got) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 for r in got)
    blank = [r for r in got if r["doc_id"] in (5, 6, 7)]
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in blank)
    repeated = {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 2}
    assert len(repeated) == 1


def test_nothing_to_learn_from(spark, pieces):
    docs = table(spark, [(1, "some text", None, "a", 1), (2, None, "en", "a", 1)]).withColumn("held_out", F.lit(False))
    got = language.predict(docs, language.train(docs, pieces)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    empty = table(spark, []).withColumn("held_out", F.lit(False))
    assert language.predict(empty, language.train(empty, pieces)).count() == 0
