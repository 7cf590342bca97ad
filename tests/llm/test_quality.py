import numpy as np
import pyarrow.parquet as pq

from tastegrid.llm import quality
from tastegrid.llm.queries import QUERIES
from tests.conftest import FOLDER
from tests.llm.fixtures import odd_rows, table


def test_held_out_accuracy(spark):
    label = dict(pq.read_table(f"{FOLDER}/labels.parquet", columns=["doc_id", "quality"]).to_pandas().itertuples(index=False))
    rows = [r for r in QUERIES["op7_quality"](spark, FOLDER).collect() if r["held_out"] and r["doc_id"] in label]
    assert len(rows) > 15
    assert sum(label[r["doc_id"]] == r["predicted"] for r in rows) / len(rows) > 0.9


def test_pairs_learn_what_single_features_cannot():
    x = np.random.default_rng(2).random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (1, 0) in [(j, k) for j, k, _ in model.pairs]
    assert ((model.predict(x) >= 0.5) == y).mean() > 0.95


def test_scores_are_sums_of_table_entries():
    x = np.random.default_rng(3).random((500, 2))
    model = quality.fit(x, (x[:, 0] > 0.3).astype(float))
    bins = model.bins(x)
    total = model.intercept + sum(model.tables[k][bins[:, k]] for k in range(2))
    for j, k, pair in model.pairs:
        total = total + pair[model.coarse(bins, j), model.coarse(bins, k)]
    assert np.allclose(model.predict(x), 1 / (1 + np.exp(-total)))


def test_odd_rows(spark):
    docs = table(spark, odd_rows(), clashes=True)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (100, 0, 1), (7777, 1, 1)], "doc_id bigint, quality int, toxic int")
    featured = quality.with_features(docs)
    model = quality.train(featured, labels)
    got = quality.score_features(featured, model).collect()
    assert len(got) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality.keep_good(docs, model).columns == docs.columns


def test_empty(spark):
    featured = quality.with_features(table(spark, []))
    model = quality.train(featured, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert quality.score_features(featured, model).count() == 0
    assert quality.keep_good(table(spark, odd_rows()), model).count() == len(odd_rows())  # no labels: 0.5 for all


def test_features_do_not_depend_on_batches():
    from tastegrid.llm.words import texts_of
    import pyarrow as pa

    texts = [r[1] for r in odd_rows()]
    whole = quality.features(*texts_of(pa.array(texts, pa.string())))
    single = np.concatenate([quality.features(*texts_of(pa.array([t], pa.string()))) for t in texts])
    assert np.array_equal(whole, single)
