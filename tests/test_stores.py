import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import factors, quota, telemetry
from tastegrid.sources import readers, stores
from tastegrid.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def test_csv_fallback_and_missing(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text('title,id,genre,year\n"Avatar, again",1,Action|Sci-Fi,2009\nTitanic,2,,\n')
    rows = {r["id"]: r for r in readers.read_items(spark, str(tmp_path / "absent.csv"), str(path)).collect()}
    assert rows["1"]["title"] == "Avatar, again" and rows["1"]["year"] == 2009 and rows["2"]["year"] is None
    with pytest.raises(FileNotFoundError):
        readers.read_ratings(spark, str(tmp_path / "absent.csv"))
    docs = {r["id"]: r for r in readers.load_documents_csv(spark, str(path)).collect()}
    assert docs["1"]["content"].startswith("Title: Avatar, again | Genre: Action|Sci-Fi | Year: 2009 | Director: ")
    assert docs["2"]["year"] == 0 and docs["2"]["rating"] == 0.0


def test_csv_fields_with_line_breaks(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text('id,title,plot,rating,year\n1,A,"line one\nline two, with ""more""",4.5,1999\n2,B,plain,3.0,2001\n')
    rows = {r["id"]: r for r in readers.read_items(spark, str(path)).collect()}
    assert sorted(rows) == ["1", "2"]
    assert rows["1"]["plot"] == 'line one\nline two, with "more"' and rows["1"]["rating"] == 4.5 and rows["1"]["year"] == 1999
    docs = {r["id"]: r for r in readers.load_documents_csv(spark, str(path)).collect()}
    assert docs["1"]["content"].endswith('line two, with "more"')
    plain = tmp_path / "plain.csv"
    plain.write_text("user_id,movie_id,rating\n1,2,3.0\n")
    assert readers.load_csv(spark, str(plain), readers.schemas.RATINGS, line_per_row=True).count() == 1


def test_json_array_defaults(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text(json.dumps([{"id": "1", "title": "Avatar"}, {"id": "2", "title": "Up", "year": 2009, "metadata": {"budget": "5"}}], indent=1))
    rows = {r["id"]: r for r in readers.load_documents_json(spark, str(path)).collect()}
    assert rows["1"]["genre"] == "" and rows["1"]["year"] == 0 and rows["1"]["metadata"] == {}
    assert rows["2"]["metadata"] == {"budget": "5"}


def test_eval_lines(spark, tmp_path):
    path = tmp_path / "eval.jsonl"
    path.write_text('{"id": "e1", "query": "q", "reference": "r", "category": "c"}\n\n{"id": "e2", "query": "q2"}\n')
    assert sorted(r["id"] for r in readers.read_eval_jsonl(spark, str(path)).collect()) == ["e1", "e2"]
    assert readers.read_eval_jsonl(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_index_life(spark, tmp_path):
    csv = tmp_path / "movies.csv"
    csv.write_text("id,title,genre,plot,year,rating,director\n" + "".join(f"{i},T{i},A,plot {i},2000,5.0,D\n" for i in range(12)))
    path = str(tmp_path / "index")
    assert not stores.is_ready(spark, path)
    docs, _ = stores.ensure_index(spark, path, str(csv))
    assert docs.count() == 12 and stores.is_ready(spark, path)
    assert stores.rebuild_index(spark, str(csv), path) == 12
    with pytest.raises(ValueError):
        stores.ingest(spark, str(csv), "xml", path)


def test_half_written_versions_do_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")

    def index(n):
        rows = [(i, f"T{i}", [1.0, float(i)], 0) for i in range(n)]
        return spark.createDataFrame(rows, "id long, title string, vector array<double>, centroid int"), spark.createDataFrame([(0, [1.0, 0.0])], "centroid int, center array<double>")

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:  # both folders are there, the manifest is not
        m.setattr(stores, "_commit", lost)
        with pytest.raises(RuntimeError):
            stores.save_index(*index(3), path)
    assert stores.load_index(spark, path) is None and not stores.is_ready(spark, path)
    stores.save_index(*index(4), path)
    reader = stores.load_index(spark, path)[0]
    with monkeypatch.context() as m:  # lost between the two writes
        m.setattr(type(spark.range(1).write), "partitionBy", lambda self, *_: lost())
        with pytest.raises(RuntimeError):
            stores.save_index(*index(5), path)
    assert stores.load_index(spark, path)[0].count() == 4
    stores.save_index(*index(6), path)
    assert reader.count() == 4 and stores.load_index(spark, path)[0].count() == 6
    stores.save_index(*index(7), path)
    assert stores.load_index(spark, path)[0].count() == 7 and stores.load_index(spark, path)[1].count() == 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FileNotFound|does not exist"):
        reader.count()  # two versions behind: removed


def test_model_versions(spark, tmp_path):
    def model(n):
        users = spark.createDataFrame([(str(i), [float(n)]) for i in range(n)], "user_id string, vector array<double>")
        return factors.Factors(users, users.withColumnRenamed("user_id", "item_id"), [float(n)])

    path = str(tmp_path / "m")
    for n in (2, 3):
        stores.save_model(model(n), path, f"v{n}", note=n)
    found, meta = stores.load_model(spark, [str(tmp_path / "none"), path])
    assert meta == {"version": "v3", "note": "3"} and found.singular_values == [3.0]
    assert found.user_factors.count() == found.item_factors.count() == 3


def test_missing_model(spark, tmp_path):
    assert stores.load_model(spark, [str(tmp_path / "m")]) is None
    with pytest.raises(FileNotFoundError):
        stores.load_model(spark, [str(tmp_path / "m")], required=True)


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """A log in several files, read as several micro-batches, mildly out of order inside each."""
    root = tmp_path_factory.mktemp("stream")
    path = str(root / "log")
    rows = [(f"k{i % 4 // 2}", i, T0 + dt.timedelta(seconds=20 * i + (7 * i) % 13), 1 + i % 40, "GET") for i in range(900)]
    for part in range(3):
        chunk = rows[part * 300 : (part + 1) * 300]
        spark.createDataFrame(chunk, "key string, event_id long, ts timestamp, tokens long, endpoint string").coalesce(1).write.mode("append").parquet(path)
    return root, path, spark.read.parquet(path)


def closed(df, width, last):
    return df.where(F.col("window_start") + F.expr(f"interval {width}") <= F.lit(last - dt.timedelta(minutes=10)))


def test_stream_windows_equal_batch(spark, arrivals):
    root, path, batch = arrivals
    last = batch.agg(F.max("ts")).first()[0]
    stream = jobs.read_table_stream(spark, path, files_per_trigger=1)
    got = jobs.run_available(jobs.stream_usage_windows(stream, "5 minutes"), str(root / "w"))
    expected = batch.groupBy(F.window("ts", "5 minutes")["start"].alias("window_start"), "key").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("tokens").alias("tokens")
    )
    key = ["window_start", "key"]
    assert sorted(map(tuple, closed(got, "5 minutes", last).select(*key, "requests", "tokens").collect())) == sorted(
        map(tuple, closed(expected, "5 minutes", last).select(*key, "requests", "tokens").collect())
    )


def test_stream_metrics_equal_batch(spark, arrivals):
    root, path, batch = arrivals
    last = batch.agg(F.max("ts")).first()[0]
    stream = jobs.read_table_stream(spark, path, files_per_trigger=1)
    got = jobs.run_available(jobs.stream_metrics(stream, "tokens", [10, 20], "1 hour"), str(root / "m"))
    direct = telemetry.histogram_buckets(batch.withColumn("w", F.window("ts", "1 hour")), "tokens", [10, 20], ["w", "endpoint"])
    direct = direct.select(F.col("w.start").alias("window_start"), "endpoint", "le", "n")
    assert sorted(map(tuple, closed(got, "1 hour", last).collect())) == sorted(map(tuple, closed(direct, "1 hour", last).collect()))


def test_stream_admission_equals_batch(spark, arrivals):
    root, path, batch = arrivals
    last = batch.agg(F.max("ts")).first()[0]
    stream = jobs.read_table_stream(spark, path, files_per_trigger=1)
    got = jobs.run_available(jobs.stream_admission(stream, 2, 60, 30), str(root / "a"))
    expected = quota.admission_control(batch, 2, 60, 30).join(batch.where(F.col("ts") < last - dt.timedelta(minutes=10)), ["key", "event_id"], "left_semi")
    columns = ["key", "event_id", "reason"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, expected.select(*columns).collect()))


def test_late_events_are_decided_in_event_order(spark, tmp_path):
    """Events at 0, 70 and 100 seconds arrive as 0, 100, 70; a last one moves the watermark past them."""
    def event(number, second):
        return (number, T0 + dt.timedelta(seconds=second), "k", 1)

    schema = "event_id long, ts timestamp, key string, tokens long"
    for arrived in ([event(1, 0)], [event(3, 100)], [event(2, 70)], [event(4, 4000)]):
        spark.createDataFrame(arrived, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    got = jobs.run_available(jobs.stream_admission(stream, 1, 1000, 30), str(tmp_path / "out"))
    batch = quota.admission_control(spark.read.parquet(str(tmp_path / "log")), 1, 1000, 30)
    want = {r["event_id"]: r["reason"] for r in batch.collect()}
    assert want == {1: "ok", 2: "ok", 3: "rpm", 4: "ok"}
    found = {r["event_id"]: r["reason"] for r in got.collect()}
    assert found == {k: want[k] for k in (1, 2, 3)}  # the watermark has not passed the fourth


def test_dedup_keeps_one_per_key(spark, arrivals):
    root, path, batch = arrivals
    stream = jobs.read_table_stream(spark, path, files_per_trigger=1).withColumn("cache_key", F.col("tokens"))
    got = jobs.run_available(jobs.dedup_prompts(stream.select("ts", "cache_key")), str(root / "d"))
    assert got.count() == batch.select("tokens").distinct().count()


def test_embedding_of_one_file_is_spread(spark, tmp_path, monkeypatch):
    """A documents file that one task reads is embedded by as many tasks as there are cores."""
    rows = [(i, f"T{i}", "g", "a\nb", 1999, "d") for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, title string, genre string, content string, year int, director string").coalesce(1)
    seen, embed = [], stores.retrieval.embed_text
    monkeypatch.setattr(stores.retrieval, "embed_text", lambda df, *a: seen.append(df.rdd.getNumPartitions()) or embed(df, *a))
    assert stores.ingest(spark, docs, "table", f"{tmp_path}/index") == 40
    assert seen[0] >= spark.sparkContext.defaultParallelism
