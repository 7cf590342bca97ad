import random

import pytest
from pyspark.sql import functions as F

from tastegrid.functions import hashing, scoring, text
from tastegrid.operators import evaluating, prompting

CONTEXT = "array<struct<title:string,director:string,year:int,genre:string>>"
AVATAR = [("Avatar", "James Cameron", 2009, "Action|Sci-Fi")]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_rouge_against_brute_force(spark):
    rng = random.Random(3)
    pairs = [(" ".join(rng.choices("abcdef", k=rng.randint(0, 30))), " ".join(rng.choices("abcdef", k=rng.randint(0, 30)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "p string, r string")
    for row in df.select("p", "r", scoring.rouge_l(F.col("p"), F.col("r")).alias("x")).collect():
        p, r, n = row["p"].split(), row["r"].split(), lcs(row["p"].split(), row["r"].split())
        precision, recall = (n / len(p) if p else 0.0), (n / len(r) if r else 0.0)
        f1 = 2 * precision * recall / (precision + recall) if n else 0.0
        assert row["x"]["rouge_l_precision"] == pytest.approx(precision)
        assert row["x"]["rouge_l_recall"] == pytest.approx(recall)
        assert row["x"]["rouge_l_f1"] == pytest.approx(f1)


def one(spark, expr, schema, *values):
    return spark.createDataFrame([values], schema).select(expr.alias("x")).first()["x"]


def test_score_bounds(spark):
    f1 = scoring.rouge_l(F.col("p"), F.col("r"))["rouge_l_f1"]
    assert one(spark, f1, "p string, r string", "Avatar is a great film", "Avatar is a great film") > 0.9
    assert one(spark, f1, "p string, r string", "I recommend Avatar", "Watch Titanic instead") < 0.5
    fact = scoring.factuality_score(F.col("p"), F.col("c"))
    schema = f"p string, c {CONTEXT}"
    assert one(spark, fact, schema, "Avatar (2009) by James Cameron", AVATAR) >= 3
    assert one(spark, fact, schema, "Some other thing", AVATAR) <= 3
    assert one(spark, fact, schema, "anything", None) == 3.0
    helpful = scoring.helpfulness_score(F.col("p"), F.col("q"))
    listed = "1. Avatar is good\n2. Titanic is good\n" + "word " * 50
    assert one(spark, helpful, "p string, q string", listed, "good films") >= 3.5
    assert one(spark, helpful, "p string, q string", "Watch movies", "good films") <= 3.5


def test_recorded_run_winners(spark):
    rows = [
        ("zero_shot", 1, 0.18509329540618735, 0.08082521313855465, 3.0, 3.3514285714285714, 1983.2685470581055, 2245),
        ("few_shot_k3", 2, 0.1453588245488807, 0.10118600832886546, 2.6, 3.7871428571428574, 2502.9120445251465, 3943),
        ("few_shot_k5", 3, 0.15829269674250201, 0.0990310920736818, 3.4, 4.465714285714285, 3019.4154739379883, 5061),
        ("chain_of_thought", 4, 0.09054108682015657, 0.06483408404461036, 2.0, 3.1835714285714287, 2923.3964443206787, 3161),
        ("meta_prompt", 5, 0.0, 0.0, 0.0, 0.0, 0.0, 0),
    ]
    schema = "strategy string, ordinal int, rouge_l_f1 double, embedding_similarity double, factuality double, helpfulness double, latency_ms double, tokens long"
    best = evaluating.compare_strategies(spark.createDataFrame(rows, schema)).first().asDict()
    assert best == {
        "best_rouge_l": "zero_shot",
        "best_embedding_sim": "few_shot_k3",
        "best_factuality": "few_shot_k5",
        "best_helpfulness": "few_shot_k5",
        "fastest": "zero_shot",
        "most_efficient": "zero_shot",
    }


def test_errors_and_missing_references(spark):
    rows = [("s", 1, "q", "r", "r", None, 10.0, 5, None), ("s", 1, "q", "r", "r", None, 30.0, 7, "429"), ("s", 1, "q", "r", None, None, 20.0, 1, None)]
    schema = f"strategy string, ordinal int, query string, response string, reference string, context {CONTEXT}, latency_ms double, tokens_used long, error string"
    scored = evaluating.evaluate_responses(spark.createDataFrame(rows, schema))
    got = {r["latency_ms"]: r for r in scored.collect()}
    assert got[10.0]["rouge_l_f1"] == 1.0 and got[30.0]["factuality_score"] == 0.0 and got[20.0]["rouge_l_f1"] == 0.0
    s = evaluating.summarize_strategies(scored).first()
    assert (s["num_samples"], s["tokens"], s["latency_ms"]) == (3, 13, 15.0)
    assert s["error_rate"] == pytest.approx(1 / 3)


def test_prompts(spark):
    df = spark.createDataFrame([("q1", "What now?", [("T", None, 2009, "A")] * 7)], f"query_id string, query string, context {CONTEXT}")
    df = df.withColumn("context", F.transform("context", lambda d: F.struct(d["title"], d["director"], d["year"], d["genre"], F.lit(1.0).alias("rating"), F.lit("x").alias("cast"), F.repeat(F.lit("p"), F.lit(400)).alias("plot"))))
    prompts = {r["strategy"]: r["prompt"] for r in prompting.build_prompts(df).collect()}
    assert list(prompts) and set(prompts) == set(prompting.ALL_STRATEGIES)
    assert all("What now?" in p for p in prompts.values())
    assert prompts["few_shot_k5"].count("Example") == 5 and prompts["few_shot_k3"].count("Example") == 3
    assert "p" * 200 in prompts["zero_shot"] and "p" * 201 not in prompts["zero_shot"]
    assert "p" * 300 in prompts["meta_prompt"] and "p" * 301 not in prompts["meta_prompt"]
    assert "Director: N/A" in prompts["zero_shot"] and "[Doc 5]" in prompts["few_shot_k3"] and "[Doc 6]" not in prompts["few_shot_k3"]
    with pytest.raises(ValueError):
        prompting.select_strategies(["nope"])


def test_hash_values(spark):
    import hashlib
    import json

    ids = [f"user_{i}" for i in range(50)]
    df = spark.createDataFrame([(i,) for i in ids], "u string")
    for r in df.select("u", hashing.ab_bucket(F.lit("prompt_experiment"), F.col("u")).alias("b")).collect():
        assert r["b"] == (int(hashlib.md5(f"prompt_experiment:{r['u']}".encode()).hexdigest(), 16) % 1000) / 1000
    key = one(spark, hashing.cache_key(prompt=F.col("p"), n=F.lit(3)), "p string", "hi")
    assert key == hashlib.sha256(json.dumps({"n": 3, "prompt": "hi"}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    vec = one(spark, hashing.digest_vector(F.col("p")), "p string", "Hello")
    digest = hashlib.md5(b"hello").digest()
    assert len(vec) == 384 and vec[17] == digest[1] / 127.5 - 1


def test_text_edges(spark):
    assert one(spark, text.estimate_tokens(F.col("p")), "p string", "abcdefgh") == 3
    assert one(spark, text.jaccard_words(F.col("p"), F.lit("")), "p string", "a b") == 0.0
    assert one(spark, text.split_genres(F.col("p")), "p string", None) == []
    assert one(spark, text.truncate_ellipsis(F.col("p"), 5), "p string", "abcdef") == "ab..."
    parsed = text.parse_json_response(F.col("p"), "title string")["title"]
    assert one(spark, parsed, "p string", '```json\n{"title": "x"}\n```') == "x"
    assert one(spark, parsed, "p string", "no json") is None


def test_documents_as_shown_give_the_same_prompts(spark):
    fields = "id long, title string, genre string, year int, rating double, director string, cast string, plot string"
    docs = spark.createDataFrame(
        [(1, "T" * 400, "g", 1999, 0.5, "d", "", "ä𝄞" * 500), (2, None, None, None, None, None, None, None), (3, "t", "g", 1, 1.0, "d", "c", "short")], fields
    )
    shown = prompting.as_shown(docs)

    def prompts(rows):
        asked = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("context")).withColumn("query", F.lit("q"))
        return {r["strategy"]: r["prompt"] for r in prompting.build_prompts(asked).collect()}

    assert prompts(shown) == prompts(docs)
    widths = {r["id"]: (r["title"], r["plot"]) for r in shown.select("id", F.length("title").alias("title"), F.length("plot").alias("plot")).collect()}
    assert widths == {1: (400, 300), 2: (None, None), 3: (1, 5)}
