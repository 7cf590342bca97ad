import random
import re

import pytest

from tastegrid.llm import decontaminate
from tests.llm.fixtures import odd_rows, sentence, table

ITEMS = "item_id bigint, text string"


def tokens(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text or "")]


def greedy(doc, item, least):
    """Greedy string tiling as it is defined: mark the longest free match until none is left."""
    a, b = tokens(doc), tokens(item)
    used_a, used_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return out, len(b)
        out.append(k)
        used_a[i : i + k] = [True] * k
        used_b[j : j + k] = [True] * k


def by_hand(docs, items, seed, cover):
    out = []
    for d in docs:
        for item_id, text in items:
            found, size = greedy(d[1], text, seed) if d[1] and text and len(tokens(text)) >= seed else ([], 0)
            if found and sum(found) >= cover * size:
                out.append((str(d[0]), str(item_id), len(found), sum(found), size, max(found)))
    return sorted(out)


def found(spark, docs, items, **more):
    out = decontaminate.contaminated_pairs(table(spark, docs, clashes=True), spark.createDataFrame(items, ITEMS), **more).collect()
    return sorted((str(r["doc_id"]), str(r["item_id"]), r["n_tiles"], r["tile_words"], r["item_words"], r["longest_tile"]) for r in out)


def planted(seed=4):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.randint(20, 40))) for i in range(6)]
    items += [(90, None), (91, ""), (92, "too short"), (93, "la la la la la la la la la la")]
    docs = []
    for k, (_, text) in enumerate(items[:6]):
        words = text.split()
        half = len(words) // 2
        docs.append((10 * k, f"{sentence(rng, 9)} {text.upper()} {sentence(rng, 5)}", "en", "a", 1))
        docs.append((10 * k + 1, f"{' '.join(words[half:])}, {sentence(rng, 7)}: {' '.join(words[:half])}", "en", "a", 1))
        docs.append((10 * k + 2, f"{sentence(rng, 30)} {' '.join(words[: half // 2])}", "en", "a", 1))
        docs.append((10 * k + 3, f"{text}\n{text} {sentence(rng, 3)}", "en", "a", 1))
    docs += [(500, "la " * 8, "en", "a", 1), (501, "la " * 30, "en", "a", 1), (502, None, "en", "a", 1), (503, "", "en", "a", 1)]
    return docs, items


def test_planted_passages(spark):
    docs, items = planted()
    got = found(spark, docs, items, seed=5, cover=0.5)
    assert got == by_hand(docs, items, 5, 0.5)
    flagged = {(d, i) for d, i, *_ in got}
    assert all({(str(10 * k), str(k)), (str(10 * k + 1), str(k)), (str(10 * k + 3), str(k))} <= flagged for k in range(6))
    assert not any(d == str(10 * k + 2) for d, _ in flagged for k in range(6))


def test_low_thresholds_equal_the_definition(spark):
    docs, items = planted(5)
    assert found(spark, docs, items, seed=3, cover=0.1) == by_hand(docs, items, 3, 0.1)


def test_benchmark_in_blocks(spark):
    docs, items = planted(6)
    assert found(spark, docs, items, block_words=45) == found(spark, docs, items)
    clean = decontaminate.drop_contaminated(table(spark, docs), spark.createDataFrame(items, ITEMS), block_words=45)
    dropped = {str(d[0]) for d in docs} - {str(r["doc_id"]) for r in clean.collect()}
    assert dropped == {d for d, *_ in found(spark, docs, items)}


def test_unspaced_scripts(spark):
    chinese, thai, wide = "北京是中华人民共和国的首都", "กรุงเทพมหานครเป็นเมืองหลวง", "𠀀𠀁𠀂𠀃𠀄𠀅"
    items = [(1, chinese), (2, thai), (3, wide), (4, "ひらがなとabcカタカナ")]
    docs = [(10 * k, f"我们说过{text}。very good 好的", "zh", "a", 1) for k, text in items] + [(99, "上海是一座城市 and other words", "zh", "a", 1)]
    docs.append((50, chinese[7:] + "，" + chinese[:7], "zh", "a", 1))
    got = found(spark, docs, items)
    whole = [(str(10 * k), str(k), 1, n, n, n) for (k, _), n in zip(items, (len(chinese), len(thai), 6, 10))]
    assert got == sorted([*whole, ("50", "1", 2, len(chinese), len(chinese), 7)])


@pytest.mark.parametrize("items", [[], [(1, None)], [(None, "some words that stand in no document at all")]])
def test_odd_rows(spark, items):
    assert found(spark, odd_rows(), items) == []
    assert decontaminate.drop_contaminated(table(spark, odd_rows(), True), spark.createDataFrame(items, ITEMS)).count() == len(odd_rows())
    assert found(spark, [], [(1, "one two three four five six")]) == []


def test_repeated_words_are_not_listed():
    import resource
    import time

    import numpy as np
    import pyarrow as pa

    from tastegrid.llm.words import texts_of

    held, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    items = decontaminate.Items([1], pa.array(["spam " * 1000]), 5)
    got = list(decontaminate.matches(*texts_of(pa.array(["spam " * 20_000])), items, 0.5))
    assert got == [(0, 0, 1, 1000, 1000)] and time.time() - began < 2
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - held < 200_000
    rng = np.random.default_rng(1)
    for _ in range(60):  # few different words: both ways give the tiles of the definition
        a, b = (rng.integers(0, 2, rng.integers(5, 40)).astype(np.uint64) for _ in range(2))
        seeds = [(i, j) for i in range(len(a) - 2) for j in range(len(b) - 2) if (a[i : i + 3] == b[j : j + 3]).all()]
        want, _ = greedy(" ".join(map(str, a)), " ".join(map(str, b)), 3)
        by_length = decontaminate.tiles_by_length(a, b, 3)
        assert [n for *_, n in by_length] == want
        assert sorted(by_length) == sorted(decontaminate.tiles(*(np.array(c, np.int64) for c in zip(*seeds)), 3) if seeds else [])


def test_short_items_match_whole_texts(spark):
    items = [(1, "too short"), (2, "one"), (3, "!!!")]
    docs = [(1, "Too, SHORT!", "en", "a", 1), (2, "too short for this", "en", "a", 1), (3, "one", "en", "a", 1), (4, "...", "en", "a", 1)]
    assert found(spark, docs, items) == [("1", "1", 1, 2, 2, 2), ("3", "2", 1, 1, 1, 1)]
