import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tastegrid.llm import trie
from tastegrid.llm.art import Node, Tree, sizes

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def paths(rows, rebuild):
    """conv_id -> list of (role, text), rebuilt or as they are."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, trie_id(role, text), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v, key=lambda t: t[:3])] for c, v in own.items()}
    if not rebuild:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def trie_id(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def by_hand(convs):
    """Every node by its definition."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    below = {}  # saved, leaves
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        below[p] = (saved + sum(below[k][0] for k in kids.get(p, ())), sum(below[k][1] for k in kids.get(p, ())) or 1)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), below[p][1], below[p][0], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_conversations():
    rng = random.Random(5)
    rows = [
        (None, 0, "user", "no conversation"), (1, None, "user", "first"), (1, 0, None, "second"), (1, 0, "user", None), (2, 0, "user", "same"), (2, 0, "user", "same"),
        (3, 5, "", ""), (300, 0, "user", "é👍"), (-5, 0, "user", "below"), (7, 0, "user", "x" * 20_000),
    ]
    for c in range(100, 140):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "a longer text"])) for t in range(rng.randint(1, 9))]
    for c in (500, 501, 502):  # far longer than one key, different late
        rows += [(c, t, "user", f"turn {t}" if t < 150 or c == 500 else f"turn {t} of {c}") for t in range(200)]
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_odd_rows(spark, rebuild):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit("own").alias("id"), F.lit("own").alias("depth"), F.lit("own").alias("owner"))
    got = trie.rebuilt_trie(df) if rebuild else trie.prefix_trie(df)
    assert collected(got) == by_hand(paths(rows, rebuild))


def test_small_chunks_and_runs(spark, monkeypatch):
    """Every bound at its least: many trees, keys, runs and packed pieces give the same nodes."""
    for name, value in (("SPAN", 4), ("CHUNK", 8), ("RUN_BITS", 1), ("PIECE_BITS", 1), ("ASK_BITS", 1)):
        monkeypatch.setattr(trie, name, value)
    rows = odd_conversations()
    got = collected(trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    assert got == by_hand(paths(rows, True))


def test_hot_conversation_and_first_turn(spark):
    rng = random.Random(2)
    rows = []
    for c in range(300):
        if c % 3 == 0:
            rows += [(c, t, "user", f"copy {t}") for t in range(5)]
        else:
            rows += [(c, 0, "user", "copy 0" if c % 3 == 1 else f"own {c}")] + [(c, t, "user", rng.choice("ab")) for t in range(1, rng.randint(1, 7))]
    for df_rows in (rows,):
        assert collected(trie.prefix_trie(spark.createDataFrame(df_rows, SCHEMA))) == by_hand(paths(df_rows, False))
        assert collected(trie.rebuilt_trie(spark.createDataFrame(df_rows, SCHEMA))) == by_hand(paths(df_rows, True))


def test_empty_and_turnless(spark):
    assert trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    few = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(few, 0, "user", "taken away")]  # no base: nothing is left of it
    assert collected(trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA))) == [(few, 0, None, 1, 0, 1, 0, hashlib.sha256(str(few).encode()).hexdigest())]


def test_layouts_grow_and_find_all():
    rng = random.Random(1)
    tree, keys = Tree(), {}
    for i in range(20_000):
        key = bytes([10 + i % 40]) * 2 + bytes([i % 3]) if i < 200 else bytes(rng.choice((0, 7, 9)) for _ in range(3)) + rng.randbytes(1 + 4 * rng.randint(0, 2)) if rng.random() < 0.9 else b"\x01" * rng.choice((4, 8))
        keys.setdefault(key, []).append(len(keys))
        tree.insert(key, key)
    assert {name for name, _ in sizes(tree)} == {"Beside", "Slots", "Direct"}
    assert max(n for name, n in sizes(tree) if name == "Beside") <= 16 and min(n for name, n in sizes(tree) if name == "Direct") > 48
    ended = []
    tree.fold(0, 1, lambda e: 1, lambda a, b: a + b, lambda state, k, entries: ended.extend(entries) or state)
    assert sorted(ended) == sorted(k for k, v in keys.items() for _ in v)
    assert isinstance(tree.root, Node)


def test_fold_tells_aligned_depths_only():
    tree = Tree()
    for key in (b"hAAAABBBB", b"hAAAABBBC", b"hAAAA", b"hAACC"):
        tree.insert(key, key)
    told = []
    tree.fold(1, 4, lambda e: {e}, lambda a, b: a | b, lambda s, k, ended: told.append((k, len(s), len(ended))) or s)
    assert sorted(told) == [(1, 1, 1), (1, 3, 1), (2, 1, 1), (2, 1, 1)]
