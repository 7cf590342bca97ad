import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tastegrid.llm import fingerprints as fp
from tests.llm.fixtures import hot_rows, odd_rows, table

PIECE = re.compile(r"(?:[^ \t\n\x0b\x0c\r]++(?<![.!?])[ \t\x0b\x0c\r]++(?=[^ \t\n\x0b\x0c\r])){0,7}+[^ \t\n\x0b\x0c\r]++[ \t\n\x0b\x0c\r]*+|[ \t\n\x0b\x0c\r]++")


def lanes(text):
    """The fingerprint by hand."""
    pieces = PIECE.findall(text)
    out = [len(pieces)]
    hashes = [[_hash(k, p) for p in pieces] for k in range(fp.STRONG + fp.SIGNED)]
    out += [sum(h) % 2**64 for h in hashes[: fp.STRONG]]
    for h in hashes[fp.STRONG :]:
        for j in range(fp.FIELD):
            ones = [sum(v >> j + place * fp.FIELD & 1 for v in h) % 2**fp.FIELD for place in range(3)]
            out.append(sum(n << place * fp.FIELD for place, n in enumerate(ones)))
    return out


def _hash(seed, piece):
    first = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), seed=42)
    return xxhash.xxh64_intdigest(piece.encode(), seed=first)


def printed(values):
    return "".join(f"{v:016X}" for v in values)


def by_hand(docs):
    """doc_id, n_chars, sha256, fingerprint, edited fingerprint of rows with different (doc_id, text)."""
    keys = sorted({(d[0], d[1] or "") for d in docs}, key=lambda k: (k[0] is None, -(k[0] or 0), hashlib.sha256(k[1].encode()).digest()))
    out = {}
    for i, (doc_id, text) in enumerate(keys):
        following = keys[(i + 1) % len(keys)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        out[doc_id, text] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(lanes(text)), printed(lanes(edited)))
    return out


def test_odd_rows(spark):
    docs = odd_rows()
    want = by_hand(docs)
    got = fp.fingerprint_report(table(spark, docs, clashes=True)).collect()
    expected = sorted((str(d[0]), *want[d[0], d[1] or ""]) for d in docs)
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in got) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_likeness_follows_shared_pieces(spark):
    got = fp.fingerprint_report(table(spark, hot_rows())).collect()
    copies = [r for r in got if 0 < r["doc_id"] < 60]
    assert all(r["near_next"] == 1.0 for r in copies)
    strangers = [r["near_next"] for r in got if r["doc_id"] > 2000]
    assert sum(strangers) / len(strangers) < 0.2


def test_pieces_go_in_and_out(spark):
    rows = spark.createDataFrame([("first one.\nsecond two.\n", "second two.\n", "first one.\n", "second two.\nfirst one.\n")], "a string, b string, c string, d string")
    for c in "abcd":
        rows = fp.with_lanes(rows, c, f"l{c}")
    r = rows.select(
        (fp.combine(F.col("lb"), F.col("lc")) == F.col("la")).alias("sum"),
        (fp.combine(F.col("la"), F.col("lb"), -1) == F.col("lc")).alias("difference"),
        (F.col("la") == F.col("ld")).alias("order"),
    ).first()
    assert r["sum"] and r["difference"] and r["order"]


@pytest.mark.parametrize("docs", [[], [(1, "only one text here", "en", "a", 1)], [(1, None, None, None, None)]])
def test_few_rows(spark, docs):
    got = fp.fingerprint_report(table(spark, docs)).collect()
    assert len(got) == len(docs)
    for r in got:  # a row alone is its own next document
        assert r["near_next"] == 1.0


@pytest.mark.parametrize("lines, word", [(2**21 + 1, "a")])
def test_more_pieces_than_a_lane_counts(spark, lines, word):
    """Equal lines: every lane is the number of pieces times the lane of one, modulo its width."""
    df = spark.range(1).select(F.repeat(F.lit(word + "\n"), lines).alias("t"), F.lit(word + "\n").alias("one"))
    r = fp.with_lanes(fp.with_lanes(df, "t", "many"), "one", "single").select("many", "single").first()
    one = lanes(word + "\n")
    assert [v % 2**64 for v in r["single"]] == one
    want = [lines] + [v * lines % 2**64 for v in one[1 : 1 + fp.STRONG]]
    for v in one[1 + fp.STRONG :]:
        want.append(sum((v >> p * fp.FIELD) % 2**fp.FIELD * lines % 2**fp.FIELD << p * fp.FIELD for p in range(3)))
    assert [v % 2**64 for v in r["many"]] == want


def test_long_sums_equal_short_ones(spark, monkeypatch):
    docs = table(spark, odd_rows())
    plain = fp.with_lanes(docs, "text", "lanes").select("lanes").collect()
    monkeypatch.setattr(fp, "SHORT", -1)
    assert fp.with_lanes(docs, "text", "lanes").select("lanes").collect() == plain
