import random

import pytest
import zstandard

from tastegrid.llm import warc

SCHEMA = "page_id bigint, url string, html string, size string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)


def odd_pages():
    rng = random.Random(8)
    text = "<html>\r\n\r\n" + " ".join(rng.choice("abcdef") for _ in range(200)) + "é日本👍</html>"
    rows = [(1, "http://a/1", text), (2, "http://a/2", text), (9, None, text), (3, "http://b", ""), (4, "http://b\r\nX: y", None)]
    rows += [(9, "http://again", text), (9, None, text), (None, "http://n", "alone"), (None, None, text), (5, "http://c", "x" * 200_000)]
    rows += [(100 + i, f"http://d/{i}", "copy") for i in range(60)]
    return rows + [(200 + i, f"http://e/{i}", "".join(rng.choice("lorem ipsum <p>") for _ in range(300))) for i in range(60)]


def by_hand(rows):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for payload, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        first = True
        for i in ids:
            is_top = i == top and first
            first &= not is_top
            out.append((str(i), len(payload), warc.base32_sha1(payload), "response" if is_top else "revisit", str(None if is_top else top)))
    return sorted(out)


@pytest.mark.parametrize("limit", [1, 5_000, warc.ARCHIVE_BYTES])
def test_round_trip(spark, limit):
    rows = odd_pages()
    archives = warc.write_archives(pages(spark, rows), archive_bytes=limit)
    got = warc.read_archives(archives).collect()
    found = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got)
    assert found == by_hand(rows)
    texts = {(html or "") for _, _, html in rows}
    assert {r["html"] for r in got if r["record_type"] == "response"} == texts
    assert sum(r["records"] for r in archives.collect()) == len(rows)


def test_dictionary_frame_and_single_records(spark):
    rows = [(i, f"http://x/{i}", f"<html><body><h1>Title {i}</h1><p>the same words again {i * 7}</p></body></html>") for i in range(400)]
    archive = warc.write_archives(pages(spark, rows).coalesce(1)).first()
    path = archive["path"].removeprefix("file:")
    data = open("/" + path.lstrip("/"), "rb").read()
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE
    size = int.from_bytes(data[4:8], "little")
    body = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body)).decompressobj()
    first = reader.decompress(data[8 + size :])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and first.count(b"WARC/1.1") == 1
    assert archive["archive_bytes"] < archive["raw_bytes"] / 2


def test_a_damaged_payload_is_found(spark, tmp_path):
    record = warc.record_bytes(1, "http://x", b"payload", warc.base32_sha1(b"other"), "response", None)
    path = tmp_path / "bad.warc.zst"
    path.write_bytes(b"".join(warc.archive_bytes([record])))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(spark.createDataFrame([(str(path),)], "path string")).collect()


def test_empty(spark):
    archives = warc.write_archives(pages(spark, []))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0
