import base64
import hashlib

import zstandard

from riskbook.llm import warc as W
from riskbook.llm.storage import get_file, scratch

COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def brute(rows, least=0):
    first, seen, out = {}, set(), []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for page_id, _, html in order:
        first.setdefault(html or "", page_id)
    for page_id, _, html in order:
        payload = (html or "").encode()
        again = len(payload) >= least and (html or "") in seen
        seen.add(html or "")
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [
    (1, "u", "abc"), (1, "u", "abc"), (2, None, "abc"), (None, "a\r\nb", "abc"), (3, "x", None), (4, "y", ""), (5, "z", "é"),
    (7, "v", "\r\n\r\nWARC/1.1\r\n"), (6, "w", "x" * 600_000), (8, "w", "x" * 600_000),
]


def test_records_equal_those_by_hand(spark):
    for least in (0, 3, 10):
        found = W.round_trip(pages(spark, ROWS).selectExpr("*", "1 AS size", "'x' AS key", "2 AS nth"), least).select(*COLUMNS)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(ROWS, least)


def test_given_pages(spark, data):
    given = spark.read.parquet(f"{data}/pages.parquet")
    rows = [tuple(r) for r in given.select("page_id", "url", "html").collect()]
    rows += [(10**6 + i, r[1], r[2]) for i, r in enumerate(rows[:20])]
    found = W.round_trip(pages(spark, rows)).select(*COLUMNS)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_bundles_are_plain_zstandard_and_any_record_is_found(spark, monkeypatch):
    monkeypatch.setattr(W, "FRAME_BYTES", 2000)
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>" * (1 + i % 60)) for i in range(200)]
    folder = scratch(spark) + "/warc"
    bundles = [r["file"] for r in W.write(pages(spark, rows).coalesce(1), folder).collect()]
    seen = 0
    for file in bundles:
        data = get_file(folder, file)
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        bundle = W.open_bundle(folder, file)
        assert len(bundle.frames) > 3 and sum(plain for _, _, plain in bundle.frames) == len(whole)
        for identifier in bundle.index():
            fields, block = bundle.record(identifier)
            page = int(fields["Page-ID"])
            assert block.split(b"\r\n\r\n", 1)[1].decode() == rows[page][2] and fields["WARC-Target-URI"] == rows[page][1]
            seen += 1
    assert seen == 200


def test_frames_are_independent_and_the_table_adds_up():
    writer = W.BundleWriter()
    for i in range(500):
        writer.add(*W.record(i, None, bytes([i % 256]) * 5000, f"D{i}", 1, None))
    data = b"".join(writer.finish())
    bundle = W.Bundle(lambda start, length: data[start:][:length])
    assert sum(packed for _, packed, _ in bundle.frames) < len(data) and len(list(bundle.records())) == 500
    assert bundle.frame(3)  # without any frame before it


def test_no_pages(spark):
    assert W.round_trip(pages(spark, ROWS).limit(0)).count() == 0
