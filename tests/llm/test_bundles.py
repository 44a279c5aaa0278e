from __future__ import annotations

import base64
import hashlib
import io

import pytest
import zstandard

from civiclake.llm import bundles, queries
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


def expected(rows, least=0):
    largest: dict = {}
    for page, html in rows:
        data = (html or "").encode()
        if len(data) >= least:
            largest[data] = max(largest.get(data, page), page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        first = largest.get(data, page)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if first == page else "revisit", None if first == page else first))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=repr)


def test_op6(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert rows_of(queries.op6_warc_bundles(spark, SF)) == expected(pages)
    assert differences(queries.op6_warc_bundles(spark, SF), connect(SF), queries.ORACLE["op6_warc_bundles"]) == []


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip_of_odd_pages(spark, tmp_path, least):
    html = ["<p>é\r\n\r\nx</p>", None, "", "same", "same", "same", "ab", "ab", "a" * 5000, "\r\n\r\n"]
    rows = [(i, f"http://x/{i} ä\r\nb", h) for i, h in enumerate(html)] + [(5, "http://x/5", "same"), (20, None, "last")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    folder = f"file://{tmp_path}/w"
    index = bundles.write_bundles(pages, folder, least_bytes=least, frame=300, bundle=2000)
    records = bundles.read_records(index, folder)
    assert rows_of(bundles.verified(records)) == expected([(r[0], r[2]) for r in rows], least)
    payloads = {r.page_id: bytes(r.payload) for r in records.collect() if r.payload is not None}
    assert all(payloads[i] == (h or "").encode() for i, _, h in rows if i in payloads)
    assert index.select("bundle").distinct().count() >= 1
    some = index.where("page_id = 8")  # one record alone
    assert [r.page_id for r in bundles.read_records(some, folder).collect()] == [8]


def test_any_reader_decompresses_a_bundle():
    writer = bundles.Writer(frame=50)
    parts = [bytes([65 + i]) * (20 + i) for i in range(9)]
    places = [writer.add(p) for p in parts]
    data = writer.finish()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(parts)
    table = bundles.seek_table(io.BytesIO(data), len(data))
    for part, (frame, offset) in zip(parts, places, strict=True):
        start, size = table[frame]
        own = zstandard.ZstdDecompressor().decompress(data[start : start + size])
        assert own[offset : offset + len(part)] == part
    assert bundles.seek_table(io.BytesIO(empty := bundles.Writer().finish()), len(empty)) == []


def test_empty_table_and_missing_id(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    index = bundles.write_bundles(none, str(tmp_path / "a"))
    assert bundles.read_records(index, str(tmp_path / "a")).count() == 0
    bad = spark.createDataFrame([(None, "u", "h")], none.schema)
    with pytest.raises(Exception, match="no page_id"):
        bundles.write_bundles(bad, str(tmp_path / "b"))


def test_reader_hands_on_bounded_batches(spark, tmp_path):
    """Forty pages of a megabyte are never held at once by whoever gets the payloads."""
    pages = spark.range(40).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 600000) as html").coalesce(1)
    index = bundles.write_bundles(pages, folder := str(tmp_path / "w")).toArrow().combine_chunks()
    batches = index.select(["bundle", "frame", "offset", "length"]).to_batches()
    got = [sum(len(p) for p in b.column("payload").to_pylist()) for b in bundles._read(folder)(iter(batches))]
    assert sum(got) == 70 * 600_000 and max(got) < bundles.BATCH + 1_300_000
