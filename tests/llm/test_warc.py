"""Archives: round trip, revisits, seek table and index."""

import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from riskloom.llm import warc

LONG = "<html>" + "é" * 80 + "</html>"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def rows():
    out = [(i, f"http://h{i}.example/{i}", f"<p>page {i}</p>" + "x" * (i * 37 % 900)) for i in range(60)]
    out += [(70, "http://a/", LONG), (65, "http://b/", LONG), (90, None, LONG), (None, "http://null/", LONG), (65, "http://b/", LONG)]
    out += [(91, "http://c/", "short"), (92, "http://c/", "short"), (93, None, None), (94, "", ""), (95, "http://line\r\nbreak: \x00", "a\r\n\r\nWARC/1.1\r\n")]
    out += [(None, None, "unnumbered " * 20), (96, "http://big/", "y" * 3_000_000)]
    return out


def expected(data):
    first = {}
    for page, _, html in data:
        if html is not None and len(html.encode()) >= 100 and page is not None:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, url, html in data:
        body = (html or "").encode()
        other = first.get(html)
        revisit = other is not None and page != other
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("frame,bundle", [(1 << 20, 64 << 20), (2000, 6000)])
def test_round_trip(spark, tmp_path, monkeypatch, frame, bundle):
    monkeypatch.setattr(warc, "FRAME_BYTES", frame)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", bundle)
    records, index = warc.archive_pages(pages(spark, rows()), str(tmp_path))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = sorted(repr(tuple(r)) for r in records.select(*names).collect())
    assert got == expected(rows())
    urls = {r.page_id: r.url for r in records.collect()}
    assert urls[93] is None and urls[94] == "" and urls[95] == "http://line%0D%0Abreak: %00"
    # Any Zstandard reader sees the records one after the other and skips the seek table.
    for row in index.select("bundle").distinct().collect():
        data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(row.bundle, "rb").read()), read_across_frames=True).read()
        at = count = 0
        while at < len(data):
            _, _, at = warc.parse_record(data, at)
            count += 1
        assert count == index.where(F.col("bundle") == row.bundle).count()


def test_index_leads_to_single_records(spark, tmp_path):
    records, index = warc.archive_pages(pages(spark, rows()), str(tmp_path))
    wanted = index.where(F.col("page_id").isin(7, 41, 90))
    one = {r.page_id: r for r in warc.fetch_records(wanted, str(tmp_path)).collect()}
    full = {r.page_id: r for r in records.where(F.col("page_id").isin(7, 41, 90)).collect()}
    assert one == full and one[90].record_type == "revisit" and one[90].refers_to == 65


def test_empty(spark, tmp_path):
    records, index = warc.archive_pages(pages(spark, []), str(tmp_path))
    assert records.count() == index.count() == 0


def test_damage_is_found(tmp_path):
    stream = open(tmp_path / "x", "wb")
    writer = warc.BundleWriter(stream)
    body = b"payload " * 30
    digest = hashlib.sha256(body).hexdigest()
    writer.add_frame([warc.build_record(1, "u", body, len(body), digest, None)])
    writer.close()
    import pyarrow.fs as pafs

    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as source:
        frames = warc.seek_table(source)
        record = warc.read_frame(source, *frames[0])
    headers, block, _ = warc.parse_record(record)
    assert warc.read_row(headers, block)[:4] == (1, len(body), digest, "response")
    with pytest.raises(ValueError):
        warc.read_row(headers, block.replace(b"payload", b"pAyload", 1))
    with pytest.raises(ValueError):
        warc.parse_record(record[:-10])
    (tmp_path / "y").write_bytes(struct.pack("<IBI", 1, 0, 7) * 3)
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "y")) as source, pytest.raises(ValueError):
        warc.seek_table(source)
