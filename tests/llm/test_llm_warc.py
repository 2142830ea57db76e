from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import pytest
from pyarrow import fs

from coverbay.llm import warc

PAGES = "page_id long, url string, html string, digest string, n int"


def pages():
    rng = random.Random(1)
    big = "<p>" + "ä" * 80 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(i, f"http://x/{i}", "<html>" + str(rng.random()) * rng.randrange(0, 60)) for i in range(60)]
    rows += [(100 + i, "http://y/", big) for i in range(40)] + [(7, "again", big), (7, "again", big)]
    rows += [(200 + i, None, "short") for i in range(5)] + [(300, "a b\r\nc", None), (301, "", ""), (None, "u", big), (None, "u", "z" * 200)]
    return [(*r, "mine", 1) for r in rows] + [(400, "long", "<b>" * 400_000, None, None)]


def brute(rows):
    first = {}
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        refers = first.get(data) if first.get(data, page_id) != page_id else None
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [1, 3000, warc.ARCHIVE_BYTES])
def test_round_trip(spark, archive_bytes):
    rows = pages() if archive_bytes > 1 else pages()[:80]
    folder = warc.new_folder(spark)
    written = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), folder, archive_bytes)
    archives = warc.normalise(written, folder)
    got = warc.read_records(archives).collect()
    assert sorted((tuple(r[n] for n in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == brute(rows)
    html = {(r[0], r[2]) for r in rows}
    assert all((r["page_id"], r["html"]) in html or (r["page_id"], None) in html and r["html"] == "" for r in got if r["record_type"] == "response")
    assert sum(r["records"] for r in archives.collect()) == sum(r["records"] for r in written.collect()) == len(rows)


def test_members_stand_alone_and_the_index_finds_them(spark):
    folder = warc.new_folder(spark)
    written = warc.write_archives(spark.createDataFrame(pages(), PAGES).repartition(1), folder)
    files, path = fs.FileSystem.from_uri(written.first()["path"])
    whole = zlib.decompressobj(31)
    plain = whole.decompress(files.open_input_stream(path, compression=None).read())
    assert whole.eof and not whole.unused_data  # one stream
    files, path = fs.FileSystem.from_uri(warc.normalise(written, folder).first()["path"])
    data = files.open_input_stream(path, compression=None).read()
    lines = files.open_input_stream(path + ".idx", compression=None).read().decode().splitlines()
    assert b"".join(gzip.decompress(data[int(o) : int(o) + int(n)]) for o, n, _ in (x.split(" ") for x in lines)) == plain
    again = warc.normalise(spark.createDataFrame([("file://" + path,)], "path string"), folder)
    assert again.first()["records"] == len(lines)  # members in, members out


def test_broken_archives_are_refused():
    good = warc.record(1, "u", b"payload", "00", None)
    assert len(list(warc.records(iter([good[:10], good[10:], good])))) == 2
    for bad in (good[:-6], good[:20]):
        with pytest.raises(ValueError):
            list(warc.records(iter([bad])))


def test_no_pages(spark):
    folder = warc.new_folder(spark)
    archives = warc.normalise(warc.write_archives(spark.createDataFrame([], PAGES), folder), folder)
    assert warc.read_records(archives).collect() == []
