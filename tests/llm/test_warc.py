from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import pathlib

import pytest

from sparkmart.llm import warc

NASTY = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx\n\x00é"
ROWS = [
    (5, "http://a/", "<p>one</p>"), (3, "http://b/", "<p>one</p>"), (9, None, "<p>one</p>"), (1, "http://c/", NASTY),
    (2, "http://d/\r\nX: y", NASTY), (4, "http://e/", None), (6, "http://f/", ""), (7, "http://g/", "x" * 300_000),
    (8, "http://h/", "short"), (8, "http://h/", "short"), (None, "http://i/", "short"), (None, "http://j/", "alone"),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id LONG, url STRING, html STRING, at LONG, payload STRING")


def expected(rows, least):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = min(same) if same and len(payload) >= least else None
        revisit = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "size", "hot"), [(0, 1 << 24, 1000), (8, 1000, 1000), (0, 1000, 2)])
def test_round_trip(sent, tmp_path, monkeypatch, least, size, hot):
    monkeypatch.setattr(warc, "HOT_COPIES", hot)
    rows = ROWS + [(77, "http://k/", "often")] * 9 + [(78, "http://l/", "often")]
    path = warc.archive_pages(pages(sent, rows), str(tmp_path), least, archive_bytes=size)
    found = warc.read_archives(sent, path, payloads=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=repr) == expected(rows, least)
    for row in found:
        if row.record_type == "response":
            assert row.html in {h or "" for p, _, h in rows if p == row.page_id}
        else:
            assert row.html is None


def content(path):
    """The bytes of each archive under a path."""
    return {p: p.read_bytes() for p in pathlib.Path(path).glob("part-*")}


def test_records_are_warc(sent, tmp_path):
    path = warc.archive_pages(pages(sent, ROWS[:2]), str(tmp_path), date="2026-03-01T00:00:00Z")
    text = b"".join(gzip.decompress(c) for c in content(path).values()).decode()
    assert text.count("WARC-Type: warcinfo") == len(content(path)) and text.count("WARC/1.1") == 2 + len(content(path))
    assert "WARC-Profile: " + warc.PROFILE in text and "WARC-Date: 2026-03-01T00:00:00Z" in text
    assert "WARC-Refers-To: <urn:uuid:" in text and "WARC-Refers-To-Target-URI: http://b/" in text


def test_index_and_ids(sent, tmp_path):
    """Every record is read by its offset alone; ids are unique, and revisits refer to one of them."""
    path = warc.archive_pages(pages(sent, ROWS), str(tmp_path), archive_bytes=1000)
    files = content(path)
    index = warc.index_archives(sent, path).collect()
    assert len(index) == len(ROWS) + len(files) and len({r.record_id for r in index}) == len(index)
    assert sum(r.length for r in index) == sum(map(len, files.values()))
    refers = set()
    for r in index:
        name = pathlib.Path(r.archive.removeprefix("file:"))
        ((named, block),) = warc.records_in(gzip.decompress(files[name][r.offset : r.offset + r.length]))
        assert named["WARC-Record-ID"] == r.record_id and named["WARC-Type"] == r.record_type
        assert dt.datetime.now(dt.timezone.utc) - dt.datetime.fromisoformat(named["WARC-Date"]) < dt.timedelta(minutes=10)
        refers |= {named[k] for k in ("WARC-Refers-To",) if k in named}
    assert refers and refers <= {r.record_id for r in index if r.record_type == "response"}


@pytest.mark.parametrize("size", [0, 1, 300, (1 << 24) + 5])
def test_members_end_in_zero(size):
    packed = warc.member(b"x" * size) + warc.member(b"next")
    assert not packed[-1]
    found = list(warc.members_in(packed))
    assert [m for _, _, m in found] == [b"x" * size, b"next"]
    assert sum(n for _, n, _ in found) == len(packed)


def test_damage_is_found(sent):
    with pytest.raises(ValueError):
        list(warc.records_in(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n"))


def test_empty(sent, tmp_path):
    path = warc.archive_pages(pages(sent, []), str(tmp_path))
    assert warc.read_archives(sent, path).count() == 0
