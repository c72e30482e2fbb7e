import base64
import gzip
import hashlib
from datetime import datetime

import pytest

from tickframe.llm import warc_revisit as W
from tickframe.llm._common import scratch_path

PAGE = "page_id bigint, url string, html string"


def round_trip(workers, rows, least=0, extra=""):
    pages = workers.createDataFrame(rows, PAGE).repartition(3)
    path = scratch_path(workers, "warc")
    W.write_archives(pages.selectExpr("*", extra) if extra else pages, path, least, datetime(2024, 1, 2))
    return path, W.resolved(W.read_records(workers, path, payloads=True)).collect()


def rows_with_copies():
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>") for i in range(60, 0, -1)]
    return rows + [(100, None, None), (101, "http://h/ä b\r\nX: 1", ""), (102, "u", "é" * 50_000), (103, "u", "\r\n\r\nWARC/1.1\r\n")]


def test_records_of_all_pages(workers):
    rows = rows_with_copies()
    path, found = round_trip(workers, rows, extra="'x' AS record_type")
    least = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        least[payload] = min(page, least.get(payload, page))
    assert len(found) == len(rows)
    by = {r["page_id"]: r for r in found}
    for page, _, html in rows:
        payload, r = (html or "").encode(), by[page]
        first = least[payload]
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page == first else ("revisit", first))
        assert (r["payload"] is None) == (page != first) and (page != first or bytes(r["payload"]) == payload)


def test_small_payloads_are_all_responses(workers):
    _, found = round_trip(workers, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], least=5)
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in found) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_repeated_rows_and_missing_ids(workers):
    _, found = round_trip(workers, [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", "b"), (None, "v", "b")])
    assert sorted((r["record_type"], r["page_id"] or 0, r["refers_to"] or 0, r["payload_bytes"]) for r in found) == [
        ("response", 0, 0, 1), ("response", 1, 0, 1), ("revisit", 0, 0, 1), ("revisit", 0, 1, 1), ("revisit", 1, 1, 1)]


def test_members_are_records_and_damage_is_an_error(workers, tmp_path):
    path, _ = round_trip(workers, [(1, "u", "alpha"), (2, "u", "alpha")])
    name = next(iter(workers.read.parquet(f"{path}/manifest").collect()))["name"]
    local = path.removeprefix("file:")
    text = gzip.open(f"{local}/{name}", "rb").read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"WARC-Date: 2024-01-02T00:00:00Z" in text
    (tmp_path / name).write_bytes(gzip.compress(text.replace(b"alpha", b"alphb")))
    workers.read.parquet(f"{path}/manifest").write.parquet(f"{tmp_path}/manifest")
    if b"alpha" in text:
        with pytest.raises(Exception, match="digest"):
            W.read_records(workers, str(tmp_path)).collect()


def test_empty_table(workers):
    assert round_trip(workers, [])[1] == []
