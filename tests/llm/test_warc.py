"""WARC round trip: magic inside payloads, revisits, nulls, small splits."""

import base64
import hashlib

import numpy as np
import pytest

from tillroll.llm import warc
from tillroll.session import shared_path

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def _rows():
    same = "<p>same</p>" * 20
    rows = [(1, "http://a", "plain"), (2, "http://b\r\nX: y", f"x{FAKE}y{FAKE}"), (3, None, None), (4, "d%41", ""),
            (7, "e", same), (5, "f", same), (9, "g", same), (10, "h", "WARC/1.0\r\n"), (11, "i", "é" * 3000 + FAKE * 40),
            (None, "j", "no id"), (12, "k", FAKE), (13, "l", "Content-Length: 7\r\n\r\n")]
    return rows + [(100 + i, "u", f"page {i} " + "w" * (i % 50)) for i in range(200)]


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_round_trip(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pages = spark.createDataFrame(_rows(), "page_id long, url string, html string").repartition(3)
        path = shared_path(spark, "warc-test", unique=True)
        warc.write_warc(pages, path)
        got = {r["id"]: r for r in warc.resolve(warc.read_warc(spark, path, payload=False)).collect()}
        full = {r["id"]: r for r in warc.read_warc(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.set("spark.sql.files.openCostInBytes", "4m")
    first = {}
    for page, _, html in sorted(_rows(), key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page)
    assert len(got) == len(full) == len(_rows())
    for page, url, html in _rows():
        key, data = None if page is None else str(page), (html or "").encode()
        r, revisit = got[key], first[html or ""] != page
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (str(first[html or ""]) if revisit else None)
        assert full[key]["url"] == url
        assert bytes(full[key]["payload"]) == (b"" if revisit else data)


def test_empty_table(spark):
    path = shared_path(spark, "warc-test", unique=True)
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.resolve(warc.read_warc(spark, path, payload=False)).count() == 0


def test_chains_of_a_split():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40, 900):
        offset = np.sort(rng.choice(50 * n, n, replace=False))
        after = offset[np.minimum(np.arange(n) + rng.integers(1, 4, n), n - 1)]
        after = np.where(rng.random(n) < 0.05, 50 * n + 7, after)  # out of the split
        after = np.where((after > offset) & (rng.random(n) < 0.9), after, -1)
        entry = rng.random(n) < 0.1
        place = {int(o): i for i, o in enumerate(offset)}
        leaves, real = after.copy(), entry.copy()
        for i in range(n - 1, -1, -1):
            if int(after[i]) in place:
                leaves[i] = leaves[place[int(after[i])]]
        for i in range(n):
            if real[i] and int(after[i]) in place:
                real[place[int(after[i])]] = True
        assert (warc._leaves(offset, after) == leaves).all()
        assert (warc._reached(offset, after, entry) == real).all()


def test_payload_of_magic_lines(spark):
    # a chain of one record, and 40,000 places that look like records
    rows = [(1, "a", "WARC/1.0\r\n" * 40_000), (2, "b", FAKE * 2000), (3, "c", "plain")]
    path = shared_path(spark, "warc-magic", unique=True)
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = {r["id"]: r for r in warc.read_warc(spark, path).collect()}
    assert len(got) == 3
    for page, _, html in rows:
        assert bytes(got[str(page)]["payload"]) == html.encode()
