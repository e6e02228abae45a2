"""Operator 5: round trips, determinism and rows against brute force."""

import gzip
import hashlib
import json

from larder.llm import warc

PAGES = "page_id long, url string, html string, digest string, size string, shard string, largest string"
BIG = "é" * 600


def rows():
    own = ("d", "s", "h", "l")
    texts = [(1, "http://a/", "short"), (2, "http://b/", "short"), (3, "http://c/", BIG), (7, None, BIG), (5, "u\r\nX: y", BIG),
             (8, "http://d/", "x" * 999), (9, "http://d/", "x" * 999), (10, "http://e/", "x" * 1000), (11, "http://e/", "x" * 1000),
             (12, "http://f/", None), (13, "http://f/", ""), (14, "http://g/", "\r\n\r\n" * 400), (15, "http://h/", "y" * 300_000)]
    return [(*t, *own) for t in texts]


def brute(given):
    payload = {i: (h or "").encode() for i, _, h, *_ in given}
    out = []
    for i, b in payload.items():
        last = max(j for j, c in payload.items() if c == b)
        revisit = len(b) >= 1000 and last != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out)


def test_rows_equal_brute_force(spark):
    got = warc.write_and_read(spark.createDataFrame(rows(), PAGES))
    got = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == brute(rows())


def test_repeated_rows_and_null_ids(spark):
    given = [(1, "u", BIG), (1, "u", BIG), (None, "u", BIG), (None, None, None), (0, "u", BIG)]
    got = warc.write_and_read(spark.createDataFrame(given, "page_id long, url string, html string")).collect()
    kinds = sorted((r.page_id is not None, r.page_id or 0, r.record_type, r.refers_to or -1) for r in got)
    assert kinds == [(False, 0, "response", -1), (False, 0, "response", -1), (True, 0, "revisit", 1), (True, 1, "response", -1), (True, 1, "revisit", 1)]
    assert len({r.record_id for r in got if r.page_id is not None}) == 3


def test_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], PAGES)
    assert warc.write_warc(df, f"file://{tmp_path}/w") == [] and warc.write_and_read(df).collect() == []


def test_archives_are_standard_deterministic_and_roll(spark, tmp_path):
    df = spark.createDataFrame(rows(), PAGES)
    names = []
    for run, parts in (("a", 1), ("b", 5)):
        files = warc.write_warc(df.repartition(parts), f"file://{tmp_path}/{run}", file_bytes=500)
        names.append([f["path"].rsplit("/", 1)[1] for f in files])
    assert names[0] == names[1] and len(names[0]) > 3
    for n in names[0]:
        assert (tmp_path / "a" / n).read_bytes() == (tmp_path / "b" / n).read_bytes()
    listed = json.loads((tmp_path / "a" / "manifest.json").read_text())["files"]
    assert sum(f["records"] for f in listed) == len(rows()) and not list((tmp_path / "a").glob("_tmp*"))
    whole = b"".join(gzip.decompress((tmp_path / "a" / n).read_bytes()) for n in names[0])
    assert whole.count(b"WARC/1.1\r\n") == len(rows())
    ids = [int(line.split(b": ")[1]) for line in whole.split(b"\r\n") if line.startswith(b"X-Page-ID")]
    assert ids == sorted(ids)


def test_payloads_come_back(spark, tmp_path):
    files = warc.write_warc(spark.createDataFrame(rows(), PAGES), f"file://{tmp_path}/p")
    got = {r.page_id: r for r in warc.read_warc(spark, files, payloads=True).collect()}
    for i, url, html, *_ in rows():
        if got[i].record_type == "response":
            assert bytes(got[i].payload) == (html or "").encode()
        else:
            assert got[i].payload is None
    assert got[5].url == "u%0D%0AX: y"
