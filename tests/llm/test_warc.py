import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from claimweave.llm import warc

SCHEMA = "page_id bigint, url string, html string, archive string, offset int, digest string, first_id int"
PAGES = [
    (3, "http://b.example/x", "<p>one</p>", "c", 1, "d", 1), (1, "https://a.example/y?q=1#top", "<p>one</p>", "c", 1, "d", 1),
    (2, "http://a.example/y", "line\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nlines", "c", 1, "d", 1),
    (4, None, None, "c", 1, "d", 1), (5, "", "", "c", 1, "d", 1), (6, "ftp://ü.example/a b\r\nX: y", "été 東京 \u0000 end", "c", 1, "d", 1),
    (7, "http://a.example/y", "x" * 300_000, "c", 1, "d", 1), (7, "http://a.example/y", "x" * 300_000, "c", 1, "d", 1),
    (None, "http://a.example/y", "<p>one</p>", "c", 1, "d", 1), (None, "http://z.example", "alone", "c", 1, "d", 1),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(pages):
    low = {}
    for i, _, html, *_ in pages:
        key = html or ""
        low[key] = min((x for x in (low.get(key), i) if x is not None), default=None)
    out = []
    for i, _, html, *_ in pages:
        first = low[html or ""]
        out.append((i, len((html or "").encode()), digest(html), "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=str)


def table(spark, pages=PAGES):
    return spark.createDataFrame(pages, SCHEMA)


def test_round_trip_of_awkward_pages(spark):
    got = warc.archive_and_index(table(spark)).collect()
    rows = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(rows, key=str) == brute(PAGES)
    assert sorted(r["position"] for r in got) == list(range(len(PAGES)))
    in_order = sorted(got, key=lambda r: r["position"])
    key = lambda r: (r["url_key"].encode(), r["ts"], r["page_id"] is None, r["page_id"] or 0)
    assert [key(r) for r in in_order] == sorted(key(r) for r in got)
    assert warc.archive_and_index(table(spark, [])).collect() == []


def test_records_are_found_by_offset(spark, tmp_path):
    path = str(tmp_path / "warc")
    index = warc.archive_and_index(table(spark), path=path).collect()
    files = {r["path"].rsplit("/", 1)[-1]: bytes(r["content"]) for r in
             spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    html = {r[0]: r[2] or "" for r in PAGES}
    at = {(name, offset): (head, block) for name, data in files.items() for offset, head, block in warc.records(data)}
    for r in index:
        head, block = at[(r["archive"], r["offset"])]
        assert head["WARC-Type"] == r["record_type"]
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert block.partition(b"\r\n\r\n")[2].decode() == html[r["page_id"]]


def test_hot_payload_is_dealt_over_salts(spark):
    """Roles without a broadcast, where one payload is most of the rows."""
    from claimweave.settings import session_conf
    pages = [(k if k % 50 else None, f"http://h.example/{k}", "same" if k % 4 else f"p{k % 12}", "", 0, "", 0) for k in range(600)]
    pages.append(pages[1])
    again = spark.createDataFrame([("hot", 0, 450), ("cold", 1, 50)], "digest string, first_id int, n long")
    assert warc._salts(again)["hot"] > 1 and set(warc._salts(again)) <= {"hot", "cold"}
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        got = warc.captures(table(spark, pages)).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute(pages)


def test_small_payloads_stay_responses(spark):
    got = warc.archive_and_index(table(spark), least_bytes=11).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 11} == {"response"}


def test_damaged_archive_is_an_error():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, _, b in warc.records(good * 2)] == [b"abc"] * 2
    for bad in (good[:-6], good + b"x" * 20, b"nothing"):
        with pytest.raises(ValueError):
            list(warc.records(bad))


def test_loser_tree_merges():
    rng = random.Random(5)
    for k in (0, 1, 2, 3, 5, 8, 13):
        row = lambda: (rng.choice("abc"), rng.randrange(5), rng.choice([None, 1, 2]), "", "", None, 0, "", "f", rng.randrange(9))
        runs = [sorted((row() for _ in range(rng.randrange(12))), key=warc._order) for _ in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert [warc._order(r) for r in merged] == sorted(warc._order(r) for run in runs for r in run)


def test_digest_and_key(spark):
    df = spark.createDataFrame([("http://www.Example.com/Path?x#y", "abc")], "url string, html string")
    r = warc.with_url_key(df).select("url_key", warc.payload_digest(F.col("html")).alias("d")).first()
    assert (r["url_key"], r["d"]) == ("com,example,www)/path?x", digest("abc"))


def test_merge_over_many_ranges(spark):
    index = warc.archive_and_index(table(spark, [(k, f"http://h{k % 3}.example/{k % 7}", f"p{k % 11}", "", 0, "", 0) for k in range(200)]))
    again = warc.capture_history(index.drop("position"), merge_rows=17)
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, again.collect()))


def test_query_equals_oracle(spark):
    from oracle_compare import compare, duck

    from claimweave.llm.queries import ORACLE_SQL, QUERIES
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op4_warc_index_merge"](spark, sf).toArrow()
    assert compare(got, duck(sf).sql(ORACLE_SQL["op4_warc_index_merge"]).to_arrow_table()) == []
