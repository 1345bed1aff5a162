from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from keyweave.llm.warc import canonical_url, resolve_revisits

SCHEMA = ("record_id long, kind string, url string, date timestamp, status int, "
          "headers map<string,string>, payload_digest string, payload_length long, extra string")


def at(s: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)


def response(i, url, s, headers=None, status=200):
    return (i, "response", url, None if s is None else at(s), status, headers, f"d{i}", i, "x")


def revisit(i, url, s, headers=None):
    return (i, "revisit", url, None if s is None else at(s), 304, headers, None, None, "x")


def run(spark, rows, **kw):
    out = resolve_revisits(spark.createDataFrame(rows, SCHEMA), **kw)
    return {r.record_id: r for r in out.collect()}


def test_canonical_urls(spark):
    urls = ["http://WWW.Example.com:80/a/?b=2&a=1#top", "https://example.com/a?a=1&b=2&utm_source=x",
            "example.com/a/?ref=z&a=1&b=2", "https://example.com/A?a=1&b=2", None, ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(canonical_url(F.col("u"))).collect()]
    assert got[0] == got[1] == got[2] == "example.com/a?a=1&b=2"
    assert got[3] == "example.com/A?a=1&b=2" and got[4] is None and got[5] == ""


def test_latest_earlier_full_response_and_validators(spark):
    u = "http://e.com/p"
    rows = [response(1, u, 0, {"etag": '"a"', "content-type": "text/html", "date": "old"}),
            response(2, u, 10, {"etag": '"b"'}), response(3, u, 11, {"etag": '"c"'}, status=404),
            revisit(4, "https://www.e.com/p/#x", 5, {"etag": 'W/"a"', "date": "new",
                                                    "content-length": "0"}),
            revisit(5, u, 10, {"etag": '"a"'}),  # a response of the same time is not earlier
            revisit(6, u, 12, {"etag": '"a"'}), revisit(7, u, 12), revisit(8, "http://e.com/q", 9),
            revisit(9, None, 9), revisit(10, u, None),
            response(11, "http://m.com", 0, {"last-modified": "x"}),
            revisit(12, "http://m.com", 1, {"last-modified": "x"}),
            revisit(13, "http://m.com", 1, {"last-modified": "y"})]
    for chunks in (None, 1, 3, 40):
        got = run(spark, rows, chunks=chunks)
        assert {i: (r.outcome, r.source_id) for i, r in got.items()} == {
            4: ("resolved", 1), 5: ("resolved", 1), 6: ("changed", None), 7: ("unverified", 2),
            8: ("no response", None), 9: ("no response", None), 10: ("no response", None),
            12: ("resolved", 11), 13: ("changed", None)}
        assert got[4].headers == {"etag": 'W/"a"', "content-type": "text/html", "date": "new"}
        assert got[4].payload_digest == "d1" and got[4].payload_length == 1


def test_one_url_with_many_records_equals_a_scan(spark):
    rows = []
    for i in range(600):
        rows.append(response(2 * i, "http://hot.com/", 7 * i % 1000, {"etag": f'"{i}"'}))
        rows.append(revisit(2 * i + 1, "http://hot.com/", 11 * i % 1000))
    got = run(spark, rows, chunks=50)
    for r in rows:
        if r[1] == "revisit":
            before = [(x[3], x[0]) for x in rows if x[1] == "response" and x[3] < r[3]]
            assert got[r[0]].source_id == (max(before)[1] if before else None)


def test_empty_and_repeated(spark):
    assert run(spark, []) == {}
    rows = [response(1, "a.com", 0), response(1, "a.com", 0), revisit(2, "a.com", 1)]
    assert run(spark, rows)[2].source_id == 1


def test_repeated_records_give_one_row_each(spark):
    rows = []
    for i, times in ((1, 1), (3, 3), (5, 6)):
        rows += [response(i, f"r{i}.com", 0, {"etag": "x"}), revisit(i + 1, f"r{i}.com", 9)] * times
    out = resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.record_id, r.source_id, r.outcome) for r in out) == sorted(
        (i + 1, i, "unverified") for i, times in ((1, 1), (3, 3), (5, 6)) for _ in range(times))
    other = [response(7, "s.com", 0), (7, "response", "s.com", at(0), 200, None, "z", 9, "x"),
             revisit(8, "s.com", 1), revisit(8, "s.com", 1)]
    assert [r.payload_digest for r in resolve_revisits(
        spark.createDataFrame(other, SCHEMA)).collect()] == ["z", "z"]


def test_one_outlier_date_leaves_a_hot_url_in_many_chunks(spark, monkeypatch):
    from keyweave.llm import warc

    kept = {}
    real = warc.materialise
    monkeypatch.setattr(warc, "materialise",
                        lambda df, name: kept.setdefault(name, real(df, name)))
    rows = [response(i, "hot.com", 10**6 + i) if i % 2 else revisit(i, "hot.com", 10**6 + i)
            for i in range(4000)]
    rows.append(response(9999, "hot.com", -54 * 365 * 86400))  # 1970
    got = run(spark, rows, chunks=16)
    largest = kept["warc-moments"].groupBy("canonical_url", "chunk").count().agg(F.max("count"))
    assert largest.first()[0] < 4000 / 8
    assert got[2].source_id == 1 and got[0].source_id == 9999
