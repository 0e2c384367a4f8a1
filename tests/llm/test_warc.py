import hashlib

from barforge.llm import warc
from barforge.session import scratch_path

BIG = "x" * 1500
ROWS = [(1, "http://a/1?q=%41", BIG), (2, "http://a/2", BIG), (9, "http://a/9", BIG), (9, "http://a/9", BIG), (3, None, None),
        (4, "bad\r\nurl: %41 ", "é" * 700), (5, "u", "short"), (6, "u", "short"), (None, "n", BIG), (7, "", ""),
        (8, "u", "y" * 3_000_000), (10, "u", "y" * 3_000_000), (-5, "z", "a\r\n\r\nb" * 300)]


def _pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "page_id long, url string, html string, shard int, digest string")


def _write(spark, rows, **options):
    out = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(_pages(spark, rows), out, "page_id", "url", "html", **options)
    return out, manifest


def test_round_trip(spark):
    out, manifest = _write(spark, ROWS, shard_bytes=1000, file_bytes=4000)
    got = warc.read_warc(manifest, out, with_payload=True).collect()
    assert len(got) == len(ROWS)
    kept = {}
    for i, _, html in ROWS:
        if len((html or "").encode()) >= 1000 and i is not None:
            kept[html] = max(i, kept.get(html, i))
    assert sorted((r.id is None, r.id or 0, r.url or "") for r in got) == sorted((i is None, i or 0, u or "") for i, u, _ in ROWS)
    by_id = {i: (u, h or "") for i, u, h in ROWS}
    responses = set()
    for r in got:
        url, html = by_id[r.id]
        body = html.encode()
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(body), hashlib.sha1(body).hexdigest())
        revisit = html in kept and (kept[html] != r.id or r.id in responses)
        if r.record_type == "response":
            assert r.refers_to is None and bytes(r.payload) == body
            responses.add(r.id)
        else:
            assert revisit or r.id == 9
            assert r.refers_to == kept[html]
    types = sorted((r.id or 0, r.record_type) for r in got if r.id in (1, 2, 9, None))
    assert types == [(0, "revisit"), (1, "revisit"), (2, "revisit"), (9, "response"), (9, "revisit")]
    assert manifest.where("records > 1").count() + manifest.count() > 4


def test_same_rows_give_same_files(spark):
    first = _write(spark, ROWS, shard_bytes=2000, file_bytes=3000)[1]
    again = _write(spark, ROWS[::-1], shard_bytes=2000, file_bytes=3000)[1]
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_empty_table(spark):
    out, manifest = _write(spark, [])
    assert manifest.count() == 0 and warc.read_warc(manifest, out).count() == 0
