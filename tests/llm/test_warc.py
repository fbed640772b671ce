import hashlib

from shoplens.llm import warc

PAGES = "page_id long, url string, html string, digest string, kind int, payload string"


def _run(spark, rows, range_bytes=1 << 24, payloads=True):
    df = spark.createDataFrame([(*r, "d", 1, "p") for r in rows], PAGES).repartition(3)
    manifest = warc.write_archives(df)
    return manifest, warc.read_archives(manifest, range_bytes, payloads).collect()


def test_round_trip_and_revisits(spark):
    long = "<p>" + "same body " * 40
    rows = [(i, f"http://h/{i}", long) for i in (9, 4, 7)] + [(1, "http://x\r\ny", "short"), (2, "u", "short"), (3, None, None), (5, "é", "ü" * 50),
            (6, "e", ""), (None, "n", "only null id " * 20), (11, "big", "<b>x</b>" * 300_000)]
    rows += [(20, "r", long + "2"), (20, "r", long + "2"), (21, "r", long + "2")]
    _, got = _run(spark, rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert by[4][0].record_type == "response" and by[4][0].payload == long.encode()
    for i in (7, 9):
        r = by[i][0]
        assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", 4, b"")
    assert by[21][0].refers_to == 20 and all(r.record_type == "response" for r in by[20])
    assert by[1][0].record_type == by[2][0].record_type == "response"  # under 100 bytes
    assert by[5][0].payload_bytes == 100 and by[3][0].payload_bytes == by[6][0].payload_bytes == 0
    for i, _, html in rows:
        body = (html or "").encode()
        assert all((r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest()) for r in by[i])


def test_any_range_size_reads_each_record_once(spark):
    rows = [(i, "u", f"page {i} " * (i % 50 + 1)) for i in range(120)]
    manifest, _ = _run(spark, rows)
    for size in (97, 1000, 5000):
        got = [r.page_id for r in warc.read_archives(manifest, size, False).collect()]
        assert sorted(got) == list(range(120)), size


def test_magic_inside_payload_is_not_a_record(tmp_path):
    inner = warc.record(1, "u", "response", "0" * 64, 3, b"abc", None)
    import os

    noise = os.urandom(3000) + warc.MAGIC + os.urandom(500) + warc.MAGIC
    packed = [warc.record(k, "u", "response", "0" * 64, len(noise), noise, None) for k in (1, 2)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(packed[0] + packed[1] + inner)
    size = path.stat().st_size
    found = [raw for at in range(0, size, 700) for raw in warc.records_in(str(path), size, at, min(at + 700, size))]
    assert len(found) == 3


def test_empty_table(spark):
    assert _run(spark, [])[1] == []
