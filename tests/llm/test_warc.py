import gzip

import pytest

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import shared, warc  # noqa: E402


def brute(rows):
    by = {}
    for i, _, html in rows:
        by.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        best = max((x for x in by[html or ""] if x is not None), default=None)
        data = (html or "").encode()
        out.append((i, len(data), warc.base32_sha1(data), "response" if i == best else "revisit", None if i == best else best))
    return out


def check(spark, rows, range_bytes):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = warc.write_warc(spark, pages.selectExpr("*", "1 AS digest", "2 AS keeper"), shared.new_path(spark, "test-warc"))
    got = [tuple(r) for r in warc.read_warc(spark, files, range_bytes).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("range_bytes", [64, 1000, 8 << 20])
def test_round_trip(spark, range_bytes):
    nested = gzip.compress(warc.make_record(9, None, b"inner", False, None, "d")).decode("latin-1")
    rows = [(i, f"http://x/{i} \r\né", f"<p>{i % 7}</p>\r\n\r\n" * (i % 5)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "u", "<p>1</p>"), (None, None, "only null"), (102, "u", nested * 3), (103, "u", "x" * 600_000), (103, "u", "x" * 600_000)]
    check(spark, rows, range_bytes)


def test_empty_table(spark):
    check(spark, [], 100)


def test_false_magic_inside_a_member_is_skipped(spark):
    import zlib

    raw = warc.make_record(1, "u", b"p" * 50 + warc.gzip_member(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n") + b"tail" * 9, False, None, "d")
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the inner member is visible
    data = packer.compress(raw) + packer.flush() + warc.gzip_member(warc.make_record(2, "u", b"q", False, None, "d"))
    for range_bytes in (7, 20, 61, 150, 10_000):
        assert read_ids(spark, data, range_bytes) == [1, 2]


def damaged(spark, change, range_bytes=100, skip=True):
    """Ids that are read, and lost bytes, of an archive of six records whose list of members is changed."""
    parts = [warc.gzip_member(warc.make_record(i, f"u{i}", f"payload {i} ".encode() * 40, False, None, "d")) for i in range(6)]
    data = b"".join(change(parts))
    path = shared.new_path(spark, "test-damage") + "/a.warc.gz"
    with shared.publish(path) as f:
        f.write(data)
    files = spark.createDataFrame([(path, len(data))], "uri string, size long")
    if not skip:
        return warc.read_warc(spark, files, range_bytes)
    records = warc.read_records(spark, files, range_bytes)
    lost = [r["lost_bytes"] for r in warc.damage(files, records).collect()]
    ids = sorted(r["page_id"] for r in warc.read_warc(spark, files, range_bytes, "skip").collect())
    return ids, sum(lost), [len(p) for p in parts]


@pytest.mark.parametrize("range_bytes", [50, 1 << 20])
def test_damage_loses_no_intact_record(spark, range_bytes):
    magic = lambda p: [*p[:2], b"\0" + p[2][1:], *p[3:]]
    ids, lost, sizes = damaged(spark, magic, range_bytes)
    assert ids == [0, 1, 3, 4, 5] and lost == sizes[2]
    ids, lost, _ = damaged(spark, lambda p: [*p[:3], b"\0\0", *p[3:]], range_bytes)  # padding
    assert ids == [0, 1, 2, 3, 4, 5] and lost == 2
    ids, lost, sizes = damaged(spark, lambda p: [*p[:5], p[5][:-9]], range_bytes)  # cut
    assert ids == [0, 1, 2, 3, 4] and lost == sizes[5] - 9
    ids, lost, sizes = damaged(spark, lambda p: [p[0], p[1][:40] + b"~~~" + p[1][43:], *p[2:]], range_bytes)  # a byte within
    assert ids == [0, 2, 3, 4, 5] and lost == sizes[1]
    ids, lost, _ = damaged(spark, lambda p: [b"junk \x1f\x8b\x08 junk", *p, b"\x1f\x8b\x08"], range_bytes)
    assert ids == [0, 1, 2, 3, 4, 5] and lost == 16


def test_damage_raises_unless_skipped(spark):
    with pytest.raises(ValueError, match="no intact record"):
        damaged(spark, lambda p: p[:3] + [b"x"] + p[3:], skip=False)
    assert damaged(spark, lambda p: p, skip=False).count() == 6
    with pytest.raises(ValueError):
        warc.read_warc(spark, None, on_damage="ignore")


def test_foreign_and_wrong_records_are_damage(spark):
    wrong = warc.gzip_member(warc.make_record(7, "u", b"abc", False, None, "d").replace(b"abc\r\n", b"abd\r\n"))
    info = warc.gzip_member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")
    ids, lost, _ = damaged(spark, lambda p: [info, *p, wrong])
    assert ids == [0, 1, 2, 3, 4, 5] and lost == len(info) + len(wrong)


def test_a_record_within_a_payload_is_not_read(spark):
    import zlib

    inner = warc.gzip_member(warc.make_record(50, "u", b"in", False, None, "d"))
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = warc.gzip_member(warc.make_record(1, "u", b"a", False, None, "d"))
    data += packer.compress(warc.make_record(2, "u", b"b" * 30 + inner + inner + b"c" * 30, False, None, "d")) + packer.flush()
    data += warc.gzip_member(warc.make_record(3, "u", b"d", False, None, "d"))
    for range_bytes in (7, 20, 61, 200, 450, 10_000):
        assert read_ids(spark, data, range_bytes) == [1, 2, 3]


def read_ids(spark, data, range_bytes):
    path = shared.new_path(spark, "test-nested") + "/a.warc.gz"
    with shared.publish(path) as f:
        f.write(data)
    files = spark.createDataFrame([(path, len(data))], "uri string, size long")
    return sorted(r["page_id"] for r in warc.read_warc(spark, files, range_bytes).collect())


def test_records_far_inside_a_long_payload(spark):
    import os
    import zlib

    inner = b"".join(warc.gzip_member(warc.make_record(i, "u", b"in", False, None, "d")) for i in (50, 51))
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = warc.gzip_member(warc.make_record(1, "u", b"a", False, None, "d"))
    data += packer.compress(warc.make_record(2, "u", os.urandom(66 << 20) + inner + b"c" * (1 << 20), False, None, "d")) + packer.flush()
    data += warc.gzip_member(warc.make_record(3, "u", b"d", False, None, "d"))
    assert read_ids(spark, data, 8 << 20) == [1, 2, 3]


def test_records_inside_a_foreign_member(spark):
    import zlib

    inner = warc.gzip_member(warc.make_record(50, "u", b"in", False, None, "d"))
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = packer.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner) + packer.flush()
    path = shared.new_path(spark, "test-nested") + "/b.warc.gz"
    with shared.publish(path) as f:
        f.write(data)
    files = spark.createDataFrame([(path, len(data))], "uri string, size long")
    assert warc.read_warc(spark, files, 40, "skip").count() == 0
