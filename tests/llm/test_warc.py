import base64
import glob
import gzip
import hashlib
import random

from clauseloom.llm import warc
from clauseloom.session import new_folder

PAGES = "page_id long, url string, html string, digest string, size int"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_rows():
    pick = random.Random(1)
    bodies = ["", "a", "<p>é</p>\r\n\r\nWARC/1.1\r\n\r\n", "x" * 5000, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"] + [f"<html>{k}\0\n</html>" for k in range(20)]
    rows = [(i, f"http://h{i % 7}.org/ä b\r\n{i}", pick.choice(bodies[:8] if i % 2 else bodies), "clash", 1) for i in range(200)]
    rows += [(1000 + i, None, "the same page", "clash", 2) for i in range(400)]  # more than a thousandth: a heavy digest
    rows += [(2000, "u", None, None, None), (2001, None, "long " * 4_000_000, None, None), (3000, "u", "long " * 4_000_000, None, None)]
    return [*rows, (None, "u", "the same page", None, None), (None, "u", "only without id", None, None), (5, rows[5][1], rows[5][2], None, None)]


def expected(rows, min_bytes=0):
    first = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if i is not None:
            first[body] = min(i, first.get(body, i))
    out = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        original = first.get(body)
        late = len(body) >= min_bytes and original is not None and (i is None or i > original)
        out.append((i, len(body), digest(body), "revisit" if late else "response", original if late else None))
    return sorted(out, key=str)


def test_archives_come_back(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    for min_bytes in (0, 100):
        path = new_folder(spark, "warc")
        warc.write_archives(warc.page_records(pages), path, min_bytes)
        read = warc.read_archives(spark, path)
        found = warc.resolved(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, found), key=str) == expected(rows, min_bytes)
        payloads = {digest((html or "").encode()): (html or "").encode() for _, _, html, *_ in rows}
        stored = read.where("record_type = 'response'").select("payload_digest", "payload").collect()
        assert all(bytes(r.payload) == payloads[r.payload_digest] for r in stored)
        if not min_bytes:  # each payload once, but for rows that repeat an id
            assert len(stored) == len(payloads) + 1
        urls = {r.page_id: r.url for r in read.select("page_id", "url").collect()}
        assert urls[3] == "http://h3.org/ä%20b%0D%0A3" and urls[2001] is None


def test_files_are_plain_archives(spark):
    """Every file is a series of gzip members, each a record, as any gzip reader sees it."""
    path = new_folder(spark, "warc")
    warc.write_archives(warc.page_records(spark.createDataFrame(page_rows(), PAGES)), path)
    n = 0
    for name in glob.glob(f"{path}/part-*"):
        whole = gzip.open(name).read()
        at = 0
        while at < len(whole):
            head = whole[at:whole.index(b"\r\n\r\n", at)]
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            at += len(head) + 4 + int(fields["Content-Length"]) + 4
            assert whole[at - 4:at] == b"\r\n\r\n" and fields["WARC-Type"] in ("response", "revisit")
            assert (fields["WARC-Type"] == "revisit") == ("WARC-Profile" in fields)
            n += 1
    assert n == len(page_rows())
    data = warc.member(b"z" * (20 << 20)) + b"\0"
    assert gzip.decompress(data) == b"z" * (20 << 20) == next(warc.members(data))


def test_archives_are_merged(spark):
    """Revisits that were read are joined to the responses of other archives; those without one stay."""
    first, second, both = (new_folder(spark, "warc") for _ in range(3))
    a = [(1, "u1", "one", None, None), (2, "u2", "one", None, None), (3, "u3", "two", None, None)]
    b = [(0, "u0", "two", None, None), (7, "u7", "three", None, None), (8, "u8", "one", None, None)]
    warc.write_archives(warc.page_records(spark.createDataFrame(a, PAGES)), first)
    warc.write_archives(warc.page_records(spark.createDataFrame(b, PAGES)), second)
    lost = spark.createDataFrame([(9, "u9", "revisit", 77, "NOWHERE", 5, None)], warc.RECORDS)
    records = warc.read_archives(spark, first).unionByName(warc.read_archives(spark, second)).unionByName(lost)
    warc.write_archives(records, both)
    found = warc.resolved(warc.read_archives(spark, both))
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in found.collect()}
    assert got == {0: ("response", None, 3), 1: ("response", None, 3), 2: ("revisit", 1, 3), 3: ("revisit", 0, 3), 7: ("response", None, 5),
                   8: ("revisit", 1, 3), 9: ("revisit", 77, None)}


def test_no_pages(spark):
    path = new_folder(spark, "warc")
    warc.write_archives(warc.page_records(spark.createDataFrame([], PAGES)), path)
    assert warc.resolved(warc.read_archives(spark, path)).count() == 0
