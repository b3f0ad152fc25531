import gzip
import hashlib
from pathlib import Path

from helpers import EXTRA
from pyspark.sql import functions as F

from blendwise.llm import warc
from blendwise.llm.common import new_path

BIG, HUGE = "<p>long ü</p>" * 100, "<div>" + "x y z " * 60_000 + "</div>"
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, "short"), (4, "http://a/4", "short"), (5, "u\r\nv", None),
         (6, "", ""), (9, "http://a/9", HUGE), (7, "http://a/7", HUGE), (9, "http://a/9", HUGE), (None, "n", BIG),
         (8, "w", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\x1f\u008b\x08")]


def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumns({k: F.lit(v) for k, v in (EXTRA | {"payload": 1, "winner": 2, "refers_to": 3}).items()})


def expected():
    out = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        win = max(same) if len(raw) >= 1000 and same else i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if win == i else "revisit", None if win == i else win))
    return sorted(out, key=str)


def test_round_trip(spark):
    path = new_path(spark, "warc-test")
    warc.write_archives(pages(spark).repartition(3), path)
    found = warc.read_archives(spark, path)
    assert sorted(map(tuple, warc.page_records(found).collect()), key=str) == expected()
    assert found.where("kind = 'gap'").count() == 0
    assert found.where("record_type = 'warcinfo'").count() >= 1
    payload = {r.record_id: bytes(r.payload) for r in found.where("record_type = 'response'").collect()}
    assert payload["urn:page:9"] == HUGE.encode() and payload["urn:page:5"] == b""
    for part in Path(path.removeprefix("file://")).glob("part-*"):
        gzip.decompress(part.read_bytes())  # a plain multi-member gzip file


def test_empty_table(spark):
    path = new_path(spark, "warc-test")
    warc.write_archives(pages(spark).limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def archive():
    digest = lambda b: hashlib.sha1(b).hexdigest()
    payloads = [b"first", b"second" * 500, b"third \x1f\x8b\x08 WARC/1.1 inside", b"", b"last"]
    return payloads, [warc.page_record(f"urn:page:{i}", f"http://x/{i}", p, digest(p)) for i, p in enumerate(payloads)]


def ids(items):
    return [x[3]["warc-record-id"] for x in items if x[0] == "record"]


def covered(items, empty, size):
    at = 0
    for x in sorted([*items, *empty], key=lambda x: x[1]):
        assert x[1] == at
        at += x[2]
    return at == size


def test_damage_loses_only_the_damaged_record():
    payloads, members = archive()
    data = b"".join(members)
    assert ids(list(warc.salvage(data))) == [f"<urn:page:{i}>" for i in range(5)]
    start = len(members[0])
    for at in range(start, start + len(members[1])):  # flip every byte of the second member in turn
        bad = bytearray(data)
        bad[at] ^= 0x55
        items = list(warc.salvage(bytes(bad)))
        assert covered(items, [], len(data))
        left = ids(items)
        assert left[0] == "<urn:page:0>" and left[-3:] == [f"<urn:page:{i}>" for i in (2, 3, 4)]
        if len(left) == 4:
            gaps = [x for x in items if x[0] == "gap"]
            assert sum(x[2] for x in gaps) == len(members[1])


def test_truncation_garbage_and_plain_records():
    payloads, members = archive()
    assert ids(list(warc.salvage(b"".join(members[:2])[:-5]))) == ["<urn:page:0>"]
    plain = [gzip.decompress(m) for m in members]
    mixed = b"junk" + plain[0] + members[1] + b"\x1f\x8b\x08broken" + plain[2] + warc.EMPTY_MEMBER + plain[4][:-3] + members[3]
    items = list(warc.salvage(mixed))
    assert ids(items) == ["<urn:page:0>", "<urn:page:1>", "<urn:page:2>", "<urn:page:3>"]
    assert [x[3] for x in items if x[0] == "gap"] == ["no record", "damaged member", "damaged record"]
    changed = plain[1].replace(b"second", b"sEcond", 1) + plain[4]  # the block digest no longer fits
    assert ids(list(warc.salvage(changed))) == ["<urn:page:4>"]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"\x00" * 50))[0][:3] == ("gap", 0, 50)


def test_gaps_of_files(spark, tmp_path):
    _, members = archive()
    bad = bytearray(b"".join(members))
    bad[len(members[0]) + 40] ^= 0xFF
    (tmp_path / "x.warc.gz").write_bytes(bytes(bad))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("offset").collect()
    gap = [r for r in rows if r.kind == "gap"]
    assert [(r.offset, r.length, r.reason) for r in gap] == [(len(members[0]), len(members[1]), "damaged member")]
    assert gap[0].file.endswith("x.warc.gz") and len(rows) == 5


def test_reading_grows_with_the_archive():
    import time

    def seconds(records):
        page = b"<html>" + bytes(range(256)) * 8 + b"</html>"
        members = [warc.page_record(f"urn:page:{i}", "http://x", page + str(i).encode(), hashlib.sha1(page).hexdigest()) for i in range(records)]
        data, best = b"".join(members), 1e9
        for _ in range(3):
            began = time.perf_counter()
            assert sum(item[0] == "record" for item in warc.salvage(data)) == records
            best = min(best, time.perf_counter() - began)
        return best

    seconds(200)
    assert seconds(4000) < 2 * 2.5 * seconds(2000)


def test_a_record_over_the_limit_says_so():
    big = warc.page_record("urn:page:1", "http://x", b"a" * 50_000, "00" * 20)
    small = warc.page_record("urn:page:2", "http://x", b"b", hashlib.sha1(b"b").hexdigest())
    items = list(warc.salvage(big + small, limit=10_000))
    assert [i[0] for i in items] == ["gap", "record"] and "more than 10000 bytes" in items[0][3]
    assert items[0][2] == len(big) and items[1][4] == b"b"
