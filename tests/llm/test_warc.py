import base64
import gzip
import hashlib
import os
import random
import re

import pytest

from runledger.llm import warc
from runledger.sources.logs import scratch_path

PAGES = "page_id long, url string, html string"


def expect(rows, least=0):
    top = {}
    for i, _, html in rows:
        top.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = max((x for x in top[html or ""] if x is not None), default=None)
        same = len(data) < least or i == first or len(top[html or ""]) < 2
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if same else "revisit", None if same else first))
    return sorted(out, key=str)


def roundtrip(spark, rows, schema=PAGES, **kw):
    path = scratch_path(spark, "warc")
    warc.write_pages(spark.createDataFrame(rows, schema), path, **kw)
    return path, warc.read_archives(spark, path, with_payload=True)


def digests(got):
    r = got.where("record_type IN ('response', 'revisit')").select(warc.page_id("record_id"), "payload_bytes", "payload_digest", "record_type", warc.page_id("refers_to"))
    return sorted((tuple(x) for x in r.collect()), key=str)


def files(path):
    root = path.replace("file:", "")
    return sorted(os.path.join(root, f) for f in os.listdir(root) if f.startswith("part-"))


def test_pages_of_all_kinds(spark, monkeypatch):
    """Nulls, empty and very long pages, bytes of every kind, equal payloads, repeated rows, odd urls; many small archives."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    r = random.Random(1)
    rows = [(i, f"http://a.example/{i}", f"<p>{'x' * r.randint(0, 900)} é\r\n\r\nWARC/1.1\r\n{i % 7}</p>") for i in range(60)]
    rows += [(i, f"http://b.example/{i}", "<html>same</html>") for i in range(100, 160)]
    rows += [(200, None, None), (201, "", ""), (None, "http://c", "<html>same</html>"), (None, "http://d", "alone"), (None, "http://d2", "alone"),
             (159, "http://again", "<html>same</html>"), (-5, "http://e/ x\r\nWARC-Type: fake", "\x00\x1f\x8b\x08" * 3), (202, "u", "ü" * 2_000_000)]
    path, got = roundtrip(spark, rows)
    got = got.cache()
    assert digests(got) == expect(rows)
    assert got.where("kind = 'gap'").count() == 0
    bodies = {x.record_id: bytes(x.payload) for x in got.where("record_type = 'response'").collect()}
    assert sorted(bodies.values()) == sorted({(h or "").encode() for _, _, h in rows})
    assert {x.refers_to for x in got.where("record_type = 'revisit'").collect()} <= set(bodies)  # each goes to a record that is there
    assert len(files(path)) > 5
    for f in files(path):  # plain gzip members, no byte between or after them
        data = gzip.decompress(open(f, "rb").read())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def test_small_payloads_are_no_revisits_and_extra_columns_do_not_clash(spark):
    rows = [(i, "u", h) for i, h in enumerate(["aaaa", "aaaa", "aaaaaaaa", "aaaaaaaa", "", ""])]
    _, got = roundtrip(spark, rows, min_revisit=8)
    assert digests(got) == expect(rows, 8)
    path = scratch_path(spark, "warc")
    warc.write_pages(spark.createDataFrame([(*x, 1, "p", True) for x in rows], PAGES + ", id int, payload string, first boolean"), path)
    assert digests(warc.read_archives(spark, path)) == expect(rows)


def test_empty_table(spark):
    path, got = roundtrip(spark, [])
    assert got.count() == 0


def archive(n, seed, plain=False):
    """n records with their offsets, as gzip members or plain."""
    r = random.Random(seed)
    out, at, size = [], [], 0
    for i in range(n):
        body = bytes(r.randrange(256) for _ in range(r.randint(0, 400))) if i % 3 else ("text WARC/1.1\r\n" * r.randint(0, 9)).encode()
        rec = warc.page_record(i, f"http://x/{i}", body, None, False, "1970-01-01T00:00:00Z")
        out.append(rec if plain else warc.member(rec))
        at.append((size, len(out[-1])))
        size += len(out[-1])
    return b"".join(out), at


def check_cover(buf, got):
    """Records and gaps follow one another without overlap and cover the file."""
    place = 0
    for _, at, n, *_ in got:
        assert at == place and n > 0
        place += n
    assert place == len(buf)


@pytest.mark.parametrize("plain", [False, True])
def test_damage_costs_only_the_records_it_touches(plain):
    """Flipped, removed, inserted and cut bytes anywhere: every record that is still whole comes back."""
    for seed in range(60):
        r = random.Random(seed)
        buf, at = archive(12, seed, plain)
        kind, place = seed % 4, r.randrange(len(buf))
        n = r.randint(1, 60)
        if kind == 0:
            bad = buf[:place] + bytes(b ^ (1 + r.randrange(255)) for b in buf[place:place + n]) + buf[place + n:]
            touched = [place < a + s and a < place + n for a, s in at]
        elif kind == 1:
            bad, touched = buf[:place] + buf[place + n:], [place < a + s and a < place + n for a, s in at]
        elif kind == 2:
            bad = buf[:place] + bytes(r.randrange(256) for _ in range(n)) + buf[place:]
            touched = [a < place < a + s for a, s in at]
        else:
            bad, touched = buf[:place], [place < a + s for a, s in at]
        got = list(warc.salvage(bad))
        check_cover(bad, got)
        names = [re.match(r"<urn:page:(\d+)", x[3]["warc-record-id"]) for x in got if x[0] == "record"]
        ids = [int(m[1]) for m in names if m]
        whole = [i for i, t in enumerate(touched) if not t]
        assert set(whole) <= set(ids)
        if plain:  # a plain header's values have no checksum, its block has
            assert all(hashlib.sha1(x[4]).digest() == base64.b32decode(x[3].get("warc-block-digest", "sha1:" + warc.digest(x[4]))[5:]) for x in got if x[0] == "record")
        else:  # a member's checksum tells every damage
            assert ids == whole and len(names) == len(ids)


def test_gaps_say_why(spark):
    good = warc.page_record(1, "u", b"body", None, False, "1970-01-01T00:00:00Z")
    later = warc.page_record(2, "u", b"other", None, False, "1970-01-01T00:00:00Z")
    cases = [(b"junk", "no version line"), (b"WARC/1.1\r\nContent-Length: 5", "header field repeated"),
             (b"WARC/1.1\r\nno colon here\r\n\r\n", "header line without colon"), (b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n", "mandatory field missing"),
             (good.replace(b"body", b"bodY"), "block digest differs"), (warc.member(good + later), "member holds more than a record"),
             (warc.member(b"no record"), "no version line"), (re.sub(rb"Content-Length: \d+(?=\r\n\r\nHTTP)", b"Content-Length: 7", good), "record end not where its length says"),
             (re.sub(rb"Content-Length: \d+(?=\r\n\r\nHTTP)", b"Content-Length: x", good), "content length is no number"),
             (warc.member(good)[:30] + b"\x00" * 30, "member does not decompress")]
    for bad, why in cases:
        got = list(warc.salvage(good + bad + later))
        check_cover(good + bad + later, got)
        assert [(x[0], x[1]) for x in got] == [("record", 0), ("gap", len(good)), ("record", len(good + bad))], why
        assert got[1][3] == why
    assert [x[3] for x in warc.salvage(warc.member(good)[:-9])] == ["member is cut off"]
    path = scratch_path(spark, "damaged")
    root = path.replace("file:", "")
    os.makedirs(root)
    member = [warc.member(x) for x in (good, later)]
    open(os.path.join(root, "a.warc.gz"), "wb").write(member[0][:20] + member[0][25:] + member[1])
    open(os.path.join(root, "b.warc"), "wb").write(good + b"\xff" * 50 + later)
    open(os.path.join(root, "empty.warc"), "wb").close()
    got = warc.read_archives(spark, path).select("file", "kind", "offset", "length", "payload_bytes", "reason").collect()
    seen = {(os.path.basename(x.file), x.kind, x.offset, x.length, x.payload_bytes) for x in got}
    cut = len(member[0]) - 5
    assert seen == {("a.warc.gz", "gap", 0, cut, None), ("a.warc.gz", "record", cut, len(member[1]), 5),
                    ("b.warc", "record", 0, len(good), 4), ("b.warc", "gap", len(good), 50, None), ("b.warc", "record", len(good) + 50, len(later), 5)}
    assert {x.reason for x in got if x.kind == "gap"} == {"member does not decompress", "no version line"}


def test_a_damaged_response_leaves_its_revisits(spark):
    rows = [(1, "u", "copy"), (2, "u", "copy"), (3, "u", "other")]
    path, _ = roundtrip(spark, rows)
    hit = next(f for f in files(path) if b"copy" in gzip.decompress(open(f, "rb").read()))
    data = open(hit, "rb").read()
    offset = next(x[1] for x in warc.salvage(data) if x[0] == "record" and warc.payload_of(x[3], x[4]) == b"copy")
    open(hit, "wb").write(data[:offset + 12] + bytes([data[offset + 12] ^ 255]) + data[offset + 13:])
    crc = os.path.join(os.path.dirname(hit), f".{os.path.basename(hit)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    got = warc.read_archives(spark, path)
    assert digests(got) == sorted([x for x in expect(rows) if x[0] != 2], key=str)
    assert got.where("kind = 'gap'").count() == 1
