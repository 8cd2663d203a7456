"""op13: archives written, read back, and read by plain zstandard; odd pages."""

import base64
import glob
import hashlib
import random
import struct

import pytest
import zstandard

from quayside.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, digest int"


def pages():
    rng = random.Random(6)
    words = ["<p>", "</p>", "<div class='x'>", "</div>", "one", "two", "é漢🙂", "\r\n\r\n", "\n"]
    out = [(k, f"http://h{k % 5}.example/{k}", "".join(rng.choices(words, k=rng.randint(1, 300))))
           for k in range(150)]
    out += [(200 + k, "http://copy.example/", out[9][2]) for k in range(60)]
    out += [(300, None, None), (301, "", ""), (302, "http://a\r\nWARC-Type: bad/", "x"),
            (303, "http://b/", "long " * 200_000), (304, "http://b/", "long " * 200_000),
            (None, "http://n/", out[9][2]), (None, "http://n/", "only here"),
            (None, "http://n/", "only here"), (305, "http://r/", "repeated"),
            (305, "http://r/", "repeated"), (306, "http://r/", "repeated")]
    rng.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "p", 1) for r in data], SCHEMA).repartition(5)


def expected(data, least=0):
    firsts = {}
    for page, _, html in data:
        if page is not None:
            firsts[html or ""] = min(firsts.get(html or "", page), page)
    rows = []
    for page, _, html in data:
        raw = (html or "").encode()
        first = firsts.get(html or "")
        later = first is not None and (page is None or page > first) and len(raw) >= least
        rows.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if later else "response", first if later else None))
    return sorted(rows, key=repr)


def test_op13_equals_brute_force(spark):
    got = warc.op13(spark, frame(spark, pages()))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(pages())


def test_payloads_urls_and_small_archives(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4_000)
    folder = f"{tmp_dir}/archives"
    warc.write_archive(frame(spark, pages()), folder, min_bytes=100)
    rows = warc.read_archive(spark, folder).collect()
    number = lambda x: None if x is None else int(x)
    got = [(number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
            number(r.refers_to)) for r in rows]
    assert sorted(got, key=repr) == expected(pages(), least=100)
    assert len(glob.glob(f"{folder}/*.warc.zst")) > 1
    by_id = {r.page_id: r for r in rows}
    for page, url, html in pages():
        r = by_id[None if page is None else str(page)]
        if page is not None and r.record_type == "response":
            assert r.payload == (html or "")
        if page not in (None, 302):
            assert r.url == url
    assert by_id["302"].url == "http://a%0D%0AWARC-Type: bad/"
    kinds = {(r.page_id, r.record_type) for r in rows}
    assert ("306", "response") in kinds and ("304", "revisit") in kinds  # one is short
    some = spark.createDataFrame([("303",), ("12",), ("304",), ("no",)], "page_id string")
    got = {r.page_id: r for r in warc.read_pages(spark, folder, some).collect()}
    assert {k: v.asDict() for k, v in got.items()} == {
        k: by_id[k].asDict() for k in ("303", "12", "304")}


def test_archives_begin_with_a_dictionary_and_hold_a_frame_a_record(spark, tmp_dir):
    folder = f"{tmp_dir}/archives"
    warc.write_archive(frame(spark, pages()), folder)
    n = 0
    for path in glob.glob(f"{folder}/*.warc.zst"):
        raw = open(path, "rb").read()
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D
        data = raw[8:8 + size]
        kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == b"\x37\xa4\x30\xec" \
            else zstandard.DICT_TYPE_RAWCONTENT
        rest = raw[8 + size:]
        unpack = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind))
        texts = []
        while rest:
            frame_ = unpack.decompressobj()
            texts.append(frame_.decompress(rest))
            rest = frame_.unused_data
        assert all(t.startswith(b"WARC/1.1\r\n") and t.endswith(b"\r\n\r\n") for t in texts)
        assert b"WARC-Type: warcinfo" in texts[0]
        n += len(texts) - 1
    assert n == len(pages())


def test_a_dictionary_makes_records_smaller():
    records = [warc.record(str(k), f"http://h/{k}", (f"<html><body class='page'><p>{k}" * 9).encode(),
                           None, warc.DATE) for k in range(400)]
    trained = warc.dictionary(records)
    assert trained.as_bytes()[:4] == warc.TRAINED_MAGIC
    small = zstandard.ZstdCompressor(dict_data=trained)
    plain = zstandard.ZstdCompressor()
    assert sum(len(small.compress(r)) for r in records) \
        < 0.6 * sum(len(plain.compress(r)) for r in records)
    assert warc.dictionary(records[:1]).as_bytes()


def test_damage_is_found():
    raw = warc.record("1", "http://h/", b"payload", None, warc.DATE)
    assert warc.parsed(raw)[4] == b"payload"
    for bad in (raw.replace(b"payload", b"pAyload"), raw[:-1], raw.replace(b"1.1", b"0.9", 1)):
        with pytest.raises(ValueError):
            warc.parsed(bad)


def test_empty_table(spark):
    assert warc.op13(spark, frame(spark, [])).collect() == []
