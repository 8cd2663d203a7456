"""op9: files written and read back against the public library, and random access."""

import io
import json
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quayside.llm import frames
from quayside.llm.catalog import WORD_BPE

PATH = P.path(WORD_BPE)
SCHEMA = "doc_id long, text string, start int"


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def rows():
    rng = random.Random(2)
    texts = ["", None, "a", " ̈x", "e ́a", "a\x1cb\x85c d", "İstanbul ΑΣ ΑΣ. ſK", "\x01 a \x01b",
             "<|endoftext|> x<|startoftext|>", "漢字 🙂 ½²", "it's 'S 'RE", "word " * 30_000]
    texts += ["".join(rng.choice("abcDEFéüñ漢🙂 \n\t'%&!0123́ \x1f sSlL,.")
                      for _ in range(rng.randint(0, 200))) for _ in range(150)]
    keys = rng.sample(range(-500, 500), len(texts))
    return [(k, t, 7) for k, t in zip(keys, texts)] + [(None, "no id", 7), (9_000, "b", 7),
                                                       (9_000, "b", 7)]


def test_files_hold_the_library_ids_in_order(spark, library):
    got = frames.op9(spark, spark.createDataFrame(rows(), SCHEMA).repartition(5), PATH).collect()
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    start, expected = 0, []
    for key, text, _ in ordered:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in got)


@pytest.mark.parametrize("change", [
    lambda said: said["normalizer"]["normalizers"].pop(),  # letters keep their case
    lambda said: said["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True),
    lambda said: said.update(truncation={"direction": "Right", "max_length": 9, "stride": 0,
                                         "strategy": "LongestFirst"})])
def test_another_file_is_encoded_by_whole_texts(spark, tmp_dir, change):
    with open(PATH, encoding="utf-8") as file:
        said = json.load(file)
    change(said)
    other = f"{tmp_dir}/other.json"
    with open(other, "w", encoding="utf-8") as file:
        json.dump(said, file)
    library = Tokenizer.from_file(other)
    library.encode_special_tokens = True
    texts = [(k, t) for k, (_, t, _) in enumerate(rows())]
    got = {r.doc_id: r.ids for r in _ids(spark, texts, other, tmp_dir).collect()}
    assert got == {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2],
                               "<u4").tobytes() for k, t in texts}
    assert isinstance(frames.tokenizer(other), frames.LibraryTexts)
    assert not isinstance(frames.tokenizer(PATH), frames.LibraryTexts)


def _ids(spark, texts, path, folder):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    frames.write_tokens(docs, f"{folder}/ids", path, 2)
    return frames.read_tokens(spark, f"{folder}/ids")


def test_reads_only_wanted_documents(spark, tmp_dir):
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(300)],
                                 "doc_id long, text string")
    frames.write_tokens(docs, tmp_dir + "/t", PATH, 2)
    everything = {r.doc_id: (r.start, r.ids) for r in frames.read_tokens(
        spark, tmp_dir + "/t").collect()}
    some = {r.doc_id: (r.start, r.ids) for r in frames.read_tokens(
        spark, tmp_dir + "/t", [5, 250, 999]).collect()}
    assert some == {k: everything[k] for k in (5, 250)} and len(everything) == 300


def test_frames_are_independent_and_checked(monkeypatch):
    monkeypatch.setattr(frames, "FRAME_IDS", 10)
    out = io.BytesIO()
    writer = frames.FrameWriter(out)
    for k in range(40):
        writer.add(k, np.arange(k % 7, dtype=np.int32))
    writer.close()
    raw = out.getvalue()
    reader = frames.FrameReader(io.BytesIO(raw), len(raw))
    opened = []
    inner = reader.frame
    reader.frame = lambda k: opened.append(k) or inner(k)
    assert [(i, x.tolist()) for i, x in reader.documents({13, 14})] == [
        (13, list(range(6))), (14, [])]
    assert len(opened) <= 2 < len(reader.table) - 1
    damaged = bytearray(raw)
    damaged[int(reader.places[1]) + 9] ^= 0xFF
    broken = frames.FrameReader(io.BytesIO(bytes(damaged)), len(raw))
    with pytest.raises(Exception):
        broken.frame(1)
    assert broken.frame(0).tolist() == inner(0).tolist()


def test_empty_table(spark):
    assert frames.op9(spark, spark.createDataFrame([], SCHEMA), PATH).collect() == []
