"""op8 against the public library, and the way back."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken

from quayside.llm import bpe
from quayside.llm.catalog import BPE_RANKS

PATH = P.path(BPE_RANKS)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    out = ["", "a", "  \n\n x", "aaaa" * 200, "ab" * 3000, "漢字かな交じり文🙂👩‍👩‍👧", " " * 500 + "x",
           "\x1c\x85  z", "١٢٣ ½", "<|endoftext|>", "x" * 70_000]
    out += ["".join(rng.choice("abcdefghijéüñ漢🙂 \n\t'%&!0123") for _ in range(rng.randint(0, 600)))
            for _ in range(100)]
    return out + ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(250, 900)))
                  for _ in range(40)]


def test_ids_equal_the_library(library):
    ids, counts = bpe.ranks(PATH).encode(texts(), regex.compile(P.PATTERN))
    expected = [library.encode_ordinary(t) for t in texts()]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [y for x in expected for y in x]


def test_query_and_round_trip(spark, library):
    rows = [*enumerate(texts()), (None, None), (0, "same id"), (0, "same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "tokens", __import__("pyspark.sql.functions").sql.functions.lit(1))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for d, t in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        expected.append((d, len(ids), digest(ids.tobytes()), digest((t or "").encode())))
    got = bpe.op8(docs, PATH, P.PATTERN).collect()
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in got)
    encoded = bpe.encode(docs, PATH, P.PATTERN).select("doc_id", "text", "tokens.ids")
    back = bpe.decode(encoded, PATH).collect()
    assert all(bytes(r.decoded.bytes).decode() == (r.text or "") for r in back)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.op8(none, PATH, P.PATTERN).collect() == []
