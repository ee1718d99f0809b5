import base64
import hashlib
import random
import re
import struct

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from rankfold.llm import byte_bpe, registry
from rankfold.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def merges():
    with open(RANKS, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def plain(text, merges):
    """BPE by its definition: in each match, join the neighbours of lowest rank until none is left."""
    out = []
    for match in regex.findall(PATTERN, text or ""):
        tokens = [bytes([b]) for b in match.encode()]
        while True:
            ranked = [(merges[x + y], i) for i, (x, y) in enumerate(zip(tokens, tokens[1:])) if x + y in merges]
            if not ranked:
                break
            i = min(ranked)[1]
            tokens[i:i + 2] = [tokens[i] + tokens[i + 1]]
        out += [merges[t] for t in tokens]
    return out


def test_whole_table_equals_brute_force(spark, merges):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = registry.op11_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    known = {}
    for r in rows:
        ids = []
        for m in regex.findall(PATTERN, texts[r.doc_id] or ""):
            if m not in known:
                known[m] = plain(m, merges)
            ids += known[m]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_cuts_are_safe():
    """Any text cut into small parts gives the matches of the whole text."""
    rng, alphabet = random.Random(5), ["a", "b'", "'s", "'ll", "1", "?", " ", "  ", "\n", "\t", "　", "\xa0", "é", "漢", "\x1c", "́"]
    runs = re.compile(f"[{byte_bpe.WHITE}]{{3,}}")
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 30)))
        got, joined = [], ""
        for single, part in byte_bpe.parts(text, size=rng.randint(1, 6), runs=runs):
            joined += part
            got += [part] if single else regex.findall(PATTERN, part)
        assert joined == text and got == regex.findall(PATTERN, text), text


def test_very_long_texts(merges):
    coder = byte_bpe.Coder(RANKS, PATTERN)
    word = ("river stones, 12 of them; it's " * 60_000)[:1_500_000]
    for text in (word, " " * 2_000_000 + "x", "x" + "\n" * 2_000_000, "a" * 300_000, "漢字" * 100_000):
        assert coder.decode(coder.encode(text)) == text.encode()
    assert coder.encode(word[:300_000]) == struct.pack(f"<{len(w := plain_cached(word[:300_000], merges))}I", *w)
    # the white space up to the last character is one match, the last one belongs to the word
    blank = coder.encode(" " * 19_999) + coder.encode(" x")
    assert coder.encode(" " * 20_000 + "x") == blank


def plain_cached(text, merges, known={}):
    out = []
    for m in regex.findall(PATTERN, text):
        if m not in known:
            known[m] = plain(m, merges)
        out += known[m]
    return out


def test_odd_rows(spark, odd_docs, no_docs):
    coded = byte_bpe.encode(odd_docs.withColumn("ids", F.lit("clash")).withColumn("bytes", F.lit(1)), RANKS, PATTERN)
    assert coded.columns == ["doc_id", "ids"]
    back = byte_bpe.decode(coded, RANKS, PATTERN).select("doc_id", F.col("bytes").cast("string").alias("t"))
    assert sorted((str(r.doc_id), r.t) for r in back.collect()) == sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    rows = byte_bpe.round_trip(odd_docs, RANKS, PATTERN).collect()
    assert len(rows) == 10 and {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {0}
    assert len({r.ids_sha256 for r in rows if r.doc_id == 2}) == 1
    assert byte_bpe.round_trip(no_docs, RANKS, PATTERN).count() == 0


def test_ids_that_are_no_utf8_decode_to_their_bytes(spark, merges):
    ids = [merges[bytes([b])] for b in (0xC3, 0x28, 0xFF)]
    df = spark.createDataFrame([(1, bytearray(struct.pack("<3I", *ids))), (2, None)], "doc_id long, ids binary")
    rows = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(df, RANKS, PATTERN).collect()}
    assert rows == {1: b"\xc3\x28\xff", 2: b""}
    got = df.select(byte_bpe.id_array(F.coalesce("ids", F.unhex(F.lit("")))).alias("a")).collect()
    assert [r.a for r in got] == [ids, []]
