import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rankfold.llm import token_pfor
from rankfold.llm.registry import tokenizer_path

SF = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 200), st.integers(0, 2**32 - 1)), max_size=300), st.sampled_from([1, 7, 64]), st.sampled_from([0.0, 0.5, 0.95, 1.0]))
def test_segment_round_trip(ids, block, share):
    ids = np.array(ids, dtype=np.uint32)
    s = token_pfor.Segment(token_pfor.encode(ids, np.array([0, len(ids) // 2]), block, share))
    assert (s.read() == ids).all() and list(s.starts) == [0, len(ids) // 2, len(ids)]
    for lo, hi in ((0, len(ids)), (len(ids) // 3, len(ids) // 2 + 1), (5, 6)):
        assert (s.read(lo, min(hi, len(ids))) == ids[lo:min(hi, len(ids))]).all()


def test_outliers_are_exceptions_and_the_width_is_small():
    ids = np.array([100 + i % 8 for i in range(1024)], dtype=np.uint32)
    ids[500] = 4_000_000_000
    payload = token_pfor.encode(ids, np.array([0]))
    assert len(payload) < 1024 * 3 // 8 + 100
    assert (token_pfor.Segment(payload).read() == ids).all()


TEXTS = ["", " ", "a", "  two  spaces\n\nlines \n", "tab\there", "x <|endoftext|> y", "it's don't we'll", "é à ü 日本語 テスト 😀", "\x1c odd\x85 space\u2003here",
         "1234 5 67,8.9!!", " \n \n lead", "trail \n ", "\r\nwin\r\n", "A" * 3000, "word " * 500]


def test_encoder_equals_the_library():
    e = token_pfor.Encoder(tokenizer_path())
    for _ in range(2):  # fresh and remembered
        got = [np.frombuffer(b, "<u4").tolist() for b in e.encode(TEXTS)]
        assert got == [x.ids for x in e.tokenizer.encode_batch(TEXTS, add_special_tokens=False)]


def variants(settings):
    """Files of the same vocabulary under other settings, and the word tokenizer."""
    pre = settings["pre_tokenizer"]
    yield {**settings, "pre_tokenizer": {**pre, "add_prefix_space": True}}
    yield {**settings, "pre_tokenizer": {**pre, "use_regex": False}}
    yield {**settings, "normalizer": {"type": "Lowercase"}}
    yield {**settings, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, pre]}}
    yield {**settings, "truncation": {"direction": "Right", "max_length": 9, "strategy": "LongestFirst", "stride": 0}}


def test_other_tokenizer_settings_give_the_library_ids(tmp_path):
    import json

    import public_tokenizers

    files = [public_tokenizers.path("word_bpe_49k.json")]
    with open(tokenizer_path()) as f:
        settings = json.load(f)
    for i, other in enumerate(variants(settings)):
        files.append(str(tmp_path / f"{i}.json"))
        with open(files[-1], "w") as f:
            json.dump(other, f)
    for path in files:
        e = token_pfor.Encoder(path)
        assert not e.cuts
        for _ in range(2):
            got = [np.frombuffer(b, "<u4").tolist() for b in e.encode(TEXTS)]
            assert got == [x.ids for x in e.tokenizer.encode_batch(TEXTS, add_special_tokens=False)], path
    assert token_pfor.Encoder(tokenizer_path()).cuts


def brute(docs):
    t = token_pfor.Encoder(tokenizer_path()).tokenizer
    out, start = {}, 0
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [1_000_000, 50])
def test_files_match_brute_force(spark, tmp_path, segment):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    token_pfor.write_tokens(docs.repartition(5), tokenizer_path(), str(tmp_path / "t"), block=128, segment=segment)
    rows = token_pfor.read_tokens(spark, str(tmp_path / "t"), with_ids=True).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = token_pfor.token_digest(odd_docs, tokenizer_path()).collect()
    assert len(rows) == 10
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    by = {r.doc_id: r for r in rows}
    assert by[None].start == 0 and by[3].n_tokens == by[4].n_tokens == 1
    assert token_pfor.token_digest(no_docs, tokenizer_path()).count() == 0
