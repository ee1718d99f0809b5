import math
import random

from brute import SPACE_WORD, base_quality
from rankfold.llm import quality_jsd
from rankfold.llm.common import written

SF = "/root/testdata/sf0.001"


def test_base_counts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id % 1 = 0")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality_jsd.quality(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base_quality(texts[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed)


def histograms(text):
    """Characters by class and vocabulary counts of one text."""
    text = text or ""
    wide = sum(len(c.encode()) - 1 for c in text)
    chars = [sum("a" <= c <= "z" for c in text), sum("A" <= c <= "Z" for c in text), sum("0" <= c <= "9" for c in text),
             sum(c in quality_jsd.WHITE_SPACE for c in text), sum(c in quality_jsd.PUNCTUATION for c in text),
             sum(c in quality_jsd.SYMBOLS for c in text), wide]
    words = SPACE_WORD.findall(text)
    plain = [w.strip(quality_jsd.PUNCTUATION).lower() for w in words]
    inside = [plain.count(v) for v in quality_jsd.VOCABULARY]
    return chars, [*inside, len(words) - sum(inside)]


def js(p, q):
    a, b, out = sum(p), sum(q), 0.0
    if not a or not b:
        return 0.0
    for x, y in zip(p, q):
        x, y = x / a, y / b
        m = (x + y) / 2
        out += (x * math.log2(x / m) if x else 0) + (y * math.log2(y / m) if y else 0)
    return math.sqrt(max(out / 2, 0))


def plain_quality(docs):
    """(kept, char_distance, word_distance) by id, all in plain Python; docs are (id, text, lang)."""
    base = {i: base_quality(t) for i, t, _ in docs}
    hist = {i: histograms(t) for i, t, _ in docs}

    def reference(rows):
        out = {}
        for i, _, lang in rows:
            c, w = out.get(lang, ([0] * 7, [0] * (len(quality_jsd.VOCABULARY) + 1)))
            out[lang] = [x + y for x, y in zip(c, hist[i][0])], [x + y for x, y in zip(w, hist[i][1])]
        return out

    def distances(rows, refs):
        out = {}
        for i, _, lang in rows:
            ref = refs.get(lang)
            big = ref is not None and sum(ref[1]) >= quality_jsd.MIN_REFERENCE_WORDS
            out[i] = (js(hist[i][0], ref[0]) if big and base[i][1] >= quality_jsd.MIN_CHARS else None,
                      js(hist[i][1], ref[1]) if big and base[i][0] >= quality_jsd.MIN_WORDS else None)
        return out

    good = [d for d in docs if not base[d[0]][5]]
    near = distances(good, reference(good))
    inner = []
    for lang in {d[2] for d in good}:
        own = [d for d in good if d[2] == lang]
        limit = []
        for k in (0, 1):
            xs = sorted(round(near[d[0]][k], 6) for d in own if near[d[0]][k] is not None)
            limit.append(xs[(len(xs) - 1) // 2] if xs else -1)
        inner += [d for d in own if any(near[d[0]][k] is not None and round(near[d[0]][k], 6) <= limit[k] for k in (0, 1))]
    out = {}
    for i, (c, w) in distances(docs, reference(inner)).items():
        far = (c is not None and c > quality_jsd.MAX_CHAR_DISTANCE) or (
            w is not None and w > quality_jsd.MAX_WORD_DISTANCE + quality_jsd.WORD_NOISE / math.sqrt(base[i][0]))
        out[i] = not base[i][5] and not far, c, w
    return out


def test_verdicts_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    want = plain_quality([tuple(r) for r in docs.collect()])
    rows = quality_jsd.quality(docs).collect()
    assert any(r.char_distance is not None for r in rows) and len({r.kept for r in rows}) == 2
    for r in rows:
        kept, c, w = want[r.doc_id]
        assert r.kept == kept, r.doc_id
        for x, y in ((r.char_distance, c), (r.word_distance, w)):
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9))


def test_medians_are_exact(spark):
    rng = random.Random(6)
    rows = [(lang, rng.random(), rng.choice([None, rng.random()])) for lang in ("a", None) for _ in range(rng.randint(50, 99))]
    df = spark.createDataFrame(rows, "lang string, char_distance double, word_distance double").repartition(7)
    got = {r.lang: (r.mc, r.mw) for r in quality_jsd.medians(df).collect()}
    for lang in ("a", None):
        for k in (1, 2):
            xs = sorted(round(r[k], 6) for r in rows if r[0] == lang and r[k] is not None)
            assert got[lang][k - 1] == xs[(len(xs) - 1) // 2]


def test_repeated_windows(spark):
    rng = random.Random(2)
    texts = ["a b c d e f g h a b c d e f g h", "x " * 30, "a b c d e f g h i a b c d e f g h", "", " \n\t", "a b c",
             "\n".join(["same line here", "", "same line here", " same line here", "same line here"])]
    texts += [" ".join(rng.choices("pqr", k=rng.randint(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in quality_jsd.counts(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_quality(texts[r.doc_id])


def test_divergence_rejects_junk_and_keeps_prose(spark):
    rng = random.Random(1)
    common, rare = "the of and to in is that it for was on are as with by".split(), [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.45 else rng.choice(rare) for _ in range(n)) + "."

    rows = [(i, prose(rng.randint(120, 400)), "en") for i in range(120)]
    rows += [(1000 + i, "|".join(f" {rng.choice(rare).upper()} {rng.randint(0, 99999)} #" for _ in range(150)), "en") for i in range(10)]
    rows += [(2000 + i, " ".join(rng.choices(rare, k=300)), "en") for i in range(10)]
    rows += [(3000, prose(25), "en")]
    got = {r.doc_id: r for r in quality_jsd.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(120)) and got[3000].kept and got[3000].word_distance is None
    assert not any(got[1000 + i].kept or got[2000 + i].kept for i in range(10))
    assert not any(got[1000 + i].base_failed or got[2000 + i].base_failed for i in range(10))


def test_js_distance_values(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([1, 0], [0, 5]), ([1, 1], [3, 3]), ([1, 0], [1, 1]), ([0, 0], [1, 1])], "p array<bigint>, q array<bigint>")
    got = [r[0] for r in df.select(quality_jsd.js_distance(F.col("p"), F.col("q"))).collect()]
    assert [round(x, 6) for x in got] == [1.0, 0.0, 0.557923, 0.0]


def test_odd_rows(odd_docs, no_docs):
    rows = quality_jsd.quality(odd_docs).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[3].base_failed and not by[3].kept
    assert by[6].n_words == 30_000
    assert quality_jsd.quality(no_docs).count() == 0


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    docs = written(spark.read.parquet(f"{SF}/documents.parquet"), "quality-test")
    a = sorted(map(tuple, quality_jsd.quality(docs).collect()))
    monkeypatch.setattr(quality_jsd, "BROADCAST_LANGUAGES", 0)
    assert a == sorted(map(tuple, quality_jsd.quality(docs).collect()))
