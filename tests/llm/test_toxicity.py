import math
import random
import zlib

import pytest
from pyspark.sql import functions as F
from rankfold.llm import toxicity_mil

WORDS = "river stone apple garden window paper music table cloud winter summer bread light".split()
BAD = "grubnak vilesome rottick".split()


def corpus(spark, n=400, seed=3):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(WORDS, k=9)) for _ in range(rng.randint(3, 8))]
        toxic = i % 4 == 0
        if toxic:
            for s in rng.sample(range(len(sentences)), 2):
                w = sentences[s].split()
                w[rng.randrange(9)] = rng.choice(BAD)
                sentences[s] = " ".join(w)
        docs.append((i, ". ".join(f"{s} {i * 31 + k}" for k, s in enumerate(sentences)) + ".", int(toxic)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, truth int"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(spark)
    return docs, labels, toxicity_mil.fit(docs, labels)


def test_held_out_accuracy_and_located_sentences(fitted):
    docs, _, model = fitted
    rows = toxicity_mil.toxicity(docs, model).join(docs, "doc_id").collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(400)}
    unseen = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.truth for r in unseen) >= 0.95 * len(unseen)
    for r in unseen:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        for s in r.offending:
            assert any(b in r.text[s.start:s.end] for b in BAD)
        # noisy-or: the document's score is at least that of any sentence
        assert all(r.score >= s.score - 1e-9 for s in r.offending)


def test_labels_of_held_out_rows_are_not_used(spark, fitted):
    docs, labels, model = fitted
    flipped = labels.withColumn("toxic", F.when(toxicity_mil.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity_mil.fit(docs, flipped)
    assert again.bias == model.bias and again.weights == model.weights


def test_sample_bound(spark, fitted):
    docs, labels, _ = fitted
    small = toxicity_mil.fit(docs, labels, toxicity_mil.SampleBound(rows_per_label=3, characters=500))
    assert len(small.weights) < 1000


def test_odd_rows(spark, odd_docs, no_docs, fitted):
    _, labels, model = fitted
    rows = toxicity_mil.toxicity(odd_docs, model).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert all(by[i].score == 0 and by[i].predicted == 0 for i in (3, 4, 5)) and by[None].held_out is False
    kept = toxicity_mil.without_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == 10
    assert toxicity_mil.toxicity(no_docs, model).count() == 0
    nothing = toxicity_mil.fit(odd_docs, labels.limit(0))
    assert {r.score for r in toxicity_mil.toxicity(odd_docs, nothing).collect()} == {0.0}


def test_clean_documents_stay(fitted):
    docs, _, model = fitted
    kept = toxicity_mil.without_toxic(docs, model)
    clean = docs.filter("truth = 0")
    assert clean.join(kept, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_long_documents_and_repeated_ids_leave_the_sample_whole(spark):
    docs, labels = corpus(spark)
    bound = toxicity_mil.SampleBound(rows_per_label=300, characters=200_000)
    first = labels.filter(~toxicity_mil.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).first().doc_id
    ahead = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    ahead = spark.createDataFrame([(i,) for i in ahead], "doc_id long").filter(F.xxhash64("doc_id") < F.xxhash64(F.lit(first))).limit(3).collect()
    assert ahead  # ids that come before all others
    long = [(r.doc_id, "grey " * 60_000 + str(r.doc_id), 0) for r in ahead]
    more = docs.unionByName(spark.createDataFrame(long, "doc_id long, text string, truth int"))
    known = labels.unionByName(spark.createDataFrame([(i, 0) for i, _, _ in long], "doc_id long, toxic int"))
    copies = docs.filter(F.col("doc_id") == first).crossJoin(spark.range(700).select()).select(docs.columns)
    got = toxicity_mil.sample(more.unionByName(copies), known, bound)
    want = toxicity_mil.sample(docs, labels, bound)
    assert want.count() > 100 and [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    model = toxicity_mil.fit(more.unionByName(copies), known, bound)
    assert model.bias > -100
    rows = toxicity_mil.toxicity(docs, model).join(docs, "doc_id").collect()
    assert sum(r.predicted == r.truth for r in rows) >= 0.95 * len(rows)


def test_a_document_that_does_not_fit_is_passed_over():
    assert toxicity_mil.within([(0, 90), (0, 30), (1, 40), (0, 20), (1, 11)], 100) == [1, 2, 3]
    assert toxicity_mil.within([(0, 300), (1, 300)], 100) == []
    assert toxicity_mil.within([(0, 40), (0, 40), (1, 10)], 100) == [0, 1, 2]  # what a label leaves, the other may use


def plain_score(text, model):
    """The noisy-or written out, sentence by sentence."""
    left, best, strong = 1.0, 0.0, False
    for _, _, words in toxicity_mil.sentences(text or ""):
        learned = [sum(model.weights.get(f, 0.0) for f in toxicity_mil.features(w)) for w in words]
        if not any(learned):
            continue
        p = 1 / (1 + math.exp(-(sum(learned) + model.bias)))
        best = max(best, p)
        if p >= toxicity_mil.EVIDENT:
            left, strong = left * (1 - p), True
    return 1 - left if strong else best


def test_score_is_the_noisy_or(fitted):
    docs, _, model = fitted
    for r in toxicity_mil.toxicity(docs, model).join(docs, "doc_id").collect():
        assert math.isclose(r.score, plain_score(r.text, model), rel_tol=1e-5, abs_tol=1e-9)


def test_length_is_no_evidence(spark, fitted):
    docs, _, model = fitted
    scorer = toxicity_mil.Scorer(model)
    assert scorer.score("The river runs past grey stones. " * 100_000)[0] < 0.1
    assert scorer.score(" ".join(WORDS) * 50_000)[0] < 0.1
    clean = [r.text for r in docs.filter("truth = 0").collect()]
    clean = [t for t in clean if scorer.score(t)[0] < 0.7]
    for n in (1, 3, 10, 30, 100, len(clean)):
        joined = ["\n".join(clean[i:i + n]) for i in range(0, len(clean) - n + 1, n)]
        assert not any(scorer.score(t)[0] >= 0.7 for t in joined), n
    assert scorer.score(" ".join(f"new{i} word{i * 7}" for i in range(200_000)))[0] < 0.1  # unknown words meet no learned feature
    # an offending sentence counts wherever it stands
    assert scorer.score("\n".join(clean) + " You vilesome rottick grubnak.")[0] >= 0.7


def test_weak_evidence_does_not_add_up():
    weights = {toxicity_mil.features("maybe")[0]: 1.0, toxicity_mil.features("vile")[0]: 9.0}
    scorer = toxicity_mil.Scorer(toxicity_mil.Model(weights, -5.0))
    one, many = scorer.score("Well, maybe.")[0], scorer.score("Well, maybe. " * 5000)[0]
    assert 0 < one == many < 0.1
    assert scorer.score("Well, maybe. " * 5000 + "How vile!")[0] == pytest.approx(1 / (1 + math.exp(-4)), rel=1e-5)
