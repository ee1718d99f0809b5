import random

from brute import contained
from rankfold.llm import decontaminate

SF = "/root/testdata/sf0.001"


def pairs(df):
    return sorted((r.doc_id, r.item_id) for r in df.collect())


def planted(spark, seed=8):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 14, 30, 60, 61, 120, 400, 0, 30])]
    items[14] = (14, items[8][1])  # the same item twice
    docs = []
    for d in range(60):
        body = rng.choices(vocab, k=rng.choice([0, 3, 40, 900]))
        for _ in range(rng.randint(0, 2)):
            words = items[rng.randrange(len(items))][1].split()
            words = [w if rng.random() > rng.choice([0, 0, 0.05]) else "changed" for w in words]
            cut = rng.choice([0, 0, len(words) // 6])
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in words[cut:]]
        docs.append((d, " ".join(body)))
    return docs, items


def test_matches_brute_force(spark, monkeypatch):
    docs, items = planted(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(contained(docs, items))
    assert len(want) > 30
    assert pairs(decontaminate.contained_items(d, i)) == want
    for name in ("BROADCAST_SKETCH", "BROADCAST_PAIRS", "BROADCAST_ITEMS"):
        monkeypatch.setattr(decontaminate, name, 0)
    assert pairs(decontaminate.contained_items(d, i)) == want


def test_sketch_cannot_miss(spark):
    rows = decontaminate.sketches(spark.createDataFrame(planted(spark)[1], "item_id long, text string")).collect()
    for r in rows:
        missing = r.n - -(-8 * r.n // 10)
        assert r.need >= 1 and len(r.sketch) - missing >= r.need and len(r.sketch) <= r.n
    assert {r.item_id for r in rows} == set(range(15)) - {13}


def test_whole_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {d for d, _ in contained([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])}
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad and bad


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "quick BROWN fox jumps over the lazy dog"), (3, "quick BROWN fox jumps over the lazy dog"),
                                   (None, "lost id text of five words"), (4, "word5 fill5 word6 fill6 word7 fill7")], "item_id long, text string")
    got = decontaminate.contained_items(odd_docs, items).collect()
    assert sorted(((r.doc_id or 0), (r.item_id or 0)) for r in got) == [(0, 0), (1, 3), (2, 3), (6, 4)]
    kept = decontaminate.without_contaminated(odd_docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7, 8]
    assert decontaminate.contained_items(no_docs, items).count() == 0
    assert decontaminate.without_contaminated(odd_docs, items.limit(0)).count() == 10
