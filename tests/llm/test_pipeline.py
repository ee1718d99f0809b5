"""Each stage against a brute-force version on its own input."""

import pytest
from brute import contained, simhash_groups, targets

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from rankfold.llm import toxicity_mil  # noqa: E402
from rankfold.llm.common import table, written  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), "pipeline-test")
        out.append((docs, result))
        docs = result
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "mixing", "token output"]
    columns = stages[0][0].columns
    assert all(result.columns == columns for _, result in stages[:-1])


def test_toxicity(spark, stages):
    docs, result = stages[0]
    scorer = toxicity_mil.Scorer(toxicity_mil.fit(docs, table(spark, SF, "labels")))
    assert ids(result) == sorted(r.doc_id for r in docs.collect() if scorer.score(r.text)[0] < 0.7)


def test_simhash(stages):
    docs, result = stages[1]
    groups = simhash_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert ids(result) == sorted({c for _, c in groups.values()})


def test_decontamination(spark, stages):
    docs, result = stages[2]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {d for d, _ in contained([(r.doc_id, r.text) for r in docs.collect()], items)}
    assert ids(result) == sorted(set(ids(docs)) - bad)


def test_mixing(stages):
    docs, result = stages[3]
    size = {r.doc_id: (r.source, len((r.text or "").split())) for r in docs.collect()}
    per_source: dict = {}
    for s, n in size.values():
        per_source.setdefault(s, []).append(n)
    goal = targets({s: sum(v) for s, v in per_source.items()})
    taken = {s: 0 for s in per_source}
    for i in ids(result):
        taken[size[i][0]] += size[i][1]
    assert all(abs(taken[s] - goal[s]) <= max(per_source[s]) / 2 + 1e-6 for s in per_source)
    assert max(ids(result).count(i) for i in set(ids(result))) <= 3


def test_tokens(stages):
    docs, result = stages[4]
    assert ids(result) == ids(docs)
    spans = sorted((r.start, r.n_tokens) for r in result.collect())
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_run(spark, stages):
    run = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert run == sorted(tuple(r) for r in stages[-1][1].collect())
