import pytest
from rankfold.llm import chat_rotation


def brute(rows, max_turns):
    convs = {}
    for conv, turn, who, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, (who or "unknown").replace("<|", "< |"), (text or "").replace("<|", "< |")))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        for me in {t[2] for t in turns} - {"system"}:
            for k in range(0, len(turns), max_turns):
                text, spans = "", []
                for *_, who, body in turns[k:k + max_turns]:
                    text += "<|assistant|>\n" if who == me else "<|system|>\n" if who == "system" else f"<|user name={who}|>\n"
                    if who == me:
                        spans.append((len(text), len(text) + len(body)))
                    text += body + "\n"
                out[conv, me, k // max_turns] = (text, spans)
    return out


ROWS = [(c, t, ["ann", "bob", "system", "cy", None][(c + t * t) % 5], f"turn {t} é😀 of {c}" if t % 4 else None) for c in range(6) for t in range(c * 5)]
ROWS += [(7, 0, "system", "only a narrator"), (None, 1, "ann", "no id <|assistant|>"), (None, None, "bob", "first"), (8, 3, "x<|y", ""), (8, 3, "x<|y", "")]


@pytest.mark.parametrize("max_turns", [256, 3])
def test_rotation_matches_brute_force(spark, max_turns):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(4)
    rows = chat_rotation.rotate(df, max_turns=max_turns).collect()
    assert {(r.conv_id, r.perspective, r.segment): (r.text, [tuple(s) for s in r.spans]) for r in rows} == brute(ROWS, max_turns)
    assert len({(r.conv_id, r.perspective, r.segment) for r in rows}) == len(rows)
    for r in rows:
        assert all(r.text[s.start - 14:s.start] == "<|assistant|>\n" for s in r.spans)


def test_one_conversation_over_many_partitions(spark):
    rows = [(1, i, f"p{i % 3}", f"t{i}") for i in range(3000)] + [(2, 0, "a", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    ranked = {(r.conv_id, r.turn): r["rank"] for r in chat_rotation.ranked_turns(df.withColumnRenamed("role", "speaker")).collect()}
    assert ranked == {(1, i): i for i in range(3000)} | {(2, 0): 0}
    got = chat_rotation.rotate(df, max_turns=100)
    assert got.filter("conv_id = 1").count() == 3 * 30
    whole = "".join(r.text for r in got.filter("conv_id = 1 AND perspective = 'p0'").orderBy("segment").collect())
    assert whole == brute(rows, 10_000)[1, "p0", 0][0]


def test_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "a", "x", 5, "q")], "conv_id long, turn long, role string, text string, rank int, speaker string")
    assert [r.text for r in chat_rotation.rotate(df).collect()] == ["<|assistant|>\nx\n"]
    assert [r.perspective for r in chat_rotation.rotate(df, speaker="speaker").collect()] == ["q"]
    assert chat_rotation.rotate(df.limit(0)).count() == 0
