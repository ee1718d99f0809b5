"""Hand-written cases with exact answers (FIXTURES.md section 2)."""

import math

from pyspark.sql import functions as F

from rankfold.functions import java_split, ordinal, text_lines
from rankfold.operators import graph, keyed, popularity, recommend, similarity, text
from rankfold.sources import readers


def _split(spark, lines, pattern):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    rows = df.select("i", java_split("line", pattern).alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


def test_word_split_non_word(spark):
    assert _split(spark, ["", "---", "-a b--", "a"], r"\W+") == [[""], [], ["", "a", "b"], ["a"]]


def test_word_split_space(spark):
    assert _split(spark, [" a  b ", "  "], " ") == [["", "a", "", "b"], []]


def test_text_lines(spark):
    df = spark.createDataFrame([("a\nb\r\nc\n",), ("x\n\ny",), ("",)], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == [["a", "b", "c"], ["x", "", "y"], []]


def test_word_count_stop_words_sorted(spark):
    lines = spark.createDataFrame([("The cat and the hat",), ("a Cat",)], "line string")
    out = text.word_count(lines, text.NON_WORD, lower=True, stop_words=text.STOP_WORDS, sort=True)
    assert [tuple(r) for r in out.collect()] == [("cat", 2), ("hat", 1)]


def test_integer_mean(spark):
    df = spark.createDataFrame([("k", 1), ("k", 2)], "key string, v int")
    assert keyed.int_avg_by_key(df, "key", "v").collect()[0][1] == 1


def test_fahrenheit(spark):
    df = spark.createDataFrame([("s1", "TMIN", -148.0), ("s1", "TMAX", 5.0)], "station string, type string, value double")
    row = keyed.min_reading_by_station(df).collect()[0]
    assert row["label"] == "5.36 F" and row["min_temp"] == 5.36
    assert keyed.max_reading_by_station(df).collect()[0]["max_value"] == 5.0


def test_quoted_names(spark, tmp_path):
    p = tmp_path / "items.csv"
    p.write_text('11,"President, The (1995)",Comedy|Drama\n12,"Say ""Hi"" (1999)",War\n')
    rows = readers.read_items(spark, str(p), ",").orderBy("item_id").collect()
    assert rows[0]["name"] == "President, The (1995)" and rows[0]["tags"].split("|") == ["Comedy", "Drama"]
    assert rows[1]["name"] == 'Say "Hi" (1999)'


def test_pipe_items_skip_single_field(spark, tmp_path):
    p = tmp_path / "u.item"
    p.write_text("1|Toy Story|x\n2\n3|Heat|y|z\n")
    assert [r["item_id"] for r in readers.read_items(spark, str(p), "|").collect()] == [1, 3]


def test_bad_utf8_replaced(spark, tmp_path):
    p = tmp_path / "bad.txt"
    p.write_bytes(b"ok\nbad \xff end\n")
    lines = [r["line"] for r in readers.read_lines(spark, str(p)).collect()]
    assert lines == ["ok", "bad � end"]


def test_adjacency_and_names(spark, tmp_path):
    adj = tmp_path / "graph.txt"
    adj.write_text("1 2 3 \n1 4\n5\n\n")
    deg = {r["node"]: r["degree"] for r in graph.adjacency_degree(readers.read_adjacency(spark, str(adj))).collect()}
    assert deg == {1: 3, 5: 0}
    names = tmp_path / "names.txt"
    names.write_text('1 "SPIDER-MAN"\n2 no quote\nx "BAD"\n')
    assert [tuple(r) for r in readers.read_node_names(spark, str(names)).collect()] == [(1, "SPIDER-MAN")]


def _ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_cosine(spark):
    sims = similarity.item_similarity(_ratings(spark, [(1, 1, 3.0), (1, 2, 4.0), (2, 1, 4.0), (2, 2, 3.0)]))
    row = sims.collect()[0]
    assert (row["item1"], row["item2"], row["n_pairs"]) == (1, 2, 2) and abs(row["score"] - 0.96) < 1e-12


def test_cosine_zero_denominator(spark):
    sims = similarity.item_similarity(_ratings(spark, [(1, 1, 0.0), (1, 2, 0.0)]))
    assert [tuple(r) for r in sims.collect()] == [(1, 2, 0.0, 1)]


EDGES = [(0, 1), (0, 2), (1, 3), (2, 3), (3, 4)]


def _edges(spark, edges):
    return spark.createDataFrame(edges, "node long, neighbour long")


def _dos(spark, edges, target, start=0, max_levels=None):
    return [tuple(r) for r in graph.degrees_of_separation(_edges(spark, edges), start, target, max_levels).collect()]


def test_bfs_two_parents(spark):
    assert _dos(spark, EDGES, 4) == [(3, 1)]


def test_bfs_two_hits(spark):
    assert _dos(spark, EDGES, 3) == [(2, 2)]


def test_bfs_unreachable(spark):
    assert _dos(spark, EDGES, 9) == []


def test_bfs_level_limit(spark):
    chain = [(i, i + 1) for i in range(12)]
    assert _dos(spark, chain, 11, max_levels=10) == []
    assert _dos(spark, chain, 10, max_levels=10) == [(10, 1)]
    assert _dos(spark, chain, 11) == [(11, 1)]


def test_bfs_start_is_target_through_cycle(spark):
    assert _dos(spark, [(0, 1), (1, 0)], 0) == [(2, 1)]


def test_bfs_distances(spark):
    got = {r["node"]: r["dist"] for r in graph.bfs_distances(_edges(spark, EDGES), 0).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 2, 4: 3}


def test_rmse_divisor(spark):
    scored = spark.createDataFrame([(4.0, 3.0), (float("nan"), 5.0)], "prediction double, rating double")
    assert math.isclose(recommend.rmse_scored(scored), math.sqrt(0.5))


def test_time_buckets(spark):
    df = spark.createDataFrame([(5,), (6,), (8,)], "s long").select(
        F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    first = [r["split"] for r in recommend.with_split(df, "68").collect()]
    second = [r["split"] for r in recommend.with_split(df, "24").collect()]
    assert first == ["train", "validation", "test"] and second == ["train", "train", "train"]


def test_add_user_ratings_drops_unseen(spark):
    train = _ratings(spark, [(1, 1, 4.0)])
    supplied = _ratings(spark, [(9, 1, 0.0), (9, 2, 5.0), (9, 3, 3.0)])
    got = sorted(tuple(r) for r in recommend.add_user_ratings(train, supplied).collect())
    assert got == [(1, 1, 4.0), (9, 2, 5.0), (9, 3, 3.0)]


def test_tie_order_lower_id_first(spark):
    ratings = spark.createDataFrame([(7, 1.0), (3, 1.0)], "item_id long, rating double")
    items = spark.createDataFrame([(3, "c"), (7, "g")], "item_id long, name string")
    assert [r["item_id"] for r in popularity.top_items(ratings, items, 1).collect()] == [3]


def test_most_connected_tie_larger_id(spark):
    degrees = spark.createDataFrame([(4, 2), (9, 2), (1, 1)], "node long, degree long")
    names = spark.createDataFrame([(4, "d"), (9, "i"), (1, "a")], "node long, name string")
    assert [tuple(r) for r in graph.most_connected(degrees, names).collect()] == [(9, "i", 2)]


def test_ordinal_matches_sorted_positions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"))
    ranked = ordinal(df.repartition(5), [F.col("v").desc()])
    got = sorted((r["rank"], r["v"]) for r in ranked.collect())
    assert got == [(i + 1, 4999 - i) for i in range(5000)]


def test_latest_per_key_tie_breaks_on_larger_event(spark):
    from rankfold.functions import latest_per_key

    df = spark.sql("""SELECT * FROM VALUES
        (1, 1, timestamp_ntz'2024-01-01 00:00:05', 10L, 3.0),
        (1, 1, timestamp_ntz'2024-01-01 00:00:05', 12L, 4.0),
        (1, 1, timestamp_ntz'2024-01-01 00:00:04', 99L, 5.0),
        (2, 1, timestamp_ntz'1969-12-31 23:59:59', -5L, 1.0),
        (2, 1, timestamp_ntz'1969-12-31 23:59:59', -7L, 2.0)
        AS t(user_id, item_id, ts, event_id, rating)""")
    got = {(r["user_id"], r["item_id"]): (r["rating"], r["event_id"])
           for r in latest_per_key(df, ["user_id", "item_id"], ["rating", "ts"]).collect()}
    assert got == {(1, 1): (4.0, 12), (2, 1): (1.0, -5)}
    assert "SortAggregate" not in latest_per_key(df, ["user_id", "item_id"], ["rating"])._jdf.queryExecution().executedPlan().toString()


def test_similarity_text_dump_sorted(spark, tmp_path):
    from rankfold.sources import sinks

    sims = spark.createDataFrame([(1, 2, 0.5, 3), (1, 3, 0.9, 2), (2, 3, 0.9, 5)],
                                 "item1 long, item2 long, score double, n_pairs long")
    path = sinks.write_similarities(sims.repartition(3), str(tmp_path / "dump"), fmt="text")
    # part files in name order hold the global sort order
    parts = sorted(p for p in (tmp_path / "dump").iterdir() if p.name.startswith("part-"))
    lines = [line for p in parts for line in p.read_text().splitlines()]
    assert lines == ["(1,2)\t(0.500000,3)", "(1,3)\t(0.900000,2)", "(2,3)\t(0.900000,5)"]


def _file(tmp_path, name, text):
    (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path / name)


def test_empty_names_are_kept(spark, tmp_path):
    from rankfold.sources import readers

    pipe = readers.read_items(spark, _file(tmp_path, "p", "1|a|x\n2||x\n3\n"), "|")
    assert sorted(tuple(r) for r in pipe.collect()) == [(1, "a"), (2, "")]
    colons = readers.read_items(spark, _file(tmp_path, "c", "2::::Drama\n3::b\n"), "::")
    assert sorted(tuple(r) for r in colons.collect()) == [(2, "", "Drama", " <Drama>"), (3, "b", "", "b <>")]
    comma = readers.read_items(spark, _file(tmp_path, "q", '2,,Drama\n4,"a, ""b""",X\n5\n'), ",")
    assert sorted(tuple(r) for r in comma.collect()) == [(2, "", "Drama"), (4, 'a, "b"', "X")]


def test_malformed_fields_fail(spark, tmp_path):
    import pytest
    from rankfold.sources import readers

    with pytest.raises(Exception, match="(?i)malformed|CAST_INVALID|thirty"):
        readers.read_people(spark, _file(tmp_path, "ppl", "1,a,thirty,4\n")).collect()
    with pytest.raises(Exception, match="(?i)malformed|CAST_INVALID|x9"):
        readers.read_items(spark, _file(tmp_path, "it", "x9|name\n"), "|").collect()


def test_adjacency_with_trailing_tab(spark, tmp_path):
    from rankfold.sources import readers

    rows = readers.read_adjacency(spark, _file(tmp_path, "adj", "1 2 3\t\n\t4 1 \r\n\n"))
    assert sorted((r.node, list(r.neighbours)) for r in rows.collect()) == [(1, [2, 3]), (4, [1])]


def test_split_of_a_million_delimiters_is_linear(spark):
    import time

    from pyspark.sql import functions as F
    from rankfold.functions import java_split

    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), 1_000_000), F.lit("b"), F.repeat(F.lit(" "), 1_000_000)).alias("s"))
    df.select(F.size(java_split("s", r"\W+"))).first()
    t = time.perf_counter()
    assert df.select(F.size(java_split("s", r"\W+"))).first()[0] == 2
    assert time.perf_counter() - t < 2
    assert df.select(F.size(java_split("s", " "))).first()[0] == 1_000_001


def test_file_ratings_to_split_and_rmse(spark, tmp_path):
    from rankfold.functions import latest_per_key
    from rankfold.operators import recommend
    from rankfold.sources import readers

    text = "".join(f"{u}::{i}::{(u * i) % 5 + 1}::{100 + u + i}\n" for u in range(5) for i in range(6)) + "0::0::5::200\n"
    r = latest_per_key(readers.read_ratings(spark, _file(tmp_path, "r", text), "::"), ["user_id", "item_id"], ["rating", "ts"])
    rows = recommend.with_split(r, "68").collect()
    assert len(rows) == 30 and {(x.user_id, x.item_id): (x.rating, x.split) for x in rows}[(0, 0)] == (5.0, "train")
    by = {s: [x.rating for x in rows if x.split == s] for s in ("train", "validation", "test")}
    mean = sum(by["train"] + by["validation"]) / len(by["train"] + by["validation"])
    want = (sum((mean - x) ** 2 for x in by["test"]) / len(by["test"])) ** 0.5
    assert abs(recommend.mean_baseline(recommend.with_split(r, "68")).first()[0] - want) < 1e-9
    model = recommend.fit_als(r, rank=2, max_iter=2, reg=0.1)
    assert recommend.rmse_value(model, r) >= 0


def test_names_missing_and_repeated(spark):
    from rankfold.operators import popularity

    ratings = spark.createDataFrame([(1, 5.0), (1, 4.0), (2, 3.0), (3, 1.0)], "item_id long, rating double")
    items = spark.createDataFrame([(1, "b", "x"), (1, "a", "x"), (3, "c", "x")], "item_id long, name string, tags string")
    assert [tuple(r) for r in popularity.top_items(ratings, items, 2).collect()] == [(1, "a", 2), (2, None, 1)]
    assert [tuple(r) for r in popularity.unmatched_items(ratings, items).collect()] == [(1, 1)]
    assert len(popularity.item_popularity_named(ratings, items).collect()) == 3


def test_sample_fraction_is_exact(spark):
    from pyspark.sql import functions as F
    from rankfold.functions import hash_below

    ids = spark.range(20_000)
    for fraction in (0.005, 0.125):
        n = ids.filter(hash_below("id", 0, fraction)).count()
        assert abs(n - 20_000 * fraction) < 5 * (20_000 * fraction) ** 0.5


def test_sorted_reports_are_sorted(spark):
    from scales import SF_SMALL
    from rankfold.plans import catalog

    ranks = [r["rank"] for r in catalog.QUERIES["tag_popularity"](spark, SF_SMALL).collect()]
    assert ranks == list(range(1, len(ranks) + 1))
    counts = [(-r["n"], r["word"]) for r in catalog.QUERIES["word_count_sorted"](spark, SF_SMALL).collect()]
    assert counts == sorted(counts)
    pairs = [(r["item1"], r["item2"]) for r in catalog.QUERIES["sink_similarities"](spark, SF_SMALL).collect()]
    assert sorted(pairs) == sorted(set(pairs))
