"""Registered queries over the test tables, each paired with a DuckDB oracle when the
result is SQL-expressible.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
Oracle SQL is written independently (brute force where that is simpler) against the
same canonical derivations (``testmap.CTE``). Column names and types match.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from rankfold.operators import dictionary, graph, keyed, people, popularity, recommend, similarity, tags, text
from rankfold.session import scratch_path
from rankfold.sources import checked, readers, sinks
from rankfold.functions import epoch_seconds, latest_per_key, literal_rows
from rankfold.functions import sql as sql_functions
from rankfold.plans import testmap as tm
from rankfold.plans.testmap import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered queries (fixed for the test tables).
TOP_N = 10
MIN_COUNT = 30
TAG = "red"
MIN_KIND = "purchase"   # plays TMIN
MAX_KIND = "view"       # plays TMAX
SEP = tm.TAG_SEPARATOR


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _exploded_tags_sql() -> str:
    return f"SELECT item_id, unnest(string_split(tags, '{SEP}')) AS tag FROM items"


# ---------------------------------------------------------------- keyed

@register("rating_histogram", with_ctes(["purchases"],
          "SELECT rating, count(*) AS n FROM purchases GROUP BY rating"))
def q_rating_histogram(spark, d):
    return keyed.value_histogram(tm.purchases_df(spark, d), "rating", "n")


@register("int_avg_by_key", with_ctes(["people"],
          "SELECT name, CAST(sum(num_friends) // count(num_friends) AS BIGINT) AS avg_friends "
          "FROM people GROUP BY name"))
def q_int_avg_by_key(spark, d):
    return keyed.int_avg_by_key(tm.people_df(spark, d), "name", "num_friends", "avg_friends")


_MIN_H_SQL = (f"SELECT station, CAST(round(min(value) * CAST(18 AS DOUBLE) + CAST(3200 AS DOUBLE)) AS BIGINT) AS h "
              f"FROM readings WHERE type = '{MIN_KIND}' GROUP BY station")
_LABEL_SQL = "printf('%s%d.%02d F', CASE WHEN h < 0 THEN '-' ELSE '' END, abs(h) // 100, abs(h) % 100)"
_MIN_READ_SQL = with_ctes(["readings"], f"SELECT station, CAST(h AS DOUBLE) / CAST(100 AS DOUBLE) AS min_temp, "
                          f"{_LABEL_SQL} AS label FROM h", [("h", _MIN_H_SQL)])


@register("min_reading_by_station", _MIN_READ_SQL)
def q_min_reading_by_station(spark, d):
    return keyed.min_reading_by_station(tm.readings_df(spark, d), MIN_KIND)


@register("max_reading_by_station", with_ctes(["readings"],
          f"SELECT station, max(value) AS max_value FROM readings WHERE type = '{MAX_KIND}' GROUP BY station"))
def q_max_reading_by_station(spark, d):
    return keyed.max_reading_by_station(tm.readings_df(spark, d), MAX_KIND)


@register("spend_by_customer", with_ctes(["spend"],
          "SELECT customer, round(sum(amount), 2) AS total FROM spend GROUP BY customer"))
def q_spend_by_customer(spend_spark, d):
    return keyed.spend_by_customer(tm.spend_df(spend_spark, d))


# ---------------------------------------------------------------- people

@register("people_names", with_ctes(["people"], "SELECT name FROM people"))
def q_people_names(spark, d):
    return people.names(tm.people_df(spark, d))


@register("people_under_21", with_ctes(["people"], "SELECT * FROM people WHERE age < 21"))
def q_people_under_21(spark, d):
    return people.under_age(tm.people_df(spark, d), 21)


@register("people_by_age", with_ctes(["people"], "SELECT age, count(*) AS n FROM people GROUP BY age"))
def q_people_by_age(spark, d):
    return people.count_by_age(tm.people_df(spark, d))


@register("people_age_plus_10", with_ctes(["people"],
          "SELECT name, CAST(age + 10 AS INTEGER) AS age_plus_10 FROM people"))
def q_people_age_plus_10(spark, d):
    return people.age_plus(tm.people_df(spark, d), 10)


@register("people_teens_sql", with_ctes(["people"], "SELECT * FROM people WHERE age BETWEEN 13 AND 19"))
def q_people_teens_sql(spark, d):
    return people.teens_sql(tm.people_df(spark, d))


# ---------------------------------------------------------------- text

def _tokens_sql(line: str, strip_re: str, split_expr: str) -> str:
    stripped = f"regexp_replace({line}, '{strip_re}', '')"
    return (f"CASE WHEN {line} <> '' AND {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE {split_expr.format(s=stripped)} END")


_SPACE_TOKENS = _tokens_sql("line", r"(?: )+\z", "string_split({s}, ' ')")
_WORD_TOKENS = _tokens_sql("line", r"\W+\z", r"regexp_split_to_array({s}, '\W+')")
_STOP_SQL = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


@register("word_count_space", with_ctes(["lines"],
          f"SELECT word, count(*) AS n FROM (SELECT unnest({_SPACE_TOKENS}) AS word FROM lines) GROUP BY word"))
def q_word_count_space(spark, d):
    return text.word_count(tm.lines_df(spark, d), text.SPACE)


@register("word_count_regex", with_ctes(["lines"],
          "SELECT word, count(*) AS n FROM (SELECT lower(w) AS word FROM "
          f"(SELECT unnest({_WORD_TOKENS}) AS w FROM lines)) GROUP BY word"))
def q_word_count_regex(spark, d):
    return text.word_count(tm.lines_df(spark, d), text.NON_WORD, lower=True)


@register("word_count_sorted", with_ctes(["lines"],
          "SELECT word, count(*) AS n FROM (SELECT lower(w) AS word FROM "
          f"(SELECT unnest({_WORD_TOKENS}) AS w FROM lines)) WHERE word NOT IN ({_STOP_SQL}) "
          "GROUP BY word ORDER BY n DESC, word"))
def q_word_count_sorted(spark, d):
    return text.word_count(tm.lines_df(spark, d), text.NON_WORD, lower=True,
                           stop_words=text.STOP_WORDS, sort=True)


# ---------------------------------------------------------------- popularity

@register("item_popularity", with_ctes(["purchases"],
          "SELECT item_id, count(*) AS n_ratings FROM purchases GROUP BY item_id"))
def q_item_popularity(spark, d):
    return popularity.item_popularity(tm.purchases_df(spark, d))


@register("item_popularity_named", with_ctes(["purchases", "items"],
          "SELECT c.item_id, i.name, c.n_ratings FROM "
          "(SELECT item_id, count(*) AS n_ratings FROM purchases GROUP BY item_id) c JOIN items i USING (item_id)"))
def q_item_popularity_named(spark, d):
    return popularity.item_popularity_named(tm.purchases_df(spark, d), tm.items_df(spark, d))


def _top_sql(direction: str) -> str:
    return with_ctes(["purchases", "items"], f"""
SELECT c.item_id, i.name, c.n_ratings FROM
  (SELECT item_id, count(*) AS n_ratings FROM purchases GROUP BY item_id
   ORDER BY n_ratings {direction}, item_id ASC LIMIT {TOP_N}) c
JOIN items i USING (item_id)""")


@register("top_items", _top_sql("DESC"))
def q_top_items(spark, d):
    return popularity.top_items(tm.purchases_df(spark, d), tm.items_df(spark, d), TOP_N)


@register("top_items_lookup", _top_sql("DESC"))
def q_top_items_lookup(spark, d):
    # names by point lookups in a stored dictionary; a user writes it once
    names = spark.read.parquet(dictionary.write_dictionary(tm.items_df(spark, d), scratch_path(spark, "item_names")))
    order = (F.col("n_ratings").desc(), F.col("item_id").asc())
    top = popularity.item_counts(tm.purchases_df(spark, d)).orderBy(*order).limit(TOP_N)
    return dictionary.named(top, names, TOP_N, *order).select("item_id", "name", "n_ratings")


@register("most_connected_lookup", with_ctes(["entries", "node_names"], """
SELECT g.node, n.name, g.degree FROM
  (SELECT node, degree FROM (SELECT m.node, CAST(count(e.dst) AS BIGINT) AS degree
     FROM (SELECT DISTINCT node FROM incidence) m LEFT JOIN entries e ON e.src = m.node GROUP BY m.node)
   ORDER BY degree DESC, node DESC LIMIT 1) g JOIN node_names n USING (node)"""))
def q_most_connected_lookup(spark, d):
    names = spark.read.parquet(dictionary.write_dictionary(tm.node_names_df(spark, d), scratch_path(spark, "node_names"), "node"))
    degrees = graph.cooccurrence_degree(tm.incidence_df(spark, d))
    top = degrees.orderBy(F.col("degree").desc(), F.col("node").desc()).limit(1)
    return dictionary.named(top, names, 1, key="node").select("node", "name", "degree")


@register("bottom_items", _top_sql("ASC"))
def q_bottom_items(spark, d):
    return popularity.bottom_items(tm.purchases_df(spark, d), tm.items_df(spark, d), TOP_N)


def _top_rated_sql(where: str) -> str:
    return with_ctes(["purchases", "items"], f"""
SELECT s.item_id, i.name, round(s.avg_rating, 6) AS avg_rating, s.n_ratings FROM
  (SELECT item_id, avg(rating) AS avg_rating, count(*) AS n_ratings FROM purchases {where}
   GROUP BY item_id HAVING count(*) > {MIN_COUNT}
   ORDER BY avg_rating DESC, item_id ASC LIMIT {TOP_N}) s
JOIN items i USING (item_id)""")


@register("top_rated_items", _top_rated_sql(""))
def q_top_rated_items(spark, d):
    return popularity.top_rated_items(tm.purchases_df(spark, d), tm.items_df(spark, d), MIN_COUNT, TOP_N)


@register("top_rated_items_in_tag", _top_rated_sql(
    f"WHERE item_id IN (SELECT item_id FROM items WHERE list_contains(string_split(tags, '{SEP}'), '{TAG}'))"))
def q_top_rated_items_in_tag(spark, d):
    return popularity.top_rated_items_in_tag(tm.purchases_df(spark, d), tm.items_df(spark, d),
                                             TAG, MIN_COUNT, TOP_N, SEP)


# ---------------------------------------------------------------- tags

@register("rating_tag_pairs", with_ctes(["purchases", "items"],
          "SELECT p.rating, t.tag FROM purchases p JOIN t USING (item_id)",
          [("t", _exploded_tags_sql())]))
def q_rating_tag_pairs(spark, d):
    return tags.rating_tag_pairs(tm.purchases_df(spark, d), tm.items_df(spark, d), SEP)


@register("first_rating_tag_pairs", with_ctes(["purchases", "items"],
          f"SELECT p.rating, t.tag FROM purchases p JOIN t USING (item_id) ORDER BY rating DESC, tag LIMIT {TOP_N}",
          [("t", _exploded_tags_sql())]))
def q_first_rating_tag_pairs(spark, d):
    return tags.rating_tag_pairs(tm.purchases_df(spark, d), tm.items_df(spark, d), SEP, n=TOP_N)


@register("unmatched_items", with_ctes(["ratings", "items"],
          "SELECT count(DISTINCT r.item_id) AS n_items, count(*) AS n_ratings FROM ratings r "
          "WHERE r.item_id NOT IN (SELECT item_id FROM items)"))
def q_unmatched_items(spark, d):
    return popularity.unmatched_items(tm.ratings_df(spark, d), tm.items_df(spark, d))


_TAG_RATINGS = "SELECT tag, count(*) AS n_ratings FROM purchases JOIN t USING (item_id) GROUP BY tag"
_TAG_ITEMS = "SELECT tag, count(*) AS n_items FROM t GROUP BY tag"


@register("tag_rating_counts", with_ctes(["purchases", "items"],
          "SELECT row_number() OVER (ORDER BY n_ratings DESC, tag) AS rank, tag, n_ratings FROM r",
          [("t", _exploded_tags_sql()), ("r", _TAG_RATINGS)]))
def q_tag_rating_counts(spark, d):
    return tags.tag_rating_counts(tm.purchases_df(spark, d), tm.items_df(spark, d), SEP)


@register("tag_item_counts", with_ctes(["items"],
          "SELECT row_number() OVER (ORDER BY n_items DESC, tag) AS rank, tag, n_items FROM c",
          [("t", _exploded_tags_sql()), ("c", _TAG_ITEMS)]))
def q_tag_item_counts(spark, d):
    return tags.tag_item_counts(tm.items_df(spark, d), SEP)


@register("tag_popularity", with_ctes(["purchases", "items"], """
SELECT row_number() OVER (ORDER BY r.n_ratings DESC, r.tag) AS rank, r.tag, r.n_ratings, c.n_items,
       r.n_ratings // c.n_items AS ratio
FROM r JOIN c USING (tag)""", [("t", _exploded_tags_sql()), ("r", _TAG_RATINGS), ("c", _TAG_ITEMS)]))
def q_tag_popularity(spark, d):
    return tags.tag_popularity(tm.purchases_df(spark, d), tm.items_df(spark, d), SEP)


# ---------------------------------------------------------------- similarity

SIM_ITEM = 0
SIM_MIN_SCORE = 0.5
SIM_MIN_PAIRS = 30

_PAIRS_SQL = """SELECT CAST(a.item_id AS BIGINT) AS item1, CAST(b.item_id AS BIGINT) AS item2,
       sum(a.rating * b.rating) AS sxy, sum(a.rating * a.rating) AS sxx, sum(b.rating * b.rating) AS syy,
       count(*) AS n_pairs
FROM ratings_unique a JOIN ratings_unique b ON a.user_id = b.user_id AND a.item_id < b.item_id
GROUP BY a.item_id, b.item_id"""
_SCORE_SQL = ("round(CASE WHEN sqrt(sxx) * sqrt(syy) <> 0 THEN sxy / (sqrt(sxx) * sqrt(syy)) "
              "ELSE 0.0 END, 6)")


@register("item_similarity", with_ctes(["ratings_unique"],
          f"SELECT item1, item2, {_SCORE_SQL} AS score, n_pairs FROM p", [("p", _PAIRS_SQL)]))
def q_item_similarity(spark, d):
    return similarity.item_similarity(tm.ratings_unique_df(spark, d))


@register("similar_items", with_ctes(["ratings_unique", "items"], f"""
SELECT CAST(s.item_id AS BIGINT) AS item_id, i.name, s.score, s.n_pairs FROM
  (SELECT CASE WHEN item1 = {SIM_ITEM} THEN item2 ELSE item1 END AS item_id, {_SCORE_SQL} AS score, n_pairs
   FROM p WHERE (item1 = {SIM_ITEM} OR item2 = {SIM_ITEM}) AND {_SCORE_SQL} > {SIM_MIN_SCORE}
     AND n_pairs > {SIM_MIN_PAIRS}
   ORDER BY score DESC, n_pairs DESC, item_id LIMIT {TOP_N}) s
JOIN items i ON i.item_id = s.item_id""", [("p", _PAIRS_SQL)]))
def q_similar_items(spark, d):
    return similarity.similar_items(tm.ratings_unique_df(spark, d), tm.items_df(spark, d), SIM_ITEM,
                                    SIM_MIN_SCORE, SIM_MIN_PAIRS, TOP_N)


@register("similar_items_exact", ORACLE["similar_items"])
def q_similar_items_exact(spark, d):
    # order-independent sums: the same scores, bit for bit, under any partitioning
    return similarity.similar_items(tm.ratings_unique_df(spark, d), tm.items_df(spark, d), SIM_ITEM,
                                    SIM_MIN_SCORE, SIM_MIN_PAIRS, TOP_N, exact=True)


# ---------------------------------------------------------------- SQL functions

@register("sql_similar_items", ORACLE["similar_items"])
def q_sql_similar_items(spark, d):
    sql_functions.register(spark)
    return spark.sql("""
SELECT CAST(s.item_id AS BIGINT) AS item_id, i.name, s.score, s.n_pairs FROM (
  SELECT item_id, round(rf_cosine(sxy, sxx, syy), 6) AS score, n_pairs FROM (
    SELECT o.item_id, sum(x.rating * o.rating) AS sxy, sum(x.rating * x.rating) AS sxx, sum(o.rating * o.rating) AS syy,
           count(*) AS n_pairs
    FROM {r} x JOIN {r} o ON o.user_id = x.user_id AND o.item_id <> x.item_id
    WHERE x.item_id = :item GROUP BY o.item_id)) s
JOIN {i} i ON i.item_id = s.item_id
WHERE s.score > :score AND s.n_pairs > :pairs ORDER BY s.score DESC, s.n_pairs DESC, item_id LIMIT 10""",
                     args={"item": SIM_ITEM, "score": SIM_MIN_SCORE, "pairs": SIM_MIN_PAIRS},
                     r=tm.ratings_unique_df(spark, d), i=tm.items_df(spark, d))


@register("sql_word_count", ORACLE["word_count_regex"])
def q_sql_word_count(spark, d):
    sql_functions.register(spark)
    return spark.sql("SELECT lower(token) AS word, count(*) AS n FROM {l}, LATERAL rf_tokens(line) GROUP BY lower(token)", l=tm.lines_df(spark, d))


@register("sql_split_counts", with_ctes(["ratings"], """
SELECT CASE WHEN t % 10 < 6 THEN 'train' WHEN t % 10 < 8 THEN 'validation' ELSE 'test' END AS split, count(*) AS n
FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS t FROM ratings) GROUP BY 1"""))
def q_sql_split_counts(spark, d):
    # over the lines of a ratings file, parsed in SQL
    sql_functions.register(spark)
    r = tm.ratings_df(spark, d)
    line = F.concat_ws("::", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.col("rating").cast("string"),
                       epoch_seconds(r, "ts").cast("string"))
    lines = readers.read_lines(spark, sinks.write_lines(r.select(line.alias("line")), scratch_path(spark, "ratings_lines")))
    return spark.sql("SELECT rf_split(rf_bucket(ts)) AS split, count(*) AS n FROM {l}, LATERAL rf_rating(line, '::') GROUP BY 1", l=lines)


# ---------------------------------------------------------------- graph

BFS_START = 0
BFS_TARGET = 1

_DEGREE_SQL = """SELECT m.node, CAST(count(e.dst) AS BIGINT) AS degree
FROM (SELECT DISTINCT node FROM incidence) m LEFT JOIN entries e ON e.src = m.node GROUP BY m.node"""
def _bfs_ctes(entries: str, start: int) -> list[tuple[str, str]]:
    """Distance of every node that ``start`` reaches; each node is entered once."""
    return [
        ("e", f"SELECT DISTINCT src, dst FROM {entries}"),
        ("bfs(node, d) USING KEY (node)",
         f"SELECT CAST({start} AS BIGINT), 0 UNION SELECT e.dst, min(bfs.d) + 1 FROM bfs JOIN e ON e.src = bfs.node "
         "LEFT JOIN recurring.bfs r ON r.node = e.dst WHERE r.node IS NULL GROUP BY e.dst"),
        ("dist", "SELECT node, d AS dist FROM bfs"),
    ]


_BFS_CTES = _bfs_ctes("entries", BFS_START)


def _separation_sql(entries: str, target: int) -> str:
    return f"""
SELECT CAST(lvl + 1 AS INTEGER) AS degree, CAST(hits AS BIGINT) AS hits FROM
  (SELECT dd.dist AS lvl, count(*) AS hits FROM {entries} en JOIN dist dd ON en.src = dd.node
   WHERE en.dst = {target} GROUP BY dd.dist)
ORDER BY lvl LIMIT 1"""


@register("node_degree", with_ctes(["entries"], _DEGREE_SQL))
def q_node_degree(spark, d):
    return graph.cooccurrence_degree(tm.incidence_df(spark, d))


@register("most_connected", with_ctes(["entries", "node_names"], """
SELECT g.node, n.name, g.degree FROM
  (SELECT node, degree FROM g ORDER BY degree DESC, node DESC LIMIT 1) g JOIN node_names n USING (node)""",
          [("g", _DEGREE_SQL)]))
def q_most_connected(spark, d):
    return graph.most_connected(graph.cooccurrence_degree(tm.incidence_df(spark, d)), tm.node_names_df(spark, d))


@register("top_connected", with_ctes(["entries", "node_names"], f"""
SELECT g.node, n.name, g.degree FROM
  (SELECT node, degree FROM g ORDER BY degree DESC, node DESC LIMIT {TOP_N}) g JOIN node_names n USING (node)""",
          [("g", _DEGREE_SQL)]))
def q_top_connected(spark, d):
    return graph.top_connected(graph.cooccurrence_degree(tm.incidence_df(spark, d)),
                               tm.node_names_df(spark, d), TOP_N)


@register("least_connected", with_ctes(["entries"],
          f"SELECT node, degree FROM g ORDER BY degree ASC, node ASC LIMIT {TOP_N}", [("g", _DEGREE_SQL)]))
def q_least_connected(spark, d):
    return graph.least_connected(graph.cooccurrence_degree(tm.incidence_df(spark, d)), TOP_N)


@register("degrees_of_separation", with_ctes(["entries"], _separation_sql("entries", BFS_TARGET), _BFS_CTES, recursive=True))
def q_degrees_of_separation(spark, d):
    return graph.cooccurrence_degrees_of_separation(tm.incidence_df(spark, d), BFS_START, BFS_TARGET)


@register("bfs_distances", with_ctes(["entries"],
          "SELECT node, CAST(dist AS INTEGER) AS dist FROM dist", _BFS_CTES, recursive=True))
def q_bfs_distances(spark, d):
    return graph.cooccurrence_bfs_distances(tm.incidence_df(spark, d), BFS_START)


# customers meet in their nation and in their market segment; a segment holds a fifth of
# all rows, far more than a bucket takes, so this search runs over salted buckets
CUSTOMER_ROWS_PER_BUCKET = 250
_CUSTOMER_GROUPS = """SELECT c_custkey AS node, CAST(c_nationkey AS BIGINT) AS grp FROM customer
        UNION ALL SELECT c_custkey, 1000 + ascii(c_mktsegment) FROM customer"""


@register("bfs_distances_customers", with_ctes([], "SELECT node, CAST(dist AS INTEGER) AS dist FROM dist",
          [("m", _CUSTOMER_GROUPS),
           ("pairs", "SELECT a.node AS src, b.node AS dst FROM m a JOIN m b ON a.grp = b.grp AND a.node <> b.node"),
           *_bfs_ctes("pairs", 1)], recursive=True))
def q_bfs_distances_customers(spark, d):
    c = tm.table(spark, d, "customer")
    groups = (c.select(F.col("c_custkey").alias("node"), F.col("c_nationkey").cast("long").alias("grp"))
              .unionByName(c.select(F.col("c_custkey").alias("node"), (1000 + F.ascii("c_mktsegment")).cast("long").alias("grp"))))
    return graph.cooccurrence_bfs_distances(groups, 1, rows_per_bucket=CUSTOMER_ROWS_PER_BUCKET)


# ---------------------------------------------------------------- recommendation

POOL_N = 50
SAMPLE_FRACTION = 0.2
SAMPLE_SEED = 0
HISTORY_USER = 8
RECS_N = 10
UNSEEN_N = 50
GRID = dict(ranks=(8, 12), regs=(0.1, 10.0), iters=(10, 20))

_POOL_SQL = (f"SELECT item_id, count(*) AS n_ratings FROM ratings GROUP BY item_id "
             f"ORDER BY n_ratings DESC, item_id ASC LIMIT {POOL_N}")


def _sample_sql(fraction: float) -> str:
    return (f"SELECT item_id FROM pool WHERE ('0x' || substr(md5(CAST(item_id AS VARCHAR) || ':{SAMPLE_SEED}'), 1, 8))"
            f"::BIGINT < {int(round(fraction * 2 ** 32))} AND item_id IN (SELECT item_id FROM items)")


_SAMPLE_SQL = _sample_sql(SAMPLE_FRACTION)
_BUCKET = "(CAST(floor(epoch(ts)) AS BIGINT) % 10)"
_REC_CTES = [
    ("pool", _POOL_SQL),
    ("sample", _SAMPLE_SQL),
    ("supplied", "SELECT (SELECT max(user_id) + 1 FROM ratings_unique) AS user_id, item_id, "
                 "CAST(item_id % 6 AS DOUBLE) AS rating FROM sample"),
    ("train", f"SELECT user_id, item_id, rating FROM ratings_unique WHERE {_BUCKET} < 6 UNION ALL "
              "SELECT user_id, item_id, rating FROM supplied WHERE rating BETWEEN 1 AND 5"),
    ("validation", f"SELECT user_id, item_id, rating FROM ratings_unique WHERE {_BUCKET} BETWEEN 6 AND 7"),
    ("test", f"SELECT user_id, item_id, rating FROM ratings_unique WHERE {_BUCKET} >= 8"),
]


def _pool(spark, d):
    return recommend.most_rated_pool(tm.ratings_df(spark, d), POOL_N)


def _sample(spark, d):
    return recommend.elicitation_sample(_pool(spark, d), tm.items_df(spark, d), SAMPLE_FRACTION, SAMPLE_SEED)


def _supplied(spark, d):
    """The new user's answers, derived from the data: the sampled items rated item_id % 6
    (0 = not seen) under a fresh user id."""
    uid = recommend.next_user_id(tm.ratings_df(spark, d))
    return _sample(spark, d).select(F.lit(uid).cast("long").alias("user_id"),
                                    F.col("item_id").cast("int").alias("item_id"),
                                    (F.col("item_id") % 6).cast("double").alias("rating"))


def _labelled(spark, d):
    """Every rating with its split, the new user's answers in train (one pass, no re-read)."""
    labelled = recommend.with_split(tm.ratings_unique_df(spark, d), "68").select("user_id", "item_id", "rating", "split")
    kept = _supplied(spark, d).filter(F.col("rating").between(1, 5))
    return labelled.unionByName(kept.withColumn("split", F.lit(recommend.TRAIN)))


def _splits(spark, d):
    labelled = _labelled(spark, d)
    path = recommend.write_splits(labelled, scratch_path(spark, "splits"))
    return tuple(recommend.read_split(spark, path, s, labelled.schema)
                 for s in (recommend.TRAIN, recommend.VALIDATION, recommend.TEST))


@register("rating_summary", with_ctes(["ratings"],
          "SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items "
          "FROM ratings"))
def q_rating_summary(spark, d):
    return recommend.rating_summary(tm.ratings_df(spark, d))


@register("most_rated_pool", with_ctes(["ratings"], _POOL_SQL))
def q_most_rated_pool(spark, d):
    return _pool(spark, d)


@register("elicitation_sample", with_ctes(["ratings", "items"],
          "SELECT CAST(s.item_id AS BIGINT) AS item_id, i.name FROM sample s JOIN items i ON i.item_id = s.item_id",
          _REC_CTES[:2]))
def q_elicitation_sample(spark, d):
    return _sample(spark, d)


@register("elicitation_sample_100", with_ctes(["ratings", "items"],
          "SELECT CAST(s.item_id AS BIGINT) AS item_id, i.name FROM sample s JOIN items i ON i.item_id = s.item_id",
          [("pool", _POOL_SQL.replace(f"LIMIT {POOL_N}", "LIMIT 100")), ("sample", _sample_sql(0.1))]))
def q_elicitation_sample_100(spark, d):
    pool = recommend.most_rated_pool(tm.ratings_df(spark, d), 100)
    return recommend.elicitation_sample(pool, tm.items_df(spark, d), 0.1, SAMPLE_SEED)


def _split_counts_sql(train: str, val: str) -> str:
    return with_ctes(["ratings_unique"], f"""
SELECT CASE WHEN {train} THEN 'train' WHEN {val} THEN 'validation' ELSE 'test' END AS split, count(*) AS n
FROM ratings_unique GROUP BY 1""")


@register("split_counts_68", _split_counts_sql(f"{_BUCKET} < 6", f"{_BUCKET} < 8"))
def q_split_counts_68(spark, d):
    return recommend.split_counts(tm.ratings_unique_df(spark, d), "68")


@register("split_counts_24", _split_counts_sql(f"{_BUCKET} >= 4", f"{_BUCKET} >= 2"))
def q_split_counts_24(spark, d):
    return recommend.split_counts(tm.ratings_unique_df(spark, d), "24")


@register("add_user_ratings", with_ctes(["ratings_unique", "items"],
          "SELECT user_id, item_id, rating FROM train", _REC_CTES))
def q_add_user_ratings(spark, d):
    old = recommend.with_split(tm.ratings_unique_df(spark, d), "68").filter(F.col("split") == recommend.TRAIN)
    return recommend.add_user_ratings(old, _supplied(spark, d))


@register("add_user_answers", with_ctes(["ratings_unique", "items"],
          "SELECT user_id, item_id, rating FROM train", _REC_CTES))
def q_add_user_answers(spark, d):
    """As ``add_user_ratings``, the answers given as a collection on the driver: one for each item of
    the sample, which is cut from a pool of ``POOL_N`` items."""
    old = recommend.with_split(tm.ratings_unique_df(spark, d), "68").filter(F.col("split") == recommend.TRAIN)
    answers = [(r["item_id"], r["item_id"] % 6) for r in _sample(spark, d).collect()]
    return recommend.add_user_ratings(old, recommend.supplied_ratings(spark, recommend.next_user_id(tm.ratings_df(spark, d)), answers))


@register("user_history", with_ctes(["ratings_unique", "items"],
          f"SELECT r.item_id, i.name, r.rating FROM ratings_unique r JOIN items i ON i.item_id = r.item_id "
          f"WHERE r.user_id = {HISTORY_USER}"))
def q_user_history(spark, d):
    return recommend.user_history(tm.ratings_unique_df(spark, d), tm.items_df(spark, d), HISTORY_USER)


@register("mean_baseline_rmse", with_ctes(["ratings_unique", "items"], """
SELECT round(sqrt(avg(power((SELECT avg(rating) FROM (SELECT rating FROM train UNION ALL
                                                       SELECT rating FROM validation)) - rating, 2))), 6)
       AS baseline_rmse FROM test""", _REC_CTES))
def q_mean_baseline_rmse(spark, d):
    return recommend.mean_baseline(_labelled(spark, d)).select(F.round("baseline_rmse", 6).alias("baseline_rmse"))


# A deterministic predictor, the item's mean rating in train (shrunk towards the mean of
# train by ``k`` imaginary ratings), runs the same steps as ALS and can be checked in SQL.
SHRINK = (0.0, 5.0, 50.0)


def _item_mean_sql(k: str) -> str:
    return (f"(SELECT item_id, (sum(rating) + {k} * (SELECT avg(rating) FROM train)) / (count(*) + {k}) AS prediction "
            "FROM train GROUP BY item_id)")


def _mean_rmse_sql(split: str, k: str) -> str:
    return (f"(SELECT sqrt(sum(CASE WHEN p.prediction IS NOT NULL THEN power(p.prediction - t.rating, 2) END) / count(*)) "
            f"FROM {split} t LEFT JOIN {_item_mean_sql(k)} p USING (item_id))")


_GRID_SQL = " UNION ALL ".join(f"SELECT {i} AS pos, CAST({k} AS DOUBLE) AS k, {_mean_rmse_sql('validation', k)} AS rmse"
                               for i, k in enumerate(SHRINK))


@register("item_mean_rmse", with_ctes(["ratings_unique", "items"],
          f"SELECT round({_mean_rmse_sql('test', '5.0')}, 6) AS test_rmse", _REC_CTES))
def q_item_mean_rmse(spark, d):
    train, _, test = _splits(spark, d)
    scored = recommend.item_mean_scored(train, test, 5.0)
    return recommend.rmse_frame(scored).select(F.round("rmse", 6).alias("test_rmse"))


@register("item_mean_grid", with_ctes(["ratings_unique", "items"],
          "SELECT k, round(rmse, 6) AS validation_rmse, pos = (SELECT pos FROM g ORDER BY rmse, pos LIMIT 1) AS best FROM g",
          [*_REC_CTES, ("g", _GRID_SQL)]))
def q_item_mean_grid(spark, d):
    train, validation, _ = _splits(spark, d)
    rows, best = recommend.grid_choice(SHRINK, lambda k: recommend.rmse_scored(recommend.item_mean_scored(train, validation, k)))
    return literal_rows(spark, [("k", "double"), ("validation_rmse", "double"), ("best", "boolean")],
                        [(k, round(v, 6), i == best) for i, (k, v) in enumerate(rows)])


@register("item_mean_improvement", with_ctes(["ratings_unique", "items"], f"""
SELECT round(base, 6) AS baseline_rmse, round(rmse, 6) AS test_rmse,
  CASE WHEN base <> 0 THEN round((base - rmse) / base * 100, 2) END AS improvement_pct FROM
  (SELECT {_mean_rmse_sql('test', '5.0')} AS rmse, (SELECT sqrt(avg(power((SELECT avg(rating) FROM
     (SELECT rating FROM train UNION ALL SELECT rating FROM validation)) - rating, 2))) FROM test) AS base)""", _REC_CTES))
def q_item_mean_improvement(spark, d):
    train, val, test = _splits(spark, d)
    rmse = recommend.rmse_scored(recommend.item_mean_scored(train, test, 5.0))
    base = recommend.mean_baseline_rmse(train, val, test).first()[0]
    return literal_rows(spark, [("baseline_rmse", "double"), ("test_rmse", "double"), ("improvement_pct", "double")],
                        [(round(base, 6), round(rmse, 6), recommend.improvement_pct(base, rmse))])


@register("item_mean_unseen", with_ctes(["ratings_unique", "items"], f"""
SELECT row_number() OVER (ORDER BY prediction DESC, item_id) AS rank, item_id, name, round(prediction, 6) AS prediction FROM
  (SELECT CAST(i.item_id AS BIGINT) AS item_id, i.name, p.prediction FROM items i JOIN {_item_mean_sql('5.0')} p ON p.item_id = i.item_id
   WHERE i.item_id NOT IN (SELECT item_id FROM train WHERE user_id = {HISTORY_USER})
   ORDER BY prediction DESC, item_id LIMIT {RECS_N})""", _REC_CTES))
def q_item_mean_unseen(spark, d):
    train, _, _ = _splits(spark, d)
    items = tm.items_df(spark, d)
    scored = recommend.item_mean_scored(train, recommend.unseen_items(items, train, HISTORY_USER), 5.0)
    out = recommend.top_scored(items, scored.filter("prediction IS NOT NULL"), RECS_N)
    return out.select(F.col("rank").cast("long").alias("rank"), "item_id", "name", F.round("prediction", 6).alias("prediction"))


@register("item_mean_rmse_exact", ORACLE["item_mean_rmse"])
def q_item_mean_rmse_exact(spark, d):
    train, _, test = _splits(spark, d)
    scored = recommend.item_mean_scored(train, test, 5.0)
    return recommend.rmse_frame(scored, exact=True).select(F.round("rmse", 6).alias("test_rmse"))


# Fold-in against item factors that SQL has too, (1, mean / 10): a user's two factors are the
# solution of a 2 x 2 system over the user's ratings in validation.
FOLD_REG = 0.1


@register("fold_in_users", with_ctes(["ratings_unique", "items"], f"""
SELECT user_id, round((d * (c + k) - b * e) / ((a + k) * (c + k) - b * b), 6) AS x0,
       round(((a + k) * e - b * d) / ((a + k) * (c + k) - b * b), 6) AS x1 FROM
  (SELECT v.user_id, CAST(count(*) AS DOUBLE) AS a, {FOLD_REG} * count(*) AS k, sum(m) AS b, sum(m * m) AS c,
          sum(rating) AS d, sum(rating * m) AS e
   FROM validation v JOIN (SELECT item_id, avg(rating) / 10 AS m FROM train GROUP BY item_id) f USING (item_id) GROUP BY v.user_id)""",
          _REC_CTES))
def q_fold_in_users(spark, d):
    train, validation, _ = _splits(spark, d)
    means = train.groupBy("item_id").agg((F.avg("rating") / 10).alias("m"))
    factors = means.select(F.col("item_id").alias("id"), F.array(F.lit(1.0), "m").alias("features"))
    users = recommend.fold_in(factors, validation, FOLD_REG)
    return users.select("user_id", *[F.round(F.get("features", F.lit(i)), 6).alias(f"x{i}") for i in (0, 1)])


# ALS results are not bitwise comparable with another engine: rows-only checks here,
# properties in tests/test_recommend.py. As in the reference, predictions, test RMSE,
# improvement and unseen items come from the model that the grid search chose on validation;
# each query fits its own grid. Only the keys of predictions, which no setting changes, take
# one setting.
ALS_SETTING = dict(rank=8, max_iter=10, reg=0.1)


def _best_model(train, val):
    return recommend.als_grid_search(train, val, **GRID).model


@register("als_grid_search")
def q_als_grid_search(spark, d):
    train, val, _ = _splits(spark, d)
    return recommend.grid_frame(spark, recommend.als_grid_search(train, val, **GRID))


# the single setting and the two-rank grid that the reference uses for its larger files
@register("als_grid_single")
def q_als_grid_single(spark, d):
    train, val, _ = _splits(spark, d)
    return recommend.grid_frame(spark, recommend.als_grid_search(train, val, (8,), (0.01,), (20,)))


@register("als_grid_ranks")
def q_als_grid_ranks(spark, d):
    train, val, _ = _splits(spark, d)
    return recommend.grid_frame(spark, recommend.als_grid_search(train, val, (8, 12), (0.1,), (20,)))


@register("als_predict")
def q_als_predict(spark, d):
    train, val, test = _splits(spark, d)
    return recommend.als_predict(_best_model(train, val), test)


@register("als_predict_keys", with_ctes(["ratings_unique", "items"],
          "SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id FROM test "
          "WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)", _REC_CTES))
def q_als_predict_keys(spark, d):
    train, _, test = _splits(spark, d)
    return recommend.als_predict(recommend.fit_als(train, **ALS_SETTING), test).select("user_id", "item_id")


@register("als_rmse")
def q_als_rmse(spark, d):
    train, val, test = _splits(spark, d)
    return literal_rows(spark, [("test_rmse", "double")], [(recommend.rmse_value(_best_model(train, val), test),)])


@register("als_improvement")
def q_als_improvement(spark, d):
    train, val, test = _splits(spark, d)
    model_rmse = recommend.rmse_value(_best_model(train, val), test)
    base = recommend.mean_baseline_rmse(train, val, test).first()[0]
    return literal_rows(spark, [("baseline_rmse", "double"), ("test_rmse", "double"), ("improvement_pct", "double")],
                        [(base, model_rmse, recommend.improvement_pct(base, model_rmse))])


@register("als_recommend_unseen")
def q_als_recommend_unseen(spark, d):
    train, val, _ = _splits(spark, d)
    uid = recommend.next_user_id(tm.ratings_df(spark, d))
    return recommend.recommend_unseen(_best_model(train, val), tm.items_df(spark, d), train, uid, UNSEEN_N)


@register("als_new_user")
def q_als_new_user(spark, d):
    """The new user's items from a model that was fitted without that user: no refit."""
    ratings = tm.ratings_unique_df(spark, d)
    model = recommend.fit_als(recommend.with_split(ratings, "68").filter(F.col("split") == recommend.TRAIN), **ALS_SETTING)
    uid = recommend.next_user_id(tm.ratings_df(spark, d))
    return recommend.recommend_new_user(model.itemFactors, tm.items_df(spark, d), _supplied(spark, d), uid, ALS_SETTING["reg"], UNSEEN_N)


@register("als_report")
def q_als_report(spark, d):
    """One search, all its figures: the whole recommendation job as a user runs it."""
    report = recommend.recommend_report(*_splits(spark, d), tm.items_df(spark, d), recommend.next_user_id(tm.ratings_df(spark, d)), UNSEEN_N, **GRID)
    return recommend.report_frame(spark, report)


@register("als_recommend_user")
def q_als_recommend_user(spark, d):
    ratings = tm.ratings_unique_df(spark, d)
    model = recommend.fit_als(ratings, rank=8, max_iter=20, reg=0.01)
    return recommend.recommend_for_user(model, tm.items_df(spark, d), HISTORY_USER, RECS_N)


# ---------------------------------------------------------------- sources and sinks
# Each query writes a projection of the test tables in the source format to the shared
# scratch folder (under spark.checkpoint.dir) and reads it back through our reader.

ADJ_CHUNK = 1000  # bounds the length of one adjacency line; a node then spans lines


def _ratings_out(spark, d):
    r = tm.ratings_df(spark, d)
    return r.select(F.col("user_id").cast("int").alias("user_id"), "item_id", "rating",
                    epoch_seconds(r, "ts").alias("ts"))


_RATINGS_OUT_SQL = ("SELECT CAST(user_id AS INTEGER) AS user_id, item_id, rating, "
                    "CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM ratings")


def _csv(df, path, **opts):
    w = df.write.mode("overwrite")
    for k, v in opts.items():
        w = w.option(k, v)
    w.csv(path)
    return path


@register("src_lines", with_ctes(["lines"], "SELECT line FROM lines"))
def q_src_lines(spark, d):
    path = sinks.write_lines(tm.lines_df(spark, d), scratch_path(spark, "lines"))
    return readers.read_lines(spark, path)


@register("src_ratings_tab", with_ctes(["ratings"], _RATINGS_OUT_SQL))
def q_src_ratings_tab(spark, d):
    path = _csv(_ratings_out(spark, d), scratch_path(spark, "ratings_tab"), sep="\t")
    return readers.read_ratings(spark, path, "\t")


@register("src_ratings_colons", with_ctes(["ratings"], _RATINGS_OUT_SQL))
def q_src_ratings_colons(spark, d):
    path = _csv(_ratings_out(spark, d), scratch_path(spark, "ratings_colons"), sep="::")
    return readers.read_ratings(spark, path, "::")


@register("src_ratings_comma", with_ctes(["ratings"], _RATINGS_OUT_SQL))
def q_src_ratings_comma(spark, d):
    path = _csv(_ratings_out(spark, d), scratch_path(spark, "ratings_comma"), sep=",", header=True)
    return readers.read_ratings(spark, path, ",", header=True)


# ratings files in which some lines lost a field, got one more, or hold a word for a number
_DAMAGED_SQL = """SELECT CASE WHEN event_id % 50 = 0 THEN user_id || chr(9) || item_id || chr(9) || v
       WHEN event_id % 50 = 1 THEN user_id || chr(9) || item_id || chr(9) || v || chr(9) || t || chr(9) || 'x'
       WHEN event_id % 50 = 2 THEN 'user' || chr(9) || item_id || chr(9) || v || chr(9) || t
       ELSE user_id || chr(9) || item_id || chr(9) || v || chr(9) || t END AS line, event_id % 50 < 3 AS bad,
       CAST(user_id AS INTEGER) AS user_id, item_id, CAST(v AS DOUBLE) AS rating, t AS ts
FROM (SELECT event_id, user_id, item_id, CAST(floor(value) AS BIGINT) AS v, CAST(floor(epoch(ts)) AS BIGINT) AS t
      FROM (SELECT event_id, user_id, item_id, rating AS value, ts FROM ratings))"""


def _damaged_ratings(spark, d):
    r = tm.ratings_df(spark, d)
    fields = [F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.floor("rating").cast("string"),
              epoch_seconds(r, "ts").cast("string")]
    kind = F.col("event_id") % 50
    line = (F.when(kind == 0, F.concat_ws("\t", *fields[:3])).when(kind == 1, F.concat_ws("\t", *fields, F.lit("x")))
            .when(kind == 2, F.concat_ws("\t", F.lit("user"), *fields[1:])).otherwise(F.concat_ws("\t", *fields)))
    path = sinks.write_lines(r.select(line.alias("line")), scratch_path(spark, "ratings_damaged"))
    return checked.check_ratings(spark, path, "\t")


@register("checked_ratings", with_ctes(["ratings"], "SELECT user_id, item_id, rating, ts FROM f WHERE NOT bad", [("f", _DAMAGED_SQL)]))
def q_checked_ratings(spark, d):
    return _damaged_ratings(spark, d).rows


@register("rejected_ratings", with_ctes(["ratings"], "SELECT line FROM f WHERE bad", [("f", _DAMAGED_SQL)]))
def q_rejected_ratings(spark, d):
    return _damaged_ratings(spark, d).rejected


@register("checked_ratings_counts", with_ctes(["ratings"],
          "SELECT count(*) FILTER (NOT bad) AS n_rows, count(*) FILTER (bad) AS n_rejected FROM f", [("f", _DAMAGED_SQL)]))
def q_checked_ratings_counts(spark, d):
    found = _damaged_ratings(spark, d)
    return literal_rows(spark, [("n_rows", "long"), ("n_rejected", "long")], [(found.n_rows, found.n_rejected)])


@register("rejected_items_quoted", with_ctes([],
          """SELECT CASE WHEN p_partkey % 9 = 0 THEN p_partkey || ',"' || p_name || ', ' || p_brand || '"'
       ELSE 'x' || p_partkey || ',"' || p_name || ', ' || p_brand || '",' || p_type END AS line FROM part WHERE p_partkey % 9 < 2"""))
def q_rejected_items_quoted(spark, d):
    # quoted names with commas; every ninth line has no tags, every ninth no numeric id
    p = tm.table(spark, d, "part")
    name = F.format_string('"%s, %s"', "p_name", "p_brand")
    kind = F.col("p_partkey") % 9
    line = (F.when(kind == 0, F.concat_ws(",", F.col("p_partkey").cast("string"), name))
            .otherwise(F.concat(F.when(kind == 1, "x").otherwise(""), F.concat_ws(",", F.col("p_partkey").cast("string"), name, "p_type"))))
    path = sinks.write_lines(p.select(line.alias("line")), scratch_path(spark, "items_damaged"))
    return checked.check_items(spark, path, ",").rejected


@register("rejected_node_names", with_ctes(["node_names"],
          "SELECT CASE WHEN node % 7 = 0 THEN node || ' ' || name ELSE 'n' || node || ' \"' || name || '\"' END AS line "
          "FROM node_names WHERE node % 7 < 2"))
def q_rejected_node_names(spark, d):
    kind, node = F.col("node") % 7, F.col("node").cast("string")
    line = (F.when(kind == 0, F.concat(node, F.lit(" "), F.col("name")))
            .otherwise(F.concat(F.when(kind == 1, "n").otherwise(""), node, F.lit(' "'), F.col("name"), F.lit('"'))))
    path = sinks.write_lines(tm.node_names_df(spark, d).select(line.alias("line")), scratch_path(spark, "names_damaged"))
    return checked.check_node_names(spark, path).rejected


_FILE_CTES = [
    ("from_file", _RATINGS_OUT_SQL),
    ("latest", "SELECT user_id, item_id, rating, ts FROM from_file "
               "QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, rating DESC) = 1"),
]


def _ratings_from_file(spark, d):
    """Ratings as a user has them: a delimited file, read and reduced to the latest per (user, item)."""
    path = _csv(_ratings_out(spark, d), scratch_path(spark, "ratings_file"), sep="::")
    return latest_per_key(readers.read_ratings(spark, path, "::"), ["user_id", "item_id"], ["rating", "ts"])


@register("split_counts_from_file", with_ctes(["ratings"], """
SELECT CASE WHEN ts % 10 < 6 THEN 'train' WHEN ts % 10 < 8 THEN 'validation' ELSE 'test' END AS split, count(*) AS n
FROM latest GROUP BY 1""", _FILE_CTES))
def q_split_counts_from_file(spark, d):
    return recommend.split_counts(_ratings_from_file(spark, d), "68")


@register("baseline_rmse_from_file", with_ctes(["ratings"], """
SELECT round(sqrt(avg(power((SELECT avg(rating) FROM latest WHERE ts % 10 < 8) - rating, 2))), 6) AS baseline_rmse
FROM latest WHERE ts % 10 >= 8""", _FILE_CTES))
def q_baseline_rmse_from_file(spark, d):
    labelled = recommend.with_split(_ratings_from_file(spark, d), "68")
    return recommend.mean_baseline(labelled).select(F.round("baseline_rmse", 6).alias("baseline_rmse"))


@register("src_items_pipe", with_ctes(["items"], "SELECT CAST(item_id AS INTEGER) AS item_id, name FROM items"))
def q_src_items_pipe(spark, d):
    items = tm.items_df(spark, d)
    path = _csv(items, scratch_path(spark, "items_pipe"), sep="|", quote="\u0000")
    return readers.read_items(spark, path, "|")


@register("src_items_colons", with_ctes(["items"],
          "SELECT CAST(item_id AS INTEGER) AS item_id, name, replace(tags, ' ', '|') AS tags, "
          "name || ' <' || replace(tags, ' ', '|') || '>' AS label FROM items"))
def q_src_items_colons(spark, d):
    items = tm.items_df(spark, d).withColumn("tags", F.regexp_replace("tags", " ", "|"))
    path = _csv(items, scratch_path(spark, "items_colons"), sep="::", quote="\u0000")
    return readers.read_items(spark, path, "::")


@register("src_items_quoted", with_ctes(["items"],
          "SELECT CAST(i.item_id AS INTEGER) AS item_id, i.name || ', ' || p.p_brand || ' \"' || p.p_type || '\"' AS name, "
          "replace(i.tags, ' ', '|') AS tags FROM items i JOIN part p ON p.p_partkey = i.item_id"))
def q_src_items_quoted(spark, d):
    # names carrying commas and quotes, so the writer must quote and double quotes
    part = tm.table(spark, d, "part")
    items = part.select(F.col("p_partkey").alias("item_id"),
                        F.format_string('%s, %s "%s"', "p_name", "p_brand", "p_type").alias("name"),
                        F.regexp_replace("p_name", " ", "|").alias("tags"))
    path = _csv(items, scratch_path(spark, "items_quoted"), sep=",", quote='"', escape='"')
    return readers.read_items(spark, path, ",")


@register("src_people", with_ctes(["people"], "SELECT * FROM people"))
def q_src_people(spark, d):
    path = _csv(tm.people_df(spark, d), scratch_path(spark, "people"), lineSep="\r\n")
    return readers.read_people(spark, path)


@register("src_readings", with_ctes(["readings"], "SELECT station, type, value FROM readings"))
def q_src_readings(spark, d):
    ev = tm.table(spark, d, "events")
    out = ev.select(F.col("user_id").cast("string").alias("station"),
                    F.date_format("ts", "yyyyMMdd").alias("day"), F.col("event_type").alias("type"), "value")
    path = _csv(out, scratch_path(spark, "readings"))
    return readers.read_readings(spark, path)


@register("src_spend", with_ctes(["spend"], "SELECT customer, amount FROM spend"))
def q_src_spend(spark, d):
    o = tm.table(spark, d, "orders")
    out = o.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("item"),
                   F.col("o_totalprice").alias("amount"))
    path = _csv(out, scratch_path(spark, "spend"))
    return readers.read_spend(spark, path)


def _adjacency_lines(entries):
    """Lines ``node n1 n2 ...`` from (node, neighbour), one per node and id range of its
    neighbours, so no line is unbounded; such a node spans lines. The ids are dealt out before
    they are collected: nearly all lists are short, and partial lists cost more than ids."""
    return (entries.withColumn("chunk", F.floor(F.col("neighbour") / ADJ_CHUNK)).repartition("node", "chunk").groupBy("node", "chunk")
            .agg(F.sort_array(F.collect_list("neighbour")).alias("members"))
            .select(F.concat_ws(" ", F.col("node").cast("string"),
                                F.array_join(F.col("members").cast("array<string>"), " ")).alias("line")))


@register("src_adjacency", with_ctes(["incidence"],
          "SELECT grp AS node, CAST(count(*) AS BIGINT) AS degree FROM incidence GROUP BY grp"))
def q_src_adjacency(spark, d):
    inc = tm.incidence_df(spark, d).select(F.col("grp").alias("node"), F.col("node").alias("neighbour"))
    path = sinks.write_lines(_adjacency_lines(inc), scratch_path(spark, "adjacency"))
    return graph.adjacency_degree(readers.read_adjacency(spark, path))


# parts (even ids) list the orders (odd ids) they are in, and orders their parts
_LINE_ENTRIES = [("listed", "SELECT node * 2 AS src, grp * 2 + 1 AS dst FROM incidence "
                            "UNION ALL SELECT grp * 2 + 1, node * 2 FROM incidence")]
LINES_START, LINES_TARGET = 2 * BFS_START, 2 * BFS_TARGET


def _entries_from_lines(spark, d):
    inc = tm.incidence_df(spark, d)
    part, order = F.col("node") * 2, F.col("grp") * 2 + 1
    # both directions from one pass over the incidence
    both = inc.select(F.inline(F.array(F.struct(part.alias("node"), order.alias("neighbour")),
                                       F.struct(order.alias("node"), part.alias("neighbour")))))
    path = sinks.write_lines(_adjacency_lines(both), scratch_path(spark, "adjacency_lines"))
    return readers.adjacency_entries(readers.read_adjacency(spark, path))


@register("degrees_of_separation_lines", with_ctes(["incidence"], _separation_sql("listed", LINES_TARGET),
          [*_LINE_ENTRIES, *_bfs_ctes("listed", LINES_START)], recursive=True))
def q_degrees_of_separation_lines(spark, d):
    return graph.degrees_of_separation(_entries_from_lines(spark, d), LINES_START, LINES_TARGET)


@register("bfs_distances_lines", with_ctes(["incidence"], "SELECT node, CAST(dist AS INTEGER) AS dist FROM dist",
          [*_LINE_ENTRIES, *_bfs_ctes("listed", LINES_START)], recursive=True))
def q_bfs_distances_lines(spark, d):
    return graph.bfs_distances(_entries_from_lines(spark, d), LINES_START)


@register("src_node_names", with_ctes(["node_names"], "SELECT node, name FROM node_names"))
def q_src_node_names(spark, d):
    names = tm.node_names_df(spark, d)
    lines = sinks.format_lines(names, '%d "%s"', "node", "name")
    path = sinks.write_lines(lines, scratch_path(spark, "node_names"))
    return readers.read_node_names(spark, path)


@register("sink_tag_report", ORACLE["tag_popularity"])
def q_sink_tag_report(spark, d):
    report = tags.tag_popularity(tm.purchases_df(spark, d), tm.items_df(spark, d), SEP)
    path = sinks.write_tag_report(report, scratch_path(spark, "tag_report"))
    return sinks.read_tag_report(spark, path)


@register("sink_tag_report_file", ORACLE["tag_popularity"])
def q_sink_tag_report_file(spark, d):
    report = tags.tag_popularity(tm.purchases_df(spark, d), tm.items_df(spark, d), SEP)
    return sinks.read_tag_report(spark, sinks.write_tag_report_file(report, scratch_path(spark, "tag_report_file")))


@register("sink_similarities", ORACLE["item_similarity"])
def q_sink_similarities(spark, d):
    sims = similarity.item_similarity(tm.ratings_unique_df(spark, d))
    path = sinks.write_similarities(sims, scratch_path(spark, "similarities"))
    return spark.read.parquet(path)


@register("sink_similarities_text", with_ctes(["ratings_unique"], """
SELECT '(' || item1 || ',' || item2 || ')' || chr(9) || '(' || printf('%.6f', score) || ',' || n_pairs || ')' AS line FROM s""",
          [("p", _PAIRS_SQL), ("s", f"SELECT item1, item2, {_SCORE_SQL} AS score, n_pairs FROM p")]))
def q_sink_similarities_text(spark, d):
    sims = similarity.item_similarity(tm.ratings_unique_df(spark, d))
    return readers.read_lines(spark, sinks.write_similarities(sims, scratch_path(spark, "similarities_text"), "text"))


@register("formatted_min_readings", with_ctes(["readings"],
          f"SELECT printf('%s minimum temperature: %s', station, {_LABEL_SQL}) AS line FROM h", [("h", _MIN_H_SQL)]))
def q_formatted_min_readings(spark, d):
    mins = keyed.min_reading_by_station(tm.readings_df(spark, d), MIN_KIND)
    lines = sinks.format_lines(mins, "%s minimum temperature: %s", "station", "label")
    path = sinks.write_lines(lines, scratch_path(spark, "min_readings"))
    return readers.read_lines(spark, path)


@register("src_bad_utf8", with_ctes(["lines"], "SELECT line || chr(65533) AS line FROM lines"))
def q_src_bad_utf8(spark, d):
    # every document line gets a byte that is not valid UTF-8 (0xFF); the reader must
    # replace it with U+FFFD instead of failing
    lines = tm.lines_df(spark, d)
    broken = lines.select(F.concat("line", F.unhex(F.lit("FF")).cast("string")).alias("line"))
    path = sinks.write_lines(broken, scratch_path(spark, "bad_utf8"))
    return readers.read_lines(spark, path)


def _pair_store(spark, d):
    """The pair table as a user keeps it: written once, then only looked up. The catalog entry goes
    again, the files stay for the result that reads them."""
    name = f"rankfold_pairs_{uuid.uuid4().hex}"
    similarity.write_pair_store(similarity.item_similarity(tm.ratings_unique_df(spark, d)), name, scratch_path(spark, "pair_store"))
    store = spark.table(name)
    store.schema  # resolved while the entry exists
    spark.sql(f"DROP TABLE {name}")
    return store


@register("similar_items_stored", ORACLE["similar_items"])
def q_similar_items_stored(spark, d):
    return similarity.similar_items_stored(_pair_store(spark, d), tm.items_df(spark, d), SIM_ITEM, SIM_MIN_SCORE, SIM_MIN_PAIRS, TOP_N)


@register("similar_items_dumped", ORACLE["similar_items"])
def q_similar_items_dumped(spark, d):
    # P24 over the K02 dump: sorted by (item1, item2), either side may be the item
    sims = similarity.item_similarity(tm.ratings_unique_df(spark, d))
    stored = spark.read.parquet(sinks.write_similarities(sims, scratch_path(spark, "similarities")))
    return similarity.similar_items_from(stored, tm.items_df(spark, d), SIM_ITEM, SIM_MIN_SCORE,
                                         SIM_MIN_PAIRS, TOP_N)


@register("formatted_word_counts", with_ctes(["lines"],
          "SELECT printf('%s: %d', word, n) AS line FROM (SELECT word, count(*) AS n FROM (SELECT lower(w) AS word FROM "
          f"(SELECT unnest({_WORD_TOKENS}) AS w FROM lines)) WHERE word NOT IN ({_STOP_SQL}) GROUP BY word)"))
def q_formatted_word_counts(spark, d):
    counts = text.word_count(tm.lines_df(spark, d), text.NON_WORD, lower=True, stop_words=text.STOP_WORDS,
                             sort=True)
    lines = sinks.format_lines(counts, "%s: %d", "word", "n")
    return readers.read_lines(spark, sinks.write_lines(lines, scratch_path(spark, "word_counts")))


@register("formatted_recommendations")
def q_formatted_recommendations(spark, d):
    recs = q_als_recommend_unseen(spark, d)
    lines = sinks.format_lines(recs.orderBy("rank"), "%2d: %s", "rank", "name")
    return readers.read_lines(spark, sinks.write_lines(lines, scratch_path(spark, "recommendations")))
