"""The library's parse and score rules as SQL functions for ``spark.sql``.

``register(spark)`` creates temporary SQL functions. Their bodies are SQL expressions, which the
optimizer puts in place of each call, so a query over them plans like one written out: no
Python runs. Scalar functions:

* ``rf_cosine(sxy, sxx, syy)``      cosine from the three sums, 0 if a norm is 0 (P23)
* ``rf_fahrenheit(tenths)``         Fahrenheit from tenths of a degree Celsius (P06)
* ``rf_int_mean(total, n)``         integer mean, rounded towards zero (P05)
* ``rf_bucket(seconds)``            time bucket 0-9 of an epoch second (P35)
* ``rf_split(bucket)``              train, validation or test of a bucket (P35)

Table functions, to be joined ``LATERAL``:

* ``rf_tokens(line)``               tokens of a line split at runs of non-word characters,
                                    trailing empty ones dropped (P03)
* ``rf_tags(tags, sep)``            elements of a tag list (P15)
* ``rf_rating(line, sep)``          user_id, item_id, rating, ts of a delimited line; no row for
                                    a line that is no rating (S02-S04)
* ``rf_neighbours(line)``           node and neighbour of an adjacency line (S11)
* ``rf_node_name(line)``            node and name of a line ``id "NAME"`` (S12)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SCALAR = {
    "rf_cosine(sxy DOUBLE, sxx DOUBLE, syy DOUBLE) RETURNS DOUBLE":
        "CASE WHEN sqrt(sxx) * sqrt(syy) <> 0 THEN sxy / (sqrt(sxx) * sqrt(syy)) ELSE 0D END",
    "rf_fahrenheit(tenths DOUBLE) RETURNS DOUBLE": "round(tenths * 18D + 3200D) / 100D",
    "rf_int_mean(total BIGINT, n BIGINT) RETURNS BIGINT": "total DIV n",
    "rf_bucket(seconds BIGINT) RETURNS INT": "CAST(seconds % 10 AS INT)",
    "rf_split(bucket INT) RETURNS STRING":
        "CASE WHEN bucket < 6 THEN 'train' WHEN bucket < 8 THEN 'validation' WHEN bucket IS NOT NULL THEN 'test' END",
}

TABLE = {
    # of a line of delimiters only nothing is left; of an empty line one empty token
    r"rf_tokens(line STRING) RETURNS TABLE (token STRING)":
        r"SELECT token FROM (SELECT explode(CASE WHEN line <> '' AND regexp_replace(line, '\\W+\\z', '') = '' THEN array() "
        r"ELSE split(regexp_replace(line, '\\W+\\z', ''), '\\W+') END) AS token)",
    "rf_tags(tags STRING, sep STRING) RETURNS TABLE (tag STRING)":
        r"SELECT tag FROM (SELECT explode(split(tags, concat('\\Q', sep, '\\E'))) AS tag)",
    "rf_rating(line STRING, sep STRING) RETURNS TABLE (user_id INT, item_id INT, rating DOUBLE, ts BIGINT)":
        r"""SELECT u, i, r, t FROM (
              SELECT size(f) AS n, try_cast(get(f, 0) AS INT) AS u, try_cast(get(f, 1) AS INT) AS i,
                     try_cast(get(f, 2) AS DOUBLE) AS r, try_cast(get(f, 3) AS BIGINT) AS t
              FROM (SELECT split(line, concat('\\Q', sep, '\\E')) AS f))
            WHERE n = 4 AND u IS NOT NULL AND i IS NOT NULL AND r IS NOT NULL AND t IS NOT NULL""",
    "rf_neighbours(line STRING) RETURNS TABLE (node BIGINT, neighbour BIGINT)":
        r"""SELECT node, neighbour FROM (
              SELECT try_cast(get(p, 0) AS BIGINT) AS node, explode(transform(slice(p, 2, greatest(size(p) - 1, 0)), x -> try_cast(x AS BIGINT))) AS neighbour
              FROM (SELECT split(trim(line), '\\s+') AS p)) WHERE node IS NOT NULL AND neighbour IS NOT NULL""",
    "rf_node_name(line STRING) RETURNS TABLE (node BIGINT, name STRING)":
        r"""SELECT node, name FROM (SELECT try_cast(trim(get(f, 0)) AS BIGINT) AS node, get(f, 1) AS name
              FROM (SELECT split(line, '"') AS f)) WHERE node IS NOT NULL AND name IS NOT NULL""",
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session; gives their names."""
    for head, body in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for head, body in TABLE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.partition("(")[0] for head in (*SCALAR, *TABLE)]
