"""Graph connectivity and breadth-first degrees of separation.

Two graph forms are supported:

* entries ``(node, neighbour)``: one row per neighbour listed on an adjacency line
  (``sources.read_adjacency``); a node may span several lines and repeats count.
* incidence ``(node, grp)``: nodes co-occurring in a group are neighbours (e.g. heroes
  in one comic, parts in one order). Every member's line for a group lists the other
  members, so a node's degree is sum(|group| - 1). Working on the incidence directly
  keeps every step linear in the memberships: the member pairs of a group are never
  emitted, which matters when one group holds a large share of all rows.

BFS is an iterative frontier expansion. Frontier and visited sets carry ids only. The
graph and each level's new nodes are written as tables under ``spark.checkpoint.dir``
(a shared folder), which cuts lineage and means a lost executor costs at most the
current level. A level is one job: its size and whether it meets what the search looks for
are observed while it is written. A frontier of at most ``SMALL_FRONTIER`` nodes (its size is
known) is looked up by literal keys, so bucket pruning reads only the buckets that hold them; a
larger one is joined to the whole graph.

Degrees of separation search from both ends and grow the smaller frontier until they meet, so
neither reaches the hub-sized levels in the middle unless the two ends are far apart. A search
runs until a frontier is empty unless the caller names a largest level.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.functions import bounded_sort
from rankfold.operators.popularity import with_names
from rankfold.session import measured, scratch_path

# ------------------------------------------------------------------ connectivity

def adjacency_degree(adjacency: DataFrame) -> DataFrame:
    """P19 over adjacency lines ``(node, neighbours)``: summed list lengths per node;
    a line without neighbours counts 0."""
    return adjacency.groupBy("node").agg(F.sum(F.size("neighbours")).cast("long").alias("degree"))


def entry_degree(entries: DataFrame) -> DataFrame:
    """P19 over adjacency entries: number of listed neighbours per node (all lines)."""
    return entries.groupBy("node").agg(F.count("neighbour").alias("degree"))


def cooccurrence_degree(incidence: DataFrame) -> DataFrame:
    """P19 over an incidence: sum over a node's groups of (group size - 1).

    The group sizes come from a partial aggregate; joining them back is skew-safe
    under AQE (the size side has one row per group)."""
    sizes = incidence.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    return (incidence.join(sizes, "grp").groupBy("node")
            .agg(F.sum(F.col("size") - 1).alias("degree")))


def _named(top: DataFrame, names: DataFrame) -> DataFrame:
    # ``lookup(key)(0)``: one name per node, null for a node without one
    return with_names(top, names, "node")


def most_connected(degrees: DataFrame, names: DataFrame) -> DataFrame:
    """P20: the node with the largest degree; ties go to the largest id (tuple max)."""
    best = degrees.agg(F.max(F.struct("degree", "node")).alias("m")).select("m.node", "m.degree")
    return _named(best.filter(F.col("node").isNotNull()), names).select("node", "name", "degree")


def top_connected(degrees: DataFrame, names: DataFrame, n: int = 10) -> DataFrame:
    """The n most connected nodes with names (degree, then id, descending)."""
    order = (F.col("degree").desc(), F.col("node").desc())
    top = degrees.orderBy(*order).limit(n)
    return bounded_sort(_named(top, names).select("node", "name", "degree"), n, *order)


def least_connected(degrees: DataFrame, n: int = 10) -> DataFrame:
    """The n least connected nodes (degree, then id, ascending)."""
    return degrees.orderBy(F.col("degree").asc(), F.col("node").asc()).limit(n)


# ------------------------------------------------------------------ breadth-first search

ROWS_PER_BUCKET = 4_000_000
MANY_BUCKETS = 256
SMALL_FRONTIER = 1000


def _rows() -> Column:
    return F.count(F.lit(1))


class _Bucketed:
    """The graph written once in the shared scratch folder, bucketed and sorted by the join key.

    Joining a level's frontier then shuffles only the small side; without buckets each level
    would shuffle the whole graph. There is a bucket for every ``rows_per_bucket`` rows, and for
    a small graph one for every core. A bucket is a file and a task of every pass, so buckets that
    are asked to be smaller than ``ROWS_PER_BUCKET`` grow once there are ``MANY_BUCKETS`` of them,
    up to ``ROWS_PER_BUCKET`` rows. AQE cannot split a skewed bucket, so if a key has more rows
    than that (looked for once, and only in a graph with more rows than that), buckets are those
    of (key, salt): such a key gets as many salts as its rows fill buckets, its rows are spread by
    a hash of the other column, and only such keys are repeated on the small side. Other keys
    have salt 0. ``total`` is the number of rows of ``df``."""

    def __init__(self, df: DataFrame, total: int, key: str, other: str, name: str, rows_per_bucket: int):
        spark = df.sparkSession
        self.key, self.spark = key, spark
        rows_per_bucket = max(rows_per_bucket, min(ROWS_PER_BUCKET, -(-total // MANY_BUCKETS)))
        self.buckets = max(1, -(-total // rows_per_bucket), min(spark.sparkContext.defaultParallelism, -(-total // 50_000)))
        self.has_hot = False
        if total > rows_per_bucket:
            # fewer than ``buckets`` keys can hold a bucket's rows; a table, as that grows with the graph
            salts = F.ceil(F.col("c") / rows_per_bucket).cast("int").alias("salts")
            counts = df.groupBy(key).agg(_rows().alias("c")).filter(F.col("c") > rows_per_bucket)
            self.hot, seen = measured(counts.select(key, salts), f"{name}-hot", n=_rows())
            self.has_hot = seen["n"] > 0
        by = [key, "salt"] if self.has_hot else [key]
        if self.has_hot:
            df = self._with_salts(df)
            df = df.withColumn("salt", F.pmod(F.xxhash64(other), F.col("salts")).cast("int")).drop("salts")
        self.table = f"rankfold_{name}_{uuid.uuid4().hex}"
        (df.repartition(self.buckets, *by).write.bucketBy(self.buckets, *by).sortBy(*by)
         .option("path", scratch_path(spark, name)).saveAsTable(self.table))
        self.df = spark.table(self.table)

    def _with_salts(self, df: DataFrame) -> DataFrame:
        return df.join(self.hot, self.key, "left").withColumn("salts", F.coalesce("salts", F.lit(1)))

    def semi(self, keys: DataFrame) -> DataFrame:
        """Rows of the graph whose key is in ``keys`` (one column named like the key)."""
        if not self.has_hot:
            return self.df.join(keys.select(self.key), self.key, "left_semi")
        salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        # keys once each: a hot key's repeats would all get its salts, and both grow with its rows
        salted = self._with_salts(keys.select(self.key).distinct()).withColumn("salt", salt).drop("salts")
        return self.df.join(salted, [self.key, "salt"], "left_semi").drop("salt")

    def rows_of(self, keys: list[int]) -> DataFrame:
        """Rows of a few named keys: only their buckets are read."""
        return self.df.filter(F.col(self.key).isin(keys)).drop("salt")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


@dataclass
class _Level:
    """The new nodes of one level: (node, dist), their number, and whether one is sought."""

    nodes: DataFrame
    n: int
    meets: bool

    @cached_property
    def keys(self) -> list[int] | None:
        """The node ids if they are few."""
        return [r[0] for r in self.nodes.select("node").collect()] if self.n <= SMALL_FRONTIER else None


class _Edges:
    """Directed entries (node -> neighbour); duplicates are separate entries."""

    symmetric = False

    def __init__(self, entries: DataFrame, rows_per_bucket: int):
        edges, seen = measured(entries.select(F.col("node").cast("long").alias("src"),
                                                  F.col("neighbour").cast("long").alias("dst")).dropna(), "bfs-edges", n=_rows())
        self.edges, self.n, self.rows_per_bucket, self.by = edges, seen["n"], rows_per_bucket, {}

    def _side(self, key: str, other: str) -> _Bucketed:
        if key not in self.by:
            self.by[key] = _Bucketed(self.edges, self.n, key, other, f"bfs_by_{key}", self.rows_per_bucket)
        return self.by[key]

    def expand(self, frontier: _Level, back: bool = False) -> DataFrame:
        """Nodes that the frontier lists (or, going back, that list one of the frontier)."""
        key, other = ("dst", "src") if back else ("src", "dst")
        side = self._side(key, other)
        found = (side.rows_of(frontier.keys) if frontier.keys is not None
                 else side.semi(frontier.nodes.select(F.col("node").alias(key))))
        return found.select(F.col(other).alias("node")).distinct()

    def hits(self, frontier: DataFrame, target: int) -> int:
        """Entries of the frontier that name the target."""
        to_target = self._side("dst", "src").rows_of([target])
        return to_target.join(frontier.select(F.col("node").alias("src")), "src", "left_semi").count()

    def close(self) -> None:
        for side in self.by.values():
            side.drop()


class _Incidence:
    """Co-occurrence groups: frontier -> its groups -> their members. Member pairs are
    never formed. A group may be expanded again one level later (its members are at
    most one level apart); those members are already visited and drop out in the
    anti join, so the extra work is bounded by one more pass over the touched groups,
    cheaper than another scan of the incidence to filter them."""

    symmetric = True

    def __init__(self, incidence: DataFrame, rows_per_bucket: int):
        members, seen = measured(incidence.select(F.col("node").cast("long").alias("node"),
                                                      F.col("grp").cast("long").alias("grp")).dropna(), "bfs-incidence", n=_rows())
        self.by_node = _Bucketed(members, seen["n"], "node", "grp", "bfs_by_node", rows_per_bucket)
        self.by_grp = _Bucketed(members, seen["n"], "grp", "node", "bfs_by_grp", rows_per_bucket)

    def expand(self, frontier: _Level, back: bool = False) -> DataFrame:
        if frontier.keys is not None:
            groups = self.by_node.rows_of(frontier.keys).select("grp")
            few = groups.distinct().limit(SMALL_FRONTIER + 1).collect()
            if len(few) <= SMALL_FRONTIER:  # all of them; otherwise the join below takes them whole
                return self.by_grp.rows_of([r[0] for r in few]).select("node").distinct()
        else:
            groups = self.by_node.semi(frontier.nodes).select("grp")
        # a semi join ignores duplicate keys on its right side: no distinct needed there
        return self.by_grp.semi(groups).select("node").distinct()

    def hits(self, frontier: DataFrame, target: int) -> int:
        """Entries p -> target: one per group that a frontier node p shares with the target."""
        groups = self.by_node.rows_of([target]).select("grp")
        members = self.by_grp.semi(groups).filter(F.col("node") != target)
        return members.join(frontier.select("node"), "node", "left_semi").count()

    def close(self) -> None:
        self.by_node.drop()
        self.by_grp.drop()


def _start(spark: SparkSession, start: int) -> _Level:
    # built JVM-side (no Python rows), one row
    node = spark.range(1).select(F.lit(int(start)).cast("long").alias("node"), F.lit(0).alias("dist"))
    level = _Level(node, 1, False)
    level.keys = [int(start)]
    return level


class _Side:
    """The levels reached from one end."""

    def __init__(self, graph, spark: SparkSession, start: int, back: bool = False):
        self.graph, self.back, self.levels = graph, back, [_start(spark, start)]

    @property
    def last(self) -> _Level:
        return self.levels[-1]

    @property
    def visited(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [x.nodes for x in self.levels])

    def grow(self, sought: _Level | None = None) -> _Level:
        """Write the next level, one job; with ``sought``, a flag says which of its nodes are in it."""
        depth = len(self.levels)
        # neighbours are at most one level apart in a symmetric graph: two levels suffice
        seen = self.levels[-2:] if self.graph.symmetric else self.levels
        seen = reduce(DataFrame.unionByName, [x.nodes.select("node") for x in seen])
        new = self.graph.expand(self.last, self.back).join(seen, "node", "left_anti").withColumn("dist", F.lit(depth))
        observed = {"n": _rows()}
        if sought is not None:
            new = _flagged(new, sought)
            observed["meets"] = F.max("meets")
        nodes, got = measured(new, f"bfs-{'back' if self.back else 'level'}{depth}", **observed)
        self.levels.append(_Level(nodes, got["n"], bool(got.get("meets"))))
        return self.last


def _flagged(nodes: DataFrame, sought: _Level) -> DataFrame:
    """``nodes`` with ``meets``: the node is one of ``sought``."""
    if sought.keys is not None:
        return nodes.withColumn("meets", F.col("node").isin(sought.keys))
    other = sought.nodes.select(F.col("node").alias("other"))
    return nodes.join(other, F.col("node") == F.col("other"), "left").withColumn("meets", F.col("other").isNotNull()).drop("other")


def _distances(graph, spark: SparkSession, start: int, max_levels: int | None) -> DataFrame:
    """(node, dist) of all that ``start`` reaches. The graph's bucketed tables are dropped at the
    end; the levels do not depend on them."""
    side = _Side(graph, spark, start)
    try:
        while (max_levels is None or len(side.levels) <= max_levels) and side.last.n:
            side.grow()
    finally:
        graph.close()
    return side.visited


def _separation(graph, spark: SparkSession, start: int, target: int, max_levels: int | None) -> DataFrame:
    try:
        cyclic = start == target
        found = (_through_cycle if cyclic else _meet)(graph, spark, start, target, max_levels)
    finally:
        graph.close()
    # built JVM-side: one row (degree, hits), or none when the target was not reached
    level, hits = found or (0, 0)
    row = spark.range(1).select(F.lit(level).cast("int").alias("degree"), F.lit(hits).cast("long").alias("hits"))
    return row if found else row.limit(0)


def _through_cycle(graph, spark: SparkSession, start: int, target: int, max_levels: int | None):
    """(degree, hits) of a start that is its own target: each level is probed for it."""
    side = _Side(graph, spark, start)
    while side.last.n and (max_levels is None or len(side.levels) <= max_levels):
        if hits := graph.hits(side.last.nodes, target):
            return len(side.levels), hits
        side.grow()
    return None


def _meet(graph, spark: SparkSession, start: int, target: int, max_levels: int | None):
    """(degree, hits) by search from both ends, or None.

    As long as the sides have no node in common, the distance is more than the sum of their
    depths, so they can only meet in their last levels. The target is then listed by those of its
    predecessors that the meeting nodes reach in as many steps as the backward side has levels,
    less one: they are followed through its levels down to the first."""
    ahead, behind = _Side(graph, spark, start), _Side(graph, spark, target, back=True)
    while ahead.last.n and behind.last.n:
        depth = len(ahead.levels) + len(behind.levels) - 1  # of the level to come
        if max_levels is not None and depth > max_levels:
            return None
        # the smaller frontier grows; of equal ones the backward one, which ends nearer the hits
        side, other = (ahead, behind) if ahead.last.n < behind.last.n else (behind, ahead)
        if side.grow(other.last).meets:
            return depth, graph.hits(_listing(graph, ahead, behind, side.last), target)
    return None


def _listing(graph, ahead: _Side, behind: _Side, met: _Level) -> DataFrame:
    """The nodes one step before the target on shortest ways, from the level where the sides met."""
    at = len(behind.levels) - 1
    if at == 0:  # the forward side reached the target itself: from its level before
        return ahead.levels[-2].nodes
    on_way, got = measured(met.nodes.filter("meets").select("node"), "bfs-met", n=_rows())
    for level in reversed(behind.levels[1:at]):
        step = graph.expand(_Level(on_way, got["n"], False)).join(level.nodes.select("node"), "node", "left_semi")
        on_way, got = measured(step, "bfs-way", n=_rows())
    return on_way


def degrees_of_separation(entries: DataFrame, start: int, target: int, max_levels: int | None = None,
                          rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """P25 over adjacency entries: (degree, hits) where degree is the BFS level at which
    a frontier node first lists the target and hits the number of such entries; no row
    when the target cannot be reached (within ``max_levels``, if given)."""
    return _separation(_Edges(entries, rows_per_bucket), entries.sparkSession, start, target, max_levels)


def cooccurrence_degrees_of_separation(incidence: DataFrame, start: int, target: int, max_levels: int | None = None,
                                       rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """P25 over a co-occurrence incidence (same semantics as the entry form)."""
    return _separation(_Incidence(incidence, rows_per_bucket), incidence.sparkSession, start, target, max_levels)


def bfs_distances(entries: DataFrame, start: int, max_levels: int | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(node, dist) of every node that can be reached (within ``max_levels``, if given)."""
    return _distances(_Edges(entries, rows_per_bucket), entries.sparkSession, start, max_levels)


def cooccurrence_bfs_distances(incidence: DataFrame, start: int, max_levels: int | None = None,
                               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    return _distances(_Incidence(incidence, rows_per_bucket), incidence.sparkSession, start, max_levels)
