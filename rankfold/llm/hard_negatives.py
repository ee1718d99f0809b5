"""Hard-negative mining by a BOND vertical scan.

Vectors become integers, ``floor(scale * x)``, and a row's score for an anchor is their inner
product. An anchor's positives are its best rows of the same label; the hard negatives of an
(anchor, positive) pair are the best rows of other labels whose score lies in a window below
the positive's score.

Rows and anchors are dealt by hash into a grid of cells, so that every anchor meets every row
once, in blocks of bounded size (``CELL_ROWS`` and ``CELL_ANCHORS`` components). Inside a cell
the vectors lie column by column and are scanned vertically for each anchor: dimensions in
descending order of the anchor's magnitude, ``STEP`` at a time, added to the candidates' partial
scores. The least and largest value of each dimension that is still to come bound what a score
can gain, and candidates whose bounds show that they cannot be among the best, or in no window,
leave the bitmap. What is left in the end has exact scores. A first scan finds the positives,
a second one the negatives in the windows; each cell hands on at most ``n`` rows for an anchor
or a pair, and a window function over those picks the best of all cells.

Scores are exact: sums below 2^53 are added as doubles, larger ones as Python integers; a score
beyond 64 bits fails. A vector shorter than another counts as filled up with zeros.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Rows
that repeat id, label and vector count once; different rows of one id are rows of their own.
Ties go to the smaller id, then to the smaller hash of label and vector. Fewer rows than asked
for give all there are; without an anchor, a positive or a row in the window there is no row.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import ship_by_value, written

ship_by_value(__name__)

CELL_ROWS = 1 << 20     # components of a cell's rows: 16,384 vectors of 64 dimensions
CELL_ANCHORS = 1 << 15  # components of a cell's anchors
STEP = 8
EXACT = 2.0 ** 53


def clean(rows: DataFrame, label: Column, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, mark, label, vector) of the rows that take part, each once; ``mark`` tells rows of one id apart."""
    # read the vector as an array of doubles, whatever it is stored as
    ok = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = rows.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"))
    return (out.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ok)
            .distinct().select("id", F.xxhash64("label", "vector").alias("mark"), "label", "vector"))


class Block:
    """Rows of a cell in columns, sorted by label."""

    def __init__(self, table: pa.Table, scale: float, width: int):
        label = table["label"].to_numpy()
        order = np.argsort(label, kind="stable")
        self.label = label[order]
        self.id, self.mark = table["id"].to_numpy()[order], table["mark"].to_numpy()[order]
        self.columns = np.ascontiguousarray(integers(table["vector"], scale, width)[order].T)

    def same(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, side="right"))

    def best(self, at: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
        """Positions in ``at`` of its first ``n``: highest score, then id, then mark."""
        if len(at) > n:
            least = np.partition(score, len(score) - n)[len(score) - n]
            found = np.flatnonzero(score >= least)
        else:
            found = np.arange(len(at))
        return found[np.lexsort((self.mark[at[found]], self.id[at[found]], -score[found]))][:n]


def integers(vectors: pa.ChunkedArray, scale: float, width: int) -> np.ndarray:
    """Rows of ``floor(scale * x)`` as doubles, ``width`` wide."""
    lists = vectors.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(scale * flat)
    out = np.zeros((len(sizes), width))
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([0, *(int(np.diff(c.offsets.to_numpy()).max(initial=0)) for column in columns for c in column.chunks)])


def _exact(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)


class Scan:
    """One anchor's vertical scan over columns (dimensions x rows), ``STEP`` dimensions at a time.

    ``low`` and ``high`` are the columns' least and largest values. Iterating gives, after each
    step, the least and most that the dimensions still to come can add; ``keep`` narrows the
    candidates. ``at`` are their row numbers, ``score`` their partial scores."""

    def __init__(self, anchor: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray):
        self.anchor, self.columns, self.at = anchor, columns, at
        self.order = np.argsort(-np.abs(anchor).astype(np.float64), kind="stable")
        a, b = anchor * low, anchor * high
        zero = np.zeros(1, dtype=anchor.dtype)
        self.least, self.most = (np.concatenate([np.cumsum(x[self.order][::-1])[::-1], zero]) for x in (np.minimum(a, b), np.maximum(a, b)))
        self.score = np.zeros(len(at), dtype=anchor.dtype)

    def __iter__(self) -> Iterator[tuple[float, float]]:
        whole, n = len(self.at) == self.columns.shape[1], len(self.order)
        for k in range(0, n, STEP):
            dims = self.order[k:k + STEP]
            part = self.columns[dims] if whole and len(self.at) == self.columns.shape[1] else self.columns[np.ix_(dims, self.at)]
            self.score = self.score + self.anchor[dims] @ part
            yield self.least[min(k + STEP, n)], self.most[min(k + STEP, n)]

    def keep(self, alive: np.ndarray) -> None:
        if not alive.all():
            self.at, self.score = self.at[alive], self.score[alive]


def top(scan: Scan, n: int) -> None:
    """Narrow ``scan`` to the candidates that can be among the ``n`` highest scores."""
    for least, most in scan:
        if len(scan.at) > n:
            bound = np.partition(scan.score, len(scan.score) - n)[len(scan.score) - n] + least
            scan.keep(scan.score + most >= bound)


def windows(scan: Scan, bounds: list[tuple[float, float]], n: int) -> None:
    """Narrow ``scan`` to the candidates that can be among the ``n`` highest in a window."""
    for least, most in scan:
        low, high = scan.score + least, scan.score + most
        alive = np.zeros(len(scan.at), dtype=bool)
        for a, b in bounds:
            reach = (high >= a) & (low <= b)
            inside = low[reach & (low >= a) & (high <= b)]  # sure to lie in the window
            if len(inside) >= n:
                reach &= high >= np.partition(inside, len(inside) - n)[len(inside) - n]
            alive |= reach
        scan.keep(alive)


def _prepared(anchors: pa.Table, rows: pa.Table, scale: float) -> tuple[Block, np.ndarray]:
    width = _width(anchors["anchor_vector"], rows["vector"])
    block, vectors = Block(rows, scale, width), integers(anchors["anchor_vector"], scale, width)
    bound = (np.abs(block.columns).max(axis=1, initial=0) * np.abs(vectors).max(axis=0, initial=0)).sum()
    if not bound < EXACT:
        block.columns, vectors = _exact(block.columns), _exact(vectors)
    return block, vectors


ANCHOR = ["anchor_id", "anchor_mark"]


def _cells(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int, int], cell_rows: int, cell_anchors: int):
    """``rows`` and ``anchors`` dealt over the cells of a grid; ``counts`` are the numbers of rows
    and of anchors and the largest width."""
    n_rows, n_anchors, width = (max(x, 1) for x in counts)
    across, down = -(-n_anchors * width // cell_anchors), -(-n_rows * width // cell_rows)
    def line(key, n):
        return F.pmod(F.xxhash64(*key, F.lit(7)), F.lit(n)).cast("int")
    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("across", line(ANCHOR, across)).withColumn("down", every(down))
    right = rows.withColumn("down", line(["id", "mark"], down)).withColumn("across", every(across))
    return left.groupBy("across", "down"), right.groupBy("across", "down")


def positives(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int, int], n: int = 5, scale: float = 256.0,
              cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """The ``n`` best other rows of each anchor's label: anchor, positive_id, positive_mark, positive_score."""
    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in range(5)]
        if len(left) and len(right):
            block, vectors = _prepared(left, right, scale)
            extremes: dict[int, tuple] = {}
            for i, (id_, mark, label) in enumerate(zip(*(left[c].to_pylist() for c in (*ANCHOR, "anchor_label")))):
                a, b = block.same(label)
                if a == b:
                    continue
                columns = block.columns[:, a:b]
                if label not in extremes:
                    extremes[label] = columns.min(axis=1), columns.max(axis=1)
                other = np.flatnonzero((block.id[a:b] != id_) | (block.mark[a:b] != mark))
                scan = Scan(vectors[i], columns, *extremes[label], other)
                top(scan, n)
                for k in block.best(scan.at + a, scan.score, n):
                    for c, v in zip(out, (id_, mark, int(block.id[scan.at[k] + a]), int(block.mark[scan.at[k] + a]), int(scan.score[k]))):
                        c.append(v)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=[*ANCHOR, "positive_id", "positive_mark", "positive_score"])

    left, right = _cells(rows, anchors, counts, cell_rows, cell_anchors)
    found = left.cogroup(right).applyInArrow(cell, "anchor_id long, anchor_mark long, positive_id long, positive_mark long, positive_score long")
    nth = F.row_number().over(Window.partitionBy(*ANCHOR).orderBy(F.desc("positive_score"), "positive_id", "positive_mark"))
    return found.withColumn("nth", nth).filter(F.col("nth") <= n).drop("nth")


def negatives(rows: DataFrame, anchors: DataFrame, pairs: DataFrame, counts: tuple[int, int, int], n: int = 3,
              low: int = 50, high: int = 95, scale: float = 256.0,
              cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """The ``n`` best rows of other labels for each of ``pairs`` (of ``positives``) whose score s
    satisfies low * positive_score <= 100 * s <= high * positive_score."""
    sought = F.collect_list(F.struct("positive_id", "positive_mark", "positive_score")).alias("pairs")  # at most n of positives
    wanted = anchors.join(pairs.groupBy(*ANCHOR).agg(sought), ANCHOR)
    names = [*ANCHOR, "positive_id", "positive_mark", "positive_score", "negative_id", "negative_mark", "negative_score"]

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in names]
        if len(left) and len(right):
            block, vectors = _prepared(left, right, scale)
            extremes = block.columns.min(axis=1), block.columns.max(axis=1)
            for i, (id_, mark, label, asked) in enumerate(zip(*(left[c].to_pylist() for c in (*ANCHOR, "anchor_label", "pairs")))):
                # integer bounds of the windows: ceil(low * p / 100) to floor(high * p / 100)
                spans = {p: (-(-low * p // 100), high * p // 100) for p in {x["positive_score"] for x in asked}}
                open_ = [s for s in spans.values() if s[0] <= s[1]]
                a, b = block.same(label)
                other = np.concatenate([np.arange(a), np.arange(b, len(block.label))])
                if not open_ or not len(other):
                    continue
                scan = Scan(vectors[i], block.columns, *extremes, other)
                windows(scan, open_, n)
                first = {}
                for p, (x, y) in spans.items():
                    inside = np.flatnonzero((scan.score >= x) & (scan.score <= y))
                    first[p] = inside[block.best(scan.at[inside], scan.score[inside], n)]
                for pair in asked:
                    for k in first[pair["positive_score"]]:
                        r = scan.at[k]
                        for c, v in zip(out, (id_, mark, *pair.values(), int(block.id[r]), int(block.mark[r]), int(scan.score[k]))):
                            c.append(v)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=names)

    left, right = _cells(rows, wanted, counts, cell_rows, cell_anchors)
    found = left.cogroup(right).applyInArrow(cell, ", ".join(f"{c} long" for c in names))
    nth = F.row_number().over(Window.partitionBy(*ANCHOR, "positive_id", "positive_mark")
                              .orderBy(F.desc("negative_score"), "negative_id", "negative_mark"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, label: Column, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3,
                   low: int = 50, high: int = 95, scale: float = 256.0, id_column: str = "vec_id", vector: str = "embedding",
                   cell_rows: int = CELL_ROWS, cell_anchors: int = CELL_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``label`` is an
    expression over ``rows``, ``is_anchor`` one over the column ``id``."""
    vectors = written(clean(rows, label, id_column, vector), "hard-negative-rows")
    counts = tuple(vectors.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first())
    anchors = vectors.filter(is_anchor).select(*[F.col(c).alias(f"anchor_{c}") for c in ("id", "mark", "label", "vector")])
    pairs = written(positives(vectors, anchors, counts, n_positives, scale, cell_rows, cell_anchors), "hard-negative-pairs")
    out = negatives(vectors, anchors, pairs, counts, n_negatives, low, high, scale, cell_rows, cell_anchors)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scores s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3"""
