"""Toxicity by multiple-instance learning with noisy-or.

A document is a bag of sentences. Each sentence gets a probability from a linear model over
hashed word and word-beginning features; the document's score is the noisy-or of them,
``1 - prod(1 - p)``. Only documents have labels: the gradient of the noisy-or likelihood
shares each document's error among its sentences, so the trained model also says which
sentences offend.

Length is no evidence. A sentence without a learned feature has no part in the noisy-or, in
training as in scoring, and a scored document takes only sentences of ``EVIDENT`` or more, so
that a long text does not add up what each sentence has by chance; without such a sentence the
score is that of its likeliest one.

The model is fitted on a bounded sample of labelled documents (``SampleBound``: at most so
many rows of each label and so many characters in all, chosen by the hash of the id), on the
driver; its weights are at most one for each feature of the sample's words. A document that does not fit what is left of the
bound is passed over, documents of more than a 64th of it are taken after all others, and each
label has half of it before the other may use it. All documents are scored whole, in tasks.

Nulls: a null text is an empty text and scores 0, like any text without a word. Rows with a
null id or label are not trained on. Repeated labels of an id count as toxic if any is.
Without a toxic and a clean label there is nothing to learn and every score is 0. Repeated
rows each get their row; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import ship_by_value

ship_by_value(__name__)

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
RUN = 40  # words; a longer sentence counts as several
BUCKETS = (1 << 18) - 1  # training counts features by the low bits of their hash
NONE = (1 << 32) - 1
PREFIXES = (3, 4, 5)
EVIDENCE = 1.5
OFFENDS = 0.5
EVIDENT = 0.1  # a sentence's probability from which on it joins the noisy-or of a scored document
CACHE = 100_000
SPANS = "array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class SampleBound:
    rows_per_label: int = 2000
    characters: int = 16_000_000

    @property
    def long(self) -> int:
        """Characters from which on a document is taken only after all shorter ones."""
        return self.characters // 64


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]  # by the whole hash, so that a long text's many words meet none by chance
    bias: float


def features(word: str) -> list[int]:
    marks = [f"w{word}", *(f"p{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(m.encode("utf-8", "surrogatepass")) for m in marks]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of each sentence that has a word."""
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m[0].lower())
        if len(words) <= RUN:
            if words:
                yield m.start(), m.end(), words
            continue
        at = [w.span() for w in WORD.finditer(m[0])]
        for i in range(0, len(at), RUN):
            part = at[i:i + RUN]
            a, b = part[0][0], part[-1][1]
            yield m.start() + a, m.start() + b, [m[0][x:y].lower() for x, y in part]


def _sketch(text: str) -> int:
    """Smallest hash of the text's 5-word shingles: near copies mostly share it."""
    w = text.lower().split()
    return min(zlib.crc32(" ".join(w[i:i + 5]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(w) - 4)))


def _marks_toxic(documents: list[np.ndarray], of_word: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Features in three toxic documents or more whose log-odds for toxic documents is at
    least ``EVIDENCE``, one standard error deducted. The noisy-or is then fitted on these:
    rare features that met toxic documents by chance would explain their labels away."""
    counts = np.zeros((2, BUCKETS + 1), dtype=np.int64)  # documents of either label that have the feature
    for words, toxic in zip(documents, y):
        found = of_word[np.unique(words)]
        counts[int(toxic), np.unique(found[found != NONE] & BUCKETS)] += 1
    c, t = counts
    odds = np.log((t + 0.5) / (y.sum() + 1)) - np.log((c + 0.5) / ((~y).sum() + 1))
    return (t >= 3) & (odds - np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) > EVIDENCE)


def train(sample: Iterable[tuple[str, int]], steps: int = 300, rate: float = 0.2, decay: float = 1e-5) -> Model:
    """Adam on the noisy-or likelihood of document labels (both labels weigh the same).

    The sample is held as one number per word; features are looked up per distinct word."""
    known: dict[str, int] = {}
    words_, sentence_of, bag_of, seen, y = array("i"), array("i"), array("i"), set(), []
    for text, label in sample:
        sketch = _sketch(text)
        if sketch in seen:
            continue
        seen.add(sketch)
        for _, _, words in sentences(text):
            words_.extend(known.setdefault(w, len(known)) for w in words)
            sentence_of.extend([len(bag_of)] * len(words))
            bag_of.append(len(y))
        y.append(bool(label))
    y, n = np.array(y, dtype=bool), len(bag_of)
    if not n or y.all() or not y.any():
        return Model({}, -np.inf)
    of_word = np.full((len(known), 1 + len(PREFIXES)), NONE, dtype=np.uint32)
    for i, w in enumerate(known):
        f = features(w)
        of_word[i, :len(f)] = f
    del known
    word, row, bag = (np.frombuffer(x, dtype=np.int32) for x in (words_, sentence_of, bag_of))
    marks = _marks_toxic(np.split(word, np.searchsorted(bag[row], np.arange(1, len(y)))), of_word, y)
    # the few entries (sentence, feature) of the features that are left
    cols, rows = [], []
    for k in range(of_word.shape[1]):
        f = of_word[word, k]
        keep = (f != NONE) & marks[f & BUCKETS]
        cols.append(f[keep] & BUCKETS)
        rows.append(row[keep])
    used, col = np.unique(np.concatenate(cols), return_inverse=True)
    # sentences without such a feature are no evidence: they have no part in the noisy-or
    evident, row = np.unique(np.concatenate(rows), return_inverse=True)
    bag, n = bag[evident], len(evident)
    if not n:
        return Model({}, -np.inf)
    weigh = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum()) * len(y)
    w = np.zeros(len(used) + 1)
    w[-1] = -np.log(2.0 * n / len(y))  # the noisy-or of an average document starts near a half
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], n) + w[-1]
        p, soft = 1 / (1 + np.exp(-z)), np.logaddexp(0, z)
        a = np.bincount(bag, soft, len(y))  # -log of the chance that no sentence offends
        pull = np.where(y, -1 / np.maximum(np.expm1(np.minimum(a, 50)), 1e-9), 1.0) * weigh
        g_z = p * pull[bag]
        g = np.append(np.bincount(col, g_z[row], len(used)), g_z.sum()) / len(y)
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
    learned = of_word[(of_word != NONE) & marks[of_word & BUCKETS]]
    learned = np.unique(learned)
    return Model(dict(zip(learned.tolist(), w[np.searchsorted(used, learned & BUCKETS)].tolist())), float(w[-1]))


class WordWeights(dict):
    """Summed weights of the words met so far; forgets them when there are too many."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        self[word] = s = sum(self.weights.get(f, 0.0) for f in features(word))
        return s


class Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, WordWeights(model.weights)

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        if not text or self.model.bias == -np.inf:
            return 0.0, []
        spans, z = [], []
        for start, end, words in sentences(text):
            weights = list(map(self.known.__getitem__, words))
            if any(weights):  # without a learned feature a sentence is no evidence and adds nothing
                spans.append((start, end))
                z.append(sum(weights))
        if not z:
            return 0.0, []
        z = np.array(z) + self.model.bias
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        strong = z[p >= EVIDENT]
        found = [{"start": spans[i][0], "end": spans[i][1], "score": float(p[i])} for i in np.flatnonzero(p >= OFFENDS)]
        return (float(-np.expm1(-np.logaddexp(0, strong).sum())) if len(strong) else float(p.max())), found


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def within(sizes: list[tuple[int, int]], characters: int) -> list[int]:
    """Positions of the (label, size) rows that fit ``characters``, in order: each label first
    fills its half, then the rows passed over fill what is left. A row that does not fit is
    passed over and ends nothing."""
    taken, left = set(), characters
    for label in (0, 1):
        room = characters // 2
        for i, (k, size) in enumerate(sizes):
            if k == label and size <= room:
                taken.add(i)
                room, left = room - size, left - size
    for i, (_, size) in enumerate(sizes):
        if i not in taken and size <= left:
            taken.add(i)
            left -= size
    return sorted(taken)


def sample(docs: DataFrame, labels: DataFrame, bound: SampleBound = SampleBound()) -> DataFrame:
    """The bounded sample (text, toxic) of labelled rows that are not held out, in order of the
    hash of the id.

    Chosen by numbers alone (id, hash and size of each different text of an id), so that only
    the texts of the sample move. Long documents (``SampleBound.long``) and further texts of an
    id come after the others."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("mark"), F.length("text").cast("long").alias("size"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("mark", "size"))
    rows = (texts.select("doc_id", "mark", "size").distinct().join(known, "doc_id")
            .withColumn("nth", nth).filter(F.col("nth") <= bound.rows_per_label)
            .select("doc_id", "mark", "size", "toxic", "nth", F.xxhash64("doc_id").alias("at"), (F.col("size") > bound.long).alias("long")))
    order = ["long", "nth", "at", "doc_id", "mark"]
    found = [r for k in (0, 1) for r in rows.filter(F.col("toxic") == k).orderBy(*order).limit(bound.rows_per_label).collect()]
    found.sort(key=lambda r: tuple(r[c] for c in order))
    chosen = [found[i] for i in within([(r["toxic"], r["size"]) for r in found], bound.characters)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys = docs.sparkSession.createDataFrame([(r["doc_id"], r["mark"], r["size"], int(r["toxic"])) for r in chosen],
                                             f"doc_id {kind}, mark long, size long, toxic int")
    whole = texts.join(F.broadcast(keys), ["doc_id", "mark", "size"]).groupBy("doc_id", "mark", "size").agg(
        F.first("text").alias("text"), F.first("toxic").alias("toxic"))
    return whole.orderBy(F.xxhash64("doc_id"), "doc_id", "text").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, bound: SampleBound = SampleBound()) -> Model:
    """Train on the bounded sample of rows of ``labels`` that are not held out."""
    return train((r[0], int(r[1])) for r in sample(docs, labels, bound).toLocalIterator())


def scored(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column struct<score, offending>: the document's score and its offending sentences."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for b in batches:
            rows = [scorer.score(t) for t in b]
            yield pd.DataFrame({"score": [r[0] for r in rows], "offending": [r[1] for r in rows]})

    return F.pandas_udf(run, f"struct<score:double,offending:{SPANS}>")(docs[text])


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, offending (start, end and score of sentences)."""
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(docs, model).alias("s"))
    return out.select("doc_id", "held_out", "s.score", (F.col("s.score") >= threshold).cast("int").alias("predicted"), "s.offending")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``."""
    return docs.withColumn("_tx", scored(docs, model)).filter(F.col("_tx.score") < threshold).select(*docs.columns)
