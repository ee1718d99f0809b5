"""Quality rules: base counts and divergence from language references.

One pass over the texts makes a small row of counts per document: the base rules' counts, a
histogram of character classes and a histogram of common words. Summed by language over all
documents that pass the base rules, the histograms are first references; summed again over
the half of each language's documents that is nearest to them in either histogram (a trimmed
estimate that junk cannot shift), they are the language references. A document is compared with the reference of its language by the Jensen-Shannon distance (square
root of the divergence to base 2, between 0 and 1) of either histogram and rejected when one
is too far. Short texts have noisy histograms, so each comparison has a minimum length. A
language (null is one) whose reference holds fewer than ``MIN_REFERENCE_WORDS`` words is too
small to judge by: its documents are kept if they pass the base rules.

Nulls: a null text is an empty text; it fails the base rules. Repeated rows each get their
row; an empty table gives an empty result. Texts may be of any length; of equal distances
at the median all count as near. Other columns are ignored. 8-word windows are compared by 64-bit
hashes of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import WHITE_SPACE, broadcast_if_small, let, shingle_hashes, space_words, written

# Frequent function words of the languages that the references cover.
COMMON_WORDS = {
    "de": "der die und das ist in zu den von mit auf für als im dem nicht ein eine sich auch",
    "en": "the of and to in is that it for was on are as with by this be at from or an not",
    "es": "el la los las de del que y en un una es por con para se su al lo no",
    "fr": "le la les de des et du en un une est que qui dans pour par sur au pas avec",
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words.split()})

SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "wide")
WINDOW = 8

MAX_CHAR_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.22
WORD_NOISE = 1.3  # a clean text of n words is expected to lie up to about WORD_NOISE / sqrt(n) away
MIN_CHARS = 300
MIN_WORDS = 50
MIN_REFERENCE_WORDS = 5000
BROADCAST_LANGUAGES = 10_000


def _removed(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_window_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def again(k):
                return (F.coalesce(F.get(s, k)["x"] == F.get(s, k - 1)["x"], F.lit(False))
                        | F.coalesce(F.get(s, k)["x"] == F.get(s, k + 1)["x"], F.lit(False)))
            return F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), again), lambda k: F.get(s, k)["i"])

        def total(p: Column) -> Column:
            reach = F.transform(p, lambda v, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1), v + window) - v))
            return F.aggregate(reach, F.lit(0).cast("long"), lambda a, v: a + v)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(let(ordered, lambda s: F.sort_array(starts(s))), total))

    return let(shingle_hashes(words, window), covered)


def counts(docs: DataFrame) -> DataFrame:
    """One small row of counts per document."""
    text = F.coalesce("text", F.lit(""))
    # lower-case letters go first, so the later counts run over short strings
    rest = _removed(text, "abcdefghijklmnopqrstuvwxyz")
    visible = _removed(rest, WHITE_SPACE)
    chars = {
        "lower": F.length(text) - F.length(rest),
        "upper": F.length(visible) - F.length(_removed(visible, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        "digit": F.length(visible) - F.length(_removed(visible, "0123456789")),
        "space": F.length(rest) - F.length(visible),
        "punctuation": F.length(visible) - F.length(_removed(visible, PUNCTUATION)),
        "symbol": F.length(visible) - F.length(_removed(visible, SYMBOLS)),
        "wide": F.octet_length(visible) - F.length(visible),
    }
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(WHITE_SPACE)) != "")

    def histogram(found: Column) -> Column:
        return F.transform(F.array_distinct(found), lambda v: F.struct(
            v.alias("word"), F.size(F.filter(found, lambda x: x == v)).cast("long").alias("n")))

    def per_words(w: Column) -> Column:
        plain = F.transform(w, lambda x: F.lower(F.btrim(x, F.lit(PUNCTUATION))))
        return F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_window_words(w).alias("n_repeat_words"),
            let(F.filter(plain, lambda x: x.isin(VOCABULARY)), histogram).alias("common"))

    out = docs.select(
        "doc_id", "lang", let(space_words(text), per_words).alias("w"),
        (F.length(text) - chars["space"]).cast("long").alias("word_chars"),
        chars["symbol"].cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.array(*[chars[c].cast("long") for c in CLASSES]).alias("chars"))
    out = out.select("doc_id", "lang", "w.*", "word_chars", "n_symbols", "n_dup_lines", "chars")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; 0 if either is empty."""
    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def term(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def spread(s: Column) -> Column:
        parts = F.zip_with(s["v"]["p"], s["v"]["q"], lambda a, b: let(
            F.struct((a / s["p"]).alias("a"), (b / s["q"]).alias("b")),
            lambda r: term(r["a"], (r["a"] + r["b"]) / 2) + term(r["b"], (r["a"] + r["b"]) / 2)))
        return F.when((s["p"] == 0) | (s["q"] == 0), F.lit(0.0)).otherwise(F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0))))

    return let(F.struct(p.alias("p"), q.alias("q")),
               lambda v: let(F.struct(v.alias("v"), total(v["p"]).alias("p"), total(v["q"]).alias("q")), spread))


def references(rows: DataFrame) -> DataFrame:
    """One row per language: the summed histograms of ``rows``."""
    sums = rows.groupBy("lang").agg(
        F.sum("n_words").alias("ref_words"),
        F.array(*[F.sum(F.get("chars", F.lit(k))) for k in range(len(CLASSES))]).alias("ref_chars"))
    words = (rows.select("lang", F.explode("common").alias("c")).groupBy("lang", F.col("c.word").alias("word"))
             .agg(F.sum("c.n").alias("n")).groupBy("lang")
             .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "n")))).alias("m")))
    words = words.select("lang", F.array(*[F.coalesce(F.col("m")[w], F.lit(0)) for w in VOCABULARY]).alias("ref_common"))
    w = words.withColumnRenamed("lang", "_l")
    out = sums.join(w, F.col("lang").eqNullSafe(F.col("_l")), "left").drop("_l")
    none = F.array(*[F.lit(0).cast("long") for _ in VOCABULARY])
    return out.withColumn("ref_common", F.coalesce("ref_common", none))


def with_distances(rows: DataFrame, refs: DataFrame, min_chars: int, min_words: int) -> DataFrame:
    """Add char_distance and word_distance to the reference of the row's language."""
    def vector(words: Column, common: Column) -> Column:
        """Counts of the vocabulary and of all other words."""
        inside = F.aggregate(common, F.lit(0).cast("long"), lambda s, c: s + c["n"])
        return let(F.map_from_entries(common), lambda m: F.concat(
            F.transform(F.array(*[F.lit(w) for w in VOCABULARY]), lambda w: F.coalesce(F.element_at(m, w), F.lit(0))),
            F.array(words - inside)))

    ref_inside = F.aggregate("ref_common", F.lit(0).cast("long"), lambda s, x: s + x)
    words = js_distance(vector(F.col("n_words"), F.col("common")),
                        F.concat("ref_common", F.array(F.col("ref_words") - ref_inside)))
    judged = refs.filter(F.col("ref_words") >= MIN_REFERENCE_WORDS).withColumnRenamed("lang", "_l")
    side = broadcast_if_small(judged, refs.count(), BROADCAST_LANGUAGES)
    known = rows.join(side, F.col("lang").eqNullSafe(F.col("_l")), "left")
    long_chars = F.col("ref_words").isNotNull() & (F.col("word_chars") >= min_chars)
    long_words = F.col("ref_words").isNotNull() & (F.col("n_words") >= min_words)
    return (known.withColumn("char_distance", F.when(long_chars, js_distance(F.col("chars"), F.col("ref_chars"))))
            .withColumn("word_distance", F.when(long_words, words)).select(*rows.columns, "char_distance", "word_distance"))


def _bucket(distance: str) -> Column:
    return F.round(distance, 6)


def medians(near: DataFrame) -> DataFrame:
    """(lang, mc, mw): each language's lower medians of char_distance and word_distance rounded to
    six digits, exact and the same in every run: a histogram has a million buckets at most,
    however many documents there are."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), _bucket(f"{k}_distance").alias("d")) for k in ("char", "word")])).alias("v")
    sizes = near.select("lang", kinds).select("lang", "v.*").filter("d IS NOT NULL").groupBy("lang", "kind", "d").agg(F.count("*").alias("n"))
    all_ = Window.partitionBy("lang", "kind")
    half = (sizes.withColumn("up_to", F.sum("n").over(all_.orderBy("d"))).withColumn("total", F.sum("n").over(all_))
            .filter(2 * F.col("up_to") >= F.col("total")))
    return half.groupBy("lang").agg(F.min(F.when(F.col("kind") == "char", F.col("d"))).alias("mc"),
                                    F.min(F.when(F.col("kind") == "word", F.col("d"))).alias("mw"))


def quality(docs: DataFrame, max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE,
            min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """Base counts, char_distance and word_distance to the language reference (null where the
    text is too short to compare), base_failed and kept."""
    rows = written(counts(docs), "quality-counts")
    good = rows.filter(~F.col("base_failed"))
    first = written(references(good), "quality-references")
    near = written(with_distances(good, first, min_chars, min_words), "quality-distances")
    middle = medians(near).withColumnRenamed("lang", "_l")
    inner = near.join(broadcast_if_small(middle, first.count(), BROADCAST_LANGUAGES), F.col("lang").eqNullSafe(F.col("_l")))
    inner = inner.filter((_bucket("char_distance") <= F.col("mc")) | (_bucket("word_distance") <= F.col("mw"))).select(*rows.columns)
    out = with_distances(rows, written(references(inner), "quality-references"), min_chars, min_words)
    noise = F.lit(WORD_NOISE) / F.sqrt(F.col("n_words"))
    far = F.coalesce(F.col("char_distance") > max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > max_word_distance + noise, F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")
