"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered once with that speaker as
the assistant and all others as named users; the training mask covers the texts of the
assistant's turns only. Narrators (``system``) speak to all and are nobody's perspective.

    <|system|>                    <|user name=ann|>            <|assistant|>
    text                          text                         text

A rendering is cut into segments of at most ``max_turns`` turns, numbered from 0, so a
conversation of any length never meets in one task: turns are ranked by a range partitioning
over (conversation, turn), with an offset for each conversation and partition, and only the
turns of one segment are gathered.

Turns are ordered by ``turn`` (null first), ties by speaker, text and input order. Nulls: a
null text is empty, a null speaker is called ``unknown``, a null conversation is one
conversation. Repeated rows are turns of their own. ``<|`` in a text or name is written
``< |``, so no text can pose as a header. A conversation of narrators only has no rendering;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import let, written

MAX_TURNS = 256
NARRATORS = ("system",)


def ranked_turns(turns: DataFrame) -> DataFrame:
    """Add ``rank``, the position of each turn in its conversation from 0."""
    order = ["conv_id", "turn", "speaker", "text", "_at"]
    dealt = turns.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(dealt.withColumn("_mid", F.monotonically_increasing_id()).drop("_at"), "chat-turns")
    rows = rows.withColumn("_part", F.shiftright("_mid", 33))
    runs = rows.groupBy("conv_id", "_part").agg(F.min("_mid").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    runs = runs.select(F.col("conv_id").alias("_c"), F.col("_part").alias("_p"), "_first", "_base")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_part") == F.col("_p"))
    return rows.join(runs, same).withColumn("rank", F.col("_mid") - F.col("_first") + F.col("_base")).select(
        "conv_id", "turn", "speaker", "text", "rank")


def rotate(conversations: DataFrame, speaker: str = "role", narrators: tuple[str, ...] = NARRATORS,
           max_turns: int = MAX_TURNS) -> DataFrame:
    """conv_id, perspective, segment, n_turns, text and spans: an array of struct<start, end>,
    the code point ranges of ``text`` to train on."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    turns = conversations.select("conv_id", "turn", safe(F.coalesce(F.col(speaker), F.lit("unknown"))).alias("speaker"),
                                 safe(F.coalesce("text", F.lit(""))).alias("text"))
    ranked = ranked_turns(turns)
    segments = ranked.groupBy("conv_id", F.floor(F.col("rank") / max_turns).cast("long").alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "speaker", "text"))).alias("turns"))
    people = (turns.filter(~F.col("speaker").isin(list(narrators))).select(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective"))
              .distinct())
    seen = segments.join(people, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")

    def piece(t):
        own = t["speaker"] == F.col("perspective")
        head = F.when(own, F.lit("<|assistant|>\n")).when(
            t["speaker"].isin(list(narrators)), F.concat(F.lit("<|"), t["speaker"], F.lit("|>\n"))).otherwise(
            F.concat(F.lit("<|user name="), t["speaker"], F.lit("|>\n")))
        return F.struct(head.alias("head"), t["text"].alias("text"), own.alias("own"))

    def rendering(parts):
        whole = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["text"], F.lit("\n"))), "")
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def step(s, p):
            a = s["at"] + F.length(p["head"])
            b = a + F.length(p["text"])
            return F.struct((b + 1).alias("at"), F.when(p["own"], F.concat(s["spans"], F.array(F.struct(a.alias("start"), b.alias("end"))))
                                                        ).otherwise(s["spans"]).alias("spans"))

        return F.struct(whole.alias("text"), F.aggregate(parts, start, step)["spans"].alias("spans"))

    out = seen.withColumn("r", let(F.transform("turns", piece), rendering))
    return out.select("conv_id", "perspective", "segment", F.size("turns").cast("long").alias("n_turns"), "r.text", "r.spans")


def mask_text(spans):
    """Spans as "start-end,start-end"."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS rank FROM t),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
pieces AS (SELECT r.conv_id, perspective, rank // {MAX_TURNS} AS segment, rank, text, speaker = perspective AS own,
  CASE WHEN speaker = perspective THEN '<|assistant|>' WHEN speaker = 'system' THEN '<|system|>' ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head
  FROM ranked r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (SELECT *, sum(length(head) + length(text) + 1) OVER (PARTITION BY conv_id, perspective, segment ORDER BY rank) - length(text) - 1 AS a FROM pieces)
SELECT conv_id, perspective, segment, count(*) AS n_turns, string_agg(head || text || chr(10), '' ORDER BY rank) AS text,
  coalesce(string_agg(a::BIGINT || '-' || (a + length(text))::BIGINT, ',' ORDER BY rank) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, perspective, segment
"""
