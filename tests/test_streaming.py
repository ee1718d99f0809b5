"""Batch operators applied to a stream source give the batch answer."""

from rankfold.operators import text
from rankfold.session import scratch_path
from rankfold.streaming import incremental


def test_word_count_over_text_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("the cat\nA cat\n")
    (src / "b.txt").write_text("hat\n")
    stream = spark.readStream.text(str(src)).withColumnRenamed("value", "line")
    q = incremental(stream, lambda df: text.word_count(df, text.NON_WORD, lower=True), "wc_stream",
                    scratch_path(spark, "stream-ckpt"), str(tmp_path / "out"))
    try:
        q.processAllAvailable()
        got = {r["word"]: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    finally:
        q.stop()
    assert got == {"the": 1, "cat": 2, "a": 1, "hat": 1}
