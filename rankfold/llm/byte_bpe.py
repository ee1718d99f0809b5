"""Byte-level BPE encoding and decoding with the ``tiktoken`` library.

The vocabulary is a local rank file (lines ``base64-bytes rank``) and a splitting pattern;
both are parameters. ``encode`` turns each text into the ids that ``encode_ordinary`` gives
for the whole text: no special tokens, every match of the pattern merged on its own. Ids are
one binary value a document, little-endian unsigned 32-bit integers. ``decode`` joins the raw
bytes of the tokens; bytes that form no valid UTF-8 stay as they are.

Long texts are split before they reach the library, at places where the pattern surely ends a
match, so the ids are those of the whole text:

* before white space that follows another character: no alternative of the pattern goes
  from another character on to white space, and none looks behind;
* inside a long run of white space, before its last character: the run up to there is one
  match, whatever follows. Such a run is merged as bytes, as the library's backtracking over
  it overflows its stack.

A text without white space stays whole; the library takes it in n log n.

Nulls: a null text is an empty text and has no ids; null ids decode to no bytes. Repeated rows
are each encoded; an empty table gives an empty result. Columns other than the named ones are
ignored, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.common import ship_by_value

ship_by_value(__name__)

# Unicode's White_Space, what ``\s`` means in the pattern
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PART = 200_000      # characters; a longer text is split at the next safe place
WHITE_RUN = 10_000  # characters of white space from which on a run is merged as bytes
FEW = 256           # texts encoded before their ids are handed on
BORDER = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
LONG_RUN = re.compile(f"[{WHITE}]{{{WHITE_RUN},}}")


def parts(text: str, size: int = PART, runs: re.Pattern = LONG_RUN) -> Iterator[tuple[bool, str]]:
    """(is it one match, characters) of the stretches of ``text``; joined they give it again."""
    at = 0
    for run in runs.finditer(text):
        yield from ((False, x) for x in stretches(text, at, run.start(), size))
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield True, text[run.start():end]
        at = end
    yield from ((False, x) for x in stretches(text, at, len(text), size))


def stretches(text: str, at: int, end: int, size: int) -> Iterator[str]:
    """``text[at:end]`` cut at the first border after every ``size`` characters."""
    while end - at > size and (border := BORDER.search(text, at + size, end)):
        yield text[at:border.start()]
        at = border.start()
    if at < end:
        yield text[at:end]


class Coder:
    """Texts to ids and back by one rank file and pattern."""

    def __init__(self, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if len(text) < WHITE_RUN:
            ids: Iterable[int] = self.library.encode_ordinary(text)
        else:
            ids = []
            for single, part in parts(text):
                ids += self.library._encode_single_piece(part) if single else self.library.encode_ordinary(part)
        return np.array(ids, dtype="<u4").tobytes()

    def decode(self, ids: bytes | None) -> bytes:
        return self.library.decode_bytes(np.frombuffer(ids or b"", dtype="<u4").tolist())


def task_coder(ranks: str, pattern: str) -> Coder:
    """The worker process's coder: Spark reuses its Python workers, but what a shipped function
    holds is new in every task; a module of its own outlives the task."""
    state = sys.modules.setdefault("rankfold_byte_bpe_state", types.ModuleType("rankfold_byte_bpe_state")).__dict__
    if (ranks, pattern) not in state:
        state[ranks, pattern] = Coder(ranks, pattern)
    return state[ranks, pattern]


def _mapped(df: DataFrame, source: str, out: str, method: str, ranks: str, pattern: str, keep: list[str]) -> DataFrame:
    """``keep`` and the binary column ``out`` that the coder's ``method`` makes of ``source``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = getattr(task_coder(ranks, pattern), method)
        for b in batches:
            for i in range(0, b.num_rows, FEW):
                few = b.slice(i, FEW)
                made = pa.array([code(v) for v in few.column(source).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(few.column(c) for c in keep), made], names=[*keep, out])

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return df.select(*keep, *([source] if source not in keep else [])).mapInArrow(run, ", ".join([*kinds, f"`{out}` binary"]))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``ids`` (binary) of every row of ``docs``."""
    return _mapped(docs, text, "ids", "encode", ranks, pattern, [id_column])


def decode(coded: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """``id_column``, ``ids`` and ``bytes``, the raw bytes of the tokens in order."""
    return _mapped(coded, "ids", "bytes", "decode", ranks, pattern, [id_column, "ids"])


def n_tokens(ids: Column) -> Column:
    return F.shiftright(F.octet_length(ids), 2).cast("long")


def id_array(ids: Column) -> Column:
    """``ids`` as array<long>, natively."""
    def at(i):
        return F.conv(F.concat(*[F.hex(F.substring(ids, 4 * i + k, 1)) for k in (4, 3, 2, 1)]), 16, 10).cast("long")

    n = n_tokens(ids).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<bigint>"))


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Encode every text, decode the ids, and give per row: ``id_column``, n_tokens, and the
    SHA-256 of the ids and of the decoded bytes."""
    both = decode(encode(docs, ranks, pattern, text, id_column), ranks, pattern, id_column)
    return both.select(id_column, n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))
