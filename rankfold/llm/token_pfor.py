"""Token ids in binary files of patched frame-of-reference (PFOR) blocks.

Documents are dealt by ranges of ``doc_id`` and sorted, each task encodes its documents and
writes segments; a segment is one binary value of the form

    "PFOR"  u16 version  u16 block  u32 n_docs  u64 n_ids  u32 n_blocks
    u64 x (n_docs + 1)    start of each document among the segment's ids, and their end
    u64 x (n_blocks + 1)  start of each block after this index, and their end
    blocks: u32 minimum  u8 width  u16 n_exceptions  u16 x n position  u32 x n value  packed

(all little-endian). A block holds ``block`` ids (the last one fewer). Its minimum is
subtracted, every difference is packed in ``width`` bits, the width that fits ``share`` of
the block's differences, and those that need more are stored whole in the exception list.
Any id range can be read through the block index without decoding the rest.

Segments are rows of a Parquet table (columns part, segment, doc_ids, n_ids, payload), so
Spark's commit protocol replaces the output of lost tasks. A document always lies in one
segment; a segment closes after about ``SEGMENT`` ids.

Ids come from the ``tokenizers`` library. BPE splits text before every run of spaces or line
feeds that follows another visible character, so such chunks are encoded once and remembered
(a bounded memo in each worker process); texts with other white space or a special token's string are
encoded whole. Both give the library's own ids. A tokenizer file with other settings than those this
rule holds for (see ``cuts_before_space``) encodes every text whole.

Nulls: a null text is an empty text (only the end id); null ids come first. Repeated rows
are each written. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.common import ship_by_value
from rankfold.session import scratch_path

ship_by_value(__name__)

BLOCK = 4096
SHARE = 0.95
WHOLE_BYTES = (8, 16, 32)  # widths whose packed bits are plain little-endian numbers
SEGMENT = 1_000_000
MEMO = 700_000  # chunks that a worker process remembers
HEAD = "<4sHHIQI"
BLOCK_HEAD = "<IBH"

CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
OTHER_SPACE = re.compile(r"[^\S \n]")


def encode(ids: np.ndarray, starts: np.ndarray, block: int = BLOCK, share: float = SHARE) -> bytes:
    """One segment of ``ids`` (unsigned 32-bit) whose documents begin at ``starts``."""
    ids = np.asarray(ids, dtype=np.uint32)
    blocks: list[bytes] = []
    for i in range(0, len(ids), block):
        part = ids[i:i + block]
        low = int(part.min())
        delta = part - np.uint32(low)
        fit = int(np.partition(delta, k := min(len(part) - 1, int(share * len(part))))[k])
        width = fit.bit_length()
        out = np.flatnonzero(delta >> np.uint32(width)) if width < 32 else np.array([], dtype=np.int64)
        if width in WHOLE_BYTES:
            packed = delta.astype(f"<u{width // 8}").tobytes()
        else:
            bits = np.unpackbits(delta.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
            packed = np.packbits(bits, bitorder="little").tobytes()
        blocks.append(struct.pack(BLOCK_HEAD, low, width, len(out)) + out.astype("<u2").tobytes()
                      + delta[out].astype("<u4").tobytes() + packed)
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = struct.pack(HEAD, b"PFOR", 1, block, len(starts), len(ids), len(blocks))
    return b"".join([head, np.append(starts, len(ids)).astype("<u8").tobytes(), offsets.tobytes(), *blocks])


class Segment:
    """Reads one segment."""

    def __init__(self, payload: bytes):
        magic, version, self.block, self.n_docs, self.n_ids, n_blocks = struct.unpack_from(HEAD, payload)
        if magic != b"PFOR" or version != 1:
            raise ValueError("not a PFOR segment")
        at = struct.calcsize(HEAD)
        self.starts = np.frombuffer(payload, "<u8", self.n_docs + 1, at).astype(np.int64)
        self.offsets = np.frombuffer(payload, "<u8", n_blocks + 1, at := at + 8 * (self.n_docs + 1)).astype(np.int64)
        self.body, self.payload = at + 8 * (n_blocks + 1), payload

    def read_block(self, k: int) -> np.ndarray:
        n = min(self.block, self.n_ids - k * self.block)
        at = self.body + int(self.offsets[k])
        low, width, n_out = struct.unpack_from(BLOCK_HEAD, self.payload, at)
        at += struct.calcsize(BLOCK_HEAD)
        where = np.frombuffer(self.payload, "<u2", n_out, at)
        value = np.frombuffer(self.payload, "<u4", n_out, at + 2 * n_out)
        if width in WHOLE_BYTES:
            delta = np.frombuffer(self.payload, f"<u{width // 8}", n, at + 6 * n_out).astype(np.uint32)
        else:
            packed = np.frombuffer(self.payload, np.uint8, (n * width + 7) // 8, at + 6 * n_out)
            bits = np.zeros((n, 32), dtype=np.uint8)
            bits[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
            delta = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
        delta[where] = value
        return delta + np.uint32(low)

    def read(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo..hi, decoding only the blocks that hold them."""
        hi = self.n_ids if hi is None else hi
        if hi <= lo:
            return np.array([], dtype=np.uint32)
        first = lo // self.block
        parts = [self.read_block(k) for k in range(first, (hi - 1) // self.block + 1)]
        return np.concatenate(parts)[lo - first * self.block:hi - first * self.block]


def cuts_before_space(settings: dict) -> bool:
    """Whether a tokenizer surely cuts a text before each run of spaces or line feeds that follows a
    visible character, and between a letter and a full stop: plain BPE over the byte-level regex
    split, with no normalizer, added prefix, truncation, padding, dropout or word affixes."""
    model, pre = settings.get("model") or {}, settings.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and model.get("type", "BPE") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
            and not any(settings.get(k) for k in ("normalizer", "truncation", "padding")))


class Encoder:
    """Texts to little-endian 32-bit ids, remembering chunks where the tokenizer's settings allow it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.memo, self.limit = Tokenizer.from_file(path), {}, MEMO
        settings = json.loads(self.tokenizer.to_str())
        self.cuts = cuts_before_space({k: settings.get(k) for k in ("normalizer", "pre_tokenizer", "truncation", "padding")}
                                      | {"model": {k: v for k, v in settings["model"].items() if k not in ("vocab", "merges")}})
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        space = ("\u0120", "\u010a")  # how byte-level tokens write a space and a line feed
        self.starts = np.array([t.startswith(space) for t in tokens])
        self.marks = {c: self.whole(c) for c in ".,"}
        self.blank = np.array([bool(t) and not t.strip("".join(space)) for t in tokens])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks into the memo. Those of the form space + visible are joined: no token
        reaches over their borders, and a border is a token that starts with space after one
        that is not all space. A full stop or comma after a Latin letter is a token of its own, so
        such a chunk is put together from its stem."""
        whole = self.memo
        stems = {c: c[:-1] for c in chunks if c[-1] in ".," and c[-2:-1].isalpha() and c[-2] < "\u0250"}
        need = {s for s in stems.values() if s not in whole}
        need.update(c for c in chunks if c not in stems)
        joined = [c for c in need if c[0] in " \n" and c[-1] not in " \n"]
        if joined:
            e = self.tokenizer.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0]
            ids = np.array(e.ids, dtype="<u4")
            border = self.starts[ids]
            border[1:] &= ~self.blank[ids[:-1]]
            at = np.append(np.flatnonzero(border), len(ids)) * 4
            if len(at) == len(joined) + 1:
                data = ids.tobytes()
                whole.update(zip(joined, map(data.__getitem__, map(slice, at[:-1].tolist(), at[1:].tolist()))))
        for c in need:
            if c not in whole:
                whole[c] = self.whole(c)
        for c, stem in stems.items():
            whole[c] = whole[stem] + self.marks[c[-1]]

    def chunks(self, text: str) -> list[str] | None:
        """Cut ``text`` where the library surely cuts it; None if it must be encoded whole."""
        if not self.cuts or OTHER_SPACE.search(text) or any(s in text for s in self.special):
            return None
        return CHUNK.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > self.limit:
            self.memo.clear()
        known, rows, new = self.memo.get, [], set()
        for t in texts:
            chunks = self.chunks(t)
            if chunks is None:
                rows.append(([], [self.whole(t)], []))
                continue
            coded = list(map(known, chunks))
            missing = [i for i, v in enumerate(coded) if v is None]
            new.update([chunks[i] for i in missing])
            rows.append((chunks, coded, missing))
        self.learn(list(new))
        for chunks, coded, missing in rows:
            for i in missing:
                coded[i] = self.memo[chunks[i]]
        return [b"".join(coded) for _, coded, _ in rows]


def task_encoder(path: str) -> Encoder:
    """The worker process's encoder for ``path``. Spark reuses its Python workers, but what a
    shipped function holds is new in every task; a module of its own outlives the task."""
    state = sys.modules.setdefault("rankfold_task_state", types.ModuleType("rankfold_task_state")).__dict__
    if path not in state:
        state[path] = Encoder(path)
    return state[path]


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, block: int = BLOCK,
                 share: float = SHARE, segment: int = SEGMENT, memo: int = MEMO) -> None:
    """Encode every text, append ``end_id`` and write segments in ascending doc_id order. A worker
    remembers up to ``memo`` chunks (about 200 bytes each)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all that it may use
        encoder, part, number = task_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        encoder.limit = memo
        end = np.array([end_id], dtype="<u4").tobytes()
        held_ids, held, total = [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(h) // 4 for h in held])
            ids = np.frombuffer(b"".join(held), "<u4")
            payload = encode(ids, np.append(0, np.cumsum(lengths)[:-1]), block, share)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([held_ids], pa.list_(id_type)), pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "segment", "doc_ids", "n_ids", "payload"])

        for b in batches:
            id_type = b.column("doc_id").type
            for i in range(0, b.num_rows, 256):
                few = b.slice(i, 256)
                coded = encoder.encode([t or "" for t in few.column("text").to_pylist()])
                for doc_id, ids in zip(few.column("doc_id").to_pylist(), coded):
                    held_ids.append(doc_id)
                    held.append(ids + end)
                    total += len(held[-1]) // 4
                    if total >= segment:
                        yield flush()
                        held_ids, held, total, number = [], [], 0, number + 1
        if held:
            yield flush()

    text_hash = F.xxhash64("text")
    dealt = (docs.select("doc_id", "text").repartitionByRange("doc_id", text_hash)
             .sortWithinPartitions("doc_id", text_hash))
    (dealt.mapInArrow(run, f"part int, segment int, doc_ids array<{kind}>, n_ids long, payload binary")
     .write.parquet(path))


def read_tokens(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and, if asked for, the ids."""
    files = spark.read.parquet(path)
    # offsets: within a part over its segments, and over one row for each part
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("part", "segment", "n_ids")
    in_part = sizes.select("part", "segment", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("inner"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("outer"))
    base = in_part.join(parts, "part").select("part", "segment", (F.col("inner") + F.col("outer")).alias("base"))
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    shape = f"part int, segment int, doc_id {kind}, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, number, doc_ids, payload in zip(*(b.column(c) for c in ("part", "segment", "doc_ids", "payload"))):
                s = Segment(payload.as_py())
                ids, n = s.read(), s.n_docs
                spans = list(zip(s.starts[:-1], s.starts[1:]))
                columns = [pa.array([part.as_py()] * n, pa.int32()), pa.array([number.as_py()] * n, pa.int32()),
                           doc_ids.values, pa.array(s.starts[:-1]), pa.array(np.diff(s.starts)),
                           pa.array([zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in spans], pa.int64())]
                if with_ids:
                    columns.append(pa.array([ids[x:y].astype(np.int64) for x, y in spans], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in shape.split(", ")])

    out = files.select("part", "segment", "doc_ids", "payload").mapInArrow(run, shape).join(base, ["part", "segment"])
    return out.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_digest(docs: DataFrame, tokenizer_path: str, path: str | None = None, end_id: int = 0, memo: int = MEMO) -> DataFrame:
    """Write ``docs`` as token files (to the shared scratch folder unless ``path`` is given) and
    return what the files hold for each document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer_path, path, end_id, memo=memo)
    return read_tokens(spark, path)
