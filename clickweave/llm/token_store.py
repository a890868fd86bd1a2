"""Token-ID output: fixed-width bit-packed shards with block offsets.

A shard is one binary value. Layout (little-endian):

    8 bytes   magic ``BITPACK1``
    4 x u32   bits per id, ids per block, number of blocks, number of documents
    u64       number of ids
    u32[]     byte offset of each block in the payload, and the payload's size
    u64[]     first id of each document in the shard, and the number of ids
    u8[]      payload: blocks of packed ids, each starting at a whole byte

Ids take the fewest bits that hold the vocabulary. As block offsets are known,
any range of ids unpacks with numpy without reading what stands before it.
Shards are rows of a Parquet table in the shared folder, so Spark's commit
protocol keeps them whole when executors are lost.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, arrow_slices, text_buffer
from clickweave.llm.text import range_hashes, words_of

END_ID = 2
BLOCK_IDS = 1024
SHARD_IDS = 1 << 20  # a shard is closed at this many ids; a longer document has a shard of its own
CACHED_PIECES = 1_500_000  # pieces whose ids a worker keeps; others are encoded again
MAGIC = b"BITPACK1"
_HEAD = struct.Struct("<8sIIIIQ")
# white space beyond ASCII, in UTF-8
_ODD = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a little-endian bit stream, the last byte filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: np.ndarray, bits: int, count: int) -> np.ndarray:
    """Inverse of ``pack`` for ``count`` ids, as u32."""
    if bits in (8, 16, 32):
        return data[:count * bits // 8].view(f"<u{bits // 8}").astype(np.uint32)
    planes = np.unpackbits(data, count=count * bits, bitorder="little").reshape(count, bits).astype(np.uint32)
    return (planes << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def write_shard(docs: list[np.ndarray], bits: int, block: int = BLOCK_IDS) -> bytes:
    """One shard holding the ids of each document in order."""
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype("<u8")
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    blocks = [pack(ids[a:a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u4")
    head = _HEAD.pack(MAGIC, bits, block, len(blocks), len(docs), len(ids))
    return b"".join([head, offsets.tobytes(), first.tobytes(), *blocks])


class Shard:
    """Random access to a packed shard."""

    def __init__(self, data: bytes) -> None:
        magic, self.bits, self.block, blocks, docs, self.n = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a packed shard")
        at = _HEAD.size
        self.offsets = np.frombuffer(data, "<u4", blocks + 1, at)
        at += self.offsets.nbytes
        self.first = np.frombuffer(data, "<u8", docs + 1, at).astype(np.int64)
        self.payload = np.frombuffer(data, np.uint8, offset=at + 8 * (docs + 1))

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end), touching only the blocks they lie in."""
        if end <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (end - 1) // self.block
        parts = [unpack(self.payload[self.offsets[k]:self.offsets[k + 1]], self.bits, min(self.block, self.n - k * self.block))
                 for k in range(a, b + 1)]
        return np.concatenate(parts)[start - a * self.block:end - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.first[i], self.first[i + 1])


@cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


def cut_pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges that the byte-level pre-tokenizer never joins across: together they are the texts.

    A word with the space before it; what white space stands before that, but
    for its last character, in one; that last character, if it isn't the
    word's space; white space at the end of a text. Only for texts whose white
    space is ASCII.
    """
    words = words_of(data, off, hashes=False)
    first = np.searchsorted(words.first[:-1], np.arange(len(words.start)), side="right") - 1
    gap = np.empty(len(words.start), np.int64)  # where the white space before a word begins
    gap[1:] = words.end[:-1]
    own = np.ones(len(gap), bool)
    own[1:] = first[1:] != first[:-1]
    gap[own] = off[first[own]]
    size = words.start - gap
    space = (size > 0) & (data[np.maximum(words.start - 1, 0)] == 32)
    tail = off[:-1].copy()
    full = np.flatnonzero(np.diff(words.first))
    tail[full] = words.end[words.first[full + 1] - 1]
    run, last, rest = size > 1, (size > 0) & ~space, tail < off[1:]
    start = np.concatenate([gap[run], words.start[last] - 1, words.start - space, tail[rest]])
    end = np.concatenate([words.start[run] - 1, words.start[last], words.end, off[1:][rest]])
    order = np.argsort(start, kind="stable")
    return start[order], end[order]


class Encoder:
    """Ids of whole texts, encoding each repeated piece once per worker.

    A text's ids are those of its pieces in order. Pieces are known by 64-bit
    hashes; the ids of those met so far lie in one array.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        none = np.zeros(0, np.int64)
        self.known = none.astype(np.uint64), none, none, none.astype(np.uint32)  # hashes (ascending), first id, count, ids

    def _lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First id and count of each piece, and the ids."""
        kinds, sample, kind = np.unique(range_hashes(data, start, end), return_index=True, return_inverse=True)
        keys, first, count, ids = self.known
        at = np.searchsorted(keys, kinds)
        new = np.flatnonzero(~(keys[np.minimum(at, len(keys) - 1)] == kinds) if len(keys) else np.ones(len(kinds), bool))
        if len(new):
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            size = np.fromiter(map(len, found), np.int64, len(found))
            more = np.fromiter((i for x in found for i in x), np.uint32, size.sum())
            keys, place = np.insert(keys, at[new], kinds[new]), at[new]
            first = np.insert(first, place, len(ids) + np.cumsum(size) - size)
            count, ids = np.insert(count, place, size), np.concatenate([ids, more])
            if len(keys) <= CACHED_PIECES:
                self.known = keys, first, count, ids
            at = np.searchsorted(keys, kinds)
        return first[at][kind], count[at][kind], ids

    def encode(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a UTF-8 buffer."""
        raw = data.tobytes()
        odd = {int(np.searchsorted(off, m.start(), side="right")) - 1 for m in _ODD.finditer(raw)}
        start, end = cut_pieces(data, off)
        if not len(start):
            return [np.zeros(0, np.uint32)] * (len(off) - 1)
        first, count, ids = self._lookup(data, start, end)
        flat = ids[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)]
        border = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, off)]
        out = [flat[a:b] for a, b in zip(border[:-1].tolist(), border[1:].tolist())]
        for i in odd:
            text = raw[off[i]:off[i + 1]].decode()
            out[i] = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        return out


@cache
def encoder(path: str) -> Encoder:
    """This process's encoder; Python workers keep it from task to task."""
    return Encoder(path)


def _encode(path: str, bits: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ids, count, shard, pid = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([shard], pa.int32()), pa.array([count], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([write_shard(ids, bits)], pa.binary())],
                ["part", "shard", "n_ids", "docs", "data"])

        for part in arrow_slices(batches, "text", 1 << 20):
            pid = part.column(2)[0].as_py()
            for doc, own in zip(part.column(0).to_pylist(), encoder(path).encode(*text_buffer(part.column(1)))):
                own = np.append(own, np.uint32(end_id)).astype(np.uint32)
                if count and count + len(own) > SHARD_IDS:
                    yield flush()
                    names, ids, count, shard = [], [], 0, shard + 1
                names.append(doc)
                ids.append(own)
                count += len(own)
        if names:
            yield flush()
    return run


RANGE_BYTES = 128 << 20  # of text in one range of ids, about


def write_tokens(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = END_ID) -> None:
    """Encode every text of ``docs`` and write packed shards, in ascending doc_id order, to the table at ``path``.

    Null and empty texts hold the end id only. Rows without a doc_id come
    first; rows that repeat one follow each other in the order of their texts'
    hashes. An empty table writes an empty one. Other columns are not read.
    """
    spark = docs.sparkSession
    held = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // RANGE_BYTES), 1)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _encode(tokenizer, bits_for(vocabulary), end_id), "part int, shard int, n_ids long, docs array<long>, data binary").write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch.column(3)[i].as_py())
            first = shard.first
            crc = [zlib.crc32(shard.document(k).astype("<u4").tobytes()) for k in range(len(first) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2)[i].values, pa.array(first[:-1] + batch.column(1)[i].as_py()), pa.array(np.diff(first)), pa.array(crc, pa.int64()),
                 pa.array([batch.column(0)[i].as_py()] * len(crc), pa.string())], ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, shard) from the shards at ``path``.

    ``start`` counts the ids of all documents before; the number of ids in
    each shard (one row per shard) gives it without reading the payloads.
    """
    shards = spark.read.schema("part int, shard int, n_ids long, docs array<long>, data binary").parquet(path)
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a row per task
    before, rows = 0, []
    for part in sorted(totals):
        rows.append((part, before))
        before += totals[part]
    base = spark.createDataFrame(rows, "part int, before long")
    inside = shards.select("part", "shard", "n_ids").withColumn(
        "skip", F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids"))
    at = inside.join(base, "part").select("part", "shard", (F.col("before") + F.col("skip")).alias("start"))
    return shards.join(at, ["part", "shard"]).select(
        F.concat_ws("-", "part", "shard").alias("shard"), "start", "docs", "data").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard string")


def token_output(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as packed shards in the shared folder and return what ``read_tokens`` finds in them."""
    scratch = Scratch(docs.sparkSession, "tokens")
    path = f"{scratch.root}/shards"
    write_tokens(docs, path, tokenizer, vocabulary, end_id)
    return read_tokens(docs.sparkSession, path)
