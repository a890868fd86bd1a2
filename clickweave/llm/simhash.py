"""SimHash near-duplicates: pigeonhole blocks over 64-bit fingerprints.

A fingerprint is split into ``max_bits + 4`` blocks. Fingerprints at most
``max_bits`` apart agree on at least 4 blocks, so they meet under one of the
keys made of 4 blocks; the Hamming distance decides. Equal fingerprints are
collapsed first, so groups of copies never form pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import NULL_KEY, Scratch, arrow_slices, components, key_of

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
PAIR_GROUP = 64  # block groups up to this size are joined; larger ones are linked through one-bit variants


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(whole, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size)
    start = (end - size)[:len(words) - width + 1].tolist()
    end = (end - 1)[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(start), 50_000):
        h = np.array([digest(whole[a:b], SEED) for a, b in zip(start[at:at + 50_000], end[at:at + 50_000])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(start)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _map_fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text", 1 << 22):
            texts = part.column(2)
            fp = np.fromiter((fingerprint(t.as_py(), width) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))], ["doc_id", "row", "fp"])
    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, row, fp long) for every row of ``docs``; ``row`` is the hash of the text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(_map_fingerprints(width), "doc_id long, row long, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Masks (signed 64-bit) that each keep 4 of ``max_bits + 4`` blocks."""
    n = max_bits + 4
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n)]
    return [_signed(sum(c)) for c in combinations(blocks, 4)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(scratch: Scratch, distinct: DataFrame, max_bits: int = MAX_BITS, pair_group: int = PAIR_GROUP) -> DataFrame:
    """Edges (a, b) that connect all fingerprints at most ``max_bits`` apart.

    Groups of up to ``pair_group`` fingerprints under one key are joined and
    checked. In a larger group the key's blocks are equal, so only the other
    blocks can differ: each fingerprint emits its variants with up to
    half of ``max_bits`` of those bits flipped, and fingerprints sharing a
    variant hang on the smallest of them. (An odd bound has no such middle
    point: there a fingerprint meets the full-radius variants of the others.)
    Exact; linear in the group for an even bound.
    """
    masks = block_masks(max_bits)
    keyed = distinct.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                                                       for t, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    sizes = scratch.table(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "block-sizes")
    shared = scratch.table(keyed.join(sizes, ["t", "key"]), "blocks")
    few = shared.where(F.col("n") <= pair_group)
    pairs = few.select("t", "key", F.col("fp").alias("a")).join(few.select("t", "key", F.col("fp").alias("b")), ["t", "key"])
    pairs = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b").distinct()
    many = shared.where(F.col("n") > pair_group).select("fp", "t")
    reach = max_bits if max_bits % 2 else max_bits // 2
    flips = []
    for m in masks:
        free = [1 << i for i in range(64) if not (m >> i) & 1]
        flips.append([_signed(sum(c)) for r in range(reach + 1) for c in combinations(free, r)])
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in flips])
    variants = many.select("fp", F.explode(F.element_at(table, F.col("t") + 1)).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("v")).distinct()
    if max_bits % 2 == 0:
        hub = scratch.table(variants.groupBy("v").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("v", "a"), "hubs")
        star = variants.join(hub, "v").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()
    else:
        hub = scratch.table(variants.alias("v"), "hubs")
        near = distinct.select(F.col("fp").alias("a")).join(hub.select(F.col("fp").alias("b"), F.col("v").alias("a")), "a")
        star = near.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b").distinct()
    return scratch.table(pairs.unionByName(star), "links")


def simhash_groups(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (doc_id, row, fingerprint, component_id) for every row of ``docs``; ``row`` is the hash of the text.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits. Null and empty texts have fingerprint zero
    and link like any other. Rows without a doc_id keep it null; a component
    of such rows only has a null id. Repeated rows stay. Other columns of
    ``docs`` are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.table(fingerprints(docs, width), "fingerprints")
    classes = scratch.table(marked.groupBy("fp").agg(F.min(key_of("doc_id")).alias("least")), "classes")
    edges = links(scratch, classes.select("fp"), max_bits)
    parts = components(scratch, edges)
    joined = scratch.table(parts.join(classes.withColumnRenamed("fp", "node"), "node"), "parts")
    least = scratch.table(joined.groupBy("comp").agg(F.min("least").alias("component")), "least")
    linked = joined.join(least, "comp").select(F.col("node").alias("fp"), "component")
    of_class = scratch.table(classes.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component")), "of-class")
    out = marked.join(of_class, "fp")
    return out.select("doc_id", "row", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("component") != NULL_KEY, F.col("component")).alias("component_id"))
