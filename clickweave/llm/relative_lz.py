"""Substring de-duplication by relative Lempel-Ziv factors.

Every document is parsed against an index of all reference blocks. Blocks are
cut where the content says so: a window of ``window`` words belongs to the
leftmost smallest hash among the runs of ``anchor`` words inside it, and
consecutive windows with the same anchor form one block. Equal texts are cut
alike wherever they stand, so the references that can share a window with a
block are those of the same anchor, and the index is partitioned by anchor:

* blocks that equal a reference block are one factor each, taken in one step;
* every other block is factored greedily: at a position the longest match in
  any reference block of a smaller document is taken, and the parse goes on at
  the factor's boundary, at the first window the factor does not hold. Factors
  of ``window`` words or more are copied spans.

Reference blocks of one anchor that are not alike are few, but a passage that
a third of all documents surround with words of their own has as many as there
are documents. Anchors of more than ``REFERENCES`` different blocks are split
by window instead: all windows of their blocks are looked up by hash, which is
the same question asked for factors of exactly ``window`` words.

A window counts as copied if its words also start in a document with a smaller
id; words under copied windows are removed. Hashes are 64-bit, two for a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, arrow_slices, key_of, text_buffer
from clickweave.llm.text import RangeHash, Words, window_min, words_of

WINDOW = 50
ANCHOR = 20
REFERENCES = 256  # different blocks of one anchor that a block is factored against in one task
_POSITION_BITS = 24
_KINDS = 4096  # blocks in an emitted batch


def anchors_of(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, RangeHash]:
    """Blocks of several texts: (text, first window, number of windows, anchor word) and the range hash of the words."""
    hashed = RangeHash(words.hash)
    n = len(words.hash)
    count = np.maximum(np.diff(words.first) - window + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none, none, none, hashed
    starts = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(words.first[:-1], count)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    at = np.arange(n - anchor + 1)
    best = np.empty(len(starts), np.int64)
    span = window - anchor + 1
    grams = hashed(at, at + anchor) & ~low
    step = (1 << _POSITION_BITS) - span  # positions stay comparable inside one stretch
    for a in range(0, len(grams), step):
        part = grams[a:a + step + span] | np.arange(len(grams[a:a + step + span]), dtype=np.uint64)
        if len(part) < span:
            break
        least = (window_min(part, span) & low).astype(np.int64) + a
        mine = np.flatnonzero((starts >= a) & (starts < a + min(step, len(least))))
        best[mine] = least[starts[mine] - a]
    head = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (text[1:] != text[:-1])]))
    size = np.diff(np.concatenate([head, [len(best)]]))
    return text[head], starts[head], size, best[head], hashed


def _blocks(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text"):
            words = words_of(*text_buffer(part.column(2)))
            text, start, size, at, hashed = anchors_of(words, window, anchor)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text)),
                 pa.array(hashed(at, at + anchor).view(np.int64)), pa.array(hashed(start, start + size - 1 + window).view(np.int64)),
                 pa.array((start - words.first[text]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array((at - start).astype(np.int32))],
                ["doc", "row", "gram", "block", "start", "n", "lead"])
    return run


def _references(window: int):
    """The word hashes of the listed blocks: rows (gram, block, doc, lead, words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text"):
            words = words_of(*text_buffer(part.column(1)))
            lists = part.column(2)
            todo = lists.flatten()
            text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            begin = todo.field("start").to_numpy().astype(np.int64) + words.first[text]
            size = todo.field("n").to_numpy().astype(np.int64) - 1 + window
            for k in range(0, len(size), _KINDS):
                some = slice(k, k + _KINDS)
                each = np.repeat(np.arange(len(size[some])), size[some])
                first = np.concatenate([[0], np.cumsum(size[some])])
                values = words.hash[begin[some][each] + np.arange(len(each)) - first[each]]
                yield pa.RecordBatch.from_arrays(
                    [todo.field("gram")[some], todo.field("block")[some], part.column(0).take(pa.array(text[some])), todo.field("lead")[some],
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))],
                    ["gram", "block", "doc", "lead", "words"])
    return run


def greedy(low: np.ndarray, high: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Factors (start, end, reference) of a block that reference j shares from ``low[j]`` to ``high[j]``.

    The longest match at the position is taken, the first reference if several
    are as long; the next position is the first window that the factor does not
    hold, so a factor of another reference may begin inside it. Positions at
    which no match has ``window`` words are passed over.
    """
    long = np.flatnonzero(high - low >= window)
    low, high = low[long], high[long]
    out, at = [], 0
    while len(low):
        reach = np.where(low <= at, high, -1)
        best = int(reach.argmax())
        if reach[best] - at >= window:
            out.append((at, int(reach[best]), int(long[best])))
            at = int(reach[best]) - window + 1
            continue
        later = low[low > at]
        if not len(later):
            break
        at = int(later.min())
    return out


def _run(same: np.ndarray) -> np.ndarray:
    """Length of the run of true values that each row begins with."""
    if not same.shape[1]:
        return np.zeros(len(same), np.int64)
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


def factors(docs: np.ndarray, lead: np.ndarray, size: np.ndarray, words: np.ndarray, window: int, anchor: int) -> Iterator[tuple[int, int, int, int]]:
    """Factors (block, start, end, reference document) of the blocks of one anchor, in ascending order of their documents.

    A block has ``size`` words, its anchor stands after ``lead`` of them. All
    blocks lie in one table with the anchors one below the other, and each is
    compared with the rows of smaller documents, outwards from the anchor.
    """
    side = window - anchor
    row = np.repeat(np.arange(len(docs)), size)
    table = np.zeros((len(docs), side + window), np.int64)
    table[row, np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size) + (side - lead)[row]] = words
    earlier = np.searchsorted(docs, docs)
    for i in range(len(docs)):
        if not earlier[i]:
            continue
        a, begin = int(lead[i]), int(side - lead[i])
        same = table[:earlier[i], begin:begin + size[i]] == table[i, begin:begin + size[i]]
        real = same[:, a:a + anchor].all(axis=1)
        low = np.where(real, a - _run(same[:, :a][:, ::-1]), 0)
        high = np.where(real, a + anchor + _run(same[:, a + anchor:]), 0)
        for start, end, source in greedy(low, high, window):
            yield i, start, end, int(docs[source])


def _parse(window: int, anchor: int):
    """Reference blocks sorted by (gram, doc) -> factors (gram, block, start, end, source)."""
    names = ["gram", "block", "start", "end", "source"]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of whole anchors; an anchor may go on in the next batch."""
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column(0).to_numpy()
            edge = np.flatnonzero(gram[1:] != gram[:-1]) + 1
            begins = bool(kept) and kept[-1].column(0)[0].as_py() != gram[0]
            if begins or len(edge):
                last = int(edge[-1]) if len(edge) else 0
                yield pa.Table.from_batches([*kept, batch.slice(0, last)]).combine_chunks()
                kept = [batch.slice(last)]
            else:
                kept.append(batch)
        if kept:
            yield pa.Table.from_batches(kept).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches):
            gram, block, docs = (part.column(c).to_numpy() for c in range(3))
            lead = part.column(3).to_numpy().astype(np.int64)
            lists = part.column(4).combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.chunk(0)
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            words, first = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)])
            edge = np.concatenate([[0], np.flatnonzero(gram[1:] != gram[:-1]) + 1, [len(gram)]])
            out = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                found = factors(docs[a:b], lead[a:b], size[a:b], words[first[a]:first[b]], window, anchor)
                out += [(gram[a], block[a + i], start, end, source) for i, start, end, source in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*out)], names)
    return run


def _windows(window: int):
    """Window hashes of reference blocks: rows (gram, block, at, h1, h2, doc)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            lists = part.column(4)
            words = lists.flatten().to_numpy().view(np.uint64)
            first, second = RangeHash(words), RangeHash(words ^ np.uint64(0xA5A5_5A5A_1234_FEDC))
            length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            size = length - window + 1
            each = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
            begin = (np.cumsum(length) - length)[each] + at
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(each)), part.column(1).take(pa.array(each)), pa.array(at.astype(np.int32)),
                 pa.array(first(begin, begin + window).view(np.int64)), pa.array(second(begin, begin + window).view(np.int64)),
                 part.column(2).take(pa.array(each))], ["gram", "block", "at", "h1", "h2", "doc"])
    return run


def _spans(window: int):
    """Runs of copied windows as word spans: (doc, row, start, least document of each window) -> (doc, row, start, end, source)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            doc = part.column(0).to_numpy()
            lists = part.column(3)
            flat = lists.flatten()
            text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            copied = np.flatnonzero(flat.field("least").to_numpy() < doc[text])
            text = text[copied]
            begin = part.column(2).to_numpy().astype(np.int64)[text] + flat.field("at").to_numpy()[copied]
            order = np.lexsort((begin, text))
            text, begin, least = text[order], begin[order], flat.field("least").to_numpy()[copied][order]
            head = np.concatenate([[True], (text[1:] != text[:-1]) | (begin[1:] != begin[:-1] + 1)])[:len(text)]
            head = np.flatnonzero(head)
            size = np.diff(np.concatenate([head, [len(text)]]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text[head])), part.column(1).take(pa.array(text[head])),
                 pa.array(begin[head]), pa.array(begin[head] + size - 1 + window),
                 pa.array(np.minimum.reduceat(least, head) if len(head) else least)], ["doc", "row", "start", "end", "source"])
    return run


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n words lie under a span."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def _keep(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text"):
            data, off = text_buffer(part.column(1))
            words = words_of(data, off, hashes=False)
            raw, spans = words.data.tobytes(), part.column(2)
            n = np.diff(words.first)
            removed, kept, cut = np.zeros(len(n), np.int64), [], []
            for i in range(len(n)):
                pairs = spans[i].as_py() or []
                if not pairs:
                    cut.append([])
                    kept.append(b" ".join(raw[off[i]:off[i + 1]].split()))
                    continue
                mine = slice(words.first[i], words.first[i + 1])
                gone = covered(n[i], np.array([p["start"] for p in pairs]), np.array([p["end"] for p in pairs]))
                removed[i] = gone.sum()
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
                cut.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(b" ".join([raw[a:b] for a, b in zip(words.start[mine][~gone].tolist(), words.end[mine][~gone].tolist())]))
            text = pa.array(kept, pa.binary()).cast(pa.string()) if with_text else pa.nulls(len(n), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(removed), pa.array(cut, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 text, pa.array([hashlib.sha256(t).hexdigest() for t in kept])], ["doc_id", "n_words", "n_removed", "spans", "kept", "kept_sha256"])
    return run


def copied_spans(docs: DataFrame, scratch: Scratch, window: int = WINDOW, anchor: int = ANCHOR,
                 references: int = REFERENCES) -> tuple[DataFrame, DataFrame]:
    """The documents as (doc_id, doc, row, text) and their factors (doc, row, start, end, source) in words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", key_of("doc_id").alias("doc"), F.xxhash64("text").alias("row"), "text")
    blocks = scratch.table(texts.select("doc", "row", "text").mapInArrow(
        _blocks(window, anchor), "doc long, row long, gram long, block long, start int, n int, lead int"), "blocks")
    # anchors of more than one document; alike: all of them stand in one and the same block
    index = scratch.table(blocks.groupBy("gram").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.min("block").alias("b1"),
                                                     F.max("block").alias("b2")).where("least < most").select(
        "gram", "least", F.expr("b1 = b2").alias("alike")), "index")
    shared = scratch.table(blocks.join(index, "gram"), "shared")
    scratch.drop("blocks", "index")

    def whole(rows: DataFrame, source: str) -> DataFrame:
        return rows.where(F.col("doc") > F.col(source)).select(
            "doc", "row", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("n") - 1 + window).cast("long").alias("end"),
            F.col(source).alias("source"))

    edge = shared.where("NOT alike")
    # equal blocks: the least document stands for all, and the others copy the block whole
    kinds = scratch.table(edge.groupBy("gram", "block").agg(F.min(F.struct("doc", "row", "start", "n", "lead")).alias("r")).select(
        "gram", "block", "r.*"), "kinds")
    ranked = scratch.table(edge.join(kinds.select("gram", "block", F.col("doc").alias("least_doc")), ["gram", "block"]), "ranked")
    lists = kinds.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "n", "lead", "gram", "block")).alias("todo"))
    lists = scratch.table(lists, "lists")
    listed = texts.select("doc", "row", "text").join(lists, ["doc", "row"]).select("doc", "text", "todo").mapInArrow(
        _references(window), "gram long, block long, doc long, lead int, words array<long>")
    # repeated rows of one document list a block more than once: the same words
    listed = scratch.table(listed, "references")
    many = scratch.table(kinds.groupBy("gram").count().where(F.col("count") > references).select("gram"), "many")
    few = listed.join(many, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram", "doc")
    parsed = scratch.table(few.mapInArrow(_parse(window, anchor), "gram long, block long, start long, end long, source long").distinct(), "factors")
    own = ranked.where("doc = least_doc").select("doc", "row", "gram", "block", F.col("start").cast("long").alias("at")).join(
        parsed, ["gram", "block"]).select("doc", "row", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end"), "source")
    windows = scratch.table(listed.join(many, "gram", "left_semi").mapInArrow(
        _windows(window), "gram long, block long, at int, h1 long, h2 long, doc long"), "windows")
    first = scratch.table(windows.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where(
        "least < most").select("h1", "h2", "least"), "first")
    hit = scratch.table(windows.join(first, ["h1", "h2"]).where("least < doc").select("gram", "block", "at", "least"), "hit")
    known = scratch.table(hit.distinct().groupBy("gram", "block").agg(F.collect_list(F.struct("at", "least")).alias("w")), "known")
    hot = ranked.where("doc = least_doc").join(known, ["gram", "block"]).select("doc", "row", "start", "w").mapInArrow(
        _spans(window), "doc long, row long, start long, end long, source long")
    spans = whole(shared.where("alike"), "least").unionByName(whole(ranked, "least_doc")).unionByName(own).unionByName(hot)
    spans = scratch.table(spans, "spans")
    scratch.drop("windows", "first", "hit", "known", "lists", "kinds", "references", "many", "factors", "ranked", "shared")
    return texts, spans


def remove_copied(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = True, references: int = REFERENCES) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, spans, kept, kept_sha256), one per row of ``docs``.

    ``spans`` are the removed word ranges [start, end), ``kept`` the remaining
    words joined by one space (null if not ``with_text``). Windows are judged on the input. Null and empty
    texts have no words; texts under ``window`` words lose nothing. A null
    doc_id counts as larger than every id: such rows lose what others have,
    and never take from others. Rows that repeat a doc_id are judged each by
    its own text against smaller ids only. Very long texts are whole: only one
    text at a time has to fit in a task. Other columns are not read; an empty
    table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "rlz")
    texts, spans = copied_spans(docs, scratch, window, anchor, references)
    lists = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    lists = scratch.table(lists, "span-lists")
    return texts.join(lists, ["doc", "row"], "left").select("doc_id", "text", "spans").mapInArrow(
        _keep(with_text), "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string, kept_sha256 string")
