"""Repeated passages by a sparse suffix array.

Only suffixes that start at minimisers are kept: the smallest of the runs of
``anchor`` words in each window of ``window`` words, so equal windows keep the
same place. Kept suffixes with the same words around them (all windows that
belong to the minimiser) are one entry, led by its smallest document.

Entries are sorted by what follows the minimiser, and once more by what stands
before it. In sorted order no entry shares more words with any other than with
a neighbour, so comparing neighbours gives how far each entry's matches can
extend to the right and to the left. Where both extents together hold a
window, the windows inside them are looked up among those of the other
entries; all else is settled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import NULL_KEY, Scratch, arrow_slices, key_of, text_buffer
from clickweave.llm.relative_lz import anchors_of
from clickweave.llm.text import RangeHash, words_of

WINDOW = 50
ANCHOR = 20
_LISTS = pa.list_(pa.int64())


def _suffixes(window: int, anchor: int):
    """Kept suffixes: the minimiser's words, their surroundings, place, and the words before and after that belong to its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text"):
            words = words_of(*text_buffer(part.column(2)))
            text, start, n, at, hashed = anchors_of(words, window, anchor)
            whose = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(whose), part.column(1).take(whose), pa.array(hashed(at, at + anchor).view(np.int64)),
                 pa.array(hashed(start, start + n - 1 + window).view(np.int64)), pa.array((at - words.first[text]).astype(np.int32)),
                 pa.array((at - start).astype(np.int32)), pa.array((start + n - 1 + window - at).astype(np.int32))],
                ["doc", "row", "gram", "around", "at", "before", "after"])
    return run


def _ranges(values: np.ndarray, start: np.ndarray, size: np.ndarray, back: bool = False) -> pa.Array:
    """Lists values[start : start + size], or values[start], values[start - 1], ... if ``back``."""
    border = np.concatenate([[0], np.cumsum(size)])
    step = np.arange(border[-1]) - np.repeat(border[:-1], size)
    at = np.repeat(start, size) + (-step if back else step)
    return pa.ListArray.from_arrays(pa.array(border.astype(np.int32)), pa.array(values[at].view(np.int64)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes after each listed minimiser, and before it from right to left."""
    for part in arrow_slices(batches, "text"):
        words = words_of(*text_buffer(part.column(1)))
        lists = part.column(2)
        todo = lists.flatten()
        text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        at, before, after = (todo.field(x).to_numpy().astype(np.int64) for x in ("at", "before", "after"))
        at = at + words.first[text]
        yield pa.RecordBatch.from_arrays(
            [todo.field("gram"), todo.field("around"), part.column(0).take(pa.array(text)),
             _ranges(words.hash, at, after), _ranges(words.hash, at - 1, before, back=True)], ["gram", "around", "doc", "after", "before"])


def _extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words of ``side`` each entry of a sorted partition shares with a neighbour of the same minimiser.

    At a partition's ends the neighbour is elsewhere: the whole side counts.
    """
    pending: tuple | None = None  # an entry waiting for its next neighbour: gram, around, words, extent

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[3] for r in rows], pa.int32())], ["gram", "around", "extent"])

    for part in batches:
        grams, around = part.column(0).to_pylist(), part.column(1).to_pylist()
        side = part.column(2)
        values, border = side.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(side.value_lengths().to_numpy())])
        done = []
        for i in range(part.num_rows):
            own = values[border[i]:border[i + 1]]
            if pending is None:
                pending = (grams[i], around[i], own, len(own))
                continue
            shared = 0
            if pending[0] == grams[i]:
                m = min(len(own), len(pending[2]))
                differ = np.flatnonzero(own[:m] != pending[2][:m])
                shared = int(differ[0]) if len(differ) else m
            done.append((*pending[:3], max(pending[3], shared)))
            pending = (grams[i], around[i], own, shared)
        if done:
            yield batch(done)
    if pending is not None:
        yield batch([(*pending[:3], len(pending[2]))])


def _windows(window: int):
    """Windows of an entry inside its extents: (gram, around, at, h1, h2, doc), ``at`` the words before the minimiser."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            left, right = part.column(6).to_numpy().astype(np.int64), part.column(5).to_numpy().astype(np.int64)
            after, before = part.column(3), part.column(4)
            rows, at, h1, h2 = [], [], [], []
            for i in range(part.num_rows):
                back = before[i].values.to_numpy(zero_copy_only=False)
                words = np.concatenate([back[::-1], after[i].values.to_numpy(zero_copy_only=False)]).view(np.uint64)
                # the window with x words before the minimiser needs x of them shared, and window - x after it
                x = np.arange(max(0, window - right[i]), min(left[i], len(back)) + 1)
                x = x[len(back) - x + window <= len(words)]
                if len(x):
                    start = len(back) - x
                    rows.append(np.full(len(x), i))
                    at.append(x)
                    h1.append(RangeHash(words)(start, start + window))
                    h2.append(RangeHash(words ^ np.uint64(0xA5A5_5A5A_1234_FEDC))(start, start + window))
            if rows:
                who = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(who), part.column(1).take(who), pa.array(np.concatenate(at).astype(np.int32)),
                     pa.array(np.concatenate(h1).view(np.int64)), pa.array(np.concatenate(h2).view(np.int64)), part.column(2).take(who)],
                    ["gram", "around", "at", "h1", "h2", "doc"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping spans of a document become one; its source is the smallest."""
    for part in batches:
        which, start, end, source = [], [], [], []
        for i, spans in enumerate(part.column(2).to_pylist()):
            for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
                if which and which[-1] == i and s["start"] < end[-1]:
                    end[-1], source[-1] = max(end[-1], s["end"]), min(source[-1], s["least"])
                else:
                    which.append(i)
                    start.append(s["start"])
                    end.append(s["end"])
                    source.append(s["least"])
        who = pa.array(which, pa.int64())
        yield pa.RecordBatch.from_arrays([part.column(0).take(who), part.column(1).take(who), pa.array(start, pa.int64()), pa.array(end, pa.int64()),
                                          pa.array(source, pa.int64())], ["doc", "row", "start", "end", "source_id"])

RANGE_WORDS = 4  # of a context that decide its range


def repeated_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Rows (doc_id, row, start, end, source_id): the word spans [start, end) whose every word lies in ``window`` words
    that also stand in a document with a smaller id.

    ``source_id`` is the smallest id a window of the span is found in. Words
    are runs of characters other than space and U+0009..U+000D. Documents
    without a repeated passage have no row; null, empty and short texts never
    do. A null doc_id counts as larger than every id and is no source. Rows
    that repeat a doc_id and its text are listed once; ``row`` is the hash of
    the text. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    texts = docs.select(key_of("doc_id").alias("doc"), F.col("text").cast("string").alias("text")).select("doc", F.xxhash64("text").alias("row"), "text")
    kept = scratch.table(texts.mapInArrow(
        _suffixes(window, anchor), "doc long, row long, gram long, around long, at int, before int, after int"), "kept")
    grams = scratch.table(kept.groupBy("gram").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.min("around").alias("a1"),
                                                   F.max("around").alias("a2")).where("least < most").select(
        "gram", "least", F.expr("a1 = a2").alias("alike")), "grams")
    shared = scratch.table(kept.join(grams, "gram"), "shared")
    scratch.drop("kept", "grams")
    begin, end = (F.col("at") - F.col("before")).cast("long"), (F.col("at") + F.col("after")).cast("long")
    whole = shared.where("alike AND doc > least").select("doc", "row", begin.alias("start"), end.alias("end"), "least")
    mixed = shared.where("NOT alike").drop("least")
    entries = scratch.table(mixed.groupBy("gram", "around").agg(F.min(F.struct("doc", "row", "at", "before", "after")).alias("e")).select(
        "gram", "around", "e.*"), "entries")
    ranked = scratch.table(mixed.join(entries.select("gram", "around", F.col("doc").alias("least")), ["gram", "around"]), "ranked")
    lists = scratch.table(entries.groupBy("doc", "row").agg(F.collect_list(F.struct("at", "before", "after", "gram", "around")).alias("todo")), "lists")
    # repeated rows of a document give its entries again
    contexts = texts.join(lists, ["doc", "row"]).dropDuplicates(["doc", "row"]).select("doc", "text", "todo").mapInArrow(
        _contexts, "gram long, around long, doc long, after array<long>, before array<long>")
    contexts = scratch.table(contexts, "contexts")

    def extents(side: str, other: str) -> DataFrame:
        keys = ["gram", side, other]
        # ranges by the first words only: the driver samples them, whole word lists would grow with the texts
        near = contexts.withColumn("near", F.slice(side, 1, RANGE_WORDS))
        ordered = near.repartitionByRange("gram", "near").sortWithinPartitions(*keys)
        return scratch.table(ordered.select("gram", "around", side).mapInArrow(_extents, "gram long, around long, extent int"), f"extents-{side}")

    right, left = extents("after", "before"), extents("before", "after")
    both = scratch.table(right.withColumnRenamed("extent", "r").join(left.withColumnRenamed("extent", "l"), ["gram", "around"]).where(
        F.col("r") + F.col("l") >= window), "extents")
    open_ = contexts.join(both, ["gram", "around"]).select("gram", "around", "doc", "after", "before", "r", "l")
    windows = scratch.table(open_.mapInArrow(_windows(window), "gram long, around long, at int, h1 long, h2 long, doc long"), "windows")
    first = scratch.table(windows.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where(
        "least < most").select("h1", "h2", "least"), "first")
    hit = scratch.table(windows.join(first, ["h1", "h2"]).where("least < doc").select("gram", "around", F.col("at").alias("x"), F.col("least").alias("s")), "hit")
    scratch.drop("windows", "first", "contexts", "lists")
    best = scratch.table(hit.groupBy("gram", "around").agg(F.min("s").alias("s")), "best")
    same = ranked.where("doc > least").join(best, ["gram", "around"], "left").select(
        "doc", "row", begin.alias("start"), end.alias("end"), F.least("least", "s").alias("least"))
    own = ranked.where("doc = least").drop("least").join(hit, ["gram", "around"]).select(
        "doc", "row", (F.col("at") - F.col("x")).cast("long").alias("start"), (F.col("at") - F.col("x") + window).cast("long").alias("end"),
        F.col("s").alias("least"))
    spans = whole.unionByName(same).unionByName(own)
    lists = spans.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end", "least")).alias("spans"))
    out = lists.mapInArrow(_merge, "doc long, row long, start long, end long, source_id long")
    return out.select(F.when(F.col("doc") != NULL_KEY, F.col("doc")).alias("doc_id"), "row", "start", "end", "source_id")
