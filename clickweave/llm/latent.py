"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and documents are cut into passages and weighted by TF-IDF,
with document frequencies counted over all documents. A randomised SVD of
passages, computed from partial products of Spark tasks, spans a latent space
of ``RANK`` directions; document passages are folded into it and searched by
cosine. Candidates are then checked word by word: the longest common
subsequence of item and text, weighted by IDF, must hold nearly all of the
item, or, for a paraphrase, half of it together with the item's answer.

The space is fitted to the items' passages and to a sample of the corpus: one
passage of about ``SAMPLE`` distinct texts, picked by a hash. Both parts have
the same total weight. The sample tells which words stand in the same places,
so that an item and a passage that use different words for one thing come
close; the items keep the space from spanning frequent words alone. Every
document is searched whatever the sample was.

A space of few directions can't hold every item. An item passage that keeps
less than ``ENERGY`` of its square is also compared by its exact TF-IDF
cosine, so no item is lost by the truncation.

Items go in blocks of about ``BLOCK`` passages, so what a block sends to the
tasks is bounded however large the benchmark is. A block's vocabulary is the
words of its items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, arrow_slices, key_of, masked, text_buffer
from clickweave.llm.text import PUNCTUATION, Words, words_of

HALF = 32  # words in half a passage; passages overlap by a half
RANK = 128  # directions of the latent space
BLOCK = 256  # passages in a block of items, about
SAMPLE = 4096  # distinct texts, about, that lend a passage to the fit
OVERSAMPLE = 16
POWER_STEPS = 2
LATENT = 0.6  # least cosine of a candidate in the latent space
ENERGY = 0.5  # item passages that keep less of their square are searched by exact cosine, too
COSINE = 0.35  # least exact cosine of a candidate
VERBATIM = 0.8  # least weighted share of the item in the common subsequence
PARAPHRASE = 0.5  # the same, if the answer is there too
ANSWER = 0.6  # least weighted share of the answer
_ROWS = 512
_PREFIX = 1 << 20
_ANSWER_MARK = re.compile(r"(?is)^.*\banswer\s*[:=]\s*")


@dataclass
class Items:
    """A block of items: their words as term numbers, the terms' hashes, and where each answer begins."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    hashes: np.ndarray  # ascending
    idf: np.ndarray

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each hash, -1 if it is in no item."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def _split(texts: list[str]) -> Words:
    return words_of(*text_buffer(pa.array(texts, pa.string())), lower=True, gaps=PUNCTUATION)


def load_items(rows: list) -> Items:
    """Items from (item_id, text, answer) rows.

    Without an answer column, or with null in it, the answer is what follows
    the last ``answer:`` in the text, else the last quarter of its words.
    """
    texts, answers = [r[1] or "" for r in rows], []
    whole = _split(texts)
    hashes = np.unique(whole.hash)
    items = Items([r[0] for r in rows], [], [], hashes, np.zeros(len(hashes)))
    for i, row in enumerate(rows):
        own = whole.hash[whole.first[i]:whole.first[i + 1]]
        items.words.append(items.terms(own))
        mark = _ANSWER_MARK.match(texts[i])
        if row[2] is not None or mark:
            given = _split([row[2] if row[2] is not None else texts[i][mark.end():]]).hash
        else:
            given = own[len(own) - -(-len(own) // 4):]
        answers.append(given)
    items.answers = [items.terms(a) for a in answers]
    return items


def halves(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half passages: the first word and the text of each, and the half passage of every word."""
    count = -(-np.diff(words.first) // HALF)
    text = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    start = (np.arange(len(text)) - first[text]) * HALF + words.first[:-1][text]
    size = np.diff(np.append(start, words.first[-1]))
    return start, text, np.repeat(np.arange(len(start)), size)


def _counts(half: np.ndarray, term: np.ndarray, a: int, b: int, terms: int) -> np.ndarray:
    """Term counts of the passages made of halves k and k + 1, for a <= k < b (dense, b - a rows)."""
    lo, hi = np.searchsorted(half, [a, b + 1])
    flat = np.bincount((half[lo:hi] - a) * terms + term[lo:hi], minlength=(b + 1 - a) * terms).reshape(b + 1 - a, terms)
    return flat


def _frequencies(items: Items):
    """Rows (term, n): documents of a task that hold the term, all of them under term -1; rows (words): a passage of each picked text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(len(items.hashes), np.int64), 0
        look = _Lookup(items)
        for part in arrow_slices(batches, "text", 1 << 20):
            words = words_of(*text_buffer(part.column(0)), lower=True, gaps=PUNCTUATION)
            at, term = look(words.hash)
            text = np.searchsorted(words.first, at, side="right") - 1
            pairs = np.unique(text * np.int64(len(df)) + term)
            df += np.bincount(pairs % max(len(df), 1), minlength=len(df))
            docs += part.num_rows
            passages = []
            for row, place in enumerate(part.column(1).to_pylist()):
                if place is not None:
                    a, b = words.first[row:row + 2]
                    a += place % max(1, -(-int(b - a) // HALF) - 1) * HALF
                    lo, hi = np.searchsorted(at, [a, min(a + 2 * HALF, b)])
                    passages.append(term[lo:hi].tolist())
            if passages:
                none = pa.nulls(len(passages), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(passages, pa.list_(pa.int64()))], _COUNTED)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], docs)), pa.nulls(len(seen) + 1, pa.list_(pa.int64()))], _COUNTED)
    return run


_COUNTED = ["term", "n", "words"]


class _Lookup:
    """Finds the words that are item terms; a bit table turns most others away."""

    def __init__(self, items: Items) -> None:
        self.items, self.table = items, np.zeros(_PREFIX, bool)
        self.table[(items.hashes & np.uint64(_PREFIX - 1)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.table[(hashes & np.uint64(_PREFIX - 1)).astype(np.int64)])
        term = self.items.terms(hashes[at])
        return at[term >= 0], term[term >= 0]


def _item_passages(items: Items) -> tuple[list[np.ndarray], np.ndarray]:
    """Words of the items' passages, and the item of each."""
    cut = [[words[a:a + 2 * HALF] for a in range(0, max(len(words) - HALF, 1), HALF)] for words in items.words]
    return [p for own in cut for p in own], np.repeat(np.arange(len(cut)), [len(own) for own in cut])


def _rows(passages: list, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of passages given as lists of term numbers."""
    if not len(passages):
        return np.zeros((0, len(idf)))
    return np.array([np.bincount(np.asarray(p, np.int64), minlength=len(idf)) for p in passages]) * idf


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1, so that short and light items weigh as much as long ones; zero rows stay."""
    norms = np.linalg.norm(rows, axis=1)
    return rows / np.where(norms > 0, norms, 1)[:, None]


def _products(idf: np.ndarray, basis: np.ndarray, gram: bool):
    """A^T (A basis) of a task's passages, or (A basis)^T (A basis), in row stripes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1] if gram else basis.shape[0], basis.shape[1]))
        for batch in batches:
            passages, weights = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for k in range(0, len(passages), 64):
                rows = _unit(_rows(passages[k:k + 64], idf)) * weights[k:k + 64, None]
                image = rows @ basis
                total += (image if gram else rows).T @ image
        for k in range(0, len(total), 256):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([total[k:k + 256].tobytes()], pa.binary())], ["stripe", "data"])
    return run


def _add(part: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(d) for d in part["data"])
    return pd.DataFrame({"stripe": part["stripe"].iloc[:1], "data": [total.tobytes()]})


def randomised_svd(passages: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Leading ``rank`` right singular vectors (terms x rank) of the TF-IDF rows of ``passages`` (words, weight).

    A row has the length ``weight``. Each step multiplies the passages, spread over Spark tasks, with the current basis; only
    sums of terms x rank come back.
    """
    width = min(rank + OVERSAMPLE, len(idf))

    def product(basis: np.ndarray, gram: bool = False) -> np.ndarray:
        stripes = passages.select("words", "weight").mapInArrow(_products(idf, basis, gram), "stripe long, data binary").groupBy(
            "stripe").applyInPandas(_add, "stripe long, data binary").collect()
        return np.concatenate([np.frombuffer(r["data"]) for r in sorted(stripes, key=lambda r: r["stripe"])]).reshape(-1, basis.shape[1])

    basis = np.random.default_rng(11).standard_normal((len(idf), width))
    for _ in range(1 + POWER_STEPS):
        basis, _ = np.linalg.qr(product(basis))
    values, turn = np.linalg.eigh(product(basis, gram=True))
    order = np.argsort(values)[::-1][:rank]
    return basis @ turn[:, order[values[order] > values.max(initial=0) * 1e-10]]


def subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    places: dict[int, int] = {}
    for i, term in enumerate(item.tolist()):
        if term >= 0:
            places[term] = places.get(term, 0) | (1 << i)
    full = (1 << len(item)) - 1
    row = full
    for term in text.tolist():
        hit = places.get(term)
        if hit:
            both = row & hit
            row = ((row + both) | (row & ~hit)) & full
    return len(item) - row.bit_count()


def weighted_subsequence(item: np.ndarray, text: np.ndarray, weight: np.ndarray) -> float:
    """Largest weight of a common subsequence as a share of the item's weight."""
    total = weight.sum()
    if not len(item) or total <= 0:
        return 0.0
    row = np.zeros(len(item) + 1)
    for term in text.tolist():
        if term >= 0:
            new = np.where(item == term, row[:-1] + weight, row[1:])
            row[1:] = np.maximum.accumulate(np.maximum(new, row[1:]))
    return float(row[-1] / total)


def _search(items: Items, space: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, look = len(items.idf), _Lookup(items)
        passages, owner = _item_passages(items)
        unit = _unit(_rows(passages, items.idf))
        asked = unit @ space
        weak = np.flatnonzero((asked**2).sum(axis=1) < ENERGY)
        images = np.hstack([space, unit[weak].T]).astype(np.float32)  # of each term: in the space, in the weak passages
        asked = _unit(asked).astype(np.float32)
        most = (unit**2).max(axis=0, initial=0.0)  # largest share a term has in any item passage
        weights = items.idf.astype(np.float32)
        holds = np.zeros((len(items.ids), terms + 1), bool)  # terms of each item; the last column stands for other words
        for i, item in enumerate(items.words):
            holds[i, item] = True
        total = [items.idf[item].sum() for item in items.words]
        present = np.zeros(terms + 1, bool)
        for part in arrow_slices(batches, "text", 1 << 20):
            words = words_of(*text_buffer(part.column(2)), lower=True, gaps=PUNCTUATION)
            start, text, half_of = halves(words)
            at, term = look(words.hash)
            if not len(at):
                continue
            half = half_of[at]
            share = np.bincount(half, most[term], minlength=len(start) + 1)
            same = np.append(text[1:] == text[:-1], False)  # the next half belongs to the same text
            share = share[:-1] + np.where(same, share[1:], 0)
            # an exact cosine is at most the root of the shares of the terms it can rest on; a passage with less
            # of every item passage holds nothing that the check of half an item's weight could pass
            hopeful = np.flatnonzero(share >= COSINE**2)
            found: dict[tuple[int, int], tuple[float, int]] = {}
            lo, mid = np.searchsorted(half, hopeful), np.searchsorted(half, hopeful + 1)
            hi = np.where(same[hopeful], np.searchsorted(half, hopeful + 2), mid)
            for k in range(0, len(hopeful), _ROWS):
                size = hi[k:k + _ROWS] - lo[k:k + _ROWS]
                row = np.repeat(np.arange(len(size)), size)
                pick = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[k:k + _ROWS], size)
                pairs, count = np.unique(row * terms + term[pick], return_counts=True)
                first = np.searchsorted(pairs, np.arange(len(size)) * terms)  # a hopeful passage has a term at least
                value = count.astype(np.float32) * weights[pairs % terms]
                image = np.add.reduceat(images[pairs % terms] * value[:, None], first, axis=0)
                cosine = _unit(image[:, :space.shape[1]]) @ asked.T
                candidate = cosine >= LATENT
                plain = image[:, space.shape[1]:] / np.sqrt(np.add.reduceat(value**2, first))[:, None]
                candidate[:, weak] |= plain >= COSINE
                cosine[:, weak] = np.where(plain >= COSINE, np.maximum(plain, cosine[:, weak]), cosine[:, weak])
                for r, c in zip(*np.nonzero(candidate)):
                    where = hopeful[k + r]
                    key = (int(where), int(owner[c]))
                    found[key] = max(found.get(key, (0.0, 0)), (float(cosine[r, c]), int(where)))
            best: dict[tuple[int, int], tuple] = {}
            known = np.full(len(words.hash), -1)
            known[at] = term
            for (where, i), (cosine, _) in found.items():
                item, doc = items.words[i], int(text[where])
                pad = len(item) // 2
                a = max(int(start[where]) - pad, int(words.first[doc]))
                b = min(int(start[where]) + 2 * HALF + pad, int(words.first[doc + 1]))
                region = known[a:b]
                shared = region[holds[i, region]]
                present[shared] = True
                weight = items.idf[item]
                most_shared = weight[present[item]].sum()  # no subsequence weighs more than the shared words
                present[shared] = False
                if most_shared < PARAPHRASE * total[i] * (1 - 1e-9) or subsequence(item, shared) < PARAPHRASE / 2 * len(item):
                    continue
                overlap = weighted_subsequence(item, shared, weight)
                if overlap < PARAPHRASE:
                    continue
                answer = items.answers[i]
                told = weighted_subsequence(answer, region, np.where(answer >= 0, items.idf[answer], items.idf.max(initial=0.0)))
                if overlap >= VERBATIM or told >= ANSWER:
                    row = (overlap, told, cosine)
                    best[doc, i] = max(best.get((doc, i), row), row)
            if best:
                keys = sorted(best)
                docs = pa.array([d for d, _ in keys])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(docs), part.column(1).take(docs), pa.array([items.ids[i] for _, i in keys], pa.int64()),
                     pa.array(["verbatim" if best[x][0] >= VERBATIM else "paraphrase" for x in keys]),
                     *(pa.array([round(best[x][j], 6) for x in keys]) for j in (2, 0, 1))],
                    ["doc_id", "row", "item_id", "kind", "cosine", "overlap", "answer"])
    return run


SCHEMA = "doc_id long, row long, item_id long, kind string, cosine double, overlap double, answer double"


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, row, item_id, kind, cosine, overlap, answer): documents holding a benchmark item, one row a pair.

    ``row`` is the hash of the text; ``cosine`` is that of the best passage in
    the latent space, or its exact one where that found the pair and is
    larger. ``benchmark`` has item_id and text, and may have answer. Null and
    empty texts and items match nothing; null ids are carried along; repeated
    rows of ``docs`` each have theirs. Other columns are not read. Empty
    tables give no rows. ``rank`` is the number of directions of the space,
    ``block`` the passages of items searched at a time.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "latent")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    asked = scratch.table(asked.where("text IS NOT NULL").distinct(), "items")
    passages = F.greatest(F.lit(1), F.ceil((F.size(F.split("text", r"[\s\p{Punct}]+")) - HALF) / HALF))
    blocks = max(1, -(-(asked.agg(F.sum(passages)).first()[0] or 0) // block))
    rate = SAMPLE / max(texts.count(), 1)
    # texts whose hash is below the rate lend a passage; the same hash says which
    picked = F.when(F.shiftrightunsigned(F.xxhash64("text", F.lit("fit")), 11) < rate * 2.0**53, F.pmod(F.xxhash64("text"), F.lit(2**62)))
    found = None
    for number in range(blocks):  # a hash block of about ``block`` passages
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        items = load_items(sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if not len(items.hashes):
            continue
        told = scratch.table(texts.select("text", picked.alias("place")).mapInArrow(
            _frequencies(items), "term long, n long, words array<long>"), f"counted-{number}")
        counted = dict(told.where("term IS NOT NULL").groupBy("term").agg(F.sum("n")).collect())
        n = counted.pop(-1, 0)
        df = np.zeros(len(items.hashes))
        df[list(counted)] = list(counted.values())
        items.idf = np.log((n + 1) / (df + 1)) + 1e-3
        space = randomised_svd(_fit_passages(scratch, told, items, number), items.idf, rank)
        scratch.drop(f"counted-{number}", f"fit-{number}")
        hits = texts.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(_search(items, space), SCHEMA)
        found = hits if found is None else found.unionByName(hits)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def _fit_passages(scratch: Scratch, told: DataFrame, items: Items, number: int) -> DataFrame:
    """(words, weight) of the items' passages and of the sampled ones, equal ones once; either part has the same sum of squares."""
    sampled = told.where("size(words) > 0").select("words").distinct()
    own = [p.tolist() for p in _item_passages(items)[0]]
    both = sampled.withColumn("own", F.lit(False)).unionByName(
        scratch.spark.createDataFrame([(p, True) for p in own], "words array<long>, own boolean"))
    table = scratch.table(both.repartition(8), f"fit-{number}")
    weight = (len(own) / max(table.where("NOT own").count(), 1)) ** 0.5
    return table.select("words", F.when(F.col("own"), 1.0).otherwise(weight).alias("weight"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    hits = contaminated(docs, benchmark, rank, block).select(key_of("doc_id").alias("_key"), F.col("row").alias("_row")).distinct()
    rows, names = masked(docs, "doc_id", "text")
    keyed = rows.withColumns({"_key": key_of("doc_id"), "_row": F.xxhash64(F.col("text").cast("string"))})
    return keyed.join(hits, ["_key", "_row"], "left_anti").select(*names).toDF(*docs.columns)
