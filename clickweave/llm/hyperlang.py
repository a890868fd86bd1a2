"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random vector of +1 and -1. An n-gram binds its letters'
vectors, each permuted by its place, into one product vector; a text bundles
(adds) the vectors of its n-grams, and a language bundles its unit-length
training texts. A text gets the language whose prototype has the largest
cosine with it.

Bundling is linear, so a block of texts is bundled as one matrix product of
n-gram counts with n-gram vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from clickweave.llm.common import arrow_slices, bounded_batches

DIMENSIONS = 1024
GRAM = 3
LETTERS = 128  # letter vectors: the gap between words, a-z, and the rest shared by code point
UNKNOWN = "und"
SEED = 20_240_401
_COLUMNS = 8192  # distinct n-grams per matrix product


@cache
def _codes() -> np.ndarray:
    """Letter index of every code point; 0 is anything but a letter."""
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000:
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                at = ord(low) if len(low) == 1 else point
                out[point] = 1 + at - 97 if 97 <= at < 123 else 27 + at % (LETTERS - 27)
    return out


@cache
def _letters(dimensions: int) -> np.ndarray:
    """Vectors of all letters, and their permutation (a rotation) by place."""
    base = np.random.default_rng(SEED).integers(0, 2, (LETTERS, dimensions), dtype=np.int8) * 2 - 1
    return np.stack([np.roll(base, GRAM - 1 - place, axis=1) for place in range(GRAM)])


def gram_vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bound vectors of n-gram numbers (base ``LETTERS`` digits)."""
    letters = _letters(dimensions)
    out = letters[GRAM - 1][grams % LETTERS].astype(np.float32)
    for place in range(GRAM - 2, -1, -1):
        grams = grams // LETTERS
        out *= letters[place][grams % LETTERS]
    return out


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram numbers of all texts, the text each belongs to, and whether a text has a letter.

    Runs of other characters are one gap, and a gap stands at either end.
    """
    joined = "\x00".join(["", *((t or "") .replace("\x00", " ") for t in texts), ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _codes()[points]
    text = np.cumsum(points == 0) - 1
    border = points == 0
    keep = border | (code > 0)
    keep[1:] |= code[:-1] > 0
    keep[1:] &= ~(border[:-1] & (code[1:] == 0) & ~border[1:])  # a gap after the border is the border
    code, text, border = code[keep].astype(np.int64), text[keep], border[keep]
    # "x gap border" has two gaps in a row: drop the one before the border
    double = np.zeros(len(code), bool)
    double[:-1] = (code[:-1] == 0) & ~border[:-1] & border[1:]
    code, text = code[~double], text[~double]
    letters = np.bincount(text[code > 0], minlength=len(texts))[:len(texts)] > 0
    if len(code) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    grams = np.zeros(len(code) - GRAM + 1, np.int64)
    for place in range(GRAM):
        grams = grams * LETTERS + code[place:len(code) - GRAM + 1 + place]
    middle = code[1:len(code) - GRAM + 2]
    whole = (middle > 0) | (code[:len(grams)] > 0) & (code[GRAM - 1:] > 0)
    whole &= middle > 0  # n-grams around a border or gap start and end there
    return grams[whole], text[1:len(code) - GRAM + 2][whole], letters


def bundle(texts: list[str | None], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vector of each text, and whether it has a letter."""
    grams, text, letters = grams_of(texts)
    out = np.zeros((len(texts), dimensions), np.float32)
    if len(grams):
        seen = np.zeros(LETTERS**GRAM, bool)
        seen[grams] = True
        kinds = np.flatnonzero(seen)
        column = np.zeros(LETTERS**GRAM, np.int32)
        column[kinds] = np.arange(len(kinds), dtype=np.int32)
        at = column[grams]
        for a in range(0, len(kinds), _COLUMNS):
            width = min(_COLUMNS, len(kinds) - a)
            mine = slice(None) if len(kinds) <= _COLUMNS else (at >= a) & (at < a + width)
            counts = np.bincount(text[mine] * width + (at[mine] - a), minlength=len(texts) * width).reshape(len(texts), width)
            out += counts.astype(np.float32) @ gram_vectors(kinds[a:a + width], dimensions)
    return out, letters


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _learn(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part in arrow_slices(batches, "text", 1 << 20):
            vectors, _ = bundle(part.column(0).to_pylist(), dimensions)
            vectors = _unit(vectors)
            names = np.array(part.column(1).to_pylist(), object)
            for name in set(names):
                total[name] = total.get(name, 0) + vectors[names == name].sum(axis=0, dtype=np.float64)
        for name, vector in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(np.asarray(vector))],
                ["lang", "at", "value"])
    return run


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of each language of ``docs`` (text, lang), from all its rows.

    Every task adds up its own texts; Spark adds the tasks' sums by (language,
    dimension). The driver holds one vector per language.
    """
    bounded_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = known.mapInArrow(_learn(dimensions), "lang string, at int, value double").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    profiles = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("v")).select("lang", "v.value")
    return {r["lang"]: np.array(r["value"]) for r in profiles.collect()}


def _predict(languages: list[str], prototypes: np.ndarray, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dimensions = prototypes.shape[1]
        for part in arrow_slices(batches, "text", 1 << 20):
            vectors, letters = bundle(part.column(part.schema.get_field_index("text")).to_pylist(), dimensions)
            cosine = _unit(vectors) @ prototypes.T
            best = cosine.argmax(axis=1)
            score = np.where(letters, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0).astype(np.float64)
            lang = [languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())]
            names = [n for n in part.schema.names if with_text or n != "text"]
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(n)) for n in names), pa.array(lang, pa.string()),
                                              pa.array(score)], [*names, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], with_text: bool = True) -> DataFrame:
    """The columns of ``docs`` with lang_pred and score (cosine, 0 to 1); only ``text`` is looked at
    (and left out if not ``with_text``).

    ``und`` and 0 where the text is null or has no letter, or nothing was
    learned. Ties go to the language first by name. Columns of ``docs`` named
    lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    languages = sorted(prototypes)
    if not languages:
        return (docs if with_text else docs.drop("text")).withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    matrix = _unit(np.stack([prototypes[x] for x in languages])).astype(np.float32)
    schema = StructType([f for f in docs.schema.fields if with_text or f.name != "text"]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(_predict(languages, matrix, with_text), schema)


def held_out(key: str = "doc_id", folds: int = 3) -> Column:
    """Whether a row's text of its id has the CRC-32 remainder 1 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 1, F.lit(False))


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per row of ``docs``.

    Learns from the rows that are not held out and have a language; a null
    doc_id counts as not held out. Repeated rows stay and weigh each.
    """
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang")).withColumn("held_out", held_out())
    prototypes = learn(marked.where("NOT held_out").select("text", "lang"), dimensions)
    return predict(marked.select("doc_id", "held_out", "text"), prototypes, with_text=False)
