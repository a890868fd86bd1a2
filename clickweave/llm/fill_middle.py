"""Fill-in-middle transformation with an indexable skip list over the units of a text.

A text is cut into units (lines). The skip list's lowest lane holds one node a
unit; each higher lane keeps about every second node of the lane below, chosen
by a hash of its place. A node carries how many units and how many code points
lie between it and the next node of its lane, so a search for a unit rank
descends lane by lane, adds up both widths, and ends at the exact code point.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import arrow_slices, bounded_batches, masked
from clickweave.llm.text import mix64

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SHORT = 8  # lanes of fewer nodes get no lane above
_SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


class SkipList:
    """Units in order, found by rank; ``cut(rank)`` is the code point before which ``rank`` units lie."""

    def __init__(self, widths: np.ndarray) -> None:
        self.size = len(widths)
        units, chars = np.ones(self.size, np.int64), widths.astype(np.int64)
        lanes, below = [], None
        names = np.arange(self.size, dtype=np.uint64)
        while True:
            lanes.append((units.tolist(), chars.tolist(), below))
            if len(units) < _SHORT:
                break
            kept = (mix64(names + np.uint64(len(lanes) << 40)) & np.uint64(1)) == 0
            kept[0] = True  # the head stands in every lane
            at = np.flatnonzero(kept)
            if len(at) == len(units):
                break
            units, chars, names, below = np.add.reduceat(units, at), np.add.reduceat(chars, at), names[at], at.tolist()
        self.lanes = lanes

    def cut(self, rank: int) -> int:
        if not 0 <= rank <= self.size:
            raise IndexError(f"rank {rank} of {self.size} units")
        passed = chars = node = 0
        for units, widths, below in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += units[node]
                chars += widths[node]
                node += 1
            if passed == rank:
                return chars
            node = below[node] if below else node
        raise AssertionError("a unit lane ends at every rank")


def unit_widths(text: str, pattern: str = LINES) -> np.ndarray:
    """Code points of each unit, matched left to right."""
    if pattern == LINES:
        found = [len(line) + 1 for line in text.split("\n")]
        found[-1] -= 1
        return np.array(found if found[-1] else found[:-1], np.int64)
    return np.array([len(m.group()) for m in re.finditer(pattern, text)], np.int64)


def transform(text: str, draws: tuple[int, int, int, int], rate: int, spm_rate: int, pattern: str = LINES) -> tuple:
    """(n, form, prefix code points, middle code points, output) of one text under four random integers."""
    widths = unit_widths(text, pattern)
    n = len(widths)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or draws[2] % 100 >= rate:
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, second = (units.cut(r) for r in sorted((draws[0] % (n + 1), draws[1] % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if draws[3] % 100 < spm_rate:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _run(rate: int, spm_rate: int, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, "text"):
            names = part.schema.names
            texts = part.column(names.index("text")).to_pylist()
            draws = zip(*(part.column(names.index(f"_draw{i}")).to_pylist() for i in range(4)))
            made = [transform(t or "", d, rate, spm_rate, pattern) for t, d in zip(texts, draws)]
            kept = [i for i, name in enumerate(names) if not name.startswith("_draw")]
            for lo, hi in _pieces([len(m[4]) for m in made]):
                n, form, prefix, middle, output = zip(*made[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i).slice(lo, hi - lo) for i in kept), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    [*(names[i] for i in kept), "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def _pieces(sizes: list[int], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` code points, one row at least."""
    lo, before = 0, 0
    for i, total in enumerate(accumulate(sizes)):
        if i > lo and total - before > limit:
            yield lo, i
            lo, before = i, total - sizes[i]
    yield lo, len(sizes)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, pattern: str = LINES) -> DataFrame:
    """Columns of ``docs`` and (n, form, prefix_chars, middle_chars, output): each text as prefix-suffix-middle training text.

    ``rate`` in 100 texts are transformed, of those ``spm_rate`` in 100 in
    suffix-first order; all draws come from sha256 of the seed and the decimal
    ``doc_id``, so reruns and any partitioning agree. Null texts count as
    empty; empty texts and texts that hold one of the marks stay as they are
    (form plain, null lengths). A null id draws like the empty string.
    Repeated rows are each transformed alike. Other columns pass through, of
    whatever name; an empty table gives no rows. One pass, no shuffle.
    """
    bounded_batches(docs.sparkSession)
    rows, names = masked(docs, "doc_id", "text")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = rows.withColumns({"text": F.col("text").cast("string")} | {
        f"_draw{i}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)})
    kept = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    made = rows.select(*names, *[f"_draw{i}" for i in range(4)]).mapInArrow(_run(rate, spm_rate, pattern), f"{kept}, {_SCHEMA}")
    return made.toDF(*docs.columns, "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text a transformed output was made from: its three parts in text order (the marks occur once each)."""
    length = F.char_length(output)
    s, p, m = (F.instr(output, mark) for mark in (SUFFIX, PREFIX, MIDDLE))

    def part(start: Column, stop: Column) -> Column:
        return F.substr(output, start + 3, stop - start - 3)

    psm = F.concat(part(p, s), part(m, length + 1), part(s, m))
    spm = F.concat(part(p, m), part(m, length + 1), part(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
