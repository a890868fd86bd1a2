"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the
trigrams that every match must hold. Documents are indexed in shards (a slice
of a Spark partition, bounded by bytes), so no posting list grows with the
corpus and a trigram that stands in every text is split like any other. A
shard's postings are intersected and united as a rule's query says, and the
rule's expression runs on the candidates only. A rule without mandatory
trigrams scans every text.

Trigrams are of UTF-8 bytes with A-Z lower-cased, so they find candidates of
rules that ignore case, and a superset of those of rules that don't.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from re import _constants as op
from re import _parser

from clickweave.llm.common import arrow_slices, bounded_batches, masked, text_buffer
from clickweave.llm.text import LOWER

MOST_STRINGS = 16  # larger sets of alternative strings are cut to their trigrams
SHARD_BYTES = 1 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression (ASCII classes), and the least length of one of its groups."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def spans(self, text: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        return [m.span() for m in compiled.finditer(text) if len(m.group(self.group)) >= self.least]


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),  # whole runs: the same spans as those of `[0-9a-f]+` of 24 characters or more
)
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=~-]{16,}", True),
    Rule("url_password", r"://[^\s:/@]+:[^\s:/@]+@"),
)
RULES = BASE + FURTHER

# Boolean queries: True (any text), a trigram, or ("and" | "or", frozenset of queries)
Query = bool | bytes | tuple


def both(a: Query, b: Query) -> Query:
    return _join("and", (a, b))


def either(a: Query, b: Query) -> Query:
    return True if a is True or b is True else _join("or", (a, b))


def _join(word: str, parts: Iterable[Query]) -> Query:
    flat: set = set()
    for p in parts:
        if p is not True:
            flat |= p[1] if isinstance(p, tuple) and p[0] == word else {p}
    if not flat:
        return True
    return next(iter(flat)) if len(flat) == 1 else (word, frozenset(flat))


def _all_trigrams(text: bytes) -> Query:
    return _join("and", (text[i:i + 3] for i in range(len(text) - 2)))


def _one_of(texts: Iterable[bytes]) -> Query:
    """Query that holds for every text with one of ``texts`` inside."""
    parts = [_all_trigrams(t) for t in texts]
    return True if not parts or True in parts else _join("or", parts)


@dataclass
class Info:
    """What is known of the strings an expression matches: all of them (if few), how they begin and end, and a query."""

    exact: set[bytes] | None = None
    head: set[bytes] = field(default_factory=lambda: {b""})
    tail: set[bytes] = field(default_factory=lambda: {b""})
    query: Query = True

    @classmethod
    def of(cls, texts: set[bytes]) -> Info:
        return cls(texts, texts, texts).reduced()

    def reduced(self) -> Info:
        if self.exact is not None and len(self.exact) <= MOST_STRINGS:
            return Info(self.exact, self.exact, self.exact, self.query)
        query = self.query if self.exact is None else both(self.query, _one_of(self.exact))
        head, tail = (self.head, self.tail) if self.exact is None else (self.exact, self.exact)
        query = both(both(query, _one_of(head)), _one_of(tail))
        head, tail = {h[:2] for h in head}, {t[-2:] for t in tail}
        return Info(None, head if len(head) <= MOST_STRINGS else {b""}, tail if len(tail) <= MOST_STRINGS else {b""}, query)

    @property
    def whole(self) -> Query:
        return self.query if self.exact is None else both(self.query, _one_of(self.exact))


EMPTY = Info.of({b""})


def _cross(a: set[bytes], b: set[bytes]) -> set[bytes]:
    return {x + y for x, y in product(a, b)}


def concat(a: Info, b: Info) -> Info:
    if a.exact is not None and b.exact is not None:
        return Info(_cross(a.exact, b.exact), query=both(a.query, b.query)).reduced()
    query = both(a.query, b.query)
    query = both(query, _one_of(_cross(a.tail, b.head)))
    return Info(None, _cross(a.exact, b.head) if a.exact is not None else a.head,
                _cross(a.tail, b.exact) if b.exact is not None else b.tail, query).reduced()


def alternate(a: Info, b: Info) -> Info:
    if a.exact is not None and b.exact is not None and a.query is True and b.query is True:
        return Info.of(a.exact | b.exact)
    return Info(None, a.head | b.head, a.tail | b.tail, either(a.whole, b.whole)).reduced()


def _bytes_of(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass").lower()


def _set_info(items: list) -> Info:
    found: set[bytes] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_bytes_of(value))
        elif kind is op.RANGE and value[1] - value[0] < 64:
            found |= {_bytes_of(c) for c in range(value[0], value[1] + 1)}
        else:
            return Info()
    return Info.of(found) if len(found) <= MOST_STRINGS else Info()


def analyse(parsed) -> Info:
    out = EMPTY
    for kind, value in parsed:
        if kind is op.LITERAL:
            one = Info.of({_bytes_of(value)})
        elif kind is op.IN:
            one = _set_info(value)
        elif kind is op.SUBPATTERN:
            one = analyse(value[3])
        elif kind is op.ATOMIC_GROUP:
            one = analyse(value)
        elif kind is op.BRANCH:
            one = None
            for branch in value[1]:
                info = analyse(branch)
                one = info if one is None else alternate(one, info)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            info = analyse(inner)
            if least == 0:
                one = alternate(info, EMPTY) if most == 1 else Info()
            else:
                one, times = info, min(least, 4)
                for _ in range(times - 1):
                    one = concat(one, info)
                if most > times:
                    one = concat(one, Info())
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            one = EMPTY
        else:  # any character, categories, back references: nothing known
            one = Info()
        out = concat(out, one)
    return out


def trigram_query(rule: Rule) -> Query:
    """Boolean trigram query that every text with a match of the rule satisfies; True if the rule has no mandatory trigram."""
    return analyse(_parser.parse(rule.pattern, rule.compiled().flags)).whole


def trigrams_in(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*(trigrams_in(q) for q in query[1]))


class ShardIndex:
    """Postings of the wanted trigrams over the texts of one shard."""

    def __init__(self, data: np.ndarray, off: np.ndarray, wanted: Sequence[bytes], table: np.ndarray) -> None:
        self.texts = len(off) - 1
        low = LOWER[data].astype(np.uint32)
        slot = table[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]] if len(low) > 2 else np.zeros(0, np.uint16)
        at = np.flatnonzero(slot)
        text = np.searchsorted(off, at, side="right") - 1
        inside = at + 3 <= off[text + 1]
        pairs = np.unique((slot[at[inside]].astype(np.int64) - 1) * self.texts + text[inside])
        border = np.searchsorted(pairs, np.arange(len(wanted) + 1) * self.texts)
        self.postings = {t: pairs[border[i]:border[i + 1]] - i * self.texts for i, t in enumerate(wanted)}

    @staticmethod
    def table(wanted: Sequence[bytes]) -> np.ndarray:
        out = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(wanted):
            out[int.from_bytes(t, "big")] = i + 1
        return out

    def search(self, query: Query) -> np.ndarray:
        """Ascending numbers of the texts that satisfy a query."""
        if query is True:
            return np.arange(self.texts)
        if isinstance(query, bytes):
            return self.postings[query]
        found = [self.search(q) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(found))
        found.sort(key=len)  # shortest postings first
        out = found[0]
        for more in found[1:]:
            out = np.intersect1d(out, more, assume_unique=True)
        return out


def _scan(rules: Sequence[Rule]):
    queries = [trigram_query(r) for r in rules]
    wanted = sorted(set().union(*(trigrams_in(q) for q in queries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, compiled = ShardIndex.table(wanted), [r.compiled() for r in rules]
        for part in arrow_slices(batches, "text", SHARD_BYTES):
            at = part.schema.get_field_index("text")
            index = ShardIndex(*text_buffer(part.column(at)), wanted, table)
            texts: dict[int, str] = {}
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(part.num_rows)]
            for number, rule in enumerate(rules):
                for i in index.search(queries[number]).tolist():
                    if i not in texts:
                        texts[i] = part.column(at)[i].as_py() or ""
                    spans[i] += [(start, number, end) for start, end in rule.spans(texts[i], compiled[number])]
            found = [[{"kind": rules[n].kind, "start": s, "end": e} for s, n, e in sorted(row)] for row in spans]
            kept = [i for i in range(part.num_columns) if i != at]
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(found, kinds)],
                                             [*(part.schema.names[i] for i in kept), "spans"])
    return run


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Columns of ``docs`` but ``text``, and ``spans``: array of (kind, start, end) by start, then in the order of ``rules``.

    Places are code points of the whole text, ends exclusive. Matches are
    leftmost and don't overlap within a kind; those shorter than the rule's
    least are dropped. Null and empty texts have no spans. Repeated rows are
    each scanned; other columns pass through, of whatever name; an empty table
    gives no rows. One pass, no shuffle; a shard holds about SHARD_BYTES of
    text, or one text.
    """
    bounded_batches(docs.sparkSession)
    rows, names = masked(docs, "text")
    rows = rows.withColumn("text", F.col("text").cast("string"))
    others = [n for n in names if n != "text"]
    schema = "".join(f"`{n}` {rows.schema[n].dataType.simpleString()}, " for n in others)
    found = rows.select(*others, "text").mapInArrow(_scan(rules), f"{schema}spans array<struct<kind:string,start:long,end:long>>")
    return found.toDF(*[n for n in docs.columns if n != "text"], "spans")


def listed(spans: F.Column, kinds: Sequence[str] | None = None) -> F.Column:
    """``kind:start:end`` of the spans (of some kinds), comma-joined."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
