import random

import numpy as np
import pytest
from brute import NONE, components, lowered, patchwork, removed, spans, words

from clickweave.llm import relative_lz, simhash, suffix_array
from clickweave.llm.common import Scratch
from clickweave.llm.common import components as graph_components


def _key(row):
    return tuple(NONE if x is None else x for x in row)


@pytest.mark.parametrize("references", [1, 4, 256])
@pytest.mark.parametrize("vocabulary", [["a", "b", "é"], [f"w{i}" for i in range(40)]])
def test_copied_words_are_exact(shipped, vocabulary, references):
    rows = patchwork(3, vocabulary)
    frame = shipped.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in relative_lz.remove_copied(frame, 12, 5, references=references).collect()]
    assert sorted(got, key=_key) == sorted(removed(rows, 12), key=_key)
    found = {(r.doc_id, r.start, r.end, r.source_id) for r in suffix_array.repeated_passages(frame, 12, 5).collect()}
    assert found == spans(rows, 12)


def test_greedy_factors():
    """The longest match first, then from the first window it does not hold; short matches are passed over."""
    low, high = np.array([0, 2, 0, 7, 30]), np.array([9, 16, 12, 22, 34])
    assert relative_lz.greedy(low, high, 8) == [(0, 12, 2), (5, 16, 1), (9, 22, 3)]
    assert relative_lz.greedy(low[4:], high[4:], 8) == []
    rnd = random.Random(5)
    for _ in range(200):
        low = np.array([rnd.randrange(40) for _ in range(6)])
        high = low + np.array([rnd.randrange(30) for _ in low])
        found = relative_lz.greedy(low, high, 8)
        windows = {w for a, b, _ in found for w in range(a, b - 7)}
        assert windows == {w for a, b in zip(low, high) for w in range(a, b - 7)}
        assert all(low[j] <= a and high[j] == b for a, b, j in found)


def test_factors_name_their_source(shipped):
    """A passage between words of its own: one factor, from the smallest document that has it."""
    passage = [f"p{i}" for i in range(70)]
    rows = [(d, " ".join([f"a{d}x{i}" for i in range(40)] + passage + [f"b{d}x{i}" for i in range(40)])) for d in (7, 3, 9)]
    rows += [(None, rows[0][1])]
    _, spans = relative_lz.copied_spans(shipped.createDataFrame(rows, "doc_id long, text string"), Scratch(shipped, "test"))
    got = {(r.doc, i): r.source for r in spans.collect() for i in range(r.start, r.end)}
    assert {d for d, _ in got} == {7, 9, NONE} and {s for (d, _), s in got.items() if d == 9} == {3}
    assert {i for d, i in got if d == 9} == set(range(40, 110)) and {i for d, i in got if d == NONE} == set(range(150))


def test_copied_words_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = relative_lz.remove_copied(documents).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(removed(rows, 50))
    for r in got:
        gone = {i for s in r.spans for i in range(s.start, s.end)}
        assert len(gone) == r.n_removed and r.kept.count(" ") + bool(r.kept) == r.n_words - r.n_removed


def test_odd_documents(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in relative_lz.remove_copied(odd_documents, with_text=False).collect()]
    assert sorted(got, key=_key) == sorted(removed(rows, 50), key=_key)
    found = {(r.doc_id, r.start, r.end, r.source_id) for r in suffix_array.repeated_passages(odd_documents).collect()}
    assert found == spans(rows, 50)


def test_empty(documents):
    none = documents.limit(0)
    assert relative_lz.remove_copied(none).count() == 0
    assert suffix_array.repeated_passages(none).count() == 0
    assert simhash.simhash_groups(none).count() == 0


def test_fingerprint_follows_its_definition():
    import xxhash

    for text in [None, "", "One", "one TWO", "a b c", "a b c d A b c", "é É x " * 30]:
        w = words(lowered(text))
        shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
        assert simhash.fingerprint(text) == want


def test_simhash_components(shipped, documents, odd_documents):
    for frame in (documents, odd_documents):
        rows = simhash.simhash_groups(frame).collect()
        assert len(rows) == frame.count()
        bits = sorted({r.fingerprint for r in rows})
        group = components(bits, lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count() <= 2)
        least = {}
        for r in rows:
            if r.doc_id is not None:
                least[group[r.fingerprint]] = min(least.get(group[r.fingerprint], NONE), r.doc_id)
        assert all(r.component_id == least.get(group[r.fingerprint]) for r in rows)


@pytest.mark.parametrize("pair_group", [2, 64])
def test_links_of_a_dense_cluster(shipped, pair_group):
    rnd = random.Random(1)
    base = rnd.getrandbits(64)
    bits = {base ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(150)} | {rnd.getrandbits(64) for _ in range(50)}
    bits = sorted(b - (1 << 64) if b >> 63 else b for b in bits)
    scratch = Scratch(shipped, "test")
    edges = simhash.links(scratch, shipped.createDataFrame([(b,) for b in bits], "fp long"), 2, pair_group)
    got = {r.node: r.comp for r in graph_components(scratch, edges).collect()}
    want = components(bits, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    assert {b: got.get(b, b) for b in bits} == want


def test_components_of_a_chain(shipped):
    scratch = Scratch(shipped, "test")
    chain = shipped.range(40).selectExpr("id AS a", "id + 1 AS b")
    assert {r.comp for r in graph_components(scratch, chain).collect()} == {0}
