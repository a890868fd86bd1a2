import collections
import math
import zlib

import numpy as np
import pytest
import pyarrow as pa
from brute import lowered, words

from clickweave.llm import attention, hyperlang, latent, lm_scoring
from clickweave.llm.common import text_buffer
from clickweave.llm.queries import tokenizer_path
from clickweave.llm.text import words_of


def held(doc, folds):
    return doc is not None and zlib.crc32(str(doc).encode()) % folds == 1


def test_words_and_hashes():
    texts = ["Hello  World", None, "", "x\ty\x0bz", "World"]
    w = words_of(*text_buffer(pa.array(texts)), lower=True)
    cut = [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    assert cut == [x for t in texts for x in words(lowered(t))]
    assert np.diff(w.first).tolist() == [len(words(t)) for t in texts]
    assert w.hash[1] == w.hash[-1] and len(set(w.hash.tolist())) == 5


def test_language_held_out_accuracy(documents):
    got = {r.doc_id: r for r in hyperlang.identify(documents).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    out = [r for r in rows if held(r.doc_id, 3)]
    assert all(got[r.doc_id].held_out == held(r.doc_id, 3) and 0 <= got[r.doc_id].score <= 1 for r in rows)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in out) / len(out) > 0.95


def test_language_of_odd_documents(odd_documents, documents):
    got = hyperlang.identify(odd_documents).collect()
    assert len(got) == odd_documents.count()
    silent = [r for r in odd_documents.collect() if not any(c.isalpha() for c in r.text or "")]
    assert sum(r.lang_pred == "und" and r.score == 0 for r in got) == len(silent)
    untaught = hyperlang.predict(documents.select("doc_id", "text"), {}).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert hyperlang.identify(documents.limit(0)).count() == 0


def test_bundle_is_the_sum_of_bound_vectors():
    grams, text, _ = hyperlang.grams_of(["abc ab", ""])
    vectors, letters = hyperlang.bundle(["abc ab", ""], 64)
    assert np.array_equal(vectors[0], hyperlang.gram_vectors(grams, 64).sum(axis=0)) and not vectors[1].any()
    assert letters.tolist() == [True, False] and set(text.tolist()) == {0}


def test_gradient_by_differences():
    r = np.random.default_rng(0)
    p = {k: v + r.standard_normal(v.shape) * 0.05 for k, v in attention.initial().items()}
    prior = _prior(r.integers(0, attention.IDS, 5000), r.integers(0, 50, attention.IDS))
    ids, targets = r.integers(0, attention.IDS, (2, 3, attention.WINDOW))
    scored = r.random(ids.shape) < 0.7
    loss, grad = attention.gradient(p, prior, ids, targets, scored)
    single = {k: v.astype(np.float32) for k, v in p.items()}
    assert abs(loss + attention.Scorer(single, prior)(ids, targets, scored).mean()) < 1e-4
    for name in p:
        at = tuple(int(r.integers(0, n)) for n in p[name].shape)
        if name == "E":
            at = (int(ids[0, 0]), at[1])
        old, losses = p[name][at], []
        for step in (1e-5, -1e-5):
            p[name][at] = old + step
            losses.append(attention.gradient(p, prior, ids, targets, scored)[0])
        p[name][at] = old
        assert abs((losses[0] - losses[1]) / 2e-5 - grad[name][at]) < 1e-6


def test_windows_score_each_id_once_and_sum_to_one():
    pieces = lm_scoring.load_pieces(tokenizer_path())
    cutter = lm_scoring.Pieces(pieces)
    texts = ["the quick brown fox " * 11, "", "word"]
    w = words_of(*text_buffer(pa.array(texts)), lower=True)
    ids, begin = cutter.sequences(w)
    for i, text in enumerate(texts):
        assert b"".join(pieces[k] for k in ids[begin[i] + 1:begin[i + 1] - 1]) == "".join(" " + x for x in words(text)).encode()
    uniform = attention.Prior(np.zeros(attention.IDS), np.zeros((attention.IDS, attention.IDS), np.float32))
    score, n = lm_scoring.score_texts(attention.Scorer(attention.initial(), uniform), cutter, w)
    assert np.allclose(score, -n * math.log10(attention.IDS), rtol=1e-3) and n.tolist() == (np.diff(begin) - 1).tolist()


def test_every_window_of_the_training_texts_is_trained_on():
    pieces = lm_scoring.load_pieces(tokenizer_path())
    texts = [" ".join(f"word{i % 7} of{i}" for i in range(n)) for n in (0, 3, 40, 200)]
    _, begin = lm_scoring.Pieces(pieces).sequences(words_of(*text_buffer(pa.array(texts)), lower=True))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["row", "text"])
    out = pa.Table.from_batches(lm_scoring._gather(pieces)(iter([batch]))).to_pylist()
    assert sum(r["n"] for r in out if r["kind"] == 2) == sum(-(-(x - 1) // attention.WINDOW) for x in np.diff(begin).tolist())
    ids = np.concatenate([np.frombuffer(r["data"], "<i2").reshape(-1, attention.WINDOW + 1)[:, 1:].ravel() for r in out if r["kind"] == 2])
    assert (ids >= 0).sum() == (np.diff(begin) - 1).sum()
    whole = lm_scoring.Pieces(pieces).sequences(words_of(*text_buffer(pa.array(texts)), lower=True))[0]
    pairs = collections.Counter((a, b) for lo, hi in zip(begin, begin[1:]) for a, b in zip(whole[lo:hi - 1].tolist(), whole[lo + 1:hi].tolist()))
    assert {divmod(r["key"], attention.IDS): r["n"] for r in out if r["kind"] == 3} == pairs


def test_base_scores(documents, odd_documents):
    for frame in (documents, odd_documents):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        tokens = [[*words(lowered(t)), None] for _, t in rows]
        c = collections.Counter()
        for (doc, _), t in zip(rows, tokens):
            if not held(doc, 5):
                c.update(t)
        n, v = sum(c.values()), len(c)
        want = sorted((doc is None, doc or 0, len(t), sum(w in c for w in t), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 4))
                      for (doc, _), t in zip(rows, tokens))
        got = lm_scoring.score(frame.select("doc_id", "text"), tokenizer_path()).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
        assert all(r.train_tokens == n and r.score < 0 and r.held_out == held(r.doc_id, 5) for r in got)


def test_training_beats_frequencies():
    r = np.random.default_rng(1)
    chain = np.tile(np.arange(300, 317), 40)[:attention.WINDOW * 40]
    rows = np.array([chain[i:i + attention.WINDOW + 1] for i in r.integers(0, len(chain) - attention.WINDOW - 1, 600)])
    p = attention.initial()
    prior = attention.Prior(np.bincount(rows.ravel(), minlength=attention.IDS), np.zeros((attention.IDS, attention.IDS), np.float32))
    every = np.ones((len(rows), attention.WINDOW), bool)
    before = attention.Scorer(p, prior)(rows[:, :-1], rows[:, 1:], every).mean()
    attention.train(p, prior, iter([rows] * 4), 0.02, 96)
    assert attention.Scorer(p, prior)(rows[:, :-1], rows[:, 1:], every).mean() > before + 1


def _prior(ids, counts):
    pairs = np.zeros((attention.IDS, attention.IDS), np.float32)
    np.add.at(pairs, (ids[:-1], ids[1:]), 1)
    return attention.Prior(counts, pairs)


def test_prior_holds_the_frequencies_after_an_id():
    ids = np.random.default_rng(4).integers(0, 300, 20_000)
    counts = np.bincount(ids, minlength=attention.IDS)
    prior = _prior(ids, counts)
    chance = (prior.classes[:, :, None] + prior.members.astype(np.float32))[:300].reshape(300, -1)
    assert np.allclose(np.exp(chance).sum(axis=1), 1, atol=2e-3)
    share = (counts + 0.5) / (counts + 0.5).sum()
    pairs = collections.Counter(zip(ids[:-1].tolist(), ids[1:].tolist()))
    seen = np.bincount(ids[:-1], minlength=300)
    for a, b in [(5, 9), (17, 17), (299, 4000)]:
        c = slice(b // 64 * 64, b // 64 * 64 + 64)
        of_class, in_class = share[c].sum(), sum(pairs[a, i] for i in range(c.start, c.stop))
        want = (in_class + 10 * of_class) / (seen[a] + 10) * (pairs[a, b] + 10 * share[b] / of_class) / (in_class + 10)
        assert np.exp(chance[a, b]) == pytest.approx(want, rel=5e-3)


def test_model_beats_word_counts_on_held_out_texts(shipped):
    docs = shipped.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = lm_scoring.score(docs.select("doc_id", "text"), tokenizer_path()).where("held_out").agg(
        {"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    model, base = rows["sum(score)"] / rows["sum(n_tokens)"], rows["sum(base_score)"] / rows["sum(n_tokens)"]
    assert model > base + 0.05, (model, base)
    assert lm_scoring.score(docs.limit(0).select("doc_id", "text"), tokenizer_path()).count() == 0


def _plain_lcs(x, y):
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_subsequences():
    r = np.random.default_rng(1)
    for _ in range(100):
        x, y = r.integers(0, 6, r.integers(1, 30)), r.integers(-1, 6, r.integers(0, 40))
        want = _plain_lcs(x.tolist(), y.tolist())
        assert latent.subsequence(x, y) == want
        assert abs(latent.weighted_subsequence(x, y, np.ones(len(x))) * len(x) - want) < 1e-9


def test_benchmark_items_are_found(shipped, documents):
    bench = shipped.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    planted = []
    for k, (item, text) in enumerate(items[:6]):
        w = text.split()
        if k % 2:  # a paraphrase: every fourth word of the first part replaced, the last quarter whole
            w = [x if i % 4 or i >= len(w) * 3 // 4 else f"other{i}" for i, x in enumerate(w)]
        planted.append((100_000 + k, f"Something before it all. {' '.join(w).upper() if k == 0 else ' '.join(w)}\nand after."))
    frame = shipped.createDataFrame(rows + planted + [(None, None), (5, "")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in latent.contaminated(frame, bench).collect()}
    plain = lambda t: " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split())
    exact = {(doc, item) for doc, t in rows for item, i in items if plain(i) in plain(t)}
    assert exact <= got and {(100_000 + k, items[k][0]) for k in range(6)} <= got
    assert len(got) == len(exact) + 6
    clean = latent.decontaminate(frame, bench)
    assert clean.columns == frame.columns and clean.count() == frame.count() - len({d for d, _ in got})


def test_no_item_of_a_large_benchmark_is_lost(shipped):
    r = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 6000, r.integers(12, 60))) for _ in range(700)]
    bench = shipped.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    frame = shipped.createDataFrame([(i, f"some words before {t} and after") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in latent.contaminated(frame, bench).where("kind = 'verbatim'").collect()}
    assert got == {(i, i) for i in range(700)}


def test_space_finds_what_plain_cosine_misses(shipped):
    """Six topics of 24 notions with two words each, used alike in the corpus. The planted text has the notions of an item
    in order, 11 of them by their other word, among other words of the topic."""
    r = np.random.default_rng(8)
    word = lambda t, c, k: f"t{t}c{c}{'ab'[k]}"
    bench = [(2 * t + k, " ".join(word(t, c, k) for c in range(24))) for t in range(6) for k in range(2)]
    corpus = [(i, " ".join(word(i % 6, c, k) for c, k in zip(r.integers(0, 24, 64), r.integers(0, 2, 64)))) for i in range(600)]
    told = " ".join(word(0, c, int(c < 11)) for c in range(24))
    corpus.append((1000, " ".join(word(0, c, 1) for c in range(20)) + " " + told + " " + " ".join(word(0, c, 1) for c in range(20))))
    frame = shipped.createDataFrame(corpus, "doc_id long, text string")
    items = shipped.createDataFrame(bench, "item_id long, text string")
    found = {rank: {(x.doc_id, x.item_id) for x in latent.contaminated(frame, items, rank=rank).collect()} for rank in (6, 1000)}
    assert (1000, 0) in found[6] and (1000, 0) not in found[1000]
    assert found[6] >= found[1000]


def test_singular_vectors(shipped):
    r = np.random.default_rng(2)
    passages = [r.integers(0, 40, 30).tolist() for _ in range(90)]
    idf, weights = r.random(40) + 0.5, r.random(90) + 0.5
    frame = shipped.createDataFrame(list(zip(passages, weights.tolist())), "words array<long>, weight double")
    got = latent.randomised_svd(frame, idf, rank=40)
    rows = latent._unit(latent._rows(passages, idf)) * weights[:, None]
    want = np.linalg.svd(rows, full_matrices=False)[2].T
    assert np.allclose(np.abs((got * want).sum(axis=0)), 1, atol=1e-6)
    few = latent.randomised_svd(frame, idf, rank=5)
    best = (np.linalg.svd(rows)[1][:5]**2).sum()
    assert few.shape == (40, 5) and ((rows @ few)**2).sum() > 0.98 * best


def test_long_item(shipped):
    r = np.random.default_rng(3)
    text = " ".join(f"w{x}" for x in r.integers(0, 900, 3000))
    bench = shipped.createDataFrame([(1, text), (2, "a short item beside the long one")], "item_id long, text string")
    frame = shipped.createDataFrame([(1, "before it " + text + " after it"), (2, " ".join(text.split()[:300])), (3, "none of it")], "doc_id long, text string")
    assert [(x.doc_id, x.item_id, x.kind) for x in latent.contaminated(frame, bench).collect()] == [(1, 1, "verbatim")]


def test_contamination_of_nothing(shipped, documents, odd_documents):
    bench = shipped.createDataFrame([(1, None), (None, "some item of a few words"), (2, ""), (2, "")], "item_id long, text string")
    assert latent.contaminated(odd_documents, bench).count() == 0
    assert latent.contaminated(documents, bench.limit(0)).count() == 0
    assert latent.contaminated(documents.limit(0), bench).count() == 0
    answered = bench.withColumn("answer", bench.text)
    assert latent.decontaminate(odd_documents, answered).count() == odd_documents.count()
