import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import mix_targets, words
from pyspark.sql import functions as F

from clickweave.llm import ball_tree, main_text, mixing, token_store
from clickweave.llm.common import Scratch, text_buffer
from clickweave.llm.queries import tokenizer_path


def _best(vectors, query, k):
    scores = sorted((-int(np.dot(v, vectors[query])), i) for i, v in vectors.items() if i != query and len(v) == len(vectors[query]))
    return [(i, -s) for s, i in scores[:k]]


@pytest.mark.parametrize("limits", [{}, {"shard_values": 100, "query_block": 2}])
def test_top_k_with_ties_nulls_and_lengths(shipped, limits):
    r = np.random.default_rng(2)
    whole = {int(i): r.integers(-3, 4, 6) for i in range(400)}
    for i in range(100, 300):
        whole[i] = whole[0]
    whole[1000], whole[1050] = np.array([1]), np.array([2])
    rows = [(i, [float(x) / 256 for x in v]) for i, v in whole.items()]
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (None, [1.0] * 6), rows[3]]
    frame = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", ball_tree.scaled(F.col("embedding")).alias("v"))
    got = collections.defaultdict(list)
    frame = frame.withColumns({c: F.lit(7) for c in ("dim", "cell", "shard", "asks", "floor", "score", "rank", "block")})
    for x in ball_tree.top_k(frame, F.col("vec_id") % 50 == 0, 5, **limits).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score))
    assert got == {q: _best(whole, q, 5) for q in whole if q % 50 == 0}
    assert ball_tree.top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_cells_are_pruned_by_bound():
    """Queries near one of two far groups are never sent to the other, and no better cell is left out."""
    r = np.random.default_rng(4)
    rows = np.concatenate([r.integers(900, 1100, (50, 4)), r.integers(-1100, -900, (50, 4))]).astype(float)
    cells = ball_tree.Cells([rows[0].tolist(), rows[50].tolist()])
    cell, away = cells.nearest(4, rows)
    assert (cell == np.repeat([0, 1], 50)).all()
    cells.radii[4][:] = [away[:50].max(), away[50:].max()]
    bound = cells.bounds(4, rows)
    score = rows @ rows.T
    assert (bound >= np.stack([score[:, :50].max(axis=1), score[:, 50:].max(axis=1)], axis=1)).all()
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(100)), pa.array(rows.astype(int).tolist(), pa.list_(pa.int64())),
                                        pa.array(np.full(100, 4, np.int32)), pa.array(np.zeros(100))], ["vec_id", "v", "dim", "floor"])
    sent = pa.Table.from_batches(list(ball_tree._route(cells, 0, 2)([batch]))).to_pydict()
    assert sorted(zip(sent["vec_id"], sent["cell"])) == [(i, int(i >= 50)) for i in range(100)]


def test_large_scores_are_exact():
    r = np.random.default_rng(3)
    v = r.integers(-2**40, 2**40, (200, 4))
    tree = ball_tree.BallTree(v, np.arange(200), 8)
    for i, best in tree.search(v[:5], np.arange(5), np.full(5, -np.inf), 3):
        want = sorted(((-sum(int(a) * int(b) for a, b in zip(v[j], v[i])), j) for j in range(200) if j != i))[:3]
        assert sorted((-s, j) for s, j in best) == want


def plain_taken(rows, want):
    """Words that the mix takes of each row: rows (source, shuffle key, size) in shuffled order, blocks taken in turn until the target."""
    out = {}
    for source, target in want.items():
        mine = sorted(r for r in rows if r[0] == source)
        size = sum(r[2] for r in mine)
        if not size:
            out |= {r[:2]: 0 for r in mine}
            continue
        blocks = max(-(-size // 64), min(size, 64), 1)
        length = [size // blocks + (j < size % blocks) for j in range(blocks)]
        sums = [sum(length) * n + sum(length[:j]) for n in range(4) for j in range(blocks)]
        turns = min(range(len(sums)), key=lambda t: (abs(sums[t] - target), -t))  # of as many words as the target, nearly
        times = [t for j in range(blocks) for t in [turns // blocks + (j < turns % blocks)] * length[j]]  # of each word
        at = 0
        for r in mine:
            out[r[:2]] = sum(times[at:at + r[2]])
            at += r[2]
    return out


def test_mix(shipped, documents, odd_documents):
    small = shipped.createDataFrame([(1, "a b  c", "x"), (2, None, "x"), (3, "", None), (4, "q\n w", "é"), (5, "z " * 500, "b"), (6, "z " * 50, None),
                                     (None, "m n", "b")], "doc_id long, text string, source string")
    tail = [(i, "w " * 20, f"small{i}") for i in range(30)] + [(100 + i, "w v " * 5000, "large") for i in range(60)]
    tail = shipped.createDataFrame(tail, "doc_id long, text string, source string")
    for frame in (documents, odd_documents, small, tail):
        key = F.xxhash64(F.lit("mix"), F.col("doc_id"), F.xxhash64(F.col("text").cast("string")))
        rows = frame.select("doc_id", "text", "source", key.alias("shuffle")).collect()
        size = collections.Counter()
        for r in rows:
            size[r.source] += len(words(r.text))
        want = mix_targets(dict(size))
        given = [(r.source, (r.shuffle, r.doc_id is not None, r.doc_id or 0), len(words(r.text))) for r in rows]
        single = len({r[:2] for r in given}) == len(given)  # no repeated rows
        got = mixing.mix(frame).collect()
        assert sorted(str((r.doc_id, r.size)) for r in got) == sorted(str((r.doc_id, len(words(r.text)))) for r in rows)
        assert all(0 <= r.taken <= 3 * r.size for r in got)
        if single:
            plain = plain_taken(given, want)
            told = {r.doc_id: plain[r.source, (r.shuffle, r.doc_id is not None, r.doc_id or 0)] for r in rows}
            assert {r.doc_id: r.taken for r in got if r.doc_id is not None} == {d: n for d, n in told.items() if d is not None}
        for s in want:
            mine = sum(r.taken for r in got if r.source_size == size[s] and abs(want[s] - r.target) < 1e-6 * max(1, r.target))
            alike = sum(size[o] == size[s] and abs(want[o] - want[s]) < 1e-6 * max(1, want[s]) for o in want)
            assert abs(mine - alike * want[s]) <= alike * min(33, size[s] / 2 + 1)
        again = mixing.mix(frame.repartition(3)).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))
    assert {r.taken for r in mixing.mix(tail).where("size = 20").collect()} == {60}  # every small source reaches three times its size
    assert mixing.mix(documents.limit(0)).count() == 0
    whole = mixing.mixed_documents(odd_documents)
    assert whole.columns == odd_documents.columns and whole.where("text IS NULL OR trim(text) = ''").count() == 0


def test_schedule_gives_every_turn_once_and_stays_near_the_shares(shipped):
    goal = shipped.createDataFrame([(0, 5000), (1, 1), (2, 0), (3, 2500), (4, 3), (5, 1)], "rank int, turns long")
    slots = mixing.schedule(Scratch(shipped, "test"), goal).orderBy("slot").collect()
    seen = collections.defaultdict(list)
    for i, r in enumerate(slots):
        seen[r["rank"]].append(r["turn"])
        if i % 500 == 499:
            assert abs(len(seen[0]) - (i + 1) * 5000 / 7505) <= 4
    assert {k: v for k, v in seen.items()} == {0: list(range(5000)), 1: [0], 3: list(range(2500)), 4: [0, 1, 2], 5: [0]}


def test_targets(shipped):
    rnd = random.Random(4)
    for _ in range(4):
        size = {s: rnd.choice([0, 1, 5, 1000, 10**6]) for s in [None, *[rnd.choice("aZé\U0001f600") + str(i) for i in range(rnd.randrange(0, 12))]]}
        got = mixing.targets(shipped.createDataFrame(list(size.items()), "source string, source_size long")).collect()
        want = mix_targets(size)
        assert all(abs(r.target - want[r.source]) < 1e-6 * max(1, r.target) for r in got)


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 32])
def test_shards(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 3001).astype(np.uint32)
    shard = token_store.Shard(token_store.write_shard([ids[:5], ids[5:5], ids[5:]], bits))
    assert (shard.ids(0, 3001) == ids).all() and (shard.ids(1000, 2050) == ids[1000:2050]).all()
    assert (shard.document(2) == ids[5:]).all() and not len(shard.document(1))
    assert token_store.bits_for(50_257) == 16 and token_store.bits_for(2) == 1 and token_store.bits_for(257) == 9


def _token_rows(rows):
    tokenizer, at, out = token_store._tokenizer(tokenizer_path()), 0, []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_output(documents, odd_documents):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    got = token_store.token_output(documents, tokenizer_path(), 50_257).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == _token_rows(rows)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = token_store.token_output(odd_documents, tokenizer_path(), 50_257).orderBy("start").collect()
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(str((d, n, c)) for d, _, n, c in _token_rows(rows))
    assert [r.doc_id is None or r.doc_id for r in got] == sorted((r.doc_id is None or r.doc_id for r in got), key=lambda x: (x is not True, x))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert token_store.token_output(documents.limit(0), tokenizer_path(), 50_257).count() == 0


def test_pieces_give_the_tokenizers_ids():
    rnd = random.Random(1)
    encoder, tokenizer = token_store.Encoder(tokenizer_path()), token_store._tokenizer(tokenizer_path())
    letters = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000 \u200b'sreañé!.,09½²Ω中\U0001f600<|>"
    for size in (0, 12, 40):
        texts = ["".join(rnd.choice(letters[:rnd.choice([7, len(letters)])] + "abc") for _ in range(rnd.randrange(size + 1)))
                 + rnd.choice(["", " don't we'll", "<|endoftext|>", "  x", " \n"]) for _ in range(400)]
        texts[5] = None
        got = encoder.encode(*text_buffer(pa.array(texts)))
        assert [g.tolist() for g in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain < text &amp; more", "plain < text & more"),
    ("<html><body><nav>x</nav><article><h1>T &amp; U</h1><p>a <b>b</b>\n c<p>d<div class='ad'>no</div><section class=comments><p>hey</p></section>"
     "<aside>q</aside><ul><li>one<li>two</ul>tail</article><footer>f", "T & U\na b c\nd\none\ntwo\ntail"),
    ("<article><p>a<script>if(a<b)'</p>'</script>b<!-- c --></p><p class=lead>x<br>y</p></article>", "ab\nx y"),
    ("<body><div id=cookie-notice>ok?</div><main><p>one</p><form><p>mail</p></form></main><p>outside</p>", "one"),
    ("<body><div class='content no-sidebar'><p>Hello world</p></div></body>", "Hello world"),
    ("<body><div class='post sidebar'><p>Hello world</p></div></body>", "Hello world"),  # the sole container
    ("<article><header><h1>Title</h1></header><p>a</p><footer>by me</footer></article>", "Title\na"),
    ("<article><p>a</p><div class='related-work'><p>b</p></div><p class='notice'>c</p><p class=share>d</p></article>", "a\nb\nc\nd"),
    ("<article><p>a</p></article><ol class='commentlist'><li>Nice</li></ol><div id=comments><p>Hey</p></div>", "a"),
    ("<body><p>a</p><ol class='commentlist'><li>Nice</li></ol><div class='site-sidebar'>x</div><div class='comment-list-2'>y</div></body>", "a"),
    ("<main><p>First</p></main><article><p>Second</p></article>", "First\nSecond"),
    ("<main><p>Around</p><article><p>Inner</p></article></main>", "Inner"),
    ("<p>kept<div hidden>gone</div><div style='display: none'>gone</div>&#233;&nbsp;x", "kept\né x")])
def test_main_text_of_a_page(page, text):
    assert main_text.main_text(page) == text


def test_template_removal(shipped):
    page = "<body><div class=x><p>Shop of things</p></div><div><p>Story number {0} of many</p><p>Quoted by all</p></div></body>"
    article = "<article><p>Story {0}</p><p>Quoted by all</p><div><span>Rate this</span></div></article>"
    rows = [(i, f"https://A.example/{i}", page.format(i)) for i in range(8)] + [(i, f"https://b.example:80/{i}", article.format(i)) for i in range(10, 18)]
    rows += [(20, "https://c.example/", page.format(20)), (21, None, None), (None, "", ""), (20, "https://c.example/", page.format(20))]
    got = {(r.page_id, r.url): r for r in main_text.extract_main_text(shipped.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1, "https://A.example/1"].text == "Story number 1 of many"
    assert got[11, "https://b.example:80/11"].text == "Story 11\nQuoted by all"
    assert got[20, "https://c.example/"].text == "Shop of things\nStory number 20 of many\nQuoted by all"
    assert got[21, None].text == "" and got[None, ""].n_chars == 0
    assert main_text.extract_main_text(shipped.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_decides_where_no_name_and_no_article_does(shipped):
    page = ("<body><div class=top><a href=/>Home</a><a href=/shop>Shop</a></div><div class=layout><div class=c{1}><p>Story {0} begins</p><p>and ends {0}</p></div>"
            "<div class=r><p>Follow us</p><p>Call {1}</p></div></div><div class=bottom>All rights kept {1}</div></body>")
    rows = [(i, f"https://t.example/{i}", page.format(i, i % 3)) for i in range(60)]
    rows.append((60, "https://t.example/60", "<body><p>" + "long words " * 100_000 + "</p></body>"))
    frame = shipped.createDataFrame(rows, "page_id long, url string, html string")
    clash = frame.withColumns({c: frame["page_id"] for c in ("host", "template", "digest", "page", "n", "pages", "n_chars")})
    got = {r.page_id: r.text for r in main_text.extract_main_text(clash.select("page_id", "url", "html", "host", "template", "digest")).collect()}
    assert all(got[i] == f"Story {i} begins\nand ends {i}" for i in range(60)) and got[60] == ("long words " * 100_000).strip()
    alone = main_text.main_text(rows[0][2])
    assert alone.startswith("HomeShop") and "Follow us" in alone  # only the counts tell the template
    # counts against a plain version: pages of the host that hold the subtree
    held = collections.Counter(d for _, _, h in rows for d in main_text.countable(main_text.parse(h)))
    template = frozenset(d for d, n in held.items() if n >= 5 and n >= 0.1 * len(rows))
    assert got == {i: main_text.main_text(h, template) for i, _, h in rows}


def test_copied_pages_and_large_hosts(shipped):
    plain = "<html><head><title>{0}</title></head><body><div class=x><p>Shop</p></div><div><h1>Story {0}</h1><p>Of {0}</p></div></body></html>"
    boxed = "<html><body><nav>{1}</nav><article><section><p>Tale {0}</p></section><div><ul><li>One</ul></div></article></body></html>"
    rows = [(i, f"https://a.example/{i}", plain.format("copied" if i < 8 else i)) for i in range(40)]
    rows += [(i, f"https://b.example/{i}", boxed.format("copied" if i < 108 else i, i)) for i in range(100, 110)]
    rows += [(i, f"https://c.example/{i}", f"<html><body><div><p>Only {i // 10}</p></div></body></html>") for i in range(200, 210)]
    odd = "<div><p>Sale now</p></div>"
    rows += [(i, f"https://d.example/{i}", f"<body>{odd if i < 1150 else ''}<div><p>Item {i}</p></div></body>") for i in range(1000, 2600)]
    got = {r.page_id: r.text for r in main_text.extract_main_text(shipped.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Story copied\nOf copied" and got[20] == "Story 20\nOf 20"
    assert got[100] == "Tale copied\nOne" and got[109] == "Tale 109\nOne"
    assert {got[i] for i in range(200, 210)} == {"Only 20"}
    assert got[1000] == "Item 1000" and got[2000] == "Item 2000"


def test_articles_hold_their_documents(shipped, documents):
    flat = {" ".join(r.text.split()) for r in documents.select("text").collect()}
    pages = main_text.extract_main_text(shipped.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert pages and all(" ".join(r.text.split("\n", 1)[-1].split()) in flat and r.n_chars == len(r.text) for r in pages)
