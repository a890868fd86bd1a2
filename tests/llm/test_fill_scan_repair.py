"""Fill-in-middle, secret scans and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import conversation_repair as repair
from clickweave.llm import fill_middle as fim
from clickweave.llm import secret_scan as scan
from clickweave.llm.queries import op11_fill_middle, op12_trigram_scan, op13_edit_lattice


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11: fill-in-middle

def plain_fim(doc, text, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"7:{'' if doc is None else doc}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_skip_list_reaches_every_rank_exactly():
    rng = random.Random(3)
    for n in [0, 1, 2, 7, 8, 9, 63, 1000]:
        widths = np.array([rng.randrange(0, 40) for _ in range(n)], np.int64)
        units, ends = fim.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
        assert [units.cut(r) for r in range(n + 1)] == ends.tolist()
        assert n < 64 or len(units.lanes) > 3
        for rank in (-1, n + 1):
            with pytest.raises(IndexError):
                units.cut(rank)


def test_fill_in_middle_equals_plain_version_and_restores(shipped, documents, odd_documents):
    marks = [(100 + i, t) for i, t in enumerate(
        ["a\nb<S>c\n", "<P>", "no end of line", "\n", "\n\n\n", "é\n\U0001f600x\r\ny", "<\n>S>\n<M\n>", "<P\n<S\nM>\n", "a\n" * 5000])]
    rows = documents.select("doc_id", "text").union(odd_documents.select("doc_id", "text")).union(shipped.createDataFrame(marks, "doc_id long, text string"))
    given = [tuple(r) for r in rows.collect()]
    for rate, spm in [(100, 50), (60, 0), (100, 100), (0, 50)]:
        made = fim.fill_in_middle(rows, 7, rate, spm).withColumn("back", fim.restored(F.col("output"), F.col("form")))
        found = [tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back", "text").collect()]
        key = lambda r: tuple(str(x) for x in r)
        assert sorted((r[:6] for r in found), key=key) == sorted((plain_fim(d, t, rate, spm) for d, t in given), key=key)
        assert all(r[6] == (r[7] or "") for r in found)


def test_fill_in_middle_by_words_and_odd_tables(shipped, odd_documents):
    words = fim.fill_in_middle(odd_documents.select("doc_id", "text"), pattern=r"\S+\s*|\s+")
    assert {r["n"] for r in words.where("doc_id = 5").collect()} == {80_000}
    made = fim.fill_in_middle(odd_documents)
    assert made.columns[:len(odd_documents.columns)] == odd_documents.columns and made.count() == odd_documents.count()
    assert fim.fill_in_middle(odd_documents.limit(0)).count() == 0


# ---- 12: secret scans

def plain_base(text):
    text, out = text or "", []
    patterns = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
                ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
    for order, (kind, pattern, group, least) in enumerate(patterns):
        for m in re.finditer(pattern, text, re.ASCII | (re.IGNORECASE if kind == "assign" else 0)):
            if len(m.group(group)) >= least:
                out.append((m.start(), order, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


SECRETS = ["PassWord = 'abc12345", "api_key:\"ZZZZZZ", "APIKEY=short", "apikey==longenough", "secret=api_key=abcdefgh", "ſecret=abcdefgh", "toKen: aaaaaa",
           "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "0" * 12, "xAKIA" + "B2" * 20, "deadbeef" * 3, "deadbeef" * 3 + "G" + "0" * 23, "f" * 5000,
           "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "ghp_" + "a1" * 20, "xoxb-1234567890-abc", "sk_live_" + "x" * 20,
           "Bearer " + "y" * 20, "https://user:pw@host", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "pass word=abcdefg", "secre", "t=abcdefg"]


def test_trigram_queries_hold_for_every_match():
    queries = {r.kind: scan.trigram_query(r) for r in scan.RULES}
    assert queries["hex"] is True  # no mandatory trigram: scans fully
    assert queries["access"] == ("and", frozenset({b"aki", b"kia"}))
    assert all(q is not True for k, q in queries.items() if k != "hex")
    assert {b"pas", b"ord", b"key", b"swd"} <= scan.trigrams_in(queries["assign"])
    found = 0
    for rule in scan.RULES:
        wanted = sorted(scan.trigrams_in(queries[rule.kind]))
        for text in SECRETS:
            data = np.frombuffer(text.encode(), np.uint8)
            index = scan.ShardIndex(data, np.array([0, len(data)]), wanted, scan.ShardIndex.table(wanted))
            if rule.spans(text, rule.compiled()):
                found += 1
                assert index.search(queries[rule.kind]).tolist() == [0], (rule.kind, text)
    assert found >= len(scan.RULES) + 8


@pytest.mark.parametrize("pattern", ["abc|abd", "(ab|cd)+ef", "a{3,5}b", "x?yzw", "[ab]cd[ef]", "(?:foo)*bar+", "a.c", "", "[^a]bcd", "(a|b)(c|d)(e|f)", "hello(?= world)"])
def test_trigram_query_keeps_all_texts_that_match(pattern):
    rule, rng = scan.Rule("x", pattern), random.Random(pattern)
    query = scan.trigram_query(rule)
    wanted = sorted(scan.trigrams_in(query))
    letters = "abcdefxyzw"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(3000)] + ["foofoobarr", "hello world", "cdabef", "aaab", "xyzw", "acdf"]
    data = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    index = scan.ShardIndex(np.frombuffer(b"".join(data), np.uint8), off, wanted, scan.ShardIndex.table(wanted))
    kept = set(index.search(query).tolist())
    matches = {i for i, t in enumerate(texts) if re.search(pattern, t)}
    assert matches <= kept
    if query is not True:
        def holds(q, text):
            return q in text if isinstance(q, bytes) else (all if q[0] == "and" else any)(holds(p, text) for p in q[1])
        assert kept == {i for i, d in enumerate(data) if holds(query, d)}


def test_secret_spans_equal_plain_version(shipped, documents, odd_documents):
    rng = random.Random(5)
    mixed = [(1000 + i, "".join(rng.choice([*SECRETS, " ", "\n", "é", "\U0001f600 ", "word "]) for _ in range(rng.randrange(30)))) for i in range(200)]
    rows = documents.select("doc_id", "text").union(odd_documents.select("doc_id", "text")).union(shipped.createDataFrame(mixed, "doc_id long, text string"))
    texts = [(r["doc_id"], r["text"]) for r in rows.collect()]
    kinds = [r.kind for r in scan.BASE]
    spans = F.col("spans")
    found = scan.find_secrets(rows).select("doc_id", scan.listed(spans, kinds), scan.listed(spans)).collect()
    assert sorted((str(d), b) for d, b, _ in found) == sorted((str(d), ",".join(plain_base(t))) for d, t in texts)
    every = {}
    for d, t in texts:
        rank = [(s, n, e, r.kind) for n, r in enumerate(scan.RULES) for s, e in r.spans(t or "", r.compiled())]
        every.setdefault(str(d), []).append(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(rank)))
    assert {k: sorted(v) for k, v in every.items()} == {k: sorted(a for d, _, a in found if str(d) == k) for k in every}
    assert sum("url_password" in a for *_, a in found) and sum("private_key" in a for *_, a in found)


def test_secret_scan_odd_tables_and_query(shipped, odd_documents):
    found = scan.find_secrets(odd_documents)
    assert found.columns == [c for c in odd_documents.columns if c != "text"] + ["spans"] and found.count() == odd_documents.count()
    assert scan.find_secrets(odd_documents.limit(0)).count() == 0
    out = {r["doc_id"]: r for r in op12_trigram_scan(shipped, "/root/testdata/sf0.01").collect()}
    texts = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(out) == len(texts)
    for d, t in texts:
        base, r = plain_base(t), out[d]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex"))
        assert r["base_sha256"] == sha(",".join(base)) and set(base) <= set(r["spans"].split(","))


# ---- 13: conversation repair

def plain_cheapest(messages, entry=0, exits=(0, 3)):
    """All labels by relaxation over (message, state), the last state inserted up to twice."""
    following = (2, 2, 3, 2)
    kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def settle(labels):
        for _ in range(4):
            for s, (c, a) in list(labels.items()):
                new = (c + 2, a + "I")
                if following[s] not in labels or new < labels[following[s]]:
                    labels[following[s]] = new
        return labels

    labels = settle({entry: (0, "")})
    for role, fault in messages:
        new = {}

        def offer(s, label):
            if s not in new or label < new[s]:
                new[s] = label
        for s, (c, a) in labels.items():
            offer(s, (c + 3, a + "D"))
            if fault in (repair.FIT, repair.CUT_OFF):
                more = int(fault == repair.CUT_OFF)
                if role in kept[s]:
                    offer(kept[s][role], (c + more, a + "K"))
                offer(following[s], (c + 2 + more, a + "R"))
        labels = settle(new)
    found = [labels[s] for s in exits if s in labels]
    return min(found) if found else None


def test_cheapest_edits_equal_plain_version():
    rng = random.Random(11)
    for n in [*range(9)] * 60 + [40, 150]:
        messages = [(rng.choice("suauaua") if rng.random() < 0.95 else rng.choice(["", "x", "U"]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        assert repair.cheapest(messages) == plain_cheapest(messages), messages
        entry, leave = rng.randrange(4), [rng.randrange(4)]
        assert repair.cheapest(messages, entry, leave) == plain_cheapest(messages, entry, leave), (messages, entry, leave)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        dice = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        role = "user" if dice == 4 else role
        out += [] if dice == 0 else [(conv, turn, role, text)] * (2 if dice == 3 else 1)
    return out


def plain_report(rows):
    out = {conv: (0, 0, 0, 0, 0, 0, "", sha("")) for conv, *_ in rows}
    groups = {}
    for row in plain_damage(rows):
        groups.setdefault(row[0], []).append(row[1:])
    digest = lambda r, t: hashlib.md5((hashlib.md5(r.encode()).hexdigest() + t).encode()).hexdigest()
    for conv, group in groups.items():
        group.sort(key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2])))
        seen, messages = set(), []
        for _, role, text in group:
            inside = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not inside else 2 if (role, text) in seen else 3 if inside[-1] not in ".!?" else 0
            seen.add((role, text))
            messages.append((role[:1], fault))
        faults = [f for _, f in messages]
        turns = {t for t, *_ in group if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:]))
        cost, audit = plain_cheapest(messages)
        lines, roles, i = [], [], 0
        for letter in audit:
            turn_to = "assistant" if roles and roles[-1][:1] == "u" else "user"
            if letter == "I":
                roles.append(turn_to)
                lines.append(f"{turn_to}:")
                continue
            if letter != "D":
                roles.append(group[i][1] if letter == "K" else turn_to)
                lines.append(f"{roles[-1]}:{group[i][2]}")
            i += 1
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles)) and i == len(group)
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha("\n".join(lines)))
    return out


def told(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_query_equals_plain_version(shipped):
    rows = [tuple(r) for r in shipped.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(op13_edit_lattice(shipped, "/root/testdata/sf0.01")) == plain_report(rows)


def odd_rows():
    rng = random.Random(2)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, None, "user", "a."), (1, None, "assistant", None), (1, 5, None, "b!"),
            (2, 0, "", ""), (3, -5, "user", "x"), (3, 2**40, "assistant", "y?"), (4, 0, "USER", "Hi."), (5, 0, "system", "é" * 300_000 + ".")]
    texts = ["Hello.", "Yes!", "no end", " ", "Why?", "a long text " * 40 + "."]
    for conv, size in [(10, 700), (11, 90), (12, 60), (13, 3), (14, 40)]:  # some span blocks and partitions
        for turn in range(size):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn // (1 if conv != 12 else 3), "system" if not turn else role, f"{rng.choice(texts)[:-1]}{turn % 50}." if rng.random() < 0.8 else rng.choice(texts)))
    return rows


@pytest.mark.parametrize("block_rows,parts", [(4, 16), (512, 8), (64, 3)])
def test_blocks_give_what_whole_conversations_give(shipped, block_rows, parts):
    rows = odd_rows()
    df = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = df.withColumns({c: F.lit(1) for c in ("key", "order", "digest", "first", "part", "seq", "audit")})
    before = shipped.conf.get("spark.sql.shuffle.partitions")
    shipped.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        pieces = repair.repair(repair.damage(clash, repair.turn_dice()), block_rows)
        assert told(repair.conversation_report(clash, pieces)) == plain_report(rows)
        if block_rows == 4:
            assert pieces.where("key = 10").count() > 100
    finally:
        shipped.conf.set("spark.sql.shuffle.partitions", before)


def test_repaired_messages_follow_the_roles_and_empty_tables(shipped):
    df = shipped.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string")
    pieces = repair.repair(df, 16).collect()
    for key in {p["key"] for p in pieces}:
        mine = sorted((p for p in pieces if p["key"] == key), key=lambda p: (p["part"], p["seq"]))
        roles = reduce(lambda a, p: a + [m["role"] for m in p["messages"]], mine, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles)), key
    none = df.limit(0)
    assert repair.conversation_report(none, repair.repair(none)).count() == 0
    assert told(repair.conversation_report(df.where("conv_id = 13"), repair.repair(none))) == {13: (0, 0, 0, 0, 0, 0, "", sha(""))}


def test_fill_query_equals_plain_version(shipped):
    texts = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = sorted((*r[:5], sha(r[5]), sha(t or "")) for (d, t) in texts for r in [plain_fim(d, t)])
    assert sorted(tuple(r) for r in op11_fill_middle(shipped, "/root/testdata/sf0.01").collect()) == want
