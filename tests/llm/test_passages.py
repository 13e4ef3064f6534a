"""Suffix-array removal, source audit and fill-in-the-middle, against brute force."""

import collections
import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pytest

from larkspur.llm import fim, queries, sourceaudit, suffixdedup, suffixes, termcounts

DATA = "/root/testdata/sf0.001"
sha = lambda b: hashlib.sha256(b).hexdigest()


def as_bytes(rng, letters, n):
    return np.frombuffer(bytes(rng.choice(letters) for _ in range(n)), dtype=np.uint8)


# 11 ----------------------------------------------------------------------------------


@pytest.mark.parametrize("letters", [b"ab", b"a", b"abcd\x00\xff"])
def test_suffix_array_order_and_equal_windows(letters):
    rng = random.Random(1)
    for _ in range(60):
        strings = [as_bytes(rng, letters, rng.randint(1, 40)) for _ in range(rng.randint(1, 8))]
        symbols, _ = suffixes.block(strings)
        order = suffixes.suffix_array(symbols, suffixes.words(symbols), 1000)
        assert sorted(order.tolist()) == list(range(len(symbols)))
        tail = [tuple(symbols[i : i + symbols[i:].tolist().index(0)]) for i in order]
        assert tail == sorted(tail)
        for window in (3, 7, 10):
            got, want = collections.defaultdict(set), collections.defaultdict(set)
            for c, w, o in zip(*(x.tolist() for x in suffixes.equal_windows(strings, window))):
                got[c].add((w, o))
            for i, s in enumerate(strings):
                for p in range(len(s) - window + 1):
                    want[bytes(s[p : p + window])].add((i, p))
            assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_segments_hold_every_window_and_meet_by_hash():
    rng = random.Random(2)
    for t in range(60):
        texts = [bytes(as_bytes(rng, b"abc" if t % 3 else b"a", rng.choice([0, 5, 30, 90, 300]))) for _ in range(6)]
        raw, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0] + [len(x) for x in texts])
        seen, hashes = {}, {}
        for a, b, n, inner, h, _ in zip(*suffixes.segments(raw, offsets, 12, 5, 9, most=rng.choice([40, 100, 1000]))):
            found = [texts[a][p : p + 12] for p in range(b, b + n)]
            assert inner or len(set(found)) == len(found)
            for p, x in zip(range(b, b + n), found):
                assert (a, p) not in seen and hashes.setdefault(x, h) == h
                seen[a, p] = x
        assert set(seen) == {(i, p) for i, x in enumerate(texts) for p in range(len(x) - 11)}


def brute_removal(rows, window=100):
    """Per row: bytes, removed, spans, hash of what is kept."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2], i))
    first, out = set(), [None] * len(rows)
    for i in order:
        text = (rows[i][1] or "").encode()
        gone = bytearray(len(text))
        for p in range(len(text) - window + 1):
            w = text[p : p + window]
            if w in first:
                gone[p : p + window] = b"\x01" * window
            first.add(w)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out[i] = (rows[i][0], len(text), sum(gone), spans, sha(kept))
    return out


def passages(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta épsilon zeta eta theta".split())
    shared = [" ".join(word() for _ in range(rng.randint(15, 120))) for _ in range(5)]
    texts = [None, "", "short", "x" * 99, "x" * 100, "x" * 101, "x" * 5000, "ab" * 700, "ab" * 900, "日本語" * 90]
    for _ in range(60):
        body = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 4))]
        body.insert(rng.randint(0, len(body)), rng.choice(shared))
        texts.append("\n".join(body))
    base = " ".join(word() for _ in range(150)).split(" ")
    for _ in range(40):  # near copies
        b = list(base)
        b[rng.randrange(len(b))] = "other" + str(rng.randint(0, 5))
        texts.append(" ".join(b))
    texts += [texts[-1]] * 6 + [texts[20]] * 3
    rng.shuffle(texts)
    ids = [rng.choice([None, 7, 9]) if rng.random() < 0.1 else i for i in range(len(texts))]
    rows = list(zip(ids, texts))
    return rows + [rows[3], rows[3], (None, "y" * 150), (None, "y" * 150)]


@pytest.mark.parametrize("crowd,slice_", [(suffixdedup.CROWD, 16 << 20), (4, 3000)])
def test_suffix_dedup(spark, monkeypatch, crowd, slice_):
    monkeypatch.setattr(suffixdedup, "SLICE", slice_)
    monkeypatch.setattr(suffixdedup, "BLOCK", 5000)
    rows = passages(4)
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "doc_id long, text string, g int").repartition(5)
    ties = {(r["doc_id"], r["text"]): r["tie"] for r in df.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) AS tie").collect()}
    want = brute_removal([(a, b, ties[a, b]) for a, b in rows])
    got = suffixdedup.dedup(df, keep_text=True, crowd=crowd).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r[:5]) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert sha(bytes(r["kept"])) == r["kept_sha256"] and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    assert sum(x[2] for x in want) > 10_000


def test_suffix_dedup_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixdedup.dedup(df).collect() == []


def test_suffix_dedup_over_a_long_text(spark):
    """A text of megabytes, cut into parts, that repeats a passage of another and of itself."""
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefghij klm\n") for _ in range(2_500_000))
    part = long[1_048_000:1_049_700]  # over the edge of two parts
    rows = [(1, part), (2, long), (3, "head " + long[2_000_000:2_000_400] + " tail")]
    got = {r["doc_id"]: r for r in suffixdedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()}
    assert bytes(got[2]["kept"]).decode() == long[:1_048_000] + long[1_049_700:] and got[2]["n_spans"] == 1
    assert bytes(got[3]["kept"]).decode().strip() in ("head  tail", "head tail") and got[1]["n_removed"] == 0


# 12 ----------------------------------------------------------------------------------


def test_term_counts_in_buckets():
    rng = random.Random(3)
    letters = "abcXYZé日ß"
    texts = ["".join(rng.choice(letters + "  1.\x00@[`{") for _ in range(rng.randint(0, 200))) for _ in range(40)]
    texts += ["a" * n for n in (7, 8, 9, 15, 16, 17, 40)] + ["longword" * 9] * 3
    data = [t.encode() for t in texts]
    raw, offsets = np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0] + [len(d) for d in data])
    groups = np.arange(len(texts)) % 3
    for most in (10, 300, 1 << 20):
        got = {}
        for terms, group, n, docs in termcounts.count(raw, offsets, groups, most):
            assert list(terms) == sorted(terms)
            for row in zip(terms, group.tolist(), n.tolist(), docs.tolist()):
                assert row[:2] not in got
                got[row[:2]] = row[2:]
        want = collections.defaultdict(lambda: [0, 0])
        for i, t in enumerate(texts):
            lower = t.translate({k: k + 32 for k in range(65, 91)})
            for term, n in collections.Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)).items():
                w = want[term.encode(), i % 3]
                w[0] += n
                w[1] += 1
        assert got == {k: tuple(v) for k, v in want.items()}


def test_share_is_exact():
    rng = random.Random(4)
    for _ in range(2000):
        total = rng.randint(1, 10 ** rng.randint(1, 15))
        c = rng.randint(0, total)
        assert int(sourceaudit.share(np.array([c]), np.array([total]))[0]) == 1 + 10**9 * (c + 1) // total


def brute_audit(rows):
    docs = [((t or ""), (g or ""), (s or "")) for t, g, s in rows]
    split = [collections.Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate({k: k + 32 for k in range(65, 91)}))) for t, _, _ in docs]
    out = []
    for lang in {g for _, g, _ in docs}:
        df = collections.Counter(x for c, d in zip(split, docs) if d[1] == lang for x in c)
        kept = {x for x, n in df.items() if n >= 3}
        per = collections.defaultdict(collections.Counter)
        for c, d in zip(split, docs):
            if d[1] == lang:
                per[d[2]].update({x: n for x, n in c.items() if x in kept})
        whole = sum(per.values(), collections.Counter())
        share = lambda c, x: 1 + 10**9 * (c[x] + 1) // (sum(c.values()) + len(kept))
        for s, c in per.items():
            p = {x: share(c, x) for x in kept}
            pairs = [(o, sum((p[x] - share(d, x)) ** 2 // share(d, x) for x in kept)) for o, d in per.items() if o != s]
            q = {x: share(whole, x) for x in kept}
            terms = [(x, (p[x] - q[x]) ** 2 // q[x]) for x in kept if c[x] > 0 and p[x] > q[x]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (x, v) in enumerate(ranked) if part == "pair" or k < 200]
    return out


def test_source_audit(spark, monkeypatch):
    monkeypatch.setattr(sourceaudit, "CELLS", 50)
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.choice([2, 5, 9, 20]))) for _ in range(400)]
    rows = [(" ".join(rng.choices(vocab, k=rng.randint(0, 90))), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "Ä", None, "only" + str(i % 3)])) for i in range(150)]
    rows += [(None, "en", "a"), ("", "xx", "lone"), ("1 2 3", "yy", "p"), (None, "yy", "q"), ("big " * 3000, "en", "b")] + [rows[0]] * 3
    df = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, term int").repartition(4)
    got = [tuple(r) for r in sourceaudit.audit(df).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert sorted(got) == sorted(brute_audit(rows))
    assert sourceaudit.audit(df.limit(0)).collect() == []


# 13 ----------------------------------------------------------------------------------


def test_pieces_are_cut_permuted_and_restored():
    rng = random.Random(6)
    forms = collections.Counter()
    for i in range(3000):
        text = "".join(rng.choice(["a", "\n", "ä", "\n\n", "x y", "𝄞", "<P" if i % 9 else "<P>", "<"]) for _ in range(rng.randint(0, 12)))
        x = fim.arrange(i, text)
        out = x.table.text()
        forms[x.form] += 1
        assert fim.restore(out, x.form).text() == text and x.table.sha256() == sha(out.encode())
        if x.form == "plain":
            assert out == text
            continue
        p, m = text[: x.prefix_chars], text[x.prefix_chars : x.prefix_chars + x.middle_chars]
        s = text[len(p) + len(m) :]
        assert out == (f"<P>{p}<S>{s}<M>{m}" if x.form == "psm" else f"<S>{s}<P>{p}<M>{m}")
        assert all(not y or y.endswith("\n") or y is s for y in (p, m)) or not (m + s).strip(m)
    assert min(forms.values()) > 100
    assert {fim.arrange(i, "a\nb", rate=0).form for i in range(50)} == {"plain"}
    assert fim.inverse((2, 0, 1)) == (1, 2, 0)


def test_fill_in_middle_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a\nb"), (None, "a\nb"), (3, "one line"), (4, "<S>"), (5, "x\n" * 200_000), (-6, "\n")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, form string").repartition(3)
    got = fim.fill_in_middle(df).collect()
    assert sorted((str(r["doc_id"]), r["restored_sha256"]) for r in got) == sorted((str(i), sha((t or "").encode())) for i, t in rows)
    assert {r["doc_id"]: r["n"] for r in got if r["doc_id"]} == {1: 0, 2: 0, 3: 1, 4: 1, 5: 200_000, -6: 1}
    assert {r["form"] for r in got if r["doc_id"] in (1, 2, 4)} == {"plain"}
    assert fim.fill_in_middle(df.limit(0)).collect() == []


# queries -------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["op12_source_audit", "op13_fill_in_middle"])
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    want = con.sql(queries.ORACLE_SQL[name]).to_arrow_table()
    cols = sorted(df.columns)
    assert sorted(want.column_names) == cols
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted(zip(*[want.column(c).to_pylist() for c in cols]), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_suffix_dedup_of_the_table(spark):
    rows = [(r["doc_id"], r["text"], 0) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_suffix_dedup(spark, DATA).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got) == sorted(brute_removal(rows))
