"""Whitening, divergence audit and tree BPE against brute force, on small tables with awkward rows."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from zonecast.llm import op11_whitening as w11
from zonecast.llm import op12_divergence as d12
from zonecast.llm import op13_bpe as b13
from zonecast.llm.queries import WORD_BPE, tokenizer_file

VECS = "vec_id bigint, embedding array<double>, n bigint, x string"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, n bigint"


# ---------------------------------------------------------------- 11

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], VECS)


def check_whitening(got, rows, keep=4, near=1e-6):
    """Result rows of vectors of one length against numpy in double precision on exact integers."""
    usable = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
              if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float((n * c - s) / n) for c, s in zip(x, sums)] for x in fit])
    _, s, wt = np.linalg.svd(centred, full_matrices=False)
    rank = min(keep, int((s > 1e-12 * s[0]).sum()))
    want = collections.Counter(i for i, _ in usable)
    assert collections.Counter(r["vec_id"] for r in got) == {i: k * rank for i, k in want.items()}
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    deviation = lambda x: sum((n * c - t) ** 2 for c, t in zip(x, sums))
    signs = {}
    for i, x in usable:
        dev = deviation(x)
        rows_of = by_row[i, dev if dev < 1 << 63 else None]
        z = np.array([(n * c - t) / n for c, t in zip(x, sums)], float)
        for c in range(rank):
            r = rows_of[c + 1]
            e = s[c] ** 2 / n
            expect = float(z @ wt[c]) / math.sqrt(e)
            sign = signs.setdefault(c, 1 if expect * r["whitened"] >= 0 else -1) if abs(expect) > 1e-3 else signs.get(c, 1)
            if abs(expect) > 1e-3:
                assert r["whitened"] == pytest.approx(sign * expect, rel=near, abs=near)
            assert r["n"] == n and r["explained"] == pytest.approx(e / (s**2 / n).sum(), rel=1e-4)
            assert r["identity_error"] <= 1e-4
    return rank


def test_whitening_equals_svd(spark):
    rng = np.random.default_rng(3)
    scale = np.array([3.0, 2.0, 1.2, 0.8, 0.3, 0.1])
    rows = [(k, (rng.normal(size=6) * scale + 5).tolist()) for k in range(300)]
    rows += [(7, rows[0][1]), (None, rows[1][1]), (1000, rows[2][1])] + [(2000 + k, rows[5][1]) for k in range(50)]
    rows += [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [1.0, 1.0, 1.0, float("-inf"), 1.0, 1.0]), (904, [])]
    got = w11.whiten(vectors(spark, rows).repartition(5)).collect()
    # one id with two vectors of equal deviation would be ambiguous here: it has none
    assert check_whitening(got, rows) == 4


@pytest.mark.parametrize("kind", ["constant", "dependent", "few", "steep", "large"])
def test_whitening_of_awkward_matrices(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 5)) * np.array([5.0, 4.0, 3.0, 2.0, 1.0])
    if kind == "constant":
        x[:, 1:4] = 2.0
    if kind == "dependent":
        x = np.floor(256 * x) / 256
        x[:, 4], x[:, 3] = x[:, 0] + x[:, 1], 2 * x[:, 0]
    if kind == "few":
        x = x[:3]
    if kind == "steep":  # nearly dependent: condition number about 1e9
        x = np.floor(x * 1e7)
        x[:, 1] = x[:, 0] + np.arange(60) % 2 / 256
        x = x[:, :2]
    if kind == "large":
        x = x * 1e15
    rows = list(enumerate(x.tolist()))
    # a unit vector rounded to doubles carries its rounding times the condition number into the second component
    rank = check_whitening(w11.whiten(vectors(spark, rows)).collect(), rows, near=1e-4 if kind == "steep" else 1e-6)
    assert rank == {"constant": 2, "dependent": 3, "few": 2, "steep": 2, "large": 4}[kind]


def test_whitening_defined_results(spark):
    assert w11.whiten(vectors(spark, [])).count() == 0
    assert w11.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)])).count() == 0
    # vectors of different lengths are fitted by length
    rows = [(k, [float(k), float(k * k % 7)]) for k in range(20)]
    more = [(100 + k, [float(k % 5)]) for k in range(20)]
    got = w11.whiten(vectors(spark, rows + more)).collect()
    check_whitening([r for r in got if r["vec_id"] < 100], rows)
    check_whitening([r for r in got if r["vec_id"] >= 100], more)
    # entries beyond a long are held at its ends
    far = w11.whiten(vectors(spark, [(1, [1e30]), (2, [-1e30]), (3, [0.0])])).collect()
    assert {r["vec_id"] for r in far} == {1, 2, 3} and {r["deviation"] for r in far if r["vec_id"] != 3} == {None}


def test_gram_matrices_are_added_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(w11, "FAN_IN", 2)
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=3).tolist()) for k in range(64)]
    fit = spark.createDataFrame([([math.floor(256 * c) for c in v],) for _, v in rows], "x array<bigint>").repartition(7)
    model = w11.fit_whitening(fit, 3, 3)
    x = np.array([[math.floor(256 * c) for c in v] for _, v in rows], float)
    v = np.cov(x.T, bias=True)
    assert np.allclose(model.components.T @ np.diag(model.eigenvalues) @ model.components, v, rtol=1e-9)
    assert model.trace == pytest.approx(np.trace(v))


# ---------------------------------------------------------------- 12

def documents(spark, rows):
    return spark.createDataFrame([(k, t, g, s, 0, "clash", 1) for k, (g, s, t) in enumerate(rows)], DOCS)


TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_DOWN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, least):
    groups, seen = {}, collections.defaultdict(set)
    for k, (g, s, t) in enumerate(rows):
        terms = TERMS.findall((t or "").translate(_DOWN))
        groups.setdefault((g or "", s or ""), collections.Counter()).update(terms)
        for x in set(terms):
            seen[g or "", x].add(k)
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), d in seen.items() if g == lang and len(d) >= least]
        mine = {s: c for (g, s), c in groups.items() if g == lang}
        total = {s: sum(c[t] for t in kept) for s, c in mine.items()}
        every = collections.Counter({t: sum(c[t] for c in mine.values()) for t in kept})
        p = {s: {t: 1 + 10**9 * (c[t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s, c in mine.items()}
        q = {t: 1 + 10**9 * (every[t] + 5) // (sum(every.values()) + 5 * len(kept)) for t in kept}
        for s in mine:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in mine if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, got in (("pair", pair), ("term", term)):
                ranked = sorted(got, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(ranked[:50 if part == "term" else None], 1)]
    return sorted(out)


def audit_rows(spark, rows, **options):
    got = d12.audit(documents(spark, rows), **options).collect()
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got)


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["a", "The", "über", "Straße", "eightchr", "ninechars", "sixteencharacter", "seventeencharact1", "x" * 17, "y" * 33,
             "z" * 300, "中文字", "😀", "naïve", "co_op", "İ", "É", "w" * 16, "w" * 17, "w" * 15]
    rows = []
    for k in range(n):
        text = " ".join(rng.choice(words[:rng.randint(2, len(words))]) + rng.choice(["", ".", "1", "-b", "B"]) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S", None, ""]), text))
    return rows


@pytest.mark.parametrize("least, cells", [(1, 40), (5, 1 << 20), (1000, 1 << 20)])
def test_audit_equals_brute_force(spark, least, cells):
    rows = corpus(120, least) + [("en", "s1", None), ("en", "none", "12 34"), ("xx", "alone", "word word"), ("zz", "a", ""), ("zz", "b", None)]
    rows += [rows[0]] * 30 + [("en", "long", "Long " * 40_000 + "y" * 100_000)]
    assert audit_rows(spark, rows, least_docs=least, block_cells=cells) == brute_audit(rows, least)


def test_audit_of_empty_table(spark):
    assert audit_rows(spark, []) == []


def test_audit_sql_equals_brute_force():
    rows = corpus(200, 9)
    con = duckdb.connect()
    documents = pd.DataFrame([(k, t, g, s) for k, (g, s, t) in enumerate(rows)], columns=["doc_id", "text", "lang", "source"])
    con.register("documents", documents)
    got = con.execute(d12.DIVERGENCE_SQL).fetchall()
    assert sorted(got) == brute_audit(rows, 30)


def test_terms_are_counted_across_slices_and_texts():
    texts = ["ab", "AB c", None, "", "ab-ab"]
    out = collections.Counter()
    for terms, group, n, d in d12.count_terms(pa.array(texts).slice(0), np.array([1, 0, 0, 1, 1])):
        for t, g, x, y in zip(terms, group, n, d):
            out[t.decode(), int(g)] = (int(x), int(y))
    # texts that touch in memory do not run into each other
    assert out == {("ab", 1): (3, 2), ("ab", 0): (1, 1), ("c", 0): (1, 1)}


# ---------------------------------------------------------------- 13

def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file(WORD_BPE))


@pytest.mark.parametrize("leaf", [2, 3, 7, 64])
def test_tree_equals_library(leaf):
    lib, tree, rng = library(), b13.TreeBpe(tokenizer_file(WORD_BPE), leaf), random.Random(leaf)
    alphabets = ["a", "ab", "ingthe", "abcdefghijklmnopqrstuvwxyz", "éàüñçßabcA", "!?.,<>/w", "日本語中文ab", "ék", " aé1  \t", "0123ab'st", "İıK"]
    for _ in range(400):
        s = "".join(rng.choice(rng.choice(alphabets)) for _ in range(3)) + "".join(
            rng.choice(rng.choice(alphabets) if rng.random() < 0.2 else alphabets[3]) for _ in range(rng.choice([1, 9, 60, 400])))
        if rng.random() < 0.15:
            s = s[:len(s) // 2] + rng.choice(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"]) + s[len(s) // 2:]
        ids, sizes = tree.encode(pa.array([s, None, s + "\n" + s]))
        want = [lib.encode(t, add_special_tokens=False).ids for t in (s, "", s + "\n" + s)]
        assert [ids[b - n:b].tolist() for b, n in zip(np.cumsum(sizes), sizes)] == want


def test_windows_grow_until_both_sides_agree(monkeypatch):
    lib, path = library(), tokenizer_file(WORD_BPE)
    asked = []
    tree = b13.TreeBpe(path, 4)
    plain = tree.encode_part
    monkeypatch.setattr(b13, "WINDOW", 1)
    monkeypatch.setattr(tree, "encode_part", lambda s, last: asked.append(s) or plain(s, last))
    word = "internationalizationoftheunitedstates" * 8
    assert tree.encode_word(word) == lib.encode(word, add_special_tokens=False).ids
    assert max(map(len, asked)) > 12  # beyond a window of one token each


def test_encode_and_decode(spark):
    lib, path, rng = library(), tokenizer_file(WORD_BPE), random.Random(2)
    letters = "".join(rng.choice("abcdefghijklmnop") for _ in range(5000))
    rows = [(1, "Hello, World's end."), (1, "Hello, World's end."), (2, None), (3, ""), (None, "no id"), (4, " \n\t "), (5, letters),
            (6, f"start {letters} middle\n{letters[:900]} end " * 3), (7, "<|endoftext|> </w> a<|startoftext|>" + letters[:700]),
            (8, "word " * 900), (9, "中" * 800 + "é" * 900), (10, "12345 " + "9" * 700)]
    frame = spark.createDataFrame([(d, t, "en", "s", 0, "x", 1) for d, t in rows], DOCS)
    for spread in (300, 1 << 15):
        coded = b13.encode(frame, path, leaf=32, spread=spread)
        got = collections.Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in b13.decode(coded, path).collect())
        want = collections.Counter()
        for d, t in rows:
            ids = lib.encode(t or "", add_special_tokens=False).ids
            want[d, tuple(ids), lib.decode(ids, skip_special_tokens=False)] += 1
        assert got == want
    sums = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in b13.digest(b13.encode(frame, path), path).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    fused = b13.encode_and_digest(frame, path, leaf=32, spread=300).collect()
    assert len(fused) == len(rows) and {tuple(r) for r in fused} == sums
    assert sums == {(d, len(i), sha(" ".join(map(str, i))), sha(s)) for d, i, s in want}
    assert b13.encode(frame.where("false"), path).count() == 0
