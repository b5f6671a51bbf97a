"""Operators of zonecast.llm against brute force, on small hand-made tables with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonecast.llm import op01_dac, op02_sentencepiece, op03_toxicity, op04_secrets, op05_quality, op06_urlfilter
from zonecast.llm import op07_minmax, op08_mixing, op09_topk, op10_chat
from zonecast.llm.components import connected_components
from zonecast.llm.queries import BYTE_BPE, CONTROL_CONVERSATION, PIECE_BPE, tokenizer_file
from zonecast.session import scratch_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, part int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """(doc_id, text[, source]) rows with the other columns of documents and two clashing extra columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0 if r[1] is None else len(r[1]), "x", 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


AWKWARD = [(None, "no id here"), (5, None), (4, ""), (3, "  \n\t "), (2, "one"), (2, "one"), (2, "other text"),
           (1, "word " * 3000), (9, "x" * 5000), (8, "é 中文 😀 a b"), (-7, "<|endoftext|> </s>[INST]")]


# ---------------------------------------------------------------- 1

def test_dac_round_trip_and_access():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = rng.integers(0, 2 ** int(rng.integers(1, 31)), n).astype("<u4")
        d = op01_dac.DacArray(n, *op01_dac.DacArray.encode(ids))
        assert (d.decode() == ids).all()
        assert [d.access(i) for i in range(n)] == ids.tolist()


def test_chunked_tokenizer_equals_library():
    from tokenizers import Tokenizer
    path = tokenizer_file(BYTE_BPE)
    lib = Tokenizer.from_file(path)
    random.seed(1)
    alphabet = ["a", "b", " ", " ", "\n", "\t", "'", "s", "1", "!", "é", " ", "中", "\r", "😀", ".", ","]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 25))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|endoftext|>", "it's", " lead", "trail ", "a  b", "a\n\nb"]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    ids, sizes = op01_dac.tokenizer(path).encode(pa.array(texts))
    ends = np.cumsum(sizes)
    assert [ids[b - n:b].tolist() for b, n in zip(ends, sizes)] == want
    assert [x.tolist() for x in op01_dac.tokenizer(path).encode(pa.array([], pa.string()))] == [[], []]


def test_token_files(spark):
    from tokenizers import Tokenizer
    path = tokenizer_file(BYTE_BPE)
    lib = Tokenizer.from_file(path)
    rows = AWKWARD + [(100 + k, f"document {k} says {k * 7}.\nx <|endoftext|> y") for k in range(40)]
    out = scratch_path(spark, "t-dac")
    op01_dac.write_token_files(docs(spark, rows), out, path)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in op01_dac.read_token_files(spark, out).collect())
    # rows of one id by the hash of their texts
    print_of = {r["text"]: r["h"] for r in docs(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, print_of[r[1]]))
    want, stream = [], []
    for d, t in order:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((len(stream), d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        stream += ids
    assert got == want
    for at in (0, 1, len(stream) // 2, len(stream) - 1):
        assert op01_dac.token_at(spark, out, at) == stream[at]
    assert op01_dac.token_at(spark, out, len(stream)) is None


def test_token_files_of_empty_table(spark):
    out = scratch_path(spark, "t-dac-empty")
    op01_dac.write_token_files(docs(spark, []), out, tokenizer_file(BYTE_BPE))
    assert op01_dac.read_token_files(spark, out).count() == 0


# ---------------------------------------------------------------- 2

def test_sentencepiece_equals_library(spark):
    import sentencepiece
    path = tokenizer_file(PIECE_BPE)
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = AWKWARD + [(50, "the the the cat sat on the mat, the end.\nThe end"), (51, "the cat  sat \t on"), (52, "a▁b"), (53, "line\nnext line\n\nafter two\n"), (54, "▁ x"), (55, "end "), (56, "\n start")]
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in op02_sentencepiece.encode(docs(spark, rows), path).collect())
    assert got == collections.Counter((d, tuple(lib.encode(t or ""))) for d, t in rows)
    back = op02_sentencepiece.encode_and_decode(docs(spark, rows), path).collect()
    assert len(back) == len(rows) and all(r["round_trip"] for r in back)
    assert op02_sentencepiece.encode_and_decode(docs(spark, []), path).count() == 0


def test_words_are_counted_whole(spark):
    texts = [r[1] for r in AWKWARD] + ["a b\nc a", "a  b", " a", "a\n", "\n\nb", "x▁y a", "a b\nc a"]
    got = collections.Counter()
    for batch in op02_sentencepiece._count_words(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])):
        got.update(dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
    want = collections.Counter(w for t in texts for w in op02_sentencepiece.words_of(t))
    assert got == want


def test_lattice_folds(spark):
    table = op02_sentencepiece.load_pieces(tokenizer_file(PIECE_BPE))
    words = ["▁hello", "▁▁▁x", "aaaa", "中国", "\u0007", "▁internationalisation", "▁", "ab" * 30]
    got = op02_sentencepiece.check_words(spark, words, table)
    assert got == {w: op02_sentencepiece.encode_word(w, table) for w in words}
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECE_BPE))
    random.seed(4)
    for n in (1, 5, 40, 70, 3000):  # the fold of a task, at any length
        w = "".join(random.choice("thenationalé-1") for _ in range(n))
        assert op02_sentencepiece.encode_word("▁" + w, table) == lib.encode(w)
    many = words[:-1] + ["▁" + "".join(random.choice("thenationalé-1中\u0007") for _ in range(random.randint(0, 39))) for _ in range(3000)]
    for w, ids in zip(many, op02_sentencepiece.WordLattices(table).encode(many), strict=True):  # many words at once
        want = op02_sentencepiece.encode_word(w, table)
        assert np.frombuffer(ids, "<i4").tolist() == want if ids is not None else any(i in table.bytes_ for i in want)
    assert op02_sentencepiece.WordLattices(table).encode([]) == []
    pieces = "a b c ab bc abc ca".split()
    uni = op02_sentencepiece.PieceTable({p: (k, k) for k, p in enumerate(pieces)},
                                        dict(zip(pieces, [-1.0, -2.0, -1.5, -2.5, -1.0, -5.0, -2.2])), [], "unigram", unknown=99)
    random.seed(3)
    words = ["".join(random.choice("abcx") for _ in range(random.randint(1, 7))) for _ in range(60)]

    def best(w):
        if not w:
            return 0.0
        return max([uni.scores[w[:k]] + best(w[k:]) for k in range(1, len(w) + 1) if w[:k] in uni.scores] + [best(w[1:]) - 1e9])

    names = {k: p for k, p in enumerate(pieces)}
    for w, ids in op02_sentencepiece.check_words(spark, words, uni).items():
        assert sum(uni.scores[names[i]] if i in names else -1e9 for i in ids) == pytest.approx(best(w))


# ---------------------------------------------------------------- 3

def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_levenshtein_walk_equals_brute_force():
    terms = {("moron", True): 3.0, ("trash", True): 2.0, ("pathetic", True): 4.0, ("scum", True): 1.0}
    trie = op03_toxicity.Trie(terms)
    random.seed(0)
    words = {"".join(random.choice("morntasheicp") for _ in range(random.randint(3, 9))) for _ in range(2000)}
    words |= {t[:i] + c + t[i + k:] for (t, _) in terms for i in range(len(t) + 1) for c in ("", "x", "e") for k in (0, 1)}
    for w in words:
        near = max([v for (t, _), v in terms.items() if len(t) >= 5 and _distance(w, t) <= 1], default=0.0)
        assert trie.near(w) == near
        if near and w not in trie.exact:
            assert trie.match(w) == (near, False)


def test_misspelled_beginnings_equal_brute_force():
    terms = {("moron", True): 3.0, ("achlich", False): 2.0, ("reeux", False): 4.0, ("scum", False): 1.0, ("trash", False): 2.5}
    trie = op03_toxicity.Trie(terms)
    random.seed(1)
    words = {"".join(random.choice("achlireuxmon") for _ in range(random.randint(3, 10))) for _ in range(2000)}
    words |= {t[:i] + c + t[i + k:] + end for (t, _) in terms for i in range(len(t) + 1) for c in ("", "x", "e") for k in (0, 1)
              for end in ("", "s", "keiten")}
    for w in words:
        near = max([v for (t, whole), v in terms.items() if len(t) >= 5 and (
            _distance(w, t) <= 1 if whole else any(_distance(w[:j], t) <= 1 for j in range(len(w))))], default=0.0)
        assert trie.near(w) == near
        if near:
            assert trie._maybe(w)
            assert trie.match(w) == (near, False) or trie.match(w)[1]
    assert trie.match("achlihkeit") == (2.0, False) and trie.match("achlichkeit") == (2.0, True)
    assert op03_toxicity.Trie(terms, frozenset({"achlihkeit"})).match("achlihkeit") is None


def test_quotation_counts_less():
    m = op03_toxicity.Matcher(op03_toxicity.Trie({("moron", True): 3.0}))
    plain, quoted = m.features("you are a moron today"), m.features('she wrote "moron" on it')
    assert plain[1] > 3 > quoted[1] and quoted[5] == 1.0
    assert m.features("a m0ron or a morom")[4] == 1.0
    assert m.features(None) == m.features("") == [0.0] * 6


def test_toxicity_learns_and_scores(spark):
    random.seed(5)
    filler = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}ord" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        bad = k % 5 == 0
        words = random.choices(filler, k=60) + (random.choices(["moron", "scumbag", "blockhead"], k=4) if bad else [])
        random.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, 1 if bad else 0))
    table = spark.createDataFrame(labels + [(None, 1), (3, None), (7777, 1)], "doc_id bigint, toxic int")
    model = op03_toxicity.train(docs(spark, rows), table)
    got = op03_toxicity.toxicity(docs(spark, rows + AWKWARD + [(900, "such a morron and a blokhead, a scumbaag")]), model).collect()
    assert len(got) == len(rows) + len(AWKWARD) + 1
    verdict = {r["doc_id"]: r["predicted"] for r in got}
    assert sum(verdict[k] == t for k, t in labels) >= 396
    assert verdict[900] == 1 and all(verdict[d] == 0 for d, _ in AWKWARD if d not in range(400))
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.5) == (r["predicted"] == 1) for r in got)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = op03_toxicity.train(docs(spark, AWKWARD), none)
    assert {r["score"] for r in op03_toxicity.toxicity(docs(spark, AWKWARD), model).collect()} == {0.0}
    assert op03_toxicity.toxicity(docs(spark, []), model).count() == 0


# ---------------------------------------------------------------- 4

def test_secrets_found_and_redacted(spark):
    rows = [(k, f'some text before token = "{hashlib.sha1(str(k).encode()).hexdigest()}" and after') for k in range(60)]
    rows += [(100 + k, f"see http://host.example.org/path/{k}/page-of-things-{k}.html or file_number_{k}_of_the_year") for k in range(60)]
    rows += AWKWARD
    found = op04_secrets.find_secrets(docs(spark, rows))
    bad = {(r["doc_id"], r["start"]) for r in found.where("is_secret").collect()}
    assert bad == {(k, t.index('"') + 1) for k, t in rows if t and 'token = "' in t}
    clean = op04_secrets.redact(docs(spark, rows), found)
    assert clean.columns == docs(spark, []).columns and clean.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in clean.where("doc_id < 60 AND doc_id > 9").collect()}
    assert all(t == 'some text before token = "[SECRET]" and after' for t in texts.values())
    assert op04_secrets.find_secrets(docs(spark, [])).count() == 0


def test_dictionary_counts_all_documents(spark):
    # 2,000 words in three documents each: more documents than any sample of a fixed size holds
    word = ["".join(chr(97 + k // 26**j % 26) for j in range(3)) + "word" for k in range(2000)]
    rows = [(k, f"{word[k % 2000]} {word[k % 2000]} the once{chr(97 + k // 676 % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}") for k in range(6000)]
    counts = collections.Counter(w for _, t in rows for w in set(t.split()))
    want = sorted((-n, w) for w, n in counts.items() if n > 1)
    assert op04_secrets.dictionary_of(docs(spark, rows)) == {w for _, w in want}
    assert op04_secrets.dictionary_of(docs(spark, rows), size=500) == {w for _, w in want[:500]}


@pytest.mark.parametrize("text, value", [
    ('password = "Tr0ub4dor&3"', "Tr0ub4dor&3"), ("pwd: hunter2x9", "hunter2x9"), ("see user:pw12!34@host.example", "pw12!34"),
    ("http://bob:p@ss!w0rd@host/x", "p@ss!w0rd"), ('{"password":"abc,def1","u":"x"}', "abc,def1"),
    ("Authorization: Bearer ab$12!xyz", "ab$12!xyz"), ("Authorization: Basic dXNlcjpw", "dXNlcjpw"),
    ("Server=x;Password=Tr0ub4dor&3;User=bob", "Tr0ub4dor&3"), ("a?token=abc123&key=def456&x=1", "def456"),
    ('{"key":12345678,"password":"abc!def1"}', "abc!def1"), ("dbPassword => 'x y z 1'", "x y z 1")])
def test_values_of_secret_names_are_candidates(text, value):
    found = list(op04_secrets.candidates(text))
    assert value in [v for _, v, _, _ in found]
    assert all(text[s:s + len(v)] == v for s, v, _, _ in found)
    before, after = next((b, a) for _, v, b, a in found if v == value)
    f = dict(zip(op04_secrets.FEATURES, op04_secrets.describe(value, before, after, frozenset())))
    assert f["assigned"] and f["name_before"]


def test_short_secrets_redacted(spark):
    def code(k):
        h = hashlib.sha1(str(k).encode()).hexdigest()
        return f"{h[:4].upper()}&x{h[5:8]}!Q{k % 10}"
    forms = ('password = "{}" and more', "then pwd: {} follows", "Authorization: Bearer {} sent", "get http://bob:{}@db.internal now")
    rows = [(k, forms[k % 4].format(code(k))) for k in range(80)]
    rows += [(100 + k, f"password: required for page {k}, token = get_token({k}) and the key: opened door {k}") for k in range(60)]
    found = op04_secrets.find_secrets(docs(spark, rows))
    texts = {r["doc_id"]: r["text"] for r in op04_secrets.redact(docs(spark, rows), found).collect()}
    # the verdict is learned: a code without letters to speak of can fall below one half
    assert sum(texts[k] == forms[k % 4].format("[SECRET]") for k in range(80)) >= 76
    assert all(texts[k] == t for k, t in rows if k >= 100)


def test_overlapping_secrets_give_one_mark(spark):
    frame = docs(spark, [(1, "ab0123456789cd")])
    spans = frame.select("doc_id", F.xxhash64("text").alias("text_key"), F.lit(True).alias("is_secret"),
                         F.expr("inline(array(named_struct('start', 2L, 'length', 8L), named_struct('start', 4L, 'length', 2L),"
                                " named_struct('start', 6L, 'length', 6L)))"))
    assert [r["text"] for r in op04_secrets.redact(frame, spans).collect()] == ["ab[SECRET]cd"]


# ---------------------------------------------------------------- 5

def _counts(t):
    t = t or ""
    w = WORDS.findall(t)
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if WORDS.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_quality_counts_equal_brute_force(spark):
    rows = AWKWARD + [(20, "a b a b a b a"), (21, "a b c"), (22, " a\n\na \n a\né# <>"), (23, "f f\nf f"), (24, "B x u0B \x0b r")]
    random.seed(1)
    rows += [(30 + k, " ".join(random.choices(["a", "b", "c", "\n", "long|er"], k=random.randint(0, 200)))) for k in range(40)]
    got = op05_quality.quality(docs(spark, rows)).collect()
    have = collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    assert have == collections.Counter((d, *_counts(t)) for d, t in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert op05_quality.quality(docs(spark, [])).count() == 0


def test_em_finds_each_kind_of_junk():
    width = len(op05_quality.RULES)
    good = tuple([1] * width)
    kinds = [tuple(-1 if j == k else 1 for j in range(width)) for k in (1, 3, 5)]
    shares, fires = op05_quality.estimate([(good, 900)] + [(k, 30) for k in kinds])
    assert op05_quality.posterior(good, shares, fires)[0] > 0.9
    assert all(op05_quality.posterior(k, shares, fires)[0] < 0.5 for k in kinds)
    assert op05_quality.estimate([])[0][0] > 0


# ---------------------------------------------------------------- 6

def test_url_filter_as_of(spark):
    events = spark.createDataFrame(
        [("bad.org", 10, True), ("bad.org", 20, False), ("bad.org", 30, True), ("x.net/a", 5, True), ("same.day", 3, True),
         ("same.day", 3, False), (None, 1, True), ("q.com", None, True), ("b.a.com", 0, True), ("a.com", 50, True), ("bad.org", 10, True)],
        "entry string, day int, listed boolean")
    rows = [(1, "http://bad.org/x", 9), (2, "http://www.BAD.org/x", 10), (3, "https://bad.org", 20), (4, "http://bad.org:80/?q", 31),
            (5, "http://x.net/a/b?c=d", 6), (6, "http://x.net/ab", 6), (7, "http://same.day/", 4), (8, None, 4), (9, "no url", 4),
            (10, "http://bad.org/", None), (11, "http://c.b.a.com/", 60), (11, "http://c.b.a.com/", 60), (None, "http://u:p@bad.org/", 15),
            (12, "http://notbad.org/", 15)]
    got = collections.Counter((r["id"], r["entry"], r["since"], r["blocked"]) for r in op06_urlfilter.filter_urls(
        spark.createDataFrame(rows, "id bigint, url string, day int"), events).collect())
    assert got == collections.Counter([
        (1, None, None, False), (2, "bad.org", 10, True), (3, None, None, False), (4, "bad.org", 30, True), (5, "x.net/a", 5, True),
        (6, None, None, False), (7, None, None, False), (8, None, None, False), (9, None, None, False), (10, None, None, False),
        (11, "b.a.com", 0, True), (11, "b.a.com", 0, True), (None, "bad.org", 10, True), (12, None, None, False)])


# ---------------------------------------------------------------- 7

def _near_brute(rows, percent=75):
    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
        w = WORDS.findall(w)
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted(((d, len(s), find(d) if d is not None else None) for d, s in sets), key=str)


def test_near_duplicates_equal_brute_force(spark):
    random.seed(7)
    vocab = [f"v{k}" for k in range(500)]
    base = [random.choices(vocab, k=90) for _ in range(12)]
    rows, k = list(AWKWARD), 200
    for b in base:
        rows.append((k, " ".join(b)))
        k += 1
        chain = list(b)
        for _ in range(5):  # a chain of edits: far ends are linked through the middle only
            chain[random.randrange(90)] = "edit%d" % k
            rows.append((k, " ".join(chain).upper() if k % 2 else "\n".join(chain)))
            k += 1
    rows += [(k + j, " ".join(base[0])) for j in range(30)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in op07_minmax.near_duplicates(docs(spark, rows)).collect()), key=str)
    assert got == _near_brute(rows)


def test_repeated_ids_join_their_classes(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (9, b), (7, c), (7, "other words altogether in here"), (8, c)]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in op07_minmax.near_duplicates(docs(spark, rows)).collect()}
    assert got == {(3, 3, True), (5, 3, False), (9, 3, False), (7, 7, True), (8, 7, False)}


def test_near_duplicates_of_empty_table(spark):
    assert op07_minmax.near_duplicates(docs(spark, [])).count() == 0


def test_pairs_that_no_leader_links(spark):
    """A hub that is linked to nobody: members reach each other in the later rounds only."""
    random.seed(8)
    hub = [f"h{k}" for k in range(60)]
    rows, k = [(1, " ".join(hub))], 2
    for g in range(4):
        own = [f"g{g}_{j}" for j in range(22)]
        for copy in range(4):
            rows.append((k, " ".join(hub[:50] + own[:20] + [f"c{g}{copy}"])))
            k += 1
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in op07_minmax.near_duplicates(docs(spark, rows)).collect()), key=str)
    assert got == _near_brute(rows)


def test_connected_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    labels, _ = connected_components(links)
    got = {r["node"]: r["comp"] for r in labels.collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 101: 100}


# ---------------------------------------------------------------- 8

def test_targets_by_water_filling(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, "d": 400, "e": 0, None: 300}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in op08_mixing.targets(frame).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want, left, rest = {}, set(order), 1.5 * sum(sizes.values())
    while left:
        total = sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / total > 2 * sizes[s]]
        if not over:
            want |= {s: rest * weight[s] / total for s in left}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left.discard(s)
        rest = 1.5 * sum(sizes.values()) - sum(v for v in want.values())
    assert got == pytest.approx(want)


def test_mix_hits_targets(spark):
    random.seed(2)
    rows = [(k, "w " * random.randint(1, 80), random.choice("abcdef")) for k in range(500)]
    rows += [(d, t, None) for d, t in AWKWARD] + [(600 + k, "same size text", "a") for k in range(300)]
    first = op08_mixing.mix(docs(spark, rows)).collect()
    assert len(first) == len(rows)
    by = collections.defaultdict(list)
    for r in first:
        by[r["source"]].append(r)
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 2
    for s, rs in by.items():
        assert sum(r["size"] for r in rs) == rs[0]["source_size"]
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(3, 0.01 * rs[0]["target"]) or s is None
    again = op08_mixing.mix(docs(spark, rows[::-1])).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["copies"])
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert op08_mixing.mix(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- 9

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=8).round(3).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(120)]  # one vector many times
    rows += [(2000, None), (2050, [0.1, None] + [0.0] * 6), (2100, [float("nan")] + [0.0] * 7), (2150, [float("inf")] + [0.0] * 7),
             (2200, [1.0, 2.0]), (2250, [0.5, 0.5]), (-50, [0.3] * 8), (None, [0.1] * 8), (2300, [])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, rank string")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in op09_topk.top_k(frame).collect()}
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints[i] = np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)
    want = {}
    for q, v in ints.items():
        if q % 50 == 0:
            scored = sorted((-int(v @ u), i) for i, u in ints.items() if i != q and len(u) == len(v))[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scored)}
    assert got == want


def test_top_k_of_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(op09_topk, "SHARD_ROWS", 16)  # several shards, so that kth scores are shared
    rng = np.random.default_rng(9)
    rows = [(int(i), rng.integers(-4, 5, 4).astype(float).tolist()) for i in range(300)]
    # the same row again, another vector under the id, and repeated candidates
    rows += [rows[50], rows[50], (100, [2.0, -1.0, 3.0, 0.5]), (150, [9.0] * 4), (150, [9.0] * 4), rows[7], (7, [5.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = collections.defaultdict(list)
    for r in op09_topk.top_k(frame).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ints = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    want = collections.defaultdict(list)
    for a, (q, v) in enumerate(ints):
        if q % 50 == 0:
            scored = sorted((-int(v @ u), i) for b, (i, u) in enumerate(ints) if a != b)[:5]
            want[q] += [(k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}


@pytest.mark.parametrize("size", [1e5, 1e8, 1e16, 1e30])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(6)
    rows = [(k, (rng.normal(size=5) * size).tolist()) for k in range(150)] + [(200 + k, [size * (k + 1), size, 0.0, 1.0, -size]) for k in range(60)]
    rows += [(300, rows[0][1]), (350, rows[3][1])]
    low, high = -(1 << 63), (1 << 63) - 1
    ints = {k: [min(max(int(np.floor(256 * np.float64(c))), low), high) for c in v] for k, v in rows}
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in op09_topk.top_k(frame, k=5, every=50).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in [k for k, _ in rows if k % 50 == 0]:
        scores = [(min(max(sum(a * b for a, b in zip(ints[q], ints[k])), low + 1), high), k) for k in ints if k != q]
        want = [(n, k, s) for n, (s, k) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5], 1)]
        assert sorted(got[q]) == want


def test_top_k_of_empty_table(spark):
    assert op09_topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


# ---------------------------------------------------------------- 10

def test_chat_round_trip(spark):
    rows = list(CONTROL_CONVERSATION) + [
        (1, 0, "system", "be <\\/s> kind"), (1, 1, "user", None), (1, 2, "assistant", "<\\\\/s> \\ [INST] <<SYS>> é😀"),
        (2, 0, "assistant", "first"), (2, 0, "assistant", "first"), (2, None, "tool]\n%", "odd\n</s>\n<s>[user]\n"), (3, 0, None, ""),
        (None, 1, "user", "x"), (None, 2, "assistant", "[TURN " * 2000), (4, 0, "user", "<"), (4, 1, "assistant", "/s>"), (4, 2, "user", "[")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, valid string")
    out = scratch_path(spark, "t-chat")
    op10_chat.write_formatted(frame, out)
    got = {r["conv_id"]: r for r in op10_chat.read_formatted(spark, out).collect()}
    convs = collections.defaultdict(list)
    for c, n, role, text in rows:
        convs[c].append((n is not None, n or 0, role or "", text or ""))
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c for c in got if got[c]["valid"]} == {-7, 1, None}
    texts = op10_chat.format_conversations(frame).select(F.explode("segments").alias("s")).where("s.loss").select("s.text").collect()
    assert not any(c in r["text"] for r in texts for c in op10_chat.DEFAULT_TEMPLATE.controls)
    empty = scratch_path(spark, "t-chat-empty")
    op10_chat.write_formatted(frame.limit(0), empty)
    assert op10_chat.read_formatted(spark, empty).count() == 0
