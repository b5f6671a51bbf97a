"""Toxicity of whole texts: Levenshtein automata over a lexicon trie, with context windows.

Training learns a lexicon of words and word beginnings from labelled rows, and a
small logistic model on what the lexicon finds.  Scoring walks a trie of the
lexicon with each different word of a text.  The walk carries the states of the
word's Levenshtein automaton (one bit set per number of edits), so a misspelled
term (one edit, terms of five letters and more) is met in the same walk as an
exact one.  Word beginnings are in the same trie: one is met when some beginning
of the word is within an edit of it, and the rest of the word is free.  The window around each hit then separates quotation (inside quote
marks, or after a reporting word) from abuse (an address near by); quoted hits
count a third.

The model is fitted on a bounded sample: about ``max_rows`` labelled rows chosen
by a hash of doc_id.  Texts are scored whole.  Labels, lang, source and doc_id
are no inputs of a score.

Defined results: null or empty text has no hits and gets the model's base score;
rows of one doc_id are scored each for itself; a doc_id with several or null
labels trains as toxic if any label says so, null labels do not train; without
both classes among the labels every score is the share of toxic ones (0 with
no labels at all); an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import drop_tables, map_arrow, map_pandas, with_row_ids, worker_cache, write_table

#: Words that report speech, and words that address a person, in the languages of the corpus.
REPORTING = frozenset("said says called calls word words term quote quoted wrote spelled "
                      "disait dit mot terme sagte sagt wort begriff dijo dice palabra".split())
ADDRESS = frozenset("you your u ur tu te toi vous votre du dich dein sie ihr usted eres vosotros".split())
QUOTES = "\"“”«»„‟"
BEGINNINGS = range(4, 9)
WINDOW = 5
MIN_SURPRISE = 16.0
_WORD = re.compile(r"[^\W\d_]+")
_CACHE_MAX = 400_000
PREFIX = "*"  # end of a beginning in the trie; no letter


class Trie:
    """Lexicon of (term, whole-word?) with weights; a beginning matches any longer word."""

    def __init__(self, terms: dict[tuple[str, bool], float], allowed: frozenset[str] = frozenset(), fuzzy_from: int = 5):
        self.root: dict = {}
        self.allowed = allowed
        self.exact = {t: w for (t, whole), w in terms.items() if whole}
        self.begin = {t: w for (t, whole), w in terms.items() if not whole}
        self.begin_lengths = sorted({len(t) for t in self.begin})
        self.heads, self.tails = set(), set()
        self.lengths = set()
        # beginnings, whole and with one letter left out: within one edit, word and stem share one of these
        self.begin_marks: set[str] = set()
        for (t, whole), w in terms.items():
            if len(t) < fuzzy_from:
                continue
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node["" if whole else PREFIX] = w
            # one edit leaves the first or the last half of a term untouched
            half = len(t) // 2
            if whole:
                self.heads.add(t[:half])
                self.tails.add(t[half:])
                self.lengths.update((len(t) - 1, len(t), len(t) + 1))
            else:
                self.begin_marks.add(t)
                self.begin_marks.update(t[:i] + t[i + 1:] for i in range(len(t)))
        self.head_lengths = sorted({len(h) for h in self.heads})
        self.tail_lengths = sorted({len(h) for h in self.tails})
        self.mark_lengths = sorted({len(m) for m in self.begin_marks})

    def _maybe(self, word: str) -> bool:
        """False only where no term can be within one edit."""
        if len(word) in self.lengths and (any(word[:k] in self.heads for k in self.head_lengths)
                                          or any(word[-k:] in self.tails for k in self.tail_lengths)):
            return True
        marks = self.begin_marks
        for k in self.mark_lengths:
            if k > len(word):
                break
            if word[:k] in marks:
                return True
            part = word[:k + 1]
            for i in range(k):
                if part[:i] + part[i + 1:] in marks:
                    return True
        return False

    def near(self, word: str) -> float:
        """Largest weight of a term within one edit: automaton states and trie nodes walked together."""
        n = len(word)
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << (i + 1)
        accept = 1 << n
        full = (accept << 1) - 1
        best = 0.0
        stack = [(self.root, 1, 3 & full)]  # states reached with no edit, with one edit
        while stack:
            node, none, one = stack.pop()
            for c, child in node.items():
                if c == "":
                    if (none | one) & accept and child > best:
                        best = child
                    continue
                if c == PREFIX:
                    # the stem is consumed before the word ends: the rest is free
                    if (none | one) & (accept - 1) and child > best:
                        best = child
                    continue
                m = masks.get(c, 0)
                none2 = none << 1 & m
                one2 = (one << 1 & m | none | none << 1 | none2 << 1) & full
                if none2 | one2:
                    stack.append((child, none2, one2))
        return best

    def match(self, word: str) -> tuple[float, bool] | None:
        """(weight, exact?) of a lower-case word, or None."""
        w = self.exact.get(word, 0.0)
        for k in self.begin_lengths:
            if k < len(word):
                b = self.begin.get(word[:k], 0.0)
                if b > w:
                    w = b
        if w:
            return w, True
        if word not in self.allowed and self._maybe(word):
            w = self.near(word)
            if w:
                return w, False
        return None


@dataclass
class ToxicModel:
    terms: dict[tuple[str, bool], float] = field(default_factory=dict)
    allowed: frozenset[str] = frozenset()
    coef: list[float] = field(default_factory=lambda: [0.0] * 7)
    base: float | None = None  # one score for all, without both classes
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(features), self.base)
        z = self.coef[0] + features @ np.array(self.coef[1:])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Matcher:
    """Features of texts under one lexicon; remembers words it has judged (bounded)."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[float, bool]] = {}

    def features(self, text: str | None) -> list[float]:
        """Evidence of different terms, strongest, hits, hits per word, misspelled, quoted."""
        low = (text or "").lower()
        words = _WORD.findall(low)
        new = set(words) - self.seen
        if new:
            if len(self.seen) > _CACHE_MAX:
                self.seen.clear()
                self.hits.clear()
                new = set(words)
            for w in new:
                if (m := self.trie.match(w)) is not None:
                    self.hits[w] = m
            self.seen |= new
        if self.hits.keys().isdisjoint(words):
            return [0.0] * 6
        evidence: dict[str, float] = {}
        hits = quoted = misspelled = 0
        # quote marks open before each place, one pass over the text
        spans = [(m.start(), m.group()) for m in _WORD.finditer(low)]
        marks = [i for i, c in enumerate(low) if c in QUOTES]
        opened = 0
        for k, (at, w) in enumerate(spans):
            if w not in self.hits:
                continue
            while opened < len(marks) and marks[opened] < at:
                opened += 1
            weight, exact = self.hits[w]
            before = {x for _, x in spans[max(0, k - WINDOW):k]}
            around = before | {x for _, x in spans[k + 1:k + 1 + WINDOW]}
            inside = opened % 2 == 1 and opened < len(marks) and at - marks[opened - 1] < 120
            if inside or before & REPORTING:
                weight *= 0.33
                quoted += 1
            elif around & ADDRESS:
                weight *= 1.2
            if not exact:
                weight *= 0.8
                misspelled += 1
            hits += 1
            evidence[w] = max(evidence.get(w, 0.0), weight)
        total = sum(evidence.values())
        return [min(total, 30.0), max(evidence.values()), math.log1p(hits),
                100 * hits / len(words) if len(words) < 100 else 100 * hits / (len(words) + 100),
                float(misspelled > 0), quoted / hits]


_matchers: dict[str, Matcher] = worker_cache(__name__)


def _matcher(model: ToxicModel) -> Matcher:
    """One matcher per worker and model, so that judged words are remembered between tasks."""
    if model.key not in _matchers:
        _matchers.clear()
        _matchers[model.key] = Matcher(Trie(model.terms, model.allowed))
    return _matchers[model.key]


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pos, neg = Counter(), Counter()
        for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
            words = set(_WORD.findall((text or "").lower()))
            terms = {(w, True) for w in words if len(w) > 2}
            terms |= {(w[:k], False) for w in words for k in BEGINNINGS if k < len(w)}
            (pos if toxic else neg).update(terms)
        keys = list(pos.keys() | neg.keys())
        yield pd.DataFrame({"term": [k[0] for k in keys], "whole": [k[1] for k in keys],
                            "pos": [pos[k] for k in keys], "neg": [neg[k] for k in keys]})


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton steps on a bounded table of features; coefficients of evidence stay non-negative."""
    free = list(range(x.shape[1]))
    while True:
        a = np.column_stack([np.ones(len(x)), x[:, free]])
        b = np.zeros(a.shape[1])
        reg = np.full(a.shape[1], ridge)
        reg[0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -40, 40)))
            h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(reg)
            step = np.linalg.solve(h, a.T @ (y - p) - reg * b)
            b += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        bad = [k for k, c in zip(free, b[1:], strict=True) if c < 0 and k < 4]
        if not bad:
            out = [0.0] * (x.shape[1] + 1)
            out[0] = float(b[0])
            for k, c in zip(free, b[1:], strict=True):
                out[k + 1] = float(c)
            return out
        free = [k for k in free if k not in bad]


def _lexicon(found: dict[tuple[str, bool], tuple[int, float]]) -> dict[tuple[str, bool], float]:
    """Terms that say something of their own.

    A beginning stays only if clearly more toxic texts have it than have its
    most frequent continuation; a longer term stays only if it weighs more
    than the beginnings that are kept.
    """
    widest: dict[str, int] = {}
    for (t, whole), (pos, _) in found.items():
        for k in BEGINNINGS:
            if k < len(t):
                widest[t[:k]] = max(widest.get(t[:k], 0), pos)
    kept: dict[tuple[str, bool], float] = {}
    for (t, whole), (pos, w) in sorted(found.items(), key=lambda x: (len(x[0][0]), x[0])):
        if not whole and pos < 1.3 * widest.get(t, 0):
            continue
        if w > max((kept.get((t[:k], False), 0.0) for k in BEGINNINGS if k < len(t)), default=0.0) + 0.5:
            kept[t, whole] = w
    return kept


def _close_words(terms: dict[tuple[str, bool], float]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie(terms)
        for pdf in batches:
            yield pd.DataFrame({"term": [t for t in pdf["term"] if trie._maybe(t) and trie.near(t)]}, dtype=object)
    return run


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 10_000, min_weight: float = 2.0) -> ToxicModel:
    """Learn lexicon and model from labelled rows (doc_id, toxic).

    ``max_rows`` bounds the sample (in expectation, chosen by hash); six tenths
    of it teach the lexicon, the rest the logistic model, so the model sees how
    the lexicon does on other texts.
    """
    marks = with_row_ids(labels, "doc_id", "toxic").where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    stats = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("pos")).head()
    if not stats["n"]:
        return ToxicModel(base=0.0)
    if stats["pos"] in (0, stats["n"]):
        return ToxicModel(base=float(stats["pos"] / stats["n"]))
    modulus = 1_000_000
    share = min(modulus, math.ceil(modulus * max_rows / stats["n"]))
    chosen = marks.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(modulus)) < share)
    sample, sample_path = write_table(
        with_row_ids(documents, "doc_id", "text").join(chosen, "doc_id").select(
            "text", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(10)) < 6).alias("lexicon")), "toxic-sample")
    part = sample.where("lexicon")
    n = part.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos"), F.count("*").alias("n")).head()
    n_pos, n_neg = n["pos"], n["n"] - n["pos"]
    if not n_pos or not n_neg:
        part, n_pos, n_neg = sample, stats["pos"], stats["n"] - stats["pos"]
    counts, counts_path = write_table(
        map_pandas(part.select("text", "toxic"), _term_counts, "term string, whole boolean, pos bigint, neg bigint")
        .groupBy("term", "whole").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "toxic-terms")
    weight = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    # log-likelihood ratio of the term against no link with the label: few sightings teach nothing
    expect = (F.col("pos") + F.col("neg")) * F.lit(n_pos / (n_pos + n_neg))
    surprise = 2 * F.col("pos") * F.log(F.col("pos") / expect)
    found = (counts.where("pos > 1 AND neg <= pos").withColumn("w", weight)
             .where((F.col("w") >= min_weight) & (surprise >= MIN_SURPRISE)).collect())
    kept = _lexicon({(r["term"], r["whole"]): (r["pos"], float(r["w"])) for r in found})
    allowed: frozenset[str] = frozenset()
    if any(len(t) >= 5 for t, _ in kept):
        # words of clean texts that happen to lie one edit from a term
        allowed = frozenset(r["term"] for r in map_pandas(
            counts.where("whole AND neg > 0 AND neg >= pos").where(F.length("term") >= 4).select("term"),
            _close_words(kept), "term string").collect())
    model = ToxicModel(terms=kept, allowed=allowed)
    rows = (sample.where("NOT lexicon") if sample.where("NOT lexicon AND toxic = 1").limit(1).count() else sample)
    fitted = map_pandas(rows.select("text", "toxic"), _feature_rows(model), "toxic int, f array<double>").toPandas()
    drop_tables(documents.sparkSession, [sample_path, counts_path])
    model.coef = _fit_logistic(np.array(fitted["f"].tolist(), float).reshape(len(fitted), 6),
                               fitted["toxic"].to_numpy(float))
    return model


def _feature_rows(model: ToxicModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(model)
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "f": [matcher.features(t) for t in pdf["text"]]})
    return run


def toxicity(documents: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, score and predicted of every row of ``documents``."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(model)
        for batch in batches:
            found = [matcher.features(t.as_py()) for t in batch.column(len(names))]
            score = model.score(np.array(found, float).reshape(batch.num_rows, 6))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())],
                [*names, "score", "predicted"])

    src = documents.select(*[F.col(f"`{c}`") for c in names], F.col("text").alias("_scored"))
    fields = [f"`{c}` {t}" for c, t in src.dtypes[:-1]]
    return map_arrow(src, run, ", ".join([*fields, "score double", "predicted int"]))
