"""Quality rules as weak supervision.

Eight rules look at a text and vote good (1), bad (-1) or abstain (0).
Expectation-maximisation over the vote patterns of all documents estimates how
often each rule fires on good documents and on each kind of bad ones, and the
shares of these classes; the posterior probability of "good" then decides,
instead of all rules having to pass.

The text is read once with built-in functions.  The number of vote patterns is
at most 3^8 at any input size, so the EM steps run on that table of counts.

Repeated words come from 3-word windows inside one row: every window becomes a
64-bit number with its hash above its position, the numbers are sorted, and
equal neighbours are repeats.  Should two different windows share a hash in a
text, that text is counted again from the words themselves.

Defined results: null or empty text has no words, every count 0, fails the base
rule and is not kept; repeated rows are each judged; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import SPACE, with_row_ids, write_table

RULES = ("length", "symbols", "duplicate_lines", "repeats", "word_length", "capitals", "variety", "sentences")


def _vote(bad: str, good: str) -> Column:
    return F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")


VOTES = {
    "length": ("n_words < 50", "n_words >= 80"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "duplicate_lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    "repeats": ("100 * n_repeat_words > 50 * n_words", "100 * n_repeat_words <= 20 * n_words"),
    "word_length": ("word_chars < 3 * n_words OR word_chars > 12 * n_words",
                    "word_chars >= 4 * n_words AND word_chars <= 9 * n_words"),
    "capitals": ("10 * n_capitals > 3 * word_chars", "10 * n_capitals <= word_chars"),
    "variety": ("100 * n_distinct < 15 * n_words", "100 * n_distinct >= 25 * n_words"),
    "sentences": ("n_stops = 0 AND n_words >= 20", "n_stops > 0 AND n_words <= 60 * n_stops"),
}


def _words(text: str) -> Column:
    trimmed = F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def features(documents: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules read, one row per document."""
    base = with_row_ids(documents, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = base.select("doc_id", "text", _words("text").alias("w")).withColumn("n", F.size("w"))
    # a power of two above the number of windows leaves the upper bits to the hash
    cut = cut.withColumn("b", F.expr("int(ceil(log2(n + 2)))"))
    windows = cut.withColumn("s", F.expr(
        "CASE WHEN n < 3 THEN cast(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, n - 3),"
        " i -> shiftleft(xxhash64(w[i], w[i + 1], w[i + 2]), b) | i)) END"))
    repeats = windows.withColumn("d", F.expr(
        "filter(s, (x, k) -> (k > 0 AND shiftright(x, b) = shiftright(get(s, k - 1), b))"
        " OR (k < n - 3 AND shiftright(x, b) = shiftright(get(s, k + 1), b)))"))
    places = repeats.withColumn("p", F.expr("transform(d, x -> int(x & (shiftleft(1L, b) - 1)))")).withColumn(
        "mixed", F.expr("exists(sequence(0, size(p)), k -> k > 0 AND k < size(p)"
                        " AND shiftright(d[k], b) = shiftright(d[k - 1], b)"
                        " AND NOT (w[p[k]] = w[p[k - 1]] AND w[p[k] + 1] = w[p[k - 1] + 1]"
                        " AND w[p[k] + 2] = w[p[k - 1] + 2]))"))
    exact = ("array_sort(transform(sequence(0, n - 3), i -> struct(w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, i AS i)))")
    same = "q[{0}].a = q[{1}].a AND q[{0}].b = q[{1}].b AND q[{0}].c = q[{1}].c"
    by_words = (f"transform(array({exact}), q -> transform(filter(sequence(0, size(q) - 1), k ->"
                f" (k > 0 AND {same.format('k', 'k - 1')}) OR (k < size(q) - 1 AND {same.format('k', 'k + 1')})),"
                " k -> q[k].i))[0]")
    covered = places.withColumn("p", F.expr(f"sort_array(CASE WHEN mixed THEN {by_words} ELSE p END)"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return covered.withColumn("lines", lines).select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("bigint(aggregate(p, struct(-3 AS last, 0 AS n),"
               " (a, x) -> struct(x AS last, a.n + least(3, x - a.last) AS n)).n)").alias("n_repeat_words"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.regexp_count("text", F.lit(r"[.!?](?:[\x20\x09-\x0D]|$)")).cast("long").alias("n_stops"))


def estimate(patterns: list[tuple[tuple[int, ...], int]], steps: int = 200) -> tuple[list[float], list[list[float]]]:
    """EM on (votes, count) rows: class shares, and per class how often each rule that votes votes bad.

    Class 0 is good; class j is the kind of bad document that rule j is made
    for, as kinds of junk differ and one bad class would hold only the kind that
    most rules see.  An abstention says nothing.  The prior, worth one document
    per hundred (the good class: one per two), says that a rule seldom fires on
    a good document and mostly on its own kind.
    """
    width = len(RULES)
    total = sum(c for _, c in patterns)
    start = [[0.005] * width] + [[0.8 if j == k else 0.1 for j in range(width)] for k in range(width)]
    worth = [total / 2] + [total / 100] * width
    shares, fires = [0.8] + [0.2 / width] * width, start
    for _ in range(steps):
        mass = [0.0] * (width + 1)
        cast = [[w] * width for w in worth]
        bad = [[w * f for f in row] for w, row in zip(worth, start, strict=True)]
        for votes, count in patterns:
            for k, p in enumerate(posterior(votes, shares, fires)):
                mass[k] += count * p
                for j, v in enumerate(votes):
                    if v:
                        cast[k][j] += count * p
                        if v < 0:
                            bad[k][j] += count * p
        new_shares = [(m + 0.01) / (total + 0.01 * (width + 1)) for m in mass]
        new_fires = [[min(0.999, max(0.001, x / c)) if c else f for x, c, f in zip(*rows, strict=True)]
                     for rows in zip(bad, cast, start, strict=True)]
        moved = max(abs(x - y) for x, y in zip(new_shares, shares, strict=True))
        shares, fires = new_shares, new_fires
        if moved < 1e-9:
            break
    return shares, fires


def posterior(votes: tuple[int, ...], shares: list[float], fires: list[list[float]]) -> list[float]:
    """Probability of each class given a pattern of votes."""
    logs = [math.log(s) + sum(math.log(f if v < 0 else 1 - f) for v, f in zip(votes, row, strict=True) if v)
            for s, row in zip(shares, fires, strict=True)]
    top = max(logs)
    odds = [math.exp(x - top) for x in logs]
    return [x / sum(odds) for x in odds]


def quality(documents: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, posterior (probability of good) and kept."""
    counted, _ = write_table(features(documents), "quality")
    voted = counted.select("*", *[_vote(*VOTES[r]).alias(f"vote_{r}") for r in RULES])
    names = [f"vote_{r}" for r in RULES]
    rows = voted.groupBy(*names).count().collect()  # 3^8 rows at most
    shares, fires = estimate([(tuple(r[n] for n in names), r["count"]) for r in sorted(rows)])
    logs = []
    for share, row in zip(shares, fires, strict=True):
        log = F.lit(math.log(share))
        for name, f in zip(names, row, strict=True):
            log = log + F.when(F.col(name) < 0, math.log(f)).when(F.col(name) > 0, math.log(1 - f)).otherwise(0.0)
        logs.append(log)
    good = 1 / sum((F.exp(x - logs[0]) for x in logs[1:]), F.lit(1.0))
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return (voted.withColumn("posterior", good).withColumn("base_failed", failed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"), "posterior"))
