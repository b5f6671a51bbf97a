"""Secret scan: broad candidates, then a random forest that removes false positives.

Candidates are runs of 16 and more characters of tokens that hold a digit, or
that stand quoted behind an assignment, and whatever their characters the values
of 6 and more that are assigned to a secret's name, follow Bearer, or stand as
password before the @ of an address.  Candidates can overlap.  The forest looks
at length, changes of character class, entropy, how much of the candidate
dictionary words cover, its path-like parts, and the words around it.

It is trained from labelled findings (features, label).  ``weak_findings`` derives
such findings from a corpus without labels: a random-looking value assigned to a
secret's name is one, other candidates are not, and each true context is written
again with values of either kind (other random codes; placeholders, joined words,
repeated characters, paths), so that the forest learns value and context.
The training sample is bounded (``max_rows``, chosen by hash); the dictionary is
counted over all documents and scanning covers every text as a whole.  Candidates are kept as digests,
places and features: no value or context is written in clear.

Defined results: null or empty text has no findings; repeated rows give their
findings each; without findings of both classes a finding gets the share of
true labels as probability; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import drop_tables, map_arrow, with_row_ids, write_table

#: Names that secrets are assigned to, and words that mark an example value.
SECRET_NAMES = frozenset("token secret password passwd pwd apikey api_key key auth authorization bearer "
                         "credential credentials access private signature".split())
EXAMPLE_WORDS = frozenset("example sample dummy placeholder your here fake changeme insert redacted xxxx".split())

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-=.~]{16,}")
_BEFORE = re.compile(r"([A-Za-z_][\w\-]*)\W*$")
_ASSIGN = re.compile(r"(?:[=:]=?>?\s*(?:(?:bearer|basic|digest|token)\s+)?|\bbearer\s+)(?:[rbfu]{0,2}[\"'`]{1,3})?"
                     r"(?:(?:bearer|basic|digest|token)\s+)?$", re.I)
# names are read once each (possessive), so the scan stays linear in the text
_NAMED = re.compile(r"(?<![\w\-])([\w\-]++)[\"'`\])]*+\s*+[=:]=?>?")
_QUOTED = re.compile(r"\s*+[rbfuRBFU]{0,2}(\"\"\"|\'\'\'|[\"'`])((?:\\.|(?!\1)[^\\\n])++)\1")
_PLAIN = re.compile(r"[^\S\n]*+[rbfuRBFU]{0,2}[\"'`]{1,3}(\S++)|[^\S\n]*+(\S++)")
_BLANK = re.compile(r"[^\S\n]*+")
_SCHEME = re.compile(r"(?:bearer|basic|digest|token)\s+", re.I)
_BEARER = re.compile(r"\bbearer\s++[\"'`]?([^\s\"'`<>]{6,}+)", re.I)
_NEXT_FIELD = re.compile(r"[;&,](?=[\"'`]?[\w.\-]++[\"'`]?[=:])")
_URL_LOGIN = re.compile(r"://[^\s/:@\"'<>]*+:([^\s/\"'<>]{6,})@")
_LOGIN = re.compile(r"(?<![\w./:@+\-])(?!mailto:|e-?mail:)[\w.+\-]{1,64}+:([^\s/:@]{6,}+)@(?=\w)", re.I)
_LOGIN_BEFORE = re.compile(r"(?:://[^\s/:@\"'<>]*|(?<![\w./:@+\-])[\w.+\-]+):$")
# a value that refers to a secret kept elsewhere: ${NAME}, <name>, {{ name }}, call(...), table[...]
_REFERENCE = re.compile(r"\$\w+|\$[{(].*|<[^>]*>?|\{\{.*|%\w+%|[A-Za-z_][\w.]*[(\[].*", re.S)
_WORD_IN_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PART = re.compile(r"[A-Za-z]{3,}")
FEATURES = ("log_length", "class_changes", "digit_share", "upper_share", "distinct_share", "entropy", "hex_only",
            "dictionary_share", "path_parts", "web_before", "assigned", "quoted", "name_before", "name_near", "example_near", "reference")
_CONTEXT = 60
_LEAST = 6


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def is_secret_name(name: str) -> bool:
    """A name of SECRET_NAMES, alone or as a part of ``name`` (db_password, api-key, accessToken)."""
    low = name.lower().strip("_-")
    return low in SECRET_NAMES or any(p in SECRET_NAMES for p in re.split(r"[_\-]", low)) or any(
        p.lower() in SECRET_NAMES for p in _WORD_IN_NAME.findall(name))


def describe(value: str, before: str, after: str, dictionary: frozenset[str]) -> list[float]:
    """Numbers that the forest splits on."""
    n = len(value)
    kinds = [_kind(c) for c in value]
    counts = Counter(value)
    covered = 0
    for part in _PART.findall(value):
        # words of the dictionary, longest first from the left
        low, i = part.lower(), 0
        while i < len(low):
            for j in range(min(len(low), i + 14), i + 2, -1):
                if low[i:j] in dictionary:
                    covered += j - i
                    i = j
                    break
            else:
                i += 1
    near = {w.lower() for w in re.findall(r"[A-Za-z_]+", before[-40:])}
    # the name stands before an authentication scheme (Authorization: Basic ...)
    last = _BEFORE.search(re.sub(r"\b(?:basic|digest)\s+$", "", before, flags=re.I))
    login = after[:1] == "@" and _LOGIN_BEFORE.search(before) is not None
    words = set(re.split(r"[^a-z]+", value.lower())) | near | set(re.findall(r"[a-z]+", after[:20].lower()))
    return [math.log(n), sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
            sum(k == 0 for k in kinds) / n, sum(k == 2 for k in kinds) / n, len(counts) / n,
            -sum(c / n * math.log2(c / n) for c in counts.values()),
            float(re.fullmatch(r"[0-9a-fA-F]+", value) is not None), covered / n,
            float(value.count("/") + value.count(".")), float("://" in before[-12:] or before.endswith("/")),
            float(_ASSIGN.search(before) is not None), float(before[-1:] in "\"'`" and after[:1] in "\"'`" and after != ""),
            float(login or (last is not None and is_secret_name(last.group(1)))),
            float(bool(near & SECRET_NAMES)), float(bool(words & EXAMPLE_WORDS)),
            float(_REFERENCE.fullmatch(value) is not None)]


def _trimmed(value: str, opened: str) -> str:
    """An unquoted value without the marks that end it; ``opened`` is the quote around the whole assignment, if any."""
    if opened:
        value = value.split(opened, 1)[0]
    return value.rstrip("\"'`,;" + "".join(c for o, c in ("()", "[]", "{}", "<>") if o not in value))


def named_values(text: str) -> set[tuple[int, int]]:
    """(start, end) of the values that a secret's name, Bearer or a login marks, whatever their characters."""
    found: set[tuple[int, int]] = set()
    at = done = stop = field = 0
    while (m := _NAMED.search(text, at)) is not None:
        at = m.end()
        if not is_secret_name(m.group(1)):
            continue
        if (v := _QUOTED.match(text, m.end())) is not None:
            start, end = v.span(2)
            if (scheme := _SCHEME.match(text, start, end)) is not None:
                start = scheme.end()
            found.add((start, end))
            continue
        start = _BLANK.match(text, m.end()).end()
        if (scheme := _SCHEME.match(text, start)) is not None:
            start = scheme.end()
        # a run of several fields counts as a whole, and each field up to the next (read once: no field starts in another)
        if start >= done:
            if (v := _PLAIN.match(text, start)) is None:
                continue
            start, done = v.span(v.lastindex)
            before = text[m.start() - 1:m.start()] if m.start() else ""
            stop = start + len(_trimmed(text[start:done], before if before and before in "\"'`" else ""))
            found.add((start, stop))
            field = start
        if start >= field:
            cut = _NEXT_FIELD.search(text, start, stop)
            field = cut.start() if cut is not None else stop
            found.add((start, field))
    for pattern in (_BEARER, _URL_LOGIN, _LOGIN):
        for m in pattern.finditer(text):
            start, value = m.start(1), m.group(1)
            found.add((start, start + len(_trimmed(value, "") if pattern is _BEARER else value)))
    return {(a, b) for a, b in found if b - a >= _LEAST}


def candidates(text: str | None) -> Iterator[tuple[int, str, str, str]]:
    """(start, value, before, after) of everything that could be a secret."""
    for start, value, before, after, _ in _marked(text):
        yield start, value, before, after


def _marked(text: str | None) -> Iterator[tuple[int, str, str, str, bool]]:
    """Candidates, each with whether it holds, or lies in, another value that a name marks: its own label is open."""
    text = text or ""
    named = sorted(named_values(text))
    reach = list(accumulate((b for _, b in named), max))
    spans = {span: True for span in named}
    for m in _CANDIDATE.finditer(text):
        value = m.group().strip("=.-") if not m.group().endswith("==") else m.group().lstrip("=.-")
        start = m.start() + m.group().find(value) if value else m.start()
        if len(value) >= 16:
            spans.setdefault((start, start + len(value)), False)
    for (start, end), marked in sorted(spans.items()):
        value = text[start:end]
        before = text[max(0, start - _CONTEXT):start]
        after = text[end:end + _CONTEXT]
        if not (marked or any(c.isdigit() for c in value) or (_ASSIGN.search(before) and before[-1:] in "\"'`")):
            continue
        i = bisect_left(named, (start, 0))
        inner = [x for x in named[i:i + 2] if x != (start, end) and x[0] < end and (not marked or x[1] <= end)]
        yield start, value, before, after, bool(inner) or (not marked and i > 0 and reach[i - 1] > start)


def weak_labels(value: str, before: str, after: str, f: list[float], dictionary: list[str]) -> Iterator[tuple[list[float], float]]:
    """(features, label) of a candidate without a label, and of its context with other values where it is true."""
    known = dict(zip(FEATURES, f, strict=True))
    true = bool(known["name_before"] and known["assigned"] and known["entropy"] >= min(3, 0.8 * math.log2(len(value)))
                and not known["reference"] and known["class_changes"] >= 0.2 and not known["example_near"]
                and known["dictionary_share"] < 0.4)
    yield f, float(true)
    if not true:
        return
    digest = hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()
    code = base64.urlsafe_b64encode(digest).decode().rstrip("=")
    words, known_words = dictionary or ["value"], frozenset(dictionary)
    joined = "_".join(words[b % len(words)] for b in digest[:4]) + "_1"
    for other, label in ((code, 1.0), (digest.hex()[:32], 1.0), (code[:20].upper() + code[20:24], 1.0),
                         (code[:6] + "!" + code[6:9] + "$", 1.0), (code[9:15] + "&" + code[15:17], 1.0),
                         (words[digest[4] % len(words)], 0.0), ("${" + words[digest[5] % len(words)].upper() + "}", 0.0),
                         ("get_" + words[digest[6] % len(words)] + "()", 0.0),
                         (joined, 0.0), ("your_" + joined, 0.0), (chr(97 + digest[0] % 26) * 24, 0.0),
                         ("1234567890" * 2, 0.0), (joined.replace("_", "/") + ".txt", 0.0)):
        yield describe(other, before, after, known_words), label
    # the same code where nothing speaks of a secret: a checksum in running text
    yield describe(digest.hex()[:40], "commit of the file ", " was built", known_words), 0.0


_FINDING = pa.struct([("f", pa.list_(pa.float64())), ("label", pa.float64())])


def _scan(dictionary: frozenset[str], labelled: bool):
    """Candidates of every text with their features, and the labelled findings they give if asked for.  Values
    and their contexts stay in the task: only digests and features leave it."""
    words = sorted(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1)):
                for start, value, before, after, overlaps in _marked(text.as_py()):
                    f = describe(value, before, after, dictionary)
                    weak = ([{"f": g, "label": y} for g, y in weak_labels(value, before, after, f, words)]
                            if labelled and not overlaps else [])
                    at.append(i)
                    rows.append((start, len(value), hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest(), f, weak))
            places = pa.array(at, pa.int64())
            types = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.list_(_FINDING))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(places), batch.column(2).take(places),
                 *[pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]],
                ["doc_id", "text_key", "start", "length", "value_sha256", "f", "weak"])
    return run


_FOUND = ("doc_id bigint, text_key bigint, start bigint, length bigint, value_sha256 string, f array<double>, "
          "weak array<struct<f:array<double>,label:double>>")


def weak_findings(found: DataFrame) -> DataFrame:
    """(f, label, key) of scanned candidates; the key depends on the finding's place, not on how files are laid out."""
    return (found.select("doc_id", "text_key", "start", F.posexplode("weak").alias("pos", "w"))
            .select("w.f", "w.label", F.xxhash64("doc_id", "text_key", "start", "pos").alias("key")))


def train(findings: DataFrame, max_rows: int = 20_000, trees: int = 30, depth: int = 6, seed: int = 4
          ) -> RandomForestClassificationModel | float:
    """Forest from labelled findings (f, label); the share of true ones where there is one class only.

    The sample goes by the findings' ``key``, by their features where they have none.
    """
    spark = findings.sparkSession
    key = F.col("key") if "key" in findings.columns else F.xxhash64("f")
    rows, path = write_table(findings.select("f", "label", key.alias("key")), "findings")
    stats = rows.agg(F.count("*").alias("n"), F.sum("label").alias("pos")).head()
    if not stats["n"] or stats["pos"] in (0, stats["n"]):
        drop_tables(spark, [path])
        return float((stats["pos"] or 0) / max(1, stats["n"]))
    share = min(1.0, max_rows / stats["n"])
    spread = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000)
    # a bounded table: one partition in a fixed order makes reruns agree
    sample = rows.where(spread).repartition(1).sortWithinPartitions("label", "f").select(
        array_to_vector("f").alias("features"), "label")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(sample)
    drop_tables(spark, [path])
    return model


def dictionary_of(documents: DataFrame, size: int = 4000) -> frozenset[str]:
    """The ``size`` words of three to twelve letters that most documents have, counted over all of them (part of the model)."""
    words = with_row_ids(documents, "text").select(
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?<![a-z])[a-z]{3,12}(?![a-z])"), F.lit(0)))).alias("w"))
    top = words.groupBy("w").count().where("count > 1").orderBy(F.desc("count"), "w").limit(size).collect()
    return frozenset(r["w"] for r in top)


def find_secrets(documents: DataFrame, model: RandomForestClassificationModel | float | None = None,
                 dictionary: frozenset[str] | None = None) -> DataFrame:
    """One row per candidate: doc_id, text_key, start, length, value_sha256, probability, is_secret.

    Without a model one is trained from ``weak_findings`` of these documents.
    """
    docs = with_row_ids(documents, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    words = dictionary_of(documents) if dictionary is None else dictionary
    found, _ = write_table(map_arrow(docs, _scan(words, model is None), _FOUND), "secret-candidates")
    if model is None:
        model = train(weak_findings(found))
    if isinstance(model, float):
        scored = found.withColumn("p", F.lit(model))
    else:
        scored = model.transform(found.drop("weak").withColumn("features", array_to_vector("f"))).withColumn(
            "p", vector_to_array("probability")[1])
    return scored.select("doc_id", "text_key", "start", "length", "value_sha256",
                         F.round("p", 6).alias("probability"), (F.col("p") >= 0.5).alias("is_secret"))


def redact(documents: DataFrame, findings: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with every secret of ``findings`` replaced in its text; all columns and rows stay."""
    spans = findings.where("is_secret").select("doc_id", "text_key", "start", "length").distinct().groupBy(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias("_spans"))
    spans, _ = write_table(spans, "secret-spans")
    joined = documents.join(spans, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_key")), "left")
    cut = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        # spans that overlap give one mark
        lambda a, s: F.struct(F.greatest(a["at"], s["start"] + s["length"]).alias("at"),
                              F.when(s["start"] < a["at"], a["out"]).otherwise(
                                  F.concat(a["out"], F.substring("text", (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                                           F.lit(mark))).alias("out")),
        lambda a: F.concat(a["out"], F.substring("text", (a["at"] + 1).cast("int"), F.length("text"))))
    return joined.withColumn("text", F.when(F.col("_spans").isNotNull(), cut).otherwise(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in documents.columns])
