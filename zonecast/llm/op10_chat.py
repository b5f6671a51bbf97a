"""Chat formatting: a finite-state machine over roles and a declarative template.

The template lists, per role, the marks before and after a text and whether the
text is under the loss mask.  Control strings inside texts are escaped: a
backslash after the first character of every control string (with any
backslashes already there kept, one more added), which reading takes out again.
A role machine says whether the turns of a conversation come in a valid order;
its transitions run as a fold over the ordered roles.

Output per conversation: ``formatted``, and its segments with a loss flag per
segment (text, loss), whose texts joined give ``formatted``.

Defined results: null text is empty; a null role is an empty role and, like any
role the template does not know, is written with the default marks, without
loss, and makes the order invalid; a null conv_id is a conversation; turns go by
turn (nulls first), then role, then text, and repeated rows are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.common import with_row_ids


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around texts; ``{role}`` in ``before`` is filled in."""

    before: str = "<s>[{role}]\n"
    after: str = "</s>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Strings that steer a model: none of them may come out of a text.
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    #: state -> role -> next state; "start" is the first state.
    machine: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "asked", "user": "user"},
        "asked": {"user": "user"},
        "user": {"assistant": "answer"},
        "answer": {"user": "user"},
    })
    accepting: tuple[str, ...] = ("answer",)

    @property
    def control_pattern(self) -> str:
        """Java and Python regex: first character, backslashes, the rest of a control string."""
        return "|".join(f"(?:(?<={re.escape(c[0])})(\\\\*)(?={re.escape(c[1:])}))" for c in self.controls)


DEFAULT_TEMPLATE = ChatTemplate()


def _pattern(t: ChatTemplate, escaped: bool) -> str:
    heads = "".join(sorted({re.escape(c[0]) for c in t.controls}))
    tails = "|".join(re.escape(x) for x in sorted({c[1:] for c in t.controls}))
    return f"([{heads}])(\\\\{'+' if escaped else '*'})(?={tails})"


def escape(text: Column, t: ChatTemplate) -> Column:
    return F.regexp_replace(text, F.lit(_pattern(t, False)), F.lit(r"$1\\$2"))


def unescape(text: Column, t: ChatTemplate) -> Column:
    # one backslash goes: the first of the run
    pattern = _pattern(t, True).replace(r"(\\+)", r"\\(\\*)")
    return F.regexp_replace(text, F.lit(pattern), F.lit("$1$2"))


def _role_mark(role: Column) -> Column:
    """Roles keep out of the mark's own end: percent signs, brackets and line feeds are written as codes."""
    for char, code in (("%", "%25"), ("]", "%5D"), ("\n", "%0A")):
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def _role_back(mark: Column) -> Column:
    for char, code in (("\n", "%0A"), ("]", "%5D"), ("%", "%25")):
        mark = F.replace(mark, F.lit(code), F.lit(char))
    return mark


def _valid(roles: Column, t: ChatTemplate) -> Column:
    """Whether the machine accepts the sequence of roles."""
    steps = F.create_map(*[F.lit(x) for s, nexts in t.machine.items() for r, to in nexts.items() for x in (f"{s}>{r}", to)])
    end = F.aggregate(roles, F.lit("start"), lambda state, role: F.when(
        state == "stuck", state).otherwise(F.coalesce(F.get(F.array(steps[F.concat(state, F.lit(">"), role)]), F.lit(0)), F.lit("stuck"))))
    return end.isin(list(t.accepting))


def format_conversations(turns: DataFrame, t: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """conv_id, formatted, segments (text, loss), valid."""
    rows = with_row_ids(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    before, after = t.before.split("{role}"), t.after
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def parts(x: Column) -> Column:
        open_mark = F.concat(F.lit(before[0]), escape(_role_mark(x["role"]), t), F.lit(before[1]))
        return F.array(
            F.struct(open_mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"], t).alias("text"), x["role"].isin(list(t.loss_roles)).alias("loss")),
            F.struct(F.lit(after).alias("text"), F.lit(False).alias("loss")))

    segments = convs.select(
        "conv_id", F.flatten(F.transform("turns", parts)).alias("segments"),
        _valid(F.transform("turns", lambda x: x["role"]), t).alias("valid"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments", "valid")


def write_formatted(turns: DataFrame, out: str, t: ChatTemplate = DEFAULT_TEMPLATE) -> None:
    """Write conv_id, formatted, the loss spans (start, length in characters) and valid to ``out``."""
    formatted = format_conversations(turns, t)
    spans = F.aggregate(
        "segments", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s["text"])).alias("at"),
            F.when(s["loss"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(s["text"]).alias("length")))))
            .otherwise(a["spans"]).alias("spans")))["spans"]
    formatted.select("conv_id", "formatted", spans.alias("loss_spans"), "valid").write.mode("error").parquet(out)


def read_formatted(spark: SparkSession, out: str, t: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Digests of what the written output holds: turns and loss text parsed back from ``formatted``."""
    before = t.before.split("{role}")
    mark = re.escape(before[0]) + r"([^\]\n]*)" + re.escape(before[1])
    pieces = F.split("formatted", re.escape(t.after))
    turns = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda p: F.struct(
            _role_back(unescape(F.regexp_extract(p, f"^{mark}", 1), t)).alias("role"),
            unescape(F.regexp_replace(p, F.lit(f"^{mark}"), F.lit("")), t).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"]), t)), "")
    parsed = spark.read.parquet(out).select("conv_id", "valid", turns.alias("turns"), loss.alias("loss"),
                                            F.length("formatted").cast("long").alias("formatted_chars"))
    digest = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(digest, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars", "valid")
