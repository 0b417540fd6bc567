"""Chat formatting: a finite-state machine over roles and a declarative template (native Spark only).

``format_conversations`` sorts a conversation's rows by (turn, role, text), runs the role machine
over them, and emits text segments with a loss flag each; the formatted text is their concatenation.
``read_turns`` reads the turns back from the formatted text alone.

Cases: null text or role counts as empty; equal rows are turns of their own; rows with a null
conv_id form one conversation; an empty table gives an empty result; other columns are ignored. A
conversation whose roles break the machine is formatted all the same, with ``valid`` false and the
index of the first offending turn (its length, if it only stops too early). A conversation is one output
value, so one task holds one conversation's text; conversations are spread by conv_id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "### "
    role_close: str = ": "
    close: str = "</turn>\n"
    labels: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: tuple = ("assistant",)
    #: Role machine: state -> {role: next state}; turns may end in ``final``.
    machine: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"}, "system": {"user": "user"},
        "user": {"assistant": "assistant"}, "assistant": {"user": "user"}})
    final: tuple = ("assistant",)
    #: Characters that begin or end control strings, and what stands for them; the first is the escape itself.
    escapes: tuple = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
    #: Escapes used inside texts (role names use them all).
    text_escapes: int = 3


CHAT = Template()


def escape(c: Column, t: Template, n: int) -> Column:
    for raw, code in t.escapes[:n]:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column, t: Template, n: int) -> Column:
    for raw, code in reversed(t.escapes[:n]):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _label(role: Column, t: Template) -> Column:
    other = F.concat(F.lit("\\r"), escape(role, t, len(t.escapes)))
    out = F.lit(None).cast("string")
    for k, v in t.labels.items():
        out = F.coalesce(out, F.when(role == k, F.lit(v)))
    return F.coalesce(out, other)


def _role(label: Column, t: Template) -> Column:
    out = F.lit(None).cast("string")
    for k, v in t.labels.items():
        out = F.coalesce(out, F.when(label == v, F.lit(k)))
    return F.coalesce(out, unescape(F.substring(label, 3, 1 << 30), t, len(t.escapes)))


def run_machine(turns: Column, t: Template) -> Column:
    """struct(valid, bad_turn): the state goes through the turns from left to right."""
    arcs = F.create_map(*[F.lit(x) for s, out in t.machine.items() for r, n in out.items() for x in (f"{s}>{r}", n)])
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("bad"))

    def step(acc, x):
        nxt = F.try_element_at(arcs, F.concat(acc["state"], F.lit(">"), x["role"]))
        return F.struct(F.coalesce(nxt, F.lit("start")).alias("state"), (acc["i"] + 1).alias("i"),
                        F.coalesce(acc["bad"], F.when(nxt.isNull(), acc["i"])).alias("bad"))

    def end(acc):
        bad = F.coalesce(acc["bad"], F.when(~acc["state"].isin(*t.final), acc["i"]))
        return F.struct(bad.isNull().alias("valid"), bad.alias("bad_turn"))

    return F.aggregate(turns, start, step, end)


def format_conversations(df: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, turns array<struct<turn, role, text>>, segments array<struct<text, loss>>, formatted,
    valid, bad_turn."""
    t = template
    row = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    conv = df.select("conv_id", row.alias("_r")).groupBy("conv_id").agg(F.sort_array(F.collect_list("_r")).alias("turns"))

    def segments(x):
        return F.array(
            F.struct(F.concat(F.lit(t.open), _label(x["role"], t), F.lit(t.role_close)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"], t, t.text_escapes).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))

    conv = conv.withColumn("segments", F.flatten(F.transform("turns", segments)))
    conv = conv.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    return conv.withColumn("_m", run_machine(F.col("turns"), t)).select(
        "conv_id", "turns", "segments", "formatted", F.col("_m.valid").alias("valid"), F.col("_m.bad_turn").alias("bad_turn"))


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """array<struct<role, text>> read back from the formatted text."""
    t = template
    parts = F.split(formatted, "\\Q" + t.close + "\\E", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def read(p):
        body = F.substring(p, len(t.open) + 1, 1 << 30)
        at = F.instr(body, t.role_close)
        return F.struct(_role(F.substr(body, F.lit(1), at - 1), t).alias("role"),
                        unescape(F.substr(body, at + len(t.role_close)), t, t.text_escapes).alias("text"))

    return F.transform(parts, read)


def read_loss(segments: Column, template: Template = CHAT) -> Column:
    """The text under the loss mask, unescaped, nothing between its parts."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"], template, template.text_escapes)), "")


def digests(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    turns = read_turns(F.col("formatted"), template)
    said = F.array_join(F.transform("_t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    d = formatted.select("conv_id", "formatted", "valid", turns.alias("_t"), read_loss(F.col("segments"), template).alias("_l"))
    return d.select("conv_id", F.size("_t").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.char_length("_l").cast("long").alias("loss_chars"), F.sha2("_l", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")
