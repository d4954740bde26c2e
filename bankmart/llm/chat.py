r"""Chat conversations as training text that reads back exactly.

A conversation is ``<s>`` and its turns. A turn stands between the marks of its role; an
assistant's, which the loss covers, is what comes up to ``</s>``:

    <<SYS>>text<</SYS>>   [INST]text[/INST]   text</s>   <<TURN role>>text<</TURN>>

Rendered text is parsed again and compared with its source. If it differs, because a text
holds a mark or looks escaped, the conflicting texts are escaped, and if that doesn't do,
all are. Escaped text has no ``<``, ``[`` or ``>`` left, so nothing in it can be a mark.

All of it is built-in functions on one row per conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.llm.columns import pick

START = "<s>"
# Role: opening and closing mark. Any other role stands in its opening mark.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>")}
OTHER = ("<<TURN ", ">>", "<</TURN>>")
TRAINED = "assistant"
# Escapes, in the order that undoes them; the escape character itself comes last.
ESCAPES = {"<": r"\l", ">": r"\g", "[": r"\b", "\\": r"\e"}

_CLOSE = r"<</SYS>>|\[/INST\]|</s>|<</TURN>>"
_CONFLICT = rf"{_CLOSE}|<s>|<<SYS>>|\[INST\]|<<TURN |\\[lgbe]"


def escape(text: Column) -> Column:
    for char, code in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for char, code in ESCAPES.items():
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def _render(turns: Column) -> Column:
    """The text of an array of role and text."""

    def turn(t: Column) -> Column:
        role, text = t["role"], t["text"]
        out = F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), text, F.lit(OTHER[2]))
        for name, (before, after) in MARKS.items():
            out = F.when(role == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
        return out

    return F.concat(F.lit(START), F.array_join(F.transform(turns, turn), ""))


def _pieces(formatted: Column) -> Column:
    """The turns of a text with their marks: each ends behind a closing mark."""
    body = F.substr(formatted, F.lit(len(START) + 1))
    return F.filter(F.split(body, rf"(?<={_CLOSE})"), lambda p: p != "")


def _opening(piece: Column) -> Column:
    """The length of a piece's opening mark."""
    out = F.lit(0)
    for before, after in MARKS.values():
        out = F.when(F.endswith(piece, F.lit(after)), F.lit(len(before))).otherwise(out)
    other = F.instr(piece, OTHER[1]) + len(OTHER[1]) - 1
    return F.when(F.endswith(piece, F.lit(OTHER[2])), other).otherwise(out)


def _closing(piece: Column) -> Column:
    out = F.lit(len(OTHER[2]))
    for _, after in MARKS.values():
        out = F.when(F.endswith(piece, F.lit(after)), F.lit(len(after))).otherwise(out)
    return out


def _role(piece: Column) -> Column:
    out = F.substr(piece, F.lit(len(OTHER[0]) + 1), F.instr(piece, OTHER[1]) - 1 - len(OTHER[0]))
    for name, (_, after) in MARKS.items():
        out = F.when(F.endswith(piece, F.lit(after)), F.lit(name)).otherwise(out)
    return out


def _body(piece: Column) -> Column:
    opening = _opening(piece)
    return F.substr(piece, opening + 1, F.length(piece) - opening - _closing(piece))


def parse(formatted: Column) -> Column:
    """The turns that a formatted text holds, as an array of role and text."""
    return F.transform(
        _pieces(formatted), lambda p: F.struct(unescape(_role(p)).alias("role"), unescape(_body(p)).alias("text"))
    )


def loss_spans(formatted: Column) -> Column:
    """Start and end, in code points, of each stretch of the formatted text that the loss covers."""
    zero = F.struct(F.lit(len(START)).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        span = F.struct((acc["at"] + _opening(p)).alias("start"), (acc["at"] + F.length(p) - _closing(p)).alias("end"))
        spans = F.when(_role(p) == TRAINED, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + F.length(p)).alias("at"), spans.alias("spans"))

    return F.aggregate(_pieces(formatted), zero, step)["spans"]


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans``, one row per conversation.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``. A null text or role is empty. Turns
    stand by number, a null one first; rows of one number by role and text, each as often as
    it comes. Rows without an id are one conversation. Other columns are ignored. No rows: no rows.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("sorted"))
    whole = whole.withColumn("source", F.transform("sorted", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    safe = lambda c: F.when(c.rlike(_CONFLICT), escape(c)).otherwise(c)
    versions = {
        "as_is": F.col("source"),
        "some": F.transform("source", lambda t: F.struct(_known(t["role"], safe).alias("role"), safe(t["text"]).alias("text"))),
        "all": F.transform("source", lambda t: F.struct(_known(t["role"], escape).alias("role"), escape(t["text"]).alias("text"))),
    }
    out = _render(versions["all"])
    for name in ("some", "as_is"):
        text = _render(versions[name])
        out = F.when(parse(text) == F.col("source"), text).otherwise(out)
    formatted = whole.select("conv_id", out.alias("formatted"))
    return formatted.withColumn("loss_spans", loss_spans(F.col("formatted")))


def _known(role: Column, change) -> Column:
    """A role of its own marks as it is, any other changed."""
    return F.when(role.isin(*MARKS), role).otherwise(change(role))
