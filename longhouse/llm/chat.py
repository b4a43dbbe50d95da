"""Conversations as training text, with a grammar that reads them back exactly."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings of this template and of others that tokenizers act on. Each starts
#: with < or [ and holds neither again, nor a backslash; the escape relies on that.
CONTROLS = [
    TURN,
    TEXT,
    END,
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
]
ROLES_UNDER_LOSS = ["assistant"]

_STARTS = "|".join(re.escape(c[0]) + "(?=" + re.escape(c[1:]) + ")" for c in CONTROLS)
ESCAPED = rf"(\\|{_STARTS})"


def escape(text: F.Column) -> F.Column:
    """Break every control string with a backslash after its first character; double backslashes."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({_STARTS})", r"$1\\")


def unescape(text: F.Column) -> F.Column:
    """Drop each backslash that stands before a character, which is kept."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: F.Column, text: F.Column) -> F.Column:
    return F.concat(F.lit(TURN), role, F.lit(TEXT), text, F.lit(END))


def parse(formatted: F.Column) -> F.Column:
    """The turns of a formatted text as array<struct<role, text>>, by its grammar alone.

    turns := (TURN role TEXT text END)*, where role and text hold no control string. What does not
    follow the grammar gives a turn of nulls.
    """
    pieces = F.split(formatted, re.escape(END), -1)
    closed = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    rest = F.element_at(pieces, -1)

    def turn(piece: F.Column) -> F.Column:
        body = F.split(F.substring(piece, F.lit(len(TURN) + 1), F.length(piece)), re.escape(TEXT), -1)
        clean = piece.startswith(TURN) & (F.size(body) == 2) & ~F.get(body, F.lit(1)).contains(TURN)
        return F.struct(
            F.when(clean, unescape(F.get(body, F.lit(0)))).alias("role"),
            F.when(clean, unescape(F.get(body, F.lit(1)))).alias("text"),
        )

    nothing = F.struct(F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    turns = F.transform(closed, turn)
    return F.when(rest == "", turns).otherwise(F.concat(turns, F.array(nothing)))


def _same(rendered: F.Column, role: F.Column, text: F.Column) -> F.Column:
    back = parse(rendered)
    first = F.get(back, F.lit(0))
    same = (F.size(back) == 1) & first["role"].eqNullSafe(role) & first["text"].eqNullSafe(text)
    return same


def holds_control(text: F.Column) -> F.Column:
    return text.rlike(_STARTS)


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with the column ``rendered``.

    Each turn is rendered as it is and parsed again; where the parser does not recover role and
    text, or a control string would stand in them, both are escaped. The escape is exact for any
    text, so the second round always ends with identical content.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.withColumn("__role", role).withColumn("__text", text)
    rows = rows.withColumn("rendered", render(F.col("__role"), F.col("__text")))
    plain = (
        ~holds_control(F.col("__role"))
        & ~holds_control(F.col("__text"))
        & _same(F.col("rendered"), F.col("__role"), F.col("__text"))
    )
    escaped = render(escape(F.col("__role")), escape(F.col("__text")))
    rows = rows.withColumn("escaped", ~plain)
    return rows.withColumn("rendered", F.when(F.col("escaped"), escaped).otherwise(F.col("rendered")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, and ``identical``, whether it reads back as given.

    Turns stand in the order of turn, then role, then text; a null turn comes first. Null roles and
    texts are empty. Rows that repeat are turns that repeat. A null conv_id is a conversation of its
    own. No rows give no rows. Further input columns are left out. A conversation is one text and so
    one value; its rows are gathered in one aggregate.
    """
    rows = format_turns(turns.select("conv_id", "turn", "role", "text"))
    whole = rows.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"), "__role", "__text", "rendered"))
        ).alias("__turns")
    )
    whole = whole.withColumn("formatted", F.array_join(F.transform("__turns", lambda t: t["rendered"]), ""))
    source = F.transform("__turns", lambda t: F.struct(t["__role"].alias("role"), t["__text"].alias("text")))
    return whole.select("conv_id", "formatted", (parse(F.col("formatted")) == source).alias("identical"))


def read_back(formatted: DataFrame, roles: list[str] = ROLES_UNDER_LOSS) -> DataFrame:
    """What the formatted texts say: turns, and the text under the loss mask, which is that of ``roles``."""
    rows = formatted.withColumn("turns", parse(F.col("formatted")))
    loss = F.filter("turns", lambda t: t["role"].isin(roles))
    return rows.withColumn("loss_text", F.array_join(F.transform(loss, lambda t: t["text"]), ""))


def digest(read: DataFrame) -> DataFrame:
    """Counts and digests of ``read_back``: the whole of the turns and the text under the loss mask."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )
