"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log has rows (conv, seq, turn, kind, role, text). Kinds: `open` starts a message and names its role; `delta` appends to it; `edit` puts
its text in place of all before; `regenerate` empties it, for the deltas of a new answer; `drop` removes the message. Anything else, and a
null kind, is passed over. The log is partitioned by conversation and message and sorted by seq (ties: by kind, then text); each
message is folded, and the messages of a conversation are rendered in the order of their turns.

A message that no `open` names has role "". Null text: empty. Null turn: first. Null conversation: one conversation of its own. A
conversation whose messages are all dropped gives no row.

Rendering: `<|role|>` and a line feed, the text, `<|end|>` and a line feed. In roles and texts, `\\` becomes `\\b`, `<` becomes
`\\l` and `[` becomes `\\k` (and in roles `|` becomes `\\p`), so no control string of this template or of the other common ones can come from a text, and the change can be
undone. The loss mask lists for each assistant turn the code points, from the start of the turn's rendering, that a model is to learn.

A message is folded in a group of its own, and a conversation meets only when it is rendered: its one string needs all of its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

END = "<|end|>\n"
KINDS = ("open", "delta", "edit", "regenerate", "drop")


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\k"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("|"), F.lit("\\p"))


def unescape(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\k"), F.lit("["))
    return F.replace(F.replace(c, F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def fold(log: DataFrame) -> DataFrame:
    """The final messages: conv, turn, role, text."""
    known = log.where(F.col("kind").isin(*KINDS))
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    events = known.groupBy("conv", "turn").agg(F.array_sort(F.collect_list(event)).alias("events"))
    of = lambda *kinds: (lambda e: e["kind"].isin(*kinds))
    reset = F.array_max(F.transform(F.col("events"), lambda e, i: F.when(of("edit", "regenerate")(e), i).otherwise(F.lit(-1))))
    kept = events.select("*", reset.alias("reset")).where(~F.exists("events", of("drop")))
    text = F.array_join(F.transform(F.filter("events", lambda e, i: of("delta", "edit")(e) & (i >= F.col("reset"))), lambda e: e["text"]), "")
    role = F.coalesce(F.try_element_at(F.filter("events", of("open")), F.lit(1))["role"], F.lit(""))
    return kept.select("conv", "turn", role.alias("role"), text.alias("text"))


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row a conversation: conv, formatted, loss_mask array<struct<turn, start, end>> (turn from 0; code points; end exclusive)."""
    role = escape_role(F.coalesce("role", F.lit("")))
    body = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit("<|"), role, F.lit("|>\n"))
    part = F.struct("turn", head.alias("head"), body.alias("body"), (F.col("role") == learn).alias("learn"))
    turns = messages.groupBy("conv").agg(F.array_sort(F.collect_list(part)).alias("turns"))
    mask = F.filter(F.transform("turns", lambda t, i: F.when(F.coalesce(t["learn"], F.lit(False)), F.struct(i.alias("turn"), F.length(t["head"]).alias("start"), (F.length(t["head"]) + F.length(t["body"])).alias("end")))), lambda x: x.isNotNull())
    return turns.select("conv", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation, array<struct<role, text>>."""
    parts = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda p: p != "")
    head = lambda p: F.instr(p, "|>\n")
    return F.transform(parts, lambda p: F.struct(unescape(F.substring(p, F.lit(3), head(p) - 3)).alias("role"), unescape(F.substring(p, head(p) + 3, F.length(p))).alias("text")))


def learned(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped. A turn is looked up by its number, so the work is in proportion to the text."""
    parts = F.split(formatted, r"(?<=<\|end\|>\n)", -1)
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(F.get(parts, m["turn"]), m["start"] + 1, m["end"] - m["start"]))), "")


def log_of(rows: DataFrame) -> DataFrame:
    """The log that a finished table (conv_id, turn, role, text) comes from: every row is a message, opened and then streamed in two deltas. An answer of `assistant` is first streamed in
    part, then regenerated; any other message is first sent as a draft, then edited; and a conversation begins with a message that is dropped. Rows of equal conv_id
    and turn are messages of their own, by role and text. Other columns are passed over."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    of = lambda turn, seq, kind, t: F.struct(turn.alias("turn"), F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), t.alias("text"))
    first, second, draft = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text)), F.substring(text, 1, 8)
    n, none = F.col("n"), F.lit("")
    plain = F.array(of(n, 0, "open", none), of(n, 1, "delta", draft), of(n, 2, "edit", first), of(n, 3, "delta", second))
    again = F.array(of(n, 0, "open", none), of(n, 1, "delta", draft), of(n, 2, "regenerate", none), of(n, 3, "delta", first), of(n, 4, "delta", second))
    begun = F.array(of(F.lit(0), 0, "open", none), of(F.lit(0), 1, "delta", draft), of(F.lit(0), 2, "drop", none))
    numbered = rows.select("conv_id", "turn", "role", "text").withColumn("n", number)  # before the explode, which would number events
    own = F.when(F.col("role") == "assistant", again).otherwise(plain)
    events = numbered.select("conv_id", "role", F.explode(F.when(n == 1, F.concat(begun, own)).otherwise(own)).alias("e"))
    return events.select(F.col("conv_id").alias("conv"), F.col("e.seq").alias("seq"), F.col("e.turn").alias("turn"), F.col("e.kind").alias("kind"), "role", F.col("e.text").alias("text"))
