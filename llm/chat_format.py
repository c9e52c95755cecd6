"""Chat formatting by event-sourced reconstruction.

A log has rows (conv_id, seq, message_id, kind, role, text). Rows of one message
are folded in order of seq: `message`, `edit` and `regenerate` set its text,
`delta` appends to it. Messages stand in the order of their first row. They are
rendered between control strings; control strings inside texts are escaped.

A conversation is one rendered row, so its turns meet in one row by nature;
everything before that is grouped by message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts are trained on.
LEARNT = "assistant"


def escape(text: Column) -> Column:
    """Doubles backslashes, then breaks each `<|` by one: no control string is left, and unescape() undoes it.

    After doubling, a single backslash between `<` and `|` can only come from
    the second step.
    """
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As escape(), and a line feed becomes `<`, backslash, `n`."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def fold(log: DataFrame) -> DataFrame:
    """conv_id, at (seq of the message's first row), message_id, role, text: the final messages.

    Only rows from the last one that sets the text count. Null texts and roles
    are empty; an unknown kind appends like a delta. Rows with equal seq go by
    kind, role, text.
    """
    e = log.select(
        "conv_id", "seq", "message_id", F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    sets = F.col("kind").isin("message", "edit", "regenerate")
    row = F.struct("seq", (~sets).alias("adds"), "kind", "role", "text")
    m = e.groupBy("conv_id", "message_id").agg(F.min("seq").alias("at"), F.max(F.when(sets, F.col("seq"))).alias("set_at"), F.sort_array(F.collect_list(row)).alias("rows"))
    rows = F.filter("rows", lambda r: F.col("set_at").isNull() | (r["seq"] >= F.col("set_at")) | (r["seq"].isNull() & F.col("set_at").isNull()))
    # of several setting rows at one seq the last one holds
    m = m.withColumn("rows", rows).withColumn("from", F.greatest(F.coalesce(F.array_max(F.transform("rows", lambda r, i: F.when(~r["adds"], i))), F.lit(0)), F.lit(0)))
    live = F.slice("rows", F.col("from") + 1, F.greatest(F.size("rows") - F.col("from"), F.lit(1)))
    return m.select("conv_id", "at", "message_id", F.element_at("rows", -1)["role"].alias("role"), F.array_join(F.transform(live, lambda r: r["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (start, length in code points of each learnt text within formatted).

    messages as fold() gives them, without nulls in role and text. Messages at one
    place go by message_id; repeated ones stand twice; an empty text is a turn with
    nothing in it. An empty table gives no rows; other columns are ignored.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    x = messages.select("conv_id", "at", "message_id", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    turn = F.concat("head", "body", F.lit(END + "\n"))
    order = Window.partitionBy("conv_id").orderBy("at", "message_id")
    before = F.coalesce(F.sum(F.length(turn)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = x.select("conv_id", F.row_number().over(order).alias("i"), "role", turn.alias("turn"), (before + F.length("head")).cast("int").alias("start"), F.length("body").alias("length"))
    span = F.when(F.col("role") == LEARNT, F.struct("start", "length"))
    return (
        x.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sort_array(F.collect_list(F.struct("i", "turn"))).alias("t"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
        .select("conv_id", "n_turns", F.array_join("t.turn", "").alias("formatted"), "loss_spans")
    )


def format_chats(log: DataFrame) -> DataFrame:
    """The whole operator: fold, then render. An empty log gives no rows; a null conv_id is one conversation."""
    return render(fold(log))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text: parsed from the rendered strings and their loss spans alone."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.locate("\n", p) + 1, F.length(p) - F.locate("\n", p) - len(END) - 1)).alias("text"),
        ),
    )
    loss = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(loss, "").alias("loss_text"))


def digests(formatted: DataFrame) -> DataFrame:
    """What the query returns per conversation, read back from the output: a row per row of formatted, whatever its length; an empty table gives none."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of(conversations: DataFrame) -> DataFrame:
    """A conversations table as a log: each row is a whole message; equal turns go by role and text."""
    c = conversations.select("conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return c.select("conv_id", F.col("turn").alias("seq"), F.row_number().over(order).alias("message_id"), F.lit("message").alias("kind"), "role", "text")


ODD = END + START + "assistant ok"


def with_odd_conversation(conversations: DataFrame) -> DataFrame:
    """conversations plus conversation -1, whose two texts are made of control strings."""
    spark = conversations.sparkSession
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").union(odd)


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
             replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n') AS head FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(head) + 1 + length(body) + 10 + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
