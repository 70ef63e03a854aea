"""Chat formatting from an event log (DataFrame functions only).

Log events are (conv_id, seq, msg, kind, role, text). ``start`` opens message ``msg`` with
a role, ``delta`` appends text, ``edit`` replaces the text, ``regenerate`` empties the
message and drops every later message that was opened before it. Events are grouped by
message first, so a long conversation spreads over tasks, folded in ``seq`` order, and only
finished messages meet by conversation to be rendered.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docnorm.llm.common import table

START, END = "<|im_start|>", "<|im_end|>"
RESETS = ("start", "edit", "regenerate")


def escape(text: Column) -> Column:
    r"""Break every control string: ``\`` doubles, then ``<`` and ``[`` get a ``\`` behind them.

    All control strings of common templates open with one of the two. ``unescape`` undoes it.
    """
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    opened = F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role ends at the line break, so its own line breaks become ``[n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("[n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("[n"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, msg, role, text) of an event log.

    Nulls: a null text adds nothing, a null role is empty, events of a null conv_id form one
    conversation. Events with one ``seq`` are folded by kind, then text; equal events count
    as often as they come. A message without ``start`` has an empty role. An empty log gives
    no messages.
    """
    one = F.struct("seq", "kind", "role", "text")
    by_message = events.groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list(one)).alias("log"))
    reset = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin(*RESETS), i).otherwise(-1)))
    state = by_message.select(
        "conv_id", "msg", "log", F.greatest(reset, F.lit(0)).alias("from"),
        F.array_max(F.transform("log", lambda e: F.when(e["kind"].isin(*RESETS), e["seq"]))).alias("since"),
        F.array_max(F.transform("log", lambda e: F.when(e["kind"] == "regenerate", e["seq"]))).alias("redone"))
    live = F.slice("log", F.col("from") + 1, F.size("log"))
    roles = F.filter(F.transform("log", lambda e: F.when(e["kind"] == "start", e["role"])), lambda r: r.isNotNull())
    earlier = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    return (state.withColumn("cut", F.max("redone").over(earlier))
            .where(F.col("cut").isNull() | (F.coalesce("since", F.col("cut")) >= F.col("cut")))
            .select("conv_id", "msg", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                    F.array_join(F.transform(live, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text")))


def render(messages: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``segments`` (piece of text, loss flag) and ``formatted``.

    The concatenated pieces are the formatted text; a piece is under the loss mask when it
    is the escaped text of a trained role, marks never are.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    parts = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(F.col("text")).alias("text"), F.col("role").isin(*trained).alias("loss")),
        F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))
    gathered = (messages.select("conv_id", "msg", parts.alias("parts")).groupBy("conv_id")
                .agg(F.sort_array(F.collect_list(F.struct("msg", "parts"))).alias("turns")))
    segments = F.flatten(F.transform("turns", lambda t: t["parts"]))
    return (gathered.select("conv_id", segments.alias("segments"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def parse(formatted: Column) -> Column:
    """(role, text) of each turn, read back from a formatted text."""
    turns = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)
    return F.transform(turns, lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substring_index(F.substr(t, F.instr(t, "\n") + 1), END, 1)).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")


def as_events(conversations: DataFrame) -> DataFrame:
    """The event log of finished conversations (conv_id, turn, role, text): every row opens a
    message and streams its text in two deltas. Rows are taken by turn, then role and text;
    rows that share a turn are messages of their own, null turns come first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"),
                                F.row_number().over(order).cast("long").alias("msg"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    none = F.lit(None).cast("string")
    log = F.array(
        F.struct(F.lit("start").alias("kind"), F.col("role").alias("role"), none.alias("text")),
        F.struct(F.lit("delta").alias("kind"), none.alias("role"), F.left("text", half).alias("text")),
        F.struct(F.lit("delta").alias("kind"), none.alias("role"), F.substr("text", half + 1).alias("text")))
    return (rows.select("conv_id", "msg", F.posexplode(log).alias("nth", "event"))
            .select("conv_id", (F.col("msg") * 3 + F.col("nth")).alias("seq"), "msg", "event.kind", "event.role", "event.text"))


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = render(fold_events(as_events(rows)))
    read = out.select("conv_id", parse(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("int").alias("n_turns"), F.sha2(said_all, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role AS raw, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, length(replace(replace(replace(text, '\', '\\'), '<', '<\'), '[', '[\')) AS text_chars,
             length(replace(replace(replace(replace(role, '\', '\\'), '<', '<\'), '[', '[\'), chr(10), '[n')) AS role_chars FROM c),
g AS (SELECT conv_id, count(*)::INTEGER AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, raw NULLS FIRST, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, raw NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum(12 + role_chars + 1 + text_chars + 11)::BIGINT AS formatted_chars
      FROM n GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""
