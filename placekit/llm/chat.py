"""Chat formatting by relational expressions only.

The turns of a conversation are collected as structs and sorted, neighbours
of one role become one block by an array aggregation, and the blocks are
concatenated to a text::

    <role>user<text>first turn<next>second turn<end>
    <role>assistant<text>answer<end>

Marks begin with ``<``.  In roles and texts ``\\`` is written ``\\s`` and ``<``
is written ``\\l``, so no text holds a mark, whatever it says, and cutting at
the marks and undoing the two replacements gives the turns back exactly.
Merged turns keep a mark between them, so merging loses nothing.

The loss mask of a formatted text is the list of its assistant turns, as
(start, end) in code points; it covers the escaped text of each such turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks.
ROLE, TEXT, NEXT, END = "<role>", "<text>", "<next>", "<end>\n"
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """From rows ``(conv_id, turn, role, text)``: one row ``(conv_id,
    formatted, mask)`` for each conversation; ``mask`` is the array of
    ``(start, end)`` of its assistant turns.

    Turns are sorted by ``turn``, then role, then text; a null turn comes
    first, and rows that repeat a turn are turns of their own.  A null text or
    role is an empty one.  Rows without ``conv_id`` are one conversation, as
    grouping has it.  Empty turns stay.  An empty table gives no rows; other
    columns are ignored.  A conversation is one text, so its turns meet in one
    task however many they are.
    """
    rows = turns.select(
        "conv_id", F.struct(F.col("turn").cast("bigint").alias("turn"),
                            F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    said = F.transform("ts", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    conv = conv.select("conv_id", said.alias("ts"))
    # what stands before each turn: a new block, or the mark between turns of one role
    begins = lambda t, i: (i == 0) | (F.get("ts", i - 1)["role"] != t["role"])
    lead = F.transform("ts", lambda t, i: F.when(
        begins(t, i), F.concat(F.when(i == 0, "").otherwise(END), F.lit(ROLE), t["role"], F.lit(TEXT)))
        .otherwise(F.lit(NEXT)))
    conv = conv.withColumn("lead", lead)
    # where each turn's text starts and ends: running sums over the array
    spans = F.aggregate(
        F.arrays_zip("ts", "lead"),
        F.struct(F.lit(0).cast("bigint").alias("at"),
                 F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["lead"]) + F.length(x["ts"]["text"])).cast("bigint").alias("at"),
            F.when(x["ts"]["role"] == ASSISTANT, F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.length(x["lead"])).cast("bigint").alias("start"),
                (a["at"] + F.length(x["lead"]) + F.length(x["ts"]["text"])).cast("bigint").alias("end")))))
            .otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    text = F.concat(F.array_join(F.transform(F.arrays_zip("ts", "lead"),
                                             lambda x: F.concat(x["lead"], x["ts"]["text"])), ""), F.lit(END))
    return conv.select("conv_id", text.alias("formatted"), spans.alias("mask"))


def read_conversations(formatted: DataFrame) -> DataFrame:
    """From ``(conv_id, formatted, mask)``, by reading the formatted text:
    ``turns`` (array of role and text, as they were) and ``loss`` (the
    unescaped text under each span of the mask, in order)."""
    blocks = F.filter(F.split("formatted", ROLE), lambda b: b != "")
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(F.substring_index(b, TEXT, -1), END, 1), NEXT),
        lambda t: F.struct(unescape(F.substring_index(b, TEXT, 1)).alias("role"), unescape(t).alias("text")))))
    loss = F.transform("mask", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv_id", "formatted", "mask", turns.alias("turns"), loss.alias("loss"))


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
                                 F.lit(hard).alias("text"))
    back = read_conversations(format_conversations(rows.unionByName(more)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


OP3_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(replace(text, '\', ''), '<', '')) AS text_size,
    CASE WHEN before = role THEN 6
         ELSE 12 + CASE WHEN k > 1 THEN 6 ELSE 0 END
              + length(role) + length(role) - length(replace(replace(role, '\', ''), '<', '')) END AS lead_size
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(text_size + lead_size) + 6)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
