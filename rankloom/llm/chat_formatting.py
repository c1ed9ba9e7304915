"""Relational chat formatting.

Turns are collected and sorted as structs, adjacent turns of one role are merged into a block by an array
aggregation, and blocks are concatenated, all with Spark expressions. A conversation becomes

    ### Role: first text</cont>second text of the same role</turn>

Controls are made of the characters ``#`` and ``<``, which escaped texts never hold: ``\\`` is written ``\\\\``,
``<`` as ``\\l`` and ``#`` as ``\\h``. So the output can be read back without loss.

Defined cases: null text is empty, null role is the empty role, a null turn sorts first. Rows that share
(conv_id, turn) keep all their copies, ordered by role and text. Rows with a null conv_id form one conversation.
An empty table gives no rows. Columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import pick

OPEN, SEP, CONT, END = "### ", ": ", "</cont>", "</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def unescape(c: Column) -> Column:
    """Pairs of backslashes are cut out first, left to right, so no other escape can begin inside one."""
    part = lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


def _role(c: Column) -> Column:
    """Roles are escaped as texts are; a colon in one is written \\c, so the first ': ' ends a role."""
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def _unrole(c: Column) -> Column:
    part = lambda p: F.replace(F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#")), F.lit("\\c"), F.lit(":"))
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


_BLOCKS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("texts", T.ArrayType(T.StringType()))]))


def merge_adjacent(turns: Column) -> Column:
    """array<struct<role,text>> in order -> array<struct<role,texts>>, one element for each run of one role.

    Run starts are found by comparing neighbours and each run is cut out with slice, so the work is linear in the
    turns rather than the copying of a growing array at each step.
    """
    n = F.size(turns)
    index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(index, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(n))
    run = lambda a, b: F.struct(
        F.get(turns, a)["role"].alias("role"),
        F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts"),
    )
    return F.zip_with(starts, F.slice(ends, 1, F.greatest(F.size(starts), F.lit(1))), run)


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, blocks, formatted, loss_spans (array of start and end, code points, one for
    each text of loss_role, in the formatted string; a span holds that text as escaped)."""
    turns = pick(conversations, "conv_id", "turn", "role", "text").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Where a text will stand is a running sum over the rows of a conversation, in the order in which they are collected;
    # within the collected array it would take a copy of the array for every turn.
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    same = lambda c: F.coalesce(c == F.col("role"), F.lit(False))
    lead = F.when(same(F.lag("role").over(order)), len(CONT)).otherwise(F.length(_role(F.col("role"))) + len(OPEN) + len(SEP))
    tail = F.when(same(F.lead("role").over(order)), 0).otherwise(len(END))
    sized = turns.withColumn("lead", lead).withColumn("own", F.length(escape(F.col("text")))).withColumn("tail", tail)
    upto = F.sum((F.col("lead") + F.col("own") + F.col("tail")).cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0))
    placed = sized.withColumn("end", upto - F.col("tail"))
    turn = F.struct("turn", "role", "text", (F.col("end") - F.col("own")).alias("start"), "end")
    sorted_turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    blocks = sorted_turns.select("conv_id", merge_adjacent(F.col("turns")).alias("blocks"), spans.alias("loss_spans"))

    def rendered(b: Column) -> Column:
        return F.concat(F.lit(OPEN), _role(b["role"]), F.lit(SEP), F.array_join(F.transform(b["texts"], escape), CONT), F.lit(END))

    return blocks.select("conv_id", "blocks", F.array_join(F.transform("blocks", rendered), "").alias("formatted"), "loss_spans")


def read_back(formatted: Column | str) -> Column:
    """formatted -> array<struct<role,text>>, a struct for each original turn."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")

    def turns(b: Column) -> Column:
        role = _unrole(F.substring_index(F.substring(b, len(OPEN) + 1, 2147483647), SEP, 1))
        body = F.substring(b, F.instr(b, SEP) + len(SEP), F.lit(2147483647))
        return F.transform(F.split(body, CONT, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


#: A substring is found by counting characters from the beginning, so long strings are cut into parts of this size first.
PART = 4096


def cut_out(text: Column, spans: Column) -> Column:
    """The texts of spans (start and end in code points), at a cost of their lengths and a part or two for each."""

    def of(parts: Column) -> Column:
        def one(s: Column) -> Column:
            first, last = F.floor(s["start"] / PART), F.floor(s["end"] / PART)
            near = F.array_join(F.slice(parts, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
            return F.substring(near, (s["start"] - first * PART + 1).cast("int"), (s["end"] - s["start"]).cast("int"))

        return F.transform(spans, one)

    # The outer lambda binds the parts, which would be cut anew for every span otherwise.
    return F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(r"(?s)(.{1,%d})" % PART), F.lit(1))), of), F.lit(0))


def digest(out: DataFrame) -> DataFrame:
    """What the formatted strings say when they are read again."""
    masked = F.array_join(F.transform(cut_out(F.col("formatted"), F.col("loss_spans")), unescape), "")
    seen = out.select("conv_id", read_back(F.col("formatted")).alias("turns"), masked.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return seen.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: Conversation -7, whose texts hold control strings of common templates.
HOSTILE = "\\### Assistant: </turn> ok"


def op10_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = pick(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE).alias("text")
    )
    return digest(format_conversations(rows.unionByName(extra)))


OP10_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', '')) AS n,
         coalesce(lag(role) OVER w <> role, true) AS starts
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n + CASE WHEN starts THEN 14 + length(role) ELSE 7 END)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
