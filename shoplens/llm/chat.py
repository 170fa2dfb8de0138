"""Conversations as training text, with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one
role make a block, whose texts are aggregated with a joint between them; the blocks are
concatenated.  The template:

    <s>  <<SYS>>text<</SYS>>  [INST]text[/INST]  <a>text</s>  <role NAME>text</role>

for system, user, assistant and any other role, without blanks; ``<+>`` joins merged
turns.  In texts and role names ``&``, ``<``, ``>`` and ``[`` are escaped, so no text
can hold a marker and every text can be read back.  ``loss_spans`` are the code points
(start, end exclusive) of each assistant text in the formatted conversation.

A conversation is one string and so one row: its turns meet in one task by nature.

Defined results: a null text or role is empty; turns with equal numbers go by role,
then text, null numbers first; rows without a conversation id form one conversation;
repeated rows are turns of their own; no rows give no conversations; texts of any length
are taken whole; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN = "CASE r WHEN 'system' THEN '<<SYS>>' WHEN 'user' THEN '[INST]' WHEN 'assistant' THEN '<a>' ELSE concat('<role ', {e}, '>') END"
_CLOSE = "CASE r WHEN 'system' THEN '<</SYS>>' WHEN 'user' THEN '[/INST]' WHEN 'assistant' THEN '</s>' ELSE '</role>' END"
BEGIN, JOINT = "<s>", "<+>"
# Escapes, in the order in which they are put in.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lb;")]


def escape(text: str) -> str:
    """SQL for a text that holds no control character."""
    for plain, coded in ESCAPES:
        text = f"replace({text}, '{plain}', '{coded}')"
    return text


def unescape(text: str) -> str:
    for plain, coded in reversed(ESCAPES):
        text = f"replace({text}, '{coded}', '{plain}')"
    return text


def _case(template: str, role: str) -> str:
    return template.replace("CASE r", f"CASE {role}").replace("{e}", escape(role))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans, n_blocks."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    collected = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # where a block begins, and one past the last turn
    begins = ("concat(filter(sequence(0, size(turns) - 1), "
              "i -> i = 0 OR turns[i].role <> turns[i - 1].role), array(size(turns)))")
    bounded = collected.withColumn("begins", F.expr(begins))
    block = ("transform(sequence(0, size(begins) - 2), j -> named_struct("
             f"'role', turns[begins[j]].role, 'open', {_case(_OPEN, 'turns[begins[j]].role')}, "
             f"'close', {_case(_CLOSE, 'turns[begins[j]].role')}, "
             "'texts', transform(slice(turns, begins[j] + 1, begins[j + 1] - begins[j]), t -> " + escape("t.text") + ")))")
    blocks = bounded.select("conv_id", F.expr(block).alias("blocks"))
    formatted = (f"concat('{BEGIN}', array_join(transform(blocks, "
                 f"b -> concat(b.open, array_join(b.texts, '{JOINT}'), b.close)), ''))")
    nothing = "cast(array() as array<struct<start: bigint, end: bigint>>)"
    inner = ("aggregate(b.texts, named_struct('at', acc.at + length(b.open), 'spans', acc.spans), (in, t) -> named_struct("
             f"'at', in.at + length(t) + {len(JOINT)}, 'spans', if(b.role = 'assistant', concat(in.spans, array("
             "named_struct('start', in.at, 'end', in.at + length(t)))), in.spans)))")
    spans = (f"aggregate(blocks, named_struct('at', {len(BEGIN)}L, 'spans', {nothing}), (acc, b) -> "
             f"transform(array({inner}), x -> named_struct('at', x.at - {len(JOINT)} + length(b.close), 'spans', x.spans))[0], "
             "acc -> acc.spans)")
    return blocks.select("conv_id", F.expr(formatted).alias("formatted"), F.expr(spans).alias("loss_spans"),
                         F.size("blocks").cast("long").alias("n_blocks"))


def read_turns() -> Column:
    """The turns (role, text) that a ``formatted`` column was made of."""
    opens = r"<<SYS>>|\\[INST\\]|<a>|<role [^>]*>"
    closes = r"<</SYS>>|\\[/INST\\]|</s>|</role>"
    role = ("CASE WHEN startswith(b, '<<SYS>>') THEN 'system' WHEN startswith(b, '[INST]') THEN 'user' "
            "WHEN startswith(b, '<a>') THEN 'assistant' ELSE " + unescape("regexp_extract(b, '^<role ([^>]*)>', 1)") + " END")
    texts = f"split(regexp_replace(b, '^(?:{opens})|(?:{closes})\\\\z', ''), '<\\\\+>', -1)"
    blocks = f"split(substring(formatted, {len(BEGIN) + 1}), '(?={opens})', -1)"
    return F.expr(f"flatten(transform({blocks}, b -> transform({texts}, "
                  f"t -> named_struct('role', {role}, 'text', {unescape('t')}))))")


def masked_text() -> Column:
    """The text under the loss mask, unescaped, nothing between."""
    part = unescape("substring(formatted, cast(s.start + 1 as int), cast(s.end - s.start as int))")
    return F.expr(f"array_join(transform(loss_spans, s -> {part}), '')")


def report(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations, and from one more that quotes the template."""
    quote = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = format_chats(turns.select("conv_id", "turn", "role", "text").unionByName(quote))
    back = chats.select("*", read_turns().alias("turns"), masked_text().alias("masked"))
    spoken = F.expr("array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_blocks")
