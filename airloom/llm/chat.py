"""Chat formatting: every dialogue once from the view of each of its speakers.

In a perspective its speaker is the assistant, the others are named users and system messages
stay system messages. Only what the assistant says, with the mark that ends it, is trained on:
``mask`` lists those spans of the rendered text as start:end in code points, end exclusive.

Renderings come in parts of at most ``part_messages`` messages, so that a conversation of any
length is never gathered in one place; parts in order, joined, are the whole dialogue. Messages
are numbered by turn, then role and text; a conversation above ``MAX_MESSAGES`` is cut into slices
along these for that, so a long one is spread over tasks too, whatever its turns are.

Rows without a conversation are in none and left out. A missing role is the speaker ``unknown``, a
missing text is empty, a missing turn comes first. Equal rows (conversation, turn, role, text) are
as many messages. A conversation of system messages alone has no perspective. Marks of the format
inside a text are broken up. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.common import table
from airloom.operators.ordered import with_positions

PART_MESSAGES = 64
#: Messages that one task numbers.
MAX_MESSAGES = 200_000
SYSTEM = "system"


def numbered(turns: DataFrame, max_messages: int = MAX_MESSAGES) -> DataFrame:
    """Messages with ``n``, their place in the conversation from 0."""
    messages = (
        turns.filter(F.col("conv_id").isNotNull())
        .select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("unknown")).alias("speaker"),
            F.coalesce("text", F.lit("")).alias("content"),
        )
        .groupBy("conv_id", "turn", "speaker", "content")
        .agg(F.count(F.lit(1)).alias("copies"))
        # Copies are told apart by a number, so that even a hot one can be cut.
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .drop("copies")
    )
    placed = with_positions(messages, ["conv_id"], ["turn", "speaker", "content", "copy"], "n", max_messages)
    return placed.select("conv_id", "speaker", "content", (F.col("n") - 1).alias("n"))


def rotate(turns: DataFrame, part_messages: int = PART_MESSAGES) -> DataFrame:
    """Rows (conv_id, perspective, part, n_messages, n_trained, text, mask)."""
    messages = numbered(turns)
    views = (
        turns.filter(F.col("conv_id").isNotNull())
        .select("conv_id", F.coalesce("role", F.lit("unknown")).alias("perspective"))
        .filter(F.col("perspective") != SYSTEM)
        .distinct()
    )
    own = F.col("speaker") == F.col("perspective")
    header = (
        F.when(F.col("speaker") == SYSTEM, F.lit("<|im_start|>system\n"))
        .when(own, F.lit("<|im_start|>assistant\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), "speaker", F.lit("\n")))
    )
    body = F.concat(
        F.regexp_replace("content", r"<\|(im_start|im_end)\|>", "<| $1 |>"), F.lit("<|im_end|>\n")
    )
    pieces = messages.join(views, "conv_id").select(
        "conv_id",
        "perspective",
        F.floor(F.col("n") / part_messages).alias("part"),
        F.struct("n", header.alias("header"), body.alias("body"), own.alias("own")).alias("m"),
    )
    parts = pieces.groupBy("conv_id", "perspective", "part").agg(
        F.sort_array(F.collect_list("m")).alias("ms")
    )
    nothing = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("trained"), F.array().cast("array<string>").alias("spans")
    )

    def add(a, m):
        start = a["at"] + F.length(m["header"])
        end = start + F.length(m["body"])
        # The last line break separates messages and is not part of what is said.
        span = F.concat_ws(":", start.cast("string"), (end - 1).cast("string"))
        return F.struct(
            end.alias("at"),
            (a["trained"] + F.when(m["own"], end - 1 - start).otherwise(0)).alias("trained"),
            F.when(m["own"], F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"),
        )

    return parts.withColumn("found", F.aggregate("ms", nothing, add)).select(
        "conv_id",
        "perspective",
        "part",
        F.size("ms").cast("long").alias("n_messages"),
        F.col("found.trained").cast("long").alias("n_trained"),
        F.array_join(F.transform("ms", lambda m: F.concat(m["header"], m["body"])), "").alias("text"),
        F.array_join("found.spans", ",").alias("mask"),
    )


def op3_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return rotate(table(spark, folder, "conversations"))


SQL = f"""
with messages as (
    select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as content
    from conversations where conv_id is not null),
numbered as (
    select *, row_number() over (partition by conv_id
                                 order by turn nulls first, speaker, content) - 1 as n
    from messages),
views as (
    select distinct conv_id, coalesce(role, 'unknown') as perspective from conversations
    where conv_id is not null and coalesce(role, 'unknown') <> 'system'),
pieces as (
    select conv_id, perspective, n // {PART_MESSAGES} as part, n, speaker = perspective as own,
           case when speaker = 'system' then '<|im_start|>system' || chr(10)
                when speaker = perspective then '<|im_start|>assistant' || chr(10)
                else '<|im_start|>user name=' || speaker || chr(10) end as header,
           regexp_replace(content, '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g')
               || '<|im_end|>' || chr(10) as body
    from numbered join views using (conv_id)),
placed as (
    select *, sum(length(header) + length(body)) over (
               partition by conv_id, perspective, part order by n) as stop
    from pieces)
select conv_id, perspective, part, count(*) as n_messages,
       coalesce(sum(length(body) - 1) filter (own), 0)::bigint as n_trained,
       string_agg(header || body, '' order by n) as text,
       coalesce(string_agg((stop - length(body))::varchar || ':' || (stop - 1)::varchar, ','
                           order by n) filter (own), '') as mask
from placed group by conv_id, perspective, part"""
