"""Preference formatting of chat pairs, in column expressions only.

A pair has a chosen and a rejected conversation. Their longest common prefix of turns is rendered
once as the prompt; what is left of each side is its completion, rendered likewise, with the spans
that are trained on. Everything else, the prompt first of all, is masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneprep.functions.binding import bind
from tuneprep.llm.common import fresh, table
from tuneprep.runtime import column

ASSISTANT = "assistant"
TURNS = "array<struct<role string, text string>>"
SPANS = "array<struct<start: int, end: int>>"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def _body(text: Column) -> Column:
    """The text and the line break that ends the turn; a null text is empty."""
    return F.concat(F.coalesce(text, F.lit("")), F.lit("\n"))


def render(turns: Column) -> Column:
    """All turns as one text: a line with the role, the text, a line break."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_head(t["role"]), _body(t["text"]))), ""
    )


def trained_spans(turns: Column) -> Column:
    """``array<struct<start, end>>``: the bodies of the assistant's turns in ``render(turns)``.

    Code points, end exclusive; the line break that ends a turn is trained on as its stop mark.
    """
    lengths = F.transform(
        turns,
        lambda t: F.struct(
            F.length(_head(t["role"])).alias("head"),
            F.length(_body(t["text"])).alias("body"),
            F.coalesce(t["role"] == ASSISTANT, F.lit(False)).alias("mine"),
        ),
    )
    return bind({"lengths": lengths}, lambda get: _spans(get("lengths")))


def _spans(lengths: Column) -> Column:
    """Spans from the lengths of the turns.

    Each append copies the array before it, so turns are taken in blocks of about the square root of
    their number: spans are appended within a block, then blocks to each other, moved by their start.
    """
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def turn(so_far, t):
        start = so_far["at"] + t["head"]
        end = start + t["body"]
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(t["mine"], F.concat(so_far["spans"], own)).otherwise(so_far["spans"]).alias("spans"),
        )

    def block(so_far, part):
        moved = F.transform(
            part["spans"],
            lambda s: F.struct(
                (s["start"] + so_far["at"]).alias("start"), (s["end"] + so_far["at"]).alias("end")
            ),
        )
        return F.struct(
            (so_far["at"] + part["at"]).alias("at"), F.concat(so_far["spans"], moved).alias("spans")
        )

    size = F.greatest(F.ceil(F.sqrt(F.size(lengths))), F.lit(1)).cast("int")
    first = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), size)
    parts = F.transform(first, lambda i: F.aggregate(F.slice(lengths, i, size), none, turn))
    return F.aggregate(parts, none, block, lambda x: x["spans"])


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal in role and text; nulls are equal to nulls."""
    # The shorter side is filled up with nulls, which no turn is equal to.
    equal = F.zip_with(chosen, rejected, lambda x, y: x.eqNullSafe(y) & x.isNotNull())
    first = F.array_position(equal, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(equal)).cast("int")


def format_preferences(
    pairs: DataFrame, chosen_col: str = "chosen", rejected_col: str = "rejected"
) -> DataFrame:
    """Add ``prompt``, and the completion and trained spans of each side.

    The two columns hold arrays of turns (``role``, ``text``) and are replaced by the rendered
    completions; ``chosen_spans`` and ``rejected_spans`` are offsets into those. A null side is an
    empty conversation; null roles and texts are rendered as empty. If one side is the beginning of
    the other, or both are equal, the completion of the shorter, or of both, is empty. Rows are
    neither moved nor dropped. Columns of the results' names are replaced, others stay.
    """
    side = {
        name: F.coalesce(column(name).cast(TURNS), F.array().cast(TURNS))
        for name in (chosen_col, rejected_col)
    }
    rest = [c for c in pairs.columns if c not in (chosen_col, rejected_col)]
    kept = [
        c for c in rest if c not in ("prompt", f"{chosen_col}_spans", f"{rejected_col}_spans")
    ]
    pair = fresh("pair")
    cut = pairs.select(
        *[column(c) for c in kept],
        F.struct(
            side[chosen_col].alias("c"),
            side[rejected_col].alias("r"),
            common_turns(side[chosen_col], side[rejected_col]).alias("n"),
        ).alias(pair),
    )

    def completion(which):
        turns = F.col(f"{pair}.{which}")
        return F.slice(turns, F.col(f"{pair}.n") + 1, F.greatest(F.size(turns), F.lit(1)))

    return cut.select(
        *[column(c) for c in kept],
        render(F.slice(F.col(f"{pair}.c"), F.lit(1), F.col(f"{pair}.n"))).alias("prompt"),
        render(completion("c")).alias(chosen_col),
        render(completion("r")).alias(rejected_col),
        trained_spans(completion("c")).alias(f"{chosen_col}_spans"),
        trained_spans(completion("r")).alias(f"{rejected_col}_spans"),
    )


def pairs_of_conversations(turns: DataFrame) -> DataFrame:
    """A pair for every conversation: itself, and itself with another's last reply.

    The other is the conversation whose id differs in the last bit (0 and 1, 2 and 3, ...); without
    one, or without a reply there, the rejected reply is empty. Conversations without a reply are
    rejected as they are. A conversation is one row by nature; only narrow replies are joined. Turns
    of a null id are one conversation; turns that tie are in the order of role and text.
    """
    turn = F.struct("turn", "role", "text")
    conversations = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_all"))
    conversations = conversations.select(
        "conv_id",
        F.transform("_all", lambda t: F.struct(t["role"], t["text"])).alias("chosen"),
    )
    replies = F.filter("chosen", lambda t: t["role"] == ASSISTANT)
    other = conversations.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("_id"),
        F.try_element_at(replies, F.lit(-1))["text"].alias("_reply"),
    )
    last = F.size("chosen") - F.array_position(
        F.transform(F.reverse("chosen"), lambda t: F.coalesce(t["role"] == ASSISTANT, F.lit(False))),
        F.lit(True),
    )
    has_reply = F.exists("chosen", lambda t: F.coalesce(t["role"] == ASSISTANT, F.lit(False)))
    swapped = F.transform(
        "chosen",
        lambda t, i: F.when(
            F.col("_has") & (i == F.col("_last")),
            F.struct(t["role"].alias("role"), F.coalesce("_reply", F.lit("")).alias("text")),
        ).otherwise(F.struct(t["role"].alias("role"), t["text"].alias("text"))),
    )
    return (
        conversations.join(other, F.col("conv_id") == F.col("_id"), "left")
        .withColumn("_has", has_reply)
        .withColumn("_last", last.cast("int"))
        .select("conv_id", "chosen", swapped.alias("rejected"))
    )


def op7_chat(spark, sf_dir):
    """Every conversation as a formatted preference pair."""
    pairs = pairs_of_conversations(table(spark, sf_dir, "conversations"))
    out = format_preferences(pairs)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")

    return out.select(
        "conv_id",
        "prompt",
        "chosen",
        "rejected",
        listed("chosen_spans").alias("chosen_spans"),
        listed("rejected_spans").alias("rejected_spans"),
    )


def _side_sql(name, turns):
    """Turns of one side after the first that differs, with their places in the completion."""
    return f"""
{name}_rest AS (
  SELECT x.conv_id, x.turn, x.role, x.h || x.b AS shown, length(x.h) AS head, length(x.b) AS body,
    sum(length(x.h) + length(x.b)) OVER (PARTITION BY x.conv_id ORDER BY x.turn) AS upto
  FROM {turns} x JOIN cut USING (conv_id) WHERE cut.first IS NOT NULL AND x.turn >= cut.first),
{name}_side AS (
  SELECT conv_id, string_agg(shown, '' ORDER BY turn) AS {name},
    string_agg((upto - body) || ':' || upto, ',' ORDER BY turn) FILTER (role = 'assistant') AS {name}_spans
  FROM {name}_rest GROUP BY conv_id)"""


OP7_SQL = f"""
WITH replies AS (
  SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS reply FROM conversations
  WHERE role = 'assistant' GROUP BY conv_id),
good AS (
  SELECT conv_id, turn, role, '<|' || role || '|>' || chr(10) AS h, text || chr(10) AS b
  FROM conversations),
bad AS (
  SELECT c.conv_id, c.turn, c.role, '<|' || c.role || '|>' || chr(10) AS h,
    CASE WHEN c.turn = mine.last_turn THEN coalesce(other.reply, '') ELSE c.text END || chr(10) AS b
  FROM conversations c LEFT JOIN replies mine ON mine.conv_id = c.conv_id
  LEFT JOIN replies other ON other.conv_id = xor(c.conv_id, 1)),
cut AS (
  SELECT good.conv_id, min(CASE WHEN good.b <> bad.b THEN good.turn END) AS first
  FROM good JOIN bad USING (conv_id, turn) GROUP BY good.conv_id),
prompts AS (
  SELECT conv_id, string_agg(h || b, '' ORDER BY turn) AS prompt FROM good JOIN cut USING (conv_id)
  WHERE cut.first IS NULL OR turn < cut.first GROUP BY conv_id),{_side_sql("chosen", "good")},{_side_sql("rejected", "bad")}
SELECT conv_id, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen,
  coalesce(rejected, '') AS rejected, coalesce(chosen_spans, '') AS chosen_spans,
  coalesce(rejected_spans, '') AS rejected_spans
FROM cut LEFT JOIN prompts USING (conv_id) LEFT JOIN chosen_side USING (conv_id)
LEFT JOIN rejected_side USING (conv_id)"""
