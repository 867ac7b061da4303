"""Chat formatting by multi-party perspective rotation.

A dialogue is rendered once for each participant: that speaker's turns are the assistant's and are trained on, all others' are those of
named users, and system turns stay system turns. The result has a row per message of each rendering, with its place
in the rendered text, so a dialogue of any length is never gathered in one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM = "system"
#: A speaker without a name.
NOBODY = "unknown"
#: Turns whose places are summed up together; the sums of such blocks come first, so a long dialogue is worked on by many tasks.
BLOCK = 1024


def rendered(role: Column, name: Column, text: Column) -> Column:
    """A message in the template: a header line with the role and, for users, the name; the text; an end line."""
    return F.concat(F.lit("<"), role, F.when(role == "user", F.concat(F.lit(":"), name)).otherwise(F.lit("")), F.lit(">\n"), text, F.lit("\n</>\n"))


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, turn, role, name, message, start, train_start, train_end for each participant and message.

    turns: conv_id, turn, role (the speaker), text. Messages are in the order of turn (null last), then speaker, then text. start is the
    message's place in the rendering in code points; train_start and train_end bound what is trained on (the assistant's text and end
    line), null for other messages. A null speaker is one called 'unknown', a null text is empty; rows without a conv_id
    belong to no dialogue and are left out, turns below 0 come first, dialogues of system turns alone have no rendering. Repeated rows are repeated messages.
    Other columns aren't read. An empty table gives an empty result.
    """
    rows = turns.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit(NOBODY)).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    people = rows.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    role = F.when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).when(F.col("speaker") == F.col("perspective"), F.lit("assistant")).otherwise(F.lit("user"))
    seen = rows.join(people, "conv_id").withColumn("role", role)
    seen = seen.withColumn("message", rendered(F.col("role"), F.col("speaker"), F.col("text"))).withColumns({"late": F.col("turn").isNull(), "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(0))})
    blocks = seen.groupBy("conv_id", "perspective", "late", "block").agg(F.sum(F.length("message")).alias("size"))
    so_far = Window.partitionBy("conv_id", "perspective").orderBy("late", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "perspective", "late", "block", F.coalesce(F.sum("size").over(so_far), F.lit(0)).alias("before"))
    seen = seen.join(blocks, ["conv_id", "perspective", "late", "block"])
    within = Window.partitionBy("conv_id", "perspective", "late", "block").orderBy(F.asc_nulls_last("turn"), "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("start", F.col("before") + F.coalesce(F.sum(F.length("message")).over(within), F.lit(0)))
    trained = F.col("role") == "assistant"
    end = F.col("start") + F.length("message")
    return seen.select(
        "conv_id", "perspective", "turn", "role", F.when(F.col("role") == "user", F.col("speaker")).alias("name"), "message", "start",
        F.when(trained, end - F.length("text") - 5).alias("train_start"), F.when(trained, end).alias("train_end"),
    )
