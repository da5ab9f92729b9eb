"""Multi-party perspective rotation of dialogues, on DataFrame functions only.

For every participant of a conversation the dialogue is rendered once, with that speaker as
``assistant`` and every other one as a named ``user``; system turns stay system turns and are
no participants.  The result has a row per conversation, perspective and turn: its segment of
the rendered dialogue, the segment's place there (start, in characters), and a mask that is 1
where the model is to learn: the assistant's segments, from learn_from up to the end.

Conversations of many turns (at most HOT_KEYS of them are above the limit) are joined with their participants under
SALTS salts, and their running numbers and places come from sums by ranges of (turn, role, beginning of the text), so none of
them is gathered in one task unless most of its turns agree in all of these.  Others fit a window each.

Names hold letters, digits, ``_`` and ``-``; other characters become ``_``.  Participants of a conversation whose names
would then be the same are told apart by ``.2``, ``.3`` and so on, in the order of their roles.

Turns with equal numbers are ordered by role and text; equal rows are rendered each.  A null
role counts as ``unknown``, a null text as empty, a null turn comes first; a null conv_id
is a conversation of its own.  Marks in texts and names are broken up (``<|`` becomes ``< |``).
Conversations of system turns only give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.shared import HOT_FLOOR, HOT_KEYS, cut
from lineflow.operators.batch import running

SALTS = 16
#: Characters of a text that ranges of a long conversation go by.
BEGINNING = 64


def _safe(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|", "< |")


def _turns(conversations: DataFrame) -> DataFrame:
    role = F.coalesce(F.col("role").cast("string"), F.lit("unknown"))
    return conversations.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        role.alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _names(people: DataFrame) -> DataFrame:
    """(conv_id, role, name) of participants, names distinct in a conversation."""
    plain = F.regexp_replace("role", r"[^A-Za-z0-9_-]", "_")
    among = Window.partitionBy("conv_id", "plain").orderBy("role")
    named = people.withColumn("plain", plain).withColumn("k", F.row_number().over(among))
    name = F.when(F.col("k") == 1, F.col("plain")).otherwise(F.concat("plain", F.lit("."), F.col("k").cast("string")))
    return named.select("conv_id", "role", name.alias("name"), "k")


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, n (place from 0), turn, start, segment, mask, learn_from."""
    turns = _turns(conversations)
    sizes = cut(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = cut(sizes.filter(F.col("n") > max(HOT_FLOOR, total // HOT_KEYS)))  # at most HOT_KEYS ids
    any_hot = not hot.isEmpty()
    marks = F.broadcast(hot.select(F.col("conv_id").alias("_hot"), F.lit(True).alias("_is_hot")))
    mark = lambda df: df.join(marks, F.col("conv_id").eqNullSafe(F.col("_hot")), "left").drop("_hot")
    salts = F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(F.col("_is_hot"), F.pmod(F.xxhash64("turn", "role", "text"), F.lit(SALTS))).otherwise(0)
    salted = mark(turns).withColumn("_salt", salt.cast("int"))
    of = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_salt") == F.col("_psalt"))
    people = turns.filter("role <> 'system'").select("conv_id", "role").distinct()
    others = cut(_names(people).filter("k > 1"))  # names that another participant has already
    name = F.regexp_replace("role", r"[^A-Za-z0-9_-]", "_")
    if not others.isEmpty():
        told = mark(others).select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), "name", F.explode(salts).alias("_psalt"))
        salted = salted.join(told, of & (F.col("role") == F.col("_role")), "left").drop("_conv", "_role", "_psalt")
        name = F.coalesce("name", name)
    people = mark(people).select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective"), F.explode(salts).alias("_psalt"))
    rows = salted.join(people, of)
    own = F.col("role") == F.col("perspective")
    head = (
        F.when(F.col("role") == "system", F.lit("<|im_start|>system\n"))
        .when(own, F.lit("<|im_start|>assistant\n"))
        .otherwise(F.concat(F.lit("<|im_start|>user name="), name, F.lit("\n")))
    )
    segment = F.concat(head, _safe(F.col("text")), F.lit("<|im_end|>\n"))
    rows = rows.select(
        "conv_id", "perspective", "turn", "role", "text", segment.alias("segment"), own.cast("int").alias("mask"),
        F.char_length(head).alias("learn_from"), "_is_hot",
    )
    size = F.char_length("segment").cast("long")
    result = ["conv_id", "perspective", "n", "turn", "start", "segment", "mask", "learn_from"]
    upto = Window.partitionBy("conv_id", "perspective").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    cold = rows.filter("_is_hot is null").select("*", (F.count("*").over(upto) - 1).alias("n"), (F.sum(size).over(upto) - size).alias("start"))
    if not any_hot:
        return cold.select(*result)
    long = rows.filter("_is_hot").withColumn("beginning", F.left("text", F.lit(BEGINNING)))
    order = ["turn", "role", "beginning", "text"]
    long = running(long, order, ["conv_id", "perspective"], {"_n": F.lit(1), "_end": size}, ranges_by=order[:3])
    long = long.select("*", (F.col("_n") - 1).alias("n"), (F.col("_end") - size).alias("start"))
    return cold.select(*result).unionByName(long.select(*result))
