"""Chat formatting of logged conversations, after cumulative snapshots are collapsed.

Chat logs often hold a conversation once for every turn: each snapshot is a prefix
of the next. A rolling hash tells them: turn k's hash mixes its place, role and
text, and the hash of a prefix is the XOR over its turns, for two seeds. Both are
sums that blocks of turns can give in part, so no conversation is held in one
task: running values within blocks of `BLOCK` turn numbers, and running values over
the blocks' totals. A conversation goes if its whole hash is a strict prefix of another
one (an anti-join with the distinct prefix hashes), or if it equals another one
with a lower id.

All of that runs on hashes of role and text. Texts themselves are read again for the
conversations that stay, and move once: to the task that renders their block. Each turn
is rendered as <|role|>, a line end, the text and a line end, in order; a conversation
is one row for every block of `BLOCK` turn numbers that it has turns in (`formatted`), or
one row, or one for so many turns (`whole`), for which texts move twice.

Turns are ordered by `turn`, then role and text; a conversation's turns are numbered by
that order, so that gaps in `turn` don't matter to what is a prefix. Rows that repeat a
turn entirely count once. Null role or text counts as empty; rows with a null conversation
id or turn are left out. Other columns are ignored. Texts of any length are one value.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.llm.common import small
from gridframe.shared import written

#: Turn numbers that are held together, in a window or in a rendered part.
BLOCK = 1024
_BLOCK = ["conv_id", "block"]


def _rows(conversations: DataFrame) -> DataFrame:
    """conv_id, block, turn, role, text; rows may repeat."""
    c = conversations
    rows = c.select(c["conv_id"], c["turn"], F.coalesce(c["role"], F.lit("")).alias("role"), F.coalesce(c["text"], F.lit("")).alias("text"))
    return rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", F.floor(F.col("turn") / BLOCK).alias("block"), "turn", "role", "text")


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, block, turn, place (within the block), x, y (hashes of role and text); each distinct turn once."""
    rows = _rows(conversations)
    marks = [F.xxhash64("role", "text").alias("x"), F.xxhash64("text", "role", F.lit("second")).alias("y")]
    # By block, so that everything up to the running hashes needs no further exchange.
    hashed = rows.select(*_BLOCK, "turn", "role", *marks).repartition(*_BLOCK).dropDuplicates([*_BLOCK, "turn", "role", "x", "y"])
    ties = written(hashed.groupBy(*_BLOCK, "turn", "role").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "ties")
    order = F.lit(0)
    if ties.limit(1).count():
        # Turns that share number and role are ordered by their texts: those alone are brought together.
        own = rows.join(small(ties), [*_BLOCK, "turn", "role"], "left_semi").distinct()
        ranked = own.select("conv_id", "block", "turn", *marks, F.row_number().over(Window.partitionBy(*_BLOCK, "turn", "role").orderBy("text")).alias("rank"))
        hashed, order = hashed.join(ranked, [*_BLOCK, "turn", "x", "y"], "left"), F.coalesce(F.col("rank"), F.lit(0))
    place = F.row_number().over(Window.partitionBy(*_BLOCK).orderBy("turn", "role", order))
    return hashed.select(*_BLOCK, place.alias("place"), "x", "y")


def _prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, block, n, h1, h2: number and hashes of the turns up to each turn; n_turns: of the whole."""
    turns = _turns(conversations)
    counts = turns.groupBy(*_BLOCK).agg(F.max("place").alias("n_block"))
    order = Window.partitionBy("conv_id").orderBy("block")
    offsets = counts.select(*_BLOCK, (F.sum("n_block").over(order) - F.col("n_block")).alias("before"))
    placed = turns.join(offsets, _BLOCK).withColumn("n", F.col("before") + F.col("place"))
    hashed = placed.select(*_BLOCK, "n", F.xxhash64("n", "x", "y").alias("a"), F.xxhash64("y", "n", "x", F.lit("second")).alias("b"))
    within = Window.partitionBy(*_BLOCK).orderBy("n")
    running = hashed.select(*_BLOCK, "n", *(F.expr(f"bit_xor({x})").over(within).alias(x) for x in "ab"))
    totals = hashed.groupBy(*_BLOCK).agg(F.expr("bit_xor(a)").alias("ta"), F.expr("bit_xor(b)").alias("tb"), F.max("n").alias("last"))
    # A block's own total taken out of the running one leaves that of the blocks before.
    sums = totals.select(*_BLOCK, *(F.expr(f"bit_xor(t{x})").over(order).bitwiseXOR(F.col(f"t{x}")).alias(f"p{x}") for x in "ab"), F.max("last").over(Window.partitionBy("conv_id")).alias("n_turns"))
    return running.join(sums, _BLOCK).select(*_BLOCK, "n", "n_turns", F.col("a").bitwiseXOR(F.col("pa")).alias("h1"), F.col("b").bitwiseXOR(F.col("pb")).alias("h2"))


def _maximal(prefixes: DataFrame) -> DataFrame:
    whole = prefixes.where("n = n_turns").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    strict = prefixes.where("n < n_turns").groupBy("n", "h1", "h2").agg(F.lit(1).alias("seen"))
    return whole.join(strict, ["n", "h1", "h2"], "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"))


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that are no strict prefix of another and have the least id of their equals."""
    return _maximal(written(_prefixes(conversations), "prefixes"))


def _line(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("\n"))


def formatted(conversations: DataFrame) -> DataFrame:
    """One row per part of a maximal conversation: conv_id, part, n_turns (of the whole), text.

    A part holds `BLOCK` turn numbers, so that turns that are numbered by time stamps make many; see `whole`.
    """
    prefixes = written(_prefixes(conversations), "prefixes")
    kept = written(prefixes.select(*_BLOCK).distinct().join(_maximal(prefixes), "conv_id"), "kept-blocks")
    blocks = _rows(conversations).join(small(kept), _BLOCK).groupBy(*_BLOCK, "n_turns").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("lines"))
    return blocks.select("conv_id", F.col("block").alias("part"), "n_turns", F.array_join(F.transform("lines", _line), "").alias("text"))


def whole(conversations: DataFrame, part_turns: int | None = None) -> DataFrame:
    """Maximal conversations by the places of their turns, whatever numbers these have: conv_id, part, n_turns, text.

    part_turns: turns of a part, all parts but the last having that many; None for one row a
    conversation, whose text then has to fit in one value.
    """
    prefixes = written(_prefixes(conversations), "prefixes")
    before = prefixes.groupBy(*_BLOCK).agg((F.min("n") - 1).alias("before"))
    kept = written(before.join(_maximal(prefixes), "conv_id"), "kept-blocks")
    blocks = _rows(conversations).join(small(kept), _BLOCK).groupBy(*_BLOCK, "n_turns", "before").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("lines"))
    if part_turns is None:
        texts = blocks.select("conv_id", "n_turns", F.lit(0).cast("long").alias("part"), F.col("before").alias("n"), F.array_join(F.transform("lines", _line), "").alias("text"))
    else:
        turns = blocks.select("conv_id", "n_turns", "before", F.posexplode("lines").alias("k", "x")).withColumn("n", F.col("before") + F.col("k"))
        texts = turns.select("conv_id", "n_turns", F.floor(F.col("n") / part_turns).alias("part"), "n", _line(F.col("x")).alias("text"))
    parts = texts.groupBy("conv_id", "part", "n_turns").agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("parts"))
    return parts.select("conv_id", "part", "n_turns", F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"))


#: The same by SQL, with whole prefixes as lists.
ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
), whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY n) AS turns, count(*) AS n_turns FROM t GROUP BY conv_id
), kept AS (
  SELECT * FROM whole w WHERE NOT EXISTS (
    SELECT 1 FROM whole o WHERE o.conv_id <> w.conv_id AND o.n_turns >= w.n_turns AND o.turns[1] = w.turns[1]
      AND o.turns[1:w.n_turns] = w.turns AND (o.n_turns > w.n_turns OR o.conv_id < w.conv_id))
)
SELECT conv_id, turn // 1024 AS part, n_turns, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY n) AS text
FROM t JOIN kept USING (conv_id) GROUP BY conv_id, turn // 1024, n_turns
"""
