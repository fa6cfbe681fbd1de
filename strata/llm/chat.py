"""Chat formatting: cumulative-snapshot collapse.

A logged conversation is often stored again and again while it grows. One that
is a prefix of a longer one, or equal to one with a smaller id, is redundant.
Each turn gets the rolling hash of all turns up to it; a conversation is
dropped if its own last hash is an inner prefix hash of any conversation
(anti-join), so maximal conversations remain and are rendered.

The rolling hash is the running sum of hashes of (position, role, text), kept
as two exact decimal sums with different seeds. Turns are range-partitioned by
(conversation, turn, role, text) and stored in that order with a running number,
so a conversation of any length, the null one included, may lie in several
tasks: positions and rolling hashes are counted inside each part of it and
moved by what the parts before hold. Texts take part in sorting and rendering
only. Both sides of the anti-join are aggregated per (length, hash) first: a
first turn or a conversation that a third of the log shares is one row per task.
Rendered text comes in parts of ``part_turns`` turns, so no conversation has to
fit one row.

Defined results: turns are ordered by (turn, role, text), nulls first, and
positions count from 1, so gaps and ties in ``turn`` do not matter and repeated
rows are turns of their own; a turn's text may be of any length; a null role or text counts as empty and is not
told from it; rows of a null conv_id form one conversation; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import quoted, stored

PART_TURNS = 64
#: Marks of a rendered turn: opening, between role and text, closing.
OPEN, MID, CLOSE = "<|", "|>\n", "\n"


def ordered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Stored (conv, role, text, part, at): all turns in order; ``at`` counts
    on inside each part of the order."""
    rows = turns.select(
        quoted(conv).alias("conv"), quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"), F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    order = ["conv", "turn", "role", "text"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    # The upper bits of the running number are the partition's.
    return stored(dealt.drop("turn").withColumn("part", F.shiftright("at", 33)), "turns-in-order")


def slices(rows: DataFrame) -> DataFrame:
    """(conv, part, first, before, length): the parts of each conversation,
    where they begin, how many turns lie before, and the whole length."""
    parts = rows.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    upto = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "conv", "part", "first", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("conv")).alias("length")
    )


def _numbered(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` with their position and what else ``cut`` holds of their part."""
    cut = cut.withColumnsRenamed({"conv": "its_conv", "part": "its_part"})
    joined = rows.join(cut, F.col("conv").eqNullSafe(F.col("its_conv")) & (F.col("part") == F.col("its_part")))
    pos = F.col("at") - F.col("first") + F.col("before") + 1
    return joined.withColumn("pos", pos).drop("its_conv", "its_part", "at", "first")


def prefixes(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """(conv, pos, length, h1, h2): every turn's rolling hash, without texts."""
    narrow = rows.select("conv", "part", "at", *[F.xxhash64(F.lit(i), "role", "text").alias(f"c{i}") for i in (1, 2)])
    upto = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moving = lambda i: F.sum(F.xxhash64(F.lit(i), "pos", f"c{i}").cast("decimal(20,0)")).over(upto).alias(f"s{i}")
    inside = stored(_numbered(narrow, cut).select("conv", "part", "pos", "before", "length", moving(1), moving(2)), "rolling-inside")
    # Only conversations in several parts have anything to move.
    ends = inside.groupBy("conv", "part", "before", "length").agg(F.max(F.struct("pos", "s1", "s2")).alias("end"))
    ends = ends.where((F.col("before") > 0) | (F.col("end.pos") < F.col("length")))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = ends.select(
        F.col("conv").alias("its_conv"), F.col("part").alias("its_part"), *[F.sum(f"end.s{i}").over(earlier).alias(f"m{i}") for i in (1, 2)]
    )
    joined = inside.join(moved, F.col("conv").eqNullSafe(F.col("its_conv")) & (F.col("part") == F.col("its_part")), "left")
    none = F.lit(0).cast("decimal(20,0)")
    return joined.select("conv", "pos", "length", *[(F.col(f"s{i}") + F.coalesce(f"m{i}", none)).alias(f"h{i}") for i in (1, 2)])


def maximal(rolled: DataFrame) -> DataFrame:
    """(conv, length) of the conversations to keep."""
    last = F.col("pos") == F.col("length")
    whole = rolled.where(last).groupBy("pos", "h1", "h2").agg(F.min("conv").alias("conv"))
    inner = rolled.where(~last).select("pos", "h1", "h2").distinct()
    return whole.join(inner, ["pos", "h1", "h2"], "left_anti").select("conv", F.col("pos").alias("length"))


def render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           part_turns: int = PART_TURNS) -> DataFrame:
    """(conv, part, n_turns, rendered): the maximal conversations as text."""
    rows = ordered(turns, conv, turn, role, text)
    cut = stored(slices(rows), "conversation-parts")
    kept = maximal(stored(prefixes(rows, cut), "rolling")).select(F.col("conv").alias("kept"))
    chosen = cut.join(kept, F.col("conv").eqNullSafe(F.col("kept"))).drop("kept")
    mine = _numbered(rows, chosen)
    line = F.concat(F.lit(OPEN), "role", F.lit(MID), "text", F.lit(CLOSE))
    no = F.floor((F.col("pos") - 1) / part_turns).cast("int")
    parts = mine.groupBy("conv", no.alias("no"), "length").agg(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines"))
    return parts.select(
        F.col("conv").alias(conv), F.col("no").alias("part"), F.col("length").cast("int").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"),
    )
