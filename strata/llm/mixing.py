"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; a document's expected copies are
target / words of its source. The expected copies are summed in a fixed order
within the source, one random offset (drawn from the seed and the source) is
added, and a document is emitted once for each integer the sum crosses. So a
document appears floor(r) or ceil(r) times, r being its source's rate.

Documents are ordered by size, so consecutive picks stand for documents of like
size and a source's taken words come near its target. The running sum never
needs a whole source in one task: documents fall into groups (source, size
class, slice of a hash), group counts are summed within the source over a
bounded number of groups, and only the rank inside a group needs the rows.

Targets: weights by the rank of the source, all words of the table shared out,
no target above ``cap`` times its source's words; what is above is shared again
by weight. That is a water level over the sources sorted by words / weight.

Defined results: a null text has size 0; documents of a source without words
get a target of 0 and are not taken; a null source is a source, last in the
order; repeated rows are separate documents, ties are broken by key and text
hash; an empty table gives an empty result; extra columns are kept, and added
columns take a free name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, free_name, quoted, stored

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20
#: Size classes: so many for each factor e of the size.
FINENESS = 11.5


def sizes(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slice_of(key: Column) -> Column:
    """One of 256 slices, by a hash of the key."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 2), 16, 10).cast("int")


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source, in [0, 1)."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source.cast("string"), F.lit(""))))
    return F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def targets(measured: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) of ``measured`` (source, size). One row
    per source from here on; windows run over sources, not documents."""
    per = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", (cap * F.col("source_size")).cast("long"))
    # Sources in the order in which a rising level fills them.
    filling = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.col("full")) / F.col("open")
    per = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("level", level)
        # The level holds from the first source that it does not fill.
        .withColumn("holds", F.col("level") * F.col("weight") <= F.col("most"))
        .withColumn("level", F.min(F.when(F.col("holds"), F.struct(F.col("most") / F.col("weight"), "rank", "level"))).over(everything)["level"])
    )
    return per.select(
        "source", "source_size", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")).alias("target")
    )


def sample(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: tuple = WEIGHTS,
           cap: int = CAP, seed: int = SEED) -> DataFrame:
    """Per document: key, tie (text hash), size, source_size, target, copies.
    The regex runs once; the result of it is stored."""
    measured = stored(
        docs.select(
            quoted(key).alias("key"),
            quoted(source).alias("source"),
            sizes(quoted(text)).alias("size"),
            F.xxhash64(quoted(key), quoted(text)).alias("tie"),
        ),
        "sizes",
    )
    step = F.floor(F.log(F.col("size") + 1) * FINENESS).cast("int")
    grouped = measured.withColumn("step", step).withColumn("slice", slice_of(F.col("key")))
    counts = grouped.groupBy("source", "step", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("step", "slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rates = targets(measured, weights, cap).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    rates = rates.withColumn("offset", offset(F.col("source"), seed))
    groups = (
        counts.alias("g").join(rates.alias("r"), F.col("g.source").eqNullSafe(F.col("r.source")))
        .select("g.*", "r.source_size", "r.target", "r.rate", "r.offset")
    )
    inside = Window.partitionBy("source", "step", "slice").orderBy("size", "key", "tie")
    ranked = grouped.withColumn("at", F.row_number().over(inside))
    same = F.col("d.source").eqNullSafe(F.col("g.source")) & (F.col("d.step") == F.col("g.step")) & (F.col("d.slice") == F.col("g.slice"))
    placed = ranked.alias("d").join(groups.alias("g"), same).select("d.*", "g.base", "g.source_size", "g.target", "g.rate", "g.offset")
    upto = F.col("base") + F.col("at")
    copies = F.floor(F.col("offset") + F.col("rate") * upto) - F.floor(F.col("offset") + F.col("rate") * (upto - 1))
    return placed.select("key", "tie", "size", "source_size", "target", copies.cast("long").alias("copies"))


def report(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **more) -> DataFrame:
    got = sample(docs, text, source, key, **more)
    return got.select(
        F.col("key").alias(key), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **more) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Copies are joined
    back by key and text hash; rows that agree in both are interchangeable, so
    their copies are added up and dealt out among them."""
    tie, m, c, no, its_key, its_tie = (free_name(docs, x) for x in ("tie", "rows_alike", "copies_alike", "row_no", "key_", "tie_"))
    got = sample(docs, text, source, key, **more).groupBy("key", "tie").agg(F.count("*").alias(m), F.sum("copies").alias(c))
    left = docs.withColumn(tie, F.xxhash64(quoted(key), quoted(text))).alias("d")
    right = got.select(F.col("key").alias(its_key), F.col("tie").alias(its_tie), m, c)
    joined = left.join(right, (F.col(f"d.`{tie}`") == F.col(its_tie)) & F.col(f"d.`{key}`").eqNullSafe(F.col(its_key)))
    alike = Window.partitionBy(its_tie, its_key).orderBy(its_tie)
    dealt = joined.withColumn(no, F.row_number().over(alike))
    copies = F.floor(F.col(c) / F.col(m)) + F.when(F.col(no) <= F.col(c) % F.col(m), 1).otherwise(0)
    repeated = dealt.where(copies > 0).withColumn(no, F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return repeated.select(*[F.col(f"d.`{x}`") for x in docs.columns])
