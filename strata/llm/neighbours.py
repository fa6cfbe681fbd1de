"""Approximate nearest neighbours by collision counting.

Every vector is projected on ``PROJECTIONS`` fixed random lines; a block of
vectors keeps one sorted array of projections per line. A query opens a window
around its own projection on every line and counts in how many windows a vector
lies. Windows widen by ``GROWTH`` (virtual rehashing: no new hash tables, only
the newly covered ends are counted). A vector whose count reaches the collision
threshold is verified: its exact distance is computed from the original
components in double precision. There is no cap on candidates.

All blocks share one radius for each query, the distance of its k-th nearest in
a bounded sample, which the final one cannot exceed. The first windows stand for
a radius ``STEPS`` widenings below it. A query stops in a block when enough
verified vectors lie within the radius that its windows stand for, when that
radius reaches the shared one (what lies beyond cannot be among the nearest), or
when the windows hold all. Queries that found fewer than k this way are searched
again without a radius, in which case each block gives as many as it has, up to k.

Equal vectors are one index entry with their k+1 smallest ids (a top k can use
no more), equal queries are searched once. Vectors are dealt into blocks; each
task builds its block's arrays once and streams the stored queries past it in
batches, so memory holds one block and one batch whatever the table's size. The
blocks' nearest are merged by a ranking that is cut before its shuffle.

Only the windows' widths are fitted, on a bounded sample of ``SAMPLE`` vectors;
every vector is indexed.

Defined results: vectors that are null, empty, all zero, or hold a null or
non-finite component take no part, nor do rows without an id; vectors of
different length are never compared; rows that repeat an id count once for each
distinct vector and appear once, at their least distance; ties go to the
smaller id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import quoted, ship, stored, stored_at

PROJECTIONS = 64
#: Half the window's width in standard deviations of a projected difference at
#: the radius, and the share of windows in which a vector must lie.
HALF_WIDTH, THRESHOLD = 1.45, 0.75
GROWTH = 1.3
#: Widenings from the first windows to the shared radius.
STEPS = 4
BLOCK, QUERIES = 1 << 16, 512
SAMPLE = 4096
SEED = 11


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~bad & F.exists(embedding, lambda x: x != 0)


def lines(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim, PROJECTIONS))


class Block:
    """The sorted arrays of one block of vectors of equal length."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        projected = vectors @ lines(vectors.shape[1])
        self.order = np.argsort(projected, axis=0, kind="stable").astype(np.int32).T.copy()
        self.sorted = np.sort(projected, axis=0).T.copy()

    def typical(self) -> float:
        """The median distance between neighbouring rows of the block."""
        some = self.vectors[:256]
        apart = np.sqrt(((some[1:] - some[:-1]) ** 2).sum(axis=1))
        return float(np.median(apart)) if len(apart) and apart.any() else 1.0

    def nearest(self, queries: np.ndarray, k: int, radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Per query: positions and distances of its verified vectors, and how
        many those are. A query of unknown radius (infinite) starts from the block's
        own distances and widens until it has ``k``."""
        n, need = len(self.vectors), int(np.ceil(THRESHOLD * PROJECTIONS))
        centres = (queries @ lines(queries.shape[1])).T
        first = np.where(np.isfinite(radius), radius, self.typical()) / GROWTH**STEPS
        windows: list[tuple[np.ndarray, np.ndarray]] = []

        def window(step: int) -> tuple[np.ndarray, np.ndarray]:
            # Borders of all lines and queries, worked out once for each width.
            if step == len(windows):
                reach = HALF_WIDTH * first * GROWTH**step
                low = [np.searchsorted(s, c - reach) for s, c in zip(self.sorted, centres)]
                high = [np.searchsorted(s, c + reach, side="right") for s, c in zip(self.sorted, centres)]
                windows.append((np.array(low).T.copy(), np.array(high).T.copy()))
            return windows[step]

        for i, q in enumerate(queries):
            counts = np.zeros(n, dtype=np.int64)
            found, far = np.zeros(0, dtype=np.int64), np.zeros(0)
            low = high = None
            step = 0
            while True:
                lo, hi = (x[i] for x in window(step))
                if low is None:
                    ends = [o[a:b] for o, a, b in zip(self.order, lo, hi)]
                else:
                    ends = [o[a:b] for o, a, b in zip(self.order, lo, low)] + [o[a:b] for o, a, b in zip(self.order, high, hi)]
                low, high = lo, hi
                ends = np.concatenate(ends)
                if len(ends):
                    counts += np.bincount(ends, minlength=n)
                    new = np.flatnonzero(counts >= need)
                    # A verified vector never counts again.
                    counts[new] = -2 * PROJECTIONS
                    found = np.append(found, new)
                    far = np.append(far, np.sqrt(((self.vectors[new] - q) ** 2).sum(axis=1)))
                reached = first[i] * GROWTH**step
                if reached >= radius[i] or (far <= reached).sum() >= min(k, n) or (hi - lo).min() == n:
                    break
                step += 1
            yield found, far, len(found)


def _sampled(vectors: DataFrame) -> dict[int, np.ndarray]:
    """At most ``SAMPLE`` of the distinct vectors, by length."""
    got: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vector")).limit(SAMPLE).collect():
        got.setdefault(len(r["vector"]), []).append(r["vector"])
    return {k: np.array(v, dtype=np.float64) for k, v in got.items()}


def radii(queries: np.ndarray, sample: np.ndarray | None, k: int) -> np.ndarray:
    """Per query a distance within which at least ``k`` of the sample lie;
    infinite if the sample is smaller."""
    if sample is None or len(sample) < k:
        return np.full(len(queries), np.inf)
    return np.array([np.partition(np.sqrt(((sample - q) ** 2).sum(axis=1)), k - 1)[k - 1] for q in queries])


def _query_batches(uri: str) -> Iterator[pa.RecordBatch]:
    import pyarrow.dataset as ds
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(uri)
    yield from ds.dataset(path, filesystem=files, format="parquet").to_batches(batch_size=QUERIES)


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _search(uri: str, k: int, samples):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block():
            table = pa.Table.from_batches(held)
            sizes = np.array([len(v) for v in table["vector"].to_pylist()])
            for dim in np.unique(sizes):
                mine = table.take(pa.array(np.flatnonzero(sizes == dim)))
                ids = mine["ids"].to_pylist()
                index = Block(_matrix(mine["vector"]))
                for batch in _query_batches(uri):
                    same = np.flatnonzero([len(v) == dim for v in batch.column("vector").to_pylist()])
                    if not len(same):
                        continue
                    batch = batch.take(pa.array(same))
                    out = ([], [], [])
                    queries = _matrix(batch.column("vector"))
                    near = index.nearest(queries, k + 1, radii(queries, samples and samples.value.get(int(dim)), k + 1))
                    for key, (at, far, _) in zip(batch.column("qkey").to_pylist(), near):
                        # Nearest entries first, until they hold k + 1 ids.
                        best = []
                        for p in np.argsort(far, kind="stable"):
                            if len(best) > k and far[p] > best[-1][0]:
                                break
                            best = sorted([*best, *((float(far[p]), i) for i in ids[at[p]])])[: k + 1]
                        for d, i in best:
                            for column, value in zip(out, (key, i, d)):
                                column.append(value)
                    yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["qkey", "vec_id", "score"])

        for batch in batches:
            while len(batch):
                take = batch.slice(0, BLOCK - n)
                held.append(take)
                n += len(take)
                batch = batch.slice(len(take))
                if n == BLOCK:
                    yield from block()
                    held, n = [], 0
        if held:
            yield from block()

    return run


def search(rows: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query row
    among all other rows."""
    ship(rows.sparkSession)
    spark = rows.sparkSession
    good = rows.where(usable(quoted(embedding)) & quoted(key).isNotNull())
    vectors = good.select(quoted(key).cast("long").alias("id"), quoted(embedding).cast("array<double>").alias("vector"), is_query.alias("asks"))
    asked = vectors.where("asks").groupBy("vector").agg(F.min("id").alias("qkey"))
    queries, uri = stored_at(asked, "ann-queries")
    smallest = Window.partitionBy("vector").orderBy("id")
    entries = (
        vectors.select("vector", "id").withColumn("r", F.dense_rank().over(smallest)).where(F.col("r") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    )
    index = stored(entries, "ann-index")
    samples = spark.sparkContext.broadcast(_sampled(index.select("vector")))
    n = max(1, spark.sparkContext.defaultParallelism, -(-index.count() // BLOCK))
    dealt = index.repartition(n, F.xxhash64("vector"))

    def merged(uri: str, radius_from) -> DataFrame:
        found = dealt.mapInArrow(_search(uri, k, radius_from), "qkey long, vec_id long, score double")
        near = found.groupBy("qkey", "vec_id").agg(F.min("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("qkey").orderBy("score", "vec_id"))
        return near.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank")

    best = stored(merged(uri, samples), "ann-found")
    # A query that found too few within its radius is searched without one.
    full = best.groupBy("qkey").agg(F.count("*").alias("n")).where(F.col("n") > k).select("qkey")
    short, short_uri = stored_at(queries.join(full, "qkey", "left_anti"), "ann-short")
    if not short.isEmpty():
        best = best.join(full, "qkey", "left_semi").unionByName(merged(short_uri, None))
    whose = vectors.where("asks").select("id", "vector").join(queries, "vector").select(F.col("id").alias("query_id"), "qkey").distinct()
    own = whose.join(best, "qkey").where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return own.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(rows: DataFrame, every: int = 100, k: int = 10, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    return search(rows, F.coalesce(quoted(key) % every == 0, F.lit(False)), k, key, embedding)
