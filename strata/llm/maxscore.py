"""Exact top-k search by inner product: MaxScore over sharded postings.

Vectors become integers, floor(256 * x). A term is a dimension; in a shard it
has two postings, the vectors with a positive and those with a negative value
there, and the greatest value of each gives the bound of a query's score in that
term: its weight times the greatest value of its own sign (zero if there is no
posting). For each query the terms are ordered by bound. The smallest ones whose
bounds together stay below the threshold are non-essential: a vector that is in
no essential posting cannot reach it. The essential postings are traversed in
descending order and their scores summed; each vector found is then probed in
the other terms, the largest bounds first, as long as its sum and the remaining
bounds reach the threshold. Every sum is an exact integer, so are the results.

The threshold starts at the (k+1)-th best of a bounded sample of ``SAMPLE``
vectors, which is never above the final one, and rises with the full scores of
the most promising vectors of the shard. The shards' best are merged by a
ranking that is cut before its shuffle.

Equal vectors are one entry with their k+1 smallest ids (a top k can use no
more), equal queries are searched once. Vectors are dealt into shards of
``SHARD``; each task builds its shard's postings once and streams the stored
queries past it in batches, so memory holds one shard and one batch.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; zero vectors do; vectors of different
length are never compared (empty ones score 0 among themselves); rows that
repeat an id are one candidate, with their greatest score, and never candidates
of their own id; ties go to the smaller id; scores beyond 64 bits count as the
nearest long; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import quoted, ship, stored, stored_at

FACTOR = 256
SHARD, QUERIES, SAMPLE = 1 << 15, 512, 2048
_LONG = np.iinfo(np.int64)


def usable(embedding: Column) -> Column:
    return embedding.isNotNull() & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _bar(score):
    """A threshold that cut scores can be held against."""
    return float("-inf") if score <= _LONG.min else min(score, _LONG.max)


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) as integers; Python's own where 64 bits could overflow."""
    scaled = np.floor(vectors * float(FACTOR))
    if not scaled.size or np.abs(scaled).max() < 2**20:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], dtype=object).reshape(scaled.shape)


class Shard:
    """Postings of one shard: per dimension and sign the vectors that have such
    a value there, and its greatest size."""

    def __init__(self, vectors: np.ndarray):
        self.values = np.ascontiguousarray(vectors.T)
        self.size = len(vectors)
        self.postings = [(np.flatnonzero(v > 0), np.flatnonzero(v < 0)) for v in self.values]
        self.most = [(max(v.max(), 0), max(-v.min(), 0)) if self.size else (0, 0) for v in self.values]

    def like(self, query: np.ndarray) -> Shard:
        """This shard in the query's kind of integers, if those are larger."""
        return Shard(self.values.T.astype(object)) if query.dtype == object != self.values.dtype else self

    def bounds(self, query: np.ndarray) -> list:
        return [int(abs(q)) * int(self.most[j][0 if q > 0 else 1]) for j, q in enumerate(query)]

    def search(self, query: np.ndarray, keep: int, threshold) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and scores of all vectors with at least the threshold,
        among them the ``keep`` best ones if so many reach it; and how many
        vectors were scored in full."""
        bounds = self.bounds(query)
        order = sorted(range(len(bounds)), key=lambda j: -bounds[j])
        # What the terms from each place on can still add.
        rest = [0]
        for j in reversed(order):
            rest.append(rest[-1] + bounds[j])
        rest.reverse()
        essential = 0
        while essential < len(order) and rest[essential] >= threshold:
            essential += 1

        sums = np.zeros(self.size, dtype=self.values.dtype if self.values.size else np.int64)
        if essential == len(order):
            # Even a vector in no posting may reach the threshold.
            found = np.arange(self.size)
        else:
            touched = np.zeros(self.size, dtype=bool)
            for j in order[:essential]:
                touched[self.postings[j][0 if query[j] > 0 else 1]] = True
            found = np.flatnonzero(touched)
        for j in order[:essential]:
            for posting in self.postings[j]:
                sums[posting] += query[j] * self.values[j][posting]
        sums = sums[found]

        if len(found) > keep and essential < len(order):
            # The full scores of the most promising raise the threshold.
            ahead = np.argpartition(-sums, keep - 1)[:keep] if sums.dtype != object else np.argsort(-sums)[:keep]
            full = sums[ahead]
            for j in order[essential:]:
                full = full + query[j] * self.values[j][found[ahead]]
            threshold = max(threshold, _bar(int(full.min())))
        for place in range(essential, len(order)):
            near = sums + rest[place] >= threshold
            if not near.all():
                found, sums = found[near], sums[near]
            sums = sums + query[order[place]] * self.values[order[place]][found]
        scored = len(found)
        near = sums >= threshold
        return found[near], sums[near], scored


def _best(ids: list, found: np.ndarray, sums: np.ndarray, keep: int) -> list[tuple]:
    """The first ``keep`` (-score, id), ties to smaller ids; each entry has
    its ids in ascending order."""
    best: list[tuple] = []
    if sums.dtype == object:
        sums = np.clip(sums, _LONG.min, _LONG.max)
    for p in np.argsort(-sums, kind="stable"):
        score = -int(sums[p])
        if len(best) >= keep and score > best[-1][0]:
            break
        best = sorted([*best, *((score, i) for i in ids[found[p]])])[:keep]
    return best


def _query_batches(uri: str) -> Iterator[pa.RecordBatch]:
    import pyarrow.dataset as ds
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(uri)
    yield from ds.dataset(path, filesystem=files, format="parquet").to_batches(batch_size=QUERIES)


def _by_length(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each length of vector."""
    values = column.to_pylist()
    sizes = np.array([len(v) for v in values])
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, np.array([values[i] for i in at], dtype=np.float64).reshape(len(at), dim)


def _least(query: np.ndarray, sample: np.ndarray | None, keep: int):
    """A score that at least ``keep`` vectors reach, or one below all."""
    if sample is None or len(sample) < keep:
        return float("-inf")
    return _bar(int(np.sort(sample @ query)[-keep]))


def _search(uri: str, keep: int, samples):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = {k: quantised(v) for k, v in samples.value.items()}

        def shard(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            all_ids = table["ids"].to_pylist()
            for at, vectors in _by_length(table["vector"]):
                ids = [all_ids[i] for i in at]
                index = Shard(quantised(vectors))
                for batch in _query_batches(uri):
                    keys = batch.column("qkey").to_pylist()
                    out = ([], [], [])
                    for rows, queries in _by_length(batch.column("vector")):
                        if queries.shape[1] != vectors.shape[1]:
                            continue
                        for key, query in zip((keys[i] for i in rows), quantised(queries)):
                            least = _least(query, sample.get(len(query)), keep)
                            found, sums, _ = index.like(query).search(query, keep, least)
                            for score, i in _best(ids, found, sums, keep):
                                for column, value in zip(out, (key, i, -score)):
                                    column.append(value)
                    if out[0]:
                        yield pa.record_batch([pa.array(x, pa.int64()) for x in out], names=["qkey", "vec_id", "score"])

        held, n = [], 0
        for batch in batches:
            while len(batch):
                take = batch.slice(0, SHARD - n)
                held.append(take)
                n += len(take)
                batch = batch.slice(len(take))
                if n == SHARD:
                    yield from shard(held)
                    held, n = [], 0
        if held:
            yield from shard(held)

    return run


def _sampled(vectors: DataFrame) -> dict[int, np.ndarray]:
    """At most ``SAMPLE`` of the distinct vectors, by length."""
    got: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vector")).limit(SAMPLE).collect():
        got.setdefault(len(r["vector"]), []).append(r["vector"])
    return {k: np.array(v, dtype=np.float64).reshape(len(v), k) for k, v in got.items()}


def search(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query row among all
    other rows."""
    spark = rows.sparkSession
    ship(spark)
    good = rows.where(usable(quoted(embedding)) & quoted(key).isNotNull())
    # Only the integers count, so vectors that become equal are one entry. They
    # travel as doubles in the original scale, which holds them exactly.
    whole = F.transform(quoted(embedding).cast("array<double>"), lambda x: _floored(x))
    vectors = good.select(quoted(key).cast("long").alias("id"), whole.alias("vector"), is_query.alias("asks"))
    asked = vectors.where("asks").groupBy("vector").agg(F.min("id").alias("qkey"))
    queries, uri = stored_at(asked, "search-queries")
    smallest = Window.partitionBy("vector").orderBy("id")
    entries = (
        vectors.select("vector", "id").withColumn("r", F.dense_rank().over(smallest)).where(F.col("r") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    )
    index = stored(entries, "search-index")
    samples = spark.sparkContext.broadcast(_sampled(index.select("vector")))
    n = max(1, spark.sparkContext.defaultParallelism, -(-index.count() // SHARD))
    dealt = index.repartition(n, F.xxhash64("vector"))
    found = dealt.mapInArrow(_search(uri, k + 1, samples), "qkey long, vec_id long, score long")
    best = found.groupBy("qkey", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("qkey").orderBy(F.col("score").desc(), "vec_id"))
    best = best.withColumn("rank", order).where(F.col("rank") <= k + 1).drop("rank")
    whose = vectors.where("asks").select("id", "vector").join(queries, "vector").select(F.col("id").alias("query_id"), "qkey").distinct()
    own = whose.join(best, "qkey").where(F.col("query_id") != F.col("vec_id"))
    own = own.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return own.withColumn("rank", order.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _floored(x: Column) -> Column:
    """floor(256 * x) / 256 without leaving doubles (zero has one sign)."""
    most = F.lit(2.0**1000)
    scaled = F.least(F.greatest(x, -most), most) * float(FACTOR)
    # From 2 ** 52 on a double has no fraction.
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled) / float(FACTOR) + 0.0


def report(rows: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    return search(rows, F.coalesce(quoted(key) % every == 0, F.lit(False)), k, key, embedding)
