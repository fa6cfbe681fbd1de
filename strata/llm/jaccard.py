"""N-gram Jaccard join by vertical partitioning.

A document is the set of its 5-word shingles (64-bit hashes). The global order
of all shingles is cut into fragments, and what two documents, or a document
and all others, share is counted in each fragment apart and summed.

1. Each text gives its set size and a digest of its set. Documents with equal
   sets form a class; from here on there is one set per class.
2. Every class sends each fragment its part of the set, packed. A fragment
   counts in how many classes each shingle occurs. The shingles found in two
   classes or more go back to the class, with their frequency. A class in which
   fewer than 80 % of the shingles are shared cannot have a partner and ends
   here. Shingles in a noticeable share of all documents are known from a
   bounded list, skip the counting and are spread evenly. A fragment that
   swells beyond a task's memory (under a shingle too rare for the list, in a
   very large table) hands all its shingles back as if they were listed: they
   are ordered last, which tells fewer classes apart, but loses none.
3. Of what remains, rarest shingles first, two partners must agree on one of
   the first 20 %. Under each such shingle, every class is paired with the
   smallest one; the pairs' partial overlaps are counted per vertical part and
   summed. Links give components.
4. Only shingles whose other classes still lie in different components are
   looked at again, together for each smallest class: all pairs are counted, in
   blocks of bounded size, inside tasks, and only links that join components
   come out.

So no link between different sets is lost, pairs inside a component found by
step 3 are never enumerated, and no task or row holds a whole group.

Defined results: a null text, or one without words, has the empty set, links
with nothing and is its own component; fewer than five words are one shingle;
repeated rows share a class; a null key is never the smallest (a component of
null keys only has a null id); an empty table gives an empty result; extra
columns are ignored by ``report`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, free_name, quoted, ship, stored
from strata.llm.components import components

WIDTH, PERCENT = 5, 80
#: Shingles per fragment (up to half as many more), bytes of text handled at a time.
FRAGMENT, CHUNK = 2 << 20, 4 << 20
#: A fragment that grows beyond this many times its size is not counted.
SWOLLEN = 4
#: Classes and shingles per block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: A shingle in more than this share of the documents is listed as frequent;
#: the list has at most (mean set size / share) entries.
FREQUENT, LEAST_FREQUENT = 1 / 500, 64
#: Tasks over which the rows of a listed shingle are spread.
SPREAD = 64
#: Vertical parts in which the overlap of a pair is counted.
PARTS = 4

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; the texts' UTF-8 lies in
    ``data`` between consecutive offsets."""
    n = len(offsets) - 1
    if not len(data):
        return [np.zeros(0, np.uint64)] * n
    inside = ~_SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    if not len(start):
        return [np.zeros(0, np.uint64)] * n
    letters = _LOWER[data[inside]].astype(np.uint64)
    # Word borders among the letters alone.
    first = np.cumsum(inside)[start] - 1
    length = np.diff(np.append(first, len(letters)))
    power = np.cumprod(np.full(int(length.max()), _A, dtype=np.uint64))
    place = np.arange(len(letters)) - np.repeat(first, length)
    word = _mix(np.add.reduceat((letters + np.uint64(1)) * power[place], first) + length.astype(np.uint64) * _C)
    at = np.searchsorted(start, offsets)
    rolled = word[: max(0, len(word) - WIDTH + 1)].copy()
    for k in range(1, WIDTH):
        rolled = rolled * _A + word[k : k + len(rolled)]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= WIDTH:
            s = np.sort(rolled[a : b - WIDTH + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            h = np.array([b - a], dtype=np.uint64)
            for i in range(a, b):
                h = h * _B + word[i : i + 1]
            out.append(_mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) for runs of texts of about ``CHUNK`` bytes."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, side="right")) - 1)
        yield a, _sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        a = b


def class_id(s: np.ndarray) -> bytes:
    """96 bits of digest and the set's size; empty for the empty set."""
    return hashlib.blake2b(s.tobytes(), digest_size=12).digest() + len(s).to_bytes(4, "big") if len(s) else b""


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, tie, text) to (key, tie, n, class), and frequent shingles of each
    run of texts as (shingle, times)."""
    for batch in batches:
        for a, sets in shingle_sets(batch.column(2)):
            ids = [class_id(s) for s in sets]
            m = len(sets)
            once = {c: s for c, s in zip(ids, sets) if c}
            least = max(4, int(FREQUENT * m))
            every = np.sort(np.concatenate(list(once.values()))) if once else np.zeros(0, np.uint64)
            far = np.flatnonzero(every[least - 1 :] == every[: max(0, len(every) - least + 1)])
            shingle, times = np.unique(every[far], return_counts=True)
            times = times + least - 1
            k = len(shingle)
            yield pa.record_batch(
                [
                    pa.concat_arrays([batch.column(0).slice(a, m), pa.nulls(k, batch.column(0).type)]),
                    pa.concat_arrays([batch.column(1).slice(a, m), pa.nulls(k, pa.int64())]),
                    pa.array([len(s) for s in sets] + [None] * k, pa.int64()),
                    pa.array(ids + [None] * k, pa.binary()),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(shingle.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(times.astype(np.int64))]),
                ],
                names=["key", "tie", "n", "class", "shingle", "times"],
            )


def _shift(fragments: int) -> int:
    """Fragments are a power of two: a hash shifted by so many bits is its
    fragment, and the lower bits are all that has to travel with it."""
    return 64 - (fragments.bit_length() - 1)


def _low(h: np.ndarray, shift: int) -> bytes:
    """The bytes of each hash that hold its lower ``shift`` bits."""
    wide = -(-shift // 8)
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]).tobytes()


def _unlow(b: bytes, shift: int) -> np.ndarray:
    wide = -(-shift // 8)
    out = np.zeros((len(b) // wide, 8), dtype=np.uint8)
    out[:, :wide] = np.frombuffer(b, dtype=np.uint8).reshape(-1, wide)
    return out.view("<u8").reshape(-1)


def _whole(low: np.ndarray, fragment: np.ndarray, shift: int) -> np.ndarray:
    """The hashes again. (Bits that both parts hold are the same.)"""
    return low if shift == 64 else low | (fragment << np.uint64(shift))


PACKED = "fragment int, classes binary, counts binary, low binary"


def _deal(fragments: int, frequent):
    """Texts to their classes' parts of the fragments, packed per run of texts.
    Listed frequent shingles go to fragment numbers beyond the others, spread
    by the run's first class, so that one shingle's rows meet in no one task."""

    shift = _shift(fragments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = frequent.value
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0)):
                once = {c: s for c, s in ((class_id(s), s) for s in sets) if c}
                if not once:
                    continue
                ids = np.frombuffer(b"".join(once), dtype=np.uint8).reshape(-1, 16)
                size = np.array([len(s) for s in once.values()])
                h = np.concatenate(list(once.values()))
                owner = np.repeat(np.arange(len(size)), size)
                part = (h >> np.uint64(shift)).astype(np.int32) if shift < 64 else np.zeros(len(h), dtype=np.int32)
                if len(listed):
                    at = np.searchsorted(listed, h)
                    hot = listed[np.minimum(at, len(listed) - 1)] == h
                    part[hot] += fragments * (1 + int(ids[0, 0]) % SPREAD)
                order = np.argsort(part, kind="stable")
                part, h, owner = part[order], h[order], owner[order]
                cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                rows = ([], [], [], [])
                for a, b in zip(cut, np.append(cut[1:], len(part))):
                    who, count = np.unique(owner[a:b], return_counts=True)
                    for column, value in zip(rows, (int(part[a]), ids[who].tobytes(), count.astype("<u4").tobytes(), _low(h[a:b], shift))):
                        column.append(value)
                yield pa.record_batch([pa.array(rows[0], pa.int32()), *[pa.array(c, pa.binary()) for c in rows[1:]]], names=["fragment", "classes", "counts", "low"])

    return run


SHARED = "bucket int, fragment int, classes binary, counts binary, low binary, often binary"
_SHARED_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one value of a sorted column, together."""
    now, held = None, []
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
            # Lists stay in Arrow's buffers; as Python's numbers they are large.
            row = {k: v.values.to_numpy() if isinstance(v, pa.ListScalar) else v.as_py() for k, v in zip(names, row)}
            value = row[names[column]]
            if held and value != now:
                yield now, held
                held = []
            now = value
            held.append(row)
    if held:
        yield now, held


def _words64(ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(ids, dtype=">u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def _count(fragments: int, buckets: int, most: int):
    """One fragment: how many classes hold each shingle. What two or more hold
    goes back to the classes, packed per bucket of classes."""
    shift = _shift(fragments)

    def emit(fragment, c0, c1, count, h, often):
        bucket = (c0 % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        begin = (np.cumsum(count) - count)[order]
        bucket, c0, c1, count = bucket[order], c0[order], c1[order], count[order]
        # Positions of the classes' shingles in the new order of classes.
        element = np.arange(len(h)) + np.repeat(begin - (np.cumsum(count) - count), count)
        h, often = h[element], often[element]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        at = np.concatenate([[0], np.cumsum(count)])
        rows = tuple([] for _ in _SHARED_TYPES)
        for a, b in zip(cut, np.append(cut[1:], len(bucket))):
            ids = np.stack([c0[a:b], c1[a:b]], axis=1).astype(">u8").tobytes()
            x, y = at[a], at[b]
            for column, value in zip(rows, (int(bucket[a]), fragment, ids, count[a:b].astype("<u4").tobytes(), _low(h[x:y], shift), often[x:y].tobytes())):
                column.append(value)
        return pa.record_batch([pa.array(c, t) for c, t in zip(rows, _SHARED_TYPES)], names=[x.split(" ")[0] for x in SHARED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, swollen in _parts(batches, fragments, most * -(-shift // 8)):
            c0, c1 = _words64(b"".join(r[0] for r in rows))
            count = np.frombuffer(b"".join(r[1] for r in rows), dtype="<u4").astype(np.int64)
            h = np.concatenate([_unlow(r[2], shift) for r in rows])
            rows.clear()
            # A class comes once for each run of texts that has a copy of it.
            order = np.lexsort((c1, c0))
            again = np.zeros(len(c0), dtype=bool)
            again[order[1:]] = (c0[order[1:]] == c0[order[:-1]]) & (c1[order[1:]] == c1[order[:-1]])
            if again.any():
                h = h[np.repeat(~again, count)]
                c0, c1, count = c0[~again], c1[~again], count[~again]
            if swollen or number >= fragments:
                yield emit(number % fragments, c0, c1, count, h, np.full(len(h), 255, dtype=np.uint8))
                continue
            order = np.argsort(h)
            s = h[order]
            new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            run_length = np.diff(np.append(new, len(s)))
            often = np.empty(len(h), dtype=np.uint8)
            often[order] = np.repeat(np.minimum(run_length, 254), run_length).astype(np.uint8)
            shared = often > 1
            owner = np.repeat(np.arange(len(count), dtype=np.int32), count)
            left = np.bincount(owner[shared], minlength=len(count))
            some = left > 0
            if some.any():
                yield emit(number, c0[some], c1[some], left[some], h[shared], often[shared])

    return run


def _parts(batches: Iterator[pa.RecordBatch], fragments: int, most: int) -> Iterator[tuple[int, list, bool]]:
    """Rows (classes, counts, low) of one fragment, and whether its shingles take
    more than ``most`` bytes. Only counting needs to see a fragment whole; rows of
    listed shingles, and of a fragment once it has too many, are handed on."""
    now, held, size, swollen = None, [], 0, False
    for batch in batches:
        for i, f in enumerate(batch.column(0).to_pylist()):
            if held and (f != now or f >= fragments):
                yield now, held, swollen
                held, size = [], 0
            if f != now:
                now, size, swollen = f, 0, False
            held.append(tuple(batch.column(c)[i].as_py() for c in (1, 2, 3)))
            size += len(held[-1][2])
            if size > most and f < fragments:
                swollen = True
                yield now, held, True
                held, size = [], 0
    if held:
        yield now, held, swollen


KEPT = "class binary, n int, prefix array<bigint>, parts array<array<bigint>>"


def _assemble(fragments: int):
    """One bucket of classes: their shared shingles, rarest first. Classes with
    too few of them end here."""
    shift = _shift(fragments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 0):
            c0, c1 = _words64(b"".join(r["classes"] for r in rows))
            count = np.frombuffer(b"".join(r["counts"] for r in rows), dtype="<u4").astype(np.int64)
            low = np.concatenate([_unlow(r["low"], shift) for r in rows])
            name = np.repeat(np.array([r["fragment"] for r in rows], dtype=np.uint64), [len(r["often"]) for r in rows])
            often = np.frombuffer(b"".join(r["often"] for r in rows), dtype=np.uint8)
            rows.clear()
            order = np.lexsort((c1, c0))
            new = np.concatenate([[True], (c0[order[1:]] != c0[order[:-1]]) | (c1[order[1:]] != c1[order[:-1]])])
            number = np.empty(len(c0), dtype=np.int64)
            number[order] = np.cumsum(new) - 1
            first = order[np.flatnonzero(new)]
            n = (c1[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            owner = np.repeat(number, count)
            # Copies of a class in several runs of texts each sent the listed ones.
            hot = np.flatnonzero(often == 255)
            if len(hot):
                order = hot[np.lexsort((low[hot], name[hot], owner[hot]))]
                same = (owner[order[1:]] == owner[order[:-1]]) & (low[order[1:]] == low[order[:-1]]) & (name[order[1:]] == name[order[:-1]])
                once = np.ones(len(owner), dtype=bool)
                once[order[1:][same]] = False
                owner, low, name, often = owner[once], low[once], name[once], often[once]
            shared = np.bincount(owner, minlength=len(first))
            stays = 100 * shared >= PERCENT * n
            keep = stays[owner]
            owner, often = owner[keep], often[keep]
            shingle = _whole(low[keep], name[keep], shift).view(np.int64)
            order = np.lexsort((shingle, often, owner))
            owner, shingle = owner[order], shingle[order]
            part = (low[keep][order] >> np.uint64(46)).astype(np.int64) % PARTS
            at = np.searchsorted(owner, np.arange(len(first) + 1))
            out = ([], [], [], [])
            for c in np.flatnonzero(stays):
                s, p = shingle[at[c] : at[c + 1]], part[at[c] : at[c + 1]]
                size = int(n[c])
                unshared = size - len(s)
                lead = size - -(-PERCENT * size // 100) + 1 - unshared
                ids = np.array([c0[first[c]], c1[first[c]]], dtype=np.uint64).astype(">u8").tobytes()
                for column, value in zip(out, (ids, size, s[:lead], [s[p == k] for k in range(PARTS)])):
                    column.append(value)
                if len(out[0]) >= 2000:
                    yield _kept_batch(out)
                    out = ([], [], [], [])
            if out[0]:
                yield _kept_batch(out)

    return run


def _kept_batch(out) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    return pa.record_batch(
        [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], longs), pa.array(out[3], pa.list_(longs))],
        names=["class", "n", "prefix", "parts"],
    )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections. Shingles are cut into fragments by how many
    sets hold them; each fragment's counts are added to the sum."""
    k = len(sets)
    total = np.zeros((k, k), dtype=np.float32)
    owner = np.repeat(np.arange(k), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    held = np.diff(np.append(new, len(values)))
    for c in np.unique(held[held > 1]):
        if c <= 16:
            rows = owner[new[held == c][:, None] + np.arange(c)]
            for i in range(c):
                for j in range(i + 1, c):
                    total += np.bincount(rows[:, i] * k + rows[:, j], minlength=k * k).reshape(k, k) if k <= 64 else 0
                    if k > 64:
                        np.add.at(total, (rows[:, i], rows[:, j]), 1)
        else:
            begins = new[held == c]
            for s in range(0, len(begins), 2048):
                rows = owner[begins[s : s + 2048, None] + np.arange(c)]
                m = np.zeros((k, len(rows)), dtype=np.float32)
                m[rows, np.arange(len(rows))[:, None]] = 1
                total += np.triu(m @ m.T, 1)
    return total + total.T


def _link_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, class, root, shingles), sorted by group, to links (a, b)
    between different roots; links that join nothing new are left out."""
    for _, rows in _groups(batches, 0):
        n = np.array([int.from_bytes(r["class"][12:], "big") for r in rows], dtype=np.float64)
        both = _overlaps([r["shingles"] for r in rows])
        i, j = np.nonzero(np.triu(100 * both >= PERCENT * (n[:, None] + n[None] - both), 1))
        top: dict[bytes, bytes] = {}

        def find(x):
            while x in top:
                x = top[x]
            return x

        links = []
        for x, y in zip(i, j):
            a, b = find(rows[x]["root"]), find(rows[y]["root"])
            if a != b:
                top[b] = a
                links.append((rows[x]["root"], rows[y]["root"]))
        if links:
            yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*links)], names=["a", "b"])


def _fits(a, b):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _size(c):
    return F.conv(F.hex(F.substring(c, 13, 4)), 16, 10).cast("long")


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Stored (key, tie, n, class) per row, and the list of frequent shingles."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(quoted(key).alias("key"), F.xxhash64(quoted(text)).alias("tie"), quoted(text).alias("text"))
    got = stored(rows.mapInArrow(_measure, f"key {kind}, tie long, n long, class binary, shingle long, times long"), "shingle-sets")
    own = got.where(F.col("shingle").isNull()).select("key", "tie", "n", "class")
    frequent = got.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("times").alias("times"))
    return own, frequent


def linked(docs: DataFrame, own: DataFrame, frequent: DataFrame, text: str = "text") -> DataFrame:
    """(node, root): the components of all classes that link with another."""
    spark = docs.sparkSession
    classes = own.where(F.col("n") > 0).groupBy("class").agg(F.first("n").alias("n"))
    count, total = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    fragments = 1
    while fragments * FRAGMENT * 3 < total * 2:
        fragments *= 2
    # At most (mean set size / FREQUENT) entries.
    often = frequent.where(F.col("times") >= max(LEAST_FREQUENT, FREQUENT * count)).select("shingle").collect()
    listed = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in often], dtype=np.int64).view(np.uint64)))
    dealt = docs.select(quoted(text).alias("text")).mapInArrow(_deal(fragments, listed), PACKED)
    counted = dealt.repartition("fragment").sortWithinPartitions("fragment").mapInArrow(_count(fragments, fragments, SWOLLEN * FRAGMENT), SHARED)
    kept = stored(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_assemble(fragments), KEPT), "shared-sets")

    # Shingles of the prefixes; groups with the same members count once.
    under = kept.select("class", "n", F.explode("prefix").alias("z"))
    groups = (
        under.groupBy("z").agg(F.count("*").alias("k"), F.min("class").alias("leader"), F.bit_xor(F.xxhash64("class")).alias("x"))
        .where("k > 1").groupBy("k", "leader", "x").agg(F.min("z").alias("z"))
    )
    members = stored(
        under.join(groups.select("z", "k", "leader"), "z").where(F.col("class") != F.col("leader")).select("z", "k", "leader", "class", "n"), "groups"
    )
    pairs = members.where(_fits(F.col("n"), _size(F.col("leader")))).select("leader", "class", "n").distinct()
    cut = kept.select("class", F.posexplode("parts").alias("part", "shingles"))
    theirs = cut.select(F.col("class").alias("leader"), "part", F.col("shingles").alias("theirs"))
    partial = pairs.join(cut, "class").join(theirs, ["leader", "part"]).select(
        "leader", "class", "n", F.size(F.array_intersect("shingles", "theirs")).alias("same")
    )
    overlap = partial.groupBy("leader", "class", "n").agg(F.sum("same").alias("same"))
    union = F.col("n") + _size(F.col("leader")) - F.col("same")
    links = stored(overlap.where(100 * F.col("same") >= PERCENT * union).select(F.col("leader").alias("a"), F.col("class").alias("b")), "pairs")
    roots = stored(components(links), "roots")

    # Groups whose members, without the leader, lie in several components. The
    # groups of one leader are looked at together, so that a class is sent once
    # for each leader and not once for each shingle.
    rooted = members.where("k > 2").join(roots, F.col("class") == F.col("node"), "left").select(
        "z", "leader", "class", F.coalesce("root", "class").alias("root")
    )
    mixed = rooted.groupBy("z").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("z")
    bundles = stored(rooted.join(mixed, "z").select("leader", "class", "root").distinct(), "bundles")
    blocks = F.greatest(F.ceil(F.col("k") / BLOCK), F.ceil(F.col("held") / BLOCK_SHINGLES)).cast("int")
    mine = F.pmod(F.xxhash64("class"), blocks).cast("int")
    # A class of block b goes to the block pairs (b, i) and (i, b).
    spread = (
        bundles.join(bundles.groupBy("leader").agg(F.count("*").alias("k"), F.sum(_size(F.col("class"))).alias("held")), "leader")
        .withColumn("i", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(F.concat_ws("/", F.hex("leader"), F.least(mine, "i").cast("string"), F.greatest(mine, "i").cast("string")).alias("group"), "class", "root")
    )
    shipped = spread.join(kept.select("class", F.flatten("parts").alias("shingles")), "class").select("group", "class", "root", "shingles")
    more = shipped.repartition("group").sortWithinPartitions("group").mapInArrow(_link_blocks, "a binary, b binary")
    top = stored(components(more), "tops")
    first = roots.unionAll(stored(more_nodes(top, roots), "lone"))
    return first.join(top.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def more_nodes(top: DataFrame, roots: DataFrame) -> DataFrame:
    """Classes that only the second search linked, as their own roots."""
    return top.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))


def grouped(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Stored (key, tie, n, group) per row: equal groups are linked. Rows of
    the empty set have a null group."""
    own, frequent = measured(docs, text, key)
    roots = linked(docs, own, frequent, text)
    return stored(
        own.join(roots, F.col("class") == F.col("node"), "left")
        .select("key", "tie", "n", F.when(F.col("n") > 0, F.coalesce("root", "class")).alias("group")),
        "grouped",
    )


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    got = grouped(docs, text, key)
    least = stored(got.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("key").alias("least")), "least")
    joined = got.where(F.col("group").isNotNull()).join(least, "group").select("key", "n", "least")
    alone = got.where(F.col("group").isNull()).select("key", "n", F.col("key").alias("least"))
    return joined.unionAll(alone).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest key, then of
    the smallest text hash; of rows that agree in both, any one. Rows without a
    word all stay."""
    got = grouped(docs, text, key).where(F.col("group").isNotNull())
    best = got.groupBy("group").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tie")).alias("best"))
    tie, its_key, its_tie = (free_name(docs, x) for x in ("tie", "key_", "tie_"))
    best = best.select(F.col("best.key").alias(its_key), F.col("best.tie").alias(its_tie))
    worded = F.coalesce(quoted(text).rlike(WORD), F.lit(False))
    mine = docs.where(worded).withColumn(tie, F.xxhash64(quoted(text))).alias("d").join(
        best, (F.col(f"d.`{tie}`") == F.col(its_tie)) & F.col(f"d.`{key}`").eqNullSafe(F.col(its_key))
    )
    once = mine.dropDuplicates([its_tie, its_key]).select(*[F.col(f"d.`{c}`") for c in docs.columns])
    return once.unionAll(docs.where(~worded))
