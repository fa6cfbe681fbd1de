"""Phrase collocation mining by top-order marginalisation.

Only the longest windows are counted: at each word the word itself and the next
three, as lead columns padded beyond the end of the piece. A Spark ROLLUP over
(lang, w1, w2, w3, w4) then sums ever shorter prefixes, which gives the counts
of all phrases of one to four words without separate n-gram explosions.

Almost all windows of natural text are unique, and none of them can be a
candidate: every part of a phrase that occurs ``least`` times does so too. Two
passes therefore count 64-bit keys, exactly and distributed: of single words and
neighbouring pairs, then of the triples of frequent pairs. The keys that reach
``least`` are marked in sieves, bitmaps of at most ``SIEVE_BITS`` bits that are
sent to the tasks. A window is padded from the first word on with which it is in
no sieve. The sieves err to one side only: a false mark keeps a window that is
dropped after exact counting, and with more frequent keys than they can tell
apart they let more windows through; results are the same with any sieve.

Texts are read as bytes in chunks of ``CHUNK`` (a longer text is cut at a word,
the next three words are looked at from both sides), so memory does not depend
on a text's length. What follows the ROLLUP holds frequent phrases only: cuts
and their parts' counts (joins), the lowest-scoring cut, phrases that a longer
candidate covers, and the ranking, which is cut before its shuffle.

Defined results: a null text is empty, a null lang is ``und``; texts without
words add nothing; repeated rows count as often as they occur; ties in score go
to the larger count, then to the phrase's UTF-8 bytes; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strata.llm.common import quoted, ship, stored

LONGEST, LEAST, TOP = 4, 30, 2000
#: A longer candidate with this share (percent) of a phrase's count covers it.
COVER = 80
SCALE = 2_000_000
UNKNOWN = "und"
#: FIXED VALUES: bytes that end a piece, and bytes between words.
SEPARATORS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

CHUNK = 1 << 20
#: Keys that a task gathers before it counts them, rows of a batch it returns.
HELD, ROWS = 1 << 20, 1 << 15
#: The sieve has SPARE bits for a key, up to SIEVE_BITS (16 MB).
SPARE, SIEVE_BITS = 32, 1 << 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(SEPARATORS)] = 2
_TO_BLANK = bytes.maketrans(SEPARATORS + BLANKS, b" " * len(SEPARATORS + BLANKS))
_AHEAD = re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % (LONGEST - 1))
_BYTE = np.random.default_rng(13).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (all arithmetic modulo 2 ** 64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


def cuts(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``size`` bytes: the part with the next words of
    its last piece, and where its own words end. Only a word longer than that
    makes a longer part."""
    at = 0
    while len(text) - at > size:
        own = text[at : at + size].translate(_TO_BLANK).rfind(b" ") + at
        if own <= at:
            found = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]").search(text, at + size)
            if not found:
                break
            own = found.start()
        yield text[at : _AHEAD.match(text, own).end()], own - at
        at = own
    yield text[at:], len(text) - at


class Words:
    """The words of a chunk of texts as arrays: 64-bit hash, place in the
    buffer, language, whether the word is the chunk's own, and whether the next
    word belongs to the same piece."""

    def __init__(self, parts: list[tuple[bytes, int, str]]):
        self.buffer = _LOWER[np.frombuffer(b"\n".join(p[0] for p in parts), dtype=np.uint8)]
        kind = _KIND[self.buffer]
        inside = np.concatenate([[False], kind == 0, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        begin = np.cumsum([0, *(len(p[0]) + 1 for p in parts)])[:-1]
        part = np.searchsorted(begin, self.start, side="right") - 1
        self.own = self.start < (begin + np.array([p[1] for p in parts]))[part]
        self.langs = sorted({p[2] for p in parts})
        at = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([at[p[2]] for p in parts])[part]
        piece = np.cumsum(kind == 2)[self.start] if len(self.start) else self.start
        self.joined = np.append(piece[1:] == piece[:-1], False)[: len(self.start)]
        self.hash = self._hashes(inside[1:-1])

    def _hashes(self, inside: np.ndarray) -> np.ndarray:
        sizes = self.end - self.start
        if not len(sizes):
            return np.zeros(0, dtype=np.uint64)
        first = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(first, sizes)
        power = np.cumprod(np.full(sizes.max(), _BASE))
        summed = np.add.reduceat(_BYTE[self.buffer[inside]] * power[place], first)
        return _mix(summed + sizes.astype(np.uint64))

    def singles(self) -> np.ndarray:
        """The sieve's key of each word in its language."""
        salt = np.array([_salt(x) for x in self.langs], dtype=np.uint64)
        return _mix(self.hash ^ salt[self.lang]) if len(self.hash) else self.hash

    def pairs(self) -> np.ndarray:
        """The sieve's key of each word with the next one (of any piece)."""
        one = self.singles()
        after = np.append(self.hash[1:], np.uint64(0))[: len(one)]
        return _mix(one * np.uint64(3) + _mix(after + _BASE))

    def triples(self) -> np.ndarray:
        """The sieve's key of each word with the next two (of any piece)."""
        two = self.pairs()
        after = np.append(self.hash[2:], np.zeros(2, dtype=np.uint64))[: len(two)]
        return _mix(two * np.uint64(5) + _mix(after + _BASE))

    def text(self, i: np.ndarray) -> pa.Array:
        return pa.array([self.buffer[a:b].tobytes() for a, b in zip(self.start[i], self.end[i])], pa.binary()).cast(pa.string())


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of (lang, text) batches, about ``CHUNK`` bytes at a time."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang"), texts):
            for part, own in cuts(text.as_py(), CHUNK):
                held.append((part, own, lang.as_py()))
                size += len(part) + 1
                if size >= CHUNK:
                    yield Words(held)
                    held, size = [], 0
    if held:
        yield Words(held)


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(batch), ROWS):
        yield batch.slice(i, ROWS)


def _count_keys(pairs=None):
    """Keys of single words and pairs with their numbers; with the pairs' sieve,
    those of the triples of frequent pairs."""

    def keys_of(words: Words) -> list[np.ndarray]:
        if pairs is None:
            return [words.singles()[words.own], words.pairs()[words.own & words.joined]]
        good = words.joined & _in(pairs.value, words.pairs())
        return [words.triples()[words.own & good & _lead(good, 1)]]

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for words in chunks(batches):
            held += keys_of(words)
            size = sum(map(len, held))
            if size >= HELD:
                yield from _sliced(counted(held))
                held, size = [], 0
        if held:
            yield from _sliced(counted(held))

    return run


def _in(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64(len(sieve) * 64 - 1)
    return (sieve[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _lead(x: np.ndarray, k: int) -> np.ndarray:
    return np.append(x[k:], np.zeros(k, dtype=x.dtype))[: len(x)]


def _windows(pairs, triples):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in chunks(batches):
            if not len(words.hash):
                continue
            _, first, word = np.unique(words.hash, return_index=True, return_inverse=True)
            word = word + 1  # 0 pads
            two = words.joined & _in(pairs.value, words.pairs())
            three = two & _lead(two, 1) & _in(triples.value, words.triples())
            fits = _in(pairs.value, words.singles())
            column = [np.where(fits, word, 0)]
            for k, goes_on in ((1, two), (2, three), (3, _lead(three, 1))):
                fits = fits & goes_on
                column.append(np.where(fits, _lead(word, k), 0))
            # Two numbers stand for a window; equal ones are counted here.
            wide = len(first) + 1
            rows = np.flatnonzero(words.own)
            a = ((words.lang * wide + column[0]) * wide + column[1])[rows]
            b = (column[2] * wide + column[3])[rows]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))[: len(a)]
            n = np.diff(np.append(new, len(a)))
            at = rows[order[new]]
            used = np.unique(np.concatenate([c[at] for c in column]))
            names = pa.concat_arrays([pa.array([""]), words.text(first[used[used > 0] - 1])])
            place = np.zeros(wide, dtype=np.int64)
            place[used[used > 0]] = np.arange(1, (used > 0).sum() + 1)
            # Words hold no blanks, so a window is one string; padding falls off.
            joined = pc.utf8_rtrim(pc.binary_join_element_wise(*[names.take(pa.array(place[c[at]])) for c in column], " "), " ")
            langs = pa.array(words.langs).take(pa.array(words.lang[at]))
            yield from _sliced(pa.record_batch([langs, joined, pa.array(n.astype(np.int64))], names=["lang", "window", "n"]))

    return run


_W = [f"w{k + 1}" for k in range(LONGEST)]


def _sieve(frequent: DataFrame) -> np.ndarray:
    """The bitmap of the frequent keys, put together by Spark; what reaches the
    driver is bounded by SIEVE_BITS."""
    n = frequent.count()
    bits = 1 << 16
    while bits < min(SPARE * n, SIEVE_BITS):
        bits *= 2
    bit = F.col("key").bitwiseAND(F.lit(bits - 1))
    slots = frequent.groupBy(F.shiftright(bit, 6).alias("slot")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast((key & {bits - 1}L) & 63L as int)))").alias("marks")
    )
    got = slots.toArrow()
    sieve = np.zeros(bits // 64, dtype=np.uint64)
    sieve[got["slot"].to_numpy()] = got["marks"].to_numpy().view(np.uint64)
    return sieve


def phrases(docs: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, k, words, phrase, a) of every phrase of one to four words that
    occurs at least ``least`` times in its language, and (lang, n), the number
    of word occurrences."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.coalesce(quoted(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(quoted(text), F.lit("")).alias("text")
    ).where(F.col("text") != "")

    def sieve(of, name: str):
        keys = texts.mapInArrow(of, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        return spark.sparkContext.broadcast(_sieve(stored(keys.where(F.col("n") >= least).select("key"), name)))

    pairs = sieve(_count_keys(), "frequent-pairs")
    triples = sieve(_count_keys(pairs), "frequent-triples")
    # Windows are summed as strings first: what the ROLLUP expands is small.
    windows = texts.mapInArrow(_windows(pairs, triples), "lang string, window string, n long")
    windows = windows.groupBy("lang", "window").agg(F.sum("n").alias("n")).withColumn("ws", F.split("window", " "))
    windows = windows.select("lang", *[F.coalesce(F.get("ws", F.lit(k)), F.lit("")).alias(w) for k, w in enumerate(_W)], "n")
    # The grouping id tells a column that ROLLUP left out from padding.
    level = F.lit(LONGEST) - F.bit_count(F.grouping_id())
    sums = windows.rollup("lang", *_W).agg(F.sum("n").alias("a"), level.cast("int").alias("k"))
    last = F.get(F.array(*_W), F.col("k") - 1)
    wanted = (F.col("k") == 0) | ((F.col("k") > 0) & (last != "") & (F.col("a") >= least))
    counted = stored(sums.where(wanted), "phrase-counts")
    words = F.slice(F.array(*_W), 1, F.col("k"))
    listed = counted.where("k > 0").select("lang", "k", words.alias("words"), F.array_join(words, " ").alias("phrase"), "a")
    return listed, counted.where("k = 0").select("lang", F.col("a").alias("n"))


def _exact(x: str) -> Column:
    return F.col(x).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases."""
    listed, totals = phrases(docs, least, text, lang)
    count = listed.select("lang", "phrase", "a")
    pairs = listed.where("k > 1")

    parted = pairs.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ").alias("rest"),
    )
    left = count.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = count.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = parted.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr(f"({SCALE} * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c"))

    # Phrases inside longer candidates, with the longest one's greatest count.
    spots = F.expr(f"filter(flatten(transform(sequence(2, {LONGEST - 1}), m -> transform(sequence(1, {LONGEST - 1}), "
                   "i -> struct(i as i, m as m)))), s -> s.m < k and s.i + s.m - 1 <= k)")
    inner = listed.where("k > 2").select("lang", "words", "a", F.explode(spots).alias("s")).select(
        "lang", F.array_join(F.slice("words", F.col("s.i"), F.col("s.m")), " ").alias("phrase"), "a"
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = lowest.join(covered, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact("longer") < COVER * _exact("a"))
    )

    order = Window.partitionBy("lang").orderBy(F.col("c.score").desc(), F.col("a").desc(), "phrase")
    best = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n",
        F.col("c.score").cast("long").alias("score"),
    )
