"""Cost-balanced packing of token sequences.

Texts are tokenised once, in the tasks that read them, and cut into blocks of
``capacity`` ids; the last block of a document is shorter. All pieces go through
one shuffle by a hash of the piece, and each partition is packed in windows of
``WINDOW`` pieces, so memory does not depend on the data. A full block is a
sequence by itself. The others are assigned in descending order of their cost
(linear plus quadratic attention cost) to the open sequence of lowest cost that
has room; a piece that fits nowhere is cut at the sequence with most room. A
window opens no more sequences than its tokens need, so it pads less than one
sequence.

Sequence ids are the partition's number and a count, so a task that is run
again gives the same ids. A token id takes two bytes in the shuffle when the
vocabulary allows it.

Defined results: a null text is empty (only the closing id); an empty text
likewise; repeated rows are packed as separate documents; a null key is kept;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import quoted, ship

CAPACITY = 1024
CLOSING_ID = 0
WINDOW = 4096
#: Relative cost of a token and of a pair of tokens in the same piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Words whose ids a worker remembers.
CACHE = 150_000

#: FIXED VALUES: letters of the characters that the quick path knows.
LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
#: FIXED VALUES: the byte-level pre-tokeniser's split, for those characters.
SPLIT = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
ODD = re.compile(rf"[^\x00-\x1b\x20-\x7e{LETTERS}]")


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, equal to those of the
    tokenizers file. Byte-level BPE encodes each split word by itself, so words
    are encoded once and remembered. Texts with other characters, and other
    kinds of tokenizer, take the library's own path."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.words = self._word_encoder(spec)
        self.vocab_size = 1 + max(spec["model"]["vocab"].values()) if self.words else self.whole.get_vocab_size()
        self.cache: dict[str, bytes] = {}

    @functools.cached_property
    def whole(self):
        # Loaded only for texts that need it.
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _word_encoder(self, spec: dict):
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = model["type"] == "BPE" and not spec.get("normalizer") and not model.get("dropout") and not model.get("byte_fallback")
        if not plain or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return None
        # Ranks need ids that grow with the order of the merges.
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            return None
        import tiktoken

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = set(self.added)
        ranks = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("words", pat_str=split, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if self.words is None or ODD.search(text) or any(t in text for t in self.added):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        parts = SPLIT.findall(text)
        cache = self.cache
        for w in parts:
            if w not in cache:
                if len(cache) >= CACHE:
                    cache.clear()
                    return self(text) if len(set(parts)) < CACHE else self._uncached(parts)
                cache[w] = np.asarray(self.words(w), dtype="<u4").tobytes()
        return b"".join([cache[w] for w in parts])

    def _uncached(self, parts: list[str]) -> bytes:
        return b"".join(np.asarray(self.words(w), dtype="<u4").tobytes() for w in parts)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _cut(path: str, capacity: int, closing: int):
    """Tasks that turn (key, text) into (key, start, length, ids, doc_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        narrow = "<u2" if encode.vocab_size <= 1 << 16 and closing < 1 << 16 else "<u4"
        end = np.array([closing], dtype="<u4").tobytes()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at, rows, held = [], ([], [], [], []), 0

            def out():
                start, length, ids, total = rows
                return pa.record_batch(
                    [keys.take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                    names=["key", "start", "length", "ids", "doc_tokens"],
                )

            for i in range(len(texts)):
                ids = np.frombuffer(encode(texts[i].as_py() or "") + end, dtype="<u4").astype(narrow)
                for s in range(0, len(ids), capacity):
                    part = ids[s : s + capacity]
                    at.append(i)
                    for column, value in zip(rows, (s, len(part), part.tobytes(), len(ids))):
                        column.append(value)
                    held += part.nbytes
                if held > 8 << 20:
                    yield out()
                    at, rows, held = [], ([], [], [], []), 0
            if at:
                yield out()

    return run


def assign(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces of the given lengths: (piece, first id of it, ids, sequence,
    offset). Pieces are taken in descending order of cost."""
    cost = LINEAR * lengths + QUADRATIC * lengths.astype(float) ** 2
    n = int(-(-lengths.sum() // capacity))
    load, room = np.zeros(n), np.full(n, capacity, dtype=np.int64)
    out = []
    for i in np.argsort(-cost, kind="stable"):
        done, left = 0, int(lengths[i])
        while left:
            fits = np.where(room >= left, load, np.inf)
            q = int(fits.argmin())
            if room[q] < left:
                q = int(room.argmax())
            k = min(left, int(room[q]))
            out.append((int(i), done, k, q, capacity - int(room[q])))
            room[q] -= k
            load[q] += LINEAR * k + QUADRATIC * k * k
            done, left = done + k, left - k
    return out


def _pack(capacity: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 36
        count = 0

        def packed(held: list[pa.RecordBatch]):
            nonlocal count
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = table["length"].to_numpy().astype(np.int64)
            full = np.flatnonzero(lengths == capacity)
            part = np.flatnonzero(lengths < capacity)
            places = [(int(i), 0, capacity, q, 0) for q, i in enumerate(full)]
            places += [(int(part[i]), d, k, len(full) + q, o) for i, d, k, q, o in assign(lengths[part], capacity)]
            piece, done, size, seq, offset = (np.array(x, dtype=np.int64) for x in zip(*places))
            base, w = first + count, 4 if wide else 2
            count += int(seq.max()) + 1
            for s in range(0, len(piece), 1024):
                e = s + 1024
                taken = table.take(pa.array(piece[s:e])).combine_chunks()
                ids = [
                    np.frombuffer(b.as_py()[d * w : (d + k) * w], dtype=f"<u{w}").astype("<u4").tobytes()
                    for b, d, k in zip(taken["ids"], done[s:e], size[s:e])
                ]
                columns = [taken["key"].combine_chunks(), pa.array(taken["start"].to_numpy() + done[s:e]), pa.array(size[s:e]), pa.array(ids, pa.binary()),
                           taken["doc_tokens"].combine_chunks(), pa.array(base + seq[s:e]), pa.array(offset[s:e])]
                yield pa.record_batch(columns, names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        held, n = [], 0
        for batch in batches:
            while len(batch):
                take = batch.slice(0, WINDOW - n)
                held.append(take)
                n += len(take)
                batch = batch.slice(len(take))
                if n == WINDOW:
                    yield from packed(held)
                    held, n = [], 0
        if held:
            yield from packed(held)

    return run


def pack(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
         closing: int = CLOSING_ID) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset) per piece;
    ``ids`` are little-endian unsigned 32-bit. ``tokenizer`` is the path of a
    tokenizers file that every executor has."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    pieces = docs.select(quoted(key).alias("key"), quoted(text).alias("text")).mapInArrow(
        _cut(tokenizer, capacity, closing), f"key {kind}, start long, length int, ids binary, doc_tokens long"
    )
    dealt = pieces.repartition(order := F.xxhash64("key", "start", "doc_tokens", F.crc32("ids"))).sortWithinPartitions(order, "key", "start")
    wide = encoder(tokenizer).vocab_size > 1 << 16 or closing >= 1 << 16
    packed = dealt.mapInArrow(
        _pack(capacity, wide),
        f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
    return packed.withColumnRenamed("key", key)


def report(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", **more) -> DataFrame:
    return pack(docs, tokenizer, text, key, **more).select(
        quoted(key).alias(key), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
