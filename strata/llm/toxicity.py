"""Toxicity: a convolutional text classifier.

A word's vector is the sum of hashed embeddings of the word and of its first
4, 5 and 6 letters, so an unseen form of a known stem is placed near it. Filters of several
widths run over the word vectors, each keeps its largest response over the
whole text (max pooling), and a logistic layer gives the score, which is then
scaled on held-back rows to read as a probability.

The model learns from every labelled row whose crc32(id as text) mod 3 is not
1, whole texts of any length. A few (``SHARD_ROWS``, ``SHARD_CHARS``) are trained
on at once on the driver. More are dealt into shards of that size by a hash: the
word odds of all rows start one model, each shard trains a copy of it, and the
changes are averaged, a word's by the texts that hold it.
Sums are of integers, so reruns agree. Scale and cuts come from the counts of all
held-back rows by score. The driver sees the model, which has a fixed size, and
these counts; scoring is one scan of all whole texts, in parts, without a shuffle.

Only the text enters a score. Thresholds on the score are calibrated on the
held-back rows, per language where these hold enough toxic texts of it, and are
kept apart from the score.

Defined results: null and empty texts get the score of a text without words;
unlabelled, null and repeated ids are scored like any other row; labels that
contradict each other count as toxic; with no labelled rows of one of the two
classes every score is 0 or 1 according to the other; an empty table gives an
empty result; extra columns are kept and added ones take a free name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.llm.common import free_name, quoted, ship, stored

SHARD_ROWS, SHARD_CHARS = 6000, 1 << 25
#: The unit of the integer sums of the shards' changes.
UNIT = float(1 << 30)
#: Bins of a raw output of 1, when outputs are counted.
BINS = 32
BUCKETS, DIM = 1 << 19, 8
WIDTHS, FILTERS = (1, 2, 3), 6
STEMS = (4, 5, 6)
EPOCHS, SHARD_EPOCHS, BATCH, RATE = 6, 3, 32, 0.05
CUT = 0.7
#: Toxic texts that a language needs in the held-back rows for a cut of its own.
LEAST_TOXIC = 8
#: Words whose projections a worker remembers, and words scored at a time.
CACHE, PART = 200_000, 1 << 16
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def features(word: str) -> list[int]:
    """Buckets of a word and its stems; bucket 0 is kept for padding."""
    named = [f"w:{word}", *[f"{k}:{word[:k]}" for k in STEMS if len(word) >= k]]
    named += [named[0]] * (1 + len(STEMS) - len(named))
    return [1 + zlib.crc32(x.encode()) % (BUCKETS - 1) for x in named]


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None
    cuts: dict = field(default_factory=dict)
    cut: float = CUT

    def projection(self) -> np.ndarray:
        """DIM x all (width, offset, filter) columns."""
        return np.concatenate([w[o] for w in self.filters for o in range(len(w))], axis=1).astype(np.float32)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -30, 30)))


def _layout(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all documents with padding (0) after each, and where a
    document begins and ends. A document without words is one padding."""
    gap = max(WIDTHS) - 1
    lengths = np.array([max(1, len(d)) for d in docs])
    begin = np.concatenate([[0], np.cumsum(lengths + gap)[:-1]])
    flat = np.zeros(int((lengths + gap).sum()), dtype=np.int64)
    for b, d in zip(begin, docs):
        flat[b : b + len(d)] = d
    return flat, begin, begin + lengths


def _numbered(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Word numbers per text, the buckets in use, and each word's among them."""
    vocab: dict[str, int] = {"": 0}
    docs = [np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], dtype=np.int64) for t in texts]
    feats = np.zeros((len(vocab), 1 + len(STEMS)), dtype=np.int64)
    for w, i in vocab.items():
        if i:
            feats[i] = features(w)
    rows, local = np.unique(feats, return_inverse=True)
    return docs, rows, local.reshape(feats.shape)


def _seen(docs: list[np.ndarray], local: np.ndarray, n_rows: int, labels: np.ndarray, fit) -> np.ndarray:
    """2 x rows: clean and toxic texts that hold a feature."""
    seen = np.zeros((2, n_rows))
    for i in fit:
        seen[labels[i], np.unique(local[docs[i]])] += 1
    return seen


def _start(seen: np.ndarray, n_clean: int, n_toxic: int, table: np.ndarray, rng) -> Model:
    """The untrained model, from a random table: how much more often a feature is in toxic texts."""
    odds = np.log((seen[1] + 0.5) / (n_toxic + 1)) - np.log((seen[0] + 0.5) / (n_clean + 1))
    n_seen = seen.sum(axis=0)
    odds *= n_seen / (n_seen + 4)
    table[:, 0] = 0.25 * odds
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS]
    # Half of the filters start from the odds of their first word, the others
    # from chance, of either sign, and are free to learn words in order.
    half = FILTERS // 2
    bias, out = np.full((len(WIDTHS), FILTERS), -0.5), np.full((len(WIDTHS), FILTERS), 0.5)
    for w in filters:
        w[0, 0, :half] += 0.6
        w[:, :, half:] *= 5
    bias[:, half:] = 0
    out[:, half:] = rng.choice([-0.3, 0.3], out[:, half:].shape)
    return Model(table, filters, bias.reshape(-1), out.reshape(-1), -2.0)


def _learn(model: Model, docs: list[np.ndarray], local: np.ndarray, labels: np.ndarray, fit: np.ndarray, weight: np.ndarray,
           epochs: int, rng) -> None:
    """Gradient steps on the texts ``fit``; ``model.table`` has the rows in use."""
    table, filters = model.table, model.filters
    sums = [np.zeros_like(x) for x in (table, *filters, model.bias, model.out)]
    sum_b = 0.0
    for _ in range(epochs):
        shuffled = rng.permutation(fit)
        for s in range(0, len(shuffled), BATCH):
            part = shuffled[s : s + BATCH]
            flat, begin, end = _layout([docs[i] for i in part])
            x = table[local[flat]].sum(axis=1)
            x[flat == 0] = 0
            pooled, where = [], []
            for w in filters:
                n = len(flat) - len(w) + 1
                r = sum(x[o : o + n] @ w[o] for o in range(len(w)))
                at = np.stack([b + r[b : min(e, n)].argmax(axis=0) for b, e in zip(begin, end)])
                where.append(at)
                pooled.append(np.take_along_axis(r, at, axis=0))
            z = np.concatenate(pooled, axis=1) + model.bias
            a = np.maximum(z, 0)
            p = 1 / (1 + np.exp(-np.clip(a @ model.out + model.out_bias, -30, 30)))
            d = (p - labels[part]) * weight[part] / len(part)
            da = d[:, None] * model.out * (z > 0)
            grads = [None] * (len(filters) + 1)
            gx = np.zeros_like(x)
            for j, (w, at) in enumerate(zip(filters, where)):
                dj = da[:, j * FILTERS : (j + 1) * FILTERS]
                gw = np.zeros_like(w)
                for o in range(len(w)):
                    gw[o] = np.einsum("bf,bfd->df", dj, x[at + o])
                    np.add.at(gx, at + o, dj[:, :, None] * w[o].T[None])
                grads[j + 1] = gw
            hit = np.flatnonzero(gx.any(axis=1) & (flat != 0))
            touched, place = np.unique(local[flat[hit]], return_inverse=True)
            gt = np.zeros((len(touched), DIM))
            np.add.at(gt, place.reshape(-1), np.repeat(gx[hit], local.shape[1], axis=0))
            sums[0][touched] += gt**2
            table[touched] -= RATE * gt / (np.sqrt(sums[0][touched]) + 1e-6)
            for j in range(len(filters)):
                sums[j + 1] += grads[j + 1] ** 2
                filters[j] -= RATE * grads[j + 1] / (np.sqrt(sums[j + 1]) + 1e-6)
            gb, go = da.sum(axis=0), a.T @ d
            sums[-2] += gb**2
            model.bias -= RATE * gb / (np.sqrt(sums[-2]) + 1e-6)
            sums[-1] += go**2
            model.out -= RATE * go / (np.sqrt(sums[-1]) + 1e-6)
            sum_b += d.sum() ** 2
            model.out_bias -= RATE * d.sum() / (np.sqrt(sum_b) + 1e-6)


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> tuple[Model, np.ndarray]:
    """Fit on texts and 0/1 labels; also gives the positions of the fifth that
    is held back for the scale and the cuts."""
    rng = np.random.default_rng(seed)
    docs, rows, local = _numbered(texts)
    order = rng.permutation(len(docs))
    back, fit = order[: len(docs) // 5], order[len(docs) // 5 :]
    n_clean, n_toxic = np.bincount(labels[fit], minlength=2)
    table = rng.normal(0, 0.1, (len(rows), DIM))
    model = _start(_seen(docs, local, len(rows), labels, fit), n_clean, n_toxic, table, rng)
    table[rows == 0] = 0
    _learn(model, docs, local, labels, fit, _weights(labels, n_clean, n_toxic), EPOCHS, rng)
    whole = np.zeros((BUCKETS, DIM), dtype=np.float32)
    whole[rows] = model.table
    model.table = whole
    model.filters = [w.astype(np.float32) for w in model.filters]
    _scale(model, [texts[i] for i in back], labels[back])
    return model, back


def _weights(labels: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    n = n_clean + n_toxic
    return np.where(labels == 1, 0.5 * n / max(1, n_toxic), 0.5 * n / max(1, n_clean))


def _scale(model: Model, texts: list[str], labels: np.ndarray) -> None:
    if len(set(labels.tolist())) < 2:
        return
    p = Scorer(model).many(texts)
    _fit_scale(model, np.log(p) - np.log1p(-p), labels, np.ones(len(labels), dtype=np.int64))


def _fit_scale(model: Model, z: np.ndarray, labels: np.ndarray, times: np.ndarray) -> None:
    """Logistic fit of the raw output on held-back rows, by Newton's method,
    towards smoothed labels so that separable rows give a finite fit."""
    n1, n = (labels * times).sum(), times.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (q * (1 - q) * times)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ ((target - q) * times) - 1e-3 * (b - np.array([1.0, 0.0])))
        b = b + np.clip(step, -1, 1)
    if b[0] > 0:
        model.scale = (float(b[0]), float(b[1]))


class Scorer:
    """Scores whole texts; remembers the projections of words."""

    def __init__(self, model: Model):
        self.model, self.proj = model, model.projection()
        self._reset()

    def _reset(self):
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, self.proj.shape[1]), dtype=np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            if len(self.known) + len(new) >= CACHE:
                self._reset()
                new = list(dict.fromkeys(words))
            first = len(self.known) + 1
            while first + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            f = np.array([features(w) for w in new])
            self.rows[first : first + len(new)] = self.model.table[f].sum(axis=1) @ self.proj
            self.known.update(zip(new, range(first, first + len(new))))
        known = self.known
        return np.array([known[w] for w in words], dtype=np.int64)

    def _pooled(self, words: list[str]) -> np.ndarray:
        """Largest response of each filter; a window may run over the end."""
        gap = max(WIDTHS) - 1
        best = np.full(FILTERS * len(WIDTHS), -np.inf, dtype=np.float32)
        for s in range(0, max(1, len(words)), PART):
            part = words[s : s + PART + gap]
            flat = np.concatenate([self._numbers(part) if part else np.zeros(1, np.int64), np.zeros(gap, np.int64)])
            n = max(1, min(PART, len(part)))
            r = self.rows[flat]
            c = 0
            for j, w in enumerate(WIDTHS):
                total = r[:n, c : c + FILTERS]
                for o in range(1, w):
                    total = total + r[o : o + n, c + o * FILTERS : c + (o + 1) * FILTERS]
                c += w * FILTERS
                f = slice(j * FILTERS, (j + 1) * FILTERS)
                best[f] = np.maximum(best[f], total.max(axis=0))
        return best

    def many(self, texts) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        pooled = [self._pooled(words_of(t)) for t in texts]
        return self.model.score(np.stack(pooled).astype(float)) if pooled else np.zeros(0)


def _best(s: np.ndarray, y: np.ndarray, times: np.ndarray) -> float:
    """The middle of the cuts with the fewest errors."""
    order = np.argsort(s)
    s, y, times = s[order], y[order], times[order]
    # Errors if everything from position i on is called toxic.
    wrong = np.concatenate([[0], np.cumsum(y * times)]) + np.concatenate([np.cumsum(((1 - y) * times)[::-1])[::-1], [0]])
    i = np.flatnonzero(wrong == wrong.min())
    lo, hi = i[0], i[-1]
    edge = lambda k: 0.5 * ((s[k - 1] if k else 0.0) + (s[k] if k < len(s) else 1.0))
    return float(np.clip(0.5 * (edge(lo) + edge(hi)), 0.3, 0.9))


def calibrate(model: Model, texts: list[str], langs: list, labels: np.ndarray) -> None:
    """Cuts per language: the middle of the best gap between the scores of
    clean and toxic held-back texts, where the language has enough toxic ones.
    Without held-back texts of both classes the cuts stay at CUT."""
    if len(set(labels.tolist())) < 2:
        return
    once = np.ones(len(labels), dtype=np.int64)
    _centre(model, Scorer(model).many(texts), labels, once)
    scores = Scorer(model).many(texts)
    model.cut = _best(scores, labels, once)
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([x == lang for x in langs])
        if labels[mine].sum() >= LEAST_TOXIC:
            model.cuts[lang] = _best(scores[mine], labels[mine], once[mine])


def _centre(model: Model, scores: np.ndarray, labels: np.ndarray, times: np.ndarray) -> None:
    """Move the scale so that the best cut over all languages reads CUT."""
    found = np.clip(_best(scores, labels, times), 0.4, 0.9)
    a, b = model.scale
    model.scale = (a, b + float(np.log(CUT / (1 - CUT)) - np.log(found / (1 - found))))


def _pack(model: Model) -> np.ndarray:
    """All but the table, as rows that look like the table's."""
    flat = np.concatenate([*[w.reshape(-1) for w in model.filters], model.bias, model.out, [model.out_bias]])
    return np.concatenate([flat, np.zeros(-len(flat) % DIM)]).reshape(-1, DIM)


def _unpack(model: Model, rows: np.ndarray) -> None:
    flat, at = rows.reshape(-1), 0
    for j, w in enumerate(model.filters):
        model.filters[j] = flat[at : at + w.size].reshape(w.shape).copy()
        at += w.size
    n = len(model.bias)
    model.bias, model.out, model.out_bias = flat[at : at + n].copy(), flat[at + n : at + 2 * n].copy(), float(flat[at + 2 * n])


_COUNTED = "row int, clean long, toxic long"
_CHANGED = "row int, w long, " + ", ".join(f"d{i} long" for i in range(DIM))


def _train_shards(rows: DataFrame, shards: int) -> Model:
    """Train on all rows (t, g, y, h, back) of any number, in shards."""
    spark = rows.sparkSession
    ship(spark)
    fit = rows.where(~F.col("back"))
    sizes = {r["y"]: r["n"] for r in fit.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, BUCKETS), dtype=np.int64)
        for part in batches:
            docs, used, local = _numbered(part["t"].to_list())
            total[:, used] += _seen(docs, local, len(used), part["y"].to_numpy(), range(len(docs))).astype(np.int64)
        at = np.flatnonzero(total.any(axis=0))
        yield pd.DataFrame({"row": at.astype(np.int32), "clean": total[0, at], "toxic": total[1, at]})

    # Bounded: one row per bucket of the table.
    held = fit.select("t", "y").mapInPandas(counted, _COUNTED).groupBy("row").agg(F.sum("clean"), F.sum("toxic")).toArrow()
    seen = np.zeros((2, BUCKETS))
    seen[:, held.column(0).to_numpy()] = [held.column(1).to_numpy(), held.column(2).to_numpy()]
    rng = np.random.default_rng(7)
    table = 0.1 * rng.standard_normal((BUCKETS, DIM), dtype=np.float32)
    model = _start(seen, n_clean, n_toxic, table, rng)
    table[0] = 0
    del held, seen
    shared = spark.sparkContext.broadcast(model)

    def changed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["h", "t"])
        docs, used, local = _numbered(part["t"].to_list())
        y, m = part["y"].to_numpy(), shared.value
        mine = Model(m.table[used].astype(float), [w.copy() for w in m.filters], m.bias.copy(), m.out.copy(), m.out_bias)
        before = np.concatenate([mine.table, _pack(mine)])
        rng = np.random.default_rng([7, int(part["shard"].iloc[0])])
        _learn(mine, docs, local, y, np.arange(len(docs)), _weights(y, n_clean, n_toxic), SHARD_EPOCHS, rng)
        delta = np.concatenate([mine.table, _pack(mine)]) - before
        more = len(delta) - len(used)
        w = np.concatenate([_seen(docs, local, len(used), y, range(len(docs))).sum(axis=0), np.full(more, len(docs))])
        sums = np.rint(delta * w[:, None] * UNIT).astype(np.int64)
        got = {"row": np.concatenate([used, BUCKETS + np.arange(more)]).astype(np.int32), "w": w.astype(np.int64)}
        return pd.DataFrame({**got, **{f"d{i}": sums[:, i] for i in range(DIM)}})

    dealt = fit.withColumn("shard", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards)).cast("int")).repartition(shards, "shard")
    mean = [(F.sum(f"d{i}") / F.lit(UNIT) / F.sum("w")).cast("float").alias(f"d{i}") for i in range(DIM)]
    # Bounded: the size of the model.
    moved = dealt.groupBy("shard").applyInPandas(changed, _CHANGED).where("w > 0").groupBy("row").agg(*mean).toArrow()
    at = moved.column("row").to_numpy()
    of_table, rest = at < BUCKETS, _pack(model)
    for i in range(DIM):
        d = moved.column(f"d{i}").to_numpy()
        table[at[of_table], i] += d[of_table]
        rest[at[~of_table] - BUCKETS, i] += d[~of_table]
    _unpack(model, rest)
    model.filters = [w.astype(np.float32) for w in model.filters]
    shared.unpersist()
    return model


def _calibrate_shards(model: Model, back: DataFrame) -> None:
    """Scale and cuts from the held-back rows, counted by raw output."""
    shared = back.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("int")
    def output(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            p = scorer.many(texts.to_list())
            yield pd.Series(np.rint(BINS * (np.log(p) - np.log1p(-p))), dtype="int32")

    count = F.sum("n").alias("n")
    held = stored(back.select("g", "y", output("t").alias("z")).groupBy("g", "y", "z").agg(F.count("*").alias("n")), "toxic-held")
    own = held.where("y = 1 AND g IS NOT NULL").groupBy("g").agg(count).where(F.col("n") >= LEAST_TOXIC).select("g")
    arrays = lambda df: [df[c].to_numpy().astype(np.int64) for c in ("z", "y", "n")]
    z, y, n = arrays(held.groupBy("y", "z").agg(count).orderBy("z", "y").toArrow())
    if len(set(y.tolist())) < 2:
        return
    z = z / BINS
    scored = lambda x: 1 / (1 + np.exp(-np.clip(model.scale[0] * x + model.scale[1], -30, 30)))
    _fit_scale(model, z, y, n)
    _centre(model, scored(z), y, n)
    model.cut = _best(scored(z), y, n)
    for lang, mine in held.join(own, "g").orderBy("g", "z", "y").toArrow().to_pandas().groupby("g"):
        z, y, n = arrays(mine)
        model.cuts[lang] = _best(scored(z / BINS), y, n)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", label: str = "toxic") -> Model:
    """Train on all labelled rows outside the held-out fold."""
    marked = (
        labels.select(quoted(key).alias("k"), quoted(label).alias("y"))
        .where(F.col("k").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("k")))
        .groupBy("k").agg(F.max("y").cast("int").alias("y")).where("y IN (0, 1)")
    )
    found = (
        docs.select(quoted(key).alias("k"), quoted(text).alias("t"), quoted(lang).alias("g"))
        .where(F.col("t").isNotNull() & ~held_out(F.col("k")))
        .join(marked.hint("merge"), "k").select("t", "g", "y", F.xxhash64("k", "t").alias("h"))
    )
    seen = Observation()
    rows = stored(found.observe(seen, F.count("*").alias("n"), F.sum(F.length("t")).alias("chars"), F.min("y").alias("lo"), F.max("y").alias("hi")), "toxic-labelled")
    n, chars, lo, hi = (seen.get[x] for x in ("n", "chars", "lo", "hi"))
    if not n or lo == hi:
        empty = np.zeros((1, DIM), dtype=np.float32)
        return Model(empty, [], np.zeros(0), np.zeros(0), 0.0, constant=float(lo) if n else 0.0)
    shards = max(-(-n // SHARD_ROWS), -(-chars // SHARD_CHARS))
    if shards > 1:
        rows = rows.withColumn("back", F.pmod(F.col("h"), F.lit(5)) == 0)
        model = _train_shards(rows, shards)
        _calibrate_shards(model, rows.where("back"))
        return model
    # One shard: at most SHARD_ROWS rows and SHARD_CHARS characters.
    few = rows.orderBy("h", "t").collect()
    texts, langs, y = [r["t"] for r in few], [r["g"] for r in few], np.array([r["y"] for r in few], dtype=np.int64)
    model, back = train(texts, y)
    # Scores of texts that the model was fitted on separate better than those of new ones.
    calibrate(model, [texts[i] for i in back], [langs[i] for i in back], y[back])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``score``, ``cut`` (by language) and ``toxic``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name, cut, toxic = (free_name(docs, x) for x in ("score", "cut", "toxic"))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value) if shared.value.constant is None else None
        for texts in batches:
            yield pd.Series(scorer.many(texts.to_list()) if scorer else np.full(len(texts), shared.value.constant), dtype=float)

    limit = F.lit(model.cut)
    for k, v in model.cuts.items():
        limit = F.when(quoted(lang) == k, v).otherwise(limit)
    out = docs.withColumn(name, scored(quoted(text))).withColumn(cut, limit)
    return out.withColumn(toxic, F.col(name) >= F.col(cut))


def report(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", cut: float = CUT) -> DataFrame:
    model = fit(docs, labels, text, key, lang)
    plain = docs.select(quoted(key).alias("key"), quoted(text).alias("text"), quoted(lang).alias("lang"))
    got = score(plain, model, "text", "lang")
    return got.select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"), F.col("cut").alias("lang_cut"), F.col("toxic").alias("rejected"),
    )


def clean(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """``docs`` without those that their language's cut calls toxic."""
    got = score(docs, fit(docs, labels, text, key, lang), text, lang)
    return got.where(~F.col(got.columns[-1])).select(*[quoted(c) for c in docs.columns])
