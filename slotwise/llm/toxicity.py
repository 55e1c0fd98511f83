"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

* The kernel compares two short strings by all their common subsequences of three
  characters within ``SPAN`` places, each weighted by ``DECAY`` to the power of the span it
  covers, so ``id.iot`` and ``idi0t`` stay close to ``idiot``. It is normalised and raised
  to ``POWER``; values of a normalised kernel below ``FLOOR`` count as 0.
* A document is a bag of short strings: its words without outer punctuation, their
  prefixes (insults with any ending), windows of longer words and runs of single
  characters ("i d i o t"). Against a landmark it counts by its most similar string.
* Landmarks are strings found much more often in toxic training documents than in clean
  ones, chosen greedily until every toxic document is covered several times, plus common
  clean words. Landmark values go through the inverse root of the landmark matrix
  (Nyström) into a linear SVM, and by a logistic curve fitted on out-of-fold decision
  values to scores.

Labels are learnt only from rows whose crc32(doc_id as text) mod 4 is not 2, from at most
about ``MAX_LABELLED`` of them (a hash sample of ids; exact copies count once). Everything
else covers all rows and whole texts. Counting and scoring run in Spark tasks; the driver
gets at most ``CANDIDATES`` strings and ``MAX_LABELLED`` x ``LANDMARKS`` numbers.

Defined results: a null or empty text has no strings and gets the score of that; with no
labelled row, or labels of one class only, every score is the smoothed share of toxic labels (0
without labels); several labels of one id count as toxic if one is; a null id is never
held out; repeated rows score alike; only the named columns are read.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, query, table

MAX_LABELLED = 24_000
LANDMARKS, CLEAN_LANDMARKS = 96, 8
CANDIDATES = 3_000
COVER = 4
DECAY, SPAN, POWER, FLOOR = 0.6, 6, 3, 0.6
THRESHOLD = 0.3
#: Weight of the squared norm in the SVM's objective (mean loss).
RIDGE = 3e-5
PREFIXES = (3, 4, 5, 6, 7)
LONGEST = 16
#: Words a Python worker remembers, and rows of landmark values among them.
CACHE_WORDS, CACHE_ROWS = 700_000, 120_000

_EDGE = string.punctuation + "«»“”„‘’…¡¿–—"
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")


def words(text: str | None) -> set[str]:
    """The distinct words of a text, lower-cased, without outer punctuation."""
    low = (text or "").lower()
    found = {w.strip(_EDGE) for w in set(low.split())}
    for run in _SPACED.findall(low):
        found.add("".join(run.split()))
    found.discard("")
    return found


def units(word: str) -> list[str]:
    """The strings a word is compared by: itself and its prefixes; of a word longer than
    ``LONGEST``, overlapping windows that cover it; and the word without inner signs."""
    own = [word] if len(word) <= LONGEST else \
        [word[k:k + LONGEST] for k in range(0, len(word) - LONGEST // 2, LONGEST // 2)]
    if not word.isalnum():
        letters = "".join(filter(str.isalnum, word))
        own += [letters[:LONGEST]] + [letters[:n] for n in PREFIXES if n < len(letters)]
    return own + [word[:n] for n in PREFIXES if n < len(word)]


def _codes(strings: list[str]) -> np.ndarray:
    n = len(strings[0])
    return np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32).reshape(len(strings), n).astype(np.int64)


def triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the subsequences of a string of n characters, and their weights."""
    at = np.array([t for t in combinations(range(n), 3) if t[2] - t[0] < SPAN])
    return at, (DECAY ** (at[:, 2] - at[:, 0] + 1.0)).astype(np.float32)


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """k(s, s) of strings of one length: squared weight sums of equal subsequences."""
    at, weight = triples(codes.shape[1])
    key = (codes[:, at[:, 0]] * 2097152 + codes[:, at[:, 1]]) * 2097152 + codes[:, at[:, 2]]
    order = np.argsort(key, axis=1, kind="stable")
    key = np.take_along_axis(key, order, 1)
    first = np.ones(key.shape, dtype=bool)
    first[:, 1:] = key[:, 1:] != key[:, :-1]
    starts = np.flatnonzero(first.ravel())
    sums = np.add.reduceat(weight[order].ravel().astype(float), starts)
    return np.bincount(starts // key.shape[1], weights=sums ** 2, minlength=len(codes))


class Landmarks:
    """Kernel values of many strings against fixed landmarks, by explicit features: the
    subsequences of the landmarks."""

    def __init__(self, strings: list[str]) -> None:
        self.strings = strings
        alphabet = sorted({ch for s in strings for ch in s})
        self.base = len(alphabet) + 1
        self.code = np.zeros(0x110000, dtype=np.int32)             # character -> code, 0: in no landmark
        self.code[[ord(ch) for ch in alphabet]] = np.arange(1, self.base)
        # subsequence -> feature (0: none) in two steps: its first two characters name a row of the
        # second table, which has one row per such pair that occurs; size goes with features x alphabet
        self.pair = np.zeros(self.base ** 2, dtype=np.int32)
        features: dict[int, int] = {}
        entries: list[tuple[int, int, float]] = []
        for m, s in enumerate(strings):
            codes = [int(self.code[ord(ch)]) for ch in s]
            for i, j, k in triples(len(s))[0].tolist():
                at = (codes[i] * self.base + codes[j]) * self.base + codes[k]
                entries.append((features.setdefault(at, len(features) + 1), m, DECAY ** (k - i + 1)))
        self.weights = np.zeros((len(features) + 1, len(strings)))
        for f, m, x in entries:
            self.weights[f, m] += x
        self.weights /= np.maximum(np.sqrt((self.weights ** 2).sum(0)), 1e-300)
        self.weights = self.weights.astype(np.float32)
        self.most = self.weights.max(1)
        pairs = {p: i for i, p in enumerate(sorted({at // self.base for at in features}), 1)}
        self.last = np.zeros((len(pairs) + 1) * self.base, dtype=np.int32)
        for p, i in pairs.items():
            self.pair[p] = i * self.base
        for at, f in features.items():
            self.last[pairs[at // self.base] * self.base + at % self.base] = f

    def values(self, strings: list[str]) -> np.ndarray:
        """Normalised kernel ** POWER of each string and landmark, 0 below FLOOR."""
        out = np.zeros((len(strings), len(self.strings)), dtype=np.float32)
        by_length: dict[int, list[int]] = {}
        for i, s in enumerate(strings):
            if len(s) >= 3:
                by_length.setdefault(len(s), []).append(i)
        for n, places in by_length.items():
            at, weight = triples(n)
            least_norm = float(np.sqrt((weight.astype(float) ** 2).sum()))
            for k in range(0, len(places), 4000):
                part = np.asarray(places[k:k + 4000])
                raw = _codes([strings[i] for i in part])
                own = self.code[raw]
                # code 0 stands in no pair, and column 0 and row 0 of the second table are 0
                hit = self.last[self.pair[own[:, at[:, 0]] * self.base + own[:, at[:, 1]]] + own[:, at[:, 2]]]
                # no landmark can be nearer than the sum of each subsequence's best weight
                near = np.flatnonzero(self.most[hit] @ weight >= FLOOR * least_norm)
                for m in range(0, len(near), 1000):
                    some = near[m:m + 1000]
                    r, t = np.nonzero(hit[some])                   # every row has a hit
                    dots = self.weights[hit[some][r, t]] * weight[t][:, None]
                    dots = np.add.reduceat(dots, np.flatnonzero(np.diff(r, prepend=-1)))
                    v = dots / np.sqrt(self_kernel(raw[some]))[:, None].astype(np.float32)
                    out[part[some]] = np.where(v >= FLOOR, np.minimum(v, 1.0) ** POWER, 0.0)
        return out


class Pooler:
    """Landmark values of documents: per landmark, the most similar string of the text.
    Strings and words are remembered, up to a bound."""

    def __init__(self, landmarks: list[str]) -> None:
        self.marks = Landmarks(landmarks)
        self._forget()

    def _forget(self) -> None:
        self.strings: set[str] = set()       # strings met so far
        self.near: dict[str, int] = {}       # string similar to a landmark -> row of values
        self.known: set[str] = set()         # words met so far
        self.hits: dict[str, int] = {}       # word with such strings -> row: their largest values
        self.hit_words: set[str] = set()
        self.rows = np.zeros((1024, len(self.marks.strings)), dtype=np.float32)    # the first ``used`` count
        self.used = 0

    def _keep(self, values: np.ndarray) -> None:
        """Append rows; the room doubles when it is full, so that rows are rarely copied."""
        end = self.used + len(values)
        if end > len(self.rows):
            room = np.zeros((max(end, 2 * len(self.rows)), self.rows.shape[1]), dtype=np.float32)
            room[:self.used] = self.rows[:self.used]
            self.rows = room
        self.rows[self.used:end] = values
        self.used = end

    def _learn(self, fresh: set[str]) -> None:
        spelt = [(s, units(s)) for s in fresh]
        new = list({u for _, us in spelt for u in us} - self.strings)
        values = self.marks.values(new)
        near = np.flatnonzero(values.any(1))
        self.strings.update(new)
        self.near.update((new[u], self.used + i) for i, u in enumerate(near.tolist()))
        self._keep(values[near])
        pooled, found = [], self.near.keys()
        for s, us in spelt:
            if found.isdisjoint(us):
                continue
            rows = [self.near[u] for u in us if u in self.near]
            if len(rows) > 1:
                pooled.append(self.rows[rows].max(0))
                self.hits[s] = self.used + len(pooled) - 1
            else:
                self.hits[s] = rows[0]
            self.hit_words.add(s)
        self.known |= fresh
        if pooled:
            self._keep(np.stack(pooled))

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.marks.strings)), dtype=np.float32)
        for k in range(0, len(texts), 100):
            bags = [words(t) for t in texts[k:k + 100]]
            seen = set().union(*bags)
            fresh = seen - self.known
            if len(self.known) + len(fresh) > CACHE_WORDS or self.used > CACHE_ROWS:
                self._forget()
                fresh = seen
            parts = list(fresh)
            for a in range(0, len(parts), 20_000):
                self._learn(set(parts[a:a + 20_000]))
            for i, bag in enumerate(bags):
                rows = [self.hits[w] for w in bag & self.hit_words]
                if rows:
                    out[k + i] = self.rows[rows].max(0)
        return out


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray      # on landmark values
    bias: float
    slope: float
    offset: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        f = features @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * f + self.offset, -50, 50)))


def fit_svm(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; both classes weigh alike in
    the square root of their size."""
    n, d = x.shape
    xb = np.hstack([x, np.ones((n, 1))])
    s = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, np.sqrt((y <= 0).sum() / max(1, (y > 0).sum())), 1.0) / n
    w = np.zeros(d + 1)
    reg = np.full(d + 1, ridge)
    reg[-1] = 1e-8
    for _ in range(rounds):
        live = s * (xb @ w) < 1
        xl, sl, cl = xb[live], s[live], share[live]
        step = np.linalg.solve((xl * cl[:, None]).T @ xl + np.diag(reg), (xl * cl[:, None]).T @ sl)
        if np.allclose(step, w, atol=1e-8):
            break
        w = step
    return w[:-1], float(w[-1])


def fit_curve(f: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic curve through decision values, with smoothed targets (Platt)."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -50, 50)))
        g = np.array([((p - t) * f).sum(), (p - t).sum()])
        v = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * f * f).sum() + 1e-6, (v * f).sum()], [(v * f).sum(), v.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -5, 5), b - np.clip(db, -5, 5)
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def _held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """text, toxic of the labelled rows that may be learnt from: a hash sample of about
    ``max_labelled`` ids, exact copies once."""
    ids = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~_held_out()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, max_labelled / max(1, ids.count()))
    sample = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # about max_labelled rows of two numbers: bounded, so every task may hold them
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id") \
        .groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("content")) \
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).drop("content")


def _count_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pd.DataFrame:
        keys = list(counts[0].keys() | counts[1].keys())
        return pd.DataFrame({"unit": keys, "pos": [counts[1][k] for k in keys], "neg": [counts[0][k] for k in keys]})

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[int(toxic)].update({u for w in words(text) for u in units(w) if len(u) >= 3})
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield out()
                counts[0].clear()
                counts[1].clear()
    yield out()


def candidate_units(train: DataFrame, pos: int, neg: int) -> pd.DataFrame:
    """Strings far more frequent in toxic than in clean documents, and common clean words."""
    counted = train.mapInPandas(_count_units, "unit string, pos long, neg long") \
        .groupBy("unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = counted.where("pos + neg >= 2").withColumn("odds", F.log(
        ((F.col("pos") + 0.5) / (pos + 1)) / ((F.col("neg") + 0.5) / (neg + 1))))
    counted = cut(counted, "toxic-units")
    toxic = counted.where(F.col("pos") >= max(2, pos // 500)).where("odds >= 1.5") \
        .orderBy(F.desc(F.col("odds") * F.log1p("pos")), "unit").limit(CANDIDATES).toPandas()
    clean = counted.where("odds < 0.3 AND length(unit) >= 4") \
        .orderBy(F.desc("neg"), "unit").limit(CLEAN_LANDMARKS).toPandas()
    return pd.concat([toxic.assign(toxic=True), clean.assign(toxic=False)], ignore_index=True)


def _cover(train: DataFrame, toxic_units: pd.DataFrame) -> list[str]:
    """Greedy choice: each step takes the string that covers most toxic documents not yet
    covered ``COVER`` times, weighted by its log odds."""
    wanted = frozenset(toxic_units["unit"])

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"units": [sorted({u for w in words(t) for u in units(w)} & wanted)
                                          for t in batch["text"]]})

    bags = train.where("toxic = 1").select("text").mapInPandas(present, "units array<string>").toPandas()["units"]
    odds = dict(zip(toxic_units["unit"], toxic_units["odds"]))
    holders: dict[str, list[int]] = {}
    for i, bag in enumerate(bags):
        for u in bag:
            holders.setdefault(u, []).append(i)
    need = np.full(len(bags), COVER)
    chosen: list[str] = []
    gain = {u: np.asarray(h) for u, h in holders.items()}
    while gain and len(chosen) < LANDMARKS - CLEAN_LANDMARKS:
        value = {u: odds[u] * float(need[h].sum()) for u, h in gain.items()}
        best = max(value, key=lambda u: (value[u], len(u), u))
        if value[best] <= 0:
            break
        h = gain.pop(best)
        need[h] = np.maximum(need[h] - 1, 0)
        # where a chosen string stands, its prefixes and extensions say nothing new
        for u in [u for u in gain if u.startswith(best) or best.startswith(u)]:
            gain[u] = np.setdiff1d(gain[u], h)
        chosen.append(best)
    return chosen


def train_model(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or the constant score where there is nothing to learn from."""
    train = cut(training_rows(docs, labels), "toxic-train")
    by_class = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = by_class.get(1, 0), by_class.get(0, 0)
    if not pos or not neg:
        return (pos + 1) / (pos + neg + 2) if pos + neg else 0.0
    found = candidate_units(train, pos, neg)
    chosen = _cover(train, found[found["toxic"]])
    landmarks = chosen + [u for u in found[~found["toxic"]]["unit"] if u not in chosen]
    if not chosen:
        return (pos + 1) / (pos + neg + 2)

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pooler = Pooler(landmarks)
        for batch in batches:
            x = pooler.features(batch["text"].tolist())
            yield pd.DataFrame({"x": [r.astype(np.float32).tobytes() for r in x], "toxic": batch["toxic"]})

    rows = train.mapInPandas(pool, "x binary, toxic int").toPandas()
    rows = rows.sort_values(["toxic", "x"]).reset_index(drop=True)     # the same model on every run
    x = np.frombuffer(b"".join(rows["x"]), dtype=np.float32).reshape(len(rows), -1).astype(float)
    y = rows["toxic"].to_numpy()

    lam, vec = np.linalg.eigh(Landmarks(landmarks).values(landmarks).astype(float))
    keep = lam > 1e-3 * lam.max()
    to_phi = vec[:, keep] / np.sqrt(lam[keep])                         # K^(-1/2), small directions left out
    phi = x @ to_phi
    fold = np.arange(len(y)) % 5
    decision = np.zeros(len(y))
    for k in range(5):
        if (y[fold != k] > 0).any() and (y[fold != k] <= 0).any():
            w, b = fit_svm(phi[fold != k], y[fold != k])
            decision[fold == k] = phi[fold == k] @ w + b
    slope, offset = fit_curve(decision, y)
    w, b = fit_svm(phi, y)
    return Model(landmarks, to_phi @ w, b, slope, offset)


def score_documents(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooler = Pooler(model.landmarks) if isinstance(model, Model) else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            score = model.scores(pooler.features(texts)) if pooler else np.full(len(texts), float(model))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                                             ["doc_id", "held_out", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")) \
        .select("doc_id", "held_out", "text") \
        .mapInArrow(run, "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the model does not reject, with their own columns."""
    model = train_model(docs, labels)
    if not isinstance(model, Model):
        return docs if model < THRESHOLD else docs.limit(0)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooler = Pooler(model.landmarks)
        for batch in batches:
            score = model.scores(pooler.features(batch.column(names.index("text")).to_pylist()))
            yield batch.filter(pa.array(score < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train_model(docs, table(spark, sf_dir, "labels")))
