"""Importance resampling: span hashes against zlib, defined results, brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from slotwise.llm import importance
from slotwise.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_features string, weight string, rank string, _able string, bucket int, n int"
FOLD = str.maketrans(importance.UPPER, importance.LOWER)


def documents(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", 1, 2) for i, t in rows], DOCS)


def test_spans_hash_as_crc32_does():
    rng = np.random.RandomState(5)
    data = rng.randint(0, 256, 5_000).astype(np.uint8)
    lengths = np.array([1, 2, 3, 4, 5, 63, 64, 65, 127, 128, 129, 130, 191, 192, 193, 1_000, 4_096])
    starts = rng.randint(0, 900, len(lengths))
    got = importance.crc_spans(data, starts, starts + lengths)
    assert got.tolist() == [zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(starts, lengths)]


def features(text: str | None, max_words: int) -> list[str]:
    words = WORD.findall((text or "").translate(FOLD))
    return [" ".join(words[i:i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]


def brute_force(docs, target, percent, min_words, max_words, buckets, seed):
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(crc(f) for _, t in docs for f in features(t, max_words))
    t = Counter(crc(f) for x in target for f in features(x, max_words))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, text in docs:
        fs = features(text, max_words)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(crc(f)) for f in fs)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append([i, len(fs), weight, score, None, len(features(text, 1)) >= min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0], -r[2], r[1]))
    for place, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = place
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("max_words", [1, 3])
def test_resample_equals_brute_force(spark, max_words):
    rng = np.random.RandomState(7)
    docs = [(i, " ".join(f"W{x}é" if x % 3 else f"w{x}" for x in rng.zipf(1.4, rng.randint(1, 40)) % 500)) for i in range(150)]
    docs += [(900, None), (901, ""), (902, " \x7f-!"), (None, "lost words " * 20), (903, "copy of one row " * 9),
             (903, "copy of one row " * 9), (904, "z" * 70_000 + " " + "long " * 30), (905, "A\x00B/c:d[E`F{g\x7fh中文") ]
    target = ["w1 w2é w3 long copy", None, "", "w5é W5É w3"]
    options = dict(percent=30, min_words=10, max_words=max_words, buckets=211, seed="s")
    got = importance.resample(documents(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_force(docs, target, **options)


def test_slices_and_batches_do_not_matter(monkeypatch):
    texts = [b"one two", b"", b"three", "viér  fünf".encode(), b"six" * 50]
    raw, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
    whole = [np.concatenate(x).tolist() for x in zip(*importance.feature_buckets(raw, offsets, 2))]
    monkeypatch.setattr(importance, "SLICE", 5)
    assert [np.concatenate(x).tolist() for x in zip(*importance.feature_buckets(raw, offsets, 2))] == whole
    assert whole[0].count(0) == 3                               # "one", "two", "one two"


def test_resample_empty_tables(spark):
    none = documents(spark, [])
    assert importance.resample(none, none).count() == 0
    one = importance.resample(documents(spark, [(1, "a b")]), none, percent=100, min_words=2).first()
    assert (one.n_features, one.rank) == (2, 1)


def test_draw_returns_the_rows_themselves(spark):
    docs = documents(spark, [(i, f"word{i} " * 25) for i in range(20)])
    target = spark.createDataFrame([("word3 word4 " * 50,)], "text string")
    kept = importance.draw(docs, target)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {3, 4}
