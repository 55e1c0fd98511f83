"""Target-distribution importance resampling: documents are drawn by how much likelier their
hashed word features are under a target text set than under the corpus, with Gumbel noise.

Method (position-table CRC). A CRC is linear over XOR: the crc32 of a span is the XOR of
what each byte contributes at its distance from the span's end, and of a constant for the
span's length. ``contributions()`` holds byte x distance for ``TABLE`` distances, so all
features of a batch are hashed at once: one table lookup per byte and one
``bitwise_xor.reduceat`` over the feature spans. Spans longer than the table fold
blockwise: the register so far moves by a whole block (one lookup per register byte), then
the next block's contributions are XORed in.

Scale. Two scans of the texts and no shuffle of them: the first leaves one count per bucket
and task (at most ``BUCKETS`` rows), summed by a partial aggregate; the second turns a text
into (n_features, weight). The gains are ``BUCKETS`` numbers, whatever the corpus. Ranks come
from a range sort of (score, id) and one count per partition. Features are hashed in slices of ``SLICE`` bytes.

Defined results. Null and texts without a word: no features, weight 0, never drawn (a draw
asks for ``MIN_WORDS`` words). Words are what lies between bytes 00-2F, 3A-60 and 7B-7F after
lower-casing A-Z only; a feature is a run of up to ``max_words`` of them joined by one space.
Very long texts and very long words are hashed whole. Repeated rows are rows: each counts
and each may be drawn. Equal scores: the smaller doc_id first, null ids last. A null id is
noised as an empty one. An empty corpus or target counts as no features (the smoothing
keeps gains finite). Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, prepare, query, table
from slotwise.operators.report import with_global_positions

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
TABLE = 64            # distances from the end that the table holds
SLICE = 1 << 20       # bytes of features hashed at once
POLY = 0xEDB88320     # the reflected polynomial of crc32


@lru_cache(maxsize=1)
def contributions() -> np.ndarray:
    """[distance from the end, byte] -> what the byte adds to the register."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(POLY), first >> 1).astype(np.uint32)
    rows = [first]
    for _ in range(TABLE - 1):
        rows.append((rows[-1] >> 8) ^ first[rows[-1] & 0xFF])
    return np.stack(rows)


@lru_cache(maxsize=1)
def block_shift() -> np.ndarray:
    """[register byte, its value] -> the register after ``TABLE`` further zero bytes."""
    t = contributions()
    out = np.empty((4, 256), dtype=np.uint32)
    for i in range(4):                       # the register's low byte meets the next byte first
        out[i] = t[TABLE - 1 - i]
    return out


def shift_block(register: np.ndarray) -> np.ndarray:
    s = block_shift()
    return s[0][register & 0xFF] ^ s[1][(register >> 8) & 0xFF] ^ s[2][(register >> 16) & 0xFF] ^ s[3][register >> 24]


@lru_cache(maxsize=1)
def length_constants() -> np.ndarray:
    """[length up to ``TABLE``] -> what the initial register adds to a span of that length."""
    first = contributions()[0]
    out, register = np.empty(TABLE + 1, dtype=np.uint32), np.uint32(0xFFFFFFFF)
    for n in range(TABLE + 1):
        out[n] = register
        register = (register >> np.uint32(8)) ^ first[register & np.uint32(0xFF)]
    return out


def _xor_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each span's bytes; lengths from 1 to ``TABLE``."""
    heads = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum()))
    distance = np.repeat(heads + lengths - 1, lengths) - at
    return np.bitwise_xor.reduceat(contributions()[distance, data[at + np.repeat(starts - heads, lengths)]], heads)


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every span data[start:end] (spans may overlap, none is empty)."""
    lengths = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    short = np.flatnonzero(lengths <= TABLE)
    if len(short):
        out[short] = _xor_spans(data, starts[short], lengths[short]) ^ length_constants()[lengths[short]]
    folded = np.flatnonzero(lengths > TABLE)
    if len(folded):
        # The first block takes what does not fill whole blocks, so all further ones are whole.
        head = (lengths[folded] - 1) % TABLE + 1
        register = _xor_spans(data, starts[folded], head) ^ length_constants()[head]
        at, left = starts[folded] + head, (lengths[folded] - head) // TABLE
        while (open_ := np.flatnonzero(left)).size:
            register[open_] = shift_block(register[open_]) ^ _xor_spans(data, at[open_], np.full(len(open_), TABLE))
            at[open_] += TABLE
            left[open_] -= 1
        out[folded] = register
    return out ^ np.uint32(0xFFFFFFFF)


@lru_cache(maxsize=1)
def _fold_case() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[0x41:0x5B] += 32
    return lut


@lru_cache(maxsize=1)
def _word_bytes() -> np.ndarray:
    """Bytes inside words, after case folding: digits, a-z, all of a non-ASCII character."""
    lut = np.zeros(256, dtype=bool)
    lut[0x30:0x3A] = lut[0x61:0x7B] = lut[0x80:] = True
    return lut


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, word starts and ends, and words per text, of texts laid end to end."""
    data = _fold_case()[raw]
    inside = _word_bytes()[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True                         # a word never crosses two texts
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return data, starts, ends, counts


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them, and where they lie now."""
    lengths = ends - starts
    new = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int((lengths + 1).sum()), 0x20, dtype=np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(new, lengths) + within] = data[np.repeat(starts, lengths) + within]
    return out, new, new + lengths


def feature_buckets(raw: np.ndarray, offsets: np.ndarray, max_words: int = MAX_WORDS,
                    buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all features, slice by slice."""
    data, starts, ends, counts = words_of(raw, offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    if max_words > 1 and len(starts):
        data, starts, ends = _joined(data, starts, ends)
    for n in range(1, max_words + 1):
        if len(starts) < n:
            return
        s, e, who = starts[:len(starts) - n + 1], ends[n - 1:], owner[:len(owner) - n + 1]
        whole = owner[n - 1:] == who             # all words of one text
        s, e, who = s[whole], e[whole], who[whole]
        part = (np.cumsum(e - s) - 1) // SLICE
        bounds = [*np.searchsorted(part, np.unique(part)), len(s)]
        for lo, hi in zip(bounds, bounds[1:]):
            yield who[lo:hi], (crc_spans(data, s[lo:hi], e[lo:hi]) % np.uint32(buckets)).astype(np.int64)


def _texts(column: pa.Array, limit: int = 16 * SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``limit`` bytes."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1)
        yield lo, hi, raw[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo]
        lo = hi


def bucket_counts(texts: DataFrame, text_col: str, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, raw, offsets in _texts(batch.column(0)):
                for _, bucket in feature_buckets(raw, offsets, max_words, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])
    prepare(texts.sparkSession)
    return texts.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, from the two bucket counts (``buckets`` numbers on the driver)."""
    both = corpus.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full")
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in both.collect():
        s[row.bucket], t[row.bucket] = row.s or 0, row.t or 0
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            words, features, weight = (np.zeros(size, dtype=np.int64) for _ in range(3))
            for lo, hi, raw, offsets in _texts(batch.column(1)):
                words[lo:hi] = words_of(raw, offsets)[3] if max_words > 1 else 0
                for who, bucket in feature_buckets(raw, offsets, max_words, len(gain)):
                    features[lo:hi] += np.bincount(who, minlength=hi - lo)
                    # Sums of whole numbers far below 2^53: exact in doubles.
                    weight[lo:hi] += np.bincount(who, weights=gain[bucket], minlength=hi - lo).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words if max_words > 1 else features), pa.array(features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])
    prepare(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             max_words: int = MAX_WORDS, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every row of ``docs``."""
    gain = gains(bucket_counts(docs, text_col, max_words, buckets),
                 bucket_counts(target, target_col, max_words, buckets), buckets)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = cut(weigh(docs, gain, id_col, text_col, max_words).withColumn(
        "score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))).withColumn("_able", F.col("n_words") >= min_words),
        "importance-weights")                                 # read by the sort's sample, the sort and the count
    placed = with_global_positions(
        scored, F.col("_able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
        F.col("weight").desc(), F.col("n_features"), name="_place")
    drawn = scored.agg(F.expr(f"count_if(_able) * {percent} div 100").alias("_drawn"))
    return placed.join(F.broadcast(drawn)).select(            # one row
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("_able") & (F.col("_place") <= F.col("_drawn")), F.col("_place")).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns (ids must be unique and not null)."""
    id_col = options.get("id_col", "doc_id")
    kept = resample(docs, target, **options).where("rank is not null").select(F.col("doc_id").alias(id_col))
    return docs.join(kept, id_col, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: crc32 byte by byte over a table that the SQL derives itself, once per distinct word.
CRC_CTES = f"""
bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, {POLY}) ELSE r >> 1 END, CAST(b AS BIGINT))) AS crc_table
)"""


def crc_of(expr: str) -> str:
    """DuckDB SQL: crc32 of a text's UTF-8 bytes; ``crc_table`` in scope."""
    return f"""xor(4294967295, list_reduce(
      list_transform(range(CAST(length(hex(encode({expr}))) / 2 AS BIGINT)),
        lambda i: CAST('0x' || substr(hex(encode({expr})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
      lambda r, b: xor(r >> 8, crc_table[CAST(xor(r & 255, b) AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)))"""


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

ORACLE = f"""
WITH {CRC_CTES},
doc_words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
target_words AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
vocabulary AS (SELECT DISTINCT unnest(ws) AS w FROM doc_words UNION SELECT w FROM target_words),
hashed AS (SELECT w, {crc_of("w")} % {BUCKETS} AS bucket FROM vocabulary, bits),
exploded AS (SELECT doc_id, unnest(ws) AS w FROM doc_words),
s AS (SELECT bucket, count(*) AS s FROM exploded JOIN hashed USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN hashed USING (w) GROUP BY 1),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS})::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
),
weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM exploded JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1
),
scored AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM doc_words d LEFT JOIN weights USING (doc_id)
),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * {PERCENT} // 100 AS drawn
  FROM scored WHERE n_features >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CAST(rank AS BIGINT) AS rank
FROM scored LEFT JOIN (SELECT doc_id, rank FROM placed WHERE rank <= drawn) USING (doc_id)
"""


@query("op12_importance_resampling", ORACLE)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
