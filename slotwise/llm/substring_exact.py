"""Removal of every byte covered by a string of ``THRESHOLD`` bytes that also starts elsewhere:
suffixes ordered through ``THRESHOLD`` bytes only, by most-significant-digit passes.

Only the order through the threshold counts: suffixes equal that far form the groups of
repeated windows. They are dealt in three steps, each exact:

1. First digit, content-chosen. Every window takes the least hash of its ``GRAM``-byte pieces
   (leftmost if several); equal windows take the same piece at the same place. Consecutive
   starts share their piece, so a text gives about one row (piece hash, place, range of starts)
   per 185 bytes instead of one per suffix. A piece that stands once in the corpus has no
   repeated window; rows of the others go on with the bytes that their windows cover.
2. Rows of one task with equal bytes settle among themselves and leave as one row.
3. Rows of a piece meet in one group: small groups are compared pair by pair from the piece
   outwards; larger ones order each start's windows by passes over eight 50-byte digits, most
   significant first, dropping what a pass leaves alone. A piece held by more than ``GROUP``
   rows is dealt on by whole windows instead (counted with map-side combine), so no group grows
   beyond the bound.

Texts are shuffled by row for step 1's bytes and for the result. Digits and whole-window keys are
64 and 128 bits of hash; pairs in small groups are compared byte by byte.

Defined results: null counts as empty; texts shorter than the threshold lose nothing; matches
never cross documents; overlaps count; rows that repeat another row (equal id, null too, and text) are
documents of their own, so both lose what they share; an empty table gives an empty result; only
the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, query, table
from slotwise.llm.groups import in_runs, runs

THRESHOLD, GRAM, DIGIT = 400, 32, 50
#: Rows of a group; rows up to which pairs are compared.
GROUP, PAIRS = 8_000, 40
#: Bytes of a text looked at at once.
SEGMENT = 1 << 22

_BASE, _BASE2 = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_BYTES = np.random.RandomState(97).randint(1, 1 << 62, (2, 256), dtype=np.uint64)
_M = np.uint64(0xC2B2AE3D27D4EB4F)


def rolling(data: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit number of every run of ``width`` bytes (last axis), by doubling."""
    base = pow((_BASE, _BASE2)[which], 1, 1 << 64)
    out, have = None, 0
    power, size = _BYTES[which][data], 1                 # numbers of runs of `size` bytes
    rest = width
    while rest:
        if rest & 1:
            if out is None:
                out, have = power, size
            else:                                        # out covers `have` bytes, followed by `size` more
                n = out.shape[-1] - size
                out = out[..., :n] * np.uint64(pow(base, size, 1 << 64)) + power[..., have:have + n]
                have += size
        rest >>= 1
        if rest:
            power = power[..., :-size] * np.uint64(pow(base, size, 1 << 64)) + power[..., size:]
            size *= 2
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M
    return h ^ (h >> np.uint64(29))


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, last start) of each chosen piece of one text."""
    parts = []
    for base in range(0, max(0, len(data) - THRESHOLD + 1), SEGMENT):
        part = data[base:base + SEGMENT + THRESHOLD - 1]
        gram = mix(rolling(part, GRAM))
        span = THRESHOLD - GRAM + 1                      # pieces of one window
        mark = (gram >> np.uint64(24) << np.uint64(24)) | np.arange(len(gram), dtype=np.uint64)
        padded = np.full(-(-len(mark) // span) * span, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:len(mark)] = mark
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(part) - THRESHOLD + 1
        least = np.minimum(behind[:starts], ahead[span - 1:span - 1 + starts])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], starts) - 1
        parts.append((gram[at[first]].astype(np.int64), at[first] + base, first + base, last + base))
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _rows(batch: pa.RecordBatch) -> Iterator[bytes]:
    for raw in pc.cast(batch.column("text"), pa.large_binary()):
        yield raw.as_py() or b""


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2 = (np.asarray(batch.column(c)) for c in ("k1", "k2"))
        found = [pieces(np.frombuffer(raw, dtype=np.uint8)) for raw in _rows(batch)]
        n = [len(f[0]) for f in found]
        columns = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in zip(*found)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0]), pa.array(np.repeat(k1, n)), pa.array(np.repeat(k2, n)), *map(pa.array, columns[1:])],
            ["h", "k1", "k2", "place", "lo", "hi"])


def _spans(k1: list, k2: list, start: list, end: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k1, k2, start, end)], ["k1", "k2", "start", "end"])


_CONTEXT = "h long, k1 long, k2 long, place long, lo long, hi long, many boolean, hot boolean, bytes binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the windows of shared pieces. Equal rows of a batch leave as one that
    is marked; the others leave marked as settled, without bytes."""
    for batch in batches:
        seen: dict[tuple, int] = {}
        out: list[list] = []
        for k1, k2, raw, held in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), _rows(batch),
                                     batch.column("held").to_pylist()):
            for p in held:
                data = raw[p["lo"]:p["hi"] + THRESHOLD]
                key = (p["h"], p["place"] - p["lo"], data)
                row = [p["h"], k1, k2, p["place"], p["lo"], p["hi"], False, p["hot"], data]
                if key in seen:
                    out[seen[key]][6] = True
                    row[6], row[8] = True, None
                else:
                    seen[key] = len(out)
                out.append(row)
        for a in range(0, len(out), 2000):
            part = list(zip(*out[a:a + 2000]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in part[:6]), *(pa.array(c, pa.bool_()) for c in part[6:8]),
                 pa.array(part[8], pa.binary())], ["h", "k1", "k2", "place", "lo", "hi", "many", "hot", "bytes"])


def repeated_starts(contexts: list[bytes], before: np.ndarray, after: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per row, ranges (first, last) of window starts, counted back from the piece, whose
    windows another row has too. Row i has the starts ``after[i]`` <= o <= ``before[i]`` places
    before its piece; its bytes begin ``before[i]`` places before it."""
    n, left = len(contexts), THRESHOLD - GRAM
    grid = np.zeros((n, left + THRESHOLD), dtype=np.uint8)
    for i, c in enumerate(contexts):
        grid[i, left - before[i]:left - before[i] + len(c)] = np.frombuffer(c, dtype=np.uint8)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    if n <= PAIRS:
        for i in range(n - 1):
            same = grid[i] == grid[i + 1:]
            right = np.where(same[:, left:].all(1), THRESHOLD, np.argmin(same[:, left:], axis=1))
            back = same[:, left - 1::-1]
            reach = np.where(back.all(1), left, np.argmin(back, axis=1))
            most = np.minimum(np.minimum(reach, before[i]), before[i + 1:])
            least = np.maximum(np.maximum(THRESHOLD - right, after[i]), after[i + 1:])
            for j in np.flatnonzero(least <= most):
                found[i].append((int(least[j]), int(most[j])))
                found[i + 1 + j].append((int(least[j]), int(most[j])))
        return found
    digits = mix(rolling(grid, DIGIT))
    for o in range(int(after.min()), int(before.max()) + 1):
        live = np.flatnonzero((after <= o) & (o <= before))
        group = np.zeros(len(live), dtype=np.int64)
        for d in range(0, THRESHOLD, DIGIT):                # most significant digit first
            if len(live) < 2:
                live = live[:0]
                break
            column = digits[live, left - o + d]
            order = np.lexsort((column, group))
            step = (np.diff(group[order]) != 0) | (column[order][1:] != column[order][:-1])
            number = np.concatenate([[0], np.cumsum(step)])
            alone = np.bincount(number)[number] < 2         # nothing equal so far
            live, group = live[order][~alone], number[~alone]
        for i in live:
            runs_ = found[i]
            if runs_ and runs_[-1][1] == o - 1:
                runs_[-1] = (runs_[-1][0], o)
            else:
                runs_.append((o, o))
    return found


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: tuple[list, list, list, list] = ([], [], [], [])
    for run in runs(batches, ["h"]):
        if run.num_rows < 2:
            continue
        k1, k2, place, lo, hi, bytes_ = (run.column(c).to_pylist() for c in ("k1", "k2", "place", "lo", "hi", "bytes"))
        holders: dict[tuple[int, bytes], list[int]] = {}
        for i, b in enumerate(bytes_):
            holders.setdefault((place[i] - lo[i], b), []).append(i)
        keys = list(holders)
        if len(keys) > 1:
            before = np.array([k[0] for k in keys])
            after = np.array([place[h[0]] - hi[h[0]] for h in holders.values()])
            found = repeated_starts([k[1] for k in keys], before, after)
        else:
            found = [[]]
        for (_, rows), ranges in zip(holders.items(), found):
            for i in rows:
                for least, most in ([(place[i] - hi[i], place[i] - lo[i])] if len(rows) > 1 else ranges):
                    for column, x in zip(out, (k1[i], k2[i], place[i] - most, place[i] - least + THRESHOLD)):
                        column.append(x)
        if len(out[0]) > 5000:
            yield _spans(*out)
            out = ([], [], [], [])
    yield _spans(*out)


def _whole_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, k1, k2, start) for every window of the row."""
    for batch in batches:
        for k1, k2, lo, raw in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "lo", "bytes"))):
            data = np.frombuffer(raw, dtype=np.uint8)
            w1, w2 = (mix(rolling(data, THRESHOLD, which)).astype(np.int64) for which in (0, 1))
            n = len(w1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1), pa.array(w2), pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), pa.array(lo + np.arange(n))],
                ["w1", "w2", "k1", "k2", "start"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a 128-bit key of the row (rows of equal id and text share it)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return narrow.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"),
                         F.xxhash64("text", F.lit(1), "doc_id").alias("k2"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, start, end) of repeated stretches; ``docs``: text, k1, k2."""
    found = cut(docs.select("k1", "k2", "text").mapInArrow(
        _pieces, "h long, k1 long, k2 long, place long, lo long, hi long"), "pieces")
    shared = found.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1") \
        .select("h", (F.col("df") > GROUP).alias("hot"))
    shared = cut(shared, "shared-pieces")       # a plain side of the join: Spark can split a very common piece
    held = found.join(shared, "h").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("h", "place", "lo", "hi", "hot")).alias("held"))
    contexts = docs.select("k1", "k2", "text").join(held, ["k1", "k2"]).select("k1", "k2", "text", "held") \
        .mapInArrow(_contexts, _CONTEXT)
    contexts = cut(contexts, "contexts")
    settled = contexts.where("many").select("k1", "k2", F.col("lo").alias("start"), (F.col("hi") + THRESHOLD).alias("end"))
    open_ = contexts.where("bytes IS NOT NULL")
    schema = "k1 long, k2 long, start long, end long"
    spans = in_runs(open_.where("NOT hot").drop("many", "hot"), "h").mapInArrow(_settle, schema)
    windows = open_.where("hot").select("k1", "k2", "lo", "bytes") \
        .mapInArrow(_whole_windows, "w1 long, w2 long, k1 long, k2 long, start long")
    often = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hot = windows.join(often, ["w1", "w2"]).select("k1", "k2", "start", (F.col("start") + THRESHOLD).alias("end"))
    return settled.unionByName(spans).unionByName(hot)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for raw, spans in zip(_rows(batch), batch.column("spans").to_pylist()):
            gone = merged([(s["start"], min(s["end"], len(raw))) for s in spans or []]) if len(raw) >= THRESHOLD else []
            kept, at = [], 0
            for a, z in gone:
                kept.append(raw[at:a])
                at = z
            kept = b"".join([*kept, raw[at:]])
            rows.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
        n, removed, count, digest, kept = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, removed, count)), pa.array(digest, pa.string()),
             pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256, kept (the remaining bytes)."""
    keyed = _keyed(docs, id_col, text_col)
    # Rows that repeat a row lose all their windows to it; one of them stands for all in the search.
    repeated = cut(keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2"), "repeated-rows")
    texts = keyed.select("k1", "k2", "text")
    once = texts.join(repeated, ["k1", "k2"], "left_anti") \
        .unionByName(texts.join(repeated, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text")))
    whole = repeated.select("k1", "k2", F.lit(0).cast("long").alias("start"), F.lit(1 << 62).alias("end"))
    spans = repeated_spans(once).join(repeated, ["k1", "k2"], "left_anti").unionByName(whole) \
        .groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return keyed.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


@query("op8_repeated_substrings")
def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
