"""Exact deduplication by Grace hashing.

1. Every scan task folds its rows into an open-addressing table (content -> largest id,
   row count), so a content that a third of all rows share leaves each task once.
2. The folded records are partitioned by a hash of the content (the Spark shuffle).
3. A bucket that does not fit the memory bound is partitioned again, recursively, by
   fresh hash digits into spill files, until each part fits an open-addressing table.
   Equality is always decided on the complete content, never on the hash alone.

Spill files belong to one task attempt: nothing else reads them and they go before the
task ends, so a lost executor costs a task retry and nothing more.

Defined results: a null text equals an empty text; a null id loses against any other id;
rows with equal text and equal id are copies too (``ties`` counts the rows that carry the
winning id); an empty table gives an empty result. Only the two named columns are read,
so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import query, table

#: Bytes of distinct content one table may hold before its bucket is partitioned again.
TABLE_BYTES = 48 << 20
#: Parts a bucket is split into at each level of the recursion.
FANOUT = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Record = tuple[bytes, int | None, int, int]  # content, keep id, rows, rows that carry the keep id


class ContentTable:
    """Open addressing with linear probing; entries compare complete contents."""

    def __init__(self, slots: int = 1024) -> None:
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, content: bytes, keep: int | None, rows: int, ties: int) -> None:
        h = xxhash.xxh3_64_intdigest(content)
        mask = len(self.slots) - 1
        at = h & mask
        while (e := self.slots[at]) >= 0:
            entry = self.entries[e]
            if self.hashes[e] == h and entry[0] == content:
                entry[2] += rows
                if keep == entry[1]:
                    entry[3] += ties
                elif entry[1] is None or (keep is not None and keep > entry[1]):
                    entry[1], entry[3] = keep, ties
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.hashes.append(h)
        self.entries.append([content, keep, rows, ties])
        self.bytes += len(content) + 200
        if 2 * len(self.entries) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for e, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = e


_HEAD = struct.Struct("<?qqqI")


def _write(fh, content: bytes, keep: int | None, rows: int, ties: int) -> None:
    fh.write(_HEAD.pack(keep is None, keep or 0, rows, ties, len(content)))
    fh.write(content)


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb") as fh:
        while head := fh.read(_HEAD.size):
            missing, keep, rows, ties, size = _HEAD.unpack(head)
            yield fh.read(size), None if missing else keep, rows, ties


def grace(records: Iterable[Record], table_bytes: int = TABLE_BYTES, level: int = 0) -> Iterator[list]:
    """Merge records of equal content, in bounded memory. ``level`` seeds the digit that
    deals the records of an oversized bucket to its parts."""
    records, held = iter(records), ContentTable()
    for record in records:
        held.add(*record)
        if held.bytes > table_bytes and len(held.entries) > 1:
            break
    else:
        yield from held.entries
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        paths = [os.path.join(folder, f"{k}") for k in range(FANOUT)]
        parts = [open(p, "wb", buffering=1 << 16) for p in paths]
        try:
            for source in (held.entries, records):
                for content, keep, rows, ties in source:
                    digit = xxhash.xxh3_64_intdigest(content, seed=level + 1) % FANOUT
                    _write(parts[digit], content, keep, rows, ties)
                if source is held.entries:
                    held = ContentTable()
        finally:
            for fh in parts:
                fh.close()
        for path in paths:
            yield from grace(_read(path), table_bytes, level + 1)
            os.remove(path)


def _contents(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    texts = pc.cast(batch.column("text"), pa.large_binary())
    for i, raw in zip(batch.column("doc_id").to_pylist(), texts):
        raw = raw.as_py()
        yield i, raw.lower() if raw else b""   # bytes.lower() changes A-Z only


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map side: one record per distinct content and table-full of a scan task."""
    def out(held: ContentTable) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(held.entries), 500):
            rows = held.entries[k:k + 500]
            yield pa.RecordBatch.from_arrays([
                pa.array([h - (1 << 63) for h in held.hashes[k:k + 500]], pa.int64()),
                pa.array([r[0] for r in rows], pa.binary()),
                *(pa.array([r[c] for r in rows], pa.int64()) for c in (1, 2, 3)),
            ], ["bucket", "content", "keep_id", "n", "ties"])

    held = ContentTable()
    for batch in batches:
        for i, content in _contents(batch):
            held.add(content, i, 1, 1)
            if held.bytes > TABLE_BYTES:
                yield from out(held)
                held = ContentTable()
    yield from out(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[Record]:
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("content", "keep_id", "n", "ties")))

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.string()),
            *(pa.array([r[c] for r in rows], pa.int64()) for c in (1, 2, 3)),
        ], ["text_sha256", "keep_id", "group_size", "ties"])

    rows: list = []
    for content, keep, n, ties in grace(records()):
        rows.append((hashlib.sha256(content).hexdigest(), keep, n, ties))
        if len(rows) == 5000:
            yield batch(rows)
            rows = []
    yield batch(rows)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256(content).hexdigest() for _, content in _contents(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.string())],
                                         ["doc_id", "text_sha256"])


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct content: text_sha256 (of the text after lower-casing A-Z),
    keep_id (largest id), group_size (rows), ties (rows that carry keep_id)."""
    folded = _narrow(docs, id_col, text_col).mapInArrow(
        _fold, "bucket long, content binary, keep_id long, n long, ties long")
    return folded.repartition("bucket").mapInArrow(
        _merge, "text_sha256 string, keep_id long, group_size long, ties long")


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept,
    text_sha256, ties. Only ids and digests are joined back, never texts; a digest that
    very many rows share is a skewed join key that Spark splits at run time."""
    members = _narrow(docs, id_col, text_col).mapInArrow(_digest, "doc_id long, text_sha256 string")
    return members.join(copy_groups(docs, id_col, text_col), "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "ties")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their own columns. Rows that repeat the winning id with an
    equal text are reduced to one."""
    plain = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    wide = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(id_col).cast("long").alias("doc_id"), F.sha2(plain, 256).alias("text_sha256"))
    groups = copy_groups(docs, id_col, text_col).alias("g")
    kept = wide.alias("w").join(groups, (F.col("w.text_sha256") == F.col("g.text_sha256"))
                                & F.col("w.doc_id").eqNullSafe(F.col("g.keep_id"))
                                ).select("row", F.col("w.text_sha256").alias("text_sha256"), "ties")
    single = kept.where("ties = 1").select("row.*")
    repeated = kept.where("ties > 1").groupBy("text_sha256").agg(F.min("row").alias("row")).select("row.*")
    return single.unionByName(repeated)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""


@query("op4_exact_dedup", ORACLE)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents")).drop("ties")
