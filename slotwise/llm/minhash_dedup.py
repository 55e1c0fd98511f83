"""Near duplicates by an inverted join of MinHash coordinates.

1. Texts of equal word sequence form a class; its smallest id stands for it.
2. Each class gets ``COORDINATES`` MinHash values of its shingle set. Two sets that are
   similar to 0.8 or more agree in fewer than ``MATCHES`` of the 64 coordinates with a
   probability below 1 in 10,000 (binomial tail at exactly 0.8, less above).
3. Classes are posted under their (coordinate, value) pairs. Prefix rule: order pairs by
   how many classes hold them; two classes that agree in at least ``MATCHES`` coordinates
   share a pair among their ``COORDINATES - MATCHES + 1`` rarest ones, so only those are
   merged; the frequent lists are skipped, and classes with too few shared pairs drop out.
4. Within a posting list, agreeing coordinates are counted; only links that join parts not
   yet joined leave the list. A list longer than ``BLOCK`` is cut into blocks, and every
   pair of blocks is one group, so no list lands in one task.
5. Connected parts of these links hold every pair above the match threshold. Each part is
   settled on the full sets: exact link test 100 * |A & B| >= 80 * |A | B|. Parts whose sets
   go beyond ``PART_SHINGLES`` are cut into blocks in the same way.

Rows that leave a group number at most as many as enter, however similar its members are:
components need no list of all pairs.

Defined results: texts without words (null, empty, only white space) have an empty set and
are linked with nothing; a text with fewer words than the shingle width has one shingle, the
whole sequence; a null id is linked with nothing and has a null component; rows of equal
text are one class, whatever their ids; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, query, table
from slotwise.llm.groups import components, in_runs, runs
from slotwise.llm.shingles import numbers, sequence, words

COORDINATES, MATCHES = 64, 38
#: Classes of one posting list (of each side) and shingles of one part (of each side) that a
#: task holds at once.
BLOCK, PART_SHINGLES = 8_000, 1_500_000
SIMILAR = 80

_RNG = np.random.RandomState(20_011)
_MULTIPLY = _RNG.randint(0, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.randint(0, 1 << 62, COORDINATES, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``COORDINATES`` MinHash values (32 bits each) of a set of 64-bit numbers."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[k:k + 4096, None] * _MULTIPLY + _ADD).min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size, sig = [], [], []
            for raw in pc.cast(batch.column("text"), pa.large_binary()):
                found = words(raw.as_py())
                shingles = np.unique(sequence(numbers(found), width))
                key.append(xxhash.xxh3_128_digest(b" ".join(found)))
                size.append(len(shingles))
                sig.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(key, pa.binary()), pa.array(size, pa.int64()), pa.array(sig, pa.binary())],
                ["doc_id", "key", "n", "sig"])
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, pair): a class under each of its coordinate-value pairs."""
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
        ids = np.repeat(np.asarray(batch.column("id")), COORDINATES)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((sig.astype(np.int64) + coordinate).ravel())], ["id", "pair"])


class Forest:
    """Union-find that knows the members of each part."""

    def __init__(self, n: int) -> None:
        self.part = np.arange(n)
        self.size = np.ones(n, dtype=np.int64)

    def join(self, members: np.ndarray) -> None:
        parts = np.unique(self.part[members])
        if len(parts) > 1:
            keep = parts[np.argmax(self.size[parts])]
            self.size[keep] = self.size[parts].sum()
            self.part[np.isin(self.part, parts)] = keep

    def settle(self, linked) -> None:
        """Join by ``linked(i) -> members linked with i``. A link between two parts has an end
        outside the largest part, so members inside it need no look of their own."""
        done = np.zeros(len(self.part), dtype=bool)
        while True:
            largest = self.part[np.argmax(self.size[self.part])]
            todo = np.flatnonzero(~done & (self.part != largest))
            if not len(todo):
                return
            for i in todo:
                if not done[i] and self.part[i] != largest:
                    done[i] = True
                    self.join(np.append(linked(i), i))
                    largest = self.part[np.argmax(self.size[self.part])]

    def links(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each member beside the smallest id of its part."""
        order = np.argsort(ids, kind="stable")
        least = np.full(len(ids), -1)
        for i in order[::-1]:
            least[self.part[i]] = i
        root = ids[least[self.part]]
        apart = ids != root
        return ids[apart], root[apart]


def _links_in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per posting list: links between classes that agree in enough coordinates."""
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (a, b)], ["a", "b"])

    for run in runs(batches, ["pair", "i", "j"]):
        if run.num_rows < 2:
            continue
        ids, n = run.column("id").to_numpy(), run.column("n").to_numpy()
        sig = np.frombuffer(b"".join(run.column("sig").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)

        def linked(i: int, ids=ids, n=n, sig=sig) -> np.ndarray:
            fits = np.flatnonzero((100 * n >= SIMILAR * n[i]) & (100 * n[i] >= SIMILAR * n))
            return fits[(sig[fits] == sig[i]).sum(1) >= MATCHES]

        forest = Forest(len(ids))
        forest.settle(linked)
        x, y = forest.links(ids)
        a.append(x)
        b.append(y)
        if sum(map(len, a)) > 20_000:
            yield out()
            a.clear()
            b.clear()
    yield out()


def exact_links(sets: list[np.ndarray]):
    """``linked(i)`` over shingle sets: by an inverted index, the members with
    100 * intersection >= 80 * union."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, value = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(value, kind="stable")
    holders = owner[order]
    starts = np.searchsorted(value[order], np.arange(value.max() + 2))
    begin = np.concatenate([[0], np.cumsum(size)])

    def linked(i: int) -> np.ndarray:
        own = value[begin[i]:begin[i + 1]]
        lengths = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(holders[at], minlength=len(sets))
        return np.flatnonzero(100 * common >= SIMILAR * (size + size[i] - common))
    return linked


def _settle_parts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["root", "i", "j"]):
            ids, sets = [], []
            for i, key, raw in zip(part.column("id").to_pylist(), part.column("key").to_pylist(),
                                   pc.cast(part.column("text"), pa.large_binary()).to_pylist()):
                found = words(raw)
                if xxhash.xxh3_128_digest(b" ".join(found)) == key and i not in ids[-1:]:
                    ids.append(i)
                    sets.append(np.unique(sequence(numbers(found), width)))
            if len(ids) > 1:
                forest = Forest(len(ids))
                forest.settle(exact_links(sets))
                x, y = forest.links(np.array(ids, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
    return run


def _block_pairs(df: DataFrame, blocks: Column, id_col: str = "id") -> DataFrame:
    """A row for each pair of blocks (i <= j) that the row's block is in."""
    own = F.pmod(F.xxhash64(id_col), F.col("_blocks"))
    return df.withColumn("_blocks", blocks).withColumn("_own", own) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))) \
        .withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")) \
        .drop("_blocks", "_own", "_other")


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over
    links of similarity 0.8 or more, itself included), kept (doc_id = component_id)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = cut(narrow.mapInArrow(_sketch(width), "doc_id long, key binary, n long, sig binary"), "sketch")
    classes = sketch.where("n > 0 AND doc_id IS NOT NULL").groupBy("key") \
        .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = cut(classes, "classes")

    posted = classes.select("id", "sig").mapInArrow(_pairs, "id long, pair long")
    shared = posted.groupBy("pair").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    prefix = posted.join(shared, "pair").groupBy("id") \
        .agg(F.sort_array(F.collect_list(F.struct("df", "pair"))).alias("held")) \
        .where(F.size("held") >= MATCHES) \
        .select("id", F.explode(F.slice("held", F.lit(1), F.size("held") - (MATCHES - 1))).alias("p"))
    lists = prefix.join(classes.select("id", "n", "sig"), "id").select("id", "n", "sig", "p.pair", "p.df")
    lists = _block_pairs(lists, F.ceil(F.col("df") / BLOCK)).drop("df")
    parts = components(in_runs(lists, "pair", "i", "j").mapInArrow(_links_in_lists, "a long, b long"), "near-parts")

    members = parts.join(classes.select(F.col("id").alias("node"), "key", "n"), "node")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / PART_SHINGLES).alias("blocks"))
    members = members.join(blocks, "root").select(F.col("node").alias("id"), "root", "key", "blocks")
    texts = members.join(narrow.select(F.col("doc_id").alias("id"), "text"), "id")
    texts = _block_pairs(texts, F.col("blocks")).select("root", "i", "j", "id", "key", "text")
    links = texts.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "id") \
        .mapInArrow(_settle_parts(width), "a long, b long")
    joined = components(links, "near-links")

    of_class = classes.select("key", "id").join(joined.select(F.col("node").alias("id"), "root"), "id", "left") \
        .select("key", F.coalesce("root", "id").alias("component"))
    out = sketch.select("doc_id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key")).join(of_class, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """The documents that stay, one of each group, with their own columns.

    Rows of an id that repeats with different texts are told apart by their texts (each stays or
    goes for itself; in a group, such rows count as the smallest ids). Of rows that repeat id and text, one
    stays (by the order of their columns), if they have a word. Rows without id or word stay."""
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    number = F.col("doc_id").cast("long")
    several = docs.where("doc_id IS NOT NULL").groupBy(number.alias("_several")).agg(
        F.min(mark).alias("least"), F.max(mark).alias("most")).where("least <> most").select("_several")
    several = cut(several, "repeated-ids")                # few or none: the planner sees its size
    # below all ids that count upwards; as far apart as 62-bit hashes are
    own = F.when(F.col("_several").isNull(), number).otherwise(-F.shiftrightunsigned(F.xxhash64(number, mark), 2) - (1 << 61))
    numbered = docs.join(several, number == F.col("_several"), "left").withColumn("_own", own)
    marked = cut(near_duplicates(numbered.select("_own", "text"), width, id_col="_own"), "near-marks")
    gone = marked.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    again = cut(marked.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id")
                .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("_again")), "near-repeats")
    kept = numbered.join(gone, numbered["_own"] == gone["_gone"], "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = kept.join(again, kept["_own"] == again["_again"], "left_anti").select(*columns)
    one = kept.join(again, kept["_own"] == again["_again"], "left_semi").groupBy("_own") \
        .agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return once.unionByName(one)


@query("op3_minhash_dedup")
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
