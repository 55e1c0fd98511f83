"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

The rank file gives byte strings and their merge order. Each byte is mapped to one
printable character (the usual byte-to-character table), so the library works on
characters; a token's merge rule is the last pair that its own bytes merge by, which
gives the library the same merges as the ranks themselves (a span of bytes always goes
through the same merges, whatever stands around it). Pieces that are whole tokens are
taken as such. Character offsets of every token come with the ids.

Decoding reverses the table: ids to characters to bytes. A character whose bytes lie in
more than one token is whole again after joining; bytes that form no character (ids cut
in the middle) become U+FFFD in ``decode_text`` and stay as they are in ``decode_bytes``.

Defined results: a null or empty text has no tokens and decodes to nothing; a text of any
length is encoded whole; repeated rows give repeated results; only the named columns are
read. Unknown ids raise.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import query, table

#: Characters of text handed to the library at once (bounds the encodings held).
CHUNK_CHARS = 1 << 19
#: Stretches of text whose ids a Python worker remembers at most, and the longest one.
MEMO_ENTRIES, MEMO_CHARS = 600_000, 64
#: A space before a visible character (Python's \\s covers every white-space character).
_STRETCH = re.compile(r" (?=\S)")


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """Byte -> character: printable Latin-1 bytes stand for themselves, the others for
    the characters from U+0100 on, in order."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as fh:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge gives ``token``; None if its bytes never merge to it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        best, at = min(((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1)))
        if best >= limit:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class ByteBPE:
    def __init__(self, ranks_path: str, pattern: str) -> None:
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(ranks_path)
        char = byte_characters()
        spell = lambda token: "".join(char[b] for b in token)
        pairs = ((rank, last_pair(token, ranks)) for token, rank in ranks.items() if len(token) > 1)
        merges = [(spell(p[0]), spell(p[1])) for _, p in sorted((x for x in pairs if x[1]), key=lambda x: x[0])]
        self.size = max(ranks.values()) + 1
        self.memo: dict[str, bytes] = {}
        vocab = {spell(token): rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        back = {c: b for b, c in enumerate(char)}
        self.bytes_of: list[bytes | None] = [None] * self.size
        for text, rank in vocab.items():
            self.bytes_of[rank] = bytes(back[c] for c in text)

    def encode(self, texts: list[str | None]) -> Iterator:
        """One encoding (``ids``, ``offsets``) per text, in order."""
        chunk: list[str] = []
        held = 0
        for text in texts:
            chunk.append(text or "")
            held += len(chunk[-1])
            if held >= CHUNK_CHARS:
                yield from self.tokenizer.encode_batch(chunk, add_special_tokens=False)
                chunk, held = [], 0
        if chunk:
            yield from self.tokenizer.encode_batch(chunk, add_special_tokens=False)

    def encode_ids(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, without offsets. The pattern always parts a text before
        a space that a visible character follows, so the stretches between such places
        encode independently; the library sees each short stretch once per memo-full."""
        cut = [_STRETCH.split(text or "") for text in texts]
        known = [list(map(self.memo.get, stretches[1:])) for stretches in cut]
        fresh = {x for stretches, tail in zip(cut, known) if None in tail
                 for x, t in zip(stretches[1:], tail) if t is None and len(x) <= MEMO_CHARS}
        if len(self.memo) + len(fresh) > MEMO_ENTRIES:
            self.memo.clear()
        fresh = list(fresh)
        for x, e in zip(fresh, self.tokenizer.encode_batch_fast([" " + x for x in fresh], add_special_tokens=False)):
            self.memo[x] = array("I", e.ids).tobytes()
        for stretches, tail in zip(cut, known):
            if None in tail:
                tail = [t or self.memo.get(x) or self._plain(" " + x) for x, t in zip(stretches[1:], tail)]
            yield np.frombuffer(self._plain(stretches[0]) + b"".join(tail), dtype=np.uint32)

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_text(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str) -> ByteBPE:
    """One tokenizer per Python worker."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
    return ByteBPE(ranks_path, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _narrow(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def _sub(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for k in range(0, max(1, batch.num_rows), rows):
        yield batch.slice(k, rows)


def encode_documents(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, starts array<int>, ends array<int>: the token ids of each
    whole text and, per token, the span of characters it comes from."""
    path, pat = ranks_path or default_vocabulary()[0], pattern or default_vocabulary()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pat)
        for whole in batches:
            for batch in _sub(whole, 100):
                ids, starts, ends = [], [], []
                for e in bpe.encode(batch.column("text").to_pylist()):
                    spans = np.asarray(e.offsets, dtype=np.int32).reshape(-1, 2)
                    ids.append(np.asarray(e.ids, dtype=np.int32))
                    starts.append(spans[:, 0])
                    ends.append(spans[:, 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(x, pa.list_(pa.int32())) for x in (ids, starts, ends))],
                    ["doc_id", "ids", "starts", "ends"])

    return _narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
                     id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, content binary (the exact bytes), text string (bytes that form no
    character replaced)."""
    path, pat = ranks_path or default_vocabulary()[0], pattern or default_vocabulary()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pat)
        for whole in batches:
            for batch in _sub(whole, 100):
                content = [bpe.decode_bytes(i or []) for i in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(content, pa.binary()),
                     pa.array([c.decode("utf-8", errors="replace") for c in content], pa.string())],
                    ["doc_id", "content", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")) \
        .mapInArrow(run, "doc_id long, content binary, text string")


def token_digests(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text", place_col: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (the bytes that the ids decode to); with ``place_col`` also that column, as a
    whole number named position. Encodes and decodes in one pass, so
    the id lists never leave the task."""
    path, pat = ranks_path or default_vocabulary()[0], pattern or default_vocabulary()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pat)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for sub in _sub(batch, 200):
                for ids in bpe.encode_ids(sub.column("text").to_pylist()):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode_bytes(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string()), *(batch.column(c) for c in place)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *place])

    place = ["position"] if place_col else []
    narrow = _narrow(docs, id_col, text_col, *(F.col(place_col).cast("long").alias(c) for c in place))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
                             + "".join(f", {c} long" for c in place))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
