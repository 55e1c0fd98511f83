"""Conversation structure repair: the cheapest edits that turn a conversation's rows into
``(system? (user assistant)+)?``, with an audit of the edits.

Method (grammar-compressed DP). A row is one letter: its role's initial and its first fault.
Re-Pair compresses the letters of all conversations together: in every round the most
frequent neighbouring pairs become new symbols. A symbol has one min-plus matrix over the
four states of the target pattern (nothing yet, after system, after user, after assistant);
an entry is a cost and, as a rope, the ASCII-least audit of that cost. A rule's matrix is the
product of its two parts', made once, bottom-up, and used by all conversations. A conversation
is a row of few symbols, and the conversations that share their letters share the result.

Scale. Rows are put in order by a range sort without their texts (a conversation may lie in
many partitions) and cut into chunks of at most ``CHUNK`` rows; only distinct chunks go
through grammar and matrices. Conversations of several chunks multiply their matrices in
groups of ``FAN_IN``, level by level. Repeated (role, text) rows come from an aggregate, so a
repeated turn is no hot group. Pair counts and at most ``RULES`` rules reach the driver, a
few per round. What is left of a letter row when the grammar ends is multiplied out, so the
bound changes no result. Writing a repaired conversation out (``repaired_rows``) and digesting
it is one ordered stream per conversation, batch by batch: a task holds one Arrow batch and one
audit, but a conversation's text passes through one task, as its digest demands.

Edits and costs: Keep 0; Rerole to user or assistant 3; Delete 4 (a must for blank and
duplicate rows); Insert an empty user or assistant row 3; a truncated row that stays adds 3.
Faults, the first that holds: blank (nothing but white space), duplicate (role and text
seen earlier in the conversation), truncated (the last visible character is not one of .!?).

Defined results. Null role or text counts as one space, a null conv_id or turn as one space
in the damage key; null conv_ids form one conversation. Rows of a conversation go by turn
(nulls first), those of one turn by role, then by the text's sha256. A role that begins with none of s, u, a fits
nowhere without rerole or delete. Repeated rows are rows (the later ones duplicates).
A conversation without rows: zeros, empty audit, digest of the empty string. Very long
texts are hashed whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import cut, prepare, query, table
from slotwise.llm.importance import CRC_CTES, crc_of

CHUNK_BITS = 10                  # a chunk has at most 2^10 rows
FAN_IN = 32
ROUNDS, RULES_A_ROUND = 12, 4    # Re-Pair rounds and rules per round; RULES is their product
RULES = ROUNDS * RULES_A_ROUND
FIRST_RULE = 0x100               # code point of the first rule's symbol
FLAT = 256                       # audits up to so many letters are plain strings
WHITE = " \t\n\x0b\x0c\r"

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"

#: Letters: initial s, u, a or another, times fault: none, truncated, blank, duplicate.
LETTERS = {"none": "suao", "truncated": "SUAO", "blank": "0123", "duplicate": "4567"}
ALL_LETTERS = "".join(LETTERS.values())
INITIALS = "suao" * 4
FOR_DP = LETTERS["none"] + LETTERS["truncated"] + "x" * 8      # blank and duplicate rows must go


# ------------------------------------------------------------------ ropes and matrices
class Rope:
    """A text as two parts, shared by all that contain it."""
    __slots__ = ("left", "right", "size")

    def __init__(self, left: "str | Rope", right: "str | Rope") -> None:
        self.left, self.right, self.size = left, right, size_of(left) + size_of(right)


def size_of(part: str | Rope) -> int:
    return len(part) if isinstance(part, str) else part.size


def join(a: str | Rope, b: str | Rope) -> str | Rope:
    if not size_of(a) or not size_of(b):
        return b if not size_of(a) else a
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= FLAT:
        return a + b
    return Rope(a, b)


def text_of(part: str | Rope) -> str:
    out, stack = [], [part]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack += (x.right, x.left)
    return "".join(out)


def less(a: str | Rope, b: str | Rope) -> bool:
    """a < b, character by character; parts that both share are skipped."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
        elif isinstance(x, str) or (not isinstance(y, str) and y.size >= x.size):
            left.append(x)
            right += (y.right, y.left)
        else:
            left += (x.right, x.left)
            right.append(y)
    return bool(right)


#: A matrix: [from][to] -> (cost, audit) or None. States: nothing yet, after system, user, assistant.
Matrix = list[list[tuple[int, "str | Rope"] | None]]
STATES = range(4)
AFTER = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),), "o": ()}
ACCEPTED = (0, 3)


def better(a, b):
    if a is None or b is None:
        return a or b
    return b if b[0] < a[0] or b[0] == a[0] and less(b[1], a[1]) else a


def times_row(row: Sequence, matrix: Matrix) -> list:
    """A row of entries times a matrix. The least audit of a product is the product of least
    audits: of two audits of one cost over the same rows none begins with the other (what
    follows would be inserts, which cost)."""
    out = []
    for j in STATES:
        best = None
        for k in STATES:
            x, y = row[k], matrix[k][j]
            if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                best = better(best, (x[0] + y[0], join(x[1], y[1])))
        out.append(best)
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return [times_row(row, b) for row in a]


def insertions() -> Matrix:
    """Cheapest inserts between two states (longer ways round cost more)."""
    out: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        out[i][i] = (0, "")
    for i, j, n in ((0, 2, 1), (0, 3, 2), (1, 2, 1), (1, 3, 2), (2, 3, 1), (3, 2, 1)):
        out[i][j] = (INSERT * n, "I" * n)
    return out


def letter_matrix(letter: str) -> Matrix:
    """Inserts, then what may be done with one row."""
    row: Matrix = [[None] * 4 for _ in STATES]
    for i in STATES:
        row[i][i] = (DELETE, "D")
    if letter != "x":
        extra = CUT_SHORT if letter.isupper() else 0
        for to in "ua":
            for i, j in AFTER[to]:
                row[i][j] = better(row[i][j], (REROLE + extra, "R"))
        for i, j in AFTER[letter.lower()]:
            row[i][j] = better(row[i][j], (KEEP + extra, "K"))
    return times(insertions(), row)


class Grammar:
    """Matrices of letters and rules; rules are (symbol, left, right), parts first."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]) -> None:
        self.matrix = {c: letter_matrix(c) for c in sorted(set(FOR_DP))}
        for symbol, left, right in rules:
            self.matrix[symbol] = times(self.matrix[left], self.matrix[right])

    def product(self, symbols: str) -> Matrix:
        out = self.matrix[symbols[0]]
        for c in symbols[1:]:
            out = times(out, self.matrix[c])
        return out

    def whole(self, symbols: str) -> tuple[int, str]:
        row: list = [(0, ""), None, None, None]
        for c in symbols:
            row = times_row(row, self.matrix[c])
        return finish(row)


def finish(row: Sequence) -> tuple[int, str]:
    ends = times_row(row, insertions())
    best = None
    for j in ACCEPTED:
        best = better(best, ends[j])
    return best[0], text_of(best[1])


def _packed(matrix: Matrix) -> tuple[list, list]:
    flat = [e for row in matrix for e in row]
    return [None if e is None else e[0] for e in flat], [None if e is None else text_of(e[1]) for e in flat]


def _unpacked(costs: Sequence, audits: Sequence) -> Matrix:
    flat = [None if c is None else (c, a) for c, a in zip(costs, audits)]
    return [flat[4 * i:4 * i + 4] for i in STATES]


# ------------------------------------------------------------------ rows, faults, letters
def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text after the damage that crc32(`conv_id:turn`) % 20 names: 0 drops
    the row, 1 empties the text, 2 removes its [.!?], 3 repeats the row, 4 sets role user."""
    col = lambda c: F.col(f"`{c}`")
    as_text = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text(conv_col), F.lit(":"), as_text(turn_col)).cast("binary")) % 20
    rows = conversations.select(
        col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"), as_text(role_col).alias("role"),
        as_text(text_col).alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", F.when(F.col("kind") == 4, USER).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def as_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text of conversations as they are (nulls of role and text: one space)."""
    col = lambda c: F.col(f"`{c}`")
    return conversations.select(col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"),
                                F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"))


def _order(*last: F.Column) -> list[F.Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), *last]


def lettered(rows: DataFrame) -> DataFrame:
    """conv, turn, pos, letter of every row; pos rises in the order of the rows."""
    plain = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
        F.expr("coalesce(nullif(instr('sua', substr(role, 1, 1)), 0), 4)").alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1).isin(".", "!", "?")).alias("short"))
    # substr(role, 1, 1) of an empty role is '', which instr finds at 1: no initial at all.
    plain = plain.withColumn("initial", F.when(F.col("role") == "", 4).otherwise(F.col("initial")))
    placed = cut(plain.orderBy(F.col("conv").asc_nulls_first(), *_order(F.monotonically_increasing_id()))
                 .withColumn("pos", F.monotonically_increasing_id()), "conversation-rows")
    again = placed.groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").drop("n").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    faults = F.when(F.col("blank"), F.lit(LETTERS["blank"])).when(F.col("pos") > F.col("first"), F.lit(LETTERS["duplicate"])) \
        .when(F.col("short"), F.lit(LETTERS["truncated"])).otherwise(F.lit(LETTERS["none"]))
    return placed.join(again, placed["conv"].eqNullSafe(again["c"]) & (placed["role"] == again["r"])
                       & (placed["digest"] == again["d"]), "left") \
        .select("conv", "turn", "pos", F.substring(faults, F.col("initial"), F.lit(1)).alias("letter"))


def chunks_of(letters: DataFrame) -> DataFrame:
    """conv, chunk, seq: letters of at most 2^CHUNK_BITS consecutive rows."""
    return letters.groupBy("conv", F.shiftright("pos", CHUNK_BITS).alias("chunk")) \
        .agg(F.array_sort(F.collect_list(F.struct("pos", "letter"))).alias("rows")) \
        .select("conv", "chunk", F.array_join(F.col("rows.letter"), "").alias("seq"))


# ------------------------------------------------------------------ grammar
def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, how often each pair of neighbouring symbols occurs (overlaps not twice).
    Symbols are at most the letters and ``RULES`` rules, so pairs have a bound."""
    counts: dict[str, int] = {}
    for batch in batches:
        for symbols, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before = ""
            for i in range(len(symbols) - 1):
                pair = symbols[i:i + 2]
                if pair == before and pair[0] == pair[1]:
                    before = ""
                    continue
                counts[pair] = counts.get(pair, 0) + n
                before = pair
    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pair", "n"])


def re_pair(sequences: DataFrame, rounds: int = ROUNDS) -> tuple[list[tuple[str, str, str]], F.Column]:
    """Rules over distinct letter rows (``dp``, ``n`` times each), and the expression that
    rewrites a letter row by them. A round takes the most frequent pairs that share no symbol."""
    rules: list[tuple[str, str, str]] = []
    rewritten = F.col("dp")
    for _ in range(rounds):
        top = sequences.select(rewritten.alias("dp"), "n").where("length(dp) > 1") \
            .mapInArrow(_count_pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")) \
            .where("n > 1").orderBy(F.col("n").desc(), "pair").limit(4 * RULES_A_ROUND).collect()
        taken: set[str] = set()
        added = 0
        for row in top:
            if added < RULES_A_ROUND and not taken & set(row.pair):
                taken |= set(row.pair)
                symbol = chr(FIRST_RULE + len(rules))
                rules.append((symbol, row.pair[0], row.pair[1]))
                rewritten = F.replace(rewritten, F.lit(row.pair), F.lit(symbol))
                added += 1
        if not added:
            break
    return rules, rewritten


_RESULT = "dp string, cost long, audit string, costs array<long>, audits array<string>"


def evaluate(sequences: DataFrame) -> DataFrame:
    """dp, cost and audit of the letter row as a whole conversation, and (where ``parts``)
    its packed matrix, for distinct letter rows (dp, n, parts)."""
    rules, rewritten = re_pair(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            dps, symbols, parts = (batch.column(i).to_pylist() for i in range(3))
            whole = [grammar.whole(s) for s in symbols]
            packed = [_packed(grammar.product(s)) if p else (None, None) for s, p in zip(symbols, parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(dps, pa.string()), pa.array([w[0] for w in whole], pa.int64()), pa.array([w[1] for w in whole], pa.string()),
                 pa.array([p[0] for p in packed], pa.list_(pa.int64())), pa.array([p[1] for p in packed], pa.list_(pa.string()))],
                ["dp", "cost", "audit", "costs", "audits"])
    return sequences.select("dp", rewritten.alias("symbols"), "parts").mapInArrow(run, _RESULT)


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, last = [], []
        for parts in batch.column(2).to_pylist():
            product = None
            for p in parts:
                m = _unpacked(p["costs"], p["audits"])
                product = m if product is None else times(product, m)
            packed.append(_packed(product))
            last.append(finish(product[0]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([p[0] for p in packed], pa.list_(pa.int64())),
             pa.array([p[1] for p in packed], pa.list_(pa.string())), pa.array([x[0] for x in last], pa.int64()),
             pa.array([x[1] for x in last], pa.string())], ["conv", "place", "costs", "audits", "cost", "audit"])


def _count(col: str, letters: str) -> F.Column:
    return F.length(col) - F.length(F.translate(col, letters, ""))


def repair_plan(rows: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation
    that has rows (conv, turn, role, text)."""
    prepare(rows.sparkSession)
    letters = lettered(rows)
    kind = letters.schema["conv"].dataType.simpleString()
    gaps = letters.groupBy("conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    plain = F.translate("seq", ALL_LETTERS, INITIALS)
    legal = sum(((F.length("ini") - F.length(F.replace("ini", F.lit(p), F.lit("")))) / 2 for p in ("su", "ua", "au")), F.lit(0))
    chunks = cut(chunks_of(letters).withColumn("ini", plain).select(
        "conv", "chunk", "seq", F.translate("seq", ALL_LETTERS, FOR_DP).alias("dp"),
        F.substring("ini", 1, 1).alias("head"), F.substring("ini", -1, 1).alias("tail"),
        (F.length("seq") - 1 - legal).cast("long").alias("illegal")), "conversation-chunks")
    convs = cut(chunks.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.min("dp").alias("dp"), F.sum("illegal").alias("illegal"),
        *[F.sum(_count("seq", LETTERS[f])).alias(f) for f in ("blank", "duplicate", "truncated")]), "conversations")
    several = convs.where("n > 1").select(F.col("conv").alias("c"))
    parts = chunks.join(several, chunks["conv"].eqNullSafe(several["c"]), "left_semi")
    by_place = Window.partitionBy("conv").orderBy("chunk")      # chunks of one conversation, short rows
    parts = cut(parts.withColumn("place", F.row_number().over(by_place) - 1)
                .withColumn("seam", F.concat(F.lag("tail").over(by_place), F.col("head"))), "conversation-parts")
    seams = parts.groupBy("conv").agg(F.count_if(~F.col("seam").isin("su", "ua", "au")).alias("illegal"))

    distinct = cut(convs.where("n = 1").groupBy("dp").agg(F.count(F.lit(1)).alias("n"), F.lit(False).alias("parts"))
                   .union(parts.groupBy("dp").agg(F.count(F.lit(1)), F.lit(True)))
                   .groupBy("dp").agg(F.sum("n").alias("n"), F.max("parts").alias("parts")), "conversation-letters")
    done = cut(evaluate(distinct), "conversation-matrices")
    single = convs.where("n = 1").join(done, "dp").select("conv", "cost", "audit")
    level = parts.join(done, "dp").select("conv", "place", "costs", "audits", "cost", "audit")
    longest = parts.agg(F.max("place")).first()[0] or 0
    while longest:
        groups = level.groupBy("conv", F.floor(F.col("place") / FAN_IN).cast("int").alias("g")).agg(
            F.array_sort(F.collect_list(F.struct("place", "costs", "audits"))).alias("parts"))
        level = cut(groups.mapInArrow(
            _multiply, f"conv {kind}, place int, costs array<long>, audits array<string>, cost long, audit string"),
            "conversation-products")
        longest //= FAN_IN
    union = [convs.select("conv", "illegal", "blank", "duplicate", "truncated"), seams, gaps,
             single.unionByName(level.select("conv", "cost", "audit"))]
    both = union[0]
    for other in union[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return both.groupBy("conv").agg(*map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.max("audit").alias("audit"))


# ------------------------------------------------------------------ applying the edits
def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, edit, role, text) of repaired rows and (conv, None, None, None) at the end of
    each conversation, from a stream with a conversation's audit before its rows."""
    audit, at, state, conv, begun = "", 0, "", None, False

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at += 1
            state = ASSISTANT if state == USER else USER
            yield conv, "I", state, ""

    for batch in batches:
        for c, plan, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if plan is not None:
                if begun:
                    yield from inserts()
                    yield conv, None, None, None
                audit, at, state, conv, begun = plan, 0, "", c, True
                continue
            yield from inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = USER if role[:1] == "u" else ASSISTANT if role[:1] == "a" else "system"
                yield conv, "K", role, text
            elif edit == "R":
                state = ASSISTANT if state == USER else USER
                yield conv, "R", state, text
    if begun:
        yield from inserts()
        yield conv, None, None, None


def _stream(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    ordered = rows.select("conv", F.lit(None).cast("string").alias("audit"), "role", "text", "turn",
                          F.unhex(F.sha2("text", 256)).alias("digest")) \
        .unionByName(plan.select("conv", F.coalesce("audit", F.lit("")).alias("audit")), allowMissingColumns=True)
    return ordered.repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("audit").isNull(), *_order()).select("conv", "audit", "role", "text")


def repaired_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv, place (from 1), edit, role, text of every repaired conversation."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        type_ = None
        def taped():
            nonlocal type_
            for b in batches:
                type_ = b.schema.field(0).type
                yield b
        out, place = [], 0
        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], type_), pa.array([r[4] for r in out], pa.int64()),
                 *[pa.array([r[i] for r in out], pa.string()) for i in (1, 2, 3)]], ["conv", "place", "edit", "role", "text"])
        for row in _edited(taped()):
            place = 0 if row[1] is None else place + 1
            if row[1] is not None:
                out.append((*row, place))
            if len(out) >= 1_000:
                yield batch()
                out = []
        if out:
            yield batch()
    prepare(rows.sparkSession)
    return _stream(rows, plan).mapInArrow(run, f"conv {kind}, place long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """conv, repaired_sha256: digest of the repaired `role:text` rows, newline-joined."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        type_ = None
        def taped():
            nonlocal type_
            for b in batches:
                type_ = b.schema.field(0).type
                yield b
        digest, first, out = hashlib.sha256(), True, []
        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], type_), pa.array([r[1] for r in out], pa.string())],
                                              ["conv", "repaired_sha256"])
        for conv, edit, role, text in _edited(taped()):
            if edit is None:
                out.append((conv, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(out) >= 1_000:
                    yield batch()
                    out = []
                continue
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        if out:
            yield batch()
    prepare(rows.sparkSession)
    return _stream(rows, plan).mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation of the original table: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    plan = cut(repair_plan(rows), "conversation-plan")
    digests = repaired_digests(rows, plan)
    base = conversations.select(F.col(f"`{conv_col}`").alias("conv")).distinct()
    both = base.unionByName(plan, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return both.groupBy(F.col("conv").alias("conv_id")).agg(
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


# ------------------------------------------------------------------ SQL
def _add(state: str, cost: int | str, edits: str) -> str:
    """A state of the SQL is its cost in nine digits, then its audit: text order is the
    order of (cost, audit)."""
    return f"lpad(CAST(CAST(substr({state}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{edits}'"


_VISIBLE = r"[^\x20\x09-\x0D]"
ORACLE = f"""
WITH RECURSIVE {CRC_CTES},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
),
kinds AS (SELECT *, {crc_of("k")} % 20 AS kind FROM keyed, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
),
ordered AS (
  SELECT *, substr(role, 1, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM damaged
),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_VISIBLE}') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'none' ELSE 'truncated' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) || ini AS step
  FROM ordered
),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pos > 1 AND step NOT IN ('su', 'ua', 'au')) AS illegal,
    list(ini ORDER BY pos) AS inis, list(fault ORDER BY pos) AS fs
  FROM faults GROUP BY conv_id
),
dp AS (
  SELECT conv_id, inis, fs, 1 AS i, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3
  FROM stats
  UNION ALL
  SELECT conv_id, inis, fs, i + 1,
    CASE WHEN i <= len(inis) THEN {_add("s0", DELETE, "D")} END,
    CASE WHEN i <= len(inis) THEN least({_add("s1", DELETE, "D")}, CASE WHEN may AND ini = 's' THEN {_add("s0", "extra", "K")} END) END,
    CASE WHEN i <= len(inis) THEN least({_add("t2", DELETE, "D")},
      CASE WHEN may THEN {_add("least(s0, s1, t3)", f"extra + {REROLE}", "R")} END,
      CASE WHEN may AND ini = 'u' THEN {_add("least(s0, s1, t3)", "extra", "K")} END) ELSE t2 END,
    CASE WHEN i <= len(inis) THEN least({_add("t3", DELETE, "D")}, CASE WHEN may THEN {_add("t2", f"extra + {REROLE}", "R")} END,
      CASE WHEN may AND ini = 'a' THEN {_add("t2", "extra", "K")} END) ELSE least(s0, t3) END
  FROM (
    SELECT *, inis[i] AS ini, fs[i] NOT IN ('blank', 'duplicate') AS may, CASE fs[i] WHEN 'truncated' THEN {CUT_SHORT} ELSE 0 END AS extra,
      least(s2, {_add("s0", INSERT, "I")}, {_add("s1", INSERT, "I")}, {_add("s3", INSERT, "I")}) AS t2,
      least(s3, {_add("s2", INSERT, "I")}, {_add("s0", 2 * INSERT, "II")}, {_add("s1", 2 * INSERT, "II")}) AS t3
    FROM dp WHERE i <= len(inis) + 1) q
),
plans AS (
  SELECT conv_id, CAST(substr(s3, 1, 9) AS BIGINT) AS cost, substr(s3, 10) AS audit FROM dp WHERE i = len(inis) + 2
),
edits AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS k, substr(audit, CAST(k AS INTEGER), 1) AS edit FROM plans),
aimed AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w AS place
  FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY k)
),
applied AS (
  SELECT a.conv_id, a.k, a.edit, a.place, f.role, f.text,
    max(CASE WHEN a.place = 1 AND a.edit = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY a.conv_id) AS lead
  FROM aimed a LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.pos = a.pos AND a.edit <> 'I'
),
repaired AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
    chr(10) ORDER BY k)) AS repaired_sha256
  FROM applied WHERE edit <> 'D' GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN plans p ON p.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_conversation_repair", ORACLE)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damage(conversations))
