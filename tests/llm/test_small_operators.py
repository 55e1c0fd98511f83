"""Defined results of each operator on small inputs: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns; and brute-force versions."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm import (ann, bpe, exact_dedup, html_text, licences, minhash_dedup, mixing, passages, substring_exact,
                          toxicity)
from slotwise.llm.common import prepare
from slotwise.llm.groups import components

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "row string, h long, key string, id long, root long, component_id long, kept boolean, keep_id long, n long")


def documents(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    prepare(spark)
    full = [(i, t, "en", s, None, "r", 1, "k", 5, 6, 7, True, 8, 9) for i, t, *rest in rows for s in [rest[0] if rest else "s"]]
    return spark.createDataFrame(full, DOCS)


def text_of(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rng = np.random.RandomState(seed)
    return [f"w{x}" for x in rng.randint(0, vocabulary, n)]


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "x"), (5, "X"), (6, "É é"), (7, "é É"), (None, "lost"), (None, None),
       (8, "same text"), (8, "same text"), (9, "Same TEXT"), (10, "y" * 300_000)]


# ------------------------------------------------------------------ exact dedup
def test_exact_dedup_defined_results(spark):
    out = exact_dedup.mark_copies(documents(spark, ODD)).collect()
    assert len(out) == len(ODD)
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by_id[1].keep_id == 2 and by_id[1].group_size == 3 and not by_id[1].kept and by_id[2].kept
    assert by_id[4].keep_id == 5 and by_id[6].keep_id == 6                      # only A-Z fold
    assert by_id[8].keep_id == 9 and by_id[9].group_size == 3
    assert by_id[10].text_sha256 == hashlib.sha256(b"y" * 300_000).hexdigest()
    kept = exact_dedup.drop_copies(documents(spark, ODD))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 3, 5, 6, 7, None, 9, 10])
    assert exact_dedup.mark_copies(documents(spark, [])).count() == 0


def test_exact_dedup_repeated_winner_stays_once(spark):
    kept = exact_dedup.drop_copies(documents(spark, [(3, "a b"), (3, "A b"), (2, "a b")])).collect()
    assert [r.doc_id for r in kept] == [3]


def test_grace_recursion_matches_a_dictionary():
    rng = np.random.RandomState(1)
    records = [(bytes(rng.randint(97, 100, rng.randint(0, 7)).astype(np.uint8)), int(i), 1, 1) for i in rng.randint(0, 500, 4000)]
    records += [(b"hot", i, 1, 1) for i in range(2000)]
    want: dict[bytes, list] = {}
    for content, i, *_ in records:
        e = want.setdefault(content, [i, 0, 0])
        e[1] += 1
        e[0], e[2] = (i, 1) if i > e[0] or e[2] == 0 else (e[0], e[2] + (i == e[0]))
    for bound in (400, 3000, 1 << 20):                      # down to two entries a table: many levels
        got = {e[0]: e[1:] for e in exact_dedup.grace(iter(records), table_bytes=bound)}
        assert {k: (v[0], v[1]) for k, v in got.items()} == {k: (v[0], v[1]) for k, v in want.items()}


# ------------------------------------------------------------------ byte-level BPE
def test_bpe_equals_the_rank_merges_and_round_trips(spark):
    import public_tokenizers
    import tiktoken
    path, pattern = bpe.default_vocabulary()
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = np.random.RandomState(3)
    parts = ["a", " the", "  ", "\n", " \n ", "'ll", "é", "中文", "😀", "123", "\t", "!?", " ", " ", "zz", "=="]
    texts = ["".join(parts[i] for i in rng.randint(0, len(parts), 40)) for _ in range(300)]
    texts += [None, "", " ", "q" * 50_000, "<|endoftext|>"]
    docs = documents(spark, list(enumerate(texts)))
    want = {i: plain.encode_ordinary(t or "") for i, t in enumerate(texts)}
    for r in bpe.token_digests(docs).collect():
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(want[r.doc_id], dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    encoded = bpe.encode_documents(docs)
    for r in encoded.collect():
        assert r.ids == want[r.doc_id]
        text = texts[r.doc_id] or ""
        assert all(0 <= a <= b <= len(text) for a, b in zip(r.starts, r.ends))
    back = {r.doc_id: r.text for r in bpe.decode_documents(encoded).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(texts))
    assert bpe.token_digests(documents(spark, [])).count() == 0


def test_bpe_split_characters():
    b = bpe.load(*bpe.default_vocabulary())
    ids = next(iter(b.encode(["𐍈"]))).ids
    assert len(ids) > 1 and b.decode_text(ids) == "𐍈" and "�" in b.decode_text(ids[:1])


# ------------------------------------------------------------------ MinHash
def brute_components(rows, width):
    sets, part = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        part[i] = i
    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((part[a], part[b]))
            part = {k: low if v == high else v for k, v in part.items()}
    return sets, part


def near_copies(n: int) -> list[tuple[int, str]]:
    rows, rng = [], np.random.RandomState(9)
    for g in range(8):
        base = text_of(g, 60 + 20 * g)
        for _ in range(n):
            w = list(base)
            for k in rng.randint(0, len(w), rng.randint(0, 9)):
                w[k] = f"z{rng.randint(1 << 30)}"
            rows.append((len(rows) * 3 + 1, " ".join(w)))
    return rows + [(1000 + k, t) for k, t in enumerate([None, "", "one", "ONE", "two words", "two  Words", "a b c", "a b c d"])]


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_components_equal_brute_force(spark, width):
    rows = near_copies(12)
    sets, part = brute_components(rows, width)
    out = minhash_dedup.near_duplicates(documents(spark, rows), width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == {
        i: (len(sets[i]), part[i], part[i] == i) for i, _ in rows}


def test_minhash_blocks_give_the_same(spark, monkeypatch):
    rows = near_copies(12)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    monkeypatch.setattr(minhash_dedup, "PART_SHINGLES", 300)
    out = minhash_dedup.near_duplicates(documents(spark, rows), 2).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_components(rows, 2)[1]


def test_minhash_defined_results(spark):
    out = minhash_dedup.near_duplicates(documents(spark, ODD), 2).collect()
    assert len(out) == len(ODD)
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by_id[1].n_shingles == 0 and by_id[1].component_id == 1 and by_id[5].component_id == 4
    assert by_id[9].component_id == 8 and all(r.component_id is None and r.kept for r in out if r.doc_id is None)
    assert minhash_dedup.near_duplicates(documents(spark, []), 2).count() == 0
    assert minhash_dedup.drop_near_duplicates(documents(spark, ODD), 2).columns == documents(spark, []).columns


def test_components_of_paths_and_stars(spark):
    prepare(spark)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (60, 1)]
    out = components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    got = {r.node: r.root for r in out}
    assert len(out) == len(got) and all(got[k] == 0 for k in range(61)) and all(got[k] == 100 for k in range(100, 160))


# ------------------------------------------------------------------ mixing
def test_mixing_windows_lags_and_rows(spark):
    rows = [(i, "t", s) for i, s in enumerate(["a"] * 700 + ["b"] * 200 + ["c"] * 90 + [None] * 10)] + [(5, "t", "a")]
    weights = {"a": 3, "b": 5, "c": 2}                     # the null source has none: it comes last
    out = mixing.place(documents(spark, rows), weights, block=4).select("row.doc_id", "source_key", "block", "release", "deadline", "slot", "position").toPandas()
    out = out.sort_values("position")
    assert sorted(out["position"]) == list(range(len(rows))) and Counter(out["doc_id"]) == Counter(r[0] for r in rows)
    assert ((out["release"] <= out["slot"]) & (out["slot"] < out["deadline"])).all()
    slots = out.drop_duplicates("slot")
    first_end = min(slots[slots["source_key"] == s]["slot"].max() for s in ("sa", "sb", "sc"))
    for s, w in (("sa", 3), ("sb", 5), ("sc", 2)):
        share = (slots["source_key"] == s).cumsum().to_numpy()[:first_end]
        assert np.abs(share - np.arange(1, first_end + 1) * w / 10).max() < 1
    assert (out["source_key"].to_numpy()[-10:] == "n").all()
    assert mixing.place(documents(spark, [])).count() == 0
    mixed = mixing.mix(documents(spark, rows), weights, block=4)
    assert mixed.columns == documents(spark, []).columns and mixed.count() == len(rows)


def test_mixing_order_reaches_the_end_of_the_pipeline(spark):
    import corpus_pipeline
    from slotwise.llm.common import cut
    sources = ["a"] * 900 + ["b"] * 400 + ["c"] * 100
    docs = documents(spark, [(i, f"text {i}", s) for i, s in enumerate(sources)])
    for name, stage in corpus_pipeline.STAGES[3:]:
        docs = cut(stage(spark, docs, ""), "t-" + name.replace(" ", "-"))
    order = docs.orderBy("position").select("doc_id", "position").collect()
    assert [r.position for r in order] == list(range(len(sources))) and len({r.doc_id for r in order}) == len(sources)
    weights, at = {"a": 30, "b": 20, "c": 10}, Counter()    # square roots of the rows
    for n, r in enumerate(order[:320], 1):                  # all sources last at least so long
        at[sources[r.doc_id]] += 1
        assert all(abs(at[s] - n * w / 60) < 2 * mixing.BLOCK for s, w in weights.items())


def test_mixing_schedule_equals_step_by_step():
    """The periodic schedule against a block-by-block earliest-deadline-first run."""
    rows, weights = {"a": 37, "b": 61, "c": 11}, {"a": 2, "b": 3, "c": 2}
    got = {}
    for p in mixing.schedule(rows, weights, 1):
        for s in p.weights:
            for b in range(p.first[s], p.end[s]):
                n = b - p.first[s]
                got[p.start + n // p.weights[s] * sum(p.weights.values()) + p.places[s][n % p.weights[s]]] = (s, b)
    left, given, slot = dict(rows), dict.fromkeys(rows, 0), 0
    while left:
        total, base = sum(weights[s] for s in left), dict(given)
        start = slot
        while True:
            ready = [(-(-(given[s] - base[s] + 1) * total // weights[s]), s) for s in left
                     if (given[s] - base[s]) * total // weights[s] <= slot - start]
            s = min(ready)[1]
            assert got[slot] == (s, given[s])
            given[s] += 1
            left[s] -= 1
            slot += 1
            if not left[s]:
                del left[s]
                break
    assert len(got) == slot == sum(rows.values())


# ------------------------------------------------------------------ nearest neighbours
def test_neighbours_recall_ties_and_bad_vectors(spark):
    prepare(spark)
    rng = np.random.RandomState(4)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.normal(size=(900, 12)) * rng.uniform(0.5, 2, (900, 1)))]
    rows += [(2000 + i, rows[7][1], 0) for i in range(60)]                            # one vector many times
    rows += [(3000, None, 0), (3020, [0.0] * 12, 0), (3040, [float("nan")] + [1.0] * 11, 0), (3060, [1.0] * 5, 0),
             (3080, [None] + [1.0] * 11, 0), (3100, [float("inf")] * 12, 0), (None, rows[3][1], 0), (40, rows[40][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id long")
    out = ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0).toPandas()
    good = [(i, np.array(v)) for i, v, _ in rows if v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)]
    ids, x = np.array([-1 if i is None else i for i, _ in good]), np.array([v for _, v in good])
    hits = total = 0
    for q in sorted({i for i, _ in good if i is not None and i % 20 == 0}):
        v = x[ids == q][0]
        s, m = (x * v).sum(1), ids != q
        best = np.lexsort((ids[m], -s[m]))[:20]
        got = out[out["query_id"] == q].sort_values("rank")
        assert list(got["rank"]) == list(range(1, 21))
        hits += len(set(ids[m][best]) & {-1 if np.isnan(float(k)) else int(k) for k in got["vec_id"].fillna(-1)})
        total += 20
        assert np.allclose(got["score"], [s[m][np.flatnonzero(ids[m] == k)[0]] for k in got["vec_id"].fillna(-1)])
        assert (np.diff(got["score"]) <= 1e-12).all()
    assert hits / total >= 0.9
    assert set(out["query_id"]) == {i for i, _ in good if i is not None and i % 20 == 0}
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_over_many_groups(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(ann, "GROUP_ROWS", 64)
    rng = np.random.RandomState(6)
    x = rng.normal(size=(1500, 16)) + rng.normal(size=(15, 16))[rng.randint(0, 15, 1500)] * 2
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.nearest_neighbours(df, F.col("vec_id") % 50 == 0, k=10).toPandas()
    hits = 0
    for q, got in out.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:10]) & set(got["vec_id"]))
    assert hits / len(out) >= 0.9 and len(out) == 300


def test_chi_square_closed_form():
    sample = (np.random.RandomState(1).normal(size=(200_000, 8)) ** 2).sum(1)
    for x in (2.0, 7.0, 18.0):
        assert abs(ann.chi_square(x) - (sample <= x).mean()) < 0.005
    assert abs(ann.chi_square(ann.quantile(0.98)) - 0.98) < 1e-6


# ------------------------------------------------------------------ repeated substrings
def brute_removed(texts: dict[int, bytes], size: int) -> dict[int, np.ndarray]:
    seen = Counter(t[k:k + size] for t in texts.values() for k in range(len(t) - size + 1))
    out = {}
    for i, t in texts.items():
        gone = np.zeros(len(t), dtype=bool)
        for k in range(len(t) - size + 1):
            if seen[t[k:k + size]] > 1:
                gone[k:k + size] = True
        out[i] = gone
    return out


def repeated_texts() -> list[tuple[int, str]]:
    rng = np.random.RandomState(2)
    word = lambda n: " ".join(text_of(rng.randint(1 << 30), n))
    shared, border = word(120), "x" * 401
    rows = [(k, word(60) + " " + shared[:rng.randint(380, 650)] + word(rng.randint(1, 90))) for k in range(70)]
    rows += [(200, shared[100:] + word(40)), (201, "ab" * 700), (202, word(300)), (203, border), (204, border), (205, "short"),
             (206, "short"), (207, None), (208, ""), (209, "é" * 400), (210, "aé" * 300), (211, word(3) + "é" * 260 + word(3))]
    return rows + [(300 + k, rows[k][1]) for k in range(5)]


@pytest.mark.parametrize("group", [8000, 4])
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(substring_exact, "GROUP", group)                    # 4: the path of very common pieces
    rows = repeated_texts()
    texts = {i: (t or "").encode() for i, t in rows}
    want = brute_removed(texts, substring_exact.THRESHOLD)
    out = substring_exact.remove_repeats(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        raw, gone = texts[r.doc_id], want[r.doc_id]
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()), r.doc_id


def test_repeated_rows_of_one_id_lose_everything(spark):
    long = " ".join(text_of(1, 200))
    out = substring_exact.remove_repeats(documents(spark, [(1, long), (1, long), (None, "x")])).collect()
    assert sorted((r.n_removed, r.n_spans) for r in out if r.doc_id == 1) == [(len(long), 1)] * 2
    assert substring_exact.remove_repeats(documents(spark, [])).count() == 0


def test_large_groups_order_by_digits_like_pairs():
    rng = np.random.RandomState(8)
    left, size = substring_exact.THRESHOLD - substring_exact.GRAM, substring_exact.THRESHOLD
    base = rng.randint(0, 255, left + size).astype(np.uint8)
    grids = []
    for _ in range(60):
        g = base.copy()
        g[:rng.randint(0, left)] = rng.randint(0, 255)
        g[left + substring_exact.GRAM + rng.randint(0, size - substring_exact.GRAM):] = rng.randint(0, 255)
        grids.append(g.tobytes())
    before, after = np.full(60, left), np.zeros(60, dtype=int)
    cover = lambda found: [sorted({o for a, z in f for o in range(a, z + 1)}) for f in found]
    big = cover(substring_exact.repeated_starts(grids, before, after))
    pairs = [set() for _ in grids]
    for i, j in combinations(range(60), 2):
        a, b = cover(substring_exact.repeated_starts([grids[i], grids[j]], before[:2], after[:2]))
        pairs[i] |= set(a)
        pairs[j] |= set(b)
    assert big == [sorted(p) for p in pairs]


# ------------------------------------------------------------------ passages
def test_compact_windows_cover_each_subsequence_once():
    rng = np.random.RandomState(0)
    for n, kinds in ((46, 1 << 38), (60, 9), (140, 1 << 38)):
        v = rng.randint(0, kinds, n).astype(np.uint64)
        seen = {}
        for left, at, right in zip(*passages.compact_windows(v[None, :] << np.uint64(24))[0]):
            for s in range(left, at + 1):
                for e in range(max(at, s + passages.WIDTH - 1), right + 1):
                    assert (s, e) not in seen
                    seen[s, e] = at
        assert seen == {(s, e): s + int(np.argmin(v[s:e + 1])) for s in range(n) for e in range(s + passages.WIDTH - 1, n)}


def test_passages_found_and_clean_documents_left_alone(spark):
    shared, other = text_of(50, 70), text_of(51, 60)
    near = [w if k % 40 else f"changed{k}" for k, w in enumerate(shared)]
    rows = [(k, " ".join(text_of(100 + k, 80) + shared + text_of(200 + k, 50))) for k in range(6)]
    rows += [(10, " ".join(text_of(300, 30) + near + text_of(301, 90))), (11, " ".join(other)), (12, " ".join(other)),
             (13, " ".join(other).upper() + " "), (20, " ".join(text_of(400, 500))), (21, " ".join(shared[:45])), (22, None), (23, ""),
             (24, " ".join(text_of(500, 200) + other)), (None, " ".join(shared))]
    out = {r.doc_id: r for r in passages.passage_classes(documents(spark, rows)).collect()}
    assert len(out) == len(rows)
    assert all(out[k].class_id == 0 and out[k].n_links > 0 for k in (0, 1, 2, 3, 4, 5, 10))
    assert all(out[k].class_id == 11 and out[k].n_links > 0 for k in (11, 12, 13, 24))
    assert all(out[k].class_id == k and out[k].n_links == 0 for k in (20, 21, 22, 23)) and out[None].class_id is None
    spans = out[3].passages
    assert len(spans) == 1 and 80 <= spans[0].start <= 81 and 149 <= spans[0].end <= 151
    assert passages.passage_classes(documents(spark, [])).count() == 0


def test_very_common_passages_go_through_salted_runs(spark, monkeypatch):
    shared = text_of(70, 60)
    rows = [(k, " ".join(text_of(1000 + k, 60) + shared)) for k in range(120)] + [(500, " ".join(text_of(7000, 90)))]
    out = {r.doc_id: r for r in passages.passage_classes(documents(spark, rows)).collect()}
    assert all(out[k].class_id == 0 and out[k].n_links > 0 for k in range(120)) and out[500].n_links == 0


def test_passages_of_followers_whose_leader_has_too_few_words(spark):
    rows = []
    for k in range(12):
        shared = text_of(3000 + k, 60, 100_000)
        rows.append((10 * k, " ".join(text_of(4000 + k, 80, 100_000) + shared[:45] + text_of(5000 + k, 40, 100_000))))
        rows += [(10 * k + m, " ".join(text_of(6000 + 9 * k + m, 50, 100_000) + shared + text_of(8000 + 9 * k + m, 70, 100_000)))
                 for m in (1, 2)]
    out = {r.doc_id: r for r in passages.passage_classes(documents(spark, rows)).collect()}
    assert [k for k in range(12) if out[10 * k + 2].class_id != 10 * k + 1 or out[10 * k].n_links] == []


def test_open_runs_of_several_passages_equal_all_pairs(spark, monkeypatch):
    """A line of 30 words in all documents; passages around it in some; blocks and salted runs."""
    monkeypatch.setattr(passages, "BLOCK", 7)
    line, rows, want = text_of(90, 30, 100_000), [], {}
    for k in range(90):
        group = k // 3 if k >= 30 else None                  # three documents share a passage
        before = text_of(9000 + group, 25, 100_000) if group is not None else text_of(9500 + k, 25, 100_000)
        rows.append((k, " ".join(text_of(20_000 + k, 60, 100_000) + before + line + text_of(30_000 + k, 60, 100_000))))
        want[k] = 3 * group if group is not None else k
    out = passages.passage_classes(documents(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in out} == want


# ------------------------------------------------------------------ html
PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='ad-slot'>Buy</div>%s"
        "<div id='comments'><p>Me too</p></div><aside>side</aside><form><p>mail</p></form>"
        "<footer>&copy; all</footer></body></html>")


def pages(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string")


def test_html_main_text(spark):
    body = "<h1>Head &amp; more</h1><p><b>One<br>two&nbsp;<i>th</i>ree\n  four<p>Five &#233; &lt;x&gt; &copy<ul><li>a<li>b</ul>"
    want = "Head & more One two three four Five é <x> © a b"
    rows = [(k, f"http://h.example.com/{k}", PAGE % f"<article>{body}{'<p>filler text ' * 9}</article>", None, "x") for k in range(5)]
    rows += [(10 + k, "http://k.example.com/", PAGE % f"<div class='post n{k}'>{body}{'<p>filler text ' * 9}</div>", None, None) for k in range(5)]
    rows += [(20, None, None, None, None), (21, "x", "", None, None), (22, "http://h.example.com/", "plain &amp; text", None, None),
             (23, "http://h.example.com/", "<p>cut <b", None, None), (24, "http://q.example.com/", "<!-- a <p>b --> c <nav>d</nav>", None, None),
             (25, "http://h.example.com/", "<div>" * 3000 + "deep" + "</div>" * 3000, None, None)]
    rows += [rows[0]]
    out = html_text.main_text(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.text for r in out}
    filler = " " + " ".join(["filler text"] * 9)
    assert all(got[k] == want + filler for k in (0, 1, 4, 10, 14))
    assert got[20] == "" and got[21] == "" and got[22] == "plain & text" and got[23] == "cut" and got[24] == "c" and got[25] == "deep"
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_text.main_text(pages(spark, [])).count() == 0


def test_html_consensus_beats_an_odd_page(spark):
    """A page whose comments-like box is longer than its article still gives the article."""
    usual = "<div class='wrap'><div class='story'><p>%s</p></div><div class='box'><p>%s</p></div></div>"
    rows = [(k, "https://a.example.net/x", "<body>" + usual % ("long story text " * 30, "tip") + "</body>", None, None) for k in range(9)]
    rows.append((9, "https://a.example.net/y", "<body>" + usual % ("short story", "box " * 50) + "</body>", None, None))
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got[9] == "short story"


def test_html_box_that_fills_few_pages_does_not_cut_the_others(spark):
    page = "<body><div class='content'>%s<div class='section'><p>%s</p></div></div><div class='box'><p>tip</p></div></body>"
    rows = [(k, "https://s.example.org/x", page % ("<p>long article</p>" * 40, "section " * 16), None, None) for k in range(18)]
    rows += [(k, "https://s.example.org/x", page % ("", "section " * 90), None, None) for k in (18, 19)]
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got[0] == " ".join(["long article"] * 40 + ["section"] * 16) and got[18] == " ".join(["section"] * 90)


def test_html_winner_is_widened_by_blocks_that_are_not_outside(spark):
    page = "<body><div class='wrap'>%s<div class='story'><p>%s</p></div><div class='box'><p>tip</p></div></div></body>"
    rows = [(k, "https://w.example.org/x", page % ("", "long story " * 30), None, None) for k in range(19)]
    rows.append((19, "https://w.example.org/y", page % ("<p>before the story</p>" * 20, "long story " * 5), None, None))
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got[0] == " ".join(["long story"] * 30)
    assert got[19] == " ".join(["before the story"] * 20 + ["long story"] * 5)


# ------------------------------------------------------------------ toxicity
def toxic_corpus(n: int = 400):
    rng = np.random.RandomState(11)
    insults = ["zorgface", "blimhead", "krulla"]
    rows, labels = [], []
    for i in range(n):
        words = text_of(9000 + i, 40, 300)
        toxic = int(rng.rand() < 0.25)
        if toxic:
            for _ in range(2):
                s = insults[rng.randint(3)]
                s = s + "xy" if s == "krulla" and rng.rand() < 0.5 else s
                words.insert(rng.randint(len(words)), s)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity_held_out_and_disguised_insults(spark):
    rows, labels = toxic_corpus()
    truth = {i: y for i, _, y in labels}
    extra = [(1000, "so you are a zorg-face indeed"), (1001, "b.l.i.m.h.e.a.d"), (1002, "hello z o r g f a c e there"),
             (1003, None), (1004, ""), (1005, "w1 w2 w3"), (None, "w5 w6"), (1006, "w7 " * 100_000)]
    lab = spark.createDataFrame([*labels, (0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows + extra)
    model = toxicity.train_model(docs, lab)
    out = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert len(out) == len(rows) + len(extra)
    held = [r for r in out.values() if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert out[1000].predicted == 1 and out[1001].predicted == 1 and out[1002].predicted == 1
    assert all(out[k].predicted == 0 and 0 <= out[k].score <= 1 for k in (1003, 1004, 1005, 1006, None))
    kept = toxicity.drop_toxic(docs, lab)
    assert kept.columns == docs.columns and 1000 not in {r.doc_id for r in kept.collect()}


def test_toxicity_without_labels_or_one_class(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train_model(docs, none) == 0.0
    one = spark.createDataFrame([(k, 1, 0) for k in (1, 3, 5)], "doc_id long, quality int, toxic int")
    model = toxicity.train_model(docs, one)
    assert isinstance(model, float) and toxicity.score_documents(docs, model).count() == 2
    assert toxicity.score_documents(documents(spark, []), 0.0).count() == 0


def test_subsequence_kernel_equals_its_definition():
    def brute(a: str, b: str) -> float:
        def features(s):
            f = Counter()
            for t in combinations(range(len(s)), 3):
                if t[2] - t[0] < toxicity.SPAN:
                    f["".join(s[k] for k in t)] += toxicity.DECAY ** (t[2] - t[0] + 1)
            return f
        fa, fb = features(a), features(b)
        dot = sum(x * fb[k] for k, x in fa.items())
        return dot / np.sqrt(sum(x * x for x in fa.values()) * sum(x * x for x in fb.values()))

    marks = ["idiot", "clown", "ananan", "trash"]
    strings = ["idiot", "id.iot", "iidiot", "clowns", "anananan", "banana", "xyz", "trsah", "t r a s h"]
    got = toxicity.Landmarks(marks).values(strings)
    for i, s in enumerate(strings):
        for j, m in enumerate(marks):
            k = brute(s, m)
            assert got[i, j] == pytest.approx(k ** toxicity.POWER if k >= toxicity.FLOOR else 0.0, abs=1e-5)


# ------------------------------------------------------------------ licences
def test_licences_found_confirmed_and_unknown(spark):
    filler = [(100 + k, "\n".join(" ".join(text_of(k * 7 + j, 30, 200)) for j in range(4))) for k in range(60)]
    rows = [(1, "intro text\nReleased under the MIT License."), (2, "Licensed under the Apache License, Version 2.0.\nmore"),
            (3, "This work is licensed under the GNU General Public License, version 3."),
            (4, "Licensed under CC BY-NC 4.0."), (5, "x\r\nAll rights reserved."),
            (6, "She lost her driving license near the public library."), (7, None), (8, ""),
            (9, " ".join(text_of(1, 500, 200)) + " Released under the MIT License. " + " ".join(text_of(2, 500, 200))),
            (10, "Released under the MIT License.\nAll rights reserved."), (10, "Released under the MIT License."),
            (None, "Released under the ISC License."), (11, "license version public general")]
    out = {r.doc_id: r for r in licences.scan_licences(documents(spark, rows + filler)).collect()}
    assert {k: out[k].families for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11)} == {
        1: ["MIT"], 2: ["Apache-2.0"], 3: ["GPL"], 4: ["CC-BY-NC"], 5: ["Proprietary"], 6: [], 7: [], 8: [], 9: ["MIT"], 11: []}
    assert out[10].families == ["MIT", "Proprietary"] and out[None].families == ["ISC"]
    assert not any(out[k].families for k, _ in filler) and out[1].probability > 0.5 and out[6].probability == 0


def test_licences_of_wrapped_notices_and_of_two_families(spark):
    filler = [(100 + k, "\n\n".join(" ".join(text_of(k * 7 + j, 30, 200)) for j in range(4))) for k in range(60)]
    bsd = ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions", "are met:"]
    isc = ["Permission to use, copy, modify, and/or distribute this software for any", "purpose with or without fee is hereby granted."]
    rows = [(1, "Copyright 2020 A. Author. All rights reserved.\n\n" + "\n".join(bsd)),
            (2, "/*\r\n * intro\r\n *\r\n * " + "\r\n * ".join(isc) + "\r\n */"),
            (3, "# Licensed under the MIT License or the Apache License,\n# Version 2.0"),
            (4, "Licensed under the MIT License or the Apache License, Version 2.0"),
            (5, "REM " + "\nREM ".join(bsd)),
            (6, "Licensed under the GNU Lesser General Public License, version 2."), (7, "Licensed under CC BY-SA 4.0."),
            (8, "SPDX-License-Identifier: MIT"), (9, "Licensed under the GNU Affero General Public License,\nversion 3.")]
    out = {r.doc_id: r.families for r in licences.scan_licences(documents(spark, rows + filler)).collect()}
    both = ["Apache-2.0", "MIT"]
    assert {k: out[k] for k, _ in rows} == {1: ["BSD", "Proprietary"], 2: ["ISC"], 3: both, 4: both, 5: ["BSD"], 6: ["LGPL"],
                                            7: ["CC-BY-SA"], 8: ["MIT"], 9: ["AGPL"]}
    assert not any(out[k] for k, _ in filler)


def test_licences_empty_table_and_native_plan(spark):
    assert licences.scan_licences(documents(spark, [])).count() == 0


# ------------------------------------------------------------------ schema of the results
def test_result_types(spark):
    docs = documents(spark, [(1, "a b c")])
    assert exact_dedup.mark_copies(docs).schema["group_size"].dataType == T.LongType()
    assert minhash_dedup.near_duplicates(docs, 2).schema["kept"].dataType == T.BooleanType()


def test_landmarks_of_a_large_alphabet_stay_small():
    rng = np.random.RandomState(3)
    marks = ["".join(chr(0x4E00 + x) for x in rng.randint(0, 1000, 7)) for _ in range(300)]
    held = toxicity.Landmarks(marks)
    assert held.pair.nbytes + held.last.nbytes < 64 << 20
    assert np.allclose(np.diag(held.values(marks)), 1.0, atol=1e-5)


def test_many_rows_that_repeat_a_row_are_settled_at_once(spark):
    rng = np.random.RandomState(9)
    long = "".join(map(chr, rng.randint(97, 123, 700)))
    rows = spark.range(10_000).select(F.when(F.col("id") < 5_000, 7).cast("long").alias("doc_id"), F.lit(long).alias("text")) \
        .unionByName(spark.createDataFrame([(1, long[100:600] + "!" * 50), (2, "short"), (2, "short"), (None, None), (None, None)], "doc_id long, text string"))
    prepare(spark)
    out = substring_exact.remove_repeats(rows).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert {tuple(r) for r in out} == {(7, 700, 700, 1, 5_000), (None, 700, 700, 1, 5_000), (1, 550, 500, 1, 1), (2, 5, 0, 0, 2), (None, 0, 0, 0, 2)}


def test_near_dedup_drops_rows_and_not_ids(spark):
    base, other = text_of(21, 80), text_of(22, 80)
    near = [*base[:40], "changed", *base[41:]]
    rows = [(3, " ".join(base)), (7, " ".join(near)), (7, " ".join(other)), (7, None), (9, " ".join(text_of(23, 60))), (9, " ".join(text_of(23, 60))),
            (None, " ".join(base)), (4, ""), (4, "")]
    kept = minhash_dedup.drop_near_duplicates(documents(spark, rows))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    assert texts[7, " ".join(other)] == 1 and texts[7, None] == 1                # only the near copy may go
    assert texts[3, " ".join(base)] + texts[7, " ".join(near)] == 1              # one of the group stays
    assert texts[9, rows[4][1]] == 1 and texts[None, rows[0][1]] == 1 and texts[4, ""] == 2
    assert sum(texts.values()) == 7
