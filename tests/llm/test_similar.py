"""SimHash groups and cover-tree links against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import awkward, collected, documents

import corpus_pipeline
from batchledger.llm import cover_tree, near_copies, simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(keys, linked):
    """Component of each index under ``linked(i, j)``."""
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


def test_fingerprint():
    rng = random.Random(3)
    texts = [None, "", " ", "One", "one two", "A b\tC", "a b c d", "Ünï CÖDE ÀB x y z", "ſ K İ one two", "\x1ca b\x85c d"]
    texts += [" ".join(rng.choice(["The", "a", "of", "x", "\n"]) for _ in range(rng.randint(1, 60))) for _ in range(40)] + ["w1 w2 " * 9000]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


@pytest.mark.parametrize("paired", [32, 3])
def test_groups_equal_all_pairs(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(paired)
    marks = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(120):
        m = rng.choice(marks)
        for b in rng.sample(range(64), rng.randint(0, 3)):
            m ^= 1 << b
        marks.append(m)
    centre = rng.getrandbits(64)  # many that share most bits
    marks += [centre ^ rng.getrandbits(7) << 40 for _ in range(150)] + [0, 1 << 63, 3]
    ids = random.Random(9).sample(range(10_000), len(marks))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    rows = spark.createDataFrame(list(zip(ids, signed)), "doc_id bigint, fp bigint")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash._labelled(rows).collect()}
    root = groups(marks, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(lambda: 1 << 60)
    for r, i in zip(root, ids):
        least[r] = min(least[r], i)
    assert got == {i: (f"{m:016x}", least[r]) for i, m, r in zip(ids, marks, root)}


def test_links_within_two_bits_share_a_chain():
    """Every difference of one or two bits passes the filter from some segment."""
    for a in range(64):
        for b in range(a, 64):
            x = (1 << a) | (1 << b)
            assert any(
                all((x & (simhash._mask(s, n) % (1 << 64))).bit_count() <= 2 * n // 5 for n in range(1, 5)) for s in range(5)
            )


def test_near_duplicates(spark):
    rows = awkward() + [(800, "", "a"), (801, None, "a")]
    docs = documents(spark, rows)
    got = simhash.near_duplicates(docs).collect()
    marks = [plain_fingerprint(t) for _, t, *_ in rows]
    root = groups(marks, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r, (i, *_) in zip(root, rows):
        if i is not None or r not in least:
            least[r] = i if least.get(r) is None else min(least[r], i)
    assert Counter(map(tuple, got)) == Counter((i, f"{m:016x}", least[r]) for (i, *_), m, r in zip(rows, marks, root))
    out = simhash.drop_near_copies(docs)
    assert out.columns == docs.columns
    kept = {i for (i, *_), r in zip(rows, root) if i == least[r]}
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(i for i, *_ in rows if i in kept)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("paired, common, levels", [(32, 4, 6), (3, 2, 6), (2, 2, 1)])
def test_near_copies_equal_all_pairs(spark, monkeypatch, paired, common, levels):
    monkeypatch.setattr(near_copies, "PAIRED", paired)
    monkeypatch.setattr(near_copies, "LEVELS", levels)
    monkeypatch.setattr(near_copies, "COMMON", common)
    rng = random.Random(paired)
    rows = awkward() + [(800, "", "a"), (801, None, "a"), (802, "One two", "a"), (803, "one  TWO", "b")]
    passage = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(40))
    bases = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(30, 150))) for _ in range(6)]
    for i in range(150):  # many near copies, the common passage before some
        words = rng.choice(bases[: 2 if i < 90 else 6]).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(["x", "y", "z"])
        rows.append((1000 + i, (passage + " " if i % 3 == 0 else "") + " ".join(words), "a"))

    def plain(text):
        words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
        return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    root = groups([plain(t) for _, t, *_ in rows], lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b) > 0)
    least = {}
    for r, (i, *_) in zip(root, rows):
        if i is not None or r not in least:
            least[r] = i if least.get(r) is None else min(least[r], i)
    docs = documents(spark, rows)
    assert Counter(collected(near_copies.near_duplicates(docs))) == Counter((i, least[r]) for (i, *_), r in zip(rows, root))
    kept = {i for (i, *_), r in zip(rows, root) if i == least[r]}
    # The stage of the pipeline: near copies whose fingerprints are far apart go too.
    out = dict(corpus_pipeline.STAGES)["near-dedup"](spark, docs, "")
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(i for i, *_ in rows if i in kept)
    assert near_copies.near_duplicates(documents(spark, [])).collect() == []


def test_copies_of_one_text_cost_as_many_pairs_as_texts(spark, monkeypatch):
    checked = []
    alike = near_copies._checked

    def counted(pairs, sets):
        checked.append(pairs.count())
        return alike(pairs, sets)

    monkeypatch.setattr(near_copies, "_checked", counted)
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    work = {}
    for n in (300, 600):
        rows = []
        for i in range(n):  # no copy is the base itself, so most are linked to few others
            words = list(base)
            words[rng.randrange(60)] = f"new{i}"
            rows.append((i, " ".join(words), "a"))
        checked.clear()
        near_copies.near_duplicates(documents(spark, rows)).collect()
        work[n] = sum(checked)
    assert work[600] <= 2.3 * work[300] and work[600] <= 60 * 600


def test_simhash_comes_first_and_wide_sketches_within_the_join(spark, monkeypatch):
    """A passage in all texts fills one place; what else they hold tells them apart before there are rows."""
    monkeypatch.setattr(near_copies, "PAIRED", 4)
    met, proposed = [], []
    outside, by_fingerprint = near_copies._outside, near_copies._by_fingerprint
    monkeypatch.setattr(near_copies, "_outside", lambda rows: (met.append((out := outside(rows)).count()), out)[1])
    monkeypatch.setattr(near_copies, "_by_fingerprint", lambda marked: (proposed.append((out := by_fingerprint(marked)).count()), out)[1])
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(400)]
    rows = [(i, " ".join(shared + [word() for _ in range(400)]), "a") for i in range(12)]
    rows += [(100 + i, rows[0][1] + f" end{i}", "a") for i in range(6)]
    got = dict(collected(near_copies.near_duplicates(documents(spark, rows))))
    assert got == {i: i if i < 100 and i else 0 for i, *_ in rows}
    assert proposed == [6]
    assert sum(met) <= 10  # 256 bits let all 66 pairs of different texts pass


@pytest.mark.parametrize("paired, levels", [(32, 3), (2, 1)])
def test_all_texts_of_a_simhash_group_are_compared(spark, monkeypatch, paired, levels):
    """Two near copies whose group has another text as its smallest mark, without any prefix that meets."""
    monkeypatch.setattr(near_copies, "PAIRED", paired)
    monkeypatch.setattr(near_copies, "LEVELS", levels)
    kinds = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    texts = kinds + [f"{t} more" for t in kinds]
    marks = [near_copies.mark(t) for t in texts]
    rows = [(m, len(near_copies.shingles(t)), 7) for m, t in zip(marks, texts)]
    digests = spark.createDataFrame(rows, "mark bigint, n bigint, fp bigint")
    none = spark.createDataFrame([], "key bigint, mark bigint, n bigint, pos bigint")
    found = collected(near_copies.links(none, digests, spark.createDataFrame([(t,) for t in texts], "text string")))
    assert {frozenset(pair) for pair in found} == {frozenset(pair) for pair in zip(marks, marks[3:])}


def test_texts_are_digested_once_and_only_compared_ones_are_shuffled(spark, monkeypatch):
    """No table but the digests and the sets is made from texts, and no mark by patterns in the JVM."""
    plans, store = [], near_copies.stored
    keep = lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), store(df, name))[1]
    monkeypatch.setattr(near_copies, "stored", keep)
    monkeypatch.setattr(simhash, "stored", keep)
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, f"{base} more", "a"), (3, base.replace(" ", " \n").upper(), "b")]
    rows += [(10 + i, " ".join(f"t{i}x{j}" for j in range(20)), "a") for i in range(5)]
    near = near_copies.near_duplicates(documents(spark, rows))
    assert dict(collected(near)) == {i: 1 if i < 4 else i for i, *_ in rows}
    assert not any("regexp_replace" in p for _, p in plans)
    assert {name for name, p in plans if "n_chars" in p or "text" in p} == {"digests", "sets"}


def test_pairs_are_checked_once_for_all_and_none_needs_no_tables(spark, monkeypatch):
    """Each table is a plan that the driver holds."""
    names, checked, store, check = [], [], near_copies.stored, near_copies._checked
    monkeypatch.setattr(near_copies, "stored", lambda df, name: (names.append(name), store(df, name))[1])
    monkeypatch.setattr(near_copies, "_checked", lambda pairs, sets: (checked.append(pairs.count()), check(pairs, sets))[1])
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (2, f"{base} more", "a")] + [(10 + i, " ".join(f"t{i}x{j}" for j in range(20)), "a") for i in range(5)]
    assert dict(collected(near_copies.near_duplicates(documents(spark, rows)))) == {i: 1 if i < 4 else i for i, *_ in rows}
    assert checked == [1] and names.count("near") == 1
    names.clear()
    near_copies.near_duplicates(documents(spark, rows[1:])).collect()
    assert checked == [1, 0] and not {"near", "alike"} & set(names)


def test_mark_is_the_hash_of_the_words():
    for text, line in ((None, ""), (" \t\n", ""), ("One  TWO\x0b\u00c9", "one two \u00c9"), ("a" * 99, "a" * 99)):
        assert near_copies.mark(text) % (1 << 64) == xxhash.xxh64_intdigest(line.encode(), 42)
    texts = pa.array(["a b", None, "A  b", "c"])
    bits = np.zeros(4, np.int64)
    at = near_copies.mark("a b") & 255
    bits[at >> 6] = np.array([1 << (at & 63)], np.uint64).view(np.int64)[0]
    (out,) = near_copies._wanted(bits)(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]))
    assert out.column("text").to_pylist() == ["a b", "A  b"] and out.column("mark").to_pylist() == [near_copies.mark("a b")] * 2


def test_wide_sketches_rule_out_no_linked_pair():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 255, 256, 257, 1000, 5000, 20_000):
        x = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        rows = {"a": [], "b": [], "size": [], "wide_a": [], "wide_b": []}
        linked, far = [], []
        for changed in (0, n // 18, n // 9, n // 8, n // 5, n):
            y = np.unique(np.concatenate((x[changed:], rng.integers(-(2**63), 2**63 - 1, changed))))
            y = y[: max(len(y) - n // 50, 0)]  # of different widths around powers of two
            linked.append(9 * near_copies._shared(x, y) >= 4 * (len(x) + len(y)))
            far.append(n >= 255 and changed >= n // 5)
            for c, v in zip(rows, (n, changed, len(x) + len(y), near_copies.wide_sketch(x), near_copies.wide_sketch(y))):
                rows[c].append(v)
        (out,) = near_copies._near(iter([pa.RecordBatch.from_pydict(rows)]))
        left = set(out.column("b").to_pylist())
        assert {c for c, near in zip(rows["b"], linked) if near} <= left
        assert not left & {c for c, f in zip(rows["b"], far) if f}


def brute(vectors, threshold):
    """vec_id -> (links, component) for rows (vec_id, vector, label)."""
    n = len(vectors)
    links = [set() for _ in range(n)]
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v) and l is not None for _, v, l in vectors]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and vectors[i][2] == vectors[j][2] and len(vectors[i][1]) == len(vectors[j][1]):
                a, b = (np.array(vectors[k][1], np.float32).astype(float) for k in (i, j))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    root = groups(range(n), lambda i, j: j in links[i])
    least = defaultdict(lambda: 1 << 60)
    for r, (i, *_) in zip(root, vectors):
        least[r] = min(least[r], i)
    return Counter((v[0], len(k), least[r], v[0] == least[r]) for v, k, r in zip(vectors, links, root))


@pytest.mark.parametrize("block", [2048, 12])
def test_cover_tree(spark, block):
    rng = np.random.default_rng(block)
    rows, k = [], 0
    for label in (1, 2):
        for _ in range(12):
            centre = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((k, (centre + rng.normal(size=8) * rng.choice([0.0, 0.1, 0.2])).tolist(), label))
                k += 1
    rows += [(k + i, rows[0][1], 1) for i in range(5)] + [(k + 6, [2 * x for x in rows[0][1]], 1), (k + 7, rows[0][1], None), (k + 8, rows[0][1], 3)]
    rows += [(k + 9, None, 1), (k + 10, [0.0] * 8, 1), (k + 11, [float("nan")] * 8, 1), (k + 12, [float("inf")] + [1.0] * 7, 1), (k + 13, [1.0, None], 1), (k + 14, [], 1), (k + 15, [1.0, 2.0], 1), (k + 16, [1.0, 2.1], 1)]
    rows.append(rows[1])
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, id string").repartition(3)
    got = cover_tree.linked_vectors(df, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(collected(got)) == brute(rows, 0.93)
    assert cover_tree.linked_vectors(df.limit(0)).collect() == []


def test_tree_invariants():
    rng = np.random.default_rng(1)
    points = cover_tree._unit(rng.normal(size=(200, 5)))
    tree = cover_tree.build_tree(points, 0.2)
    apart = cover_tree._apart(points, points)
    radius = 2.0
    for above, level in zip(tree, tree[1:-1]):
        radius /= 2
        assert set(above["centre"]) <= set(level["centre"])
        assert apart[:, level["centre"]].min(1).max() <= radius
        d = apart[np.ix_(level["centre"], level["centre"])] + 9 * np.eye(len(level["centre"]))
        assert d.min() > radius
    assert sorted(tree[-1]["centre"]) == list(range(200))
