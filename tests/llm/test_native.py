"""Source mixing, exact dedup and chat formatting against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import awkward, collected, documents

from batchledger.llm import chat, exact_dedup, mixing
from batchledger.llm.components import components


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes, weights):
    """Targets by sharing again and again until none is above its cap."""
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in over}


def check_mix(rows, got, block=mixing.BLOCK_WORDS):
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += size(text)
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    want = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}) if sum(sizes.values()) else {s: 0 for s in sizes}
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, *_ in rows)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[(r["source_size"], round(r["target"], 6))] += r["taken"]
    expected = defaultdict(int)
    for s in sizes:
        expected[(sizes[s], round(want[s], 6))] += int(want[s] + 0.5)
    assert by_target == expected


@pytest.mark.parametrize("block", [7, 1024])
def test_mix(spark, block):
    rows = awkward()
    docs = documents(spark, rows)
    got = mixing.mix_report(docs, block_words=block)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot"]
    check_mix(rows, got.collect())


def test_mix_many_sources_and_a_hot_one(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 30), "hot" if i % 3 == 0 else f"s{i % 40}") for i in range(900)] + [(1000, "one", "tiny"), (1001, "", "empty")]
    docs = documents(spark, rows)
    first = mixing.mix_report(docs, block_words=16).collect()
    check_mix(rows, first)
    assert sorted(first) == sorted(mixing.mix_report(docs, block_words=16).collect())


def test_every_slot_is_filled_once_and_spread(spark):
    rows = [(i, "w " * 50, "abc"[i % 3]) for i in range(300)]
    placed, pieces = mixing.mix_plan(documents(spark, rows), block_words=25)
    got = collected(pieces.join(placed, "_row").select("slot", "_source", "words"))
    slots = defaultdict(set)
    for slot, source, n in got:
        slots[slot].add(source)
        assert n <= 25
    assert all(len(s) == 1 for s in slots.values())
    # The heaviest source has five eighths of any stretch of the schedule, to within a few slots.
    for start in range(0, 512, 64):
        part = Counter(next(iter(slots[k])) for k in range(start, start + 64))
        assert abs(part["0a"] - 40) <= 6


def test_mixed_documents(spark):
    rows = [r for r in awkward() if r[0] is not None]
    docs = documents(spark, rows)
    out = mixing.mixed_documents(docs, block_words=32)
    assert out.columns == docs.columns
    report = mixing.mix_report(docs, block_words=32)
    taken = Counter()
    for r in report.collect():
        taken[r["doc_id"]] += r["taken"]
    got = Counter()
    texts = defaultdict(set)
    for i, t, *_ in rows:
        texts[i].add(t)
    for r in out.collect():
        got[r["doc_id"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
        assert r["text"] in texts[r["doc_id"]] or any(" ".join(t.split()).startswith(r["text"]) for t in texts[r["doc_id"]])
    assert got == +taken


def test_empty_tables(spark):
    docs = documents(spark, [])
    for df in (mixing.mix_report(docs), mixing.mixed_documents(docs), exact_dedup.duplicate_groups(docs), exact_dedup.drop_copies(docs)):
        assert df.collect() == []
    assert chat.format_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []


@pytest.mark.parametrize("heavy", [4096, 64])
def test_exact_dedup(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    rows = awkward() + [(500 + i, "the  same\ttext", "a") for i in range(200)]
    docs = documents(spark, rows)
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows]
    ids = defaultdict(list)
    for (i, *_), t in zip(rows, normal):
        ids[t].append(i)
    least = {t: min((i for i in own if i is not None), default=None) for t, own in ids.items()}
    want = Counter((i, least[t], len(ids[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, *_), t in zip(rows, normal))
    got = exact_dedup.duplicate_groups(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len(ids)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in out.collect()) == Counter((least[t], t) for t in ids)


def test_heavy_digests_are_found_and_verified(spark):
    rows = [(i, f"t{i % 500}" if i % 3 else "hot", "a") for i in range(3000)]
    winners = exact_dedup.heavy_winners(exact_dedup._digests(documents(spark, rows))).collect()
    hot = hashlib.sha256(b"hot").hexdigest()
    assert [(r["keep_id"], r["group_size"]) for r in winners if r["text_sha256"] == hot] == [(0, 1000)]


def rendered(turns):
    return "".join(f"<|{r}|>\n{t}\n" for r, t in turns)


def test_chat(spark):
    base = [("user", "hi"), ("assistant", "yo"), ("user", "more"), ("assistant", "end")]
    talks = {1: base[:1], 2: base[:2], 3: base, 4: base, 5: base[:2] + [("user", "else")], 6: [("user", "hi!")], 7: [("user", None)], 8: [("user", "hi")] * 2}
    rows = [(c, k, r, t) for c, own in talks.items() for k, (r, t) in enumerate(own)]
    rows += [(9, k, "user", f"line {k}") for k in range(600)] + [(10, k * 1000, "user", f"line {k}") for k in range(599)]
    rows += [(None, None, None, None), (None, 1, "user", "lost")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, position string, part string").repartition(4)
    got = {(r["conv_id"], r["part"]): (r["n_turns"], r["n_copies"], r["rendered"]) for r in chat.format_chats(df).collect()}
    assert set(got) == {(3, 0), (5, 0), (6, 0), (7, 0), (8, 0), (9, 0), (9, 1), (9, 2), (None, 0)}
    assert got[(3, 0)] == (4, 2, rendered(base))
    assert got[(7, 0)][2] == "<|user|>\n\n"
    assert "".join(got[(9, k)][2] for k in range(3)) == rendered([("user", f"line {k}") for k in range(600)])
    assert got[(None, 0)][2] == "<|user|>\nlost\n<||>\n\n"


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 80)] + [(rng.randint(3000, 3099), rng.randint(3000, 3099)) for _ in range(60)] + [(-5, -5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    groups = defaultdict(set)
    for v in parent:
        groups[find(v)].add(v)
    got = defaultdict(set)
    for v, root in collected(components(spark.createDataFrame(edges, "a bigint, b bigint"))):
        got[root].add(v)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("last", [0, 7, 1000])
def test_few_edges_are_ended_without_rounds(spark, monkeypatch, last):
    from batchledger.llm import components as module

    names, store = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: (names.append(name), store(df, name))[1])
    monkeypatch.setattr(module, "LAST", last)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + k) for k in range(1, 40)] + [(500, 501), (501, 500), (9, 9)]
    got = dict(collected(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert set(got) == {*range(61), *range(200, 240), 500, 501}
    assert [len({got[v] for v in own}) for own in (range(61), range(200, 240), (500, 501))] == [1, 1, 1] and len(set(got.values())) == 3
    assert names == ["edges", "labels"] if last == 1000 else names.count("points") > 1


def test_the_mix_itself(spark):
    rows = awkward(5)
    docs = documents(spark, rows)
    blocks = mixing.mixed_blocks(docs, block_words=64).collect()
    report = mixing.mix_report(docs, block_words=64).collect()
    taken = Counter()
    for r in blocks:
        taken[r["doc_id"]] += r["words"]
        assert len(r["text"].split(" ")) == r["words"] and r["words"] <= 64
    want = Counter()
    for r in report:
        want[r["doc_id"]] += r["taken"]
        assert (r["first_slot"] is None) == (r["taken"] == 0)
    assert +taken == +want
    # Blocks are full but for the last of a source, and pieces lie side by side in them.
    slots = defaultdict(list)
    for r in sorted(blocks, key=lambda r: (r["slot"], r["source"] or "", r["place"])):
        slots[r["slot"], r["source"]].append((r["place"], r["words"]))
    sizes = defaultdict(list)
    for (_, source), pieces in slots.items():
        assert [p for p, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        sizes[source].append(sum(n for _, n in pieces))
    assert all(sum(n < 64 for n in own) <= 1 for own in sizes.values())
    # Low discrepancy: any first slots hold the sources near their shares.
    total = sum(taken.values())
    for source, own in sizes.items():
        part = sum(sum(n for _, n in p) for (slot, s), p in slots.items() if s == source and slot < 64)
        first = sum(sum(n for _, n in p) for (slot, s), p in slots.items() if slot < 64)
        assert abs(part / first - sum(own) / total) < 0.15


def test_crowded_turns(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(None, rng.choice([None, 1, 2]), "user", f"t{rng.randrange(40)}") for _ in range(300)]
    rows += [(1, t, "user", f"x{t}") for t in range(600)] + [(2, t, "user", f"x{t}") for t in range(300)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    plain = Counter(map(tuple, chat.format_chats(turns).collect()))
    monkeypatch.setattr(chat, "CROWDED", 5)
    assert Counter(map(tuple, chat.format_chats(turns).collect())) == plain
    parts = chat._in_parts(chat._ordered(turns).selectExpr("_conv", "conv_id", "position _turn", "role", "text", "sha2(text, 256) _digest"))
    assert parts.groupBy("_conv", "_part").count().agg({"count": "max"}).first()[0] <= 10
