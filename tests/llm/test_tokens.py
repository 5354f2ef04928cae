"""Token counts, tokenizer alignment and the manifest against plain Python."""

import glob
import hashlib
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from batchledger.llm import align, merkle, token_count
from batchledger.llm.common import stored, worker_cache

from helpers import awkward, documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
POOLS = ["abcdefgh", "the of and ing er", "'srtvlmd ", "\t\n  \r  ", "0123 ٣²", "!?.,'\"-<|>", "éüßñ日本語 한국", "\U0001f600́՘▁"]


def mixed_texts(n, seed=1, longest=60):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("".join(rng.sample(POOLS, rng.randint(1, 3)))) for _ in range(rng.randint(0, longest))) for _ in range(n)]
    texts += ["a<|endoftext|>b  <|endoftext|> c", "<|endoftext|>", "aaaa" * 100, " " * 300, "'" * 50, "ab" * 3000, "'r", "x'l y'll", "\t\n"]
    return texts + ["".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(40)) for _ in range(60)]


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(A)


@pytest.fixture(scope="module")
def counter():
    with open(A, encoding="utf-8") as file:
        return token_count.TokenCounter(file.read())


def test_counts_are_the_library_s(counter, byte_level):
    texts = mixed_texts(3000)
    assert counter.counts(texts) == [len(e.ids) for e in byte_level.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts([]) == []


def test_states_forgotten_on_the_way_change_nothing(counter, byte_level, monkeypatch):
    monkeypatch.setattr(token_count, "KEPT_STATES", 20)
    monkeypatch.setattr(token_count, "PIECES", 30)
    rng = random.Random(5)
    texts = ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (3000, 10, 500)] + mixed_texts(100, 6)
    assert counter.counts(texts) == [len(e.ids) for e in byte_level.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("width", [1, 2, 3, 7, 50, 1000])
def test_chunk_maps_compose_to_the_whole(counter, byte_level, width):
    for text in mixed_texts(150, width, 200):
        text = text.replace("<|endoftext|>", "")
        maps = [counter.chunk_map(text[i : i + width]) for i in range(0, len(text), width)]
        assert counter.fold(maps) == len(byte_level.encode(text, add_special_tokens=False).ids)


def test_lane_maps_compose():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 12, (12, 9), dtype=np.uint8)
    state, want = np.arange(12), []
    for lane in range(9):
        want.append(state)
        state = maps[state, lane]
    assert (token_count.scan(maps) == np.stack(want, 1)).all()


def test_token_counts_of_awkward_rows(spark, byte_level):
    rows = awkward() + [(900 + i, t, "a") for i, t in enumerate(mixed_texts(60))] + [(999, "x y<|endoftext|>" * 700, "b")]
    got = token_count.count_tokens(documents(spark, rows), A, chunk=500).collect()
    want = []
    for doc_id, text, _ in rows:
        n = len(byte_level.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert Counter(map(tuple, got)) == Counter(want)
    empty = documents(spark, rows).limit(0)
    assert token_count.count_tokens(empty, A).collect() == []


# Alignment


def test_row_products():
    rng = np.random.default_rng(2)
    left, right = (np.where(rng.random(s) < 0.2, 3, 0) for s in ((20, 30), (30, 25)))

    def csr(m):
        row, column = np.nonzero(m)
        return align.Csr(np.concatenate(([0], np.cumsum((m != 0).sum(1)))), column, m[row, column], m.shape[1])

    def dense(m):
        out = np.zeros((len(m.indptr) - 1, m.width), int)
        out[m.rows(), m.indices] = m.data
        return out

    assert (dense(csr(left).product(csr(right))) == left @ right).all()
    assert (dense(csr(left).transposed()) == left.T).all()
    assert (csr(left).times(np.arange(30)) == left @ np.arange(30)).all()


class Plain:
    """Tokens and links of one text, byte by byte."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [x for x in range(256) if x not in shown]
        self.byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return None
        ids = [self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)]
        spelt = [list(map(f, x)) for f, x in zip((self.a_bytes, self.b_bytes), ids)]
        if any(b"".join(s) != (" " + text).encode() for s in spelt):
            return None
        owners = [[k for k, s in enumerate(side) for _ in s] for side in spelt]
        links = Counter(zip(*owners))
        ends = [[sum(map(len, side[: k + 1])) for k in range(len(side))] for side in spelt]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            upto = [e.index(end) + 1 for e in ends]
            groups.append(tuple(range(x, y) for x, y in zip(at, upto)))
            at = upto
        return ids, links, groups


class Shipped:
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        value = a.read(), b.read()


def test_alignment_holds_little_beside_a_block(spark):
    """Slices and what a block gathers are small, and what other work left in the worker goes."""
    worker_cache("other work")["held"] = "words"
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    run = align._align(Shipped)
    list(run(iter([batch.slice(0, 100)])))
    assert not worker_cache("other work")
    tracemalloc.start()
    rows = sum(len(row.column(0)[0]) for row in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 60e6
    # Blocks are rows of some megabytes; the writer and the readers hold few of them.
    large = spark.range(8).coalesce(1).select(F.transform(F.sequence(F.lit(1), F.lit(1_000_000)), lambda i: F.xxhash64(i)).alias("pairs"))
    (file,) = glob.glob(stored(large, "blocks", **align.WRITER).inputFiles()[0].removeprefix("file:"))
    groups = pq.ParquetFile(file).metadata
    assert max(groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)) < 2 * align.ROW_GROUP


def test_a_block_is_the_same_however_its_texts_are_cut():
    aligner, texts = align.Aligner(*Shipped.value), mixed_texts(60, 5) + [None, ""]
    rows = []
    for size in (7, len(texts)):
        block = align._Block()
        for first in range(0, len(texts), size):
            block.add(aligner, list(range(len(texts)))[first : first + size], texts[first : first + size])
        rows.append(block.row().to_pydict())
    assert rows[0] == rows[1] and sum(rows[0]["holding"][0]) == len(rows[0]["indices"][0]) > 0


def test_alignment_against_plain(spark):
    plain = Plain()
    rows = [r for r in awkward(3, 30) if len(r[1] or "") < 5000]
    rows += [(800 + i, t[:300], "a") for i, t in enumerate(mixed_texts(150, 9))] + [(990, "<|endoftext|> <s>a</s>  ", "b"), (991, "   ", "b")]
    found = [(r[0], plain.align(r[1])) for r in rows]
    counts = Counter()
    for _, x in found:
        counts.update({(x[0][0][i], x[0][1][k]) for i, k in x[1]} if x else ())
    best = {}
    for (a, _), c in counts.items():
        best[a] = max(best.get(a, 0), c)
    want = []
    for doc_id, x in found:
        if x is None:
            want.append((doc_id, 0, 0, 0, 0, 0, 0, 0, ""))
            continue
        (a, b), links, groups = x
        pairs = [(a[i], b[k]) for i, k in links]
        text = ";".join("|".join(",".join(str(ids[i]) for i in side) for ids, side in zip((a, b), g)) for g in groups)
        shared = sum(len(g) * len(h) for g, h in groups)
        sums = sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs)
        want.append((doc_id, len(a), len(b), len(groups), len(links), *sums, shared, hashlib.sha256(text.encode()).hexdigest()))
    docs = documents(spark, rows)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_shared", "groups_sha256"]
    got = align.align_tokens(docs, A, B).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    # The links themselves.
    some = docs.filter("doc_id = 805")
    (a, b), links, groups = plain.align(rows[[r[0] for r in rows].index(805)][1])
    got = align.overlap_links(some, A, B).collect()
    assert Counter(map(tuple, got)) == Counter((805, i, k, a[i], b[k], n) for (i, k), n in links.items())
    got = align.group_links(some, A, B).collect()
    assert Counter(map(tuple, got)) == Counter((805, i, k, a[i], b[k], 1) for g, h in groups for i in g for k in h)
    assert align.align_tokens(docs.limit(0), A, B).collect() == []


def test_small_blocks_and_caches_change_nothing(spark, monkeypatch):
    docs = documents(spark, awkward(4, 40))
    whole = Counter(map(tuple, align.align_tokens(docs, A, B).collect()))
    for name, value in (("SLICE", 500), ("BLOCK", 1000), ("WORDS", 10), ("LONGEST", 4)):
        monkeypatch.setattr(align, name, value)
    assert Counter(map(tuple, align.align_tokens(docs, A, B).collect())) == whole


# Manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i - i % 3
        out.append((nodes[first:i], nodes[i + 1 : first + 3]))
        i //= 3
    return out


def plain_manifest(rows):
    order = lambda v: (v is not None, v)
    leaves = {}
    for doc_id, text, source, *lang in rows:
        fields = [doc_id, source, lang[0] if lang else "en", len(text or ""), text]
        changed = text.replace("\n", "") if text and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 else text
        both = digest(*map(field, fields)), digest(*map(field, [*fields[:4], changed]))
        leaves.setdefault(source, []).append((doc_id, *both))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    for own in leaves.values():
        own.sort(key=lambda r: (order(r[0])[0], r[0] or 0, r[1]))
    trees = [plain_levels([r[1] for r in leaves[s]]) for s in sources]
    top = plain_levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(sources):
        for i, (doc_id, leaf, changed) in enumerate(leaves[s]):
            path = plain_path(trees[k], i) + plain_path(top, k)
            folded = changed
            for left, right in path:
                folded = digest(*left, folded, *right)
            proof = digest(*(d for left, right in path for d in left + right))
            out.append((doc_id, leaf, trees[k][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_against_plain(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    rows = awkward(7) + [(2000 + i, f"line\n{i}", "a" if i % 3 else f"s{i}") for i in range(120)] + [(2**60 + 1, "big\nid", "a")]
    docs = documents(spark, rows)
    got = Counter(map(tuple, merkle.manifest(docs, merkle.tampered()).collect()))
    assert got == Counter(plain_manifest(rows))
    assert {v for *_, v in got} == {True, False}


def test_manifest_of_little(spark):
    for rows in ([], [(1, "a\nb", None)], [(4, None, "x"), (4, None, "x")]):
        docs = documents(spark, rows + [(0, "", "z")]).filter("source is distinct from 'z'")
        assert Counter(map(tuple, merkle.manifest(docs, merkle.tampered()).collect())) == Counter(plain_manifest(rows) if rows else [])


def test_word_encoder_keeps_a_bounded_number_of_words(monkeypatch):
    import public_tokenizers
    from batchledger.llm import packing
    from batchledger.llm.common import drop_worker_caches, worker_cache

    monkeypatch.setattr(packing, "CACHED", 50)
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        text = file.read()
    encoder = packing.WordEncoder(text)
    for i in range(400):
        line = f"the word{i} Other{i % 7}, \u00e9{i}"
        assert encoder.encode(line.encode()) == encoder._numbers(encoder.tokenizer.encode(line, add_special_tokens=False).ids) + encoder.end
        assert len(encoder) <= 50 and len(encoder.before) <= 50
    assert b"the" in encoder or b"the" in encoder.before
    worker_cache("word_encoder")["encoder"] = encoder
    drop_worker_caches()
    assert worker_cache("word_encoder") == {}
