"""Alignment of two tokenizers by products of sparse incidence matrices.

Both tokenizers cut the same bytes, a space and the text. ``Csr`` is a sparse matrix in compressed
rows. The incidence of tokens and bytes has a one where a token covers a byte; the row products
(Gustavson) A . B' of the two incidences give every pair of tokens that overlap, with the bytes they
share. Byte offsets where both end cut the tokens into groups; products of the incidences of tokens
and groups give the pairs that share a group. All texts of a slice are one block-diagonal matrix.

Corpus counts: documents are dealt to blocks of about ``BLOCK`` bytes of text. A block keeps the
rows of the matrix document x id pair, with links as entries, over a dictionary of its own, and
writes one dictionary row per pair with the number of its documents. These meet by id pair for the
corpus-wide counts, the best count of each A id (at most one row an id of the vocabulary) is sent to
all tasks, and the counts go back to the blocks, where a matrix-vector product gives the sums of each
document. Neither a common pair nor a source gathers more than one row a block.

Tokens come from the two libraries, word by word where a word is what the tokenizer cannot cross;
words are remembered. What a Python worker holds does not grow with the input: words, one
slice, one block, and nothing that other work left; what is written comes in row groups of ``ROW_GROUP`` bytes.

Defined results: a text that is null or empty, or that the tokens do not spell byte for byte, has no
tokens: zeros and an empty ``groups_sha256``; texts count whole; ids may be null; repeated rows are
documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import drop_worker_caches, stored, text_or_empty, worker_cache
from .token_count import Splitter, slices

#: Bytes of text in one matrix, and in one block of documents.
SLICE, BLOCK = 1 << 18, 1 << 22
#: Words that a Python worker remembers for each tokenizer, and their longest.
WORDS, LONGEST = 400_000, 64
#: Bytes of written blocks that are buffered at once, by the writer and by readers. Rows are large: each is measured.
ROW_GROUP = 1 << 24
WRITER = {"parquet.block.size": ROW_GROUP, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
_SEPARATOR = "\ud800"  # in no text, and a piece of its own


@dataclass
class Csr:
    """Sparse matrix: the columns of row i are indices[indptr[i] : indptr[i + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @classmethod
    def spans(cls, lengths: np.ndarray) -> Csr:
        """Row i covers the next ``lengths[i]`` columns."""
        indptr = np.concatenate(([0], np.cumsum(lengths)))
        return cls(indptr, np.arange(indptr[-1]), np.ones(indptr[-1], np.int64), int(indptr[-1]))

    @classmethod
    def members(cls, column: np.ndarray, width: int) -> Csr:
        """Row i has a one at ``column[i]``."""
        return cls(np.arange(len(column) + 1), column, np.ones(len(column), np.int64), width)

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.width)
        return Csr(np.concatenate(([0], np.cumsum(counts))), self.rows()[order], self.data[order], len(self.indptr) - 1)

    def product(self, other: Csr) -> Csr:
        """Row products: row i is the sum of the rows of ``other`` that row i has entries for."""
        size = other.indptr[self.indices + 1] - other.indptr[self.indices]
        upto = np.cumsum(size)
        at = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - size - other.indptr[self.indices], size)
        key = np.repeat(self.rows(), size) * max(other.width, 1) + other.indices[at]
        value = np.repeat(self.data, size) * other.data[at]
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        row, column = np.divmod(key[first], max(other.width, 1))
        indptr = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(self.indptr) - 1))))
        return Csr(indptr, column, np.add.reduceat(value, first) if len(first) else value, other.width)

    def times(self, vector: np.ndarray) -> np.ndarray:
        """Matrix times vector."""
        sums = np.concatenate(([0], np.cumsum(self.data * vector[self.indices])))
        return sums[self.indptr[1:]] - sums[self.indptr[:-1]]

    def product_sizes(self, other: Csr) -> np.ndarray:
        """Entries of each row of the product of matrices of ones, where no two coincide, without forming it."""
        return self.times(np.diff(other.indptr))


class ByteWords(dict):
    """Ids of pieces under a byte-level BPE tokenizer; strings of special tokens are plain text."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(content)
        self.model, self.splitter = tokenizer.model, Splitter(tokenizer.pre_tokenizer)
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.alphabet = str.maketrans({chr(b): c for c, b in back.items()})
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token) if all(c in back for c in token) else 0

    def __missing__(self, piece: str) -> bytes:
        if piece == _SEPARATOR:
            return b""
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.alphabet))]
        out = array("I", ids).tobytes()
        if len(self) >= WORDS:
            self.clear()
        if len(piece) <= LONGEST:
            self[piece] = out
        return out

    def ids(self, texts: list[str]) -> np.ndarray:
        """Ids of the texts (each begins with a space and none is empty) one after the other."""
        joined = _SEPARATOR.join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        starts, _ = self.splitter.starts(codes)
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(joined)])]
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), "<u4").astype(np.int64)


class PieceWords(dict):
    """Ids of words with the spaces before them under a piece tokenizer; None where they spell
    something else."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        count = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(count)]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces that hold a space after a letter")
        self.spelt = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.lengths = np.array([len(s) for s in self.spelt], np.int64)
        self.space = self.model.piece_to_id("▁")

    def __missing__(self, word: str) -> bytes | None:
        ids = self.model.encode(word[1:]) if len(word) > 1 else [self.space]  # it puts the space before
        spelt = b"".join(map(self.spelt.__getitem__, ids))
        out = array("I", ids).tobytes() if spelt == word.encode() else None
        if len(self) >= WORDS:
            self.clear()
        if len(word) <= LONGEST:
            self[word] = out
        return out

    def ids(self, text: str) -> bytes | None:
        parts = list(map(self.__getitem__, re.findall(" +[^ ]*", text)))
        return None if None in parts else b"".join(parts)


@dataclass
class Aligned:
    """The tokens of some documents and their links."""

    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_doc: np.ndarray
    links: Csr  # A token x B token: bytes shared

    def shared(self) -> Csr:
        """A token x B token: in one group."""
        return self._groups(self.a_group).product(self._groups(self.b_group).transposed())

    def shared_sizes(self) -> np.ndarray:
        return self._groups(self.a_group).product_sizes(self._groups(self.b_group).transposed())

    def _groups(self, column: np.ndarray) -> Csr:
        return Csr.members(column, len(self.group_doc))


class Aligner:
    def __init__(self, a_content: str, b_content: bytes):
        self.a, self.b = ByteWords(a_content), PieceWords(b_content)
        size = max(len(self.a.lengths), len(self.b.lengths))
        # Written numbers with what may follow them: the same side, the other side, another group.
        plain = np.array([str(i) for i in range(size)], object)
        self.written = [plain + end for end in (",", "|", ";", "")]

    def align(self, texts: list[str | None]) -> Aligned:
        spaced = [" " + t if t else None for t in texts]
        b_ids = [self.b.ids(s) if s else None for s in spaced]
        held = [i for i, ids in enumerate(b_ids) if ids is not None]
        own = [spaced[i] for i in held]
        b = np.frombuffer(b"".join(b_ids[i] for i in held), "<u4").astype(np.int64)
        a = self.a.ids(own) if own else b[:0]
        ends = np.cumsum([len(s.encode()) for s in own], dtype=np.int64)
        a_spans, b_spans = Csr.spans(self.a.lengths[a]), Csr.spans(self.b.lengths[b])
        a_ends, b_ends = a_spans.indptr[1:], b_spans.indptr[1:]
        if a_spans.width != b_spans.width or (len(ends) and ends[-1] != a_spans.width):
            raise ValueError("the tokenizers do not spell the same bytes")
        bounds = a_ends[np.isin(a_ends, b_ends, assume_unique=True)]
        held = np.array(held, np.int64)
        doc = lambda offsets: held[np.searchsorted(ends, offsets)]
        return Aligned(
            a, b, doc(a_ends), doc(b_ends), np.searchsorted(bounds, a_ends), np.searchsorted(bounds, b_ends), doc(bounds),
            a_spans.product(b_spans.transposed()),
        )

    def groups_text(self, found: Aligned, docs: int) -> list[str]:
        """Per document the ids of its groups as ``a1,a2|b1;a3|b2,b3``."""
        a_at = np.arange(len(found.a)) + np.searchsorted(found.b_group, found.a_group, "left")
        b_at = np.arange(len(found.b)) + np.searchsorted(found.a_group, found.b_group, "right")
        ids, group, doc = (np.empty(len(a_at) + len(b_at), np.int64) for _ in range(3))
        side = np.zeros(len(ids), bool)
        for at, own in ((a_at, (found.a, found.a_group, found.a_doc)), (b_at, (found.b, found.b_group, found.b_doc))):
            ids[at], group[at], doc[at] = own
        side[b_at] = True
        follows = np.full(len(ids), 3)
        if len(ids) > 1:
            new = group[1:] != group[:-1]
            follows[:-1] = np.where(doc[1:] != doc[:-1], 3, np.where(new, 2, (side[1:] != side[:-1]).astype(np.int64)))
        parts = np.empty(len(ids), object)
        for kind, table in enumerate(self.written):
            chosen = follows == kind
            parts[chosen] = table[ids[chosen]]
        upto = np.searchsorted(doc, np.arange(docs + 1)).tolist()
        return ["".join(parts[x:y].tolist()) for x, y in zip(upto, upto[1:])]


def _aligner(shipped) -> Aligner:
    cache, key = worker_cache("aligner"), hash(shipped.value)
    if cache.get("key") != key:
        drop_worker_caches()
        cache.update(key=key, aligner=Aligner(*shipped.value))
    return cache["aligner"]


class _Block:
    """Documents gathered for one block."""

    def __init__(self):
        self.documents: list[tuple] = []
        # Of each slice: rows of its documents, pairs and links of the rows, pairs once.
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.bytes = 0

    def add(self, aligner: Aligner, ids: list, texts: list) -> None:
        found = aligner.align(texts)
        size = lambda doc: np.bincount(doc, minlength=len(texts)).tolist()
        rows = found.links.rows()
        link_doc = found.a_doc[rows]
        pair = found.a[rows] << 32 | found.b[found.links.indices]
        order = np.lexsort((pair, link_doc))
        link_doc, pair = link_doc[order], pair[order]
        first = np.concatenate(([True], (pair[1:] != pair[:-1]) | (link_doc[1:] != link_doc[:-1]))) if len(pair) else np.empty(0, bool)
        at = np.flatnonzero(first)
        shared = np.bincount(found.a_doc, found.shared_sizes(), len(texts)).astype(np.int64).tolist()
        groups = aligner.groups_text(found, len(texts))
        digests = [sha256(g.encode()).hexdigest() if g else "" for g in groups]
        self.documents += zip(ids, size(found.a_doc), size(found.b_doc), size(found.group_doc), size(link_doc), shared, digests)
        self.sizes.append(np.bincount(link_doc[at], minlength=len(texts)))
        self.links.append(np.diff(np.append(at, len(pair))).astype(np.int32))
        self.pairs.append(pair[at])
        self.known.append(np.unique(pair))
        self.bytes += sum(len(t) for t in texts if t)

    def row(self) -> pa.RecordBatch:
        known = np.unique(np.concatenate(self.known))
        at = np.concatenate([np.searchsorted(known, pair).astype(np.int32) for pair in self.pairs])
        indptr = np.cumsum(np.concatenate(([0], *self.sizes)), dtype=np.int64)
        lists = [pa.array([list(c)], pa.list_(t)) for c, t in zip(zip(*self.documents), _DOCUMENT)]
        holding = np.bincount(at, minlength=len(known)).astype(np.int32)
        matrix = [indptr, at, np.concatenate(self.links), known, holding]
        number = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
        return pa.RecordBatch.from_arrays([*lists, *map(number, matrix)], names=_NAMES)


_DOCUMENT = [pa.int64()] * 6 + [pa.string()]
_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]
_NAMES = [*_RESULT, "indptr", "indices", "links", "pairs", "holding"]
_BLOCKS = (
    ", ".join(f"{c} array<{'string' if c == 'groups_sha256' else 'bigint'}>" for c in _RESULT)
    + ", indptr array<bigint>, indices array<int>, links array<int>, pairs array<bigint>, holding array<int>"
)


def _align(shipped) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = _aligner(shipped), _Block()
        for whole in batches:
            for batch in slices(whole, 1, SLICE):
                block.add(aligner, batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if block.bytes >= BLOCK:
                    yield block.row()
                    block = _Block()
        if block.documents:
            yield block.row()

    return run


def _sum_up(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Per document of a block the sums over its links."""
    drop_worker_caches()  # the words
    block = blocks.iloc[0]
    count, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    count[counts["pos"]], best[counts["pos"]] = counts["count"], counts["is_best"]
    matrix = Csr(np.array(block["indptr"]), np.array(block["indices"], np.int64), np.array(block["links"], np.int64), len(counts))
    columns = {c: list(block[c]) for c in _RESULT}
    columns["doc_id"] = pd.array(columns["doc_id"], "Int64")
    return pd.DataFrame(columns | {"n_best": matrix.times(best), "count_sum": matrix.times(count)})


def align_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256,
    and ``n_shared``, the pairs of tokens that share a group."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    aligned = rows.mapInArrow(_align(_shipped(docs, a_path, b_path)), _BLOCKS)
    blocks = stored(aligned.withColumn("block", F.monotonically_increasing_id()), "blocks", **WRITER)
    entries = F.posexplode(F.arrays_zip("pairs", "holding")).alias("pos", "e")
    entries = blocks.select("block", entries).select("block", "pos", F.col("e.pairs").alias("pair"), F.col("e.holding").alias("n"))
    counted = entries.withColumn("count", F.sum("n").over(Window.partitionBy("pair"))).drop("n")
    counted = stored(counted.withColumn("a_id", F.shiftright("pair", 32)).drop("pair"), "counts")
    best = counted.groupBy("a_id").agg(F.max("count").alias("best"))
    # One row for each id of a vocabulary at most.
    counted = counted.join(F.broadcast(best), "a_id").select("block", "pos", "count", (F.col("count") == F.col("best")).alias("is_best"))
    matrices = blocks.select("block", *_RESULT, "indptr", "indices", "links")
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in [*_RESULT, "n_best", "count_sum"])
    return matrices.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(lambda a, b: _sum_up(a, b), schema)


_LINKS = "doc_id bigint, a_pos bigint, b_pos bigint, a_id bigint, b_id bigint, n_bytes bigint"


def _link_rows(shipped, shared: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shipped)
        for whole in batches:
            for batch in slices(whole, 1, SLICE // 2):
                found = aligner.align(batch.column(1).to_pylist())
                links = found.shared() if shared else found.links
                row, column = links.rows(), links.indices
                doc = found.a_doc[row]
                place = lambda docs: np.arange(len(docs)) - np.searchsorted(docs, docs)
                ids = batch.column(0).take(pa.array(doc))
                values = [place(found.a_doc)[row], place(found.b_doc)[column], found.a[row], found.b[column], links.data]
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, values)], names=[c.split()[0] for c in _LINKS.split(", ")])

    return run


def overlap_links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every pair of tokens that share bytes: places in the text, ids, and how many bytes."""
    return _links(docs, a_path, b_path, False)


def group_links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every pair of tokens that share a group; ``n_bytes`` is 1. A group without inner boundaries
    gives all its pairs: ``align_tokens`` counts them without forming them."""
    return _links(docs, a_path, b_path, True)


def _links(docs: DataFrame, a_path: str, b_path: str, shared: bool) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_link_rows(_shipped(docs, a_path, b_path), shared), _LINKS)


def _shipped(docs: DataFrame, a_path: str, b_path: str):
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # two files of fixed vocabularies
