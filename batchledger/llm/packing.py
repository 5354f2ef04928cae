"""Packing documents into sequences by mixture-controlled deficit round-robin.

Every source is a queue of tokens, cut into grains of ``GRAIN`` tokens. In round w each queue in
turn earns its quantum of grains, in proportion to what it holds, sends the whole grains it has
earned and carries the rest, its deficit, into the next round. A round is about one sequence, so
every sequence holds the sources in their proportions to within a grain or two. The rounds are
laid end to end and cut every ``LENGTH`` tokens: only the last sequence is padded.

Quanta are fixed-point numbers, so what a queue has sent before round w is ``w * quantum`` rounded
down. The deficit of any round is thus known without the rounds before it, and each task places
its own documents: it needs the queues' totals and where its part of each queue begins.

Tokens are written once with their place in their task's queues; the task totals are summed per
queue and joined back. The totals (at most ``MAX_QUEUES`` numbers; beyond so many sources, the
smallest share a queue) go to the tasks. Target proportions are the shares of the table itself.

Defined results: null text counts as empty and has the end token only; repeated rows are packed
each; a null source is a source; of equally large sources the first by name keeps its own queue; texts
of any length are cut, never dropped. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import source_key, stored, text_or_empty, worker_cache

LENGTH = 4096
GRAIN = 64
END_ID = 2
MAX_QUEUES = 4096
#: Words and parts of words that a Python worker remembers, about 200 bytes each.
CACHED = 1 << 17
_FRACTION = 20

_SIMPLE = re.compile("[!-&(-~À-ɏ]+")
_LETTERS = re.compile("[a-zß-öø-ɏ]+")
_RUNS = re.compile("[a-zß-öø-ɏ]+|[^a-zß-öø-ɏ]+")
#: Texts of white space, printed ASCII and Latin letters alone, and what the tokenizer's own pattern finds in their UTF-8
#: once they are lower-cased: letters, among them all that is not ASCII; contractions; digits; other characters.
_LATIN = re.compile("[\t-\r -~À-ÖØ-öø-ɏ]*")
_PRINTED = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F)])
_PARTS = re.compile(rb"[a-z\x80-\xff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-z\x80-\xff0-9\t-\r ]+")
_PROBES = ("It's we'll FIVE\téTÉ x, 'S 12.5%! ß.Ärger\n\nÿ \"'s 1's ''re'x e2É", "It's we'll FIVE\tx, 'S 12.5%! \"'s\x0b1's ''re'x don'ts a<b")


class WordEncoder(dict):
    """Token ids of words, as little-endian numbers, under a tokenizer that never joins what white
    space separates; so the ids of a text are those of its words.

    A text of ASCII and Latin letters is lower-cased and cut as a whole into what the tokenizer's own
    pattern finds: each part is encoded once and remembered, whatever stands around it. Any other text
    is cut into words. A word of these letters without apostrophe is lower-cased and cut between letters
    and other characters, which makes far fewer different parts; any other is encoded as it stands.
    """

    def __init__(self, tokenizer: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.model = self.tokenizer.model
        self.letter = "H" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "I"
        self.width = struct.calcsize(f"<{self.letter}")
        self.end = self._numbers([end_id])
        self.before: dict[bytes, bytes] = {}
        # Byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = str.maketrans({b: chr(256 + i) for i, b in enumerate(hidden)})
        # Tokenizers with another pattern get words.
        self.by_part = True
        self.by_part = all(map(self._agrees, _PROBES))

    def _numbers(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        out = self.before.get(word) or self._word(word)
        if len(self) >= CACHED:  # words met since stay, the others go at the next time
            self.before = dict(self)
            self.clear()
        self[word] = out
        return out

    def _word(self, word: bytes) -> bytes:
        lower = word.lower()
        if lower.isalpha():  # ASCII letters
            return self[lower] if lower != word else self._letters(word.decode())
        if word[-1:] in b".," and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]
        text = word.decode()
        if _SIMPLE.fullmatch(text) and "<|" not in text:
            plain = text.lower()
            if not _SIMPLE.fullmatch(plain):  # some letters are lower-cased into other alphabets
                return self._numbers(self.tokenizer.encode(text, add_special_tokens=False).ids)
            parts = _RUNS.findall(plain)
            if len(parts) > 1 or plain != text:
                return b"".join([self[p.encode()] for p in parts])
            if _LETTERS.fullmatch(plain):
                return self._letters(word.decode("latin-1").translate(self.alphabet))
        return self._numbers(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, shown: str) -> bytes:
        return self._numbers([t.id for t in self.model.tokenize(shown)])

    def encode(self, text: bytes) -> bytes:
        """The ids of a text and the end token."""
        return b"".join(map(self.__getitem__, self._parts(text))) + self.end

    def _parts(self, text: bytes) -> list[bytes]:
        if not self.by_part or b"<|" in text:
            return text.split()
        if text.isascii():
            return text.split() if text.translate(None, _PRINTED) else _PARTS.findall(text.lower())
        shown = text.decode()
        if _LATIN.fullmatch(shown) and _LATIN.fullmatch(plain := shown.lower()):  # some letters are lower-cased into other alphabets
            return _PARTS.findall(plain.encode())
        return text.split()

    def _agrees(self, probe: str) -> bool:
        return self.encode(probe.encode()) == self._numbers(self.tokenizer.encode(probe, add_special_tokens=False).ids) + self.end

    def check(self) -> None:
        """Refuse a tokenizer that words and their parts do not make up."""
        if not self._agrees("It's we'll FIVE\tétÉ—x, 'S 12.5%! ß.Ärger\n\nÿ ΣΑΣ 日本語 <|endoftext|> end."):
            raise ValueError("this tokenizer joins what white space separates")


def _tokenise(tokenizer, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("word_encoder")
        key = (hash(tokenizer.value), end_id)
        if cache.get("key") != key:
            cache.update(key=key, encoder=WordEncoder(tokenizer.value, end_id))
        encode, width = cache["encoder"].encode, cache["encoder"].width
        part, sent = TaskContext.get().partitionId(), {}
        for batch in batches:
            queues = batch.column(2).to_pylist()
            starts, counts, tokens = [], [], []
            for queue, text in zip(queues, batch.column(1)):
                ids = encode(text.as_py())
                n = len(ids) // width
                starts.append(sent.get(queue, 0))
                counts.append(n)
                sent[queue] = starts[-1] + n
                tokens.append(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([part] * len(queues), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(tokens, pa.binary())],
                names=["doc_id", "queue", "part", "start", "n", "ids"],
            )

    return run


class Rounds:
    """Where the tokens of each queue stand in the packed stream."""

    def __init__(self, totals: list[int], length: int, grain: int):
        self.totals = np.array(totals, np.int64)
        self.grain = grain
        self.grains = -(-self.totals // grain)
        rounds = max(1, -(-int(self.totals.sum()) // length))
        # Rounded up, so that round number `rounds` leaves nothing behind.
        self.quanta = np.array([-(-(int(g) << _FRACTION) // rounds) for g in self.grains], np.int64)

    def sent(self, rounds: np.ndarray, queue=slice(None)) -> np.ndarray:
        """Tokens of the queue (or of each) sent before these rounds."""
        grains = np.minimum((rounds * self.quanta[queue]) >> _FRACTION, self.grains[queue])
        return np.minimum(grains * self.grain, self.totals[queue])

    def offset(self, rounds: np.ndarray, queue: int) -> np.ndarray:
        """Tokens of the stream before the queue's turn in these rounds."""
        out = np.empty(len(rounds), np.int64)
        step = max(1, (1 << 20) // len(self.totals))
        for i in range(0, len(rounds), step):
            r = rounds[i : i + step, None]
            out[i : i + step] = self.sent(r + 1, slice(0, queue)).sum(1) + self.sent(r, slice(queue, None)).sum(1)
        return out

    def runs(self, queue: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number, begin, end, place) of what the stream holds together of each span [first, last) of the queue's tokens."""
        low = first // self.grain
        times = (last - 1) // self.grain - low + 1
        number, k = _repeated(times)
        rounds = -(-((low[number] + k + 1) << _FRACTION) // self.quanta[queue]) - 1
        fresh = np.ones(len(rounds), bool)
        fresh[1:] = (number[1:] != number[:-1]) | (rounds[1:] != rounds[:-1])
        number, rounds = number[fresh], rounds[fresh]
        sent = self.sent(rounds, queue)
        begin, end = np.maximum(sent, first[number]), np.minimum(self.sent(rounds + 1, queue), last[number])
        return number, begin, end, self.offset(rounds, queue) + begin - sent


def _repeated(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index so many times, and which time it is."""
    number = np.repeat(np.arange(len(times)), times)
    return number, np.arange(len(number)) - (np.cumsum(times) - times)[number]


def _cut(number: np.ndarray, begin: np.ndarray, end: np.ndarray, place: np.ndarray, length: int):
    """The runs cut where a sequence ends: (number, begin, size, place)."""
    size = end - begin
    run, k = _repeated((place + size - 1) // length - place // length + 1)
    number, begin, size, place = (x[run] for x in (number, begin, size, place))
    left = np.maximum(place, (place // length + k) * length)
    right = np.minimum(place + size, (place // length + k + 1) * length)
    return number, begin + left - place, right - left, left


def _place(names: list[str], totals: list[int], width: str, length: int, grain: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(totals, length, grain)
        numbers = {name: i for i, name in enumerate(names)}
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                counts, starts = (batch.column(i).to_numpy() for i in (1, 3))
                queues = np.array([numbers[q] for q in batch.column(2).to_pylist()])
                cuts = []
                for queue in np.unique(queues).tolist():
                    own = np.flatnonzero(queues == queue)
                    number, *pieces = _cut(*rounds.runs(queue, starts[own], starts[own] + counts[own]), length)
                    cuts.append((own[number], *pieces))
                doc, begin, size, place = (np.concatenate(x) for x in zip(*cuts))
                order = np.argsort(doc, kind="stable")
                doc, begin, size, place = (x[order] for x in (doc, begin, size, place))
                begin = begin - starts[doc]
                crcs, data, last, view = [], [], -1, memoryview(b"")
                for d, b, e in zip(doc.tolist(), (4 * begin).tolist(), (4 * (begin + size)).tolist()):
                    if d != last:
                        last, view = d, memoryview(np.frombuffer(batch.column(4)[d].as_buffer(), width).astype("<u4")).cast("B")
                    crcs.append(zlib.crc32(view[b:e]))
                    data.append(bytes(view[b:e]) if with_ids else None)
                columns = [batch.column(0).take(pa.array(doc)), *map(pa.array, (begin, size)), pa.array(crcs, pa.int64())]
                columns += [*map(pa.array, (counts[doc], place // length, place % length)), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=_PIECE)

    return run


_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def _queues(docs: DataFrame) -> DataFrame:
    """``docs`` with their ``queue``: a source each; beyond ``MAX_QUEUES`` sources the largest keep
    their own, and the rest, each smaller than all of these, are one queue."""
    rows = docs.withColumn("queue", source_key())
    sizes = rows.groupBy("queue").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).alias("_size"))
    if sizes.count() <= MAX_QUEUES:
        return rows
    largest = sizes.orderBy(F.desc("_size"), "queue").limit(MAX_QUEUES - 1).select("queue", F.lit(True).alias("_own"))
    # MAX_QUEUES - 1 rows.
    rows = rows.join(F.broadcast(largest), "queue", "left")
    return rows.withColumn("queue", F.when(F.col("_own"), F.col("queue")).otherwise(F.lit("2")))


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, grain: int = GRAIN, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` as
    little-endian unsigned 32-bit numbers (null unless ``with_ids``).

    The pieces of a ``sequence_id`` by ``offset`` are its tokens.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    encoder = WordEncoder(tokenizer, end_id)
    encoder.check()
    width = f"<u{encoder.width}"
    shipped = spark.sparkContext.broadcast(tokenizer)  # one file of a fixed vocabulary
    rows = _queues(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source"))
    rows = rows.select("doc_id", text_or_empty().cast("binary").alias("text"), "queue")
    tokens = stored(
        rows.mapInArrow(_tokenise(shipped, end_id), "doc_id bigint, queue string, part int, start bigint, n bigint, ids binary"),
        "tokens",
    )
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = stored(
        tokens.groupBy("queue", "part").agg(F.sum("n").alias("_n")).withColumn("_begin", F.coalesce(F.sum("_n").over(earlier), F.lit(0))),
        "queues",
    )
    # At most MAX_QUEUES rows.
    totals = sorted((r["queue"], r["n"]) for r in begins.groupBy("queue").agg(F.sum("_n").alias("n")).collect())
    placed = tokens.join(begins.drop("_n"), ["queue", "part"]).select("doc_id", "n", "queue", (F.col("start") + F.col("_begin")).alias("start"), "ids")
    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'bigint'}" for c in _PIECE)
    return placed.mapInArrow(_place([q for q, _ in totals], [n for _, n in totals], width, length, grain, with_ids), schema)
