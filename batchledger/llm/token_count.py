"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic machines read a text, and their transitions carry what is counted.

* ``Splitter`` is the tokenizer's split pattern as an automaton of 12 states over 12 classes of
  characters. A transition tells whether a piece begins at the character read or at the one before
  it. A block of texts is cut into lanes of equal width that are stepped side by side: a lane's map
  from each state to the state it ends in shrinks to one state within a few characters, maps are
  composed over the lanes by a parallel prefix scan, and with that every lane knows its start state.
* ``Transducer`` reads a piece byte by byte. After every byte it is in a state that holds, for each
  place where a token may still be open, the last token before that place and the tokens up to
  there less the tokens up to now. Merge ranks decide which pairs of tokens can stand side by side;
  exactly one token that ends at the byte can follow what is before it. A transition carries the
  change of the token count. States are compiled when first met and kept. Counts of whole pieces
  are kept as well.

Very long texts are cut into chunks that are counted in different tasks. A chunk's map is (head,
count, tail): the text before its first certain boundary, the tokens between that and the last
certain one, and the text after it. Maps compose: the tail of one and the head of the next are
counted together. Per document they are folded in order. A chunk without a certain boundary (one
word of ``CHUNK`` letters) is passed on as it is.

Defined results: null text is empty, with 0 tokens; a text of any length counts whole; repeated rows
are counted each; ids may be null; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored, text_or_empty, worker_cache

LIMIT = 1024
#: Characters of a chunk; longer texts are spread over tasks.
CHUNK = 1 << 16
#: Bytes of text stepped at once, and characters of a lane.
BLOCK, LANE = 1 << 22, 256
#: Pieces and transducer states that a Python worker remembers (some 200 and 1000 bytes each).
PIECES, KEPT_STATES = 500_000, 100_000

STATES = ["start", "letters", "digits", "others", "quote", "quote r", "quote v", "quote l", "space", "white", "spaces", "whites"]
#: Letters that end or open a contraction have classes of their own; "end" separates texts.
CLASSES = ["letter", "stmd", "r", "v", "l", "e", "digit", "space", "white", "quote", "other", "end"]
_LETTERS = {"letter", "stmd", "r", "v", "l", "e"}
_OPENS = {"digit": "digits", "space": "space", "white": "white", "quote": "quote", "other": "others"} | dict.fromkeys(_LETTERS, "letters")
#: What completes a contraction after a quote and this state.
_COMPLETES = {"quote r": "e", "quote v": "e", "quote l": "l"}
_SEPARATOR = "\ud800"  # in no text
_UNKNOWN = 255


def step(state: str, read: str) -> tuple[str, bool, bool]:
    """(next state, a piece begins here, a piece begins one character before)."""
    if read == "end":
        return "start", True, state in _COMPLETES
    if state == "start":
        return _OPENS[read], True, False
    if state in ("space", "white", "spaces", "whites"):
        if read in ("space", "white"):
            return read + "s", False, False
        many = state in ("spaces", "whites")
        if state in ("space", "spaces"):  # the last space goes with what follows
            return "others" if read == "quote" else _OPENS[read], False, many
        return _OPENS[read], True, many
    if state in _COMPLETES:
        if read == _COMPLETES[state]:
            return "start", False, False
        after, here, _ = step("letters", read)
        return after, here, True
    if state == "quote":
        if read == "stmd":
            return "start", False, False
        if read in ("r", "v", "l"):
            return f"quote {read}", False, False
        if read in ("quote", "other"):
            return "others", False, False
        return _OPENS[read], True, False
    stays = {"letters": _LETTERS, "digits": {"digit"}, "others": {"quote", "other"}}[state]
    return (state, False, False) if read in stays else (_OPENS[read], True, False)


class Splitter:
    """The split pattern of byte-level tokenizers as an automaton over classes of characters."""

    def __init__(self, pre_tokenizer):
        self.pre = pre_tokenizer
        rows = [[step(s, c) for c in CLASSES] for s in STATES]
        self.next = np.array([[STATES.index(r[0]) for r in row] for row in rows], np.uint8).ravel()
        self.here = np.array([[r[1] for r in row] for row in rows], bool).ravel()
        self.before = np.array([[r[2] for r in row] for row in rows], bool).ravel()
        self.table = np.full(0x110000, _UNKNOWN, np.uint8)
        self.table[ord(_SEPARATOR)] = CLASSES.index("end")

    def classes(self, codes: np.ndarray) -> np.ndarray:
        """Classes of code points; the library itself is asked about those not met before."""
        out = self.table[codes]
        if (out == _UNKNOWN).any():
            for code in np.unique(codes[out == _UNKNOWN]).tolist():
                self.table[code] = CLASSES.index(self._ask(chr(code)))
            out = self.table[codes]
        return out

    def _ask(self, c: str) -> str:
        for name in ("r", "v", "l", "e"):
            if c == name:
                return name
        if c in "stmd":
            return "stmd"
        if c in " '":
            return "space" if c == " " else "quote"
        alone = lambda text: len(self.pre.pre_tokenize_str(text)) == 1
        if alone(f"x{c}x"):
            return "letter"
        if alone(f"1{c}1"):
            return "digit"
        return "other" if alone(f"!{c}!") else "white"

    def starts(self, codes: np.ndarray) -> tuple[np.ndarray, int]:
        """Where pieces begin, for codes read from the start state; and the position from which the
        answer would be the same for any other state at the beginning."""
        n = len(codes)
        lanes = max(1, -(-n // LANE))
        read = np.full(lanes * LANE, CLASSES.index("end"), np.uint8)
        read[:n] = self.classes(codes)
        read = np.ascontiguousarray(read.reshape(lanes, LANE).T)
        width = len(CLASSES)
        states = np.zeros((LANE + 1, lanes), np.uint8)
        maps = np.repeat(np.arange(len(STATES), dtype=np.uint8)[:, None], lanes, 1)
        open_lanes, one = np.arange(lanes), np.zeros(lanes, np.uint8)
        certain = np.full(lanes, LANE)  # characters after which the lane's state is known whatever it began in
        for j in range(LANE):
            states[j] = one
            one = self.next[one.astype(np.intp) * width + read[j]]
            if len(open_lanes):
                maps = self.next[maps.astype(np.intp) * width + read[j, open_lanes]]
                same = (maps == maps[0]).all(0)
                done = open_lanes[same]
                one[done], certain[done] = maps[0, same], j + 1
                open_lanes, maps = open_lanes[~same], maps[:, ~same]
        states[LANE] = one
        ends = np.repeat(one[None, :], len(STATES), 0)  # the lane's map; constant where it is certain
        ends[:, open_lanes] = maps
        entry = scan(ends)[0]
        for j in range(int(certain.max())):  # what lay before the certain part, from the known entry
            late = np.flatnonzero(certain > j)
            states[j, late] = entry[late]
            entry[late] = self.next[entry[late].astype(np.intp) * width + read[j, late]]
        moves = states[:LANE].astype(np.intp) * width + read
        here, before = self.here[moves].T.ravel()[:n], self.before[moves].T.ravel()[:n]
        here[:-1] |= before[1:]
        return np.flatnonzero(here), int(certain[0])


def scan(maps: np.ndarray) -> np.ndarray:
    """Exclusive prefix scan of maps (state x lane) under composition, doubling the reach."""
    states, lanes = maps.shape
    out = np.empty_like(maps)
    out[:, 0], out[:, 1:] = np.arange(states), maps[:, :-1]
    reach = 1
    while reach < lanes:
        later = out.copy()
        later[:, reach:] = np.take_along_axis(out[:, reach:], out[:, :-reach].astype(np.intp), 0)
        out, reach = later, reach * 2
    return out


class Transducer:
    """Counts the tokens of a piece; states are compiled from the merges when first met."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.vocab = vocab
        self.made: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            if token in self.made:
                raise ValueError("two merges make one token")
            self.made[token], self.rank[pair] = (*pair, rank), rank
        self.prefixes = {t[:k] for t in vocab for k in range(1, len(t))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.whole: dict[bytes, int | None] = {}
        self._forget()

    def _forget(self) -> None:
        # A state: places where a token may be open, as (bytes since, token before, tokens before less now).
        self.states: list[tuple] = [((b"", -1, 0),)]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def _side(self, token: int, child: int) -> list[tuple[int, float]]:
        """The token's edge from a byte up: (part, rank of the merge that ends it)."""
        out, ends = [], float("inf")
        while True:
            out.append((token, ends))
            if token not in self.made:
                return out[::-1]
            ends, token = self.made[token][2], self.made[token][child]

    def beside(self, a: int, b: int) -> bool:
        """Can the tokens stand side by side: does no merge across them come before those that make them?"""
        if a < 0:
            return True
        known = self.fits.get((a, b))
        if known is None:
            left, right, i, j, known = self._side(a, 1), self._side(b, 0), 0, 0, True
            while known:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                across = self.rank.get((x, y), float("inf"))
                if across < x_ends and across <= y_ends:
                    known = False
                elif i + 1 == len(left) and j + 1 == len(right):
                    break
                elif x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            if len(self.fits) > 4 * PIECES:
                self.fits.clear()
            self.fits[a, b] = known
        return known

    def token(self, text: bytes) -> int | None:
        """The token of these bytes, if the merges make it of them."""
        if text not in self.vocab:
            return None
        if text not in self.whole:
            token = self.vocab[text]
            parts = self.made.get(token)
            ok = len(text) == 1 if parts is None else self._made_of(parts, text)
            self.whole[text] = token if ok else None
        return self.whole[text]

    def _made_of(self, parts: tuple[int, int, int], text: bytes) -> bool:
        left, right, rank = parts
        # Its two halves come about by themselves, and nothing across them before the merge that joins them.
        cut = next(k for k in range(1, len(text)) if self.vocab.get(text[:k]) == left and self.vocab.get(text[k:]) == right)
        if self.token(text[:cut]) is None or self.token(text[cut:]) is None:
            return False
        own = self.rank.pop((left, right))
        try:
            self.fits.pop((left, right), None)
            return self.beside(left, right)
        finally:
            self.rank[left, right] = own
            self.fits.pop((left, right), None)

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        tail = bytes([byte])
        places, token, change = [], None, 0
        for since, before, less in self.states[state]:
            text = since + tail
            if token is None:
                found = self.token(text)
                if found is not None and self.beside(before, found):
                    token, change = found, less + 1
            if text in self.prefixes:
                places.append((text, before, less))
        if token is None:
            raise ValueError("bytes that no token covers")
        after = (*[(t, b, less - change) for t, b, less in places], (b"", token, 0))
        number = self.number.get(after)
        if number is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
            self.moves.append({})
        self.moves[state][byte] = number, change
        return number, change

    def count(self, piece: bytes) -> int:
        if len(self.states) > KEPT_STATES:
            self._forget()
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves[state].get(byte)
            if move is None:
                if len(self.states) > 2 * KEPT_STATES:  # within one long piece: keep its state alone
                    places = self.states[state]
                    self._forget()
                    moves, state = self.moves, self._adopt(places)
                move = self._compile(state, byte)
            state, change = move
            total += change
        return total

    def _adopt(self, places: tuple) -> int:
        if places not in self.number:
            self.number[places] = len(self.states)
            self.states.append(places)
            self.moves.append({})
        return self.number[places]


class TokenCounter(dict):
    """Token counts of pieces (the dict) and of texts, for a byte-level BPE tokenizer file's content."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec = json.loads(content)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec["normalizer"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if not plain or model.get("type") != "BPE" or odd:
            raise ValueError("not a plain byte-level BPE tokenizer")
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        alphabet = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.specials = special_tokens(spec)
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in self.specials}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.transducer = Transducer(vocab, [(raw(a), raw(b)) for a, b in merges])
        self.splitter = Splitter(Tokenizer.from_str(content).pre_tokenizer)
        self[_SEPARATOR] = 0

    def __missing__(self, piece: str) -> int:
        n = self.transducer.count(piece.encode())
        if len(self) >= PIECES:
            self.clear()
            self[_SEPARATOR] = 0
        if len(piece) <= 64:
            self[piece] = n
        return n

    def segments(self, text: str) -> list[str]:
        """The text between special tokens, the longest first where several begin."""
        if not any(s in text for s in self.specials):
            return [text]
        import re

        return re.split("|".join(re.escape(s) for s in self.specials), text)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text, special tokens in it included."""
        parts = [self.segments(t) for t in texts]
        joined = "".join(s + _SEPARATOR for p in parts for s in p)
        begins = np.cumsum([0, *(sum(map(len, p)) + len(p) for p in parts)])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(codes):
            return []
        starts, _ = self.splitter.starts(codes)
        ends = [*starts[1:].tolist(), len(codes)]
        pieces = [joined[a:b] for a, b in zip(starts.tolist(), ends)]
        sums = np.cumsum([0, *map(self.__getitem__, pieces)])
        at = np.searchsorted(starts, begins)
        return [int(n) + len(p) - 1 for n, p in zip(sums[at[1:]] - sums[at[:-1]], parts)]

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, tokens between, tail) of a part of a text without special tokens; tail is null, and
        the head the whole part, where no boundary is certain."""
        codes = np.frombuffer(chunk.encode("utf-32-le"), "<u4")
        starts, certain = self.splitter.starts(codes)
        white = np.isin(self.splitter.classes(codes), [CLASSES.index("space"), CLASSES.index("white")])
        # Behind white space a boundary depends on what follows; and one may be decided a character late.
        sure = starts[starts > certain]
        sure = sure[~white[sure - 1]]
        if not len(sure):
            return chunk, 0, None
        first, last = int(sure[0]), int(sure[-1])
        return chunk[:first], self.counts([chunk[first:last]])[0], chunk[last:]

    def fold(self, maps: list[tuple[str, int, str | None]]) -> int:
        """Tokens of a text from the maps of its chunks, in order."""
        total, opened = 0, []
        for head, count, tail in maps:
            opened.append(head)
            if tail is not None:
                total += self.counts(["".join(opened)])[0] + count
                opened = [tail]
        return total + self.counts(["".join(opened)])[0]


def special_tokens(spec: dict) -> list[str]:
    """Strings that the tokenizer takes out of a text before all else, longest first."""
    tokens = spec.get("added_tokens") or []
    if any(t.get(k) for t in tokens for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError("special tokens that take white space or need word ends")
    return sorted((t["content"] for t in tokens), key=len, reverse=True)


def _counter(shipped) -> TokenCounter:
    cache, key = worker_cache("token_counter"), hash(shipped.value)
    if cache.get("key") != key:
        cache.update(key=key, counter=TokenCounter(shipped.value))
    return cache["counter"]


def slices(batch: pa.RecordBatch, column: int, block: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``block`` bytes of text, one row at least."""
    values = batch.column(column)
    ends = np.cumsum([len(v.as_buffer()) if v.is_valid else 0 for v in values])
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + block, "right")))
        yield batch.slice(first, last - first)
        first = last


def _count(shipped) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shipped)
        for whole in batches:
            for batch in slices(whole, 2):
                counts = counter.counts(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def _map_chunks(shipped) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shipped)
        for whole in batches:
            for batch in slices(whole, 5):
                heads, counts, tails = zip(*map(counter.chunk_map, batch.column(5).to_pylist()))
                columns = [*batch.columns[:5], pa.array(heads, pa.string()), pa.array(counts, pa.int64()), pa.array(tails, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=_MAP)

    return run


_MAP = ["_row", "doc_id", "n_bytes", "segment", "chunk", "head", "count", "tail"]
_COUNTED = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def _fold(shipped) -> Callable:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counter = _counter(shipped)
        rows = rows.sort_values(["segment", "chunk"], kind="stable")
        total = int(rows["segment"].max())  # a special token between two segments
        for _, part in rows.groupby("segment", sort=True):
            tails = [t if isinstance(t, str) else None for t in part["tail"]]
            total += counter.fold(list(zip(part["head"], part["count"].tolist(), tails)))
        out = rows[["doc_id", "n_bytes"]].head(1).copy()
        out["n_tokens"] = total
        return out

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    specials = special_tokens(json.loads(content))
    shipped = docs.sparkSession.sparkContext.broadcast(content)  # one file of a fixed vocabulary
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    is_long = F.length("text") > chunk
    short = rows.filter(~is_long).mapInArrow(_count(shipped), _COUNTED)
    pattern = "|".join("\\Q" + s + "\\E" for s in specials) or "(?!)"
    cuts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.length("part") / chunk), F.lit(1)) - 1),
        lambda i: F.substring(F.col("part"), (i * chunk + 1).cast("int"), F.lit(chunk)),
    )
    parts = rows.filter(is_long).withColumn("_row", F.monotonically_increasing_id())
    parts = parts.select("_row", "doc_id", "n_bytes", F.posexplode(F.split("text", pattern, -1)).alias("segment", "part"))
    chunks = stored(parts.select("_row", "doc_id", "n_bytes", "segment", F.posexplode(cuts).alias("chunk", "text")), "chunks")
    maps = chunks.repartition("_row", "segment", "chunk").mapInArrow(
        _map_chunks(shipped), "_row bigint, doc_id bigint, n_bytes bigint, segment int, chunk int, head string, count bigint, tail string"
    )
    long = maps.groupBy("_row").applyInPandas(_fold(shipped), _COUNTED)
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
