"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions.

The patterns (email, ip, card, phone) always stand. The tagger adds spans that they miss: a
bidirectional LSTM over characters gives scores per tag (outside; first and further characters of
each kind), transition scores chain them, and both are trained together in numpy by the CRF
likelihood of labelled spans: those of the patterns in about ``TRAIN_ROWS`` documents drawn by
hash, and values and look-alikes of known kind written into snippets of these documents.

Every kind needs a digit or an ``@``, so only stretches around those are tagged, wherever in the
text they are. A stretch is read in overlapping windows; where windows meet, their scores are
averaged with the weight of the distance to the window's edge, and one Viterbi pass over the whole
stretch decides, so no span is cut or doubled at a window's border. A found span has to hold what
its kind needs (checked like the patterns), must not touch a valid match of the patterns and must not
lie within one of its own kind that failed.

Defined results: null text counts as empty; without digits and ``@`` there are no spans; repeated
rows give a row each; of overlapping spans of one kind the leftmost stands; texts of any length are read
whole; an empty table gives no rows. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP, MARGIN = 64, 32, 24
TRAIN_ROWS = 5_000
#: Windows of one training document.
TRAIN_WINDOWS = 8
HIDDEN = 16
SURE = 0.9

# ---- patterns -------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that begins inside a run of digits would also begin at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile("[0-9@]+")
_NUMBER = re.compile("[0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ so that long runs of letters cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _valid(kind: str, value: str) -> bool:
    digits = "".join(_NUMBER.findall(value))
    if kind == "email":
        local, _, domain = value.partition("@")
        return bool(local) and "." in domain.strip(".") and "@" not in domain and not re.search(r"\s", value)
    if kind == "ip":
        parts = _NUMBER.findall(value)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return 8 <= len(digits) <= 15


def pattern_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, valid) of all matches, leftmost and not overlapping within a kind."""
    if not _TRIGGER.search(text):
        return []
    found = [(0, s, e, True) for s, e in _emails(text)]
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        found += [(kind, m.start(), m.end(), _valid(KINDS[kind], m.group())) for m in pattern.finditer(text)]
    return found


# ---- stretches and windows ------------------------------------------------------------------

_SIGNS = "@.-_+() /:,=\"'%&#$!?|\n\t"


def _code(c: str) -> int:
    if "a" <= c <= "z":
        return 1 + ord(c) - 97
    if "A" <= c <= "Z":
        return 27
    if "0" <= c <= "9":
        return 28 + (int(c) > 2) + (int(c) > 5)
    at = _SIGNS.find(c)
    return 31 + at if at >= 0 else 31 + len(_SIGNS) + (ord(c) > 127)


_CODES = np.array([_code(chr(i)) for i in range(128)] + [_code("é")], np.int64)
_SIZE = int(_CODES.max()) + 1  # code 0 fills windows up


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CODES[np.minimum(points, 128)]


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits and @, with ``MARGIN`` characters on either side."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        first, last = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and first <= out[-1][1]:
            out[-1][1] = last
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _windows(length: int) -> range:
    return range(0, max(1, length - STEP), STEP)


# ---- model ----------------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2k first and 2 + 2k further characters of kind k
_EDGE = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """One LSTM each way with a lookup for its input, a linear layer, and tag transitions."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p: dict[str, np.ndarray] = {"out": rng.normal(0, 0.2, (2 * h, TAGS)), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS))}
        for way in "fb":
            self.p[f"x{way}"] = rng.normal(0, 0.3, (_SIZE, 4 * h))
            self.p[f"x{way}"][:, h : 2 * h] += 1  # remember at first
            self.p[f"u{way}"] = rng.normal(0, h**-0.5, (h, 4 * h))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _read(self, codes: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        n, steps = codes.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, steps, HIDDEN), np.float32)
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        for t in order:
            z = self.p[f"x{way}"][codes[:, t]] + h @ self.p[f"u{way}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            before_h, before_c = h, c
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[:, t] = h
            if keep is not None:
                keep.append((t, before_h, before_c, i, f, o, g, th))
        return out

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        both = np.concatenate((self._read(codes, "f"), self._read(codes, "b")), 2)
        return both @ self.p["out"] + self.p["bias"]

    def _gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        n, steps = codes.shape
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._read(codes, w, kept[w]) for w in "fb"], 2)
        e = (both @ self.p["out"] + self.p["bias"]).astype(np.float64)
        move = self.p["move"].astype(np.float64)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, steps):
            alpha[:, t] = e[:, t] + _logsumexp(alpha[:, t - 1, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _logsumexp(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[:, -1], 1)
        share = np.exp(alpha + beta - total[:, None, None])
        d_move = np.zeros_like(move)
        for t in range(1, steps):
            pair = alpha[:, t - 1, :, None] + move + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
            d_move += np.exp(pair).sum(0)
        np.add.at(d_move, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        share[np.arange(n)[:, None], np.arange(steps), tags] -= 1
        d_e = (share / n).astype(np.float32)
        grads = {"move": d_move / n, "out": np.einsum("nth,ntk->hk", both, d_e), "bias": d_e.sum((0, 1))}
        d_both = d_e @ self.p["out"].T
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            gu = np.zeros_like(self.p[f"u{way}"])
            d_in = np.empty((n, steps, 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((n, HIDDEN), np.float32)
            for t, before_h, before_c, i, f, o, g, th in reversed(kept[way]):
                dh = dh + d_both[:, t, part]
                dc = dc + dh * o * (1 - th * th)
                dz = np.concatenate((dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)), 1)
                d_in[:, t] = dz
                gu += before_h.T @ dz
                dh, dc = dz @ self.p[f"u{way}"].T, dc * f
            grads[f"x{way}"], grads[f"u{way}"] = self._by_code(codes, d_in), gu
        return grads

    @staticmethod
    def _by_code(codes: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        flat, columns = codes.ravel(), gradient.reshape(codes.size, -1).T
        return np.stack([np.bincount(flat, c, _SIZE) for c in columns], 1)

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int = 360, batch: int = 64, rate: float = 0.02) -> None:
        rng = np.random.default_rng(5)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(codes), min(batch, len(codes)))
            grads = self._gradients(codes[chosen], tags[chosen])
            slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - slow * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def _stretch_scores(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """Scores of every character of each stretch, averaged over the windows that hold it."""
        places = [(k, w) for k, codes in enumerate(parts) for w in _windows(len(codes))]
        sums = [np.zeros((len(p), TAGS), np.float32) for p in parts]
        weights = [np.zeros((len(p), 1), np.float32) for p in parts]
        for first in range(0, len(places), 2048):
            some = places[first : first + 2048]
            codes = np.zeros((len(some), WINDOW), np.int64)
            for row, (k, w) in zip(codes, some):
                own = parts[k][w : w + WINDOW]
                row[: len(own)] = own
            for scores, (k, w) in zip(self.emissions(codes), some):
                n = min(WINDOW, len(parts[k]) - w)
                sums[k][w : w + n] += scores[:n] * _EDGE[:n, None]
                weights[k][w : w + n] += _EDGE[:n, None]
        return [s / w for s, w in zip(sums, weights)]

    def _decode(self, scores: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Best tags of each stretch, and the probability of each of them under the whole chain."""
        move = self.p["move"].copy()
        for tag in range(2, TAGS, 2):  # a further character follows one of its own kind
            move[[t for t in range(TAGS) if t not in (tag - 1, tag)], tag] = -1e4
        start = np.zeros(TAGS, np.float32)
        start[2::2] = -1e4
        lengths = [len(s) for s in scores]
        n, steps = len(scores), max(lengths)
        padded = np.zeros((n, steps, TAGS), np.float32)
        for row, s in zip(padded, scores):
            row[: len(s)] = s
            row[len(s) :, 1:] = -1e4
        best = ahead = padded[:, 0] + start
        alpha, back = np.empty_like(padded), np.zeros(padded.shape, np.int8)
        alpha[:, 0] = ahead
        for t in range(1, steps):
            choice = best[:, :, None] + move
            back[:, t] = choice.argmax(1)
            best = choice.max(1) + padded[:, t]
            alpha[:, t] = _logsumexp(alpha[:, t - 1, :, None] + move, 1) + padded[:, t]
        total = _logsumexp(alpha[:, -1], 1)
        tag, each = best.argmax(1), np.arange(n)
        beta = np.zeros((n, TAGS), np.float32)
        tags, sure = np.empty((n, steps), np.int8), np.empty((n, steps), np.float32)
        for t in range(steps - 1, -1, -1):
            tags[:, t] = tag
            sure[:, t] = np.exp(np.minimum(0, alpha[each, t, tag] + beta[each, tag] - total))
            tag = back[each, t, tag]
            beta = _logsumexp(move + (padded[:, t] + beta)[:, None, :], 2)
        return [r[:k] for r, k in zip(tags, lengths)], [r[:k] for r, k in zip(sure, lengths)]

    def spans(self, parts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """(kind, start, end) found in each stretch."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
        order = sorted(range(len(parts)), key=lambda k: len(parts[k]))
        while order:  # stretches of like length together, about a million scores at once
            some = [order.pop()]
            while order and (len(some) + 1) * len(parts[some[0]]) <= 1 << 17:
                some.append(order.pop())
            for k, tags, sure in zip(some, *self._decode(self._stretch_scores([parts[k] for k in some]))):
                firsts = np.flatnonzero(tags % 2)
                for s in firsts.tolist():
                    end = s + 1
                    while end < len(tags) and tags[end] == tags[s] + 1:
                        end += 1
                    if sure[s:end].mean() >= SURE:
                        out[k].append(((int(tags[s]) - 1) // 2, s, end))
        return out


# ---- training -------------------------------------------------------------------------------


def _tags(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, s, e in spans:
        tags[s:e] = 2 + 2 * kind
        tags[s] = 1 + 2 * kind
    return tags


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the documents with the tags of the patterns, and a snippet without digits or @."""
    for batch in batches:
        windows, tags = [], []
        for text in batch.column(0).to_pylist():
            spans = sorted((k, s, e) for k, s, e, ok in pattern_matches(text) if ok)
            used = 0
            for first, last in stretches(text):
                for w in _windows(last - first):
                    if used < TRAIN_WINDOWS:
                        a, b = first + w, min(last, first + w + WINDOW)
                        windows.append(text[a:b])
                        inside = [(k, max(s, a) - a, min(e, b) - a) for k, s, e in spans if s < b and e > a]
                        tags.append(_tags(b - a, inside).tolist())
                        used += 1
            plain = _TRIGGER.split(text)[0][:WINDOW]
            windows.append(plain)
            tags.append([0] * len(plain))
        yield pa.RecordBatch.from_arrays([pa.array(windows), pa.array(tags, pa.list_(pa.int64()))], names=["text", "tags"])


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _word(rng: np.random.Generator) -> str:
    return "".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(3, 9)))


def _value(rng: np.random.Generator) -> tuple[int, str]:
    """A value of a random kind, or (-1) one that only looks like it."""
    kind = int(rng.integers(-4, 4))
    if kind == 0:
        return 0, f"{_word(rng)}{rng.choice(['', '.', '_', '+'])}{_digits(rng, rng.integers(0, 3))}@{_word(rng)}.{rng.choice(['com', 'org', 'example.net', 'de'])}"
    if kind == 1:
        return 1, ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        body = _digits(rng, 15)
        body += next(d for d in "0123456789" if _luhn(body + d))
        sep = str(rng.choice(["", " ", "-", ".", "  "]))
        return 2, sep.join(body[i : i + 4] for i in range(0, 16, 4))
    if kind == 3:
        area, mid, end = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
        return 3, str(rng.choice([f"+1 ({area}) {mid}-{end}", f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"+49 {area} {mid}{end}", f"00{rng.integers(1, 99)} {area} {mid} {end}", f"{area}.{mid}.{end}", f"1.{area}.{mid}.{end}"]))
    alike = [
        f"version {rng.integers(1, 9)}.{rng.integers(0, 20)}", f"{rng.integers(1900, 2100)}", f"{rng.integers(1900, 2100)}-0{rng.integers(1, 9)}-{rng.integers(10, 28)}",
        f"{rng.integers(1, 23)}:{rng.integers(10, 59)}:{rng.integers(10, 59)}", f"{rng.integers(1, 999)},{_digits(rng, 3)},{_digits(rng, 3)}", _digits(rng, rng.integers(1, 7)),
        "".join(rng.choice(list("0123456789abcdef"), 24)), "".join(rng.choice(list("0123456789ABCDEFGHIJKLMNOP"), 20)), f"@{_word(rng)}", f"{_word(rng)} @ {_word(rng)}",
        f"{rng.integers(1, 99)}.{rng.integers(1, 99)}.{rng.integers(1, 99)}", f"{_digits(rng, 3)} {_digits(rng, 2)} {_digits(rng, 1)}", f"{_word(rng)}={_digits(rng, 12)}", f"${_digits(rng, 4)}.{_digits(rng, 2)}",
    ]
    return -1, str(rng.choice(alike))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, written: int = 6000) -> Tagger | None:
    """The tagger; None for an empty table."""
    share = max(1, docs.count() // train_rows)
    rows = docs.filter(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)).select("text")
    # About train_rows documents, TRAIN_WINDOWS + 1 windows each at most; twice that whatever repeats.
    got = rows.mapInArrow(_examples, "text string, tags array<bigint>").limit(2 * train_rows * (TRAIN_WINDOWS + 1)).toPandas()
    if not len(got):
        return None
    examples = sorted(zip(got["text"], map(tuple, got["tags"])))  # they arrive in any order
    plain = [t for t, tags in examples if not _TRIGGER.search(t)]
    examples = [x for x in examples if _TRIGGER.search(x[0])]
    rng = np.random.default_rng(3)
    for k in range(written):
        text = plain[k % len(plain)] if plain else ""
        kind, value = _value(rng)
        at = int(rng.integers(0, max(1, len(text) - len(value))))
        at = text.rfind(" ", 0, at + 1) + 1  # between words
        line = f"{text[:at]}{value}{rng.choice([' ', ' ', '. ', ', ', chr(10)])}{text[at:]}"[:WINDOW]
        span = [(kind, at, min(len(line), at + len(value)))] if kind >= 0 else []
        examples.append((line, tuple(_tags(len(line), span).tolist())))
    codes, tags = np.zeros((len(examples), WINDOW), np.int64), np.zeros((len(examples), WINDOW), np.int64)
    for i, (text, own) in enumerate(examples):
        codes[i, : len(text)], tags[i, : len(own)] = _codes(text), own
    tagger = Tagger()
    tagger.fit(codes, tags)
    return tagger


# ---- documents ------------------------------------------------------------------------------


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _free(matches: list[tuple[int, int, int, bool]], kind: int, start: int, end: int) -> bool:
    """No valid match there, and none of the span's own kind that covers it and failed."""
    return not any(start < e and s < end and (ok or k == kind and s <= start and end <= e) for k, s, e, ok in matches)


def find_spans(texts: list[str], tagger: Tagger | None) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Per text the spans of the patterns, and those the tagger adds."""
    matches = [pattern_matches(t) for t in texts]
    parts, owners = [], []
    for i, text in enumerate(texts):
        for first, last in stretches(text) if tagger else ():
            parts.append(_codes(text[first:last]))
            owners.append((i, first))
    more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (i, first), spans in zip(owners, tagger.spans(parts) if parts else ()):
        for kind, s, e in spans:
            s, e = s + first, e + first
            if _valid(KINDS[kind], texts[i][s:e]) and _free(matches[i], kind, s, e):
                more[i].append((kind, s, e))
    for found, own in zip(matches, more):
        yield [(k, s, e) for k, s, e, ok in found if ok], own


def _report(tagger: Tagger | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                rows = []
                for base, more in find_spans([t or "" for t in batch.column(1).to_pylist()], tagger):
                    every = base + more
                    counts = [sum(k == kind for k, _, _ in every) for kind in range(len(KINDS))]
                    rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
                columns = list(zip(*rows)) or [[]] * 6
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return rows.mapInArrow(_report(train(docs)), schema)
