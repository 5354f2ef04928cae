"""Personal data, packing, licenses, quality, language and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from helpers import awkward, collected, documents
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from batchledger.llm import langid, license_scan, packing, pii, quality, simhash
from batchledger.llm.common import table

# ---- personal data ----


def plain_patterns(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "card":
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
                ok = 16 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
            else:
                ok = kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")) or kind == "phone" and 8 <= len(digits) <= 15
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


@settings(max_examples=400, deadline=None)
@given(st.text("aZ0159@.+-_% ()é\n", max_size=60) | st.lists(st.sampled_from(["a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (206) 555-0100", "@", ".", " ", "-", "999", "+"]), max_size=12).map("".join))
def test_patterns(text):
    got = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e, ok in sorted(pii.pattern_matches(text)) if ok]
    assert got == plain_patterns(text)


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(table(spark, SF_DIR, "documents"))


def test_tagger_adds_what_the_patterns_miss(tagger):
    found = {}
    for text in ("and the (706) 555-3138 of thing", "is 10.1.2.3 or bob.x@mail.example.org there", "version 2.0 of AKIAMD55HKU1VBL4 in 2023-05-01", "key 0123456789abcdef01234567", "plain words only"):
        base, more = next(pii.find_spans([text], tagger))
        found[text[:9]] = [(pii.KINDS[k], text[s:e]) for k, s, e in base + more]
    assert found["and the ("] == [("phone", "(706) 555-3138")]
    assert found["is 10.1.2"] == [("email", "bob.x@mail.example.org"), ("ip", "10.1.2.3")] or sorted(found["is 10.1.2"])[0][0] == "email"
    assert found["version 2"] == found["key 01234"] == found["plain wor"] == []


def test_failed_matches_of_other_kinds_do_not_block():
    """Dotted cards and phones look like an ip with parts over 255."""
    sure = pii.Tagger()
    for kind, value in ((2, "4111.1111.1111.1111"), (3, "1.800.555.1212")):
        text = f"call {value} now"
        first = pii.stretches(text)[0][0]
        sure.spans = lambda parts, k=kind, s=5 - first, n=len(value): [[(k, s, s + n)]]  # however sure
        assert next(pii.find_spans([text], sure)) == ([], [(kind, 5, 5 + len(value))])
    text = "see 10.1.2.3 and 4111 1111 1111 1112 there"  # valid ip; failed card
    for kind, s, e in ((3, 4, 12), (2, 17, 36)):
        sure.spans = lambda parts, k=kind, s=s, e=e: [[(k, s, e)]]
        assert next(pii.find_spans([text], sure))[1] == []


def test_windows_agree_with_one_pass(tagger):
    """A long stretch, read in windows, has each span once."""
    rng = random.Random(6)
    text = " ".join(f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}" if i % 3 == 0 else "word" for i in range(120))
    base, more = next(pii.find_spans([text], tagger))
    spans = sorted(more)
    assert len(spans) >= 30
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_gradients():
    t = pii.Tagger()
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, pii._SIZE, (3, 6)), rng.integers(0, pii.TAGS, (3, 6))

    def loss():
        e = t.emissions(codes).astype(float)
        alpha = e[:, 0]
        for i in range(1, 6):
            alpha = e[:, i] + pii._logsumexp(alpha[:, :, None] + t.p["move"], 1)
        gold = e[np.arange(3)[:, None], np.arange(6), tags].sum(1) + t.p["move"][tags[:, :-1], tags[:, 1:]].sum(1)
        return (pii._logsumexp(alpha, 1) - gold).mean()

    grads = t._gradients(codes, tags)
    for name, at in (("out", (3, 2)), ("move", (1, 2)), ("uf", (2, 5)), ("ub", (0, 40)), ("xf", (int(codes[0, 2]), 7)), ("bias", (4,))):
        keep = t.p[name][at]
        t.p[name][at] = keep + 1e-3
        up = loss()
        t.p[name][at] = keep - 1e-3
        down = loss()
        t.p[name][at] = keep
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-3


def test_pii_rows(spark):
    rows = awkward() + [(900, "call +1 (206) 555-0100 a@b.co", "a"), (901, "1" * 60_000 + " 1.2.3.4 " + "a" * 60_000 + "@x.yz", "a")]
    got = pii.detect(documents(spark, rows)).collect()
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(",".join(plain_patterns(t or "")))
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in rows)
    for r in got:
        base = next(b for b in texts[r["doc_id"]] if hashlib.sha256(b.encode()).hexdigest() == r["base_sha256"])
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(filter(None, base.split(","))) <= set(spans)
        assert [sum(s.startswith(k) for s in spans) for k in pii.KINDS] == [r[f"n_{k}"] for k in pii.KINDS]
    assert pii.detect(documents(spark, [])).collect() == []


# ---- packing ----


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_words_make_up_texts(tokenizer_path):
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    whole = Tokenizer.from_file(tokenizer_path)
    texts = [t or "" for _, t, *_ in awkward()] + ["It's WE'LL —! á.́ <|endoftext|>x <|ENDOFTEXT|> İstanbul ΣΑΣ ÷×7 ½ K \x1c z\x00q É'm 12.5% \u0085y 한국어 ǅ ŉ ß ẞ A., .,"]
    rng = random.Random(8)
    texts += ["".join(rng.choice("aBé.ß'! 1ª\n<|") for _ in range(200)) for _ in range(50)]
    for t in texts:
        ids = np.frombuffer(encoder.encode(t.encode()), f"<u{encoder.width}").tolist()
        assert ids == whole.encode(t, add_special_tokens=False).ids + [packing.END_ID]


@pytest.mark.parametrize("length,grain,queues", [(4096, 64, 4096), (128, 16, 4096), (100, 30, 2)])
def test_packing(spark, monkeypatch, tokenizer_path, length, grain, queues):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "MAX_QUEUES", queues)
    rows = awkward()
    whole = Tokenizer.from_file(tokenizer_path)
    got = packing.pack(documents(spark, rows), tokenizer_path, length, grain).collect()
    want = Counter((i, tuple(whole.encode(t or "", add_special_tokens=False).ids + [2])) for i, t, *_ in rows)
    places = defaultdict(list)
    pieces = defaultdict(Counter)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]][(r["doc_tokens"], r["start"], bytes(r["ids"]))] += 1
    total = sum(len(t) * n for (_, t), n in want.items())
    assert sorted(places) == list(range(-(-total // length)))
    for k, own in places.items():
        end = 0
        for offset, n in sorted(own):
            assert offset == end
            end += n
        assert end == (length if k < max(places) else total - length * max(places))
    for (i, ids), n in want.items():  # each id once: the pieces of a document cover it without overlap
        own = [(s, p) for (k, s, p), m in pieces[i].items() if k == len(ids) for _ in range(m)]
        data = np.array(ids, "<u4").tobytes()
        mine = Counter((s, len(p)) for s, p in own if data[4 * s : 4 * s + len(p)] == p)
        assert sum(size * m for (_, size), m in mine.items()) >= n * len(data)


def test_sequences_hold_the_mixture(spark, tokenizer_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["the", "of", "and"]) for _ in range(rng.randint(50, 400))), "aab"[i % 3]) for i in range(300)]
    got = packing.pack(documents(spark, rows), tokenizer_path, 1024, 32, with_ids=False).collect()
    source = {i: s for i, _, s in rows}
    shares = defaultdict(Counter)
    for r in got:
        shares[r["sequence_id"]][source[r["doc_id"]]] += r["length"]
    total = sum((c for c in shares.values()), Counter())
    part = total["a"] / total.total()
    assert all(abs(c["a"] - part * 1024) <= 3 * 32 for k, c in shares.items() if k < max(shares))
    assert packing.pack(documents(spark, []), tokenizer_path).collect() == []


def test_every_code_point_beside_letters(tokenizer_path):
    with open(tokenizer_path, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    chars = [chr(c) for c in range(0x21, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"é{c}B ab{c}" for c in chars]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    odd = [c for c, t, w in zip(chars, texts, want) if encoder.encode(t.encode()) != encoder._numbers(w.ids) + encoder.end]
    assert odd == []


def test_the_largest_of_many_sources_keep_their_queues(spark, tokenizer_path, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 8)
    rows = [(i, "some words here " * (40 if i % 3 == 0 else 1 + i % 2), "hot" if i % 3 == 0 else f"s{i % 50}") for i in range(600)]
    docs = documents(spark, rows)
    queues = packing._queues(docs.select("doc_id", "text", "source")).select("source", "queue").distinct().collect()
    assert len({r["queue"] for r in queues}) == 8
    assert {r["queue"] for r in queues if r["source"] == "hot"} == {"0hot"} and sum(r["queue"] == "0hot" for r in queues) == 1
    pieces = packing.pack(docs, tokenizer_path, length=256, with_ids=False).collect()
    hot = sum(r["length"] for r in pieces if r["doc_id"] % 3 == 0)
    share = hot / sum(r["length"] for r in pieces)
    own = Counter()
    for r in pieces:
        own[r["sequence_id"]] += r["length"] * (r["doc_id"] % 3 == 0)
    # Up to where the last, partly filled grains of the eight queues begin.
    assert all(abs(n - share * 256) <= 64 for k, n in own.items() if k <= max(own) - 3)
    tokens = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert len(tokens) == 600 and sum(tokens.values()) == sum(r["length"] for r in pieces)


def test_parts_are_encoded_once_whatever_stands_around_them(tokenizer_path):
    with open(tokenizer_path, encoding="utf-8") as file:
        encoder = packing.WordEncoder(file.read())
    own = set(encoder)
    stems, ends = ["zoqua", "VeXib", "étuÉ", "ǆurß"], ["", ",", ".", "%%%", "'s", "'", "7", ",'d", "-'s"]
    text = " ".join(form + end for stem in stems for form in (stem, stem.lower(), stem.title()) for end in ends)
    for t in (text, text[: text.index("é")], text + " don'ts 1's \"'s x\x0by\x0cz"):
        assert encoder.encode(t.encode()) == encoder._numbers(encoder.tokenizer.encode(t, add_special_tokens=False).ids) + encoder.end
        if t is text:
            assert {p.decode() for p in set(encoder) - own} <= {"zoqua", "vexib", "étué", "ǆurß", *ends, "s", "d", ",'", "-'"}


def test_documents_of_a_queue_are_placed_together(monkeypatch):
    calls = []
    monkeypatch.setattr(packing.Rounds, "runs", lambda self, *a, runs=packing.Rounds.runs: calls.append(a[0]) or runs(self, *a))
    counts, queues, sent = [1 + 37 * i % 200 for i in range(300)], ["ab"[i % 7 == 0] for i in range(300)], Counter()
    starts = [(sent[q], sent.update({q: n}))[0] for q, n in zip(queues, counts)]
    ids = [np.full(n, i, "<u2").tobytes() for i, n in enumerate(counts)]
    columns = [pa.array(range(300)), pa.array(counts), pa.array(queues), pa.array(starts), pa.array(ids, pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "queue", "start", "ids"])
    placed = packing._place(["a", "b"], [sent["a"], sent["b"]], "<u2", 128, 16, True)
    rows = [r for out in placed(iter([batch])) for r in out.to_pylist()]
    assert sorted(calls) == [0, 1]
    assert sorted(p for r in rows for p in range(128 * r["sequence_id"] + r["offset"], 128 * r["sequence_id"] + r["offset"] + r["length"])) == list(range(sum(counts)))
    for i, n in enumerate(counts):
        own = [r for r in rows if r["doc_id"] == i]
        assert sorted(p for r in own for p in range(r["start"], r["start"] + r["length"])) == list(range(n))
        assert all(r["ids"] == np.full(r["length"], i, "<u4").tobytes() and r["ids_crc32"] == zlib.crc32(r["ids"]) and r["doc_tokens"] == n for r in own)


# ---- licenses ----


def plain_scan(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    at, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def plain_labels(text):
    """Best coverage and labels, diagonal by diagonal."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 1):
        at[words[i], words[i + 1]].append(i)
    labels, score = set(), 0.0
    for number, (phrase, label) in enumerate([*license_scan.BASE.items(), *license_scan.TEMPLATES.items()]):
        own = phrase.split()
        met = defaultdict(set)
        for k in range(len(own) - 1):
            for i in at[own[k], own[k + 1]]:
                met[i - k].add(k)
        best = max((len(set().union(*(met.get(d + j, set()) for j in range(license_scan.DRIFT + 1)))) for d in list(met)), default=0)
        coverage = best / (len(own) - 1)
        if number < len(license_scan.BASE) and plain_scan(text)[1] and label in plain_scan(text)[4].split(","):
            coverage = 1.0
        if coverage >= license_scan.COVERAGE:
            labels.add(label)
            score = max(score, coverage)
    return ",".join(sorted(labels)), score


def test_license_labels_against_plain(spark):
    rng = random.Random(8)
    words = sorted({w for t in [*license_scan.BASE, *license_scan.TEMPLATES] for w in t.split()}) + ["x", "y"]
    templates = list(license_scan.TEMPLATES)
    texts = ["cc by cc by", "cc by cc by cc by cc by nc", "cc by x nc", "cc x by nc", "by nc cc by"]
    for _ in range(150):
        own = rng.choice(templates).split()
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(own))
            own[i : i + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
            own = own or ["x"]
        texts.append(" ".join(rng.choices(words, k=rng.randint(0, 8)) + own * rng.randint(1, 2) + rng.choices(words, k=5)))
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in license_scan.scan(documents(spark, rows)).collect()}
    want = {i: plain_labels(t) for i, t, _ in rows}
    assert got == {i: (a, round(b, 9)) for i, (a, b) in want.items()}
    assert got[0] == ("cc-by", 1.0) and got[1] == ("cc-by,cc-by-nc", 1.0)


def test_license_scan(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    rows = awkward() + [
        (900, "All rights\nreserved. CC-BY 4.0 cc by, cc by cc cc by", "a"), (901, "x " + mit + " y", "a"), (902, mit.replace("any person", "any kind person"), "a"),
        (903, "GNU General Public License general public", "a"), (904, "permission is granted", "a"), (905, "cc by " * 20_000, "a"), (906, "all rights rights reserved", "a"), (907, "ALL RİGHTS reserved Kcc by", "a"),
    ]
    got = license_scan.scan(documents(spark, rows)).collect()
    want = Counter((i, *plain_scan(t)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[901]["labels"] == "mit" and by_id[901]["score"] == 1.0
    assert by_id[902]["labels"] == "mit" and 0.8 <= by_id[902]["score"] < 1
    assert by_id[904]["labels"] == "" and by_id[904]["score"] == 0.0
    assert by_id[905]["n_base"] == 20_000
    assert license_scan.scan(documents(spark, [])).collect() == []


# ---- quality ----


def test_quality_held_out(spark):
    got = quality.classify(table(spark, SF_DIR.replace("0.001", "0.01"), "documents"), table(spark, SF_DIR.replace("0.001", "0.01"), "labels"))
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR.replace("0.001", "0.01"), "labels").collect()}
    rows = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in got.collect() if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, _, y in rows if y], [s for s, _, y in rows if not y]
    assert np.mean([(s > b) + 0.5 * (s == b) for s in good for b in bad]) > 0.95
    assert np.mean([p == y for _, p, y in rows]) > 0.93


def test_quality_awkward(spark):
    rows = awkward()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0, "z") for i in range(50)] + [(None, 1, 0, "z"), (3, 0, 0, "z"), (4, None, 0, "z")], "doc_id bigint, quality int, toxic int, x string")
    got = quality.classify(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sorted(got, key=str) == sorted(quality.classify(docs, labels).collect(), key=str)
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {1.0}
    assert quality.classify(documents(spark, []), labels).collect() == []
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_quality_from_positives_alone(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    model = quality.learn(docs, labels.filter("quality = 1"))
    assert 0.5 < model.prior < 0.99
    for option in ({}, {"calibrated": False}):
        model = quality.learn(docs, labels.filter("quality = 1") if not option else labels, **option)
        rows = [(model.score(np.array([quality.features(r["text"])]))[0], truth[r["doc_id"]]) for r in docs.collect() if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
        good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
        assert np.mean([(s > b) + 0.5 * (s == b) for s in good for b in bad]) > 0.9
        assert np.median(good) > np.median(bad)


def test_risk_and_its_slopes():
    rng = np.random.default_rng(4)
    for prior, shift in ((0.3, 0.0), (0.9, -3.0)):
        z_p, z_u = rng.normal(1, 1, 30), rng.normal(shift, 1, 50)
        value, slope_p, slope_u = quality.risk(z_p, z_u, prior)
        s = lambda z: 1 / (1 + np.exp(-z))
        negative = s(z_u).mean() - prior * s(z_p).mean()
        assert value == pytest.approx(prior * s(-z_p).mean() + max(0, negative))
        # Below zero the slope of the negative part is turned round.
        parts = (lambda p, u: prior * s(-p).mean() + s(u).mean() - prior * s(p).mean()) if negative >= 0 else (lambda p, u: prior * s(p).mean() - s(u).mean())
        for z, slope, f in ((z_p, slope_p, lambda z: parts(z, z_u)), (z_u, slope_u, lambda z: parts(z_p, z))):
            for i in (0, 7):
                step = np.zeros(len(z))
                step[i] = 1e-6
                assert slope[i] == pytest.approx((f(z + step) - f(z - step)) / 2e-6, abs=1e-7)
    assert negative < 0


# ---- language ----


def test_rare_languages_are_learnt(spark, monkeypatch):
    rng = random.Random(2)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, text("abcd"), "a", "common") for i in range(400)] + [(1000 + i, text("wxyz"), "a", "rare") for i in range(4)]
    rows += [(5000 + i, text("abcd"), "a", None) for i in range(300)]
    docs = documents(spark, rows)
    profiles = langid.learn_profiles(docs, lang_rows=20)
    assert set(profiles) == {"common", "rare"}
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, lang_rows=20).collect()}
    assert all(got[1000 + i] == "rare" for i in range(4)) and got[5000] == "common"
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 1)
    assert set(langid.learn_profiles(docs, lang_rows=20)) == {"common", "rare"}


def test_language_held_out(spark):
    docs = table(spark, SF_DIR.replace("0.001", "0.01"), "documents")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = [(r["lang_pred"], langs[r["doc_id"]]) for r in langid.identify(docs).collect() if r["held_out"] and langs[r["doc_id"]]]
    assert np.mean([a == b for a, b in rows]) > 0.95


def test_language_is_rank_order(spark):
    rows = [(i, t, "a", lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("und der und", None), (None, "en"), ("12 .. !", "de"), ("", None)] * 9)]
    docs = documents(spark, rows + [(None, "the the", "a", "en"), rows[0]])
    profiles = langid.learn_profiles(docs)
    model = langid.Profiles(profiles, langid.TOP)
    for r in langid.identify(docs).collect():
        text = next(t for i, t, *_ in rows + [(None, "the the")] if i == r["doc_id"])
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und"
            continue
        own = langid.ranked(text)
        cost = {}
        for lang in sorted(profiles):
            rank = {g: k for k, g in enumerate(profiles[lang])}
            cost[lang] = sum(abs(rank[g] - k) if g in rank else langid.TOP for k, g in enumerate(own.tolist()))
        assert r["lang_pred"] == min(cost, key=lambda x: (cost[x], x)) == model.predict(text)[0]
    assert langid.identify(documents(spark, [])).collect() == []
    assert {r["lang_pred"] for r in langid.identify(documents(spark, [(1, "abc", "a", None)])).collect()} == {"und"}


def test_gram_counts():
    codes, counts = langid.gram_counts("Ab a-b ß")
    name = {}
    for word in (" ab ", " ab ", " ß "):
        for n in (1, 2, 3):
            for i in range(len(word) - n + 1):
                g = word[i : i + n]
                if g.strip() and (n > 1 or g != " "):
                    name[g] = name.get(g, 0) + 1
    packed = {sum(ord(c) << 21 * (2 - k) for k, c in enumerate(g)): n for g, n in name.items()}
    assert dict(zip(codes.tolist(), counts.tolist())) == packed


# ---- personal data formats ----


def test_formats_the_patterns_miss(spark):
    """With the tagger as trained on the benchmark table."""
    tagger = pii.train(table(spark, SF_DIR.replace("0.001", "0.1"), "documents"))
    rng = random.Random(6)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kinds = {
        "(ddd) ddd-dddd": lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
        "ddd-ddd-dddd": lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
        "ddd.ddd.dddd": lambda: f"{digits(3)}.{digits(3)}.{digits(4)}",
        "1.ddd.ddd.dddd": lambda: f"1.{digits(3)}.{digits(3)}.{digits(4)}",
    }
    recall = {}
    for kind, value in kinds.items():
        texts, at = [], []
        for _ in range(100):
            v = value()
            texts.append(f"please call {v} before noon")
            at.append((3, 12, 12 + len(v)))
        found = [more for _, more in pii.find_spans(texts, tagger)]
        recall[kind] = np.mean([a in m for a, m in zip(at, found)])
    print(recall)
    assert min(recall.values()) >= 0.8, recall
    alike = ["released in version 12.3.4 today", "it was 2024-05-17 then", "at 12:30:45 sharp", "about 1,234,567 people", "pi is 3.14159 or so"]
    assert [more for _, more in pii.find_spans(alike, tagger)] == [[]] * len(alike)


# ---- pipeline ----


def test_pipeline_stages(spark):
    sf_dir = SF_DIR
    docs = table(spark, sf_dir, "documents").cache()
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, table(spark, sf_dir, "labels")).collect()}
    good = stages["quality classifier"](spark, docs, sf_dir)
    assert good.columns == names
    rows = {r["doc_id"]: r for r in good.collect()}
    assert set(rows) == {i for i, p in scores.items() if p}
    unique = stages["exact dedup"](spark, good, sf_dir)
    first = {}
    for i in sorted(rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]["text"]), i)
    assert unique.columns == names and {r["doc_id"] for r in unique.collect()} == set(first.values())
    apart = stages["near-dedup"](spark, unique, sf_dir).cache()
    assert apart.columns == names
    left = {r["doc_id"] for r in apart.collect()}
    # One document of each group that five-word shingles in common, 4/5 of all or more, link.
    shingles = {}
    for i in first.values():
        words = "".join(c.lower() if c.isascii() else c for c in rows[i]["text"]).encode().split()
        shingles[i] = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in shingles}
    for i, x in shingles.items():
        for j, y in shingles.items():
            if i < j and (x == y or 5 * len(x & y) >= 4 * len(x | y)):
                one, other = sorted((group[i], group[j]))
                group = {k: one if g == other else g for k, g in group.items()}
    assert left == set(group.values()) and len(left) < len(shingles)
    mixed = stages["mixing sources"](spark, apart, sf_dir).cache()
    assert mixed.columns == names and {r["doc_id"] for r in mixed.select("doc_id").collect()} <= left
    assert mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3
    packed = stages["packing"](spark, mixed, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in mixed.collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def test_pipeline_of_nothing(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, SF_DIR, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    assert collected(corpus_pipeline.run(spark, str(tmp_path))) == []
