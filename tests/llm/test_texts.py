"""Token counts, BPE, secrets, licenses, toxicity, near-duplicates and decontamination against plain code."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontamination, licenses, near_dedup, secrets, sp_model, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, score double, ids string, label int, node long"
#: Null, empty, white space, junk, emoji, marks, long runs.
ODD = [None, "", " ", "\n\n", "   two  spaces ", "a", "Ünïcödé ñandú 漢字かな 🎉👩‍👩‍👧 é", "\x00\x07tab\tline\r\nend", "x" * 3000, "= " * 500, "▁▁ under ▁", "don't I'll 123 4567!!! ---"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0.0, "x", 1, 2) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r.text for r in rows]


def test_token_counts_are_the_tokenizers(spark, corpus):
    import sentencepiece

    pieces = token_counts.unigram_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    model = sp_model.model_file(pieces, sp_model.UNIGRAM, dummy_prefix=True, escape=True, byte_fallback=True)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ODD + corpus
    got = {r.doc_id: r for r in token_counts.count_tokens(docs(spark, texts), pieces).collect()}
    for i, t in enumerate(texts):
        if "\x00" not in (t or ""):
            assert got[i].n_tokens == (len(sp.encode(t)) if t else 0), (i, (t or "")[:50])
        assert got[i].n_chars == len(t or "")


def test_token_counts_break_ties_as_the_tokenizer_does():
    import sentencepiece

    draw = random.Random(3)
    for trial in range(60):
        # Few scores, so that many ways tie; scores off the grain, so that the whole text is walked.
        words = {"".join(draw.choice("abc▁") for _ in range(draw.randint(1, 4))) for _ in range(12)} | {"a", "b"}
        scores = [-1.0, -2.0, -3.0] if trial % 2 else [-1.1, -2.2, -3.3, -0.7]
        pieces = [sp_model.Piece("<unk>", 0.0, sp_model.UNKNOWN), *[sp_model.Piece(w, draw.choice(scores)) for w in sorted(words)]]
        sp = sentencepiece.SentencePieceProcessor(model_proto=sp_model.model_file(pieces, sp_model.UNIGRAM, dummy_prefix=True, escape=True, byte_fallback=False))
        counter = token_counts.Counter(pieces)
        for _ in range(30):
            t = "".join(draw.choice("abcd ") for _ in range(draw.randint(1, 40)))
            assert counter.count(t)[0] == len(sp.encode(t)), (pieces, t)


def test_token_counts_break_ties_on_the_grain():
    import sentencepiece

    draw = random.Random(4)
    for _ in range(60):
        words = {draw.choice(["▁", ""]) + "".join(draw.choice("abc") for _ in range(draw.randint(1, 4))) for _ in range(12)} | {"a"}
        pieces = [sp_model.Piece("<unk>", 0.0, sp_model.UNKNOWN), *[sp_model.Piece(f"<0x{b:02X}>", 0.0, sp_model.BYTE) for b in range(256)]]
        pieces += [sp_model.Piece(w, draw.choice([-1.0, -2.0, -2.5, -3.0])) for w in sorted(words)]
        sp = sentencepiece.SentencePieceProcessor(model_proto=sp_model.model_file(pieces, sp_model.UNIGRAM, dummy_prefix=True, escape=True, byte_fallback=True))
        counter = token_counts.Counter(pieces)
        assert counter.cuts
        for _ in range(30):
            t = "".join(draw.choice("abcdé漢 ") for _ in range(draw.randint(1, 40)))
            assert counter.count(t) == (len(sp.encode(t)), counter._best("▁" + t.replace(" ", "▁"))[0]), (pieces, t)


def test_bpe_ids_and_round_trip(spark, corpus):
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = ODD + corpus
    got = {r.doc_id: r for r in byte_bpe.digests(docs(spark, texts), path, pattern).collect()}
    full = {r.doc_id: r.ids for r in byte_bpe.encode(docs(spark, texts), path, pattern).collect()}
    for i, t in enumerate(texts):
        ids = reference.encode_ordinary(t or "")
        assert full[i] == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = {r.doc_id: r.text for r in byte_bpe.decode(byte_bpe.encode(docs(spark, ODD), path, pattern), path, pattern).collect()}
    assert [back[i] for i in range(len(ODD))] == [t or "" for t in ODD]


def test_secret_patterns_and_models(spark, corpus):
    draw = random.Random(5)
    key = lambda n: "".join(draw.choice("ABCDEFGHJKMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n))
    texts = [
        f"password: abcdef SECRET='{key(30)}' token=x api_key=short5 Api_Key = \"{key(9)}\"", f"AKIA{key(16).upper()} AKIAABC aAKIA{'Z' * 20}", "0123456789abcdef01234567 deadbeef " + "f" * 24,
        f"é漢 token={'ab' * 20}", f"header ghp_{key(36)} and {key(44)} end", "_".join(re.findall("[a-z]{3,}", corpus[0])[:9]), *ODD,
    ] + corpus
    df = docs(spark, texts)
    model = secrets.train(df)
    assert secrets.finite(model)
    got = {r.doc_id: r for r in secrets.scan(df, model).collect()}
    assign = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, t in enumerate(texts):
        t = t or ""
        spans = [(m.start(), "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        spans.sort(key=lambda s: (s[0], secrets.KINDS.index(s[1])))
        said = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (i, t[:80])
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s[1] == k for s in spans) for k in secrets.KINDS[:3]]
        assert set(said.split(",")) - {""} <= set(got[i].spans.split(","))
    assert got[4].n_random == 2 and got[5].n_random == 0
    clean = {r.doc_id: r.text for r in secrets.redact(df, model).collect()}
    assert "ghp_" not in clean[4] and clean[4].startswith("header [REDACTED] and") and clean[6] is None
    assert all(clean[i] == t for i, t in enumerate(texts) if not got[i].spans)


def test_secret_spans_in_long_texts_and_parts_of_runs():
    draw = random.Random(9)
    key = lambda n: "".join(draw.choice("ABCDEFGHJKMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n))
    ratio = np.full((63, 63), 2.0)
    ratio[:, 0] = 0
    model = secrets.Markov(ratio)
    for _ in range(300):
        pieces = [draw.choice([key(draw.randint(1, 30)), "AKIA" + "A" * draw.randint(10, 30), "ab12" * draw.randint(3, 9), f"token={key(draw.randint(3, 20))}", "-", "_", "/"]) for _ in range(draw.randint(1, 12))]
        text = "".join(p + draw.choice(["", "", " "]) for p in pieces)
        base, want, taken = secrets.base_spans(text), [], set()
        for a, b, _ in base:
            taken |= set(range(a, b))
        for m in re.finditer("[A-Za-z0-9+/_=-]+", "".join(" " if i in taken else c for i, c in enumerate(text))):
            inner = [r for r in re.finditer("[A-Za-z0-9+/_=-]{12,}", text) if r.start() <= m.start() and m.end() <= r.end()]
            if len(m[0]) >= 12 and inner and 2.0 * sum(c.isalnum() for c in m[0]) >= 14:
                want.append((m.start(), m.end(), "random"))
        assert [s for s in secrets.find_spans(text, model) if s[2] == "random"] == want, text
        assert [s for s in secrets.find_spans(text, model) if s[2] != "random"] == base
    began = time.time()
    assert len(secrets.find_spans("\n".join(hashlib.md5(bytes([i % 256])).hexdigest() for i in range(50_000)), model)) == 50_000
    assert time.time() - began < 5


def test_secret_models_tell_keys_from_words(spark, corpus):
    draw = random.Random(10)
    model = secrets.train(docs(spark, corpus))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(draw.choice(letters) for _ in range(draw.randint(16, 40))) for _ in range(2000)]
    words = sorted({w for t in corpus for w in re.findall("[A-Za-z]{4,12}", t or "")})
    names = [draw.choice(["_", "-", ""]).join(draw.choice(words) for _ in range(3)) for _ in range(2000)]
    names = [n for n in names if len(n) >= 12]
    assert (model.scores(keys) >= model.least_ratio).mean() >= 0.95
    assert (model.scores(names) >= model.least_ratio).mean() <= 0.02
    extra = spark.createDataFrame([(1, f"key {keys[0]} end", 1), (1, f"key {keys[0]} end", 2), (None, None, 3)], "doc_id long, text string, spans int")
    got = secrets.scan(extra, model).collect()
    assert len(got) == 3 and got[0] == got[1] and got[2].spans == ""


def test_secret_models_without_samples(spark):
    empty = docs(spark, [])
    model = secrets.train(empty)
    assert secrets.finite(model) and secrets.scan(empty, model).collect() == []


def test_licenses_as_brute_force_finds_them(spark, corpus):
    filler = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam "
    texts = [filler * k + t + " " + filler * 3 for k, t in enumerate(licenses.TEMPLATES.values())] + [None, "", "MIT", "Released under the Foo License"] + corpus
    got = {r.doc_id: r for r in licenses.scan(docs(spark, texts)).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in got[i].licenses.split(","), name
    for i, t in enumerate(texts):
        assert set(got[i].licenses.split(",")) - {""} == _licensed(t, licenses.TEMPLATES), i


def _licensed(text, templates, least=0.8):
    """Templates of which some stretch of twice their words, wherever it begins, has enough shingles."""
    words, found = licenses.words_of(text), set()
    sh = [tuple(words[a : a + 3]) for a in range(len(words) - 2)]
    for name, t in templates.items():
        w = licenses.words_of(t)
        mine = {tuple(w[a : a + 3]) for a in range(len(w) - 2)}
        if any(len(mine & set(sh[a : a + 2 * len(w)])) >= least * len(mine) for a in range(len(sh))):
            found.add(name)
    return found


def test_licenses_edited_and_stretched_at_any_offset(spark):
    draw = random.Random(6)
    own = lambda p, n: [f"{p}{draw.randrange(10 * n)}" for _ in range(n)]
    table = spark.createDataFrame([(f"t{n}", " ".join(own(f"a{n}x", n)), 1) for n in (8, 24, 42, 400, 2500)] + [(None, "x", 2), ("none", None, 3)], "name string, text string, n int")
    templates = licenses.templates_of(table)
    assert sorted(templates) == ["t24", "t2500", "t400", "t42", "t8"]
    texts = []
    for name, t in templates.items():
        w = t.split()
        for k in range(42 if len(w) < 100 else 6):
            copy = list(w)
            for _ in range(draw.randint(0, max(1, len(w) // 14))):  # edits; about half are too many
                copy[draw.randrange(len(copy))] = "edited"
            at = draw.randrange(len(copy))
            copy[at:at] = own("b", draw.randint(0, len(w)))  # a stretch in its middle
            texts.append(" ".join(own("c", k * (1 if len(w) < 100 else len(w) // 5)) + copy + own("d", draw.randrange(60))))
    got = {r.doc_id: r for r in licenses.scan(docs(spark, texts), templates).collect()}
    want = [_licensed(t, templates) for t in texts]
    assert [set(got[i].licenses.split(",")) - {""} for i in range(len(texts))] == want
    assert 30 < sum(map(bool, want)) < len(want) - 10
    with pytest.raises(ValueError):
        licenses.templates_of(spark.createDataFrame([("big", "x " * (9 << 20))], "name string, text string"))


def test_licenses_anywhere_in_long_texts():
    matcher = licenses.Matcher(licenses.TEMPLATES)
    filler = [f"w{i}" for i in range(3 * licenses.BLOCK)]
    for name, text in licenses.TEMPLATES.items():
        for at in (0, 17, licenses.BLOCK - 40, licenses.BLOCK - 5, licenses.BLOCK, licenses.BLOCK + 3, len(filler)):
            found = {m[0]: m for m in matcher.matches(" ".join([*filler[:at], text, *filler[at:]]))}
            assert found[name][3] == 1.0 and found[name][1] <= at < found[name][2], (name, at)


def test_licenses_of_one_family_are_told_apart(spark):
    notice = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    texts = {
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 4": "",
        notice.format("General Public License", 2): "GPL-2.0-notice",
        notice.format("General Public License", 3): "GPL-3.0-notice",
        notice.format("Lesser General Public License", 2.1).replace("program", "library"): "LGPL-2.1-notice",
        notice.format("Lesser General Public License", 3): "LGPL-3.0-notice",
        notice.format("Affero General Public License", 3): "AGPL-3.0-notice",
        "This work is licensed under the GNU Affero General Public License, version 3": "AGPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3. See the GNU General Public License for more": "LGPL-3.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "CC-BY-NC-4.0-notice",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0-notice",
        "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
        "Released under the ISC License": "ISC",
        licenses.FAMILIES["Unlicense"]: "Unlicense",
        licenses.FAMILIES["CC0-1.0-notice"]: "CC0-1.0-notice",
        "This work is licensed under the GNU General Public License, version 3. This work is licensed under the GNU General Public License, version 2": "GPL-2.0,GPL-3.0",
    }
    got = {r.doc_id: r for r in licenses.scan(docs(spark, [f"lorem ipsum dolor {t} sit amet " * 2 for t in texts])).collect()}
    for i, (t, want) in enumerate(texts.items()):
        assert got[i].licenses == want and got[i].n_licenses == len(want.split(",")) * bool(want), t
    matcher = licenses.Matcher(licenses.KNOWN)
    for name, t in licenses.KNOWN.items():
        assert [m[0] for m in matcher.matches(t)] == ([name] if name != "Apache-2.0-notice" else ["Apache-2.0", name]), name


def test_toxicity_learns_from_other_folds(spark):
    import zlib

    draw = random.Random(1)
    plain = ["".join(draw.choice(["ka", "lo", "mi", "ne", "ru"]) for _ in range(3)) for _ in range(300)]
    bad = ["vexor", "grumple", "snarfle"]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        s = [[draw.choice(plain) for _ in range(8)] for _ in range(draw.randint(1, 12))]
        if toxic:
            for _ in range(2):
                draw.choice(s).append(draw.choice(bad) + draw.choice(["", "ing", "s"]))
        rows.append((i, ". ".join(" ".join(x) for x in s)))
        labels.append((i, 1, int(toxic)))
    df = spark.createDataFrame(rows + [(5000, None), (5001, ""), (5002, "...!")], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, lab)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [r for r in labels if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert toxicity.accuracy([got[i].predicted for i, _, _ in held], [t for _, _, t in held]) >= 0.97
    assert [got[i].score for i in (5000, 5001, 5002)] == [0.0] * 3
    where = toxicity.locate(df.where("doc_id = 0"), model).collect()
    assert where and all(any(b in rows[0][1][w.start : w.end] for b in bad) for w in where)
    place = lambda w: 0.0 + sum(model.weights.get(f, 0.0) for f in toxicity.features(w))
    for i, text in rows[:300] + [(5000, None)]:  # the noisy-or of sentences, plainly
        spans, clean, bad_ones = [(m.start(), m.end()) for m in re.finditer(r"[^.!?\n]+", text or "") if re.search(r"[^\W_]", m[0])], 1.0, []
        for a, b in spans:
            p = 1 / (1 + math.exp(-model.bias - sum(map(place, set(re.findall(r"[^\W_]+", text[a:b].lower()))))))
            clean *= 1 - p
            bad_ones += [f"{a}:{b}"] * (p >= 0.5)
        assert got[i].score == pytest.approx(1 - clean, abs=1e-9) and got[i].offending == ",".join(bad_ones) and got[i].n_offending == len(bad_ones)
        assert got[i].predicted == int(got[i].score >= 0.5)
    few = toxicity.train(df, lab.where("doc_id < 60"))
    assert any(few.weights.values())  # a small sample still learns
    twice = toxicity.score(df.where("doc_id = 0").union(df.where("doc_id = 0")), model).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    flat = toxicity.train(df, lab.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(df, flat).collect()} == {0}


def _sets(texts, k):
    out = []
    for t in texts:
        w = [x for x in re.split("[ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        out.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def _components(texts, k, percent=80):
    sets, label = _sets(texts, k), list(range(len(texts)))
    changed = True
    links = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != label[b]
            label[a] = label[b] = m
    return label, sets


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_are_exact(spark, k):
    draw = random.Random(k)
    words = [f"w{i}" for i in range(500)]
    texts = [*ODD, "one", "ONE", "one ", "one two", "One Two"]
    for _ in range(12):
        base = [draw.choice(words) for _ in range(draw.randint(4, 200))]
        for _ in range(9):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 18))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs(spark, texts), k=k).collect()}
    label, sets = _components(texts, k)
    for i in range(len(texts)):
        assert (got[i].component_id, got[i].n_shingles, got[i].kept) == (label[i], len(sets[i]), label[i] == i), texts[i]


@pytest.mark.parametrize("shape", ["copies of one", "chain", "three groups", "strangers"])
def test_near_duplicates_over_several_blocks(spark, monkeypatch, shape):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(near_dedup, "PIVOTS", 3)
    draw = random.Random(8)
    texts = []
    if shape == "chain":  # each is linked with its neighbours alone
        words = [f"w{i}" for i in range(900)]
        texts = [" ".join(words[6 * i : 6 * i + 70]) for i in range(100)]
        draw.shuffle(texts)
    else:
        bases = [[f"{'abc'[g] if shape == 'three groups' else 'w'}{draw.randrange(900)}" for _ in range(120)] for g in range(3)]
        for i in range(90):
            copy = list(bases[i % 3 if shape == "three groups" else 0])
            for _ in range(draw.randint(1, 7) if shape != "strangers" else 9):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(900)}"
            texts.append(" ".join(copy))
        if shape == "three groups":  # so much of each other that buckets are shared
            texts = [t + " " + " ".join(f"s{j}" for j in range(150)) for t in texts]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs(spark, texts), k=2).collect()}
    label, _ = _components(texts, 2)
    assert [got[i] for i in range(len(texts))] == label


def test_near_duplicates_of_nothing_and_of_odd_ids(spark):
    assert near_dedup.near_duplicates(docs(spark, [])).collect() == []
    same, other = "a b c d e f", "g h i j k l m n"
    said = lambda rows: sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert said([(None, same), (4, same), (4, same)]) == [(0, 0, True), (4, 4, True), (4, 4, True)]
    # One id with two texts: each row has the component of its own text.
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(7, near), (7, other), (3, near + " end"), (9, other), (5, "g h i j k l m n x x x x")]
    assert said(rows) == [(3, 3, True), (5, 5, True), (7, 3, False), (7, 7, True), (9, 7, False)]
    assert len(said([(1, near)] * 400 + [(2, near + " end")] * 3)) == 403


def test_sketches_estimate_and_merge():
    draw = np.random.default_rng(0)
    sketch = near_dedup.SetSketch(288)
    pool = draw.integers(0, 1 << 63, 3000, np.uint64)
    a, b = pool[:2000], pool[500:3000]
    ra, rb = sketch.registers(a), sketch.registers(b)
    assert abs(float(sketch.jaccard(ra, 2000, rb[None], np.array([2500]))[0]) - 0.5) < 0.1
    assert (sketch.merge(ra, rb) == sketch.registers(pool)).all()


def _leaks(text, items, width=10):
    words, hit, found = decontamination.words_of(text), set(), set()
    for item, t in items:
        w = decontamination.words_of(t)
        for a in range(max(0, len(w) - width) + 1 if w else 0):
            g = w[a : a + width]
            for p in range(len(words) - len(g) + 1):
                if words[p : p + len(g)] == g:
                    hit |= set(range(p, p + len(g)))
                    found.add(str(item))
    return len(words), len(hit), found


def _near(text, items, width, slack):
    """Items of which a passage has all its words within width + slack words of the text."""
    words, found = decontamination.words_of(text), set()
    for item, t in items:
        w = decontamination.words_of(t)
        n = min(width, len(w))
        for a in {*range(0, len(w) - n + 1, width), len(w) - n} if w else ():
            need = Counter(w[a : a + n])
            if any(not need - Counter(words[p : p + n + slack]) for p in range(len(words))):
                found.add(str(item))
    return found


def _said(r):
    return r.n_words, r.n_hit, r.n_items, r.contaminated, r.items_sha256, r.n_near


def _wanted(text, items):
    n, hit, found = _leaks(text, items)
    return n, hit, len(found), hit > 0, decontamination.digest(sorted(found)), len(_near(text, items, 10, 2))


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_contamination_as_brute_force_finds_it(spark, monkeypatch, block):
    draw = random.Random(2)
    vocab = [f"t{i}" for i in range(12)] + ["Ünder", "漢字"]
    items = [(i, " ".join(draw.choice(vocab) for _ in range(n))) for i, n in enumerate([25, 10, 4, 1, 14, 30])] + [(10, None), (11, "..."), (13, "t1 " * 12)]
    items += [items[0], (12, items[4][1])]
    texts = [*ODD, *(t for _, t in items if t), "t1 " * 40]
    for _ in range(60):
        body = [draw.choice(vocab) for _ in range(draw.randint(5, 80))]
        if draw.random() < 0.7:
            w = draw.choice(items[:6])[1].split()[draw.randrange(20) :]
            if draw.random() < 0.5:
                w.insert(draw.randrange(len(w) + 1), "between")
            body[draw.randrange(len(body)) : 0] = w
        texts.append(draw.choice([" ", ", ", "\n"]).join(body).upper() if draw.random() < 0.3 else " ".join(body))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for name, value in (("SEGMENT_WORDS", 400), ("BLOCK_BYTES", block), ("_WINDOWS", 7), ("_PAIRS", 50)):
        monkeypatch.setattr(decontamination, name, value)
    got = {r.doc_id: r for r in decontamination.contamination(docs(spark, texts), bench).collect()}
    for i, t in enumerate(texts):
        assert _said(got[i]) == _wanted(t, items), (i, t)


def test_contamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.contamination(docs(spark, ["a b c", None]), none).collect()
    assert sorted((r.n_words, r.n_hit, r.contaminated) for r in got) == [(0, 0, False), (3, 0, False)]
    assert decontamination.contamination(docs(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_contamination_gives_each_row_its_own(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    items = [(1, "a b c"), (2, "d e f"), (3, "g h i")]
    rows = [(None, "x a b c"), (None, "d e f"), (None, None), (7, "a b c d e f"), (7, "a b c d e f"), (7, "no such words here"), (8, "g h i")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert len(list(decontamination.item_blocks(bench))) == (1 if block > 8 else 2)
    assert sorted((r.doc_id or 0, *_said(r)) for r in got) == sorted((i or 0, *_wanted(t, items)) for i, t in rows)


def test_one_index_serves_several_test_sets(spark):
    index = decontamination.written(decontamination.build_index(docs(spark, ["gamma x alpha y beta", "alpha " + "x " * 30 + "beta gamma", "alpha beta gamma"])))
    found = lambda text, slack: {r.row: (r.hits, r.near) for r in decontamination.search(index, [("1", text)], 10, slack).collect()}
    place = {r.doc: r.row for r in index.selectExpr("explode(arrays_zip(rows, doc_ids)) r").selectExpr("r.rows row", "r.doc_ids doc").collect()}
    assert found("alpha beta gamma", 2) == {place[0]: ([], ["1"]), place[2]: ([0, 1, 2], ["1"])}
    assert found("alpha beta gamma", 1) == {place[2]: ([0, 1, 2], ["1"])}
    assert found("beta gamma", None) == {place[1]: ([31, 32], []), place[2]: ([1, 2], [])}
    assert found("unheard of", 3) == {}


def test_the_toxicity_model_is_the_same_for_any_partitions(spark):
    rows = [(i, f"word{i % 7} {'foul vile' if i % 3 == 0 else 'fair kind'} end. next {i % 5}") for i in range(300)]
    rows += [(i, t[::-1]) for i, t in rows] + rows[:50]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    models = [toxicity.train(df.orderBy(F.col("text").desc() if n == 3 else "text").repartition(n), labels, per_class=60) for n in (1, 3, 11)]
    assert models[0] == models[1] == models[2] and models[0].weights
