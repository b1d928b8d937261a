"""Spelling variants and mixing against plain code."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import mixing, variants

DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, n string, at string, line string"
UPPER = {c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "w", "n", "a", "l") for i, t, s in rows], DOCS)


# ---- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    total = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(UPPER.get(c, c) for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def plain_groups(n):
    form, count = {}, {}
    for w in n:
        near = [o for o in n if one_edit(w, o)]
        best = min(near, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
        count[w] = len(near)
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], count[w], n[form[w]] if form[w] else None))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    base = ["Wörterbuch", "language", "Language", "aaaaaaa", "aaaaaaaa", "abcdefghijkl", "straße" * 3, "z" * 3000]
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < 0.2:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice("xyé") + w[p:], w[:p] + rng.choice("xyÉ") + w[p + 1 :]])
            words.append(w)
        rows.append((i, rng.choice([" ", "×", "-", "1"]).join(words), "s"))
    return rows + [(None, "Nullwort Nullwort nullwor", "s"), (5, None, None), (6, "", "s"), (7, "language " * 400, "s"), (7, "language " * 400, "s")]


def grouped(spark, rows):
    return sorted(tuple(r) for r in variants.grouped(variants.count_words(docs(spark, rows).repartition(5))).collect())


def test_variants_are_those_of_plain_code(spark):
    rows = texts(1)
    want = plain_groups(plain_words(rows))
    assert sum(w[1] is not None for w in want) > 20
    assert grouped(spark, rows) == want


def test_many_words_of_one_key_and_chains(spark, monkeypatch):
    monkeypatch.setattr(variants, "TILE", 16)
    rng = random.Random(2)
    n = {"samebeginning" + "".join(rng.choice("ab") for _ in range(rng.randrange(6, 9))): rng.choice([2, 25, 300, 4000]) for _ in range(500)}
    n |= {"chained": 20000, "chainex": 1500, "chainyx": 100, "chazyx": 2, "chaizyx": 5, "chaizyxx": 2}
    got = variants.grouped(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert sorted(tuple(r) for r in got) == plain_groups(n)


def test_no_words(spark):
    assert grouped(spark, []) == [] and grouped(spark, [(1, None, "s"), (2, "short words only", None)]) == []


@given(st.lists(st.text("abé", min_size=7, max_size=10), min_size=1, max_size=12, unique=True), st.lists(st.text("abé", min_size=7, max_size=10), min_size=1, max_size=12, unique=True))
def test_tiles_find_single_edits(a, b):
    assert sorted(variants.single_edits(a, b)) == [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if one_edit(x, y)]


# ---- mixing


def plain_targets(sizes, weights):
    """As the contract says it: shares by weight, then excess shared anew until none is above."""
    t = [Fraction(3, 2) * sum(sizes) * w / sum(weights) for w in weights]
    while any(x > 2 * s for x, s in zip(t, sizes)):
        excess = sum(max(x - 2 * s, 0) for x, s in zip(t, sizes))
        t = [min(x, 2 * s) for x, s in zip(t, sizes)]
        free = [i for i, (x, s) in enumerate(zip(t, sizes)) if x < 2 * s]
        for i in free:
            t[i] += excess * weights[i] / sum(weights[j] for j in free)
    return t


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    assert mixing.targets(sizes, weights) == plain_targets(sizes, weights)


@given(st.lists(st.integers(0, 300), min_size=0, max_size=9), st.integers(1, 9))
def test_split_keeps_quotas(quotas, shards):
    got = mixing.split(quotas, shards)
    assert [sum(c) for c in zip(*got)] == (quotas if quotas else []) and len(got) == shards
    assert max(map(sum, got)) - min(map(sum, got)) <= 1 and min(map(min, got), default=0) >= 0 if quotas else True


@given(st.integers(1, 3000), st.integers(0, 99))
def test_permutations(n, seed):
    p = mixing.Permutation(n, seed)
    assert sorted(map(p, range(n))) == list(range(n))


@given(st.integers(1, 4000), st.integers(1, 50), st.fractions(0, 2))
def test_a_source_gives_its_target(size, block, share):
    source = mixing.Source(3, size, share * size, block)
    source.ends = []
    seen, draws = Counter(), set()
    for at in range(0, size, 37):
        here = min(37, size - at)
        for _, first, end, _, draw in source.pieces(at, here):
            assert 0 <= first < end <= here and 0 <= draw < source.quota
            seen.update(range(at + first, at + end))
            draws.add(draw)
    assert sum(seen.values()) == round(share * size) and max(seen.values(), default=0) <= 2 and draws == set(range(source.quota))


ROWS = [(i, None if i % 40 == 3 else "wort\t" * (i * 7 % 90), f"src{i % 5}") for i in range(600)]
ROWS += [(1000, "long " * 30_000, "src1"), (1001, "a b", None), (None, "c d e", None), (1002, None, "empty"), (3, "twice", "src3"), (3, "twice", "src3"), (1003, "  x\x0b", "\U0001f600")]


@pytest.fixture(scope="module")
def mixed(spark):
    return mixing.mix(docs(spark, ROWS), block_words=256).persist()


def test_mix_meets_targets_and_caps(spark, mixed):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by, names = defaultdict(int), sorted({s for *_, s in ROWS}, key=lambda s: (s is None, s or ""))
    for _, t, s in ROWS:
        by[s] += size(t)
    of = dict(zip(names, plain_targets([by[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])))
    rows = mixed.collect()
    want = sorted((str(i), size(t), by[s], float(of[s])) for i, t, s in ROWS)
    assert sorted((str(r.doc_id), r["size"], r.source_size, r.target) for r in rows) == want
    assert all(r.taken == sum(p.end - p.first for p in r.pieces) <= 2 * r["size"] for r in rows)
    taken = defaultdict(int)
    for r in rows:
        taken[r.source_size, r.target] += r.taken
    for s in names:
        assert abs(taken[by[s], float(of[s])] - sum(of[o] for o in names if (by[o], of[o]) == (by[s], of[s]))) <= len(names)


def test_reruns_and_other_partitions_agree(spark, mixed):
    again = mixing.mix(docs(spark, ROWS).repartition(13), block_words=256)
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, again.collect())) == sorted(map(key, mixed.collect()))


def test_shards_hold_disjoint_blocks_of_every_source(mixed):
    p = mixed.select("source_size", F.explode("pieces").alias("p")).select("source_size", "p.*")
    of_draw = p.groupBy("source_size", "draw").agg(F.countDistinct("shard").alias("shards")).where("source_size > 10")
    assert of_draw.where("shards > 1").count() == 0
    blocks = [r.n for r in p.groupBy("shard").agg(F.countDistinct("source_size", "draw").alias("n")).collect()]
    assert len(blocks) == 8 and max(blocks) - min(blocks) <= 1
    out = mixing.shuffled(mixed)
    assert out.count() == p.count() and out.select("shard", F.spark_partition_id().alias("p")).distinct().count() == 8


def test_nothing_to_mix(spark):
    assert mixing.mix(docs(spark, [])).collect() == []
    assert [(r.taken, r.target) for r in mixing.mix(docs(spark, [(1, None, None), (2, " ", "s")])).collect()] == [(0, 0.0)] * 2
