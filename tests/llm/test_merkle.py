"""The Merkle manifest against plain code."""

import hashlib
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, line string, digest string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root, and for each node its (place, siblings) up to it."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, merged = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for j, g in enumerate(groups[a : a + 8]):
                for i in g:
                    paths[i].append((j, run[:j] + run[j + 1 :]))
            parents.append(H("".join(run)))
            merged.append([i for g in groups[a : a + 8] for i in g])
        nodes, groups = parents, merged
    return nodes[0], paths


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    out, parts = [], []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        parts.append((mine, *plain_tree([plain_leaf(r) for r in mine])))
    root, above = plain_tree([p[1] for p in parts]) if parts else (None, [])
    for (mine, subroot, paths), top in zip(parts, above):
        for r, path in zip(mine, paths):
            path = path + top
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = text.translate(LOWER)
            now = plain_leaf((*r[:4], text))
            for j, siblings in path:
                now = H("".join(siblings[:j] + [now] + siblings[j:]))
            out.append((r[0], plain_leaf(r), subroot, root, H("".join(s for _, run in path for s in run)), now, now == root))
    return out


def audited(spark, rows, height=merkle.LEVELS):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    return [tuple(r) for r in merkle.audited(merkle.tampered(df), height).collect()]


def in_order(rows):
    return sorted(rows, key=repr)


ODD = [(None, "s", "en", 1, "Null id"), (None, None, None, None, None), (7, "s", None, 0, ""), (7, "s", "é", 2, "ÄB"), (7, "s", "é", 2, "ÄB"), (8, "s", "é", 2, "x" * 300_000)]


@pytest.mark.parametrize("height", [4, 1, 2])
def test_manifest_is_that_of_plain_code(spark, height):
    rows = ODD + [(i, f"s{i % 3}", "en" if i % 3 else f"l{i % 11:02d}", i, f"Text {i}" if i % 5 else "lower") for i in range(100, 800)]
    got = audited(spark, rows, height)
    assert in_order(got) == in_order(plain(rows))
    assert {r[6] for r in got} == {True, False}


def test_blocks_of_full_height(spark):
    rows = [(i, "s", "en", 3, f"T{i}") for i in range(4098)]
    assert in_order(audited(spark, rows)) == in_order(plain(rows))


@pytest.mark.parametrize("rows", [[], ODD[:1], ODD[3:5]])
def test_few_rows(spark, rows):
    assert in_order(audited(spark, rows)) == in_order(plain(rows))


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5])
def test_addresses_fill_the_layout(rows):
    places = [merkle.address(rows, d, i) for d in range(rows) for i in range(8**d)]
    assert sorted(places) == list(range(len(places)))


def test_subtrees_of_half_height_lie_together():
    for i in range(64):
        below = [merkle.address(4, 2, i)] + [merkle.address(4, 3, i * 8 + j) for j in range(8)]
        assert sorted(below) == list(range(min(below), min(below) + 9))


@given(st.integers(1, 4096))
def test_height(n):
    h = merkle.height_of(n)
    assert 8**h >= n and (h == 0 or 8 ** (h - 1) < n)
