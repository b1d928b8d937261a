"""Every stage of the pipeline against plain code on its own input."""

import math
import random
import re
import sys

import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
import corpus_pipeline  # noqa: E402

from tests.llm.test_texts import _components, _leaks  # noqa: E402
from tidemark.llm import toxicity  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def _toxic(text, model):
    """The noisy-or of a text's sentences, plainly."""
    clean = 1.0
    for part in re.findall(r"[^.!?\n]+", text or ""):
        if words := set(re.findall(r"[^\W_]+", part.lower())):
            z = model.bias + sum(model.weights.get(f, 0.0) for w in words for f in toxicity.features(w))
            clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


_PATTERNS = (
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}""", r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}",
)


def _chances(texts):
    """Log-likelihood ratios of the next character, counted one by one from the labelled samples."""
    count = [{}, {}]
    for t in texts:
        covered = sorted(m.span() for p in _PATTERNS for m in re.finditer(p, t or ""))
        plain, at = [], 0
        for a, b in covered:
            plain.append(t[at:a] if a > at else "")
            at = max(at, b)
            value = re.sub(r"""^(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "", t[a:b])
            if len(value) >= 12 and re.search("[0-9]", value) and re.search("[A-Za-z]", value):
                for x, y in zip(" " + value, value):
                    if y.isalnum():
                        key = (x if x.isalnum() else "", y)
                        count[1][key] = count[1].get(key, 0) + 1
        for run in [*plain, (t or "")[at:]]:
            run = re.sub("[^A-Za-z0-9]", " ", run)
            for x, y in zip(" " + run, run):
                if y != " ":
                    key = (x.strip(), y)
                    count[0][key] = count[0].get(key, 0) + 1
    total = [{}, {}]
    for label in (0, 1):
        for (x, _), n in count[label].items():
            total[label][x] = total[label].get(x, 0) + n
    chance = lambda label, x, y: math.log((count[label].get((x, y), 0) + 0.5) / (total[label].get(x, 0) + 31))
    return lambda x, y: chance(1, x, y) - chance(0, x, y)


def _masked(text, ratio):
    """The text with its secrets masked, by plain patterns and a plain walk over what they leave."""
    taken = {i for p in _PATTERNS for m in re.finditer(p, text) for i in range(*m.span())}
    spans = [m.span() for p in _PATTERNS for m in re.finditer(p, text)]
    for run in re.finditer("[A-Za-z0-9+/_=-]{12,}", text):
        rest = "".join(" " if i in taken else text[i] for i in range(*run.span()))
        for part in re.finditer("[^ ]{12,}", rest):
            score = sum(ratio(x if x.isalnum() else "", y) for x, y in zip(" " + part[0], part[0]) if y.isalnum())
            if score >= 14:
                spans.append((run.start() + part.start(), run.start() + part.end()))
    out, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            out += [text[at:a], "[REDACTED]"] if a >= at else []
            at = b
    return "".join([*out, text[at:]])


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "secrets", "byte-level BPE"]
    columns = docs.columns
    ins = docs.collect()
    (_, toxic), (_, near), (_, leaks), (_, mask), (_, bpe) = corpus_pipeline.STAGES

    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r.doc_id for r in ins if _toxic(r.text, model) >= 0.5}
    assert 0 < len(rejected) < len(ins) / 2
    out = toxic(spark, docs, SF)
    assert out.columns == columns and {r.doc_id for r in out.collect()} == {r.doc_id for r in ins} - rejected

    rows = sorted(out.collect(), key=lambda r: r.doc_id)
    label, _ = _components([r.text for r in rows], 5)
    out = near(spark, spark.createDataFrame(rows + rows[:3], docs.schema), SF)
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == [r.doc_id for i, r in enumerate(rows) if label[i] == i]

    rows = out.collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = leaks(spark, spark.createDataFrame(rows, docs.schema), SF)
    assert out.columns == columns and {r.doc_id for r in out.collect()} == {r.doc_id for r in rows if not _leaks(r.text, items)[1]}

    draw = random.Random(12)
    key = lambda n: "".join(draw.choice("ABCDEFGHJKMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(n))
    held = [f"password: {key(20)} then ghp_{key(36)}/{key(15)} end", f"AKIA{key(16).upper()} token={key(14)}{key(3)} x{key(30)}", "a1" * 20 + key(18), "plain_words_joined_by_marks and api_key=short"]
    planted = [docs.first().asDict() | {"doc_id": 10**6 + i, "text": t, "n_chars": len(t)} for i, t in enumerate(held)]
    kept = out.unionByName(spark.createDataFrame(planted, docs.schema))
    rows = {r.doc_id: r for r in kept.collect()}
    ratio = _chances([r.text for r in rows.values()])
    out = mask(spark, kept, SF)
    assert out.columns == columns and out.count() == len(rows)
    masked = 0
    for r in out.collect():
        want = _masked(rows[r.doc_id].text or "", ratio)
        assert r.text == want and r.n_chars == len(want)
        masked += "[REDACTED]" in want
    assert masked >= 3

    import tiktoken

    from tidemark.llm.byte_bpe import read_ranks

    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    texts = {r.doc_id: r.text for r in out.collect()}
    got = bpe(spark, out, SF).collect()
    assert len(got) == len(texts) and all(r.ids == plain.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in got)


def test_rows_are_judged_by_their_texts_not_their_ids(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic, near, leaks, _, bpe = (stage for _, stage in corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    make = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], docs.schema)
    kept = lambda stage, rows: sorted((r.doc_id or -1, r.text or "") for r in stage(spark, make(rows), SF).collect())

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    monkeypatch.setattr(toxicity, "train", lambda *_: model)
    bad = texts[next(r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect())]
    good = "a wholly plain sentence about the weather of a day in spring"
    assert kept(toxic, [(None, bad), (5, bad), (5, good), (None, good)]) == [(-1, good), (5, good)]

    leak = " ".join(spark.read.parquet(f"{SF}/benchmark.parquet").first().text.split()[:20])
    assert kept(leaks, [(None, leak), (5, leak), (5, good), (None, good)]) == [(-1, good), (5, good)]

    one, two = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(3, one), (3, two), (9, one), (None, one), (None, one + " end"), (4, ""), (4, ""), (4, None), (None, ""), (6, "")]
    assert kept(near, rows) == sorted([(3, one), (3, two), (4, ""), (4, ""), (-1, ""), (6, "")])
    assert kept(near, [(None, two), (None, two)]) == [(-1, two)]

    from tidemark.llm.byte_bpe import ByteBpe

    assert [r.n_tokens is None for r in bpe(spark, make([(1, good)]), SF).collect()] == [False]
    step = []
    monkeypatch.setattr(ByteBpe, "decode", lambda self, ids: b"?")
    from tidemark.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "map_rows", lambda df, make, schema: step.append(make()) or df)
    byte_bpe.encode(make([(1, good)]), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, checked=True)
    assert step[0]({"doc_id": [1], "text": [good]}) == {"doc_id": [1], "ids": [None], "n_tokens": [None]}


def test_empty_odd_and_repeated_rows_and_clashing_columns(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    monkeypatch.setattr(toxicity, "train", lambda *_: model)
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row long, row int, node string, component_id long, label int, ids string, spans string, text_hash int"
    long = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    rows = [(i, t, "en", "s", 0, 1, 2, "x", 3, 4, "y", "z", 5) for i, t in ((1, None), (1, None), (2, ""), (None, ""), (None, None), (3, long), (3, long), (4, "é漢 🎉"), (5, "a wholly plain sentence of words"), (5, "a wholly plain sentence of words"))]
    for table, left in ((spark.createDataFrame([], schema), {}), (spark.createDataFrame(rows, schema), None)):
        for name, stage in corpus_pipeline.STAGES:
            table = corpus_pipeline.written(stage(spark, table, SF))
            assert name == "byte-level BPE" or table.columns == corpus_pipeline.COLUMNS
        got = [(r.doc_id, r.n_tokens) for r in table.collect()]
        if left is not None:
            assert got == []
        else:  # of rows of one id with equal texts one stays; rows without id and words are like no other
            assert sorted(i or 0 for i, _ in got) == [0, 0, 1, 2, 3, 4, 5] and all(n is not None for _, n in got)


def test_run_is_its_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids"]
    assert corpus_pipeline.ORACLE_SQL is None
