"""Texts to entities: aliases after masking what excludes them, codes, ambiguous parents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

#: What an excluded span is replaced by; no alias holds it.
MASK = chr(0)
#: Characters of forms that are looked for at a time; they go to every task.
BLOCK_CHARS = 4 << 20
_ENTRY = ("ticker", "aliases", "exclude", "ambiguous_parents")


def containing(texts: DataFrame, forms: list[list[str]]) -> DataFrame:
    """texts (id, text) with the number of each list of forms of which the text holds one, a row each.

    All forms are one automaton, so a text is read once whatever their number; empty forms are left out.
    The forms must be of bounded size. Null texts hold nothing.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out = T.StructType([*texts.schema.fields, T.StructField("entry", T.IntegerType())])
    target = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        owners: dict[str, list[int]] = {}
        for i, mine in enumerate(forms):
            for form in set(mine) - {""}:
                owners.setdefault(form, []).append(i)
        automaton = ahocorasick.Automaton()
        for form, which in owners.items():
            automaton.add_word(form, which)
        automaton.make_automaton()
        for batch in batches:
            rows, entries = [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                found: set[int] = set()
                for _, which in automaton.iter(text) if text and owners else ():
                    found.update(which)
                rows += [r] * len(found)
                entries += sorted(found)
            picked = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[c if c.type == f.type else c.cast(f.type) for c, f in zip(picked.columns, target, strict=False)], pa.array(entries, pa.int32())], schema=target)

    return texts.mapInArrow(run, out)


def _blocks(rows: Iterable, forms) -> Iterator[tuple[list, list[list[str]]]]:
    """Rows of a dictionary with their forms, in blocks of bounded size."""
    held, said, size = [], [], 0
    for row in rows:
        held.append(row)
        said.append(forms(row))
        size += sum(map(len, said[-1]))
        if size >= BLOCK_CHARS:
            yield held, said
            held, said, size = [], [], 0
    yield held, said


def touching(articles: DataFrame, entries: DataFrame, codes: bool = True) -> DataFrame:
    """(article_id, text, ticker, aliases, exclude, ambiguous_parents) of each article and entry of which it holds a form.

    Forms are aliases, ambiguous parents and, with codes, the ticker. The dictionary is a stated set, read
    block after block; each block is looked for in all articles, and pairs meet their entry by its number.
    """
    text = articles.select("article_id", F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))).alias("text"))
    known = entries.select(*_ENTRY)
    schema = T.StructType([T.StructField("entry", T.IntegerType()), *known.schema.fields])
    forms = lambda r: [f for f in (*(r.aliases or ()), *(r.ambiguous_parents or ()), *((str(r.ticker),) if codes and r.ticker is not None else ())) if f]
    out = None
    for held, said in _blocks(known.toLocalIterator(), forms):
        dim = known.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(held)], schema)
        found = containing(text, said).join(F.broadcast(dim), "entry").drop("entry")
        out = found if out is None else out.union(found)
    return out


def resolve_entities(articles: DataFrame, entries: DataFrame, codes: bool = True) -> DataFrame:
    """(article_id, ticker, status, matched_form, match_type) for each article and entry that touch.

    entries: (ticker, aliases, exclude, ambiguous_parents), aliases in order of preference. Excluded
    spans are masked longest first; then the first alias found matches, else the six-digit code of the
    ticker if it stands in the text before and after masking, else a parent makes the pair ambiguous.
    Only pairs that touch are masked and judged.
    """
    none = F.array().cast("array<string>")
    ordered = F.array_sort(F.coalesce("exclude", none), lambda a, b: F.length(b) - F.length(a))
    masked = F.aggregate(ordered, F.col("text"), lambda t, e: F.replace(t, e, F.lit(MASK)))
    hit = lambda c: F.get(F.filter(F.coalesce(c, none), lambda a: (a != "") & F.contains(F.col("masked"), a)), 0)
    made = touching(articles, entries, codes).withColumn("masked", masked).withColumns({"alias": hit("aliases"), "parent": hit("ambiguous_parents")})
    bounded = lambda c: F.coalesce(F.rlike(F.col(c), F.concat(F.lit("(?<!\\d)"), F.col("ticker").cast("string"), F.lit("(?!\\d)"))), F.lit(False))
    code = F.col("ticker").cast("string").rlike("^\\d{6}$") & bounded("text") & bounded("masked") if codes else F.lit(False)
    kind = F.when(F.col("alias").isNotNull(), "alias").when(code, "code").when(F.col("parent").isNotNull(), "parent")
    out = made.withColumn("match_type", kind).where("match_type IS NOT NULL")
    form = F.when(F.col("match_type") == "alias", F.col("alias")).when(F.col("match_type") == "code", F.col("ticker").cast("string")).otherwise(F.col("parent"))
    return out.select("article_id", "ticker", F.when(F.col("match_type") == "parent", "ambiguous").otherwise("matched").alias("status"), form.alias("matched_form"), "match_type")


def mentions(lines: DataFrame, entries: DataFrame, text: str = "said_text") -> DataFrame:
    """(doc_id, line, ticker) of entities that a line names by code, canonical name or alias.

    entries (ticker, canonical, aliases, exclude); an entry's excluded spans are masked before its own names
    are looked for, so a longer name that isn't the entity's doesn't count.
    """
    as_articles = lines.select(F.struct("doc_id", "line").alias("article_id"), F.lit("").alias("title"), F.col(text).alias("description"))
    none = F.array().cast("array<string>")
    names = F.array_distinct(F.array_compact(F.concat(F.array(F.col("ticker").cast("string"), "canonical"), F.coalesce("aliases", none))))
    found = touching(as_articles, entries.select("ticker", names.alias("aliases"), "exclude", none.alias("ambiguous_parents")), codes=False)
    masked = F.aggregate(F.coalesce("exclude", none), F.col("text"), lambda t, e: F.replace(t, e, F.repeat(F.lit(MASK), F.length(e))))
    named = found.withColumn("masked", masked).where(F.exists("aliases", lambda a: (a != "") & F.contains(F.col("masked"), a)))
    return named.select("article_id.doc_id", "article_id.line", "ticker").distinct()


def claimed_labels(lines: DataFrame, labels: list[str], text: str = "said_text") -> DataFrame:
    """(doc_id, line, said): a row for each label that a line holds."""
    return label_extraction(lines, labels, text).select("doc_id", "line", F.explode("said").alias("said"))


def article_status(articles: DataFrame, resolved: DataFrame) -> DataFrame:
    """(article_id, status, n): matched before ambiguous before unmatched; n entities matched."""
    got = resolved.groupBy("article_id").agg(F.count_if(F.col("status") == "matched").alias("n"), F.count("*").alias("touched"))
    status = F.when(F.col("n") > 0, "matched").when(F.col("touched") > 0, "ambiguous").otherwise("unmatched")
    return articles.select("article_id").distinct().join(got, "article_id", "left").select("article_id", status.alias("status"), F.coalesce("n", F.lit(0)).alias("n"))


def resolution_report(status: DataFrame, limit: float = 0.3) -> DataFrame:
    """(articles, matched, ambiguous, unmatched, multi, ambiguous_ratio, within): the ratio is over all articles."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    got = status.agg(F.count("*").alias("articles"), is_("matched").alias("matched"), is_("ambiguous").alias("ambiguous"), is_("unmatched").alias("unmatched"), F.count_if(F.col("n") > 1).alias("multi"))
    return got.withColumn("ambiguous_ratio", F.try_divide(F.col("ambiguous").cast("double"), F.col("articles"))).withColumn("within", F.coalesce(F.col("ambiguous_ratio") <= limit, F.lit(True)))


def counts_by(resolved: DataFrame, *columns: str) -> DataFrame:
    return resolved.where("status = 'matched'").groupBy(*columns).agg(F.count("*").alias("n"))


def dead_aliases(entries: DataFrame, resolved: DataFrame) -> DataFrame:
    """(ticker, alias) of dictionary forms that never matched."""
    used = resolved.where("match_type = 'alias'").select("ticker", F.col("matched_form").alias("alias")).distinct()
    return entries.select("ticker", F.explode("aliases").alias("alias")).distinct().join(used, ["ticker", "alias"], "left_anti")


def coverage_gaps(watchlist: DataFrame, entries: DataFrame, resolved: DataFrame) -> DataFrame:
    """(ticker, reason): watched entities without an entry, or whose entry never matched."""
    bare = watchlist.select("ticker").join(entries.select("ticker"), "ticker", "left_anti").withColumn("reason", F.lit("no entry"))
    unmatched = watchlist.select("ticker").join(entries.select("ticker").distinct(), "ticker", "left_semi").join(resolved.where("status = 'matched'").select("ticker"), "ticker", "left_anti")
    return bare.union(unmatched.withColumn("reason", F.lit("no match")))


def alias_audit(resolved: DataFrame, articles: DataFrame, samples: int = 3) -> DataFrame:
    """(ticker, articles, samples): matched articles and the first headlines by id."""
    got = resolved.where("status = 'matched'").select("article_id", "ticker").distinct().join(articles.select("article_id", "title"), "article_id")
    place = F.row_number().over(Window.partitionBy("ticker").orderBy("article_id"))
    kept = got.withColumn("r", place)
    first = F.array_sort(F.collect_list(F.when(F.col("r") <= samples, F.struct("r", "title"))))
    return kept.groupBy("ticker").agg(F.count("*").alias("articles"), F.array_join(F.transform(first, lambda s: s["title"]), " | ").alias("samples"))


def news_rollup(matched: DataFrame, articles: DataFrame) -> DataFrame:
    """(ticker, n, headline): distinct articles and the earliest one's title."""
    got = matched.select("article_id", "ticker").distinct().join(articles.select("article_id", "title", "published_at"), "article_id")
    return got.groupBy("ticker").agg(F.countDistinct("article_id").alias("n"), F.min_by("title", F.struct("published_at", "article_id")).alias("headline"))


def group_prefixes(names: DataFrame, name: str = "name", least_length: int = 2, least_names: int = 3) -> DataFrame:
    """(name, prefix): the shortest prefix that enough names share; names without one are left out."""
    w = names.select(name).distinct().where(F.length(name) > least_length)
    prefixes = w.select(name, F.explode(F.sequence(F.lit(least_length), F.length(name) - 1)).alias("n")).withColumn("prefix", F.expr(f"substring({name}, 1, n)"))
    shared = prefixes.groupBy("prefix").agg(F.count("*").alias("c")).where(F.col("c") >= least_names).select("prefix")
    return prefixes.join(shared, "prefix").groupBy(name).agg(F.min_by("prefix", "n").alias("prefix"))


def exclude_candidates(names: DataFrame, name: str = "name") -> DataFrame:
    """(name, longer): other names that hold a name anywhere.

    Every name is posted under its grams of one to three characters; a name looks only at the postings of its rarest gram
    (of three characters, or of its own length if shorter), which an exact test then judges. Null and empty
    names are left out, repeats count once.
    """
    w = names.select(F.col(name).alias("whole")).where("whole <> ''").distinct()
    long = F.length("whole")
    grams = lambda k: F.transform(F.sequence(F.lit(1), long - k + 1), lambda i: F.substring("whole", i, F.lit(k)))
    of = {k: F.when(long >= k, grams(k)).otherwise(F.array().cast("array<string>")) for k in (1, 2, 3)}
    posted = w.select(F.col("whole").alias("longer"), F.explode(F.array_distinct(F.concat(*of.values()))).alias("gram"))
    own = F.when(long >= 3, of[3]).when(long == 2, of[2]).otherwise(of[1])
    counted = w.select("whole", F.explode(F.array_distinct(own)).alias("gram")).join(posted.groupBy("gram").agg(F.count("*").alias("n")), "gram")
    rarest = counted.groupBy("whole").agg(F.min(F.struct("n", "gram")).alias("least")).select("whole", F.col("least.gram").alias("gram"))
    held = rarest.join(posted, "gram").where(F.contains("longer", "whole") & (F.col("longer") != F.col("whole")))
    return held.select(F.col("whole").alias(name), "longer")


def name_lookup(queries: DataFrame, listing: DataFrame, query: str = "query", name: str = "name") -> DataFrame:
    """(query, n, state, found): an exact name beats names that hold the query; none and several say so."""
    listed, got = listing.select(F.col(name).alias("_id"), F.col(name)).distinct(), None
    for held, said in _blocks(queries.select(query).distinct().dropna().toLocalIterator(), lambda r: [r[0]]):
        dim = queries.sparkSession.createDataFrame([(i, r[0]) for i, r in enumerate(held)], f"entry int, `{query}` string")
        found = containing(listed, said).join(F.broadcast(dim), "entry").select(query, name)
        got = found if got is None else got.union(found)
    exact = F.max(F.when(F.col(name) == F.col(query), F.col(name)))
    counted = got.groupBy(query).agg(F.count("*").alias("n"), exact.alias("exact"), F.min(name).alias("only"))
    out = queries.select(query).distinct().join(counted, query, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    state = F.when(F.col("exact").isNotNull(), "exact").when(F.col("n") == 0, "not found").when(F.col("n") > 1, "ambiguous").otherwise("found")
    return out.select(query, "n", state.alias("state"), F.coalesce("exact", F.when(F.col("n") == 1, F.col("only"))).alias("found"))


def commentary_consistency(docs: DataFrame, ratings: DataFrame, mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, line, ticker, said, rating, verdict): ratings that lines of a text claim, against those computed.

    docs (doc_id, text); mentions (doc_id, line, ticker) rated entities per line; labels (doc_id, line,
    said). A line that names one entity speaks of it, and so do the paragraph's following lines that name
    none; after a line that names several the paragraph is contested. A blank line starts afresh. Labels
    without a subject are left out.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "said_text"))
    para = F.sum((F.trim("said_text") == "").cast("int")).over(Window.partitionBy("doc_id").orderBy("line"))
    named = mentions.groupBy("doc_id", "line").agg(F.countDistinct("ticker").alias("n"), F.min("ticker").alias("ticker"))
    placed = lines.withColumn("para", para).join(named, ["doc_id", "line"], "left").withColumn("state", F.when(F.col("n") > 0, F.struct("n", "ticker")))
    carried = placed.withColumn("subject", F.last("state", ignorenulls=True).over(Window.partitionBy("doc_id", "para").orderBy("line")))
    said = carried.join(labels, ["doc_id", "line"]).where("subject IS NOT NULL")
    got = said.withColumn("ticker", F.when(F.col("subject.n") == 1, F.col("subject.ticker"))).select("doc_id", "line", "ticker", "said").join(ratings.select("ticker", "rating"), "ticker", "left")
    verdict = F.when(F.col("ticker").isNull(), "ambiguous").when(F.col("said") == F.col("rating"), "agrees").otherwise("contradicts")
    return got.select("doc_id", "line", "ticker", "said", "rating", verdict.alias("verdict"))


def label_extraction(lines: DataFrame, labels: list[str], text: str = "text") -> DataFrame:
    """lines with ``said``: the labels in their text, longest first, each found span blanked before shorter ones."""
    out = lines.withColumn("_left", F.col(text)).withColumn("said", F.array().cast("array<string>"))
    for label in sorted(labels, key=lambda x: (-len(x), x)):
        out = out.withColumn("said", F.when(F.contains("_left", F.lit(label)), F.array_append("said", F.lit(label))).otherwise(F.col("said")))
        out = out.withColumn("_left", F.replace("_left", F.lit(label), F.lit(" " * len(label))))
    return out.drop("_left")
