"""Information-theoretic sanitisation of personal data, with DataFrame and SQL functions only.

Patterns find the protected entities. The terms of the documents that hold them are then weighed by what they reveal: with documents
counted over the whole corpus, PMI(c; t) = log2(n_ct * n / (n_c * n_t)) is how much term t tells of entity c, and IC(c) = log2(n / n_c)
all there is to tell. A term that tells ``GENERALISE`` of it is generalised, one that tells ``REMOVE`` is removed, in every document that
holds the entity. Rare words meet by chance, and copies of one text prove nothing: a term needs two texts that are no near copies of
each other, and ``EVIDENCE`` bits more than the best of all weighed pairs would have by chance.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from .common import materialize

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Possessive runs and a look at the character before (or the end of the last match) keep the
# leftmost matches the same and long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORTH = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
GENERALISE, REMOVE = 0.8, 0.95  # shares of IC
SUPPORT, EVIDENCE, WIDTH = 2, 10.0, 5  # documents with both; bits of n_ct * PMI beyond log2 of the pairs; words of a shingle
TERM = r"\p{L}{3,}"

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: F.lpad(F.regexp_replace(p, "^0+", ""), 3, "0") <= "255"
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & small(p))
    digits = _digits(value)
    n = F.length(digits)
    if kind == "phone":
        return n.between(9, 15)
    digit = lambda i: F.ascii(F.substring(digits, n - i, 1)) - 48  # noqa: E731  from the last
    doubled = lambda i: F.when(i % 2 == 0, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0))
    luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + doubled(i)) % 10 == 0
    return F.when(n.between(12, 19), luhn).otherwise(False)


def spans_of(text: Column, kind: str) -> Column:
    """Spans of a kind, in code points. Matches and the gaps between them give the places by summing lengths."""
    pattern = F.lit(PATTERNS[kind])
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.char_length(x["g"])
        end = begin + F.char_length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.when(_holds(kind, x["m"]), F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    found = F.aggregate(pairs, start, step, lambda s: s["out"])
    worth = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(WORTH[kind])
    return F.when(worth, found).otherwise(F.array().cast(_SPAN))


def base_spans(docs: DataFrame) -> DataFrame:
    """docs (with non-null ``text``) and ``spans``: all base spans by start, then kind as listed."""
    each = docs.select("*", *(spans_of(F.col("text"), k).alias(f"_{k}") for k in KINDS))
    return each.withColumn("spans", F.array_sort(F.concat(*(F.col(f"_{k}") for k in KINDS)))).drop(*(f"_{k}" for k in KINDS))


def _least_shingle(text: Column, seed: int) -> Column:
    """The least hash of a text's five-word shingles: nearly equal texts mostly have one."""
    some = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - WIDTH + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, WIDTH), F.lit(seed)))
    return let(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: F.array_min(some(w)))


def entities(based: DataFrame) -> DataFrame:
    """A row for each document with spans: key, two hashes that near copies share, kinds, values (kind, digest) and the terms outside of the spans."""
    rows = based.where(F.size("spans") > 0)
    terms = F.regexp_extract_all(rewrite(F.col("text"), F.col("spans"), F.lit(" ")), F.lit(TERM), F.lit(0))
    return rows.select(
        "key", *(_least_shingle(F.col("text"), i).alias(f"copy_{i}") for i in (1, 2)),
        F.array_distinct(F.transform("spans", lambda s: s["kind"])).alias("kinds"),
        F.array_distinct(F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), F.sha2(s["value"], 256).alias("value")))).alias("values"),
        F.array_distinct(F.transform(terms, F.lower)).alias("terms"),
    )


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """keys and n: the documents of each, where two texts are no near copies; counted before the shuffle, so no key is hot."""
    ends = [f(f"copy_{i}").alias(f"{n}_{i}") for i in (1, 2) for n, f in (("a", F.min), ("b", F.max))]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *ends).where((F.col("n") >= SUPPORT) & (F.col("a_1") < F.col("b_1")) & (F.col("a_2") < F.col("b_2"))).select(*keys, "n")


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """kind, value (null: the kind itself), term and share of the terms that tell GENERALISE of an entity's IC or more.

    n counts all documents, n_t those with the term, n_c those with the entity, n_ct those with both, near or far. Entities are
    whole kinds, and single values that two texts or more hold."""
    n = docs.count()
    copies = ["copy_1", "copy_2"]
    kinds = found.select(F.explode("kinds").alias("kind"), F.lit(None).cast("string").alias("value"), "terms", *copies)
    values = found.select("key", *copies, F.inline("values"))
    of_kinds = kinds.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_c"))
    of_values = materialize(_counted(values, "kind", "value").withColumnRenamed("n", "n_c"), "values_of_several_texts")
    n_c = of_kinds.unionByName(of_values)
    told = lambda rows: rows.select("kind", "value", F.explode("terms").alias("term"), *copies)
    # a document's terms meet the few of its values that others hold too, not one by one but as two arrays
    recurring = values.join(of_values.select("kind", "value"), ["kind", "value"], "left_semi").groupBy("key").agg(F.collect_set(F.struct("kind", "value")).alias("recurring"))
    with_values = found.select("key", "terms", *copies).join(recurring, "key").select(F.inline("recurring"), "terms", *copies)
    pairs = told(kinds).unionByName(told(with_values))
    n_ct = materialize(_counted(pairs, "kind", "value", "term").withColumnRenamed("n", "n_ct"), "terms_with_entities")
    weighed_pairs = n_ct.count()
    if not weighed_pairs:
        return n_ct.select("kind", "value", "term", F.lit(0.0).alias("share")).limit(0)
    # the whole vocabulary is counted first and only then joined: no join ever sees the corpus word by word
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))).alias("term"))
    n_t = materialize(words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).where(F.col("n_t") >= SUPPORT), "vocabulary")
    weighed = n_ct.join(n_t, "term").join(n_c, n_ct["kind"].eqNullSafe(n_c["kind"]) & n_ct["value"].eqNullSafe(n_c["value"])).select(n_ct["kind"], n_ct["value"], "term", "n_ct", "n_t", "n_c")
    pmi = F.log2(F.col("n_ct") * F.lit(float(n)) / (F.col("n_c") * F.greatest("n_t", "n_ct").cast("double")))
    ic = F.log2(F.lit(float(n)) / F.col("n_c"))
    sure = F.col("n_ct") * pmi >= EVIDENCE + math.log2(weighed_pairs)
    return weighed.where(sure).select("kind", "value", "term", F.try_divide(pmi, ic).alias("share")).where(F.col("share") >= GENERALISE)


def prepare(docs: DataFrame) -> DataFrame:
    """docs with text '' for null, spans, the text's lane and a key that rows with equal id and text share."""
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    based = base_spans(rows)
    has = F.size("spans") > 0
    return based.withColumn("lane", F.when(has, F.xxhash64("text"))).withColumn("key", F.when(has, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.col("text").cast("binary")))))


def _told_in(text: Column, told: Column, spans: Column) -> Column:
    """The spans of a text's terms that are keys of ``told`` (term to share), but for those inside base spans."""
    terms = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    pairs = F.zip_with(terms, F.slice(F.split(text, TERM, -1), 1, F.size(terms)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + F.char_length(x["g"])
        end = begin + F.char_length(x["m"])
        share = F.try_element_at(told, F.lower(x["m"]))
        kind = F.when(share >= REMOVE, F.lit("drop")).otherwise(F.lit("term"))
        span = F.struct(begin.alias("start"), F.lit(len(KINDS)).alias("rank"), end.alias("end"), kind.alias("kind"), F.lit(None).cast("string").alias("value"))
        return F.struct(end.alias("at"), F.when(share.isNotNull(), F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    found = F.aggregate(pairs, start, step, lambda s: s["out"])
    return F.filter(found, lambda t: ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))


def added_spans(rows: DataFrame, marked: DataFrame, found: DataFrame) -> DataFrame:
    """key and ``more``: the spans of disclosing terms, each once, with kind term (generalised) or drop (removed).

    A term that tells of an entity goes wherever it stands in the documents (``marked``) that hold the entity, however far away.
    Rows of equal id and text share a key and their spans."""
    told = materialize(disclosing(rows, found), "disclosing_terms")
    holds = found.select("key", F.explode("terms").alias("term")).join(told, "term")
    of_kinds = holds.where(F.col("value").isNull()).join(found.select("key", F.explode("kinds").alias("kind")), ["key", "kind"], "left_semi")
    of_values = holds.where(F.col("value").isNotNull()).join(found.select("key", F.inline("values")), ["key", "kind", "value"], "left_semi")
    hits = of_kinds.select("key", "term", "share").unionByName(of_values.select("key", "term", "share"))
    terms = hits.groupBy("key", "term").agg(F.max("share").alias("share")).groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("told"))
    more = marked.join(terms, "key").select("key", _told_in(F.col("text"), F.col("told"), F.col("spans")).alias("more"))
    return more.groupBy("key").agg(F.first("more").alias("more"))


def _join(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of each kind, base_sha256 and spans of every document. Null text: empty. An empty table: no rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    based = prepare(rows)
    marked = materialize(
        based.select("doc_id", "key", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text"), "lane"), "pii_spans"
    )
    found = materialize(entities(marked), "pii_entities")
    more = added_spans(rows, marked, found)
    none = F.array().cast(_SPAN)
    joined = marked.where("key is not null").join(more, "key", "left").select("doc_id", "spans", F.coalesce("more", none).alias("more"))
    kept = joined.unionByName(marked.where("key is null").select("doc_id", "spans", none.alias("more")))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return kept.select("doc_id", *map(count, KINDS), F.sha2(_join(F.col("spans")).cast("binary"), 256).alias("base_sha256"), _join(F.array_sort(F.concat("spans", "more"))).alias("spans"), F.size("more").cast("long").alias("n_terms"))


def rewrite(text: Column, spans: Column, other: Column | None = None) -> Column:
    """The text with each span replaced: [EMAIL] and so on, [TERM] for a generalised term, nothing for a removed one; or all by ``other``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        mark = F.when(x["kind"] == "drop", "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        mark = mark if other is None else other
        gap = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        fresh = x["start"] >= s["at"]
        return F.struct(F.greatest(x["end"], s["at"]).alias("at"), F.when(fresh, F.concat(s["out"], gap, mark)).otherwise(s["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text))))


def sanitize(docs: DataFrame) -> DataFrame:
    """docs with the same columns; entities and disclosing terms in ``text`` are replaced, n_chars follows. Null text stays null.
    Ids may be null or repeated; every row stays. An empty table gives an empty result.

    Documents without an entity pass through in the scan; only the others meet the added spans, by key."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    based = prepare(rows)
    has = F.size("spans") > 0
    marked = materialize(based.where(has).select("row", "key", "spans", "lane"), "pii_spans").withColumn("text", F.col("row.text"))
    found = materialize(entities(marked), "pii_entities")
    more = added_spans(rows, marked, found)
    clean = rewrite(F.col("text"), F.array_sort(F.concat("spans", F.coalesce("more", F.array().cast(_SPAN)))))
    changed = marked.join(more, "key", "left").withColumn("text", clean)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    untouched = based.where(~has).select("row.*")
    return untouched.unionByName(changed.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns)))
