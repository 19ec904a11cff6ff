"""Benchmark decontamination on a distributed positional inverted index.

``build_index`` splits whole documents into words in one pass and stores a
posting (row key, position, term number) for every word that occurs in the
benchmark, as Parquet in the shared folder; a document with none still has its
closing row, which carries id and word count. ``phrase_matches`` ranks each
window's terms by their posting counts over all documents and intersects
offset-adjusted lists from the rarest on: first the two rarest, whose agreeing
(row, start) pairs are counted in one grouped pass; then the lists of all the
other terms, at the positions that survive. ``proximity_matches`` finds windows
whose words all lie near an occurrence of the rarest, in any order.

DataFrame operations only. Lists of frequent words are joined by (row,
position), so no term's list meets in one task. The benchmark's own tables are
written first; Spark broadcasts them if their size allows and shuffles them
otherwise.

Defined cases: null and empty texts have no words; an item without words has no
window; a repeated item id counts once, a null one not at all; repeated rows
are judged alike; rows that share an id but not the text are judged apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clientlens.llm.shared import ascii_lower, temp_name, written

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
_CLOSE = "\x00"  # never a word


def _split(text: Column) -> Column:
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1)


def _n_words(parts: Column) -> Column:
    """Words in a split text: empty parts stand only at the ends."""
    n = F.size(parts)
    return n - F.when(parts[0] == "", 1).otherwise(0) - F.when((n > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)


def row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("string"), text)


def windows_of(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(item_id, words): every run of ``size`` words of an item, or all words
    of a shorter one."""
    w = F.filter(_split(F.col(text)), lambda x: x != "")
    rows = items.select(F.col(item_id).alias("item_id"), w.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return rows.select("item_id", "w", F.explode(starts).alias("s")) \
        .select("item_id", F.slice(F.col("w"), F.col("s") + 1, F.lit(size)).alias("words"))


def vocabulary(windows: DataFrame) -> DataFrame:
    """(term, tid) of all words in the windows; sized by the benchmark."""
    terms = windows.select(F.explode("words").alias("term")).distinct()
    return written(terms.select("term", F.row_number().over(W.orderBy("term")).alias("tid")), "decontam-terms")


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (k, pos, tid); and for each document row, with tid 0, its
    (k, doc_id, n_words)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(text)).alias("k"), _split(F.col(text)).alias("p"))
    rows = rows.select("doc_id", "k", _n_words(F.col("p")).cast("long").alias("n_words"),
                       F.posexplode(F.array_append("p", F.lit(_CLOSE))).alias("pos", "term"))
    known = terms.unionByName(terms.sparkSession.range(1).select(F.lit(_CLOSE).alias("term"), F.lit(0).alias("tid")))
    close = F.col("tid") == 0
    return written(rows.join(written(known, "decontam-known"), "term")
                   .select("k", "pos", "tid", F.when(close, F.col("doc_id")).alias("doc_id"),
                           F.when(close, F.col("n_words")).alias("n_words")), "decontam-index")


def _ranked(index: DataFrame, windows: DataFrame, terms: DataFrame) -> DataFrame:
    """(win, size, off, tid, rank) of each distinct window, rarest term first;
    windows with a word that no document has are left out."""
    count = index.filter("tid > 0").groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    w = windows.select("words").distinct().select(F.xxhash64("words").alias("win"), F.size("words").alias("size"),
                                                  F.posexplode("words").alias("off", "term"))
    w = w.join(terms, "term").join(count, "tid")
    by = W.partitionBy("win")
    return written(w.withColumn("rank", F.row_number().over(by.orderBy("df", "off")))
                   .withColumn("found", F.count(F.lit(1)).over(by)).filter("found = size")
                   .select("win", "size", "off", "tid", "rank"), "decontam-ranked")


def phrase_matches(index: DataFrame, windows: DataFrame, terms: DataFrame) -> DataFrame:
    """(k, start, win, size): every occurrence of a window as a phrase."""
    ranked = _ranked(index, windows, terms)
    post = index.filter("tid > 0").select("k", "pos", "tid")
    # the two rarest terms: agreeing starts
    start = post.join(ranked.filter("rank <= 2"), "tid") \
        .select("k", "win", "size", "rank", (F.col("pos") - F.col("off")).alias("start"))
    both = start.groupBy("k", "win", "start").agg(F.bit_or("rank").alias("seen"), F.max("size").alias("size"))
    both = written(both.filter("start >= 0 and seen = if(size = 1, 1, 3)").select("k", "win", "start", "size"), "decontam-starts")
    # the lists of all other terms, at the positions that are left
    need = both.join(ranked.filter("rank > 2").select("win", "off", "tid"), "win") \
        .select("k", "win", "start", "size", (F.col("start") + F.col("off")).alias("pos"), "tid")
    hit = need.join(post, ["k", "pos", "tid"]).groupBy("k", "win", "start", "size") \
        .agg(F.count_distinct("pos").alias("n")).filter("n = size - 2")
    return both.filter("size <= 2").unionByName(hit.select("k", "win", "start", "size"))


def _pos(v: Column) -> Column:
    return F.shiftright(v, 32).cast("int")


def _term(v: Column) -> Column:
    return F.shiftright(v.bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int")


def _lists(index: DataFrame, rare: DataFrame) -> DataFrame:
    """(k, list): a row's postings in order, each one number: position, term and,
    in the last bit, whether the term is among ``rare`` (tid). Postings travel
    once, by row; copies of a row, which share its key, are one before that."""
    post = index.filter("tid > 0").select("k", "pos", "tid")
    copies = written(index.filter("tid = 0").groupBy("k").count().filter("count > 1").select("k"), "decontam-copies")
    post = post.join(copies, "k", "left_anti").unionByName(post.join(copies, "k", "left_semi").distinct())
    post = post.join(rare.withColumn("rare", F.lit(1)), "tid", "left") \
        .select("k", (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("tid").cast("long") * 2 + F.coalesce("rare", F.lit(0))).alias("v"))
    return post.repartition("k").groupBy("k").agg(F.sort_array(F.collect_list("v")).alias("list"))


def proximity_matches(index: DataFrame, windows: DataFrame, terms: DataFrame, within: int = 20) -> DataFrame:
    """(k, pos, win): all distinct words of the window lie at most ``within``
    words from its rarest word's occurrence at ``pos``. Each such occurrence meets
    its window's words with the terms around it, taken from its row's list."""
    ranked = _ranked(index, windows, terms)
    words = written(ranked.groupBy("win").agg(F.min_by("tid", "rank").alias("tid"), F.collect_set("tid").alias("words")), "decontam-words")
    lists = _lists(index, words.select("tid").distinct())
    # positions differ, so no more than ``within`` postings of a side are near
    around = F.slice("list", F.greatest(F.col("i") - within, F.lit(0)) + 1, F.lit(2 * within + 1))
    near = F.filter("around", lambda x: F.abs(_pos(x) - F.col("at")) <= within)
    rare = lists.select("k", "list", F.posexplode("list").alias("i", "v")).filter("v % 2 = 1") \
        .select("k", _pos(F.col("v")).alias("at"), _term(F.col("v")).alias("tid"), around.alias("around")) \
        .select("k", "at", "tid", F.transform(near, _term).alias("near"))
    return rare.join(words, "tid").filter(F.size(F.array_except("words", "near")) == 0) \
        .select("k", F.col("at").alias("pos"), "win")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = WINDOW, within: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, k (row key), n_words, n_hit (words
    inside an occurrence of any window), item_ids (sorted as strings). With
    ``within`` also n_near: the distinct windows with a proximity match."""
    windows = written(windows_of(items, item_id, item_text, size), "decontam-windows")
    terms = vocabulary(windows)
    index = build_index(docs, terms, doc_id, text)
    found = written(phrase_matches(index, windows, terms), "decontam-found")
    # union of the intervals [start, start + size) of a row
    spans = found.groupBy("k", "start").agg(F.max("size").alias("size")).withColumn("end", F.col("start") + F.col("size"))
    before = F.max("end").over(W.partitionBy("k").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    spans = spans.withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))))
    hits = spans.groupBy("k").agg(F.sum("fresh").alias("n_hit"))
    named = windows.select(F.xxhash64("words").alias("win"), F.col("item_id").cast("string").alias("item_id")) \
        .filter("item_id is not null").distinct()
    lists = found.select("k", "win").distinct().join(named, "win").select("k", "item_id").distinct() \
        .groupBy("k").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))  # at most the benchmark's ids
    rows = index.filter("tid = 0").select("doc_id", "k", "n_words")
    out = rows.join(hits, "k", "left").join(lists, "k", "left")
    more = []
    if within is not None:
        near = proximity_matches(index, windows, terms, within).groupBy("k").agg(F.count_distinct("win").alias("n_near"))
        out = out.join(near, "k", "left")
        more = [F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")]
    return out.select("doc_id", "k", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), *more)


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more lie in benchmark windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by ``benchmark``, with their columns."""
    bad = contamination(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")) \
        .filter(is_contaminated(F.col("n_hit"), F.col("n_words")))
    bad = written(bad.select("k").distinct(), "decontam-bad")
    name = temp_name(docs, "key")
    have = docs.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    return have.join(bad, have[name] == bad["k"], "left_anti").drop(name)
