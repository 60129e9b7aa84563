"""Benchmark decontamination with a distributed positional inverted index.

A test item's *windows* are its runs of ``window`` consecutive words; an item
with fewer words, but not none, is one window. The operator finds where windows
occur in training texts:

1. *Words*: texts are split once, and their words written.
2. *Rarity*: count the corpus postings of every word of the test items.
3. *Index*: each window's ``anchors`` are its rarest words, the rarest its
   *pivot*. Postings ``(word, document, position)`` of the anchors are stored,
   written once; words that are no window's anchor can decide no match.
4. *Intersection*: a posting of an anchor that stands ``p`` words into an item
   proposes that the item's words begin at ``position - p`` there. Windows whose
   anchors all propose the same beginning are the intersection of their
   offset-adjusted lists.
5. *Verification*: the texts of the few documents that are left are fetched and
   read at the places proposed. Windows that stand there word for word are *phrases*.
   With ``slop`` > 0 a window is also matched *near*: its other anchors stand
   within ``slop`` words of their places beside the pivot, and ``near_share`` of
   its distinct words among as many words as it has and ``slop`` more to each
   side (words put in, left out or moved). Phrases are near too.

All of it is DataFrame code, the same at every size: no side of a join is
broadcast by a hint; Spark does so where it knows that one is small in bytes.
No join carries a text's words: verification fetches the text itself, a third of
their size, for what was proposed in the document, and at once cuts it to the
places proposed.

Null, empty or wordless texts have no words and no hits. Very long texts are rows
of words like others; their postings are rows of their own. Rows are told apart
by id and text, so equal rows have equal results. Items without an id count as
the id ''; equal items count once. Of equally rare words the first by the
alphabet is taken. An empty benchmark contaminates nothing, an empty table gives
an empty result. Columns other than ids and texts are not read, so their names
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantbeam.llm.base import pick, words
from quantbeam.session import materialize


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, item_id, words)`` of the items with words, numbered."""
    found = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"),
                             words(F.col(text_col)).alias("words")).filter(F.size("words") > 0).distinct()
    return found.withColumn("item", F.monotonically_increasing_id())


def document_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart that have the same id but not the same text."""
    return F.struct(doc_id.alias("doc_id"), F.xxhash64(text).alias("text_hash"))


def item_windows(items: DataFrame, corpus: DataFrame, window: int, count: int) -> DataFrame:
    """``(item, at, n_words, anchors, pivot, terms)``: each window with the
    places in the item of its ``count`` rarest distinct words (ties by the word;
    the first place of a word that comes again) and of the rarest of them."""
    vocabulary = materialize(items.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    found = (corpus.select(F.explode("w").alias("term")).join(vocabulary, "term")
             .groupBy("term").agg(F.count("*").alias("n")))
    last = F.greatest(F.size("words") - window, F.lit(0))
    each = (items.select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
            .select("item", "at", F.posexplode(F.slice("words", F.col("at") + 1, window)).alias("k", "term")))
    places = each.groupBy("item", "at", "term").agg((F.col("at") + F.min("k")).alias("place"), F.count("*").alias("m"))
    # Windows are as short as the caller says: a group has ``window`` rows.
    rare = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "place")))
    return (places.join(found, "term", "left").groupBy("item", "at")
            .agg(F.slice(rare, 1, count).alias("rare"), F.sum("m").cast("int").alias("n_words"))
            .select("item", "at", "n_words", F.col("rare.place").alias("anchors"),
                    F.get("rare", F.lit(0))["place"].alias("pivot"), F.col("rare.term").alias("terms")))


def build_index(corpus: DataFrame, windows: DataFrame) -> DataFrame:
    """Postings of the anchors, written once: ``(term, doc, position)``."""
    terms = materialize(windows.select(F.explode("terms").alias("term")).distinct(), "anchor-terms")
    posted = corpus.select("doc", F.posexplode("w").alias("position", "term"))
    return materialize(posted.join(terms, "term").select("term", "doc", "position"), "postings")


def intersect(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """``(doc, item, begin, ats)``: where an item's words may begin in a
    document, and the windows (by ``at``) that are proposed there by all their
    anchors, the pivot exactly and the others within ``slop`` words."""
    spots = materialize(windows.select("item", F.explode(F.arrays_zip("terms", "anchors")).alias("a")).select(
        "item", F.col("a.terms").alias("term"), F.col("a.anchors").alias("place")).distinct(), "spots")
    offsets = F.array(*[F.lit(k) for k in range(-slop, slop + 1)])
    lists = index.join(spots, "term").select("doc", "item", "place", F.explode(offsets).alias("off"),
                                             (F.col("position") - F.col("place")).alias("begin"))
    # One item's beginnings in one document: as many places as it has words at most,
    # however often the row is repeated.
    met = lists.groupBy("doc", "item", (F.col("begin") + F.col("off")).alias("begin")).agg(
        F.collect_set("place").alias("near"), F.collect_set(F.when(F.col("off") == 0, F.col("place"))).alias("exact"))
    listed = windows.groupBy("item").agg(F.collect_list(F.struct("at", "anchors", "pivot")).alias("listed"),
                                         F.min(F.size("anchors")).alias("least"))
    all_met = lambda x: F.array_contains("exact", x["pivot"]) & (F.size(F.array_except(x["anchors"], F.col("near"))) == 0)
    ats = F.transform(F.filter("listed", all_met), lambda x: x["at"])
    return (met.join(materialize(listed, "item-windows"), "item").filter(F.size("near") >= F.col("least"))
            .select("doc", "item", "begin", ats.alias("ats")).filter(F.size("ats") > 0))


def verify(proposed: DataFrame, items: DataFrame, texts: DataFrame, window: int, slop: int, near_share: float) -> DataFrame:
    """``(doc, item_id, start, n_words, phrase)``: the windows that stand where
    they are proposed, word for word or near. ``texts``: ``(doc, text)``."""
    def judged(p: Column, at: Column) -> Column:
        start, n = p["begin"] + at, F.least(F.size(p["words"]), F.lit(window))
        held = F.slice(p["words"], at + 1, n)
        there = F.slice("w", F.greatest(start, F.lit(0)) + 1, n)
        low, beyond = F.greatest(start - slop, F.lit(0)), start + n + slop
        around = F.slice("w", low + 1, F.greatest(beyond - low, F.lit(0)))
        distinct = F.array_distinct(held)
        near = F.size(F.array_intersect(distinct, around)) >= near_share * F.size(distinct)
        return F.struct(p["item_id"].alias("item_id"), start.alias("start"), n.alias("n_words"),
                        ((start >= 0) & (there == held)).alias("phrase"), near.alias("near"))

    # A row per document, whose text is split once; cut at once to the places proposed.
    listed = (proposed.join(materialize(items.select("item", "item_id", "words"), "item-words"), "item")
              .groupBy("doc").agg(F.collect_list(F.struct("item_id", "words", "begin", "ats")).alias("ps")))
    # Proposals grow with the documents: one plan at every size, no broadcast.
    read = materialize(listed, "proposed").hint("merge").join(texts, "doc").select("doc", "ps", words(F.col("text")).alias("w"))
    every = F.flatten(F.transform("ps", lambda p: F.transform(p["ats"], lambda at: judged(p, at))))
    seen = read.select("doc", F.explode(F.filter(every, lambda x: x["phrase"] | (F.lit(slop > 0) & x["near"]))).alias("m"))
    return seen.select("doc", "m.item_id", "m.start", "m.n_words", "m.phrase").distinct()


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, text)`` of every row."""
    return pick(docs, id_col, text_col).select(document_key(F.col("doc_id"), F.col("text")).alias("doc"), "text")


def split_corpus(texts: DataFrame) -> DataFrame:
    """``(doc, w)``: the words of every row, written once."""
    return materialize(texts.select("doc", words(F.col("text")).alias("w")), "corpus-words")


def matches(texts: DataFrame, corpus: DataFrame, benchmark: DataFrame, window: int = 13, anchor_words: int = 2,
            slop: int = 0, near_share: float = 0.8) -> DataFrame:
    """``(doc, item_id, start, n_words, phrase)`` of all windows in the rows
    of ``keyed_texts``, whose words are ``corpus``: phrases, and with ``slop``
    those that are near (``phrase`` false; ``start`` is by the pivot). Written
    once."""
    items = materialize(items_of(benchmark), "items")
    windows = materialize(item_windows(items, corpus, window, anchor_words), "windows")
    proposed = intersect(build_index(corpus, windows), windows, slop)
    # A few rows from each of many tasks: files by their size, not one for each task.
    return materialize(verify(proposed, items, texts, window, slop, near_share).hint("rebalance"), "found")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, anchor_words: int = 2, slop: int = 0,
                  id_col: str = "doc_id", text_col: str = "text", near_share: float = 0.8) -> DataFrame:
    """Per document ``(doc_id, doc, n_words, n_hit, n_items, item_ids,
    items_sha256, n_near)``; ``doc`` tells equal ids apart.

    ``n_hit`` counts the words inside any occurrence of a window, ``item_ids``
    are the items with such windows, sorted as text; ``n_near`` counts the
    items that have a window near (see ``slop``), phrases included.
    """
    texts = keyed_texts(docs, id_col, text_col)
    corpus = split_corpus(texts)
    found = matches(texts, corpus, benchmark, window, anchor_words, slop, near_share)

    phrases = found.filter("phrase")
    # Words covered by the union of the phrases' places, per document.
    spans = phrases.groupBy("doc", "start").agg(F.max("n_words").alias("n"))
    w = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reach", F.coalesce(F.max(F.col("start") + F.col("n")).over(w), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("n") - F.greatest("start", "reach"))
    hit = spans.groupBy("doc").agg(F.sum(fresh).alias("n_hit"))

    per_item = found.groupBy("doc", "item_id").agg(F.max("phrase").alias("phrase"))
    per_doc = per_item.groupBy("doc").agg(
        F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("item_id")))).alias("item_ids"),
        F.count("*").alias("n_near"))

    facts = corpus.select("doc", F.size("w").cast("long").alias("n_words"))
    out = (facts.join(hit, "doc", "left").join(per_doc, "doc", "left")
           .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>"))))
    return out.select(
        F.col("doc.doc_id").alias("doc_id"), "doc", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"))


def contaminated(n_hit: Column, n_words: Column, percent: int = 5) -> Column:
    """The contamination rule: any hit, and a share of the words at least."""
    return (n_hit > 0) & (100 * n_hit >= percent * n_words)
