"""Benchmark decontamination by a distributed positional inverted index.

``PositionalIndex`` stores a posting (term, doc_id, sig, pos) for every word of every
document. Each input split is a shard: its postings lie together, in order of term, then
document and position, so a reader of few terms skips the rest, and nothing is shuffled to
build it. ``sig`` (a hash of the text) tells rows apart that repeat a doc_id. The empty term,
which no word is, has one posting for every row: after its last word, so its place is the
number of words, and texts are split into words once.

``phrases`` finds the passages of test items. Every window of an item names its two rarest
terms as anchors, by their counts in the index. Lists of the anchors, with the anchor's place
in the item taken off each position, are intersected: a document holds a window only where
both anchors give the same alignment (item, document, offset). The lists of all other terms
are then read for the documents that are left and intersected with the alignments; runs of
consecutive words as long as a window are exact phrase matches. ``proximity`` finds documents
with the rarest terms of an item close together in any order.

Only built-in functions. Broadcast are terms, anchors and items of the test set and
documents with alignments, each only after a check of its bytes; beyond it the joins shuffle.

Defined cases: null text has no words and is not hit; an item without words (or null) has no
windows; an item shorter than a window is one window; equal items count once; items with
the same id are one item; a null item_id counts as an item and is written as the empty string;
rows that repeat a doc_id are judged each on its own text; empty tables give no rows or no
hits; other columns are ignored.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hubcast.llm import common
from hubcast.session import ensure_checkpoint_dir

# Words are runs of digits, ASCII letters and everything beyond ASCII. The ASCII ones are named one by one,
# which Java looks up in a table of bits; ranges are tried in turn for every character.
WORD = f"[{string.ascii_letters}{string.digits}" r"\x80-\x{10FFFF}]+"
DOC = ("doc_id", "sig")
END = ""  # the term of a row's length


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("sig"), "text")


def _same(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    """Equality on the document and ``cols``; a null doc_id equals itself."""
    on = a["doc_id"].eqNullSafe(b["doc_id"]) & (a["sig"] == b["sig"])
    for c in cols:
        on &= a[c] == b[c]
    return on


class PositionalIndex:
    """Postings of all words of a corpus in a shared folder; ``add`` appends more documents."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def fresh(cls, spark: SparkSession) -> PositionalIndex:
        return cls(spark, f"{ensure_checkpoint_dir(spark)}/postings-{uuid.uuid4().hex}")

    def add(self, docs: DataFrame) -> PositionalIndex:
        words = F.concat(F.coalesce(_words(F.col("text")), F.array().cast("array<string>")), F.array(F.lit(END)))
        places = _keyed(docs).select(*DOC, F.posexplode(words).alias("pos", "word"))
        (places.select(common.lower_ascii(F.col("word")).alias("term"), *DOC, "pos")
         .sortWithinPartitions("term", *DOC, "pos").write.mode("append").parquet(self.path))
        return self

    def postings(self, terms: DataFrame | None = None) -> DataFrame:
        found = self.spark.read.schema("term string, doc_id bigint, sig bigint, pos int").parquet(self.path)
        return found if terms is None else found.join(terms, "term", "left_semi")

    def lengths(self) -> DataFrame:
        """(doc_id, sig, n_words): one row for each text of a doc_id; rows without words have 0."""
        return self.postings().filter(F.col("term") == END).groupBy(*DOC).agg(F.max("pos").cast("long").alias("n_words"))

    def counts(self, terms: DataFrame) -> DataFrame:
        """(term, cf): occurrences of those terms that occur."""
        return self.postings(terms).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def prepare(items: DataFrame) -> DataFrame:
    """(item, item_id, words): distinct items with a word, numbered."""
    words = F.transform(_words(F.col("text")), common.lower_ascii)
    distinct = items.select("item_id", words.alias("words")).filter(F.size("words") > 0).distinct()
    return common.cut(distinct.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"))


def _counted(index: PositionalIndex, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms, counted): the terms of the test set; (item, words, cfs) with the counts of its words in order."""
    each = items.select("item", F.posexplode("words").alias("p", "term"))
    terms = common.small(common.cut(each.select("term").distinct()))
    counts = common.small(common.cut(index.counts(terms)))
    cfs = F.array_sort(F.collect_list(F.struct("p", F.coalesce("cf", F.lit(0)).alias("cf"))))["cf"]
    return terms, each.join(counts, "term", "left").groupBy("item").agg(cfs.alias("cfs")).join(items, "item")


def _anchors(counted: DataFrame, length: int) -> DataFrame:
    """(item, p, term, need): the places of the two rarest terms of every window whose terms all occur."""
    size = F.least(F.lit(length), F.size("words"))
    rarest = F.transform(
        F.sequence(F.lit(0), F.size("words") - size),
        lambda s: F.slice(F.array_sort(F.transform(
            F.sequence(s, s + size - 1), lambda p: F.struct(F.get("cfs", p).alias("cf"), p.alias("p")))), 1, 2))
    places = F.array_distinct(F.flatten(F.filter(rarest, lambda r: F.get(r, F.lit(0))["cf"] > 0))["p"])
    return (counted.select("item", "words", F.least(size, F.lit(2)).alias("need"), F.explode(places).alias("p"))
            .select("item", "p", F.get("words", F.col("p")).alias("term"), "need"))


def phrases(index: PositionalIndex, items: DataFrame, length: int = 10) -> DataFrame:
    """(item, doc_id, sig, first, n): runs of n consecutive words of an item, from word ``first`` of a document on.

    ``items`` come from ``prepare``; runs are as long as they go and hold at least one window.
    """
    terms, counted = _counted(index, items)
    anchors = common.small(common.cut(_anchors(counted, length)))
    aligned = common.cut(
        index.postings().join(anchors, "term")
        .groupBy("item", *DOC, (F.col("pos") - F.col("p")).alias("offset"))
        .agg(F.min("p").alias("low"), F.max("p").alias("high"), F.first("need").alias("need"))
        .filter("need = 1 OR low < high").select("item", *DOC, "offset"))
    held = common.small(common.cut(aligned.select(*DOC).distinct()))
    lists = index.postings(terms)
    lists = lists.join(held, _same(lists, held), "left_semi")
    wanted = aligned.join(common.small(items), "item").select(
        "item", *DOC, "offset", F.least(F.lit(length), F.size("words")).alias("size"), F.posexplode("words").alias("p", "term")
    ).withColumn("pos", F.col("offset") + F.col("p"))
    met = wanted.join(lists, _same(wanted, lists, "pos", "term"), "left_semi")
    island = F.col("p") - F.row_number().over(Window.partitionBy("item", *DOC, "offset").orderBy("p"))
    return (met.withColumn("island", island).groupBy("item", *DOC, "offset", "size", "island")
            .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n >= size")
            .select("item", *DOC, "first", "n"))


def proximity(index: PositionalIndex, items: DataFrame, terms: int = 3, within: int = 20) -> DataFrame:
    """(item, doc_id, sig, first, last): the rarest ``terms`` words of an item, all inside ``within`` words.

    In any order; a match begins at each posting of one of the words from which all others
    lie within reach, and ends at the last of their postings there. Items with a word that occurs
    nowhere have none of it among their rarest; words that occur nowhere are left out.
    """
    _, counted = _counted(index, items)
    ranked = F.slice(F.array_sort(F.array_distinct(F.filter(
        F.arrays_zip("cfs", "words"), lambda x: x["cfs"] > 0))), 1, terms)
    probes = common.small(common.cut(counted.select("item", F.posexplode(ranked).alias("k", "x"), F.size(ranked).alias("all"))
                                     .select("item", "k", "all", F.col("x.words").alias("term"))))
    hits = index.postings().join(probes, "term")
    reach = Window.partitionBy("item", *DOC).orderBy("pos").rangeBetween(0, within - 1)
    return (hits.withColumn("seen", F.size(F.collect_set("k").over(reach))).withColumn("last", F.max("pos").over(reach))
            .filter("seen = all").select("item", *DOC, F.col("pos").alias("first"), "last"))


def flag(docs: DataFrame, items: DataFrame, index: PositionalIndex, length: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every row of ``docs``, which ``index`` holds."""
    tests = prepare(items)
    found = common.cut(phrases(index, tests, length))
    before = Window.partitionBy(*DOC).orderBy("first", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("first") + F.col("n")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("first"), F.coalesce(F.max(end).over(before), F.lit(0))))
    hit = found.select(*DOC, new.alias("new")).groupBy(*DOC).agg(F.sum("new").alias("n_hit"))
    named = (found.select("item", *DOC).distinct().join(common.small(tests.select("item", "item_id")), "item")
             .groupBy(*DOC).agg(F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("ids")))
    held = hit.join(named, _same(hit, named)).select(hit["doc_id"], hit["sig"], "n_hit", "ids")
    lengths = common.cut(index.lengths())
    told = lengths.join(held, _same(lengths, held), "left").select(lengths["doc_id"], lengths["sig"], "n_words", "n_hit", "ids")
    every = _keyed(docs).select(*DOC)
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return every.join(told, _same(every, told), "left").select(
        every["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
