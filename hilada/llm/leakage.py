"""Evaluation passages that stand in documents, fully or in part.

The n-grams of all test passages form a hash set that is built once and goes to every task; each window of a document's words is
looked up in it. Hits are verified against the passage's own positions, so that a passage counts as far as runs of its words are
really there. More passages than one broadcast may hold meet the windows by a shuffle instead; the results are the same.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, written

#: A word, also where a line end splits it after a hyphen.
WORD = re.compile(r"[\w\u0300-\u036f]+(?:-[^\S\n]*\n\s*[\w\u0300-\u036f]+)*")
BREAK = re.compile(r"-\s+")


def _bare(word: str) -> str:
    """Without the break at a line end, accents and case."""
    if "-" in word:
        word = BREAK.sub("", word)
    word = word.lower()
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def _prepared(text: str) -> str:
    """Of the same length, so that words stand where they stand in the text."""
    return text.replace("_", " ").replace("\r", "\n") if "_" in text or "\r" in text else text


def bare_words(text: str, known: dict[str, str] | None = None) -> list[str]:
    """Words of a text, in the form in which passages and documents are compared."""
    known = {} if known is None else known
    out = []
    for w in WORD.findall(_prepared(text)):
        b = known.get(w)
        if b is None:
            b = known[w] = _bare(w)
        out.append(b)
    return out


class Grams:
    """The n-grams of a block of passages, with the places where they stand."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n, self.size = n, {}
        self.places: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for item, passage in items:
            words = bare_words(passage)
            self.size[item] = len(words)
            for k, gram in enumerate(zip(*(words[i:] for i in range(n)))):
                self.places[gram].append((item, k))
        self.places = dict(self.places)

    def hits(self, words: list[str]) -> dict[int, tuple[set[int], list[int]]]:
        """By item: the positions of its passage that stand in the words, and the windows of the words that hold them."""
        found: dict[int, tuple[set[int], list[int]]] = {}
        for at, gram in enumerate(zip(*(words[i:] for i in range(self.n)))):
            for item, k in self.places.get(gram, ()):
                covered, windows = found.setdefault(item, (set(), []))
                covered.update(range(k, k + self.n))
                windows.append(at)
        return found


def _cut(text: str, windows: set[int], n: int) -> str:
    """The text without the words of the windows and what stands between them; all else stays as it is."""
    spans = [m.span() for m in WORD.finditer(_prepared(text))]
    gone = sorted({k for at in windows for k in range(at, at + n)})
    kept, last, before = [], 0, -2
    for k in gone:
        if k - 1 != before:
            kept.append(text[last : spans[k][0]])
        before, last = k, spans[k][1]
    return "".join([*kept, text[last:]])


def _passages(items: DataFrame) -> DataFrame:
    return items.where("item_id is not null and passage is not null").select("item_id", "passage").distinct()


def _held(items: DataFrame, block: int) -> list[tuple[int, str]] | None:
    """The passages, if they are no more than `block`."""
    rows = _passages(items).limit(block + 1).collect()
    return None if len(rows) > block else [tuple(r) for r in rows]


def leaks(items: DataFrame, documents: DataFrame, n: int = 7, share: float = 0.5, block: int = 20_000) -> DataFrame:
    """Rows (item_id, doc_id, covered, words): items of which at least `share` of the words stand in a document, in runs of `n` or more.

    Case, accents, punctuation, white space and words split at line ends make no difference. Passages of fewer than n words and
    null or empty texts match nothing; repeated items count once, and so do equal rows of a document; two texts under one doc_id
    are judged each by itself. Up to `block` items are one broadcast; more are joined with the windows of the documents by hash.
    Either way the documents are read once.
    """
    spark = documents.sparkSession
    held = _held(items, block)
    if held is None:
        found = _joined(items, documents.where("text is not null").select("doc_id", "text"), n, share)
        return found.select("item_id", "doc_id", "covered", "words").distinct()
    shared = spark.sparkContext.broadcast(Grams(held, n))

    def start():
        grams, known = shared.value, {}

        def step(batch: pa.RecordBatch):
            found: list[list] = [[], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(known) > 500_000:
                    known.clear()
                for item, (covered, _) in grams.hits(bare_words(text, known)).items():
                    if len(covered) >= share * grams.size[item]:
                        for column, value in zip(found, (item, doc, len(covered), grams.size[item])):
                            column.append(value)
            yield found

        return step

    rows = documents.where("text is not null").select("doc_id", "text")
    return arrow_pass(rows, "item_id long, doc_id long, covered long, words long", start).distinct()


def _words_of(rows: DataFrame, key: str) -> DataFrame:
    def start():
        known: dict[str, str] = {}

        def step(batch: pa.RecordBatch):
            if len(known) > 500_000:
                known.clear()
            yield [batch.column(0).to_pylist(), [bare_words(t, known) for t in batch.column(1).to_pylist()]]

        return step

    return arrow_pass(rows, f"{key} long, words array<string>", start)


def _joined(items: DataFrame, documents: DataFrame, n: int, share: float) -> DataFrame:
    """Rows (item_id, row, doc_id, covered, words, windows) by a join on two hashes of each window.

    documents: doc_id, text. Copies of a window inside a text are sent once, and Spark's own filters keep most of those that no
    item has from the shuffle; adaptive execution splits windows that many texts have.
    """
    gram = lambda i: F.concat_ws(" ", F.slice("words", i + 1, n))
    places = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n))

    def windows(df: DataFrame, *keys: str) -> DataFrame:
        each = df.select(*keys, "words", F.explode(places).alias("at")).withColumn("gram", gram(F.col("at")))
        return each.select(*keys, "at", F.xxhash64("gram").alias("h1"), F.xxhash64(F.lit(n), F.reverse("gram")).alias("h2"))

    numbered = written(documents.withColumn("row", F.monotonically_increasing_id()))
    passages = written(_words_of(_passages(items).select("item_id", "passage"), "item_id"))
    of_items = windows(passages, "item_id").withColumnRenamed("at", "k")
    of_texts = windows(_words_of(numbered.select("row", "text"), "row"), "row").groupBy("row", "h1", "h2").agg(F.collect_list("at").alias("at"))
    hit = of_texts.join(of_items, ["h1", "h2"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.collect_set("k"), lambda k: F.sequence(k, k + n - 1)))))
    each = hit.groupBy("row", "item_id").agg(covered.cast("long").alias("covered"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("windows"))
    sized = each.join(passages.select("item_id", F.size("words").cast("long").alias("words")), "item_id").where(F.col("covered") >= share * F.col("words"))
    return sized.join(numbered.select("row", "doc_id"), "row")


def without_leaks(items: DataFrame, documents: DataFrame, n: int = 7, share: float = 0.5, block: int = 20_000, drop: bool = False) -> DataFrame:
    """The documents with leaked passages cut out (or, with drop, without the documents that hold any); other columns stay.

    What is cut is decided on the text as it came, over all items at once, and then cut once; nothing outside the cut is changed.
    """
    if drop:
        return documents.join(leaks(items, documents, n, share, block).select("doc_id").distinct(), "doc_id", "left_anti")
    held = _held(items, block)
    if held is None:
        numbered = written(documents.withColumn("_text_hash", F.sha2("text", 256)))
        distinct = numbered.where("text is not null").groupBy("_text_hash").agg(F.any_value("text").alias("text")).select(F.xxhash64("_text_hash").alias("doc_id"), "text", "_text_hash")
        distinct = written(distinct)
        found = _joined(items, distinct.select("doc_id", "text"), n, share).groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"))
        cleaned = arrow_pass(distinct.join(found, "doc_id").select("_text_hash", "text", "windows"), "_text_hash string, _cleaned string", lambda: _cutting(n))
        out = numbered.join(cleaned, "_text_hash", "left").withColumn("text", F.coalesce("_cleaned", "text"))
        return out.select(*documents.columns)
    shared = documents.sparkSession.sparkContext.broadcast(Grams(held, n))

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams, known = shared.value, {}
        for texts in batches:
            if len(known) > 500_000:
                known.clear()
            out = []
            for text in texts:
                gone: set[int] = set()
                for item, (covered, windows) in (grams.hits(bare_words(text, known)) if text else {}).items():
                    if len(covered) >= share * grams.size[item]:
                        gone.update(windows)
                out.append(_cut(text, gone, n) if gone else text)
            yield pd.Series(out, dtype=object)

    return documents.withColumn("text", cut("text"))


def _cutting(n: int):
    def step(batch: pa.RecordBatch):
        keys, texts, windows = (c.to_pylist() for c in batch.columns)
        yield [keys, [_cut(t, set(w), n) for t, w in zip(texts, windows)]]

    return step
