"""Frequency of every distinct term: counts of all n-grams up to a length, by sorting suffixes.

Each record gives its suffixes, cut to `length` terms. A suffix is sent with its number of occurrences and, for each of its
prefixes, whether the prefix is new in its record: in the record's sorted suffixes a prefix is new where it is longer than what
the suffix shares with the one before it. So sets of records become numbers that add up, and equal suffixes are combined in each
task before any shuffle. Suffixes are then routed by group and first term (and a hash of the second, so that a frequent first
term is spread over tasks), sorted in reverse order, and one stack along the sorted rows adds up equal suffixes and all prefixes.
A last small sum joins the parts of the prefixes of one term; single words need none.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import arrow_pass, written

RUN = re.compile(r"\w+")
WORD = re.compile(r"[a-záéíóúüñ]{2,}")
#: Distinct suffixes that a task holds before it sends them on.
HELD = 200_000
SEPARATOR = " "
ONE = (1,)


def words(text: str) -> list[str]:
    """Runs of two or more of the letters, with no other letter, number or underscore beside them, in NFC and lower case."""
    text = unicodedata.normalize("NFC", text).lower()
    return [w for w in RUN.findall(text) if WORD.fullmatch(w)]


def _word_list(text: str, known: dict[str, bool]) -> list[str]:
    """words(text), with the shape of each distinct run looked up."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    out = []
    for run in RUN.findall(text.lower()):
        ok = known.get(run)
        if ok is None:
            if len(known) > 1_000_000:
                known.clear()
            ok = known[run] = WORD.fullmatch(run) is not None
        if ok:
            out.append(run)
    return out


def _suffixes(terms: list[str], length: int) -> Iterator[tuple[str, int, list[int]]]:
    """Of one record: each distinct suffix, cut to `length` terms, with its count and, by prefix length, 1 where the prefix is
    new in the record. A suffix of one term is its own only prefix and always new."""
    if length == 1:
        for suffix, n in Counter(terms).items():
            yield suffix, n, ONE
        return
    before: tuple = ()
    for suffix, n in sorted(Counter(tuple(terms[i : i + length]) for i in range(len(terms))).items()):
        shared = 0
        while shared < min(len(before), len(suffix)) and before[shared] == suffix[shared]:
            shared += 1
        yield SEPARATOR.join(suffix), n, [int(shared < k <= len(suffix)) for k in range(1, length + 1)]
        before = suffix


def term_counts(df: DataFrame, text: str = "text", group: str | None = None, length: int = 1, tokenize: Callable[[str], list[str]] | None = None) -> DataFrame:
    """Rows (group, term, absolute_frequency, document_frequency) for every n-gram of up to `length` words.

    group: a long column by which counts are kept apart, or None (group is then 0). A null group counts as a group of its own,
    -1. Null and empty texts give no terms; repeated rows count as often as they come. Terms of an n-gram are parted by a blank.
    """
    rows = df.select((F.coalesce(F.col(group), F.lit(-1)) if group else F.lit(0)).cast("long").alias("grp"), F.col(text).alias("text")).where("text is not null")

    def start():
        held: dict[tuple[int, str], list[int]] = {}
        known: dict[str, bool] = {}

        def out() -> Iterator[list[list]]:
            if held:
                keys, values = list(held), list(held.values())
                yield [[k[0] for k in keys], [k[1] for k in keys], [v[0] for v in values], [v[1:] for v in values]]
                held.clear()

        def step(batch: pa.RecordBatch | None) -> Iterator[list[list]]:
            if batch is None:
                yield from out()
                return
            for grp, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for suffix, n, new in _suffixes(tokenize(t) if tokenize else _word_list(t, known), length):
                    if v := held.get((grp, suffix)):
                        v[0] += n
                        for k, x in enumerate(new, 1):
                            v[k] += x
                    else:
                        held[grp, suffix] = [n, *new]
                if len(held) > HELD:
                    yield from out()

        return step

    sent = arrow_pass(rows, "grp long, suffix string, n long, news array<long>", start, flush=True)
    first, second = F.split_part("suffix", F.lit(SEPARATOR), F.lit(1)), F.split_part("suffix", F.lit(SEPARATOR), F.lit(2))
    routed = sent.repartition("grp", first, F.pmod(F.xxhash64(second), F.lit(64))).sortWithinPartitions("grp", F.desc("suffix"))
    stacked = arrow_pass(routed, "grp long, term string, absolute_frequency long, document_frequency long", lambda: _stack(length), flush=True)
    if length > 1:  # a prefix of one term is in each part of its second terms
        stacked = stacked.groupBy("grp", "term").agg(F.sum("absolute_frequency").alias("absolute_frequency"), F.sum("document_frequency").alias("document_frequency"))
    return stacked.withColumnRenamed("grp", group or "grp")


def _stack(length: int):
    """Along suffixes in reverse order: the stack holds the prefixes of the last one; what the next doesn't share is complete."""
    path: list[str] = []
    sums: list[list[int]] = []
    at: list[int | None] = [None]

    def popped(depth: int, out: tuple[list, list, list, list]) -> None:
        while len(path) > depth:
            n, new = sums.pop()
            for column, value in zip(out, (at[0], SEPARATOR.join(path), n, new)):
                column.append(value)
            path.pop()
            if sums:
                sums[-1][0] += n

    def step(batch: pa.RecordBatch | None) -> Iterator[tuple]:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if batch is None:
            popped(0, out)
        else:
            for grp, suffix, n, news in zip(*(c.to_pylist() for c in batch.columns)):
                terms = suffix.split(SEPARATOR)
                shared = 0
                if grp == at[0]:
                    while shared < min(len(path), len(terms)) and path[shared] == terms[shared]:
                        shared += 1
                popped(shared, out)
                at[0] = grp
                for t in terms[shared:]:
                    path.append(t)
                    sums.append([0, 0])
                sums[-1][0] += n
                for k in range(len(terms)):
                    sums[k][1] += news[k]
        yield out

    return step


@F.pandas_udf(StringType())
def _plain(word):
    return word.map(lambda w: None if w is None else unicodedata.normalize("NFC", w.strip()).lower())


def marks(documents: DataFrame, published: DataFrame, rare_below: int = 3, common_above: float = 0.2) -> DataFrame:
    """Rows (batch_no, word, mark): words that are too rare or too common, and published counts that the texts contradict.

    documents: batch_no, text. published: batch_no, word, absolute_frequency, document_frequency, exported_at. rare and common
    are of the whole collection and have batch_no 0; the share of common words is of all rows, also those without text. Of a
    published (batch_no, word) the newest export holds; null counts state nothing; a word the batch hasn't has the counts 0.
    Rows without batch or word are no case.
    """
    counts = written(term_counts(documents, "text", "batch_no"))  # read twice below
    size = documents.count()
    every = counts.groupBy("term").agg(F.sum("document_frequency").alias("df"))
    mark = F.when(F.col("df") < rare_below, "rare").when(F.col("df") > common_above * size, "common")
    whole = every.select(F.lit(0).cast("long").alias("batch_no"), F.col("term").alias("word"), mark.alias("mark")).where("mark is not null")

    stated = published.where("batch_no is not null and word is not null").select("batch_no", _plain("word").alias("word"), "absolute_frequency", "document_frequency", "exported_at")
    stated = stated.groupBy("batch_no", "word").agg(F.max(F.struct("exported_at", "absolute_frequency", "document_frequency")).alias("s"))
    stated = stated.where("s.absolute_frequency is not null or s.document_frequency is not null")
    true = counts.select(F.col("batch_no"), F.col("term").alias("word"), F.col("absolute_frequency").alias("a"), F.col("document_frequency").alias("d"))
    wrong = F.coalesce(F.col("s.absolute_frequency") != F.coalesce("a", F.lit(0)), F.lit(False)) | F.coalesce(F.col("s.document_frequency") != F.coalesce("d", F.lit(0)), F.lit(False))
    miscounted = stated.join(true, ["batch_no", "word"], "left").where(wrong).select("batch_no", "word", F.lit("miscounted").alias("mark"))
    return whole.unionByName(miscounted)
