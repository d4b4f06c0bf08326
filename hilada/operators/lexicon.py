"""Word frequencies, ranked vocabularies with token ids, and what they cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..session import spread, written

FIRST_TOKEN, LAST_TOKEN = 536, 65535
SIZES = (20_000, 30_000, 40_000, 50_000, 65_000)
CUTOFFS = (10, 50, 100, 128, 512, 1024, 5000, 10_000, 25_000, 50_000, 65_000)
ALL = "completo"


def frequencies(documents: DataFrame, source: str = "source") -> DataFrame:
    """Rows (source, word, frequency, document_frequency).

    One shuffle: in a text's sorted words the first of equal ones is marked, so occurrences and documents are counted by one
    aggregate, which tasks combine before anything is sent. Null texts have no words; a null source is kept apart. The counts are
    written as a table, so that whatever ranks or compares them doesn't cut texts into words again.
    """
    rows = spread(documents.select(F.col(source).alias("source"), "text"))
    words = F.array_sort(T.lexical_tokens(F.col("text")))
    rows = rows.select("source", words.alias("ws"))  # no filter on ws: it would be made below the shuffle, a second time
    marked = F.transform("ws", lambda w, i: F.struct(w.alias("word"), F.coalesce(F.get("ws", i - 1) != w, F.lit(True)).alias("first")))
    each = rows.select("source", F.inline(marked))
    return written(each.groupBy("source", "word").agg(F.count(F.lit(1)).alias("frequency"), F.count_if("first").alias("document_frequency")))


def merged(by_source: DataFrame) -> DataFrame:
    """The sources' frequencies added up; they share no documents, so document frequencies add up too."""
    return by_source.groupBy("word").agg(F.sum("frequency").alias("frequency"), F.sum("document_frequency").alias("document_frequency"))


def with_all(by_source: DataFrame, name: str = ALL) -> DataFrame:
    """Each source's frequencies and, as one source more, those of all."""
    return by_source.unionByName(merged(by_source).withColumn("source", F.lit(name)))


def ranked(by_source: DataFrame) -> DataFrame:
    """Adds to each source's words: ranking, token, relative_frequency, cumulative_frequency, coverage (percent).

    Ranked by frequency, then by code points; shares refer to the whole vocabulary. A source's words never meet in one task:
    they are numbered inside groups of one frequency and the same first letters. How many words and occurrences stand before a
    group is told by a histogram in two steps: over bands of the groups (a frequency under 16 with two letters, or a range of
    greater ones), whose number has a bound, and inside each band. Words of a group are equally frequent, so sums need no running
    total.
    """
    few = F.col("frequency") < 16
    band = [F.when(few, F.col("frequency")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("frequency"))).cast("long")).alias("g_level"), F.when(few, F.substring("word", 1, 2)).otherwise("").alias("g_letters")]
    rows = by_source.withColumn("head", F.substring("word", 1, 5))
    at = ["source", "frequency", "head"]
    n, sums = F.col("n"), F.col("n") * F.col("frequency")
    groups = rows.groupBy(*at, *band).agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("source").orderBy(F.desc("g_level"), "g_letters").rowsBetween(Window.unboundedPreceding, -1)
    bands = groups.groupBy("source", "g_level", "g_letters").agg(F.sum(n).alias("bn"), F.sum(sums).alias("bs"))
    bands = bands.select(
        F.col("source").alias("b_source"), F.col("g_level").alias("b_level"), F.col("g_letters").alias("b_letters"), F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("b_words"), F.coalesce(F.sum("bs").over(above), F.lit(0)).alias("b_sum"),
        F.sum("bs").over(Window.partitionBy("source")).alias("total"),
    )
    before = Window.partitionBy("source", "g_level", "g_letters").orderBy(F.desc("frequency"), "head").rowsBetween(Window.unboundedPreceding, -1)
    inner = groups.withColumn("words_in", F.coalesce(F.sum(n).over(before), F.lit(0))).withColumn("sum_in", F.coalesce(F.sum(sums).over(before), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("g_level") == F.col("b_level")) & (F.col("g_letters") == F.col("b_letters"))
    ahead = inner.join(bands, same).select(
        F.col("source").alias("g_source"), F.col("frequency").alias("g_frequency"), F.col("head").alias("g_head"), (F.col("words_in") + F.col("b_words")).alias("words_ahead"), (F.col("sum_in") + F.col("b_sum")).alias("sum_ahead"), "total",
    )
    met = F.col("source").eqNullSafe(F.col("g_source")) & (F.col("frequency") == F.col("g_frequency")) & (F.col("head") == F.col("g_head"))
    inside = F.row_number().over(Window.partitionBy(*at).orderBy("word"))
    out = rows.join(ahead, met).drop("g_source", "g_frequency", "g_head").withColumn("inside", inside)
    out = out.withColumn("ranking", F.col("words_ahead") + F.col("inside")).withColumn("cumulative_frequency", F.col("sum_ahead") + F.col("inside") * F.col("frequency"))
    out = out.withColumn("token", FIRST_TOKEN + F.col("ranking") - 1).withColumn("relative_frequency", F.col("frequency").cast("double") / F.col("total"))
    return out.withColumn("coverage", F.col("cumulative_frequency") * 100.0 / F.col("total")).drop("head", "inside", "words_ahead", "sum_ahead")


def top(by_source: DataFrame, size: int) -> DataFrame:
    """The `size` first words of each source; all of a smaller vocabulary. Tokens must fit 16 bits."""
    if not 0 < size <= LAST_TOKEN - FIRST_TOKEN + 1:
        raise ValueError(f"a vocabulary has 1 to {LAST_TOKEN - FIRST_TOKEN + 1} words")
    return ranked(by_source).where(F.col("ranking") <= size)


def top_exact(by_source: DataFrame, requested: int) -> DataFrame:
    """top() of a requested size, moved into what is allowed; a source with fewer words than that is an error."""
    size = clamped(requested)
    rows = top(by_source, size)
    few = F.max("ranking").over(Window.partitionBy("source")) < size
    enough = F.when(few, F.raise_error(F.concat(F.lit(f"fewer than {size} words in "), F.coalesce("source", F.lit("no source")))).cast("long")).otherwise(F.col("ranking"))
    return rows.withColumn("ranking", enough)


def clamped(requested: int, most: int = 65_000) -> int:
    return max(1, min(requested, most))


def alphabetical(vocabulary: DataFrame) -> DataFrame:
    """Adds each word's place in alphabetical order; tokens stay."""
    return vocabulary.withColumn("alphabetical", F.row_number().over(Window.partitionBy("source").orderBy("word")).cast("long"))


def summary(by_source: DataFrame) -> DataFrame:
    """Of each source and of all: words, tokens, and words that occur once."""
    counts = [F.count(F.lit(1)).alias("vocabulary"), F.sum("frequency").alias("tokens"), F.count_if(F.col("frequency") == 1).alias("hapax")]
    return with_all(by_source).groupBy("source").agg(*counts)


def versions(by_source: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Of each source, of all, and of each size: selected words, token range, and occurrences covered and not covered.

    One ranking serves all sizes: each word is counted for the sizes its rank is within.
    """
    rows = ranked(with_all(by_source))
    inside = [F.sum(F.when(F.col("ranking") <= s, F.col("frequency")).otherwise(0)).alias(f"covered_{s}") for s in sizes]
    wide = rows.groupBy("source").agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("frequency").alias("total_occurrences"), *inside)
    long = wide.select("source", "vocabulary", "total_occurrences", F.explode(F.array(*(F.struct(F.lit(s).cast("long").alias("size"), F.col(f"covered_{s}").alias("covered")) for s in sizes))).alias("v"))
    selected = F.least(F.col("v.size"), F.col("vocabulary"))
    return long.select(
        "source", F.col("v.size").alias("size"), "vocabulary", selected.alias("selected"), F.lit(FIRST_TOKEN).cast("long").alias("first_token"), (FIRST_TOKEN + selected - 1).alias("last_token"),
        "total_occurrences", F.col("v.covered").alias("covered"), (F.col("total_occurrences") - F.col("v.covered")).alias("outside"), (F.col("v.covered") * 100.0 / F.col("total_occurrences")).alias("coverage"),
    )


def version_checks(rows: DataFrame) -> DataFrame:
    """Of rows of versions: whether as many words are selected as the size and the vocabulary allow, tokens are in their range, and
    no more is covered than there is."""
    return rows.select(
        "source", "size", (F.col("selected") == F.least("size", "vocabulary")).alias("selects_all"),
        ((F.col("first_token") == FIRST_TOKEN) & (F.col("last_token") == FIRST_TOKEN + F.col("selected") - 1) & (F.col("last_token") <= LAST_TOKEN)).alias("tokens_in_range"),
        ((F.col("covered") <= F.col("total_occurrences")) & (F.col("covered") + F.col("outside") == F.col("total_occurrences"))).alias("covered_in_total"),
    )


def cutoff_coverage(by_source: DataFrame, cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    """Cumulative coverage at the cutoffs; those beyond a vocabulary are left out."""
    return ranked(by_source).where(F.col("ranking").isin(*cutoffs)).select("source", F.col("ranking").alias("cutoff"), "cumulative_frequency", "coverage")


def cross_coverage(by_source: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """What the vocabularies of all sources together cover of each source and of all, by size.

    The ranks of all words are joined once to the sources' words; sizes are conditional sums. complete tells whether the
    vocabulary has as many words as its size asks for.
    """
    vocabulary = ranked(merged(by_source).withColumn("source", F.lit(ALL))).select("word", "ranking")
    joined = with_all(by_source).join(vocabulary, "word", "left")
    inside = [F.sum(F.when(F.col("ranking") <= s, F.col("frequency")).otherwise(0)).alias(f"c{s}") for s in sizes]
    words = [F.count_if(F.col("ranking") <= s).alias(f"w{s}") for s in sizes]
    wide = joined.groupBy("source").agg(F.count(F.lit(1)).alias("source_vocabulary"), F.sum("frequency").alias("total_occurrences"), *inside, *words)
    each = F.explode(F.array(*(F.struct(F.lit(s).cast("long").alias("size"), F.col(f"c{s}").alias("covered"), F.col(f"w{s}").alias("shared_words")) for s in sizes)))
    long = wide.select("source", "source_vocabulary", "total_occurrences", each.alias("v"))
    size = merged(by_source).agg(F.count(F.lit(1)).alias("all_words"))  # one row
    return long.join(F.broadcast(size)).select(
        "source", "v.size", "source_vocabulary", "total_occurrences", "v.covered", (F.col("total_occurrences") - F.col("v.covered")).alias("outside"), "v.shared_words",
        (F.col("v.covered") * 100.0 / F.col("total_occurrences")).alias("coverage"), (F.col("all_words") >= F.col("v.size")).alias("complete"),
    )


def comparison(by_source: DataFrame, sources: list[str], size: int) -> DataFrame:
    """The words of all sources' vocabulary, beside each listed source's frequency and rank; 0 where a source hasn't the word.

    One pivot of the sources' words, so the number of sources adds no joins.
    """
    every = top(merged(by_source).withColumn("source", F.lit(ALL)), size).select("ranking", "word", "frequency")
    ranks = ranked(by_source.where(F.col("source").isin(*sources))).groupBy("word").pivot("source", sources).agg(F.first("frequency").alias("frequency"), F.first("ranking").alias("ranking"))
    joined = every.join(ranks, "word", "left")
    filled = [F.coalesce(F.col(f"`{s}_frequency`"), F.lit(0)).alias(f"frequency_{i}") for i, s in enumerate(sources)] + [F.coalesce(F.col(f"`{s}_ranking`"), F.lit(0)).alias(f"ranking_{i}") for i, s in enumerate(sources)]
    return joined.select("ranking", "word", "frequency", *filled)


def shared_words(by_source: DataFrame, one: str, other: str) -> DataFrame:
    return _words(by_source, one).intersect(_words(by_source, other))


def missing_words(by_source: DataFrame, one: str, other: str) -> DataFrame:
    return _words(by_source, one).subtract(_words(by_source, other))


def all_words(by_source: DataFrame, one: str, other: str) -> DataFrame:
    return _words(by_source, one).union(_words(by_source, other)).distinct()


def _words(by_source: DataFrame, source: str) -> DataFrame:
    return by_source.where(F.col("source") == source).select("word")


def integrity(vocabulary: DataFrame) -> DataFrame:
    """Of each source: gaps and repeats in rankings, tokens outside the range, and ranks that rise with frequency.

    Continuity needs no order: the ranks are 1 to n exactly if the least is 1, the greatest n and all are distinct.
    """
    checked = vocabulary.withColumn("expected", FIRST_TOKEN + F.col("ranking") - 1)
    return checked.groupBy("source").agg(
        F.count(F.lit(1)).alias("words"), F.min("ranking").alias("first_rank"), F.max("ranking").alias("last_rank"),
        (F.count(F.lit(1)) - F.countDistinct("ranking")).alias("repeated_ranks"), (F.max("ranking") - F.min("ranking") + 1 - F.countDistinct("ranking")).alias("missing_ranks"),
        F.count_if(F.col("token") != F.col("expected")).alias("wrong_tokens"), F.count_if(~F.col("token").between(FIRST_TOKEN, LAST_TOKEN)).alias("tokens_out_of_range"),
    )


def rises(vocabulary: DataFrame) -> DataFrame:
    """Rows of a vocabulary whose frequency is greater than that of the rank before."""
    before = F.lag("frequency").over(Window.partitionBy("source").orderBy("ranking"))
    return vocabulary.withColumn("before", before).where(F.col("frequency") > F.col("before"))
