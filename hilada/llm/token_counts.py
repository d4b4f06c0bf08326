"""Tokens of each document under an existing tokenizer, from tries over the distinct pieces of the corpus.

A text is cut into pieces (runs of letters, numbers and underscores) and single code points between them. The tokenizer works on
each piece alone, so each distinct piece is tokenized once: the distinct pieces are parted by their first letters, sorted, and
walked as a trie; the state of the tokenizer is kept for each prefix on the path and goes on from there for the next piece.
The ends of the pieces give terminal counts, which are joined to the documents.
"""

from __future__ import annotations

import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, written
from .term_counts import HELD, RUN, WORD

#: Code points that are no tokens.
BLANK = " \t\n\r\u00a0"
#: Letters by which pieces are parted among tries; so many that no part is large, as a part's pieces differ behind them.
ROUTE = 5


class VocabularyTokenizer:
    """A piece that is listed is one token; of any other piece each code point is one.

    The state after a prefix is (node of the vocabulary's trie or None, code points so far); step and count never look back.
    """

    def __init__(self, vocabulary: list[str]):
        self.root: dict = {}
        for word in vocabulary:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = True

    def start(self) -> tuple:
        return self.root, 0

    def step(self, state: tuple, letter: str) -> tuple:
        node, n = state
        return (node.get(letter) if node else None), n + 1

    def count(self, state: tuple) -> int:
        node, n = state
        return 1 if node and "" in node else n


def _normal(text: str) -> str:
    return (text if text.isascii() else unicodedata.normalize("NFC", text)).lower()


def distinct_pieces(texts: DataFrame) -> DataFrame:
    """Each distinct piece of the column text, once."""

    def start():
        held: set[str] = set()

        def step(batch: pa.RecordBatch | None):
            if batch is not None:
                for t in batch.column(0).to_pylist():
                    held.update(RUN.findall(_normal(t)))
            if held and (batch is None or len(held) > HELD):
                yield [list(held)]
                held.clear()

        return step

    return arrow_pass(texts.where("text is not null").select("text"), "piece string", start, flush=True).distinct()


def terminal_counts(pieces: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Rows (piece, code_points, n_tokens) by one walk along the sorted pieces of each trie."""

    def start():
        tokenizer = VocabularyTokenizer(vocabulary)
        path, states = [""], [tokenizer.start()]

        def step(batch: pa.RecordBatch):
            found = batch.column(0).to_pylist()
            counts = []
            for piece in found:
                before, shared = path[0], 0
                while shared < min(len(before), len(piece)) and before[shared] == piece[shared]:
                    shared += 1
                del states[shared + 1 :]
                for letter in piece[shared:]:
                    states.append(tokenizer.step(states[-1], letter))
                path[0] = piece
                counts.append(tokenizer.count(states[-1]))
            yield [found, [len(p) for p in found], counts]

        return step

    parted = pieces.repartition(F.substring("piece", 1, ROUTE)).sortWithinPartitions("piece")
    return arrow_pass(parted, "piece string, code_points int, n_tokens int", start)


def token_counts(documents: DataFrame, vocabulary: DataFrame, key: str = "doc_id", text: str = "text", broadcast_rows: int = 200_000) -> DataFrame:
    """Rows (key, n_tokens): one for each row of documents; a null or empty text has 0 tokens.

    Text is NFC-normalized and lower-cased. A listed word is one token, every other code point is one, blanks are none. Only
    pieces whose tokens aren't just their code points need to reach the documents; these are words of the vocabulary. Up to
    `broadcast_rows` of them (the size is counted) go to all tasks, beyond that documents' pieces are joined by a shuffle and
    summed for each row by its number: the rows are the same either way, also where a key is null or comes twice.
    Words listed twice, null words and words of one letter or other characters change nothing.
    """
    listed = [r.word for r in vocabulary.where("word is not null").select("word").distinct().collect()]  # a tokenizer's vocabulary: its size is fixed
    listed = [w for w in listed if WORD.fullmatch(w)]
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString().replace("bigint", "long")
    terminal = written(terminal_counts(distinct_pieces(rows), listed).where("n_tokens != code_points"))
    if terminal.count() <= broadcast_rows:
        shared = rows.sparkSession.sparkContext.broadcast({r.piece: r.n_tokens for r in terminal.collect()})

        def start():
            ends = shared.value

            def step(batch: pa.RecordBatch):
                counts = []
                for t in batch.column(1).to_pylist():
                    n = 0
                    if t:
                        t = _normal(t)
                        n = len(t) - sum(map(t.count, BLANK))
                        for piece, times in Counter(RUN.findall(t)).items():
                            if (end := ends.get(piece)) is not None:
                                n -= times * (len(piece) - end)
                    counts.append(n)
                yield [batch.column(0), counts]

            return step

        return arrow_pass(rows, f"key {kind}, n_tokens long", start).withColumnRenamed("key", key)

    def pieces_of():
        def step(batch: pa.RecordBatch):
            out: list[list] = [[], [], [], []]
            for k, t, number in zip(*(c.to_pylist() for c in batch.columns)):
                t = _normal(t or "")
                counted = Counter(RUN.findall(t))
                rest = len(t) - sum(map(t.count, BLANK)) - sum(len(p) * n for p, n in counted.items())
                out[0] += [k] * (len(counted) + 1)
                out[1] += ["", *counted]
                out[2] += [rest, *counted.values()]
                out[3] += [number] * (len(counted) + 1)
            yield out

        return step

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    pieces = arrow_pass(numbered, f"key {kind}, piece string, n long, row long", pieces_of)
    tokens = F.when(F.col("piece") == "", F.col("n")).otherwise(F.col("n") * F.coalesce("n_tokens", F.length("piece")))
    return pieces.join(terminal, "piece", "left").groupBy("row").agg(F.first("key").alias("key"), F.sum(tokens).alias("n_tokens")).select(F.col("key").alias(key), "n_tokens")


def token_totals(counts: DataFrame, documents: DataFrame, state: DataFrame) -> DataFrame:
    """Totals of documents and tokens by (source_code, language, thematic_domain), also where document.word_count is unusable.

    counts: doc_id, n_tokens. documents: doc_id, document_id, source, lang. state: newest rows of document with thematic_domain.
    The domain is lower-cased and trimmed; what is not known is null and makes a slice of its own.
    """
    domain = F.nullif(F.lower(F.trim("thematic_domain")), F.lit(""))
    known = documents.select("doc_id", "document_id", F.col("source").alias("source_code"), F.col("lang").alias("language"))
    sliced = counts.join(known, "doc_id").join(state.select("document_id", domain.alias("thematic_domain")), "document_id", "left")
    return sliced.groupBy("source_code", "language", "thematic_domain").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_tokens").alias("n_tokens"))
