"""Statistics of each text, and fixed thresholds that tell natural text from lists, tables and junk.

Statistics are array operations over the code points of many texts at once. PUBLISHED holds rules and thresholds of published
filters for web text (mean word length, words that have a letter, symbols to words, lines that begin with a bullet or end in an
ellipsis, repeated lines); OWN holds rules of this library, whose thresholds were chosen on Spanish text. Each rule that a text
fails is recorded by name. The common words of a language are those that many texts claimed to be in it have, so any language of
the corpus is known.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, written
from .vectors import CLOSING, CONTROL, DIGIT, INVERSE, LETTER, NUMBER, NUMERIC, PLAIN, SENTENCE, SPACE, UPPER, Counts, Texts, groups, once_each

PAGE_MARKS = re.compile(r"\[\[P[ÁA]GINA\s+\d+\]\]", re.I)
# Signs that open an entry of a list, that end a line of prose, and the three forms of an ellipsis' end.
BULLETS = np.array([ord(c) for c in "-*•·–"])
LINE_CLOSERS = np.array([ord(c) for c in ".!?…:;»”\""])
MEASURES = {
    "character_count": "long", "word_count": "long", "line_count": "long", "non_empty_line_count": "long", "replacement_character_count": "long", "null_character_count": "long",
    "control_character_count": "long", "page_marker_count": "long", "hyphenated_line_break_count": "long", "long_line_count": "long", "symbol_ratio": "double", "numeric_line_ratio": "double",
    "repeated_line_ratio": "double", "uppercase_line_ratio": "double", "short_line_ratio": "double", "mean_word_length": "double", "digit_ratio": "double", "punctuated_line_ratio": "double",
    "bullet_line_ratio": "double", "ellipsis_line_ratio": "double", "alphabetic_word_ratio": "double", "common_word_ratio": "double", "sentences_per_100_words": "double",
}
#: By rule: the measure, the least and the greatest value of natural text.
PUBLISHED = {
    "mean word length": ("mean_word_length", 3.0, 10.0),
    "symbols": ("symbol_ratio", 0.0, 0.1),
    "words without letters": ("alphabetic_word_ratio", 0.8, 1.0),
    "bullets": ("bullet_line_ratio", 0.0, 0.9),
    "ellipses": ("ellipsis_line_ratio", 0.0, 0.3),
}
OWN = {
    "digits": ("digit_ratio", 0.0, 0.2),
    "repeated lines": ("repeated_line_ratio", 0.0, 0.5),
    "numeric lines": ("numeric_line_ratio", 0.0, 0.3),
    "common words": ("common_word_ratio", 0.12, 1.0),
    "too few sentences": ("sentences_per_100_words", 2.5, 1e9),
    "too many sentence ends": ("sentences_per_100_words", 0.0, 16.0),
}
RULES = PUBLISHED | OWN
#: A text of fewer lines says little by the share of its lines that are equal.
LEAST_LINES = 3


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def measured(t: Texts, languages: list[str | None], common: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The values of MEASURES by name, each an array over the texts; ratios are 0 where there is nothing to divide by.

    common: by language, hashes of its common words. A text is measured by those of the language that fits best, as claims may be
    wrong; where it claims a language of which no words are known the ratio is NaN.
    """
    codes, letter, space = t.codes, t.has(LETTER), t.has(SPACE)
    owner, hashes, starts, word_ends = t.words()
    words, letters = t.count(owner), t.count(owner, word_ends - starts)
    line, first, last = t.lines()
    full = last > first
    line_count, (line, first, last) = t.count(line), (line[full], first[full], last[full])
    n, long = t.count(line), last - first

    def in_line(mask: np.ndarray) -> np.ndarray:
        return t.within(mask, first, last)

    def share(test: np.ndarray) -> np.ndarray:
        return _divided(t.count(line, test), n)

    def sign(k: int) -> np.ndarray:
        """The code point k places into each line, 0 behind its end."""
        return np.where(first + k < last, codes[np.minimum(first + k, len(codes) - 1)], 0)

    line_letters, line_numbers = in_line(letter), in_line(t.has(NUMBER))
    upper = (line_letters >= 5) & (in_line(t.has(UPPER)) >= 0.9 * line_letters)
    numeric = (line_letters == 0) & (line_numbers > 0) & (in_line(t.has(NUMERIC)) == long)
    counted = np.flatnonzero(long >= 5)
    keys = t.hashes(codes, first[counted], last[counted]) ^ (line[counted].astype(np.uint64) * np.uint64(INVERSE)).view(np.int64)
    _, same, times = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = t.count(line[counted], times[same] >= 3)
    c0, c1, c2, c3, c4 = (sign(k) for k in range(5))
    is_digit = lambda c: (c >= 48) & (c <= 57)
    blank = lambda c: (c == 32) | (c == 9) | (c == 0xA0)
    stop = lambda c: (c == 46) | (c == 41)
    bullet = np.isin(c0, BULLETS) & blank(c1) | (is_digit(c0) | (c0 >= 97) & (c0 <= 122)) & stop(c1) & blank(c2)
    bullet |= is_digit(c0) & is_digit(c1) & (stop(c2) & blank(c3) | is_digit(c2) & stop(c3) & blank(c4))
    end = codes[np.maximum(last - 1, 0)] if len(codes) else codes
    dots = (end == 46) & (long >= 3) & (codes[np.maximum(last - 2, 0)] == 46) & (codes[np.maximum(last - 3, 0)] == 46)
    after = np.concatenate([codes[1:], [10]])
    sentence = t.has(SENTENCE) & np.concatenate([t.has(CLOSING)[1:], [True]])
    then, third = np.concatenate([codes[2:], [0, 0]])[: len(codes)], np.concatenate([codes[3:], [0, 0, 0]])[: len(codes)]
    broken = letter & (after == 45) & ((then == 10) | (then == 13) & (third == 10))
    broken[np.maximum(t.ends - 2, 0)] &= t.lengths < 2  # the line end behind a text isn't its own
    token_start, token_end = t.runs(~space)
    token = t.owner(token_start)
    alphabetic = _divided(t.count(token, np.searchsorted(starts, token_end) > np.searchsorted(word_ends, token_start, "right")), t.count(token))
    every = np.unique(np.concatenate([np.zeros(0, np.int64), *common.values()]))
    place = np.minimum(np.searchsorted(every, hashes), max(len(every) - 1, 0))
    hit = np.flatnonzero(every[place] == hashes) if len(every) else place[:0]
    best = np.max([_divided(t.count(owner[hit], np.isin(every, found)[place[hit]]), words) for found in common.values()], axis=0) if common else np.full(t.n, np.nan)
    known = np.array([not l or l in common for l in languages], bool)
    count = lambda mask: t.within(mask, t.starts, t.ends)
    return {
        "character_count": t.lengths, "word_count": words, "line_count": line_count, "non_empty_line_count": n, "replacement_character_count": count(codes == 0xFFFD), "null_character_count": count(codes == 0),
        "control_character_count": count(t.has(CONTROL)), "page_marker_count": np.array([len(PAGE_MARKS.findall(x)) if "[[" in x else 0 for x in t.texts]), "hyphenated_line_break_count": count(broken),
        "long_line_count": t.count(line, long > 400), "symbol_ratio": _divided(count(~t.has(PLAIN)), t.lengths), "numeric_line_ratio": share(numeric), "repeated_line_ratio": _divided(repeated, n),
        "uppercase_line_ratio": share(upper), "short_line_ratio": share(long <= 25), "mean_word_length": _divided(letters, words), "digit_ratio": _divided(count(t.has(DIGIT)), t.lengths),
        "punctuated_line_ratio": share(np.isin(end, LINE_CLOSERS)), "bullet_line_ratio": share(bullet), "ellipsis_line_ratio": share((end == 0x2026) | dots), "alphabetic_word_ratio": alphabetic,
        "common_word_ratio": np.where(known, best, np.nan), "sentences_per_100_words": _divided(100 * count(sentence), words),
    }


def failed(values: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """By rule, which texts fail it. Empty and blank texts fail none; a rule whose measure isn't known is not failed."""
    out = {}
    some = values["non_empty_line_count"] > 0
    for rule, (measure, least, most) in RULES.items():
        v = values[measure]
        out[rule] = some & ((v < least) | (v > most))
        if measure == "repeated_line_ratio":
            out[rule] &= values["non_empty_line_count"] >= LEAST_LINES
    return out


def _rows(documents: DataFrame, key: str, text: str, lang: str) -> tuple[DataFrame, str]:
    language = F.col(lang) if lang in documents.columns else F.lit(None)
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), language.cast("string").alias("lang"))
    return rows, rows.schema["key"].dataType.simpleString().replace("bigint", "long")


def common_words(documents: DataFrame, text: str = "text", lang: str = "lang", share: float = 0.25, least: int = 2) -> dict[str, np.ndarray]:
    """By language, sorted hashes of the words that at least `share` of the texts claiming it have, and `least` of them.

    Counts cover all texts. A language has at most (mean number of distinct words of its texts) / share such words, which bounds
    what comes to the driver.
    """
    rows, _ = _rows(documents, text, text, lang)

    def start():
        held: dict[str, Counts] = {}
        texts_of: dict[str, int] = {}

        def step(batch: pa.RecordBatch | None):
            if batch is None:
                for language, counts in held.items():
                    keys, n = counts.result()
                    yield [[language] * (len(keys) + 1), pa.array(np.append(keys, 0), mask=np.append(np.zeros(len(keys), bool), True)), np.append(n, texts_of[language])]
                return
            texts, languages = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in groups(texts):
                t = Texts(texts[a:b])
                owner, hashes, _, _ = t.words()
                one = once_each(owner, hashes)
                owner, hashes = owner[one], hashes[one]
                of = np.array(languages[a:b], dtype=object)
                for language in set(languages[a:b]) - {None, ""}:
                    mine = of == language
                    texts_of[language] = texts_of.get(language, 0) + int(mine.sum())
                    held.setdefault(language, Counts()).add(hashes[mine[owner]])

        return step

    counted = arrow_pass(rows.where("text != ''").select("text", "lang"), "lang string, word long, n long", start, flush=True).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    frequent = written(counted.where(F.col("n") >= least))  # read twice below
    small = frequent.where("word is null").select("lang", F.col("n").alias("texts"))  # a row for each language
    kept = frequent.where("word is not null").join(F.broadcast(small), "lang").where(F.col("n") >= share * F.col("texts"))
    found: dict[str, list[int]] = {}
    for r in kept.select("lang", "word").collect():
        found.setdefault(r.lang, []).append(r.word)
    return {language: np.sort(np.array(words, np.int64)) for language, words in found.items()}


def _judging(common: dict[str, np.ndarray]):
    """For batches (key, text, lang): yields keys, measures and failed rules of a few texts at a time."""

    def judged(batch: pa.RecordBatch):
        keys, texts, languages = (c.to_pylist() for c in batch.columns)
        for a, b in groups(texts):
            values = measured(Texts(texts[a:b]), languages[a:b], common)
            yield keys[a:b], values, failed(values)

    return judged


def _names(rules: dict[str, np.ndarray], i: int) -> list[str]:
    return [rule for rule, mask in rules.items() if mask[i]]


def text_statistics(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", common: dict[str, np.ndarray] | None = None) -> DataFrame:
    """One row for each row of documents: key, the measures, and `failures`, the rules it fails. A null text counts as empty.

    Without a column `lang` no text claims a language. A common_word_ratio that can't be told is null.
    """
    rows, kind = _rows(documents, key, text, lang)
    shared = documents.sparkSession.sparkContext.broadcast(common if common is not None else common_words(documents, text, lang))

    def start():
        judged = _judging(shared.value)

        def step(batch: pa.RecordBatch):
            for keys, values, rules in judged(batch):
                columns = [pa.array(v, mask=np.isnan(v)) if MEASURES[m] == "double" else v.astype(np.int64) for m, v in values.items()]
                yield [keys, *columns, [_names(rules, i) for i in range(len(keys))]]

        return step

    schema = ", ".join([f"key {kind}", *(f"{m} {t}" for m, t in MEASURES.items()), "failures array<string>"])
    return arrow_pass(rows, schema, start).withColumnRenamed("key", key)


def unnatural(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", common: dict[str, np.ndarray] | None = None) -> DataFrame:
    """Rows (key, failures) of texts that fail a rule, as text_statistics has them. Only these leave the tasks."""
    rows, kind = _rows(documents, key, text, lang)
    shared = documents.sparkSession.sparkContext.broadcast(common if common is not None else common_words(documents, text, lang))

    def start():
        judged = _judging(shared.value)

        def step(batch: pa.RecordBatch):
            for keys, _, rules in judged(batch):
                bad = np.flatnonzero(np.any(list(rules.values()), axis=0))
                yield [[keys[i] for i in bad], [_names(rules, i) for i in bad]]

        return step

    return arrow_pass(rows.where("text != ''"), f"key {kind}, failures array<string>", start).withColumnRenamed("key", key)
