"""Language of texts and of their paragraphs, with a confidence.

A language gives each piece of a fixed public vocabulary a probability; the probability of a word is the sum over all ways to cut
it into pieces, found by a forward pass over all its letters. The probabilities are learned from a bounded sample of labelled texts
by expectation and maximisation over all cuts; texts whose paragraphs the first model gives to another language than their label
are left out of a second one. A paragraph has the language under which its words together are likeliest; a text has the language
of most of its words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass

LANGUAGES = ("es", "pt", "en", "fr", "it", "ca")
# Notations of the languages in labels, without case, accents and regions.
NOTATIONS = {
    "es": "es spa espanol spanish castellano castilian esp", "pt": "pt por portugues portuguese", "en": "en eng ingles english",
    "fr": "fr fra fre frances francais french", "it": "it ita italiano italian", "ca": "ca cat catalan catala",
}
BY_NOTATION = {n: code for code, names in NOTATIONS.items() for n in names.split()}
#: Labels that name no language.
UNKNOWN = frozenset("xx und n/d nd desconocido desconhecido unknown ? - none null mul zxx mis".split())
WORD = re.compile(r"[^\W\d_]+")
PARAGRAPH = re.compile(r"\n\s*\n")
START = "▁"
#: Words of more letters teach the model nothing; they are scored like all others.
LONGEST_TAUGHT = 64
#: Positions after which a forward pass is scaled, so that long words don't vanish.
SCALED = 24
#: Smallest probability of a piece; that of letters the vocabulary lacks.
FLOOR = 1e-7


def label_code(label: str | None) -> str | None:
    """The two-letter code a label names; '' if it names another language, None if it names none."""
    if label is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", label).lower() if not unicodedata.combining(c)).strip()
    if not plain or plain in UNKNOWN:
        return None
    return BY_NOTATION.get(plain) or BY_NOTATION.get(re.split(r"[-_ ]", plain)[0], "")


def public_pieces(path: str) -> list[str]:
    """The pieces of letters of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in found if re.fullmatch(f"{START}?[^\\W\\d_]*", p) and p)


def text_words(text: str) -> list[str]:
    return WORD.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())


class Arcs:
    """All pieces inside a list of words: where they start and end, grouped by end, for passes over all words at once."""

    def __init__(self, words: list[str], ids: dict[str, int], unknown: int, longest: int):
        self.n, self.longest = len(words), longest
        word, start, end, piece = [], [], [], []
        for w, text in enumerate(words):
            marked = START + text
            for s in range(len(marked)):
                for e in range(s + 1, min(len(marked), s + longest) + 1):
                    p = ids.get(marked[s:e])
                    if p is None:
                        if e > s + 1:
                            continue
                        p = unknown
                    word.append(w)
                    start.append(s)
                    end.append(e)
                    piece.append(p)
        order = np.lexsort((start, end)) if word else np.zeros(0, int)
        self.word, self.start, self.end, self.piece = (np.asarray(x, dtype=np.int64)[order] for x in (word, start, end, piece))
        self.last = np.array([len(text) + 1 for text in words], dtype=np.int64)
        self.size = int(self.last.max()) + 1 if words else 1
        self.bounds = np.searchsorted(self.end, np.arange(self.size + 1))

    def forward(self, probabilities: np.ndarray, scaled: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """alpha[language, word, position], from probabilities[language, piece]; and, if scaled, the logarithm of what each
        word's later positions were divided by."""
        k = probabilities.shape[0]
        alpha = np.zeros((k, self.n * self.size))
        whole, logs = alpha.reshape(k, self.n, self.size), np.zeros((k, self.n))
        whole[:, :, 0] = 1.0
        arcs = probabilities[:, self.piece]
        source, target = self.word * self.size + self.start, self.word * self.size + self.end
        for e in range(1, self.size):
            a, b = self.bounds[e], self.bounds[e + 1]
            if a < b:
                np.add.at(alpha, (slice(None), target[a:b]), alpha[:, source[a:b]] * arcs[:, a:b])
            if scaled and e % SCALED == 0:
                goes_on, since = np.flatnonzero(self.last > e), max(0, e - self.longest)
                by = whole[:, goes_on, since : e + 1].max(axis=2)
                by = np.where(by > 0, by, 1.0)
                whole[:, goes_on, since : e + 1] /= by[:, :, None]
                logs[:, goes_on] += np.log(by)
        return whole, logs

    def log_likelihoods(self, probabilities: np.ndarray) -> np.ndarray:
        """By word and language, the logarithm of the sum over all segmentations."""
        alpha, logs = self.forward(probabilities, scaled=True)
        return (np.log(np.maximum(alpha[:, np.arange(self.n), self.last], 1e-300)) + logs).T

    def expected(self, probabilities: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by one language, summed over all segmentations of all words."""
        alpha = self.forward(probabilities[None])[0][0]
        beta = np.zeros((self.n, self.size))
        beta[np.arange(self.n), self.last] = 1.0
        arcs = probabilities[self.piece]
        order = np.argsort(-self.start, kind="stable")
        starts = self.start[order]
        for s in range(self.size - 1, -1, -1):
            a, b = np.searchsorted(-starts, (-s, -s + 1))
            pick = order[a:b]
            np.add.at(beta, (self.word[pick], self.start[pick]), arcs[pick] * beta[self.word[pick], self.end[pick]])
        whole = np.maximum(alpha[np.arange(self.n), self.last], 1e-300)
        uses = alpha[self.word, self.start] * arcs * beta[self.word, self.end] / whole[self.word] * counts[self.word]
        return np.bincount(self.piece, uses, len(probabilities))


class Model:
    """Piece probabilities of each language and its most common words; small, its size is that of the public vocabulary."""

    def __init__(self, pieces: list[str], probabilities: np.ndarray, common: dict[str, set[str]]):
        self.pieces, self.probabilities, self.common = pieces, probabilities, common
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        #: How much the mean evidence of a word counts, so that confidences are as often right as they say; see calibrated.
        self.sharpness = 1.0


def _train(samples: dict[str, Counter], pieces: list[str], rounds: int) -> Model:
    ids = {p: i for i, p in enumerate(pieces)}
    unknown, k, longest = len(pieces), len(LANGUAGES), max(map(len, pieces), default=1)
    table = np.full((k, len(pieces) + 1), FLOOR)
    for i, language in enumerate(LANGUAGES):
        counts = samples.get(language) or Counter()
        if not counts:
            continue
        words = [w for w in counts if len(w) <= LONGEST_TAUGHT]
        arcs, n = Arcs(words, ids, unknown, longest), np.array([counts[w] for w in words], dtype=float)
        p = np.full(len(pieces) + 1, 1.0 / (len(pieces) + 1))
        for _ in range(rounds):
            uses = arcs.expected(p, n)
            p = np.maximum((uses + 0.01) / (uses.sum() + 0.01 * len(uses)), FLOOR)
        p[unknown] = FLOOR
        table[i] = p
    common = {language: {w for w, _ in (samples.get(language) or Counter()).most_common(60)} for language in LANGUAGES}
    return Model(pieces, table, common)


def train(rows: list[tuple[str, str]], pieces: list[str], rounds: int = 6) -> Model:
    """A model of rows (label code, text); the second pass leaves out paragraphs that the first gives to another language."""
    paragraphs = [(code, text_words(p)) for code, text in rows for p in PARAGRAPH.split(text or "")]
    first: dict[str, Counter] = defaultdict(Counter)
    for code, words in paragraphs:
        first[code].update(words)
    scorer = Scorer(_train(first, pieces, rounds))
    second: dict[str, Counter] = defaultdict(Counter)
    scores = scorer.sums([words for _, words in paragraphs])
    for (code, words), row in zip(paragraphs, scores):
        if words and LANGUAGES[int(row.argmax())] == code:
            second[code].update(words)
    model = _train({c: second[c] or first[c] for c in first}, pieces, rounds)
    model.sharpness = calibrated(Scorer(model), [(LANGUAGES.index(code), words) for code, words in paragraphs if len(words) >= 3])
    return model


def calibrated(scorer: Scorer, paragraphs: list[tuple[int, list[str]]]) -> float:
    """The sharpness under which the labels of the paragraphs are likeliest; wrong labels and odd paragraphs lower it."""
    if not paragraphs:
        return 1.0
    mean = scorer.sums([words for _, words in paragraphs]) / np.array([[len(words)] for _, words in paragraphs])
    truth = np.array([code for code, _ in paragraphs])
    mean -= mean.max(axis=1, keepdims=True)
    grid = np.geomspace(0.25, 64, 33)
    return float(max(grid, key=lambda b: float((b * mean[np.arange(len(truth)), truth] - np.log(np.exp(b * mean).sum(axis=1))).mean())))


class Scorer:
    """Sums of log-likelihoods of lists of words; each distinct word is scored once in a task."""

    def __init__(self, model: Model, held: int = 300_000):
        self.model, self.held = model, held
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, len(LANGUAGES)))

    def _learn(self, words: set[str]) -> None:
        new = sorted(words, key=len)
        a = 0
        while a < len(new):
            b = a + 1
            while b < len(new) and b - a < 4096 and (b - a + 1) * (len(new[b]) + 2) <= 100_000:
                b += 1
            part, a = new[a:b], b
            n = len(self.at)
            if n + len(part) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), len(part)), len(LANGUAGES)))])
            self.rows[n : n + len(part)] = Arcs(part, self.model.ids, len(self.model.pieces), self.model.longest).log_likelihoods(self.model.probabilities)
            self.at.update(zip(part, range(n, n + len(part))))

    def sums(self, lists: list[list[str]]) -> np.ndarray:
        distinct = {w for words in lists for w in words}
        missing = distinct - self.at.keys()
        if missing:
            if len(self.at) + len(missing) > self.held:
                self.at.clear()
                missing = distinct
            self._learn(missing)
        at = self.at
        flat = self.rows[[at[w] for words in lists for w in words]] if distinct else np.zeros((0, len(LANGUAGES)))
        sums = np.concatenate([np.zeros((1, len(LANGUAGES))), np.cumsum(flat, axis=0)])
        ends = np.cumsum([len(words) for words in lists])
        starts = np.concatenate([[0], ends[:-1]]).astype(int) if lists else np.zeros(0, int)
        return sums[ends] - sums[starts] if lists else np.zeros((0, len(LANGUAGES)))


def confidence(row: np.ndarray, words: int, sharpness: float) -> float:
    """Probability of the best language by the mean evidence of the words, all languages being as likely before."""
    mean = sharpness * (row - row.max()) / max(words, 1)
    return float(1.0 / np.exp(mean).sum())


def sampled(labelled: DataFrame, key: str, code: str, text: str, per_language: int, characters: int = 20_000) -> list[tuple[str, str]]:
    """Up to about per_language rows (code, text) of each language, chosen by the hash of the key: a bounded sample for training.

    Of a longer text the first `characters` teach the model; what is judged later is always whole.
    """
    sizes = {r[0]: r[1] for r in labelled.groupBy(code).count().collect() if r[0] in LANGUAGES}
    share = F.lit(0.0)
    for language, n in sizes.items():
        share = F.when(F.col(code) == language, min(1.0, per_language / n)).otherwise(share)
    draw = F.pmod(F.xxhash64(key), F.lit(1_000_000)) / 1_000_000
    rows = labelled.where(F.col(code).isin(*LANGUAGES) & (draw < share)).select(code, F.substring(text, 1, characters).alias(text))
    return [(r[0], r[1]) for r in rows.toLocalIterator()]


def _carried(rows: DataFrame, carry: tuple[str, ...]) -> str:
    return "".join(f"{c} {rows.schema[c].dataType.simpleString().replace('bigint', 'long')}, " for c in carry)


def document_languages(documents: DataFrame, model: Model, prior: float = 2.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (document_id, *carry, segment_no, language, main, confidence, words, running) of texts and their paragraphs.

    documents: document_id, text, label (a code, '' or null), and simple columns to carry. Segment 0 is the whole text with its main
    language; paragraphs, parted by blank lines, count from 1. A label counts as evidence of `prior`, which only near ties feel; the
    confidence leaves it out. running says whether common words of its language show that the paragraph is running text. Null
    texts, and texts or paragraphs without words, have no rows; a null document_id stays null.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(shared.value)

        def step(batch: pa.RecordBatch):
            columns = [c.to_pylist() for c in batch.columns]
            for a in range(0, len(columns[0]), 512):
                texts, labels, *keys = (c[a : a + 512] for c in columns)
                yield _judge(scorer, list(zip(*keys)), texts, labels, prior)

        return step

    rows = documents.where("text is not null").select("text", "label", "document_id", *carry)
    return arrow_pass(rows, f"document_id string, {_carried(rows, carry)}segment_no int, language string, main string, confidence double, words int, running boolean", start)


def _judge(scorer: Scorer, keys: list[tuple], texts: list, labels: list, prior: float) -> list[list]:
    out: list[list] = [[] for _ in range(6 + (len(keys[0]) if keys else 0))]
    paragraphs = [[p for p in PARAGRAPH.split(t.replace("\r\n", "\n").replace("\r", "\n")) if p.strip()] for t in texts]
    lists = [text_words(p) for ps in paragraphs for p in ps]
    scores, k, sharp = scorer.sums(lists), 0, scorer.model.sharpness
    for key, label, ps in zip(keys, labels, paragraphs):
        plain, n = scores[k : k + len(ps)], [len(w) for w in lists[k : k + len(ps)]]
        words = lists[k : k + len(ps)]
        k += len(ps)
        if not sum(n):
            continue
        sums = plain.copy()
        if label in LANGUAGES:
            sums[:, LANGUAGES.index(label)] += prior
        best = sums.argmax(axis=1)
        share = np.bincount(best, n, len(LANGUAGES))
        main = int(max(range(len(LANGUAGES)), key=lambda i: (share[i], sums[:, i].sum())))
        mine = best == main
        rows = [(0, main, confidence(plain[mine].sum(axis=0), sum(m for m, x in zip(n, mine) if x), sharp), sum(n), True)]
        for s, (i, row, m, w) in enumerate(zip(best, plain, n, words), 1):
            if m:
                common = scorer.model.common[LANGUAGES[i]]
                rows.append((s, int(i), confidence(row, m, sharp), m, m >= 6 and sum(x in common for x in w) >= 0.15 * m))
        for s, i, c, m, running in rows:
            for column, value in zip(out, (*key, s, LANGUAGES[i], LANGUAGES[main], c, m, running)):
                column.append(value)
    return out


def record_languages(records: DataFrame, model: Model, key: str = "identifier", prior: float = 2.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (key, *carry, shown, confidence, words) of short texts, one for each row of records: key, text, label, columns to carry.

    shown is the language; null, with no confidence, where there are no words.
    """
    shared = records.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(shared.value)
        sharp = scorer.model.sharpness

        def step(batch: pa.RecordBatch):
            texts, labels, *keys = (c.to_pylist() for c in batch.columns)
            for a in range(0, len(texts), 4096):
                lists = [text_words(t or "") for t in texts[a : a + 4096]]
                out: list[list] = [[], [], []]
                for label, words, row in zip(labels[a : a + 4096], lists, scorer.sums(lists)):
                    if words:
                        sure = confidence(row, len(words), sharp)
                        if label in LANGUAGES:
                            row[LANGUAGES.index(label)] += prior
                    for column, value in zip(out, (LANGUAGES[int(row.argmax())], sure, len(words)) if words else (None, None, 0)):
                        column.append(value)
                yield [*(c[a : a + 4096] for c in keys), *out]

        return step

    rows = records.select("text", "label", F.col(key).alias("key"), *carry)
    return arrow_pass(rows, f"key string, {_carried(rows, carry)}shown string, confidence double, words int", start).withColumnRenamed("key", key)


def codes(column: str):
    """label_code of a column, as an expression."""
    plain = F.trim(F.translate(F.lower(column), "áéíóúñçãàèêô", "aeiouncaaeeo"))
    head = F.split(plain, "[-_ ]")[0]
    known = F.create_map(*[F.lit(x) for pair in BY_NOTATION.items() for x in pair])
    code = F.coalesce(F.element_at(known, plain), F.element_at(known, head), F.lit(""))
    return F.when(F.col(column).isNull() | (plain == "") | plain.isin(*UNKNOWN), None).otherwise(code)
