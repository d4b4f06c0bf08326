"""Subject areas of texts, by a seeded non-negative factorization of the document-term matrix.

Each area is one component, anchored: its terms start from the area's description, from texts labelled by hand and from texts
whose records name the area. Further components, one for each language, hold what belongs to no area. Documents and terms
are then updated in turn (multiplicative updates for the Kullback-Leibler divergence): document weights are a local computation
given the term weights, which are small enough to be sent to all tasks; term weights are sums over all documents. The mixture
of a document over the area components, normalized, is what its specific matter consists of.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, salted_join, written
from .mojibake import BAD, CORE
from .vectors import Counts, Texts, groups

#: Letters of the shortest term.
SHORTEST = 3
HYPHEN = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n\s*(?=[^\W\d_])")
#: Claimed languages that have a component of their own; all others share the last.
GROUNDS = ("es", "pt", "en", "fr", "it", "ca", "")
EPSILON = 1e-9


def plain(text: str) -> str:
    """A text in NFC with words joined at line ends; words with damaged letters say nothing and are left out."""
    if not text.isascii() and BAD.search(text):
        text = CORE.sub(lambda m: " " if BAD.search(m[0]) else m[0], text)
    if "-" in text:
        text = HYPHEN.sub("", text)
    return text if text.isascii() else unicodedata.normalize("NFC", text)


def terms(text: str) -> set[int]:
    """The hashes of the words of three letters or more, without regard to case."""
    return set(Texts([plain(text)]).words(SHORTEST)[1].tolist())


def hashed_matrix(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, ground, length, terms, counts) with the hashes of all terms of each text, how often it has them, the component
    of its claimed language and its code points. The texts are cut into terms here only."""

    def start():
        def step(batch: pa.RecordBatch):
            ids, languages, texts = (c.to_pylist() for c in batch.columns)
            for a, b in groups([t or "" for t in texts]):
                part = [t or "" for t in texts[a:b]]
                owner, hashes, _, _ = Texts([plain(t) for t in part]).words(SHORTEST)
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])])) if len(owner) else np.zeros(0, int)
                counts = np.diff(np.append(first, len(owner))).astype(np.int32)
                offsets = pa.array(np.searchsorted(owner[first], np.arange(b - a + 1)), pa.int32())
                ground = [GROUNDS.index(l) if l in GROUNDS else len(GROUNDS) - 1 for l in languages[a:b]]
                yield [ids[a:b], ground, [len(t) for t in part], pa.ListArray.from_arrays(offsets, pa.array(hashes[first])), pa.ListArray.from_arrays(offsets, pa.array(counts))]

        return step

    return arrow_pass(documents.select("doc_id", "lang", "text"), "doc_id long, ground int, length long, terms array<long>, counts array<int>", start)


def vocabulary(hashed: DataFrame, least_share: float = 0.0003, least: int = 3, bound: int = 200_000) -> np.ndarray:
    """Sorted hashes of the terms that, in some claimed language, at least least_share of the texts have, and `least` of them.

    Common words stay: they belong to the ground components. As a text has some hundred distinct terms, a least share bounds their
    number whatever the corpus' size. `bound` is the size of the model: if more terms pass, the share rises until no more do, so
    that the most widespread terms of each language are known.
    """

    def start():
        held = [Counts() for _ in GROUNDS]
        texts = np.zeros(len(GROUNDS), np.int64)

        def step(batch: pa.RecordBatch | None):
            if batch is None:
                for g, counts in enumerate(held):
                    keys, n = counts.result()
                    if texts[g]:
                        yield [np.full(len(keys) + 1, g, np.int32), pa.array(np.append(keys, 0), mask=np.append(np.zeros(len(keys), bool), True)), np.append(n, texts[g])]
                return
            ground, lists = np.asarray(batch.column("ground")), batch.column("terms")
            lengths = np.diff(np.asarray(lists.offsets))
            keys, of = np.asarray(lists.flatten()), np.repeat(ground, lengths)
            for g in np.unique(ground):
                texts[g] += int(((ground == g) & (lengths > 0)).sum())
                held[g].add(keys[of == g])

        return step

    counted = arrow_pass(few(hashed.select("ground", "terms")), "ground int, term long, n long", start, flush=True).groupBy("ground", "term").agg(F.sum("n").alias("n"))
    counted = written(counted)
    sizes = {r.ground: r.n for r in counted.where("term is null").collect()}
    texts = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("ground")) if sizes else F.lit(1)
    shared = counted.where(F.col("term").isNotNull() & (F.col("n") >= least)).groupBy("term").agg(F.max(F.col("n") / texts).alias("share")).where(F.col("share") >= least_share)
    shared = written(shared)
    number = shared.count()
    if number > bound:
        at = shared.approxQuantile("share", [1 - 0.98 * bound / number], 0.001)[0]
        shared = shared.where(F.col("share") > at)
    return np.sort(np.asarray(shared.select("term").toArrow().column("term")).astype(np.int64))


def matrix(hashed: DataFrame, words: np.ndarray) -> DataFrame:
    """hashed_matrix with places in `words` in place of hashes; terms that aren't there are left out."""
    shared = hashed.sparkSession.sparkContext.broadcast(words)

    def start():
        known = shared.value

        def step(batch: pa.RecordBatch):
            lists = batch.column("terms")
            lengths = np.diff(np.asarray(lists.offsets))
            keys, counts = np.asarray(lists.flatten()), np.asarray(batch.column("counts").flatten())
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            ends = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(lengths)])]
            offsets = pa.array(ends, pa.int32())
            yield [batch.column("doc_id"), batch.column("ground"), batch.column("length"), pa.ListArray.from_arrays(offsets, pa.array(at[hit].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(counts[hit].astype(np.int32)))]

        return step

    return arrow_pass(hashed, "doc_id long, ground int, length long, terms array<int>, counts array<int>", start)


def few(rows: DataFrame) -> DataFrame:
    """rows in no more tasks than twice the cores, so that what each task sums up is sent as often, whatever the corpus' size."""
    return rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)


def named_subjects(records: DataFrame) -> DataFrame:
    """Rows (local_path, subject): what the subjects of a record name, parted at semicolons, without case, blanks and final stops."""
    each = records.select("local_path", F.explode(F.array_distinct("subjects")).alias("one")).select("local_path", F.explode(F.split("one", ";")).alias("subject"))
    plain = F.lower(F.trim(F.regexp_replace("subject", r"^[\s ]+|[\s .]+$", "")))
    return each.select("local_path", plain.alias("subject")).where("subject != ''").distinct()


def subject_areas(records: DataFrame, areas: DataFrame, least_share: float = 0.5, least: int = 3) -> DataFrame:
    """Rows (subject, area): what each subject string means.

    A string with a scheme code, or equal to an area or its name, names that area. Any other means the area whose codes stand
    beside it in records, if at least least_share of them are of one area; useless subjects stand beside all areas.
    """
    keyed = records.select(F.monotonically_increasing_id().alias("local_path"), "subjects")
    named = written(named_subjects(keyed))
    code = F.regexp_extract("subject", r"(?:^|[^a-z0-9])([a-z]+\d+)(?:[.\-/]\d+)*$", 1)
    known = areas.select("area", F.lower("scheme_code").alias("code"), F.lower("area_name").alias("name"))
    distinct = written(named.select("subject").distinct().withColumn("code", code))
    ways = [distinct.join(known.select(F.col(c).alias(at), F.col("area").alias("_area")).distinct(), at).select("subject", F.col("_area").alias("area")) for c, at in (("area", "subject"), ("name", "subject"), ("code", "code"))]
    direct = ways[0].unionByName(ways[1]).unionByName(ways[2]).distinct()
    direct = written(direct)
    coded = salted_join(named, direct, "subject")
    beside = named.join(direct, "subject", "left_anti").join(coded.select("local_path", "area").distinct(), "local_path").groupBy("subject", "area").count()
    meant = beside.groupBy("subject").agg(F.sum("count").alias("all"), F.max(F.struct("count", "area")).alias("best")).where((F.col("best.count") >= least) & (F.col("best.count") >= least_share * F.col("all")))
    return direct.unionByName(meant.select("subject", "best.area"))


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the columns terms and counts: term and count of each entry, the row of each, and the rows' lengths."""
    lists = batch.column("terms")
    lengths = np.diff(np.asarray(lists.offsets))
    columns = np.asarray(lists.flatten())
    values = np.asarray(batch.column("counts").flatten(), dtype=float)
    return columns, values, np.repeat(np.arange(len(lengths)), lengths), lengths


def document_weights(columns: np.ndarray, values: np.ndarray, rows: np.ndarray, n: int, h: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights [document, component] under the term weights h [component, term] (rows sum to 1), and values / fit of each entry."""
    k = h.shape[0]
    part = np.ascontiguousarray(h[:, columns].T, dtype=np.float32)  # single precision halves what is moved, which is the cost
    values = values.astype(np.float32)
    w = np.repeat(((np.bincount(rows, values, n) / k) + EPSILON).astype(np.float32)[:, None], k, axis=1)
    at = np.searchsorted(rows, np.arange(n))
    filled = np.bincount(rows, minlength=n) > 0
    ratio = np.zeros(len(values), np.float32)
    for _ in range(steps):
        if len(values):
            ratio = values / (np.einsum("ij,ij->i", w[rows], part) + np.float32(EPSILON))
            gained = np.zeros_like(w)
            gained[filled] = np.add.reduceat(part * ratio[:, None], at[filled], axis=0)
            w *= gained
    if len(values):
        ratio = values / (np.einsum("ij,ij->i", w[rows], part) + np.float32(EPSILON))
    return w, ratio


def _summed(rows: DataFrame, k: int, size: int) -> np.ndarray:
    """Sums of rows (cell, value) as a matrix [k, term]; its size is that of the bounded vocabulary."""
    summed = rows.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(k * size)
    out[np.asarray(summed.column("cell"))] = np.asarray(summed.column("value"))
    return out.reshape(k, size)


def _emit(total: np.ndarray) -> list:
    """What isn't nought of a matrix, as (cell, value)."""
    flat = total.reshape(-1)
    used = np.flatnonzero(flat > 1e-6)
    return [used, flat[used]]


def seeds(rows: DataFrame, k_areas: int, size: int) -> np.ndarray:
    """Sums [area and ground components, term] of counts, weighted by what is known of each document.

    rows: the matrix with a column known, an array of the weights of the areas or null.
    """
    k = k_areas + len(GROUNDS)

    def start():
        total = np.zeros((k, size))

        def step(batch: pa.RecordBatch | None):
            if batch is None:
                yield _emit(total)
                return
            columns, values, at, lengths = _batch(batch)
            ground = np.asarray(batch.column("ground"))
            for g in np.unique(ground):
                pick = ground[at] == g
                total[k_areas + g] += np.bincount(columns[pick], values[pick], size)
            known = np.array([x or [0.0] * k_areas for x in batch.column("known").to_pylist()], dtype=float).reshape(len(lengths), k_areas)
            for area in range(k_areas):
                weight = known[at, area]
                pick = weight > 0
                if pick.any():
                    total[area] += np.bincount(columns[pick], values[pick] * weight[pick], size)

        return step

    return _summed(arrow_pass(few(rows.select("ground", "terms", "counts", "known")), "cell int, value double", start, flush=True), k, size)


class Factors:
    """Term weights of the areas and of what belongs to none, and what a language is likely to use.

    areas [area, term] and ground [language, term] are expected counts. In a text of one language an area shows only its terms
    of that language, so the areas' weights are conditioned on the language before they are fitted to a text.
    """

    def __init__(self, areas: np.ndarray, ground: np.ndarray, usage: np.ndarray):
        self.areas, self.ground, self.usage = areas, ground, usage

    def conditioned(self) -> tuple[list[np.ndarray], np.ndarray]:
        """By language, weights [areas and ground, term] whose rows sum to 1; and log-probabilities [language, term]."""
        likely = (self.usage + 0.1) / (self.usage.sum(axis=1, keepdims=True) + 0.1 * self.usage.shape[1])
        affinity = self.usage / np.maximum(self.usage.sum(axis=0), EPSILON) + 0.01
        out = []
        for g in range(len(GROUNDS)):
            h = np.vstack([self.areas * affinity[g], self.ground[g]])
            out.append(h / np.maximum(h.sum(axis=1, keepdims=True), EPSILON))
        return out, np.log(likely)


def anchored(sums: np.ndarray, k_areas: int, described: dict[int, set[int]], lift: float = 3.0) -> Factors:
    """First term weights: an area's component has the terms that its known documents have far above the average, and those of
    its description; the ground components have the others. What is nought stays nought, which keeps the components apart."""
    area, usage = sums[:k_areas], sums[k_areas:]
    whole = usage.sum(axis=0)
    expected = whole * (area.sum(axis=1, keepdims=True) / max(whole.sum(), 1.0))
    rate = (area + 0.1) / (expected + 0.1 + 2 * np.sqrt(expected + 0.1))  # a few chance occurrences raise no rate
    share = area / np.maximum(area.sum(axis=0), EPSILON)
    own = (rate >= lift) & (share >= 0.3)
    for i, found in described.items():
        for t in found:
            if share[i, t] >= 0.3 or area[:, t].sum() == 0:
                own[i, t] = True
    free = ~own.any(axis=0)
    undecided = free & (rate.max(axis=0) >= 1.3)
    areas = np.where(own, whole * np.maximum(share, 0.3), 0.0) + np.where(undecided, 0.1 * area * np.maximum(rate - 1.0, 0.0), 0.0)
    return Factors(areas, usage * np.where(free, 1.0, 0.02), usage)


def _fitted(batch: pa.RecordBatch, conditioned: list[np.ndarray], likely: np.ndarray, steps: int, size: int = 1024):
    """Yields, of each group of documents of one language, their rows in the batch, their entries' terms and the fit."""
    columns, values, at, lengths = _batch(batch)
    n = len(lengths)
    scores = np.stack([np.bincount(at, values * row[columns], n) for row in likely]) if n else np.zeros((len(likely), 0))
    language = scores.argmax(axis=0)
    for g in range(len(conditioned)):
        for docs in np.array_split(np.flatnonzero(language == g), max(1, int((language == g).sum()) // size)):
            if not len(docs):
                continue
            place = np.full(n, -1)
            place[docs] = np.arange(len(docs))
            pick = place[at] >= 0
            rows = place[at[pick]]
            yield g, docs, columns[pick], values[pick], rows, *document_weights(columns[pick], values[pick], rows, len(docs), conditioned[g], steps)


def factorize(rows: DataFrame, first: Factors, rounds: int = 3, steps: int = 8, hold: float = 0.2) -> Factors:
    """Term weights after `rounds` of updates in turn; a part `hold` of each first weight stays, so that anchors hold."""
    now, k, size = first, len(first.areas), first.areas.shape[1]
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(now)

        def start(shared=shared):
            conditioned, likely = shared.value.conditioned()
            total = np.zeros((k + len(GROUNDS), size))

            def step(batch: pa.RecordBatch | None):
                if batch is None:
                    yield _emit(total)
                    return
                for g, _, columns, _, at, w, ratio in _fitted(batch, conditioned, likely, steps):
                    gained = w[at] * conditioned[g][:, columns].T * ratio[:, None]
                    for i in range(k):
                        total[i] += np.bincount(columns, gained[:, i], size)
                    total[k + g] += np.bincount(columns, gained[:, k], size)

            return step

        new = _summed(arrow_pass(few(rows.select("terms", "counts")), "cell int, value double", start, flush=True), k + len(GROUNDS), size)
        now = Factors((1 - hold) * new[:k] + hold * first.areas, (1 - hold) * new[k:] + hold * first.ground, first.usage)
    return now


def mixtures(rows: DataFrame, factors: Factors, steps: int = 25) -> DataFrame:
    """Rows (doc_id, shares, specific, length): the areas' shares of what is specific, how many words that is, in how many code points."""
    shared, k = rows.sparkSession.sparkContext.broadcast(factors), len(factors.areas)

    def start():
        conditioned, likely = shared.value.conditioned()

        def step(batch: pa.RecordBatch):
            ids, long = batch.column("doc_id").to_pylist(), batch.column("length").to_pylist()
            for _, docs, _, _, _, w, _ in _fitted(batch, conditioned, likely, steps):
                specific = w[:, :k].sum(axis=1)
                shares = w[:, :k] / np.maximum(specific, EPSILON)[:, None]
                yield [[ids[d] for d in docs], shares.tolist(), specific.tolist(), [long[d] for d in docs]]

        return step

    return arrow_pass(rows.select("doc_id", "length", "terms", "counts"), "doc_id long, shares array<double>, specific double, length long", start)


def subject_mixtures(documents: DataFrame, areas: list[tuple[str, str, str]], known: DataFrame, rounds: int = 3, least_share: float = 0.0003, bound: int = 200_000) -> DataFrame:
    """mixtures() of documents (doc_id, lang, text), learned over all of them.

    areas: (area, area_name, description). known: rows (doc_id, area, weight) of what labels and records say of some documents.
    Null and empty texts have nothing specific. Documents without known areas are factorized as well.
    """
    names = [a for a, _, _ in areas]
    hashed = written(hashed_matrix(documents))
    words = vocabulary(hashed, least_share, bound=bound)
    whole = written(matrix(hashed, words))
    by_doc = known.where(F.col("area").isin(*names)).groupBy("doc_id").agg(F.array(*(F.sum(F.when(F.col("area") == n, F.col("weight")).otherwise(0.0)) for n in names)).alias("known"))
    sums = seeds(whole.join(by_doc, "doc_id", "left"), len(names), len(words))
    place = {w: i for i, w in enumerate(words.tolist())}
    described = {i: {place[w] for w in terms(f"{name} {text}") if w in place} for i, (_, name, text) in enumerate(areas)}
    return mixtures(whole, factorize(whole, anchored(sums, len(names), described), rounds))
