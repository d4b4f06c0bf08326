"""Template residue and error pages: unfilled placeholders, filler, error messages, notices that scripts are required.

The title, menus and the footer of a record are set aside; the rest is cut into units (lines and sentences). Units of equal
skeleton are aligned over the corpus: what varies between them (names, numbers, values after a label, placeholders) is a slot,
the rest must be equal. Slots are known as unfilled by the notation of a variable or default, and besides by what the aligned
records show: names in an unknown notation that keep a slot open in several records, and a value that fills slots of several
labels. A template whose slots mostly stay unfilled is residue. So are templates of messages, filler, and units that pages with
different titles share as their whole content, if most of what holds such a unit is a page of that kind. A record is residue
where at least half of its content is.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, written
from .quality import _names, common_words, failed, measured
from .vectors import Texts, groups, skeletons, word_hash

#: A variable name in the marks of a template language.
VARIABLE = r"\$\{[^}\n]{1,40}\}|\{\{[^}\n]{1,40}\}\}|\{[\w. ]{1,40}\}|<%=?[^%\n]{1,40}%>|\[\[[\w. ]{1,40}\]\]|%[A-Za-z_.]{2,40}%|@@\w[\w.]{0,40}?@@|__[^\W_][\w.]{0,40}?__|#[A-Za-z_.]{2,40}#|«[\w.]{2,40}»"
#: What is shown where a value is missing, or where a template asks for one.
DEFAULT = r"\[object Object\]|Invalid Date|\bundefined\b|\bnull\b|\bNone\b|\bNaN\b|#¡?[A-Z]{2,6}[!?]|\(sin valor\)|\(por completar\)|\b[dm]{2}/[dm]{2}/a{2,4}\b|\bX{3,}(?: X{3,})*|\[[^\W\d_][^\]\n]{3,60}\]|<[a-záéíóúñ][^<>\n%]{3,60}>|nombre@dominio"
RESIDUE = re.compile(f"{VARIABLE}|{DEFAULT}")
PAGE_MARK = re.compile(r"\[\[P[ÁA]GINA\s+\d+\]\]", re.I)
LABELLED = re.compile(r"(?<![\w])([^\W\d_][\w ]{1,30}):[ \t]*([^·|;\n]*)")

#: A name between signs, or behind one, in a notation that isn't known; the aligned records tell whether it is a variable.
ODD = re.compile(r"(?<!\S)[^\w\s,.;()'\"“”‘’¿¡—–\-]{1,3}[^\W\d_][\w.]{1,40}[^\w\s,.;()'\"“”‘’?!—–\-]{0,3}(?=[\s,.;)]|$)")

# What messages of servers and of pages that need scripts speak of, in six languages; they decide only for units that
# the corpus has no other evidence of.
PHRASES = (
    "javascript", "cookies", "secuencias de comandos", "ejecución de código", "su navegador", "seu navegador", "your browser", "tuo browser", "votre navigateur", "are human", "uma pessoa", "un robot", "um robô", "a robot", "redirigid",
    "automatically", "pulse aquí", "este servidor", "upstream", "gateway", "timeout", "no se pud", "no pudo", "no pudimos", "não pôde", "não foi possível", "n'a pas pu", "non è stato possibile", "no s'ha pogut", "could not", "couldn't", "cannot be",
    "be loaded", "not found", "no existe", "not exist", "não existe", "existe pas", "existe plus", "non esiste", "ya no está", "de servicio", "of service", "de serviço", "hors service", "fuori servizio", "mantenimiento", "maintenance",
    "manutenção", "manutenzione", "tardó demasiado", "took too long", "demorou dema", "trop de temps", "closed to you", "no tiene permiso", "not allowed", "access denied", "acesso negado", "accès refusé", "accesso negato", "accés denegat",
    "sesión caducó", "sesión ha caducado", "session expired", "session has", "session a expiré", "sessione scaduta", "sessão expirou", "log in again", "sign in again", "identificarse", "administrador", "administrator", "a la portada", "home page",
    "demasiadas peticiones", "too many requests", "base de datos falló", "fallo interno", "erro interno", "internal", "eliminado", "was removed", "retirado", "foi removid", "gone away", "inexistente", "nothing lives", "no disponible",
    "unavailable", "indispon", "introuvable", "intente más tarde", "try again", "pruebe de nuevo", "tente de novo", "riprova", "réessayez", "su visor", "requiere que", "turn on", "turned on", "switch on", "turn off", "turned off",
)
NUMBERED = re.compile(r"\b(?:js|scripts?|scripting|error|erro|errore|erreur)\b|\bnodo-\d|\b(?:ref|id)[.:] ?[0-9a-f]{6}|\b[45]\d\d[:.)]")
FILLER = re.compile(
    r"\bbla(?: bla)+|\b(?:asdf|qwer|zxcv)\b|\bprueba prueba|texto de prueba|de ejemplo\b|de muestra\b|por completar|insertar .{2,30} aquí|escriba aquí|pegue aquí|borre esta línea|nombre apellido"
    r"|(?:goes|here) here|próximamente|en construcción|aquí irá|ocupa el lugar|contenido definitivo|placeholder|lorem ipsum",
    re.I,
)
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure "
    "reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident culpa officia deserunt mollit anim est laborum vitae mauris risus augue urna nunc turpis ligula felis porta pharetra ornare vel vestibulum".split()
)
TRACE = re.compile(r"^\s+at \S+\(\S*:\d+\)\s*$")
FOOTER = re.compile(r"^\s*(?:©|\(c\)|copyright\b)", re.I)
SENTENCE = re.compile(r"(?<=[.!?…])\s+(?=\S)")
LETTERS = re.compile(r"[^\W\d_]+")


def _menu(lines: list[str]) -> bool:
    """Short entries, parted by signs or each on a line of its own, that state nothing."""
    if len(lines) == 1:
        entries = re.split(r" [|>·] ", lines[0])
        return len(entries) >= 2 and all(len(e.split()) <= 3 and not re.search(r"[\d:{}<%@_#«\[.]", e) for e in entries) and not RESIDUE.search(lines[0])
    return len(lines) >= 2 and all(len(l.split()) <= 3 and not re.search(r"[\d:{}<%@_#«\[.,;!?()]", l) for l in lines) and not any(RESIDUE.search(l) for l in lines)


def units(text: str) -> list[str]:
    """Lines and sentences of the content: without title, menus, footer and page marks; wrapped lines are joined."""
    return _cut(text)[1]


def _cut(text: str) -> tuple[str, list[str]]:
    """The title, '' if there is none, and the units."""
    text = PAGE_MARK.sub("", text.replace("\r\n", "\n").replace("\r", "\n"))
    paragraphs = [[l for l in p.split("\n") if l.strip()] for p in re.split(r"\n\s*\n", text)]
    paragraphs = [p for p in paragraphs if p]
    title, out = "", []
    for k, lines in enumerate(paragraphs):
        first = lines[0].strip()
        titled = k == 0 and len(paragraphs) > 1 and len(lines) == 1 and not re.search(r"[.!…:]$|[.!…]\s", first) and not is_message(first.lower()) and len(first.split()) <= 16 and not RESIDUE.search(first)
        if titled:
            title = first
        if titled or _menu([l.strip() for l in lines]) or all(FOOTER.match(l) for l in lines):
            continue
        joined: list[str] = []
        for l in lines:
            if joined and re.match(r"\s*[a-záéíóúñü]", l) and not TRACE.match(l) and not TRACE.match(joined[-1]) and not re.search(r"[.!?…:]$", joined[-1]):
                joined[-1] += " " + l.strip()
            else:
                joined.append(l)
        for l in joined:
            out += [l] if TRACE.match(l) else [s for s in SENTENCE.split(l.strip()) if s]
    return title, out


#: One of these is in every text that RESIDUE matches, and in every lower-cased one that FILLER does.
MARKS = ("{", "<", "[", "@", "__", "#", "%", "«", "Invalid", "undefined", "null", "None", "NaN", "(sin", "(por", "/", "XXX")
FILLERS = ("bla bla", "asdf", "qwer", "zxcv", "prueba", "de ejemplo", "de muestra", "completar", "insertar", "escriba", "pegue", "borre", "apellido", " here", "próximamente", "construcción", "aquí irá", "ocupa el", "definitivo", "placeholder", "lorem")


def _marked(text: str) -> bool:
    return any(map(text.__contains__, MARKS))


def masked(unit: str) -> tuple[str, int, int, int, list[tuple[str, str]]]:
    """The unit with ~ for what may be a slot; how many slots keep residue, have a value, or hold a name in an unknown notation;
    and the labels with their values."""
    kept = filled = odd = 0
    pairs: list[tuple[str, str]] = []

    def label(m: re.Match) -> str:
        nonlocal kept, filled, odd
        value = m[2].strip()
        if not value or RESIDUE.search(value):
            kept += max(1, len(RESIDUE.findall(value)))
        elif ODD.search(value):
            odd += 1
        else:
            filled += 1
            if value[0].islower() and not any(map(str.isdigit, value)):
                pairs.append((m[1].lower(), value))
        return f"{m[1]}: ~ "

    def slot(m: re.Match) -> str:
        nonlocal kept
        kept += 1
        return "~"

    def name(m: re.Match) -> str:
        nonlocal odd
        odd += 1
        return "~"

    out = LABELLED.sub(label, unit) if ":" in unit and LABELLED.match(unit) else unit
    if _marked(out):
        out = RESIDUE.sub(slot, out)
    return ODD.sub(name, out), kept, filled, odd, pairs


#: Signs one of which is in every unit that has anything to mask.
SIGN = re.compile(r"[:{}<\[@#%«$~&^*+=\\|/]|__|undefined|null|None|NaN|Invalid|\(sin|\(por|XXX")


def templates(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, list[tuple[str, str]]]]:
    """Of each unit: the hash of its template, its unfilled, filled and odd slots, whether it has more words than slots; and by unit
    the values of its labels."""
    marked = {i: masked(u) for i, u in enumerate(units) if SIGN.search(u)}
    hashes, words, slots = skeletons([marked[i][0] if i in marked else u for i, u in enumerate(units)] if marked else units)
    kept, filled, odd = np.zeros(len(units), np.int64), slots.copy(), np.zeros(len(units), np.int64)
    for i, (_, k, f, o, _) in marked.items():
        kept[i], filled[i], odd[i] = k, max(f, filled[i] - k - o), o
    return hashes, kept, filled, odd, words > slots, {i: m[4] for i, m in marked.items() if m[4]}


def is_message(low: str) -> bool:
    """Of a lower-cased unit: one of the phrases, or a word, code or reference of a message."""
    return any(map(low.__contains__, PHRASES)) or NUMBERED.search(low) is not None


def _hits(low: str) -> int:
    """How many phrases, codes and references of messages are in a lower-cased unit."""
    return sum(map(low.__contains__, PHRASES)) + len(NUMBERED.findall(low))


def says_nothing(unit: str, times: int, distinct: int) -> bool:
    """Messages, filler and traces, by themselves."""
    low = unit.lower()
    if len(low.split()) <= 30 * _hits(low) or TRACE.match(unit) or any(map(low.__contains__, FILLERS)) and FILLER.search(low):
        return True
    found = LETTERS.findall(low)
    if len(found) >= 4 and sum(w in LATIN for w in found) >= 0.6 * len(found):
        return True
    return times >= 3 and distinct == 1


#: Linear in the text's length, and true wherever PHRASES, NUMBERED, FILLER or TRACE are of one of its units.
SUSPECT = "|".join(map(re.escape, [*PHRASES, *FILLERS])) + r"|js|script|err(?:o\b|or|eur)|nodo-\p{Nd}|(?:ref|id)[.:] ?[0-9a-f]{6}|[45]\p{Nd}{2}[:.)]|at [^\n]*\("
LATIN_HASHES = np.sort(np.array([word_hash(w) for w in LATIN], np.int64))


def _doubtful(t: Texts, found: list[list[str]]) -> list[bool]:
    """Of the units of each text: whether says_nothing may hold for one of them by its words. Misses none."""
    low = ["\n".join(u).lower() for u in found]
    suspect = pc.match_substring_regex(pa.array(low, pa.large_string()), SUSPECT).to_pylist()
    owner, hashes, _, _ = t.words()
    latin = t.count(owner[LATIN_HASHES[np.minimum(np.searchsorted(LATIN_HASHES, hashes), len(LATIN_HASHES) - 1)] == hashes])
    return [s or n >= 3 for s, n in zip(suspect, latin)]  # 0.6 of four words


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


FOUND = "doc_id long, template long, chars long, kept long, filled long, odd long, says_nothing boolean, page long, head long, content long, pairs array<long>, unnatural array<string>"


def templates_of(documents: DataFrame, common: dict[str, np.ndarray] | None = None) -> DataFrame:
    """Rows FOUND of all texts, of any length: one for each template of a document.

    A template stands as its hash. page is a hash of title and units, so that copies are one page; head of the title, or of the
    first unit where there is none, as versions of one text have the same, null where a template has not more words than slots
    (rows of figures are alike without sharing anything); content is the number of code points of all units; pairs has, for each
    labelled value, hashes of label and value. With `common` (see quality.common_words) the same pass also judges the texts by the
    rules of quality: a text that fails some has a row more, without a template, with their names.
    """
    shared = documents.sparkSession.sparkContext.broadcast(common)
    lang = F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string")

    def start():
        known = shared.value

        def step(batch: pa.RecordBatch):
            ids, texts, languages = (c.to_pylist() for c in batch.columns)
            for a, b in groups(texts):
                yield from of(ids[a:b], texts[a:b], languages[a:b])

        def of(ids: list[int], texts: list[str], languages: list[str | None]):
            t = Texts(texts)
            cut = [_cut(text) for text in texts]
            times = [Counter(u) for _, u in cut]
            every = [u for c in times for u in c]
            n = np.array([k for c in times for k in c.values()], np.int64)
            doc = np.repeat(np.arange(len(texts)), [len(c) for c in times])
            hashes, kept, filled, odd, wordy, values = templates(every)
            says = np.zeros(len(every), bool)
            suspects, at = _doubtful(t, [u for _, u in cut]), 0
            for i, c in enumerate(times):
                if suspects[i] or len(c) == 1:
                    says[at : at + len(c)] = [says_nothing(u, k, len(c)) for u, k in c.items()]
                at += len(c)
            page = np.array([_hash("\n".join([title, *found])) for title, found in cut], np.int64)
            head = np.array([_hash(" ".join(LETTERS.findall(title.lower())) or (found[0].lower() if found else "")) for title, found in cut], np.int64)
            order = np.lexsort((hashes, doc))
            if len(order):
                first = np.flatnonzero(np.concatenate([[True], (np.diff(doc[order]) != 0) | (np.diff(hashes[order]) != 0)]))
                summed = [np.add.reduceat((n * x)[order], first) for x in (np.fromiter(map(len, every), np.int64, len(every)), kept, filled, odd)]
                by, key = doc[order][first], hashes[order][first]
                content = np.bincount(by, summed[0], len(texts)).astype(np.int64)
                pairs: list[list[int] | None] = [None] * len(first)
                if values:
                    place = np.empty(len(order), np.int64)
                    place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
                    for i, found in values.items():
                        pairs[place[i]] = (pairs[place[i]] or []) + [_hash(x) for pair in found for x in pair]
                heads = pa.array(head[by], mask=~wordy[order][first])
                yield [np.array(ids)[by], key, *summed, np.logical_or.reduceat(says[order], first), page[by], heads, content[by], pairs, [None] * len(first)]
            if known is not None:
                rules = failed(measured(t, languages, known))
                bad = np.flatnonzero(np.any(list(rules.values()), axis=0))
                none = [None] * len(bad)
                yield [[ids[i] for i in bad], *[none] * 10, [_names(rules, i) for i in bad]]

        return step

    rows = documents.where("text is not null").select("doc_id", "text", lang.alias("lang"))
    return arrow_pass(rows, FOUND, start)


def _defaults(found: DataFrame, shared_by: int) -> DataFrame:
    """Rows (value): values that each of `shared_by` labels or more has on so many pages. What is true of a record fits one label."""
    pair = F.explode(F.sequence(F.lit(0), (F.size("pairs") / 2 - 1).cast("int")))
    each = found.where("pairs is not null").select("page", "pairs", pair.alias("i")).select("page", F.get("pairs", F.col("i") * 2).alias("label"), F.get("pairs", F.col("i") * 2 + 1).alias("value"))
    held = each.distinct().groupBy("label", "value").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= shared_by)
    return held.groupBy("value").agg(F.count(F.lit(1)).alias("labels")).where(F.col("labels") >= shared_by).select("value")


def aligned(found: DataFrame, shared_by: int = 3) -> DataFrame:
    """found with the slots that the aligned records show to be unfilled counted as such: values that are defaults."""
    labelled = found.where("pairs is not null").select("doc_id", "template", "page", F.explode("pairs").alias("value"))
    kept = labelled.join(_defaults(found, shared_by), "value", "left_semi").groupBy("doc_id", "template", "page").agg(F.count(F.lit(1)).alias("more"))
    kept = written(kept)  # few, and often none
    joined = found.join(kept, ["doc_id", "template", "page"], "left").withColumn("more", F.coalesce("more", F.lit(0)))
    return joined.withColumn("kept", F.col("kept") + F.col("more")).withColumn("filled", F.greatest(F.col("filled") - F.col("more"), F.lit(0))).drop("more")


def induced(found: DataFrame, shared_by: int = 3, share: float = 0.5) -> DataFrame:
    """Of each template of the corpus: whether it is residue, and the reason. One row for each template that is.

    Messages and filler: at least `share` of the records that hold the template say nothing by it. What stands in a slot may look
    like a message in some record of any corpus that is large enough, as a number like an error's code, and says nothing of others.
    Unfilled slots: at least as many of the template's slots over all records are unfilled as filled; names in an unknown notation
    count as unfilled where `shared_by` records under more than one head keep one. Templates that at least `shared_by` heads hold
    are common. A page is shared where at least `share` of its content is common and so many heads have pages with the same common
    templates; lists of common entries differ in them. A template is residue where so many heads, and at least `share` of all heads
    that hold it in a text of any length, have shared pages with it. Copies and versions of one text have one head, so they share
    nothing.
    """
    kept = F.sum("kept").alias("kept")
    stats = found.groupBy("template").agg(kept, F.sum("filled").alias("filled"), F.sum("odd").alias("odd"), F.count_if(F.col("odd") > 0).alias("odd_records"), F.min("head").alias("h0"), F.max("head").alias("h1"), F.count_if("says_nothing").alias("saying_nothing"), F.count("*").alias("records"))
    variables = F.when((F.col("odd_records") >= shared_by) & (F.col("h0") != F.col("h1")), F.col("odd")).otherwise(0)
    unfilled = (F.col("kept") + variables > 0) & (F.col("kept") + variables >= F.col("filled"))
    reason = F.when(F.col("saying_nothing") >= share * F.col("records"), "message or filler").when(unfilled, "unfilled slots")
    stats = written(stats.withColumn("reason", reason).where((F.col("reason").isNotNull()) | (F.col("records") >= shared_by)).select("template", "reason"))

    units = found.where("head is not null").join(stats.where("reason is null"), "template", "left_semi").select("template", "page", "head", "chars", "content").distinct()
    heads = units.select("template", "head").distinct().groupBy("template").agg(F.count("*").alias("heads")).where(F.col("heads") >= shared_by)
    units = written(units.join(heads, "template"))
    whole = units.groupBy("page").agg(F.sum("chars").alias("common"), F.max("content").alias("content"), F.max("head").alias("head"), F.xxhash64(F.sort_array(F.collect_set("template"))).alias("together"))
    whole = written(whole.where(F.col("common") >= share * F.col("content")).select("page", "head", "together"))
    alike = whole.select("together", "head").distinct().groupBy("together").agg(F.count("*").alias("n")).where(F.col("n") >= shared_by)
    whole = whole.join(alike, "together", "left_semi").select("page")
    pages = units.join(whole, "page", "left_semi").select("template", "head", "heads").distinct().groupBy("template").agg(F.count("*").alias("pages"), F.max("heads").alias("heads"))
    shared = pages.where((F.col("pages") >= shared_by) & (F.col("pages") >= share * F.col("heads"))).select("template", F.lit("shared by whole pages").alias("reason"))
    return stats.where("reason is not null").unionByName(shared)


def judged(found: DataFrame, share: float = 0.5, shared_by: int = 3) -> DataFrame:
    """residue() of rows of templates_of."""
    units = aligned(found.where("template is not null"), shared_by)
    rows = units.join(induced(units, shared_by, share), "template", "left")
    rows = rows.withColumn("reason", F.when(F.col("says_nothing"), "message or filler").when((F.col("reason") != "unfilled slots") | (F.col("kept") + F.col("odd") > 0), F.col("reason")))  # a filled slot is content
    bad = F.sum(F.when(F.col("reason").isNotNull(), F.col("chars")).otherwise(0))
    shares = rows.groupBy("doc_id").agg(F.try_divide(bad, F.sum("chars")).alias("residue_share"), F.sort_array(F.collect_set("reason")).alias("reasons"))
    return shares.where(F.col("residue_share") >= share)


def residue(documents: DataFrame, share: float = 0.5, shared_by: int = 3) -> DataFrame:
    """Rows (doc_id, residue_share, reasons): records of whose content at least `share` is template residue.

    Null and empty texts, and texts of nothing but titles and menus, are no case. Repeated rows of a doc_id count together.
    """
    return judged(written(templates_of(documents)), share, shared_by)


def no_prose(documents: DataFrame, share: float = 0.5, shared_by: int = 3) -> DataFrame:
    """doc_id of what residue or quality.unnatural finds, with one pass over the texts besides that for the common words."""
    found = written(templates_of(documents, common_words(documents)))
    return judged(found, share, shared_by).select("doc_id").unionByName(found.where("template is null").select("doc_id")).distinct()


def without_residue(documents: DataFrame, share: float = 0.5) -> DataFrame:
    """The documents that are no residue, with all their columns."""
    return documents.join(residue(documents, share).select("doc_id"), "doc_id", "left_anti")
