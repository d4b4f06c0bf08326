"""Text that was decoded with the wrong character encoding, and its original.

Every distinct clean word of the corpus that has letters beyond ASCII is garbled by every chain of encodings. Garbling leaves
ASCII as it is, so only words whose ASCII skeleton also occurs among the suspicious words need their forms made. The suspicious
words of the texts are joined to these forms by hash; what no clean word explains (names) is put together from the forms of the
single letters of the corpus, under the chains that other words of the same text prove. A text counts only with such proof.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pass, written

# Single-byte encodings by which UTF-8 is misread; those in which Western texts are written (Latin-1 has no letter
# that cp1252 has not at the same place) and, besides these, read: all pairs of them.
UTF8_READ_AS = ("cp1252", "latin-1", "iso8859-15", "cp1250", "cp1251", "cp437", "cp850", "mac_roman", "koi8_r")
WRITTEN_IN = ("cp1252", "cp850", "cp437", "mac_roman")
MISREAD = tuple((a, b) for a in WRITTEN_IN for b in (*WRITTEN_IN, "latin-1", "cp1251") if a != b and (a, b) != ("cp1252", "latin-1"))
TWICE = (("cp1252", "cp1252"), ("latin-1", "latin-1"), ("latin-1", "cp1252"), ("cp1252", "latin-1"), ("mac_roman", "mac_roman"), ("cp437", "cp437"), ("cp850", "cp850"), ("cp1251", "cp1251"))
LOST = ("?", "\ufffd")

#: Letters beyond ASCII with which the languages of the corpus are written.
LOWER = "áéíóúüñàèìòùâêîôûãõçëïœæ"
UPPER = LOWER.upper()
MARKS = "\u0300-\u0303\u0308\u0327"
SIGNS = "¿¡«»—–…“”‘’·ºª\u00a0"
#: What no clean word has: other signs; a capital or an opening sign after a small letter; signs where they don't belong.
BAD = re.compile(
    f"[^\\x00-\\x7f{LOWER}{UPPER}{MARKS}{SIGNS}]|(?<=[a-z{LOWER}])[{UPPER}]|(?<=[A-Za-z{LOWER}{UPPER}])[¿¡«“](?=.)"
    f"|(?<![lL])·(?=[A-Za-z{LOWER}])|(?<=[a-z])·(?![lL])|(?<![A-Z{UPPER}])[ÂÃ](?=[{SIGNS}])"
)
CORE = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]*[\x80-\U0010ffff][A-Za-z0-9\x80-\U0010ffff]*")
#: Words in which a question mark stands for a letter, unless it ends a question.
QUESTIONED = re.compile(r"[A-Za-z0-9\x80-\U0010ffff?]*(?:\?(?=\w)|(?<=\w)\?(?=[,;.:?]|\s+[a-z]))[A-Za-z0-9\x80-\U0010ffff?]*")
NOT_ASCII = re.compile(r"[\x80-\U0010ffff]")


def _sloppy(data: bytes, encoding: str) -> str:
    """Decoded; bytes that the encoding leaves undefined become the control characters of the same number."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        return "".join(data[i : i + 1].decode(encoding) if _defined(encoding)[b] else chr(b) for i, b in enumerate(data))


_DEFINED: dict[str, list[bool]] = {}


def _defined(encoding: str) -> list[bool]:
    if encoding not in _DEFINED:
        _DEFINED[encoding] = [bytes([b]).decode(encoding, "ignore") != "" for b in range(256)]
    return _DEFINED[encoding]


def garbled_forms(word: str) -> dict[str, str]:
    """By chain, the forms the word takes; chains that leave it as it is or can't hold it are left out."""
    out = {}
    data = word.encode()
    once = {e: _sloppy(data, e) for e in UTF8_READ_AS}
    for e, form in once.items():
        out[f"utf-8>{e}"] = form
    for a, b in TWICE:
        out[f"utf-8>{a}>utf-8>{b}"] = _sloppy(once[a].encode(), b)
    for a, b in MISREAD:
        try:
            out[f"{a}>{b}"] = _sloppy(word.encode(a), b)
        except UnicodeEncodeError:
            pass
    return {chain: form for chain, form in out.items() if form != word}


def lost_forms(word: str) -> list[str]:
    """The word with each letter beyond ASCII replaced."""
    return [NOT_ASCII.sub(sign, word) for sign in LOST]


def skeleton(word: str) -> str:
    return "".join(c for c in word if c < "\x80" and c != "?")


def _spaced(word: str) -> bool:
    """Words that nothing but a no-break space may have damaged, which á becomes; no proof, and restored only to known words."""
    return "\u00a0" in word and not BAD.search(word)


def suspicious(text: str) -> list[str]:
    """The words of a text that may be garbled or may have lost letters."""
    found = []
    if BAD.search(text):
        found = [w for w in CORE.findall(text) if BAD.search(w)]
    if "\u00a0" in text:
        found += [w for w in CORE.findall(text) if _spaced(w)]
    if "?" in text:
        found += QUESTIONED.findall(text)
    return found


def _scanned(rows: DataFrame) -> DataFrame:
    """One pass over all texts, as rows of two kinds: (word, skeleton, clean) of words with letters beyond ASCII or a doubtful
    question mark, distinct inside a task; and (field, document_id, text, bad) of the texts that have suspicious words."""

    def start():
        held: dict[str, bool] = {}

        def step(batch: pa.RecordBatch | None):
            if batch is not None:
                out: list[list] = [[], [], [], []]
                for field, key, t in zip(*(c.to_pylist() for c in batch.columns)):
                    if bad := set(suspicious(t)):
                        held.update(dict.fromkeys(bad, False))
                        for column, value in zip(out, (field, key, t, list(bad))):
                            column.append(value)
                    if not t.isascii():
                        for w in CORE.findall(t):
                            if w not in held:
                                held[w] = BAD.search(w) is None
                if out[0]:
                    none = [None] * len(out[0])
                    yield [none, none, none, *out]
            if held and (batch is None or len(held) > 200_000):
                none = [None] * len(held)
                yield [list(held), [skeleton(w) for w in held], list(held.values()), none, none, none, none]
                held.clear()

        return step

    schema = "word string, skeleton string, clean boolean, field string, document_id string, text string, bad array<string>"
    return arrow_pass(rows.select("field", "document_id", "text"), schema, start, flush=True)


def _forms(clean: DataFrame) -> DataFrame:
    """Rows (form, original, chain) of clean words; the chain of lost letters is ''."""

    def start():
        def step(batch: pa.RecordBatch):
            out: list[list] = [[], [], []]
            for w in batch.column(0).to_pylist():
                for chain, form in garbled_forms(w).items():
                    for column, value in zip(out, (form, w, chain)):
                        column.append(value)
                for form in lost_forms(w):
                    for column, value in zip(out, (form, None, "")):
                        column.append(value)
            yield out

        return step

    return arrow_pass(clean.select("word"), "form string, original string, chain string", start)


class Letters:
    """Forms of the single letters of the corpus, by chain."""

    def __init__(self, letters: list[str]):
        by: dict[str, dict[str, str]] = defaultdict(dict)
        for letter in letters:
            for chain, form in garbled_forms(letter).items():
                by[chain][form] = letter
        self.by = dict(by)
        self.pattern = {chain: re.compile("|".join(map(re.escape, sorted(forms, key=len, reverse=True)))) for chain, forms in by.items()}

    def restore(self, word: str, chain: str) -> str | None:
        """The word put together from letters, if this explains all of it."""
        forms = self.by.get(chain)
        if not forms:
            return None
        out = self.pattern[chain].sub(lambda m: forms[m[0]], word)
        return out if out != word and not BAD.search(out) and garbled_forms(out).get(chain) == word else None


#: First parts of garbled letters; left over, they show that the rest is gone.
HALF = re.compile("[ÃÂ√├┬Г]")


def _explained(word: str, letters: Letters) -> bool:
    """Whether some chain makes a word of a suspicious one: not of units and amounts (20°C, m², €30), nor of foreign names."""
    ascii_part = skeleton(word)
    return len(ascii_part) >= 2 and not _spaced(word) and not any(map(str.isdigit, ascii_part)) and any(letters.restore(word, chain) for chain in letters.by)


def restored(text: str, known: dict[str, list[tuple[str, str | None]]], letters: Letters) -> str | None:
    """The original of a damaged text, '' where letters were lost for good, None where the text isn't damaged.

    known: by word of the text, the (chain, original) of the clean words that can have become it. Only such a hit proves a chain;
    under a proven chain names go by their letters. A chain of single bytes must also have hits for half of the words that any
    chain may explain, as signs strewn over a text make some words by chance.
    """
    bad = set(suspicious(text))
    hits = {w: {c for c, _ in known.get(w, ())} for w in bad if len(w) > 1 and not _spaced(w)}  # one sign alone is itself
    proof = Counter(chain for chains in hits.values() for chain in chains)
    if proof.pop("", 0) or any("\ufffd" in w and skeleton(w) for w in bad):  # U+FFFD itself says that letters were lost
        return ""
    swaps: dict[str, str] = {}
    for w in bad:
        options = {c: o for c, o in known.get(w, ()) if o is not None}
        for chain, _ in sorted(proof.items(), key=lambda x: (-x[1], x[0])):
            if original := options.get(chain) or not _spaced(w) and letters.restore(w, chain):
                swaps[w] = original
                break
    explained = sum(w in swaps or _explained(w, letters) for w in bad)
    several_bytes = any(chain.startswith("utf-8>") for chain in proof)
    if not swaps or 2 * (len(swaps) if several_bytes else sum(map(bool, hits.values()))) < explained:
        return None
    if any(HALF.search(w) for w in bad - set(swaps)):
        return ""
    return CORE.sub(lambda m: swaps.get(m[0], m[0]), text)


def damaged(rows: DataFrame, salts: int = 8) -> DataFrame:
    """Rows (field, document_id, restored) of damaged texts among rows (field, document_id, text).

    restored is '' where letters were lost for good. Null and empty texts are no case; a null field or document_id stays null.
    Equal rows give equal results once; texts that differ under one document_id are judged each by itself. The words of the
    texts meet the table of garbled forms in `salts` parts, so that a frequent word is not one task's.
    """
    scan = written(_scanned(rows.where("text is not null and text != ''")).withColumn("row", F.monotonically_increasing_id()))
    words = written(scan.where("word is not null").select("word", "skeleton", "clean").distinct())
    bad = words.where("not clean")
    clean = words.where("clean").join(bad.select("skeleton").distinct(), "skeleton", "left_semi")
    matched = bad.select("word").join(_forms(clean), F.col("word") == F.col("form")).select("word", "chain", "original").distinct()
    held = written(matched.groupBy("word").agg(F.collect_set(F.struct("chain", "original")).alias("options")))  # few for each chain: words of one form

    letters = [r.c for r in words.where("clean").select(F.explode(F.split("word", "")).alias("c")).where("c > '\x7f'").distinct().collect()]  # an alphabet: BAD bounds it
    shared = rows.sparkSession.sparkContext.broadcast(letters)

    texts = scan.where("text is not null").select("row", "field", "document_id", "text", "bad")
    per_text = texts.select("row", F.explode("bad").alias("word")).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    spread = held.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    per_text = per_text.join(spread, ["word", "salt"]).groupBy("row").agg(F.collect_list(F.struct("word", "options")).alias("known"))

    def restoring():
        alphabet = Letters(shared.value)

        def step(batch: pa.RecordBatch):
            out: list[list] = [[], [], []]
            for field, key, text, known in zip(*(c.to_pylist() for c in batch.columns)):
                options = {k["word"]: [(o["chain"], o["original"]) for o in k["options"]] for k in known or ()}
                original = restored(text, options, alphabet)
                if original is not None:
                    for column, value in zip(out, (field, key, original)):
                        column.append(value)
            yield out

        return step

    joined = texts.drop("bad").join(per_text, "row", "left").select("field", "document_id", "text", "known")
    return arrow_pass(joined, "field string, document_id string, restored string", restoring).distinct()


def with_md5(found: DataFrame) -> DataFrame:
    return found.select("field", "document_id", F.when(F.col("restored") == "", "").otherwise(F.md5(F.encode("restored", "UTF-8"))).alias("restored_md5"))
