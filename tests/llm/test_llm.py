import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hilada.llm import language, leakage, mixing, mojibake, quality, queries, residue, subjects, term_counts, token_counts
from hilada.llm.common import newest, written

DOCUMENTS = "doc_id long, document_id string, source string, lang string, batch_no long, text string, term string, word string, n int, key string, grp string"


def documents(spark, texts):
    """With columns more, whose names are used inside the operators."""
    rows = [(i, f"d{i}", "s" + str(i % 2), "es", i // 100, t, "x", "x", 1, "x", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


AWKWARD = [None, "", " ", "hola " * 40_000, "uno dos tres", "uno dos tres", "\x00�", "á" * 5000, "\n\n\n", "?"]


# terms


def ngrams(text, length):
    words = term_counts.words(text or "")
    return [" ".join(words[i : i + k]) for k in range(1, length + 1) for i in range(len(words) - k + 1)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="ab ñ1_́", max_size=40), max_size=12), st.integers(1, 4))
def test_suffix_counts_equal_brute_force(spark, texts, length):
    got = {r.term: (r.absolute_frequency, r.document_frequency) for r in term_counts.term_counts(documents(spark, texts), length=length).collect()}
    total, records = Counter(), Counter()
    for t in texts:
        total.update(ngrams(t, length))
        records.update(set(ngrams(t, length)))
    assert got == {g: (total[g], records[g]) for g in total}


def test_one_first_term_in_most_suffixes(spark):
    texts = ["la " + " la ".join(random.Random(i).choices(["casa", "luz", "voz", "mar"], k=30)) for i in range(60)]
    got = {r.term: r.absolute_frequency for r in term_counts.term_counts(documents(spark, texts), length=3).collect()}
    assert got == Counter(g for t in texts for g in ngrams(t, 3))


@pytest.mark.parametrize(("text", "words"), [("año1 a mar_tierra x² niño’s", ["niño"]), ("ALÍ alì", ["alí"]), ("pingüino", ["pingüino"]), ("coópera", ["coópera"])])
def test_words(text, words):
    assert term_counts.words(text) == words and term_counts._word_list(text, {}) == words


def test_marks(spark):
    docs = documents(spark, ["hola mundo", "hola hola", "hola raro", None, "", *["x"] * 5])
    rows = [(0, " Hola ", 4, 3, 1), (0, "hola", 9, 9, 0), (0, "mundo", None, None, 2), (0, "mundo", 5, 5, 1), (0, "nada", 1, None, 1), (None, "hola", 7, 7, 1), (0, None, 7, 7, 1), (0, "raro", 1, 2, 1)]
    published = spark.createDataFrame(rows, "batch_no long, word string, absolute_frequency long, document_frequency long, exported_at long")
    got = {tuple(r) for r in term_counts.marks(docs, published).collect()}
    assert got == {(0, "hola", "common"), (0, "mundo", "rare"), (0, "raro", "rare"), (0, "nada", "miscounted"), (0, "raro", "miscounted")}


# tokens


def plain_tokens(text, listed):
    text = unicodedata.normalize("NFC", text or "").lower()
    n, at = 0, 0
    for m in re.finditer(r"\w+|[^\w]", text):
        n += 0 if m[0] in " \t\n\r " else 1 if m[0] in listed else len(m[0])
    return n


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_tokens_equal_a_plain_tokenizer(spark, broadcast_rows):
    listed = ["hola", "ho", "mundo", "año", "de", "dé"]
    vocabulary = spark.createDataFrame([(w,) for w in [*listed, None, "hola", "a", "x1"]], "word string")
    texts = [*AWKWARD, "Hola, mundo! holas ho hola1 _de_ de\tde", "año año AÑO dé"]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(documents(spark, texts), vocabulary, broadcast_rows=broadcast_rows).collect()}
    assert got == {i: plain_tokens(t, set(listed)) for i, t in enumerate(texts)}
    again = spark.createDataFrame([(1, "a"), (1, "hola mundo"), (None, "b c"), (None, "b c"), (1, "a")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(again, vocabulary, broadcast_rows=broadcast_rows).collect()))
    assert got == [(0, 2), (0, 2), (1, 1), (1, 1), (1, 2)]


def test_states_go_on_along_prefixes():
    tokenizer = token_counts.VocabularyTokenizer(["casa", "casas"])
    state, counts = tokenizer.start(), []
    for letter in "casasx":
        state = tokenizer.step(state, letter)
        counts.append(tokenizer.count(state))
    assert counts == [1, 2, 3, 1, 1, 6]


# encodings


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abñóíúáéüçãàèÑÓ", min_size=1, max_size=8))
def test_letters_restore_what_chains_garble(word):
    letters = mojibake.Letters(list(mojibake.LOWER + mojibake.UPPER))
    for chain, form in mojibake.garbled_forms(word).items():
        if not mojibake.BAD.search(word) and (again := letters.restore(form, chain)) is not None:
            assert mojibake.garbled_forms(again)[chain] == form


def test_damaged_texts_come_back(spark):
    clean = ["La canción del niño cambió según el público.", "El pingüino acompañó a Ñandú cerca de la montaña.", "¿Cuándo llegó el señor? La opinión cambió."]
    bad = [clean[0].encode().decode("latin-1"), clean[1].encode().decode("mac_roman"), clean[0].encode("latin-1").decode("cp850"), clean[2].encode().decode("cp1252").encode().decode("cp1252"), clean[0].encode("latin-1").decode("utf-8", "replace"), clean[1].encode("ascii", "replace").decode()]
    originals = [clean[0], clean[1], clean[0], clean[2], "", ""]
    mixed = clean[1] + "\n\n" + bad[0]
    rows = [("text", f"t{i}", t) for i, t in enumerate([*clean, *bad, mixed, None, "", "x² ≥ 3·y ¬°", "¿Está?"])]
    got = {r.document_id: r.restored for r in mojibake.damaged(spark.createDataFrame(rows, "field string, document_id string, text string")).collect()}
    assert got == {f"t{i + 3}": o for i, o in enumerate(originals)} | {"t9": clean[1] + "\n\n" + clean[0]}


def test_damage_of_a_part_and_pairs_of_encodings(spark):
    clean = ["La canción del niño cambió según el público en el décimo café.", "Añadió más té después."]
    science = "A 20°C el área de 5 m² costó €30 según Dvořák."
    twins = [clean[0].encode(a).decode(b) for a, b in (("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1252", "cp850"))] + [clean[1].encode("cp850").decode("cp1252")]
    rows = [("text", f"t{i}", t) for i, t in enumerate([*clean, science, "Cuesta 50 ¢ en 3 m².", science + " La " + "canción del niño".encode().decode("latin-1"), *twins])]
    got = {r.document_id: r.restored for r in mojibake.damaged(spark.createDataFrame(rows, "field string, document_id string, text string")).collect()}
    assert got == {"t4": science + " La canción del niño", "t5": clean[0], "t6": clean[0], "t7": clean[0], "t8": clean[1]}


def test_damage_with_repeated_rows_and_null_ids(spark):
    clean = ["La canción del niño cambió.", "El año pasado llegó."]
    bad = [c.encode().decode("cp1252") for c in clean]
    rows = [("text", "a", clean[0]), ("text", "a", bad[0]), ("text", "a", bad[0]), ("text", None, bad[1]), ("text", None, clean[1]), (None, "b", bad[1])]
    got = sorted(map(str, map(tuple, mojibake.damaged(spark.createDataFrame(rows, "field string, document_id string, text string")).collect())))
    assert got == sorted(map(str, [("text", "a", clean[0]), ("text", None, clean[1]), (None, "b", clean[1])]))


def test_signs_strewn_over_a_text_are_no_damage(spark):
    rows = [("text", "a", "tía común y más"), ("text", "b", "t°a po°i °esde °nt d°a ll° q°e °ab")]
    assert mojibake.damaged(spark.createDataFrame(rows, "field string, document_id string, text string")).collect() == []


# leaks


def plain_leaks(items, texts, n=7, share=0.5):
    out = set()
    for item, passage in items:
        p = leakage.bare_words(passage)
        for doc, text in enumerate(texts):
            grams = {tuple(d[i : i + n]) for d in [leakage.bare_words(text or "")] for i in range(len(d) - n + 1)}
            covered = {k + j for k in range(len(p) - n + 1) if tuple(p[k : k + n]) in grams for j in range(n)}
            if covered and len(covered) >= share * len(p):
                out.add((item, doc))
    return out


def test_leaks_equal_brute_force(spark):
    draw = random.Random(3)
    words = ["sol", "año", "luz", "mar", "pan"]
    passages = [(i, " ".join(draw.choices(words, k=20))) for i in range(8)]
    texts = [" ".join(draw.choices(words, k=60)) + " " + " ".join(p.split()[:k]) for _, p in passages for k in (6, 9, 10, 20)] + [None, "", "x" * 100_000]
    items = spark.createDataFrame([*passages, passages[0], (99, None), (None, "x"), (98, "muy corto")], "item_id long, passage string")
    for block in (3, 1000):
        got = {(r.item_id, r.doc_id) for r in leakage.leaks(items, documents(spark, texts), block=block).collect()}
        assert got == plain_leaks(passages, texts)


def test_case_accents_and_breaks_make_no_difference(spark):
    passage = "El médico cambió según el público asistente durante aquel invierno largo"
    text = "Antes. EL MEDICO, cam-\nbió — segun\r\nel pu-\n  blico_asistente durante aquel «invierno» largo. Después."
    items, docs = spark.createDataFrame([(1, passage)], "item_id long, passage string"), documents(spark, [text, "nada"])
    assert leakage.leaks(items, docs).count() == 1
    cut = {r.doc_id: r.text for r in leakage.without_leaks(items, docs).collect()}
    assert cut == {0: "Antes. . Después.", 1: "nada"} and leakage.without_leaks(items, docs, drop=True).count() == 1


def test_cuts_are_the_same_for_any_number_of_items(spark):
    a = "uno dos tres cuatro cinco seis siete ocho nueve diez"
    b = "seis siete ocho nueve diez once doce trece catorce quince"
    items = spark.createDataFrame([(1, a), (2, b)], "item_id long, passage string")
    text = "Ini\u0301cio_de\r\ntexto, " + a + ", ONCE doce-trece catorce (quince). Fin_de_texto\r\n"
    texts = [text, "nada _que_ ver\r", None, "", text, a + " y más y más " + a]
    want = ["Ini\u0301cio_de\r\ntexto, ). Fin_de_texto\r\n", "nada _que_ ver\r", None, "", "Ini\u0301cio_de\r\ntexto, ). Fin_de_texto\r\n", " y más y más "]
    for block in (100, 1):
        assert [r.text for r in leakage.without_leaks(items, documents(spark, texts), block=block).orderBy("doc_id").collect()] == want
        assert len(leakage.without_leaks(items, documents(spark, texts), block=block).columns) == len(documents(spark, texts).columns)


# mixing


def test_budgets_and_shares(spark):
    targets = spark.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.3, 2), (1, "c", 0.2, None), (2, "zz", 1.0, 3), (None, "a", 1.0, 1), (1, "a", 0.5, 1)], "mix_id long, source_code string, target_share double, max_repeats int")
    tokens = spark.createDataFrame([(i, "abc"[i % 3], "es", "x", [10, 40, 50][i % 3]) for i in range(30)], "doc_id long, source string, language string, domain string, n_tokens long")
    budgets = {(r.mix_id, r.source_code): r for r in mixing.mix_budgets(targets, mixing.source_profile(tokens)).collect()}
    assert not budgets[1, "a"].reachable and budgets[1, "b"].reachable and budgets[1, "c"].reachable and budgets[2, "zz"].granted_tokens == 0
    assert sum(b.granted_tokens for (m, _), b in budgets.items() if m == 1) == pytest.approx(1000) and budgets[1, "b"].granted_tokens <= 800
    table = mixing.mix_budgets(targets, mixing.source_profile(tokens))
    taken = mixing.mix_selection(table, tokens, seed=1, range_tokens=100).groupBy("source_code").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("t"), F.max("copies").alias("m")).collect()
    for r in taken:
        assert r.t <= budgets[1, r.source_code].granted_tokens + 1e-6 < r.t + 50 and r.m <= budgets[1, r.source_code].max_repeats


def test_selection_is_repeatable(spark):
    targets = spark.createDataFrame([(1, "a", 1.0, 1), (1, "b", 0.0, 1)], "mix_id long, source_code string, target_share double, max_repeats int")
    tokens = spark.createDataFrame([(i, "a", "es", "x", 1 + i % 5) for i in range(50)], "doc_id long, source string, language string, domain string, n_tokens long")
    table = mixing.mix_budgets(targets, mixing.source_profile(tokens))
    one, two = ({(r.doc_id, r.copies) for r in mixing.mix_selection(table, t, seed=7).collect()} for t in (tokens, tokens.repartition(3)))
    assert one == two and len(one) == 50


def test_shortages_go_to_siblings_first(spark):
    targets = spark.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.2, 9), (1, "c", 0.3, 9)], "mix_id long, source_code string, target_share double, max_repeats int")
    rows = [(1, "a", "es", "x", 100), (2, "b", "es", "x", 450), (3, "c", "es", "y", 300), (4, "c", "pt", "y", 150)]
    tokens = spark.createDataFrame(rows, "doc_id long, source string, language string, domain string, n_tokens long")
    got = {(r.source_code, r.language): r for r in mixing.mix_budgets(targets, mixing.source_profile(tokens)).collect()}
    assert not got["a", "es"].reachable and got["a", "es"].granted_tokens == 100
    assert got["b", "es"].granted_tokens == pytest.approx(200 + 400)  # the sibling in domain x takes all that a lacks
    assert got["c", "es"].granted_tokens == pytest.approx(200) and got["c", "pt"].granted_tokens == pytest.approx(100)


# prose or not

PROSE = "La mañana llegó sin prisa y el maestro abrió la puerta de la escuela. Los niños entraron con sus libros, hablaron de la fiesta y se sentaron. Más tarde, la lluvia cambió el plan de todos; nadie se quejó de eso en el pueblo.\n\nAl final del día, el vecino más viejo contó la historia del río. Todos la conocían, pero la escucharon otra vez con mucha paciencia y algo de sueño."
LISTS = ["\n".join(f"{i}\t{i * 37}\t{i * 91},5\tn/d" for i in range(30)), "\n".join(f"- El capítulo {i}" for i in range(30)), "\n".join(f"amable, {i}, {i + 3}, {i + 9}" for i in range(30)), "\n".join(["CAPÍTULO I", "PÁGINA 12"] * 15), "d41d8cd98f00b204e9800998ecf8427e" * 20]


def test_rules_tell_prose_from_lists(spark):
    got = {r.doc_id for r in quality.unnatural(documents(spark, [PROSE, PROSE.replace(" ", "\n"), "—" + PROSE.replace(". ", ".\n—"), *LISTS, *AWKWARD[:3]])).collect()}
    assert {3, 4, 5, 6, 7} <= got and not got & {0, 1, 2, 8, 9, 10}


def test_measures(spark):
    row = quality.text_statistics(documents(spark, ["12 3.\nÁÉÍÓÚ ABC\nigual.\nigual.\nigual.\n\n[[PÁGINA 3]] pa-\nlabra\x07�", None])).orderBy("doc_id").collect()
    a, b = row
    assert (a.line_count, a.non_empty_line_count, a.replacement_character_count, a.control_character_count, a.page_marker_count, a.hyphenated_line_break_count) == (8, 7, 1, 1, 1, 1)
    assert a.repeated_line_ratio == 3 / 7 and a.numeric_line_ratio == 1 / 7 and a.uppercase_line_ratio == 1 / 7 and b.character_count == 0 and b.failures == []


def test_residue(spark):
    found = ["Editor: {autor}\nTítulo: ${titulo}\nFecha: @@FECHA@@", "Título de prueba\n\nInicio | Ayuda | Volver\n\nError 404. La página no existe.\n\n© 2020 X", "Publicado: null · Autor: undefined", "bla bla bla bla.\n" * 9, "Active JavaScript en su navegador.", "Lorem ipsum dolor sit amet. " * 30, "[Insertar resumen aquí]\nXXXXX XXXX\ndd/mm/aaaa"]
    kept = [PROSE, PROSE + " El mensaje «Error 404» apareció en la pantalla. La plantilla decía {nombre} y nada más.", "Editor: Pérez\nTítulo: Sol\nFecha: 2010", None, "", "Título solo\n\nInicio | Ayuda"]
    got = {r.doc_id for r in residue.residue(documents(spark, found + kept)).collect()}
    assert got == set(range(len(found)))
    assert residue.without_residue(documents(spark, found + kept)).count() == len(kept)


def test_long_residue(spark):
    menu = "\n".join(f"Sección {a}{b}" for a in "abcdefghij" for b in "abcdefghij")
    latin = " ".join(random.Random(1).choices(["dolor", "magna", "veniam", "laboris", "mauris", "turpis", "felis"], k=200)) + "."
    found = [f"{menu}\n\nActive JavaScript en su navegador.\n\n© 2020 X", "El servidor de la biblioteca no respondió a tiempo y la página no existe. " * 20, latin]
    kept = [PROSE * 5, PROSE + f"\n\n{menu}"]
    assert all(len(t) > 600 for t in found)
    assert {r.doc_id for r in residue.residue(documents(spark, found + kept)).collect()} == {0, 1, 2}


def test_pages_that_share_their_content(spark):
    poem = "La tarde cae sobre el río y la barca espera junto a la orilla. Nadie canta ya en la casa del molino."
    odd = "Aquí hubo algo que ahora duerme. Vuelva cuando despierte."
    def long(seed):  # no two share a sentence
        draw = random.Random(seed)
        return " ".join(" ".join("".join(draw.choices("aeiolnrst", k=6)) for _ in range(8)).capitalize() + "." for _ in range(9))

    copies = [poem] * 4 + [f"La barca\n\n{poem}\n\n© {y} Archivo" for y in (2001, 2002, 2003, 2004)]
    quoting = [f"{long(1)} {odd}"]
    pages = [f"{t}\n\n{odd}" for t in ("Museo de la villa", "Actas del congreso", "Revista de letras", "Cartas a un amigo")]
    common = [f"{long(k)} Llegó tarde. {long(k + 9)}" for k in range(2, 6)] + [f"{t}\n\nLlegó tarde." for t in ("Ana", "Eva", "Sol")] + [f"{t}\n\n{n} 41,5 {n + 7}\n{n} 12 9" for n, t in enumerate(("Ana", "Eva", "Sol", "Luz"))]
    entries = ["la casa vieja", "el río ancho", "la luz clara", "el valle verde", "la voz baja", "el mar gris", "la flor roja"]
    common += ["\n".join(e.capitalize() + "." for e in random.Random(k).sample(entries, 4)) for k in range(14)]
    got = {r.doc_id for r in residue.residue(documents(spark, copies + quoting + common + pages)).collect()}
    assert got == set(range(len(copies + quoting + common), len(copies + quoting + common + pages)))


def test_filled_and_unfilled_slots_align():
    hashes, kept, filled, odd, _, values = residue.templates(["Editor: {autor}", "Editor: Pérez", "Editor: ", "Editor: $autor", "El libro de {x}, 12", "El libro de Juan, 7", "3 4", "3 4 5", "~"])
    assert len(set(hashes[:4])) == 1 and hashes[4] == hashes[5] and len(set(hashes[6:])) == 3
    assert (kept[:4].tolist(), filled[:4].tolist(), odd[:4].tolist()) == ([1, 0, 1, 0], [0, 1, 0, 0], [0, 0, 0, 1]) and values == {}


def test_unknown_notations_and_defaults_show_in_aligned_records(spark):
    forms = [f"Registro {name}\n\nEste libro de $nombre salió en $lugar y lo guarda :casa: con ~CAMPO~ dentro." for name in ("Sol", "Mar", "Luz", "Voz")]
    labels = [f"Ficha {name}\n\nAutor: pendiente\nLugar: pendiente\nEditor: pendiente" for name in ("uno", "dos", "tres")]
    real = [f"Ficha {name}\n\nAutor: {a}\nLugar: {b}\nEditor: {c}" for name, a, b, c in (("cuatro", "anónimo", "costa", "imprenta vieja"), ("cinco", "anónimo", "sierra", "taller"), ("seis", "anónimo", "llano", "casa"))]
    lone = ["Este otro texto de $nombre es el único de su forma, y por eso no dice nada de $lugar ni de :casa: alguna."]
    got = {r.doc_id for r in residue.residue(documents(spark, [*forms, *labels, *real, *lone, PROSE])).collect()}
    assert got == set(range(7))


@pytest.mark.parametrize("size", [380, 420, 520, 650, 2000, 5000])
def test_size_makes_no_difference(spark, size):
    draw = random.Random(size)
    message = ("El servidor de la biblioteca no respondió a tiempo y la página no existe. " * 80)[:size].rpartition(".")[0] + "."
    words = ["".join(draw.choices("aeiolnrst", k=7)) for _ in range(400)]
    page = " ".join(f"{' '.join(draw.choices(words, k=9)).capitalize()}." for _ in range(80))[:size].rpartition(".")[0] + "."
    got = {r.doc_id for r in residue.residue(documents(spark, [message, *(f"Entrada {n}\n\n{page}" for n in ("sol", "mar", "luz")), PROSE])).collect()}
    assert got == {0, 1, 2, 3}


def test_a_number_like_a_code_in_one_list_says_nothing_of_others(spark, tmp_path):
    names = ["La propuesta", "El camino", "La memoria", "El grupo", "La opinión", "El invierno", "La jornada", "El mercado", "La rima", "El puente"]
    lists = ["\n".join(f"- {names[(k + i) % 10]} ({7000 + 10 * k + i if i else 404})" for i in (0, 1, 3, 4, 8)) for k in range(10)]
    messages = ["Error 404: la página no existe.", "La opinión.\n" * 4, "El servidor no respondió y la página no existe. Pulse aquí."]
    docs = documents(spark, [*lists, *messages, PROSE])
    assert {r.doc_id for r in residue.residue(docs).collect()} == {10, 11, 12}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in queries.p5_found(spark, str(tmp_path)).collect()} == set(range(10))


def test_kept_documents_by_a_stated_rule(spark):
    texts = [*(f"Entrada {n}\n\nBla bla bla." for n in "abc"), "Autor: {x}", PROSE, None, ""]
    kept = residue.without_residue(documents(spark, texts))
    assert {r.doc_id for r in kept.collect()} == {4, 5, 6} and kept.columns == documents(spark, texts).columns


def test_short_lists_and_other_languages(spark):
    german = ["Der Hund läuft durch die Stadt und der Mann sieht ihn nicht. Die Frau ist in dem Haus und liest das Buch.", "Die Stadt ist alt und das Haus ist neu. Der Mann geht in die Stadt und die Frau liest.", "Das Buch ist gut und der Mann liest es in dem Haus. Die Frau geht durch die Stadt und sieht den Hund."]
    polish = ["To jest dom i nie ma w nim psa. Kobieta czyta w domu, a pies jest na ulicy i nie wraca.", "W mieście jest dom i na ulicy jest pies. Nie ma tu kobiety, to jest stary dom."]
    lists = ["Madrid Barcelona Sevilla Valencia", "rojo azul verde negro blanco gris rosa ocre", "- pan\n- sal\n- ajo\n- uva"]
    texts = [(0, t, "de") for t in german] + [(1, t, "pl") for t in polish] + [(2, "Solo un texto en esta lengua rara, que no conoce nadie. No hay otro.", "xx")] + [(3, t, "es") for t in [PROSE, PROSE.upper(), *lists]]
    rows = spark.createDataFrame([(i, t, l) for i, (_, t, l) in enumerate(texts)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in quality.unnatural(rows).collect()} == {8, 9, 10}


def test_measures_equal_plain_ones(spark):
    draw = random.Random(9)
    for text in ["".join(draw.choices("aÁb 1.,\n\r\t-…»²~ñ\u2028_", k=300)) for _ in range(8)]:
        row = quality.text_statistics(documents(spark, [text])).first()
        lines = [l.strip() for l in re.split("\r\n|[\n\r\u2028]", text)]
        lines = lines[:-1] if not lines[-1] else lines
        full = [l for l in lines if l]
        words = re.findall(r"[^\W\d_²]+", text)
        assert (row.line_count, row.non_empty_line_count, row.word_count, row.character_count) == (len(lines), len(full), len(words), len(text))
        assert row.short_line_ratio == sum(len(l) <= 25 for l in full) / len(full) and row.mean_word_length == pytest.approx(sum(map(len, words)) / len(words))
        assert row.hyphenated_line_break_count == len(re.findall(r"[^\W\d_²]-\r?\n", text)) and row.sentences_per_100_words == pytest.approx(100 * len(re.findall(r"[.!?…](?=[\s\"”»]|$)", text)) / len(words))
        assert row.punctuated_line_ratio == sum(l[-1] in ".!?…:;»”\"" for l in full) / len(full) and row.digit_ratio == pytest.approx(text.count("1") / len(text))


# languages

TEXTS = {
    "es": "el perro come en la calle y los niños miran con mucha atención porque no hay nada más que hacer", "pt": "o cachorro come na rua e as crianças olham com muita atenção porque não há mais nada que fazer",
    "en": "the dog eats in the street and the children look with great attention because there is nothing else to do", "fr": "le chien mange dans la rue et les enfants regardent avec beaucoup d'attention parce que il n'y a rien d'autre",
    "it": "il cane mangia nella strada e i bambini guardano con molta attenzione perché non c'è nient'altro da fare", "ca": "el gos menja al carrer i els nens miren amb molta atenció perquè no hi ha res més a fer",
}


@pytest.fixture(scope="module")
def model():
    pieces = language.public_pieces(queries.PIECES)
    return language.train([(c, t) for c, t in TEXTS.items() for _ in range(3)], pieces)


def test_forward_sums_all_segmentations(model):
    ids, p = {"▁ab": 0, "▁a": 1, "b": 2, "▁": 3, "a": 4, "ab": 5}, None
    import numpy as np

    p = np.array([[0.1, 0.2, 0.3, 0.05, 0.15, 0.12, 1e-7]])
    got = np.exp(language.Arcs(["ab"], ids, 6, 3).log_likelihoods(p))[0, 0]
    assert got == pytest.approx(0.1 + 0.2 * 0.3 + 0.05 * 0.12 + 0.05 * 0.15 * 0.3)


def test_long_words_are_scored_whole(model):
    unknown, longest = len(model.pieces), model.longest
    score = lambda w: language.Arcs([w], model.ids, unknown, longest).log_likelihoods(model.probabilities)[0]
    plain = language.Arcs(["cachorro"], model.ids, unknown, longest)
    whole, _ = plain.forward(model.probabilities)
    assert np.allclose(score("cachorro"), np.log(whole[:, 0, -1]))
    long = "cachorro" * 400
    assert np.isfinite(score(long)).all() and (score(long) < 300 * score("cachorro") / 2).all()
    assert not np.allclose(score("cachorro" * 5 + "the" * 30), score("cachorro" * 5 + "que" * 30))  # what lies far behind counts
    assert np.allclose(language.Scorer(model).sums([[long, "que"], ["que"]])[0], score(long) + score("que"))


def test_expectation_raises_the_likelihood():
    import numpy as np

    ids, words, counts = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}, ["ab", "aab", "b"], np.array([5.0, 3.0, 2.0])
    arcs, p, before = language.Arcs(words, ids, 5, 3), np.full(6, 1 / 6), -np.inf
    for _ in range(6):
        now = (arcs.log_likelihoods(p[None])[:, 0] * counts).sum()
        assert now >= before - 1e-9
        before, uses = now, arcs.expected(p, counts)
        p = uses / uses.sum() + 1e-12


def test_languages_of_texts_and_paragraphs(spark, model):
    texts = [*TEXTS.values(), TEXTS["es"] + "\n\n" + TEXTS["es"] + " como\n\n" + TEXTS["en"], *AWKWARD]
    rows = spark.createDataFrame([(f"d{i}", t, None) for i, t in enumerate(texts)], "document_id string, text string, label string")
    got = {(r.document_id, r.segment_no): r for r in language.document_languages(rows, model).collect()}
    assert [got[f"d{i}", 0].language for i in range(6)] == list(TEXTS)
    assert got["d6", 0].language == "es" and got["d6", 3].language == "en" and got["d6", 3].running and 0 < got["d6", 3].confidence <= 1
    assert ("d7", 0) not in got and ("d8", 0) not in got
    records = spark.createDataFrame([("r1", TEXTS["it"], "es"), ("r2", None, None), ("r3", "", "en")], "identifier string, text string, label string")
    assert [(r.identifier, r.shown) for r in language.record_languages(records, model).orderBy("identifier").collect()] == [("r1", "it"), ("r2", None), ("r3", None)]


def test_labels(spark):
    labels = {"es": "es", "ES ": "es", "Español": "es", "es_CO": "es", "pt-BR": "pt", "català": "ca", "eng": "en", "xx": None, "": None, "?": None, "n/d": None, None: None, "de": "", "français": "fr"}
    rows = spark.createDataFrame([(k,) for k in labels], "l string").withColumn("c", language.codes("l")).collect()
    assert {r.l: r.c for r in rows} == labels and {k: language.label_code(k) for k in labels} == labels


# subjects


def test_areas_of_texts(spark):
    draw = random.Random(5)
    matter = {"salud": "hospital vacuna fiebre paciente médico clínica".split(), "derecho": "juez sentencia tribunal contrato fiscal abogado".split(), "deporte": "partido torneo arquero liga estadio entrenador".split()}
    common = "casa camino tarde mañana grupo pueblo memoria orilla plazo equipo documento valle".split()
    texts, truth = [], []
    for i in range(400):
        a, b = draw.sample(sorted(matter), 2)
        kind = i % 4
        of = [] if kind == 3 else [(a, 12)] if kind else [(a, 8), (b, 8)]
        words = draw.choices(common, k=30) + [w for x, k in of for w in draw.choices(matter[x], k=k)]
        draw.shuffle(words)
        texts.append(" ".join(words))
        truth.append({x for x, _ in of})
    docs = documents(spark, texts)
    known = spark.createDataFrame([(i, sorted(t)[0], 1.0) for i, t in enumerate(truth) if t and i % 5 == 0], "doc_id long, area string, weight double")
    areas = [(a, a, f"Trata de {w[0]} y {w[1]}.") for a, w in sorted(matter.items())]
    got = {r.doc_id: r for r in subjects.subject_mixtures(docs, areas, known).collect()}
    found = [{areas[k][0] for k, v in enumerate(got[i].shares) if v >= 0.2} if got[i].specific >= 3 else set() for i in range(400)]
    assert sum(f == t for f, t in zip(found, truth)) >= 0.95 * len(truth)


def test_meaning_of_subjects(spark):
    areas = spark.createDataFrame([("salud", "Salud y medicina", "S01", "x"), ("derecho", "Derecho", "S02", "y")], "area string, area_name string, scheme_code string, description string")
    rows = [(["clasif:S01.09", "Medicina interna"],)] * 4 + [(["clasif:S02.1", "General; Law."],), (["General", "clasif:S01.1"],)] + [(["LAW", "S02"],)] * 3 + [(["General", "clasif:S02.7"],), (None,), ([],), ([None, ""],)]
    got = {r.subject: r.area for r in subjects.subject_areas(spark.createDataFrame(rows, "subjects array<string>"), areas).collect()}
    assert got["medicina interna"] == "salud" and got["law"] == "derecho" and "general" not in got and got["clasif:s01.09"] == "salud"


# shared


@pytest.mark.parametrize("texts", [AWKWARD, []])
def test_awkward_and_empty_tables(spark, model, texts):
    docs = documents(spark, texts)
    n = len(texts)
    assert term_counts.term_counts(docs, length=2).count() >= 0 and quality.text_statistics(docs).count() == n
    assert residue.residue(docs).count() == 0 and leakage.leaks(spark.createDataFrame([], "item_id long, passage string"), docs).count() == 0
    assert token_counts.token_counts(docs, spark.createDataFrame([], "word string")).count() == n
    assert mojibake.damaged(docs.select(F.lit("text").alias("field"), "document_id", "text")).where("document_id != 'd6'").count() == 0
    assert subjects.subject_mixtures(docs, [("a", "A", "uno"), ("b", "B", "dos")], spark.createDataFrame([], "doc_id long, area string, weight double"), least_share=0.0).count() == n
    assert language.document_languages(docs.withColumn("label", F.lit(None).cast("string")), model).count() >= 0


def test_newest_takes_the_last_state(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z")], "k string, at int, v string")
    assert {tuple(r) for r in newest(rows, "k", "at", "v").collect()} == {("a", "y"), ("b", "z")}
    assert written(rows).count() == 5


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_run(spark, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    rows = df.collect()
    columns = {"p1_found": ["doc_id", "area"], "p2_found": ["batch_no", "word", "mark"], "p3_found": ["record_type", "record_key", "segment_no", "language"], "p4_found": ["doc_id", "n_tokens"], "p5_found": ["doc_id"], "p6_found": ["field", "document_id", "restored_md5"], "p7_found": ["item_id", "doc_id"], "p8_found": ["mix_id", "source_code"], "p9_found": ["doc_id"]}
    if name in columns:
        assert df.columns == columns[name] and len(set(rows)) == len(rows)
