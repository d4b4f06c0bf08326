"""Measures of each text, anomalies by configurable thresholds, and editorial scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

# The base profile's thresholds, scores and penalties, what other profiles change, and the profile of each document type.
BASE = {
    "minimum_words": 1000, "minimum_characters": 5000, "maximum_replacement_characters": 0, "maximum_null_characters": 0, "maximum_control_characters": 0, "maximum_symbol_ratio": 0.03,
    "maximum_numeric_line_ratio": 0.03, "maximum_repeated_line_ratio": 0.08, "maximum_uppercase_line_ratio": 0.08, "warning_hyphenated_line_breaks": 10, "warning_short_line_ratio": 0.65, "warning_long_line_length": 400,
    "initial_score": 100,
}
PENALTIES = {
    "replacement_characters": 40, "null_characters": 50, "control_characters": 40, "page_markers": 20, "excessive_symbols": 20, "repeated_lines": 15, "numeric_lines": 10, "uppercase_lines": 10,
    "hyphenated_line_breaks": 5, "excessive_short_lines": 5, "excessive_long_lines": 5,
}
PROFILES = {
    "default": {},
    "novela": {"thresholds": {"maximum_numeric_line_ratio": 0.02, "maximum_repeated_line_ratio": 0.06, "maximum_uppercase_line_ratio": 0.06, "warning_short_line_ratio": 0.55}},
    "obra_dialogada": {
        "thresholds": {"maximum_numeric_line_ratio": 0.06, "maximum_repeated_line_ratio": 0.35, "maximum_uppercase_line_ratio": 0.30, "warning_short_line_ratio": 0.85},
        "disabled": ["repeated_lines", "uppercase_lines"], "severities": {"numeric_lines": "WARNING", "excessive_short_lines": "INFO"}, "penalties": {"numeric_lines": 5, "excessive_short_lines": 0},
    },
    "poesia": {
        "thresholds": {"maximum_repeated_line_ratio": 0.20, "maximum_uppercase_line_ratio": 0.15, "warning_short_line_ratio": 0.90}, "disabled": ["excessive_short_lines"],
        "penalties": {"repeated_lines": 5, "uppercase_lines": 5},
    },
    "articulo_cientifico": {
        "thresholds": {"minimum_words": 500, "maximum_numeric_line_ratio": 0.12, "maximum_repeated_line_ratio": 0.08, "maximum_uppercase_line_ratio": 0.10, "warning_long_line_length": 600},
        "severities": {"numeric_lines": "INFO"}, "penalties": {"numeric_lines": 0, "excessive_long_lines": 2},
    },
    "tesis": {
        "thresholds": {"minimum_words": 5000, "maximum_numeric_line_ratio": 0.10, "maximum_repeated_line_ratio": 0.12, "maximum_uppercase_line_ratio": 0.12, "warning_long_line_length": 700},
        "severities": {"numeric_lines": "INFO"}, "penalties": {"numeric_lines": 0, "repeated_lines": 5},
    },
    "prensa": {
        "thresholds": {"minimum_words": 100, "minimum_characters": 500, "maximum_numeric_line_ratio": 0.08, "maximum_repeated_line_ratio": 0.10, "maximum_uppercase_line_ratio": 0.15, "warning_short_line_ratio": 0.60},
    },
    "libro_no_ficcion": {"thresholds": {"minimum_words": 1000, "maximum_numeric_line_ratio": 0.06, "maximum_repeated_line_ratio": 0.08, "maximum_uppercase_line_ratio": 0.10}},
}
PROFILE_OF = {
    "novela": "novela",
    "novela_picaresca": "novela",
    "cuento": "novela",
    "relato": "novela",
    "obra_dialogada": "obra_dialogada",
    "teatro": "obra_dialogada",
    "obra_teatral": "obra_dialogada",
    "drama": "obra_dialogada",
    "obra_dramatica": "obra_dialogada",
    "poesia": "poesia",
    "poemario": "poesia",
    "verso": "poesia",
    "articulo_cientifico": "articulo_cientifico",
    "articulo_academico": "articulo_cientifico",
    "paper": "articulo_cientifico",
    "tesis": "tesis",
    "tesina": "tesis",
    "trabajo_recepcion": "tesis",
    "noticia": "prensa",
    "articulo_periodistico": "prensa",
    "editorial_periodistico": "prensa",
    "prensa": "prensa",
    "ensayo": "libro_no_ficcion",
    "libro_no_ficcion": "libro_no_ficcion",
    "divulgacion": "libro_no_ficcion",
    "manual": "libro_no_ficcion",
}
# By code, its severity, the measure it looks at, the threshold (None: any occurrence), and its message.
RULES = {
    "replacement_characters": ("ERROR", "replacement_character_count", "maximum_replacement_characters", "Se encontraron caracteres Unicode de sustitución."),
    "null_characters": ("ERROR", "null_character_count", "maximum_null_characters", "Se encontraron caracteres nulos."),
    "control_characters": ("ERROR", "control_character_count", "maximum_control_characters", "Persisten caracteres de control."),
    "page_markers": ("ERROR", "page_marker_count", None, "Persisten marcas temporales de página."),
    "excessive_symbols": ("WARNING", "symbol_ratio", "maximum_symbol_ratio", "La proporción de símbolos no lingüísticos es elevada."),
    "numeric_lines": ("WARNING", "numeric_line_ratio", "maximum_numeric_line_ratio", "Existe una proporción elevada de líneas numéricas."),
    "repeated_lines": ("WARNING", "repeated_line_ratio", "maximum_repeated_line_ratio", "Se detectó repetición excesiva de líneas."),
    "uppercase_lines": ("WARNING", "uppercase_line_ratio", "maximum_uppercase_line_ratio", "Existe una proporción elevada de líneas en mayúsculas."),
    "hyphenated_line_breaks": ("WARNING", "hyphenated_line_break_count", "warning_hyphenated_line_breaks", "Se detectaron posibles palabras cortadas por salto de línea."),
    "excessive_short_lines": ("INFO", "short_line_ratio", "warning_short_line_ratio", "El documento contiene muchas líneas cortas. Puede corresponder a teatro o verso."),
    "excessive_long_lines": ("INFO", "long_line_count", None, "Se encontraron líneas excesivamente largas."),
}
SEVERITIES = {code: rule[0] for code, rule in RULES.items()}
#: Examples of lines that an anomaly shows, fewer of long lines, and the code points of those.
EXAMPLES, LONG_EXAMPLES, LONG_SHOWN = 10, 5, 200


def deep_merge(base: dict, over: dict) -> dict:
    """over laid on base, dictionaries inside each other likewise."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def profile(name: str, profiles: dict = PROFILES) -> dict:
    """A profile with all values: the base and what the profile changes."""
    base = {"thresholds": BASE, "disabled": [], "severities": SEVERITIES, "penalties": PENALTIES}
    return deep_merge(base, profiles.get(name, {}))


def _is_short(line):
    return F.length(line) <= 25


def _full_lines(t):
    return F.filter(F.transform(T.lines(t), T.strip), lambda l: l != "")


def measures(df: DataFrame, text: str = "text", long_line=BASE["warning_long_line_length"], examples: bool = False) -> DataFrame:
    """Adds the measures of the column text; a null text has the measures of an empty one.

    long_line: the length beyond which a line is long, a number or a column. With examples there are, besides, `shown`, a map of
    the lines that an anomaly shows by its code, and `counted`, a map of how many lines it is about.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    long_line = F.lit(long_line) if isinstance(long_line, int) else long_line
    out = df.withColumn("_lines", F.transform(T.lines(t), T.strip)).withColumn("_full", F.filter("_lines", lambda l: l != "")).withColumn("_limit", long_line)
    n = F.size("_full")
    is_long = lambda l: F.length(l) > F.col("_limit")
    of = {"numeric_lines": T.is_numeric_line, "uppercase_lines": T.is_uppercase_line, "excessive_short_lines": _is_short, "excessive_long_lines": is_long}
    share = lambda test: T.ratio(F.size(F.filter("_full", test)), n)
    kept = F.transform(F.filter("_full", lambda l: F.length(l) >= 5), lambda l: F.regexp_replace(l, f"[{T.WS}]+", " "))
    # of sorted lines, those equal to the second one before or to their neighbours on both sides or to the second one after are in runs of three or more
    out = out.withColumn("_ordered", F.array_sort(kept))
    at = lambda i: F.get("_ordered", i)
    repeated = F.filter("_ordered", lambda l, i: ((at(i - 2) == l) & (at(i - 1) == l)) | ((at(i - 1) == l) & (at(i + 1) == l)) | ((at(i + 1) == l) & (at(i + 2) == l)))
    out = out.withColumn("_repeated", F.coalesce(F.size(repeated), F.lit(0)))
    more = []
    if examples:
        shown = [F.lit("excessive_long_lines"), F.transform(F.slice(F.filter("_full", is_long), 1, LONG_EXAMPLES), lambda l: F.substring(l, 1, LONG_SHOWN))]
        counted = [F.lit("repeated_lines"), F.col("_repeated").cast("long")]
        for code, test in of.items():
            found = F.filter("_full", test)
            counted += [F.lit(code), F.size(found).cast("long")]
            shown += [F.lit(code), F.slice(found, 1, EXAMPLES)] if code != "excessive_long_lines" else []
        more = [F.create_map(*shown).alias("shown"), F.create_map(*counted).alias("counted")]
    return out.select(
        *df.columns,
        F.length(t).cast("long").alias("character_count"), T.word_count(t).alias("word_count"), F.size("_lines").cast("long").alias("line_count"), n.cast("long").alias("non_empty_line_count"),
        F.regexp_count(t, F.lit("\ufffd")).cast("long").alias("replacement_character_count"), F.regexp_count(t, F.lit("\\u0000")).cast("long").alias("null_character_count"),
        F.regexp_count(t, F.lit("[\\u0001-\\u0008\\u000b\\u000c\\u000e-\\u001f\\u007f]")).cast("long").alias("control_character_count"),
        F.regexp_count(t, F.lit(T.PAGE_MARK)).cast("long").alias("page_marker_count"), F.regexp_count(t, F.lit("[\\p{L}\\p{N}_]-\n")).cast("long").alias("hyphenated_line_break_count"),
        T.ratio(F.regexp_count(t, F.lit(T.SYMBOL)), F.length(t)).alias("symbol_ratio"), share(T.is_numeric_line).alias("numeric_line_ratio"), T.ratio(F.col("_repeated"), n).alias("repeated_line_ratio"),
        share(T.is_uppercase_line).alias("uppercase_line_ratio"), share(_is_short).alias("short_line_ratio"), F.size(F.filter("_full", is_long)).cast("long").alias("long_line_count"), *more,
    )


_RULE_SCHEMA = "profile string, thresholds map<string,double>, disabled array<string>, severities map<string,string>, penalties map<string,int>"


def profiles_table(spark: SparkSession, names: list[str]) -> DataFrame:
    """The named profiles, one row each."""
    rows = []
    for name in names:
        p = profile(name)
        rows.append((name, {k: float(v) for k, v in p["thresholds"].items()}, p["disabled"], p["severities"], p["penalties"]))
    return spark.createDataFrame(rows, _RULE_SCHEMA)


def anomalies(df: DataFrame) -> DataFrame:
    """Adds, to rows with measures and the columns of a profile, its anomalies in fixed order: structs of code, severity, message,
    count, ratio and, where the measures come with examples, examples.

    Examples of repeated lines come from repeated_lines, which needs a row for each line, and are joined by with_repeated.
    """
    found = []
    has_examples = "shown" in df.columns
    for code, (_, measure, threshold, message) in RULES.items():
        is_count = measure.endswith("count")
        most = F.element_at("thresholds", threshold) if threshold else F.lit(0.0)
        count = F.col(measure) if is_count else F.element_at("counted", F.lit(code)) if has_examples and code != "excessive_symbols" else F.lit(None).cast("long")
        share = F.lit(None).cast("double") if is_count else F.col(measure)
        lines = [F.coalesce(F.element_at("shown", F.lit(code)), F.array().cast("array<string>")).alias("examples")] if has_examples else []
        broken = (F.col(measure) > most) & ~F.array_contains("disabled", code)
        severity = F.element_at("severities", F.lit(code)).alias("severity")
        found.append(F.when(broken, F.struct(F.lit(code).alias("code"), severity, F.lit(message).alias("message"), count.alias("count"), share.alias("ratio"), *lines)))
    return df.withColumn("anomalies", F.filter(F.array(*found), lambda a: a.isNotNull()))


def with_repeated(df: DataFrame, repeated: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds to rows with anomalies and examples those of repeated lines: the most frequent ones, ties as they come in the text."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "first_line", "line")))
    text = F.transform(F.slice(order, 1, EXAMPLES), lambda r: F.concat(r["line"], F.lit(" ("), (-r["n"]).cast("string"), F.lit(" veces)")))
    known = repeated.groupBy(key).agg(text.alias("_repeated"))  # of one text only: the lines it has three times or more
    own = lambda a: F.when(a["code"] == "repeated_lines", F.coalesce("_repeated", a["examples"])).otherwise(a["examples"])
    return df.join(known, key, "left").withColumn("anomalies", F.transform("anomalies", lambda a: a.withField("examples", own(a)))).drop("_repeated")


def scores(df: DataFrame) -> DataFrame:
    """Adds, to rows with anomalies: errors, warnings and the score, from which each anomaly takes its penalty, within 0 and 100.

    Texts below the profile's least words or characters have an error more, without a penalty.
    """
    limit = lambda name: F.element_at("thresholds", F.lit(name))
    lost = F.aggregate("anomalies", F.lit(0), lambda acc, a: acc + F.coalesce(F.element_at("penalties", a["code"]), F.lit(0)))
    few = F.filter(F.array(F.when(F.col("word_count") < limit("minimum_words"), F.lit("few_words")), F.when(F.col("character_count") < limit("minimum_characters"), F.lit("few_characters"))), lambda x: x.isNotNull())
    of = lambda severity: F.transform(F.filter("anomalies", lambda a: a["severity"] == severity), lambda a: a["code"])
    return df.withColumns({"score": F.greatest(F.lit(0), F.least(F.lit(100), limit("initial_score") - lost)).cast("long"), "errors": F.concat(of("ERROR"), few), "warnings": of("WARNING")})


def profile_of(document_type: Column) -> Column:
    """The profile of a document type; types that aren't listed, and null, have the default one."""
    of = F.create_map(*[F.lit(x) for pair in PROFILE_OF.items() for x in pair])
    return F.coalesce(F.element_at(of, document_type), F.lit("default"))


def by_profile(df: DataFrame, document_type: str = "document_type", examples: bool = False) -> DataFrame:
    """measures, anomalies and scores of each row under the profile of its document type, whose limit for long lines holds.

    The profiles are a broadcast table of a few rows; rules are one set of expressions whatever their number.
    """
    known = profiles_table(df.sparkSession, sorted({*PROFILE_OF.values(), "default"}))
    rows = df.withColumn("profile", profile_of(F.col(document_type))).join(F.broadcast(known), "profile")
    measured = measures(rows, long_line=F.element_at("thresholds", F.lit("warning_long_line_length")), examples=examples)
    return scores(anomalies(measured)).drop("thresholds", "disabled", "severities", "penalties", "shown", "counted")


def repeated_lines(documents: DataFrame, key: str = "doc_id", least: int = 3, length: int = 5) -> DataFrame:
    """Rows (key, line, n, first_line): lines of at least `length` code points that a text has `least` times or more, white space
    inside a line counting as one blank."""
    each = documents.select(key, F.posexplode(F.transform(T.lines(F.col("text")), T.strip)).alias("at", "line")).where(F.length("line") >= length)
    each = each.withColumn("line", F.regexp_replace("line", f"[{T.WS}]+", " "))
    return each.groupBy(key, "line").agg(F.count(F.lit(1)).alias("n"), F.min("at").cast("long").alias("first_line")).where(F.col("n") >= least)
