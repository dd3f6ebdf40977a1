"""Quality rules by distribution divergence, with DataFrame functions only.

Per document: base counts, the histogram of its characters over ``CHAR_CLASSES`` and of its words over the
common words of its language (and all other words).  A language's references are the same histograms
summed over all its documents; documents of no language, or of one without a list of common words, are
held against all documents together, by characters only.  A document is kept when both Jensen-Shannon
distances (base 2, square root) are within their limits; a text below a minimum length is not judged by
that histogram.

The features of a document come from its own row (no word ever becomes a row of a table), are written
once, and feed both the references (a partial sum per language) and the verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "zu", "von", "mit", "den", "des"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "was", "for", "that", "with", "on"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "las", "un", "se", "para", "por"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "que", "est", "pour", "dans"),
}
N_COMMON = 12
# Classes of characters taken out of a text one after the other; what is left is the last class.
CHAR_CLASSES = (("space", r"[\x20\x09-\x0D]+"), ("lower", r"[a-z]+"), ("upper", r"[A-Z]+"), ("digit", r"[0-9]+"),
                ("stop", r"[.,;:!?'\"()-]+"), ("sign", r"[\x21-\x7E]+"))
MAX_CHAR_DISTANCE, MIN_CHARS = 0.22, 200
MAX_WORD_DISTANCE, MIN_WORDS = 0.29, 60
SPACE = r"\x20\x09-\x0D"


def _lang_case(value: dict[str, Column], lang: Column, other: Column) -> Column:
    out = other
    for k, v in value.items():
        out = F.when(lang == k, v).otherwise(out)
    return out


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` (and ``words``) to rows with ``text``."""
    df = docs.withColumn("text", F.coalesce("text", F.lit("")))
    df = df.withColumn("words", F.expr(rf"regexp_extract_all(text, '[^{SPACE}]+', 0)".replace("\\", "\\\\")))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("n_symbols", (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long"))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    # 5-word windows as hashes of their words' hashes; only a text with an equal pair has them sorted with places
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("windows", F.expr(
        "if(n_words < 5, cast(array() as array<bigint>), transform(sequence(0, cast(n_words as int) - 5), "
        "i -> xxhash64(hashes[i], hashes[i + 1], hashes[i + 2], hashes[i + 3], hashes[i + 4])))")).drop("hashes")
    df = df.withColumn("again", F.size(F.array_distinct("windows")) < F.size("windows"))
    df = df.withColumn("placed", F.expr(
        "if(again, sort_array(transform(windows, (h, i) -> struct(h as h, i as i))), cast(array() as array<struct<h:bigint,i:int>>))")) \
        .drop("windows", "again")
    df = df.withColumn("twice", F.expr(
        "sort_array(transform(filter(placed, (e, k) -> coalesce(get(placed, k - 1).h = e.h, false) or "
        "coalesce(get(placed, k + 1).h = e.h, false)), e -> e.i))")).drop("placed")
    # each window adds its words up to where the next one begins
    return df.withColumn("n_repeat_words", F.expr(
        "aggregate(transform(twice, (p, k) -> least(5, coalesce(get(twice, k + 1), p + 5) - p)), 0L, (a, x) -> a + x)")).drop("twice")


def _number_of(words: str, word: str) -> Column:
    return F.size(F.filter(words, lambda x: x == F.lit(word))).cast("long")


def histograms(rows: DataFrame) -> DataFrame:
    """Adds ``chars`` (counts by class), ``common`` (counts of the language's words and of all others) and ``word_chars``."""
    df = rows.withColumn("left0", F.col("text"))
    for k, (_, pattern) in enumerate(CHAR_CLASSES):
        df = df.withColumn(f"left{k + 1}", F.regexp_replace(f"left{k}", pattern, ""))
    sizes = [F.length(f"left{k}") for k in range(len(CHAR_CLASSES) + 1)]
    df = df.withColumn("chars", F.array(*[(a - b).cast("long") for a, b in zip(sizes, sizes[1:])], sizes[-1].cast("long")))
    df = df.withColumn("word_chars", sizes[1].cast("long")).drop("text", *[f"left{k}" for k in range(len(CHAR_CLASSES) + 1)])
    forms = sorted({f for ws in COMMON_WORDS.values() for w in ws for f in (w, w.capitalize())})
    df = df.withColumn("hits", F.transform(F.filter("words", lambda w: w.isin(forms)), F.lower)).drop("words")
    per_lang = {lang: F.array(*[_number_of("hits", w) for w in ws]) for lang, ws in COMMON_WORDS.items()}
    df = df.withColumn("own", _lang_case(per_lang, F.col("lang"), F.array_repeat(F.lit(0).cast("long"), N_COMMON))).drop("hits")
    return df.withColumn("common", F.concat("own", F.array(F.col("n_words") - F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x)))) \
        .drop("own")


def _js(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance of two count arrays, each taken as shares; NULL where either is empty."""
    total = "aggregate({0}, 0D, (a, x) -> a + x)".format
    term = "if({0} > 0, {0} * ln({0} / (({0} + {1}) / 2)), 0D)".format
    return F.expr(
        f"sqrt(greatest(0D, aggregate(zip_with(transform({counts}, x -> x / nullif({total(counts)}, 0D)), "
        f"transform({reference}, x -> x / nullif({total(reference)}, 0D)), (p, q) -> {term('p', 'q')} + {term('q', 'p')}), "
        "0D, (a, x) -> a + x) / (2 * ln(2D))))")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``char_distance``, ``word_distance``, ``base_failed``, ``kept``.

    NULL and empty texts have no words and fail the base rule; a NULL or unlisted language is judged by
    characters against all documents; repeated rows and NULL ids stay rows of their own; an empty table
    gives an empty result; other columns, whatever their names, are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("lang", F.when(F.col("lang").isin(list(COMMON_WORDS)), F.col("lang")).otherwise(F.lit("")))
    feats = stored(histograms(base_counts(rows)), "quality_features")
    n_char = len(CHAR_CLASSES) + 1
    sums = [F.sum(F.col("chars")[k]).cast("double").alias(f"c{k}") for k in range(n_char)] + \
           [F.sum(F.col("common")[k]).cast("double").alias(f"w{k}") for k in range(N_COMMON + 1)]
    # one row a listed language at most, and one of all documents together under ""
    grouped = feats.groupBy("lang").agg(*sums).where("lang <> ''")
    pooled = feats.agg(*sums).select(F.lit("").alias("lang"), *[f"c{k}" for k in range(n_char)], *[f"w{k}" for k in range(N_COMMON + 1)])
    refs = grouped.unionByName(pooled).select("lang", F.array(*[f"c{k}" for k in range(n_char)]).alias("ref_chars"),
                                              F.array(*[f"w{k}" for k in range(N_COMMON + 1)]).alias("ref_words"))
    df = feats.join(F.broadcast(refs), "lang")
    df = df.withColumn("char_distance", _js("chars", "ref_chars")).withColumn("word_distance", _js("common", "ref_words"))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    char_ok = (n_chars < MIN_CHARS) | (F.col("char_distance") <= max_char_distance)
    word_ok = (F.col("lang") == "") | (F.col("n_words") < MIN_WORDS) | (F.col("word_distance") <= max_word_distance)
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance",
                     failed.alias("base_failed"), (~failed & char_ok & word_ok).alias("kept"))
