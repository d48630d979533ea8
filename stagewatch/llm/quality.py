"""Quality rules by distribution divergence, with DataFrame functions only.

Each document's histograms of character classes and of common words are compared with references: the pooled histograms of
its language over all documents, by Jensen-Shannon distance.  Character classes, symbols and common words have a verdict each;
its limit narrows with the number of words, because a short document's histogram is mostly noise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import nested, text_or_empty, unnested

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Words below which a document's histograms aren't judged, and letters and words that a language's reference needs.
GUARD_WORDS = 50
GUARD_REFERENCE_WORDS = 2000
#: Limits of a histogram's distance: for an endless document, and what is added over the square root of the number of words.
#: Set on the labelled documents with an even id; the tests hold them against those with an odd one.
CLASS_LIMIT = (0.13, 2.0)
SYMBOL_LIMIT = (0.10, 0.5)
WORD_LIMIT = (0.15, 2.5)

# Character classes as regular expressions, taken off the words one after the other; what is left is a class.
CLASSES = {"lower": "[a-zß-öø-ÿ]+", "symbol": "[#*$%&|<>]+", "upper": "[A-ZÀ-ÖØ-Þ]+", "stop": "[.,;:!?'\"()\\-]+", "digit": "[0-9]+"}
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
# Common words of the corpus' languages.
COMMON = (
    "the", "of", "and", "to", "in",
    "der", "die", "und", "den", "nicht",
    "de", "la", "le", "les", "et",
    "el", "los", "y", "se", "por",
)
PREFIX = "__q_"
#: Repeated windows of a text up to which looking each place up is cheaper than sorting; the result is the same.
FEW = 12


def _words(text: Column) -> Column:
    """The words of a text; cutting at one literal space takes Java's path without regular expressions."""
    spaced = text
    for space in SPACES[1:]:
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(spaced, " ", -1), "")


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are compared by 64-bit hash.  Texts whose window hashes are all different have none.  Few hashes that occur twice
    are looked up place by place; for many, (hash, place) is sorted and places with an equal neighbour are kept.
    """
    def hashes(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda first, i: F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)),
        )

    def repeated(found: Column) -> Column:
        return F.filter(found, lambda w, k: (F.get(found, k - 1)["h"] == w["h"]) | (F.get(found, k + 1)["h"] == w["h"]))

    def sorted_places(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return _bound(placed, lambda found: F.sort_array(F.transform(repeated(found), lambda w: w["i"])))

    def looked_up_places(h: Column, twice: Column) -> Column:
        return F.filter(F.transform(h, lambda v, i: F.when(F.array_contains(twice, v), i)), lambda i: i.isNotNull())

    def covered(h: Column) -> Column:
        twice = _bound(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda v, k: v == F.get(s, k + 1))))
        places = _bound(twice, lambda t: F.when(F.size(t) <= FEW, looked_up_places(h, t)).otherwise(sorted_places(h)))
        return _bound(places, lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
            F.lit(0), lambda a, b: a + b,
        ))

    return _bound(words, lambda w: _bound(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once per row (a let-expression)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _times(words: str, word: str) -> Column:
    """How often a word is in a text of words that have two spaces between them and one at either end."""
    left = F.replace(F.col(words), F.lit(f" {word} "), F.lit(""))
    return F.floor((F.octet_length(words) - F.octet_length(left)) / (len(word.encode()) + 2))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.ltrim(line, F.lit(SPACES)) != "")
    return _bound(lines, lambda found: (F.size(found) - F.size(F.array_distinct(found))).cast("bigint"))


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the measures of each text in columns that start with ``__q_``."""
    raw, rest = f"{PREFIX}text", f"{PREFIX}rest"
    out = docs.withColumn(raw, text_or_empty(text)).withColumn(f"{PREFIX}words", _words(F.col(raw)))
    body, words = F.col(raw), F.col(f"{PREFIX}words")
    found = F.array_join(F.filter(words, lambda w: w.isin(*COMMON)), "  ")
    out = out.withColumns({f"{rest}0": F.array_join(words, ""), f"{PREFIX}found": F.concat(F.lit(" "), found, F.lit(" "))})
    for i, pattern in enumerate(CLASSES.values()):
        out = out.withColumn(f"{rest}{i + 1}", F.regexp_replace(f"{rest}{i}", pattern, ""))
    sizes = [F.length(body), *[F.length(f"{rest}{i}") for i in range(len(CLASSES) + 1)]]
    counts = [(more - less).cast("bigint") for more, less in zip(sizes, sizes[1:])]
    out = out.withColumns({
        f"{PREFIX}classes": F.array(*counts), f"{PREFIX}chars": F.length(body).cast("bigint"),
        f"{PREFIX}n_symbols": counts[2],
        f"{PREFIX}symbols": F.array(*[(F.length(body) - F.length(F.replace(body, F.lit(c), F.lit("")))).cast("bigint") for c in SYMBOLS]),
        f"{PREFIX}n_words": F.size(words).cast("bigint"),
        f"{PREFIX}word_chars": F.length(f"{rest}0").cast("bigint"),
        f"{PREFIX}n_dup_lines": _dup_lines(body),
        f"{PREFIX}n_repeat_words": _repeat_words(words).cast("bigint"),
        f"{PREFIX}common": F.array(*[_times(f"{PREFIX}found", c).cast("bigint") for c in COMMON]),
        f"{PREFIX}lang": F.coalesce(F.col(lang).cast("string"), F.lit("")),
    })
    return out.drop(raw, f"{PREFIX}words", f"{PREFIX}found", *[f"{rest}{i}" for i in range(len(CLASSES) + 1)])


def _histogram(counts: Column, total: Column) -> Column:
    """Shares of the counted bins and of the rest."""
    rest = F.greatest(total - F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0).cast("bigint"))
    whole = F.greatest(total, F.lit(1).cast("bigint")).cast("double")
    return F.transform(F.concat(counts, F.array(rest)), lambda c: c / whole)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms: 0 for equal ones, 1 for ones without a common bin."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def references(table: DataFrame) -> DataFrame:
    """One row per language with its pooled histograms; languages with too few words share the pool of all rows."""
    def pooled(column: str, bins: int) -> Column:
        return F.array(*[F.sum(F.col(f"{PREFIX}{column}")[i]) for i in range(bins)])

    sums = [pooled("classes", len(CLASSES) + 1).alias("classes"), pooled("common", len(COMMON)).alias("common"),
            pooled("symbols", len(SYMBOLS)).alias("symbols"),
            F.sum(f"{PREFIX}chars").alias("chars"), F.sum(f"{PREFIX}n_words").alias("words")]
    known = table.groupBy(F.col(f"{PREFIX}lang").alias("lang")).agg(*sums)
    by_lang = known.filter(F.col("words") >= GUARD_REFERENCE_WORDS)
    both = by_lang.withColumn("pool", F.lit(False)).unionByName(
        table.agg(*sums).select(F.lit(None).cast("string").alias("lang"), "classes", "common", "symbols", "chars", "words", F.lit(True).alias("pool"))
    )
    return stored(both.select(
        F.col("lang").alias("__ref_lang"), "pool", _histogram(F.col("classes"), F.col("chars")).alias("__ref_classes"),
        _histogram(F.col("common"), F.col("words")).alias("__ref_common"),
        _histogram(F.col("symbols"), F.col("chars")).alias("__ref_symbols"),
    ), "references")


def _limit(limit: tuple[float, float], n: Column) -> Column:
    return limit[0] + limit[1] / F.sqrt(F.greatest(n, F.lit(1)).cast("double"))


def judged(table: DataFrame) -> DataFrame:
    """Add ``__q_base_failed``, the three distances and the verdict ``__q_kept`` to a measured table.

    Symbols only tell against a document that has more of them than its language, words only against one whose language has
    a reference of its own.
    """
    refs = references(table)
    pool = refs.filter("pool").select("__ref_classes", "__ref_common", "__ref_symbols")
    # One row: the pooled histograms of all documents, as constants of the plan.
    row = pool.first()
    pool_classes = F.array(*[F.lit(float(x or 0)) for x in (row[0] or [0.0] * (len(CLASSES) + 2))])
    pool_common = F.array(*[F.lit(float(x or 0)) for x in (row[1] or [0.0] * (len(COMMON) + 1))])
    pool_symbols = F.array(*[F.lit(float(x or 0)) for x in (row[2] or [0.0] * (len(SYMBOLS) + 1))])
    own = refs.filter("NOT pool").drop("pool")
    out = table.join(own, F.col(f"{PREFIX}lang") == F.col("__ref_lang"), "left")
    n = F.col(f"{PREFIX}n_words")
    class_distance = js_distance(
        _histogram(F.col(f"{PREFIX}classes"), F.col(f"{PREFIX}chars")), F.coalesce("__ref_classes", pool_classes))
    word_distance = js_distance(_histogram(F.col(f"{PREFIX}common"), n), F.coalesce("__ref_common", pool_common))
    symbols, usual = _histogram(F.col(f"{PREFIX}symbols"), F.col(f"{PREFIX}chars")), F.coalesce("__ref_symbols", pool_symbols)
    more = F.element_at(symbols, -1) < F.element_at(usual, -1)
    symbol_distance = F.when(more, js_distance(symbols, usual)).otherwise(0.0)
    base_failed = (n < MIN_WORDS) | (100 * F.col(f"{PREFIX}n_repeat_words") > MAX_REPEAT_PERCENT * n)
    c, w = F.col(f"{PREFIX}class_distance"), F.col(f"{PREFIX}word_distance")
    judgeable, passed = n >= GUARD_WORDS, ~F.col(f"{PREFIX}base_failed")
    diverges = judgeable & (
        (c > _limit(CLASS_LIMIT, n)) | (F.col(f"{PREFIX}symbol_distance") > _limit(SYMBOL_LIMIT, n))
        | F.col(f"{PREFIX}own_words") & (w > _limit(WORD_LIMIT, n))
    )
    return (
        out.withColumns({f"{PREFIX}class_distance": class_distance, f"{PREFIX}word_distance": word_distance,
                         f"{PREFIX}symbol_distance": symbol_distance, f"{PREFIX}base_failed": base_failed,
                         f"{PREFIX}own_words": F.col("__ref_lang").isNotNull()})
        .withColumn(f"{PREFIX}kept", passed & ~diverges)
        .drop("__ref_lang", "__ref_classes", "__ref_common", "__ref_symbols", f"{PREFIX}own_words")
    )


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, three distances, kept.

    A null or empty text has no words and fails.  A null language is the empty one.  No rows in, no rows out.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    table = stored(measured(narrow).drop("text", "lang"), "quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance",
             "word_distance", "symbol_distance", "kept")
    return judged(table).select("doc_id", *[F.col(f"{PREFIX}{n}").alias(n) for n in names])


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, columns as in the input."""
    table = stored(measured(nested(docs), f"row.`{text}`", f"row.`{lang}`"), "quality")
    return unnested(judged(table).filter(f"{PREFIX}kept"))
