"""Quality rules by distribution divergence, in SQL functions alone.

A document is compared with its language's reference by the Jensen-Shannon distance of two histograms: character classes
and common words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import stored, table, temp

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

#: Texts with fewer words are too short for their histograms to mean much; the base rules alone judge them.
GUARD_WORDS = 50
#: Jensen-Shannon distances (base 2: 0 to 1) beyond which a text is rejected.
MOST_CLASSES, MOST_COMMON = 0.28, 0.45

#: The most common words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it was on are as with be at by this from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}
#: Languages outside the table share one reference, so that the references stay as few as the table.
OTHER = "other"
#: Characters that are not in a class; their number is the length of the text without them. The rest are small letters.
CLASSES = {
    "space": r"[^\x20\x09-\x0D]+",
    "symbol": r"[^#*$%&|<>]+",
    "capital": r"[^A-ZÀ-ÖØ-Þ]+",
    "digit": r"[^0-9]+",
    "stop": r"[^.,;:!?'\"()\-]+",
}


def bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def _windows(words: Column) -> Column:
    """Hashes of all runs of eight words, doubled up from hashes of one, two and four."""

    def doubled(hashes: Column, width: int) -> Column:
        return bound(hashes, lambda h: F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - width, F.lit(0))), F.slice(h, width + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for width in (1, 2, 4):
        hashes = doubled(hashes, width)
    return hashes


def _covered(windows: Column) -> Column:
    """Words inside a window that occurs twice or more, counted once each."""

    def twins(s: Column) -> Column:
        n = F.size(s)
        pairs = F.zip_with(F.slice(s, 1, n - 1), F.slice(s, 2, n - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    def spread(at: Column) -> Column:
        gaps = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: F.least(F.lit(WINDOW), b - a))
        return F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)

    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return bound(bound(ordered, twins), spread)


def repeated_words(words: Column) -> Column:
    covered = bound(_windows(words), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(0))
    return F.when(F.size(words) > WINDOW, covered).otherwise(0).cast("long")


def _common(words: Column, language: Column) -> Column:
    """How often each common word of the language occurs, then how many other words there are."""

    def counts(listed: list[str]) -> Column:
        low = F.transform(words, lambda w: F.lower(w))
        found = F.filter(low, lambda w: w.isin(listed))
        return bound(found, lambda f: F.array(*(F.size(f) - F.size(F.array_remove(f, w)) for w in listed), F.size(words) - F.size(f)))

    every = sorted({w for listed in COMMON_WORDS.values() for w in listed[:5]})
    chosen = counts(every)
    for name, listed in COMMON_WORDS.items():
        chosen = F.when(language == name, counts(listed)).otherwise(chosen)
    return chosen


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda t, c: t + c)
    return bound(total, lambda t: F.transform(counts, lambda c: F.when(t > 0, c / t).otherwise(F.lit(0.0))))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares, in base 2; 0 where either is empty."""
    term = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), term(a, b) + term(b, a)).otherwise(F.lit(0.0)))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda t, x: t + x) / 2))


def measure(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """`docs` with the counts of the base rules and the two histograms, one pass over the text."""
    whole, words, classes = temp("text"), temp("words"), temp("classes")
    docs = docs.withColumn(whole, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    docs = docs.withColumn(words, words_of(F.col(whole)))
    docs = docs.withColumn(classes, F.array(*(F.length(F.regexp_replace(whole, pattern, "")) for pattern in CLASSES.values())))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    names = list(CLASSES)
    known = F.coalesce(F.col(f"`{language}`").cast("string"), F.lit(OTHER))
    known = F.when(known.isin(*COMMON_WORDS), known).otherwise(OTHER)
    at = F.col(classes)
    rest = F.length(whole) - F.aggregate(at, F.lit(0), lambda t, c: t + c)
    return docs.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": (F.length(whole) - at[names.index("space")]).cast("long"),
            "n_symbols": at[names.index("symbol")].cast("long"),
            "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(F.col(words)),
            "reference": known,
            "class_shares": _shares(F.concat(at, F.array(rest))),
            "common_shares": _shares(_common(F.col(words), known)),
        }
    ).drop(whole, words, classes)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*MEASURES, "reference", "class_shares", "common_shares", "base_failed", "class_distance", "common_distance", "kept")


def references(measured: DataFrame) -> DataFrame:
    """Mean histograms of each language over all its documents that pass the length guard: at most a row a language."""

    def mean(name: str, size: int) -> Column:
        return F.array(*(F.avg(F.get(F.col(name), F.lit(i))) for i in range(size)))

    most = max(len(x) for x in COMMON_WORDS.values()) + 1
    most = max(most, len({w for listed in COMMON_WORDS.values() for w in listed[:5]}) + 1)
    averaged = measured.where(F.col("n_words") >= GUARD_WORDS).groupBy("reference").agg(mean("class_shares", len(CLASSES) + 1).alias("class_reference"), mean("common_shares", most).alias("common_reference"))
    return averaged.withColumn("common_reference", F.filter("common_reference", lambda x: x.isNotNull()))


def verdicts(measured: DataFrame, reference: DataFrame, most_classes: float = MOST_CLASSES, most_common: float = MOST_COMMON) -> DataFrame:
    """Measured documents with base_failed, class_distance, common_distance and kept."""
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = measured.join(F.broadcast(reference), "reference", "left")  # as many rows as COMMON_WORDS, and one
    far = lambda p, q: F.coalesce(jensen_shannon(F.col(p), F.col(q)), F.lit(0.0))
    judged = judged.withColumns({"base_failed": base, "class_distance": far("class_shares", "class_reference"), "common_distance": far("common_shares", "common_reference")})
    odd = (F.col("n_words") >= GUARD_WORDS) & ((F.col("class_distance") > most_classes) | (F.col("common_distance") > most_common))
    return judged.withColumn("kept", ~(F.col("base_failed") | odd)).drop("class_reference", "common_reference")


def judge_quality(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """Counts, distances and the verdict of every document, without its text.

    The base rules reject texts of fewer than 20 words and texts of which over 30 % lie in repeated runs of eight words.
    Texts of at least 50 words are also compared with the mean histograms of all documents of their language: character
    classes, and the language's common words; a distance beyond its threshold rejects. All of it is array and string
    functions inside one row; the measured rows (a few hundred bytes a document) are stored once, since the references
    need them all before the first can be judged. Nothing but the references' partial means is shuffled.

    Null text counts as empty (no words: the base rules reject it), a null or unlisted language has a shared reference,
    repeated rows are judged alike, an empty table gives no rows. Columns with the names of results are replaced.
    """
    measured = stored(measure(docs.drop(*(c for c in RESULTS if c not in (text, language))), text, language).drop(text), "quality")
    return verdicts(measured, references(measured))


def keep_good(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """The rows of `docs` that `judge_quality` keeps, as they are.

    Every row is measured again where it lies, so rows need no id and no text moves.
    """
    taken = docs.select(F.col(f"`{language}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    measured = stored(measure(taken).select("reference", "n_words", "class_shares", "common_shares"), "quality")
    row = temp("row")
    rows = docs.select(F.struct("*").alias(row), F.col(f"`{language}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    return verdicts(measure(rows), references(measured)).where("kept").select(f"{row}.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The quality verdict of every document."""
    judged = judge_quality(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", *MEASURES, "base_failed", "kept", "class_distance", "common_distance")
