"""Quality rules, with DataFrame functions only: base counts, and divergence from language references.

Every text gets two histograms, of character classes and of its language's common words (the other
words share one bin). The reference of a language is the sum over all of its documents, that of a null or
unknown language the sum over all documents of the table; there the common words of all languages share one bin, since
texts of one language are far from a mixture of them word by word, as far as gibberish is. So one pass
computes the histograms, which are small and staged, and a second compares them. A document fails
where the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) of a histogram
exceeds its bound; a histogram with too few entries on either side gives no verdict.

Defined cases: a null or empty text has no words and fails the base rules; a null or unknown
language ("en-US" and "EN" are unknown) uses the reference over all documents and the words of all languages; repeated rows are
judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stage import staged
from .common import WORD, table

#: Common words by language (fixed values).
COMMON = {
    "en": "the of and to a in is that for it was on with be as by this are at from",
    "de": "der die und in den von zu das sich mit auf des für ist nicht im dem ein eine als",
    "fr": "de la le et les des en un du une que pour est qui dans par pas au sur avec",
    "es": "de la que el en y los se del las por un no con su una es para al lo",
}
#: Common words of all languages.
EVERY = tuple(dict.fromkeys(w for v in COMMON.values() for w in v.split()))
#: Character classes, each given by what is not in it (fixed values). ASCII blanks are a class too, and all
#: other characters, most of them small letters, are the last one.
OUTSIDE = {"upper": r"[^\p{Lu}\p{Lt}]+", "digit": r"\P{N}+", "stop": r"[^.,;:?'\"()\-]+", "symbol": r"[^!#*$%&|<>=_@+/\\~^{}\[\]]+"}

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Largest distance from the reference, and fewest entries of a histogram and of a reference that count.
MAX_CHARS = 0.26
MAX_COMMON = 0.31
LEAST_CHARS = 100
LEAST_WORDS = 80
LEAST_REFERENCE = 2000


def repeated_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the list (a named column).

    64-bit hashes of the windows show the lists in which none can recur; in the others the windows
    themselves are sorted, so equal ones are neighbours.
    """
    n = F.size(words)
    places = F.sequence(F.lit(1), n - 2)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    return F.when(n < 3, F.lit(0)).otherwise(F.size(hashes) - F.size(F.array_distinct(hashes)))


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    counted = (df.withColumn("_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
               .withColumn("_lines", lines)
               .withColumn("n_words", F.size("_words").cast("long"))
               .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
               .withColumn("n_symbols", F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long"))
               .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
               .withColumn("_again", repeated_words(F.col("_words"))))
    words = F.col("_words")
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))
    counted = counted.withColumn("_windows", F.when(F.col("_again") > 0, F.sort_array(windows)))
    by_text = F.col("_windows")
    same = F.filter(by_text, lambda x, j: x["w"].eqNullSafe(F.get(by_text, j + 1)["w"]) | x["w"].eqNullSafe(F.get(by_text, j - 1)["w"]))
    counted = counted.withColumn("_same", F.when(F.size(by_text) > 0, F.sort_array(F.transform(same, lambda x: x["i"]))))
    at = F.col("_same")
    # each window covers three words, less those that the next one covers too
    covered = F.aggregate(F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return (counted.withColumn("n_repeat_words", F.when(F.size(at) > 0, covered).otherwise(F.lit(0)).cast("long"))
            .drop("_lines", "_again", "_windows", "_same"))


def histograms(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Append ``chars`` (entries per class), ``n_common`` (common words of any language) and ``common`` (entries per
    common word of the language, or of all languages as one where it is unknown, then of all other words).
    Needs ``_words`` of ``base_counts``."""
    body = F.coalesce(F.col(text), F.lit(""))
    counted = df.withColumns({f"_{name}": F.length(F.regexp_replace(body, other, "")) for name, other in OUTSIDE.items()})
    counted = counted.withColumn("_blank", F.length(body) - F.col("word_chars"))
    named = [F.col(f"_{name}") for name in (*OUTSIDE, "blank")]
    chars = F.array(*[x.cast("double") for x in named], F.greatest(F.length(body) - reduce(lambda a, b: a + b, named), F.lit(0)).cast("double"))
    known = F.filter(F.split(F.lower(F.array_join("_words", " ")), " "), lambda w: w.isin(*EVERY))
    counted = counted.withColumn("chars", chars).withColumn("_known", known).withColumn("n_common", F.size("_known").cast("double"))
    # every word stands between blanks of its own, so that a word is found by plain search
    counted = counted.withColumn("_spaced", F.concat(F.lit(" "), F.array_join("_known", "  "), F.lit(" ")))

    def uses(word: str) -> Column:
        return ((F.octet_length("_spaced") - F.octet_length(F.replace(F.col("_spaced"), F.lit(f" {word} "), F.lit("")))) / (len(word.encode()) + 2)).cast("double")

    def bins(words: list[str]) -> Column:
        return F.array(*[uses(w) for w in words])

    own = reduce(lambda a, k: a.when(F.col(lang) == k, bins(COMMON[k].split())), COMMON, F.when(F.lit(False), F.array().cast("array<double>")))
    counted = counted.withColumn("_bins", own.otherwise(F.array("n_common")))
    found = F.aggregate("_bins", F.lit(0.0), lambda a, x: a + x)
    return (counted.withColumn("common", F.concat(F.col("_bins"), F.array(F.greatest(F.col("n_words") - found, F.lit(0.0)))))
            .drop("_words", "_known", "_spaced", "_bins", *[f"_{name}" for name in (*OUTSIDE, "blank")]))


def total(histogram: Column) -> Column:
    return F.aggregate(histogram, F.lit(0.0), lambda a, x: a + x)


def js_distance(one: Column, other: Column, a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms of the same bins with the totals ``a`` and ``b`` (columns, so
    that they are not summed again for every bin); null if either is empty."""
    def half(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(one, other, lambda x, y: half(x / a, y / b) + half(y / b, x / a))
    return F.when((a > 0) & (b > 0), F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0))))


def references(counted: DataFrame, lang: str = "lang") -> DataFrame:
    """One row per language: the sums of its documents' histograms; in that of '' the sums over all documents.

    A language is a short code out of a small set, and the sums are taken before the shuffle.
    """
    lengths = {"chars": len(OUTSIDE) + 2, "common": 1 + max(len(v.split()) for v in COMMON.values())}
    sums = {name: F.array(*[F.coalesce(F.sum(F.get(name, F.lit(i))), F.lit(0.0)) for i in range(n)]) for name, n in lengths.items()}
    # written, so that the documents are read once for both
    per = staged(counted.groupBy(F.col(lang).alias("ref_lang")).agg(*[v.alias(f"ref_{k}") for k, v in sums.items()], F.sum("n_common").alias("n_common"),
                                                                    F.sum("n_words").cast("double").alias("n_words")), "references")
    chars = F.array(*[F.sum(F.get("ref_chars", F.lit(i))) for i in range(lengths["chars"])])
    every = per.groupBy(F.lit("").alias("ref_lang")).agg(chars.alias("ref_chars"), F.array(F.sum("n_common"), F.sum("n_words") - F.sum("n_common")).alias("ref_common"))
    return per.where("ref_lang != ''").select(every.columns).unionByName(every)


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """Per document the base counts, both distances and the verdict; columns are named as the query's."""
    narrow = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                         F.when(F.col(f"`{lang}`").isin(*COMMON), F.col(f"`{lang}`")).otherwise("").alias("lang"))
    counted = staged(histograms(base_counts(narrow)).drop("text"), "histograms")
    refs = references(counted)
    # at most one row per known language and one over all documents for the rest
    both = counted.join(F.broadcast(refs), F.col("lang") == F.col("ref_lang"), "left")
    both = both.withColumn("ref_common", F.slice("ref_common", F.lit(1), F.size("common")))
    both = both.withColumns({f"all_{c}": total(F.col(c)) for c in ("chars", "common", "ref_chars", "ref_common")})
    chars = F.when((F.col("all_chars") >= LEAST_CHARS) & (F.col("all_ref_chars") >= LEAST_REFERENCE),
                   js_distance(F.col("chars"), F.col("ref_chars"), F.col("all_chars"), F.col("all_ref_chars")))
    common = F.when((F.col("n_words") >= LEAST_WORDS) & (F.col("all_ref_common") >= LEAST_REFERENCE),
                    js_distance(F.col("common"), F.col("ref_common"), F.col("all_common"), F.col("all_ref_common")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    far = F.coalesce(F.col("char_distance") > MAX_CHARS, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_COMMON, F.lit(False))
    return (both.withColumn("char_distance", chars).withColumn("word_distance", common).withColumn("base_failed", base)
            .withColumn("kept", ~base & ~far)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances and verdict of every document."""
    return judged(table(spark, sf_dir, "documents"))
