"""Quality rules: distribution divergence from language references, in
DataFrame operations only.

A document's characters fall into six classes and its common words are
counted for each language's list.  The references are the same histograms summed
over all documents of a language (column ``lang``).  A text is compared with
every language by the Jensen-Shannon distance (base 2: 0 to 1) of both
histograms, takes the nearest language, and passes if the class distance is at most
``CLASS_CUT`` and the word distance at most ``WORD_CUT + WORD_SLACK /
sqrt(words)``: a short text's histogram strays further by chance.  Texts under
``MIN_WORDS`` words, and texts that mostly repeat their own three-word
windows, fail before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placekit.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
CLASS_CUT = 0.22
WORD_CUT, WORD_SLACK = 0.3, 3.0

# Very common words of each language.
COMMON = {
    "en": "the of and to in a is that for it as was with be by on not he this are".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au plus pas".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
_ALL = sorted({w for words in COMMON.values() for w in words})
_FORMS = sorted({f for w in _ALL for f in (w, w.capitalize())})


def features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The ``keep`` columns, the base counts and the histograms of every text.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``; ``classes`` (lower-case ASCII, upper-case ASCII,
    digits, white space, other ASCII signs, all others) and ``common`` (counts of
    all listed words).  A null text has none of anything.
    """
    text = F.coalesce("text", F.lit(""))
    d = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text.alias("text"))
    d = d.withColumn("words", F.array_remove(F.split("text", SPACE, -1), ""))
    without = lambda signs: F.length("text") - F.length(F.regexp_replace("text", signs, ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("lines", lines)
    # three-word windows: hash and position; those with an equal neighbour in
    # sorted order are repeated
    d = d.withColumn("h3", F.when(F.size("words") > 2, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))))
    d = d.withColumn("s3", F.when(F.size(F.array_distinct("h3")) < F.size("h3"), F.sort_array(
        F.transform("h3", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("s3", lambda x, i: (x["h"] == F.get(F.col("s3"), i - 1)["h"])
                     | (x["h"] == F.get(F.col("s3"), i + 1)["h"]))
    d = d.withColumn("p3", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("p3", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("p3"), k + 1), p + 3) - p)),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    # the common words alone, each between bars
    some = F.lower(F.array_join(F.filter("words", lambda w: w.isin(_FORMS)), "||"))
    d = d.select(
        *[F.col(f"k{i}") for i in range(len(keep))],
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length("text").cast("bigint").alias("n_chars"),
        without(r"[#*$%&|<>]+").cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
        without("[a-z]+").alias("lower"), without("[A-Z]+").alias("upper"), without("[0-9]+").alias("digit"),
        without(r"[!-/:-@\[-`{-~]+").alias("sign"), F.concat(F.lit("|"), some, F.lit("|")).alias("some"))
    count = lambda w: ((F.length("some") - F.length(F.replace("some", F.lit(f"|{w}|"), F.lit(""))))
                       / F.lit(len(w) + 2)).cast("int")
    space = F.col("n_chars") - F.col("word_chars")
    rest = F.col("word_chars") - F.col("lower") - F.col("upper") - F.col("digit") - F.col("sign")
    return d.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(*[c.cast("bigint") for c in (F.col("lower"), F.col("upper"), F.col("digit"), space, F.col("sign"), rest)])
         .alias("classes"),
        F.array(*[count(w) for w in _ALL]).alias("common"))


def references(found: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """For each listed language with documents: the shares of the character
    classes and of its common words over all its documents (one row each)."""
    rows = found.filter(F.col("lang").isin(list(COMMON))).groupBy("lang").agg(
        F.array(*[F.sum(F.get("classes", F.lit(i))) for i in range(6)]).alias("classes"),
        F.array(*[F.sum(F.get("common", F.lit(i))) for i in range(len(_ALL))]).alias("common")).collect()
    out = {}
    for r in rows:
        words = [r["common"][_ALL.index(w)] for w in COMMON[r["lang"]]]
        if sum(r["classes"]) and sum(words):
            out[r["lang"]] = ([x / sum(r["classes"]) for x in r["classes"]], [x / sum(words) for x in words])
    return out


def js_distance(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram (an array) with this sum
    from a distribution; 1 for an empty histogram."""
    def part(c, q):
        p = c / total
        m = (p + q) / 2
        return F.when(c > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    parts = F.zip_with(counts, F.array(*[F.lit(float(q)) for q in reference]), part)
    both = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), both / 2))).otherwise(1.0)


def judge(found: DataFrame, refs: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    """Adds ``class_distance`` and ``word_distance`` to the nearest language
    (null without references), ``base_failed`` and ``kept``."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    langs = sorted(refs)
    # one step after the other, so that no expression is computed inside another
    own = {lang: F.transform(F.array(*[F.lit(_ALL.index(x)) for x in COMMON[lang]]),
                             lambda i: F.get("common", i)) for lang in langs}
    found = found.withColumns({"_t": total("classes"), **{f"_own_{lang}": own[lang] for lang in langs}})
    found = found.withColumns({f"_t_{lang}": total(f"_own_{lang}") for lang in langs})
    found = found.withColumns({
        **{f"_c_{lang}": js_distance(F.col("classes"), F.col("_t"), refs[lang][0]) for lang in langs},
        **{f"_w_{lang}": js_distance(F.col(f"_own_{lang}"), F.col(f"_t_{lang}"), refs[lang][1]) for lang in langs}})
    near = [F.struct((F.col(f"_c_{lang}") + F.col(f"_w_{lang}")).alias("sum"),
                     F.col(f"_c_{lang}").alias("c"), F.col(f"_w_{lang}").alias("w")) for lang in langs]
    best = F.array_min(F.array(*near)) if near else F.lit(None).cast("struct<sum:double,c:double,w:double>")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passes = (F.col("_best.c") <= CLASS_CUT) & (
        F.col("_best.w") <= WORD_CUT + WORD_SLACK / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)).cast("double")))
    return (found.withColumn("_best", best)
                 .withColumn("class_distance", F.col("_best.c")).withColumn("word_distance", F.col("_best.w"))
                 .withColumn("base_failed", failed)
                 .withColumn("kept", ~failed & F.coalesce(passes, F.lit(True)))
                 .drop("_best", "_t", *[f"_{k}_{lang}" for lang in refs for k in ("c", "w", "t", "own")]))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict for every row of ``docs`` (``doc_id``,
    ``text``, ``lang``).

    Null and empty texts have no words and fail. A row of another or no
    language is compared like any other, and adds to no reference; without any
    reference the base rules decide alone.  Repeated rows each give a row and count each in
    the references.  An empty table gives none; other columns are ignored.
    """
    found = materialize(features(docs))
    return judge(found, references(found))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    from placekit.sources.tables import table
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance")
