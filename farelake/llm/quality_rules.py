"""Quality rules whose thresholds follow each language and source.

Method: every document gets a few whole-number measures. Their distribution per (language, source) is kept as a
mergeable quantile sketch: a histogram with 32 bins per power of two, so any quantile is known to 1/32 of its value.
Two sketches merge by adding counts, which is what a partial aggregate does: a hot source costs one row per bin and
task. Fences come from the sketch's quantiles and replace fixed cutoffs; a join on language and source applies them.

The bins are whole-number arithmetic, so results do not depend on the order of rows or the number of tasks.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, stored

SYMBOLS = "#*$%&|<>"  # fixed value
BLANKS = " \t\n\v\f\r"  # fixed value: what separates words
SUB_BITS = 5  # 2^5 bins per power of two

#: Measures with a fence: name, per-document value, least distance of the fence from the median.
MEASURES = (
    ("word_length", "1000 * word_chars div greatest(n_words, 1)", 2000),
    ("symbol_share", "1000000 * n_symbols div greatest(n_words, 1)", 100_000),
    ("dup_line_share", "1000000 * n_dup_lines div greatest(n_lines, 1)", 300_000),
    ("repeat_share", "1000000 * n_repeat_words div greatest(n_words, 1)", 200_000),
)


def measure_text(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words of one text."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = len(text) - sum(map(text.count, BLANKS))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        upto = 0  # words before it are decided
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every document; NULL texts have no words."""
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

    def work(rows):
        values = [measure_text(t or "") for t in rows.pop("text")]
        return rows | {n: [v[i] for v in values] for i, n in enumerate(names)}

    kept = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    )
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{n} long" for n in names)
    return map_batches(kept, schema, work).withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    )


def sketch_bin(value: Column) -> Column:
    """Bin of a whole number of 0 or more: itself below 2^(SUB_BITS+1), else its leading bits with the exponent."""
    shift = F.greatest(F.length(F.bin(value)) - F.lit(SUB_BITS + 1), F.lit(0))
    return (F.call_function("shiftright", value, shift) + (shift * F.lit(1 << SUB_BITS)).cast("long")).cast("long")


def bin_top(number: Column) -> Column:
    """Largest value of a bin."""
    shift = F.greatest((number / F.lit(1 << SUB_BITS)).cast("int") - F.lit(1), F.lit(0))
    lead = number - (shift * F.lit(1 << SUB_BITS)).cast("long")
    return F.call_function("shiftleft", lead + F.lit(1), shift) - F.lit(1)


def quantile_sketches(measured: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, measure, bin, n) over the documents that pass the base rules."""
    values = F.array(*[
        F.struct(F.lit(name).alias("measure"), sketch_bin(F.expr(value)).alias("bin")) for name, value, _ in MEASURES
    ])
    passed = measured.where("NOT base_failed")
    return passed.select("lang", "source", F.inline(values)).groupBy("lang", "source", "measure", "bin").agg(
        F.count("*").alias("n")
    )


def thresholds(sketches: DataFrame, least_docs: int = 100, reach: int = 4) -> DataFrame:
    """Fences (lang, source, one ``lo_``/``hi_`` pair per measure) from merged sketches.

    A group with fewer than ``least_docs`` documents takes the sketch of its language, a language with fewer that of
    all documents. A fence stands ``reach`` times the spread between median and outer quantile away from the median, at
    least the distance given with the measure. Sketches have at most 2,000 bins, which bounds every window here.
    """
    levels = sketches.select(
        "measure", "bin", "n", F.inline(F.array(
            F.struct(F.lit(2).alias("level"), F.col("lang").alias("l"), F.col("source").alias("s")),
            F.struct(F.lit(1).alias("level"), F.col("lang").alias("l"), F.lit(None).cast("string").alias("s")),
            F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("l"), F.lit(None).cast("string").alias("s")),
        ))
    ).groupBy("level", "l", "s", "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("level", "l", "s", "measure")
    ranked = levels.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("docs", F.sum("n").over(group))
    at = lambda percent: F.min(F.when(100 * F.col("upto") >= percent * F.col("docs"), bin_top(F.col("bin"))))
    slack = F.create_map(*[F.lit(x) for name, _, least in MEASURES for x in (name, least)])
    marks = ranked.groupBy("level", "l", "s", "measure").agg(
        F.max("docs").alias("docs"), at(5).alias("q05"), at(50).alias("q50"), at(95).alias("q95")
    ).select(
        "level", "l", "s", "measure", "docs",
        (F.col("q50") - F.greatest(reach * (F.col("q50") - F.col("q05")), slack[F.col("measure")])).alias("lo"),
        (F.col("q50") + F.greatest(reach * (F.col("q95") - F.col("q50")), slack[F.col("measure")])).alias("hi"),
    )
    pick = lambda name, side: F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{side}_{name}")
    wide = marks.groupBy("level", "l", "s").agg(
        F.max("docs").alias("docs"), *[pick(name, side) for name, _, _ in MEASURES for side in ("lo", "hi")]
    )
    fences = F.struct("docs", *[f"{side}_{name}" for name, _, _ in MEASURES for side in ("lo", "hi")])
    part = lambda level: wide.where(F.col("level") == level)
    own = part(2).select(F.col("l").alias("lang"), F.col("s").alias("source"), fences.alias("f2"))
    tongue = part(1).select(F.col("l").alias("l1"), fences.alias("f1"))
    every = part(0).agg(F.first(fences)).scalar()
    enough = lambda f: F.when(F.col(f"{f}.docs") >= least_docs, F.col(f))
    return (
        own.join(tongue, own["lang"].eqNullSafe(tongue["l1"]), "left")
        .withColumn("f0", every)
        .select("lang", "source", F.coalesce(enough("f2"), enough("f1"), F.col("f0")).alias("f")).select("lang", "source", "f.*")
    )


def adaptive_quality(docs: DataFrame, least_docs: int = 100, reach: int = 4) -> DataFrame:
    """Measures and verdict of every document (needs doc_id, text, lang, source; other columns are left out).

    ``kept`` is false where the base rules fail (under 50 words, or more than half of the words in repeated 3-word
    windows) and where a measure lies outside the fences of the document's language and source. NULL languages and
    sources are groups of their own; NULL or empty texts fail the base rules; repeated rows are judged alike; a group
    without any document that passes the base rules has no fence and nothing to keep. An empty table gives no rows.
    """
    measured = stored(measure(docs), "measures")  # texts are read once; sketches and verdict need the measures only
    fences = thresholds(stored(quantile_sketches(measured), "sketches"), least_docs, reach).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    joined = measured.join(
        fences, measured["lang"].eqNullSafe(fences["g_lang"]) & measured["source"].eqNullSafe(fences["g_source"]), "left"
    )
    inside = F.lit(True)
    for name, value, _ in MEASURES:
        inside = inside & F.expr(value).between(F.col(f"lo_{name}"), F.col(f"hi_{name}"))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
