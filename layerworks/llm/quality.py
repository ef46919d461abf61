"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects a document when its measure exceeds a cutoff of the document's stratum.  The
candidates are a grid fixed beforehand.  A cutoff is certified if the exact binomial bound on the
share of good documents it rejects stays under the allowed risk.  Errors of all tests together are
at most ``delta``: strata and rules share it (Bonferroni), and within a rule the grid is tested in
a fixed sequence from the mildest cutoff until one fails, which needs no further share.  The risks
of the rules add up to at most ``alpha``.  The strictest certified cutoff of each stratum and rule
holds; without one the rule rejects nothing there.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import stored, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Measures that a rule may bound; all are shares or means of one document.
MEASURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
}
GRID = tuple(round(0.02 * i, 2) for i in range(1, 31))


def _repeat_words(words: Column) -> Column:
    """Words in windows of five that occur twice or more in the text.

    Windows are compared by a hash of 64 bits and then, where any repeat, sorted with their
    places; the words covered by repeated windows are the gaps between their places, five at most.
    """
    count = F.size(words) - (WINDOW - 1)
    hashes = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)]),
    )
    return F.when(count >= 2, hashes).otherwise(F.array().cast("array<bigint>"))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One narrow row per document: id, the ``keep`` columns and the counts the rules use.

    A null or empty text has zero counts.  Repeated rows give a row each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
        words_of(F.col(text_col)).alias("_words"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        lines.alias("_lines"),
    )
    hashed = base.withColumn("_hashes", _repeat_words(F.col("_words"))).select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    ).drop("_words", "_lines")
    # Only texts with a repeated window are sorted.
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    sorted_places = F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    placed = hashed.withColumn("_places", F.when(repeated, sorted_places)).drop("_hashes")
    at = F.col("_places")
    starts = F.transform(
        at,
        lambda place, i: F.when(
            F.coalesce(place["h"] == F.get(at, i - 1)["h"], F.lit(False)) | F.coalesce(place["h"] == F.get(at, i + 1)["h"], F.lit(False)),
            place["i"],
        ),
    )
    placed = placed.withColumn("_starts", F.array_sort(F.filter(starts, lambda s: s.isNotNull()))).drop("_places")
    begun = F.col("_starts")
    steps = F.transform(begun, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(begun, i + 1) - s, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return placed.select(
        F.col("_id").alias(id_col), *[F.col(f"_keep_{c}").alias(c) for c in keep],
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"), "n_upper",
    )


def base_failed() -> Column:
    """The rules that hold without labels."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def allowed_failures(n: Column, risk: float, error: Column) -> Column:
    """Largest k for which P(Binomial(n, risk) <= k) <= error, or -1: so many of n good documents may
    be rejected with the true share still under ``risk`` at that error (Clopper and Pearson).

    The sum of probabilities is carried relative to its last term and as a logarithm, so large n do
    not underflow.  The search ends at the mean, beyond which the sum passes any small error.
    """
    odds = F.lit(risk / (1 - risk))
    start = F.struct(
        (n * F.log1p(F.lit(-risk))).alias("last"),  # log P(k)
        F.lit(1.0).alias("ratio"),  # P(<= k) / P(k)
        F.lit(-1).cast("long").alias("found"),
    )

    def step(state: Column, k: Column) -> Column:
        grown = F.when(k == 0, F.lit(0.0)).otherwise(F.log((n - k + 1) / F.greatest(k, F.lit(1)) * odds))
        ratio = F.when(k == 0, F.lit(1.0)).otherwise(F.lit(1.0) + state["ratio"] * F.exp(-grown))
        last = state["last"] + grown
        return F.struct(
            last.alias("last"),
            ratio.alias("ratio"),
            F.when(last + F.log(ratio) <= F.log(error), k).otherwise(state["found"]).alias("found"),
        )

    upto = F.sequence(F.lit(0).cast("long"), F.ceil(n * risk).cast("long"))
    return F.aggregate(upto, start, step, lambda state: state["found"])


def certified_cutoffs(
    labelled: DataFrame, stratum: str, good: Column, alpha: float = 0.02, delta: float = 0.05, grid: tuple[float, ...] = GRID
) -> DataFrame:
    """(stratum, one cutoff column per measure; null where none is certified).

    ``labelled`` has the counts of labelled documents that pass the base rules.  It is reduced to
    one row of counts per stratum, merged before the shuffle; nothing is collected.
    """
    rules = len(MEASURES)
    held = labelled.where(good)
    counts = held.groupBy(stratum).agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.array(*[F.count(F.when(F.expr(measure) > cut, 1)) for cut in grid]).alias(f"_over_{name}")
            for name, measure in MEASURES.items()
        ],
    )
    strata = counts.agg(F.count(F.lit(1)).alias("_strata"))
    tested = counts.join(strata).withColumn(  # one row
        "_allowed", allowed_failures(F.col("_n"), alpha / rules, F.lit(delta) / (F.col("_strata") * rules))
    )
    steps = F.array(*[F.lit(c) for c in grid])

    def strictest(name: str) -> Column:
        """Counts only fall as cutoffs rise, so the passing ones are the end of the sequence."""
        passing = F.filter(F.transform(f"_over_{name}", lambda over, i: F.when(over <= F.col("_allowed"), F.get(steps, i))), lambda c: c.isNotNull())
        return F.array_min(passing).alias(f"cut_{name}")

    return tested.select(stratum, *[strictest(name) for name in MEASURES])


def judged(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", alpha: float = 0.02, delta: float = 0.05,
) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``.

    A stratum without labels, or a null one, has no certified cutoff: its documents are kept unless
    the base rules fail.  A document labelled twice counts as good only if all its labels are.
    Null labels are no labels.  No documents give no rows.
    """
    rows = stored(measures(docs, id_col, text_col, keep=(stratum,)).withColumn("base_failed", base_failed()), "quality-measures")
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_doc")).agg(F.min(F.col(label_col).cast("int")).alias("_good"))
    labelled = rows.where(~F.col("base_failed")).join(marks, rows[id_col] == F.col("_doc")).drop("_doc")
    cuts = stored(certified_cutoffs(labelled, stratum, F.col("_good") == 1, alpha, delta), "quality-cutoffs").withColumnRenamed(stratum, "_stratum")
    over = [F.coalesce(F.expr(measure) > F.col(f"cut_{name}"), F.lit(False)) for name, measure in MEASURES.items()]
    rejected = over[0]
    for one in over[1:]:
        rejected = rejected | one
    return rows.join(cuts, rows[stratum] == F.col("_stratum"), "left").select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~rejected).alias("kept")
    )
