"""Near-duplicate lines across documents by a deletion-neighbourhood join, without Python.

Two lines are near if one edit (a character put in, left out or replaced) or none turns one into
the other.  One edit leaves the first or the last half of the shorter line's length intact, so
only lines that share such a half with another line go on.  Those emit, under the shared half,
hashed keys of the rest of the line with each character left out; lines with an equal key are
candidates, and their edit distance is verified.  Of near lines the earliest stays.

A rest above ``EXACT_CHARS`` is hashed by the sum of its characters' hashes, so that all its
variants cost one key per distinct character and not one text per place; equal variants still have
equal keys, and the verification removes what else meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerworks.llm.common import release, stored

EXACT_CHARS = 48
#: Shortest lines that are matched nearly.
MIN_CHARS = 20
#: Matches lines with a word.
SOME_WORD = r"[^\x20\x09-\x0D]"


def _half(line: Column, length: Column, side: str) -> Column:
    """First or last half of ``length`` characters' worth of a line."""
    size = F.floor(length / 2).cast("int")
    return F.left(line, size) if side == "first" else F.right(line, size)


def _rest(line: Column, length: Column, side: str) -> Column:
    size = F.floor(length / 2).cast("int")
    return F.substr(line, size + 1) if side == "first" else F.left(line, F.length(line) - size)


#: What a line can be to a partner: of the shorter (or equal) length, or one longer; and the half shared.
_ROLES = [(0, "first"), (0, "last"), (1, "first"), (1, "last")]


def _half_key(line: Column, role: int) -> Column:
    longer, side = _ROLES[role]
    length = F.length(line) - longer
    return F.xxhash64(length, F.lit(side), _half(line, length, side))


def _char_hash(char: Column) -> Column:
    return F.xxhash64(char).bitwiseAND((1 << 40) - 1)


def _with_variant_keys(lines: DataFrame) -> DataFrame:
    """Explode the keys of the variants of each line's rest in its role, bound to the shared half."""
    line, first = F.col("line"), F.col("role") % 2 == 0
    length = F.length(line) - F.when(F.col("role") >= 2, 1).otherwise(0)
    parts = lines.withColumn("length", length).select(
        "*",
        F.when(first, _half(line, F.col("length"), "first")).otherwise(_half(line, F.col("length"), "last")).alias("half"),
        F.when(first, _rest(line, F.col("length"), "first")).otherwise(_rest(line, F.col("length"), "last")).alias("rest"),
    )
    parts = parts.select(
        "k1", "k2", "role", "rest", F.length("rest").alias("size"), F.xxhash64("length", F.col("role") % 2, "half").alias("bound")
    ).withColumn("chars", F.when(F.col("size") > EXACT_CHARS, F.split("rest", "")).otherwise(F.array().cast("array<string>")))
    parts = parts.withColumn("total", F.aggregate("chars", F.lit(0).cast("long"), lambda acc, c: acc + _char_hash(c)))
    size, bound, rest = F.col("size"), F.col("bound"), F.col("rest")
    # At the limit a longer line's rest meets that of a shorter one, which is hashed exactly.
    places = F.when((size > 0) & (size <= EXACT_CHARS + 1), F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    exact = F.transform(places, lambda i: F.xxhash64(bound, F.concat(F.left(rest, i - 1), F.substr(rest, i + 1))))
    summed = F.transform(F.array_distinct("chars"), lambda c: F.xxhash64(bound, size - 1, F.col("total") - _char_hash(c)))
    whole = F.when(size <= EXACT_CHARS, F.xxhash64(bound, rest)).otherwise(F.xxhash64(bound, size, "total"))
    own = F.when(F.col("role") < 2, F.array(whole)).otherwise(F.array().cast("array<bigint>"))
    return parts.select("k1", "k2", F.explode(F.array_distinct(F.concat(own, exact, summed))).alias("key"))


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two texts are equal or one edit apart, in a logarithmic number of comparisons.

    The common beginning is found by halving; the remainders must then agree, with a character of
    either or both left out.
    """
    shorter = F.least(F.length(a), F.length(b))
    bits = F.sequence(F.ceil(F.log2(shorter + 1)).cast("int"), F.lit(0))

    def longer(common: Column, bit: Column) -> Column:
        more = common + F.pow(F.lit(2), bit).cast("int")
        return F.when((more <= shorter) & (F.left(a, more) == F.left(b, more)), more).otherwise(common)

    common = F.aggregate(bits, F.lit(0), longer)
    skip, drop = F.substr(a, common + 1), F.substr(b, common + 1)
    return (
        (F.abs(F.length(a) - F.length(b)) <= 1)
        & ((F.substr(skip, F.lit(2)) == F.substr(drop, F.lit(2))) | (skip == F.substr(drop, F.lit(2))) | (F.substr(skip, F.lit(2)) == drop))
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int | None = None, near_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with every line removed that has an equal or near line before it.

    Order is (document id, place in the document); lines are judged on the input, so a removed
    line still counts as an earlier one.  Lines are what ``\\n`` separates, as they are.  Those below
    ``near_chars`` characters go only if an equal line is before them, and those without a word
    always stay.  ``min_chars`` is one floor instead: all lines below it stay, all others are matched
    nearly.  All columns are kept, the text is replaced, and
    ``n_lines`` and ``n_removed`` (long) are added, replacing columns of these names.

    A null text stays null with no lines; an empty one has one empty line.  A null id comes before
    all others.  Rows that repeat an id count as being at the same place: none removes the other.
    """
    spare = "_lw_"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    keyed = texts.select("id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    long = F.length("line") >= (near_chars if min_chars is None else min_chars)
    keyed = keyed.where(F.col("line").rlike(SOME_WORD) if min_chars is None else long)
    here = F.struct("id", "pos", "t")
    line = F.col("line")
    narrow = keyed.select(
        "id", "pos", "t", F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"),
        *[F.when(long, _half_key(line, role)).alias(f"h{role}") for role in range(4)],
    )
    distinct = stored(
        narrow.groupBy("k1", "k2").agg(
            F.min(here).alias("first"), F.count(F.lit(1)).alias("n"), *[F.min(f"h{r}").alias(f"h{r}") for r in range(4)]
        ),
        "lines-distinct",
    )
    halves = distinct.select("k1", "first", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"h{r}").alias("h")) for r in range(4)])).alias("x"))
    halves = halves.select("k1", "first", "x.role", "x.h").where("h is not null")
    crowded = halves.groupBy("h").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).where("a != b").select("h")
    wanted = halves.join(crowded, "h").select(F.col("first.id").alias("id"), F.col("first.t").alias("t"), F.col("first.pos").alias("pos"), "role")
    wanted = stored(wanted.groupBy("id", "t").agg(F.collect_set(F.struct("pos", "role")).alias("wanted")), "lines-wanted")
    # Texts of the lines that share a half; one row per role of a line.
    hashed = texts.withColumn("t", F.xxhash64("text"))
    same = hashed["id"].eqNullSafe(wanted["id"]) & (hashed["t"] == wanted["t"])
    # Most lists are too many to be sent to every task; the plan is the same at every size.
    found = hashed.join(wanted.hint("merge"), same).select(hashed["id"], hashed["t"], F.split("text", "\n").alias("all"), F.explode("wanted").alias("w"))
    found = found.select(F.struct("id", "w.pos", "t").alias("first"), "w.role", F.get("all", F.col("w.pos")).alias("line")).dropDuplicates(["first", "role"])
    lines = stored(found.withColumn("k1", F.xxhash64("line")).withColumn("k2", F.xxhash64("line", F.lit(1))), "lines-near")
    release(wanted)
    variants = stored(_with_variant_keys(lines), "lines-variants")
    left, right = variants.alias("a"), variants.alias("b")
    pairs = left.join(right, "key").where("struct(a.k1, a.k2) < struct(b.k1, b.k2)")
    pairs = pairs.select(F.col("a.k1").alias("a1"), F.col("a.k2").alias("a2"), F.col("b.k1").alias("b1"), F.col("b.k2").alias("b2")).distinct()
    once = lines.groupBy("k1", "k2").agg(F.min("first").alias("first"), F.first("line").alias("line"))
    one = once.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("first").alias("af"), F.col("line").alias("al"))
    two = once.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("first").alias("bf"), F.col("line").alias("bl"))
    near = stored(
        pairs.join(one, ["a1", "a2"]).join(two, ["b1", "b2"]).where(within_one_edit(F.col("al"), F.col("bl"))).select("a1", "a2", "af", "b1", "b2", "bf"),
        "lines-pairs",
    )
    release(lines, variants)
    # The earliest place of a line or of one near it.
    links = near.select(F.col("a1").alias("k1"), F.col("a2").alias("k2"), F.col("bf").alias("first")).unionByName(
        near.select(F.col("b1").alias("k1"), F.col("b2").alias("k2"), F.col("af").alias("first"))
    )
    repeated = distinct.where("n > 1").select("k1", "k2", "first")
    earliest = stored(links.unionByName(repeated).groupBy("k1", "k2").agg(F.min("first").alias("first")), "lines-earliest")
    release(distinct, near)
    places = keyed.select("id", "pos", "t", F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"))
    later = places.join(earliest, ["k1", "k2"]).where("struct(first.id, first.pos) < struct(id, pos)")
    removed = later.groupBy(F.col("id").alias(f"{spare}id"), F.col("t").alias(f"{spare}t")).agg(F.collect_set("pos").alias(f"{spare}gone"))
    base = docs.drop("n_lines", "n_removed").withColumn(f"{spare}hash", F.xxhash64(text_col))
    out = base.join(
        removed.hint("merge"), base[id_col].eqNullSafe(F.col(f"{spare}id")) & (F.col(f"{spare}hash") == F.col(f"{spare}t")), "left"
    ).withColumn(f"{spare}lines", F.split(F.col(text_col), "\n"))
    every = F.col(f"{spare}lines")
    stay = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(f"{spare}gone"))
    text = F.when(F.col(f"{spare}gone").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(stay, lambda i: F.get(every, i)), "\n"))
    return out.withColumn(text_col, text).withColumn("n_lines", F.coalesce(F.size(every), F.lit(0)).cast("long")).withColumn(
        "n_removed", F.coalesce(F.size(f"{spare}gone"), F.lit(0)).cast("long")
    ).select(*base.columns[:-1], "n_lines", "n_removed")
