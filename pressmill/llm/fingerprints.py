"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A document is a bag of words with their frequencies as weights. For sample ``j`` and word
``w`` hashing gives r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), the same in every document.
With weight S the word's level is t = floor(ln S / r + b) and its key
ln a = ln c - r (t - b + 1); the sample is the (word, level) with the smallest key. Two
documents agree in a sample with a probability equal to their generalised Jaccard
similarity, sum of min over sum of max of the weights.

Texts are shuffled once: documents are dealt by ranges of doc_id, so the next document is
in the same task but for the ends of ranges, whose few texts are fetched by themselves.
What follows keeps that partitioning.

Cases: a null text counts as empty. A text without words is the bag of one empty word: all
such texts agree and differ from the rest. Documents are ordered by falling doc_id, null
last, then text; a lone document is followed by itself. An empty table gives an empty
result. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm.common import BLANKS, shuffle_parts, text_or_empty
from pressmill.session import computed_once

SAMPLES = 32
_BITS = float(1 << 32)
_LOW = 0xFFFFFFFF
#: Steps that a key's logarithm is cut to; with the sample behind it, it fits 64 bits.
_STEPS = float(1 << 20)


def words(text: Column) -> Column:
    """Words between blanks; one empty word where there is none."""
    found = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    return F.when(F.size(found) == 0, F.array(F.lit(""))).otherwise(found)


def _uniforms(word: Column, j: int) -> tuple[Column, Column]:
    """Two independent numbers in (0, 1)."""
    mixed = F.xxhash64(word, F.lit(j))
    low = (mixed.bitwiseAND(F.lit(_LOW)) + 0.5) / _BITS
    return (F.shiftrightunsigned(mixed, 32) + 0.5) / _BITS, low


def sample(word: Column, log_weight: Column, j: int) -> Column:
    """Key of a hashed word in sample ``j`` above 32 bits that name word and level."""
    u1, u2 = _uniforms(word, 3 * j)
    v1, v2 = _uniforms(word, 3 * j + 1)
    b, _ = _uniforms(word, 3 * j + 2)
    r = -F.log(u1 * u2)
    t = F.floor(log_weight / r + b)
    key = F.log(-F.log(v1 * v2)) - r * (t - b + 1)
    name = F.xxhash64(word, t).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(F.floor(key * _STEPS), 32) + name


def bags(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``word`` (hashed) and ``weight``, the logarithm of its frequency.

    Words are counted inside their row: equal ones stand side by side once sorted, and
    run from one start to the next. No state is kept for the words of a task's documents.
    """
    hashed = F.sort_array(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))
    rows = computed_once(texts.select(*keys, hashed.alias("_words")))
    fresh = lambda w, k: (k == 0) | (w != F.get("_words", k - 1))
    marked = F.transform("_words", lambda w, k: F.when(fresh(w, k), k))
    rows = computed_once(rows.select(*keys, "_words", F.array_compact(marked).alias("_starts")))
    end = lambda j: F.coalesce(F.get("_starts", j + 1), F.size("_words"))
    found = F.transform(
        "_starts",
        lambda k, j: F.struct(F.get("_words", k).alias("word"), (end(j) - k).alias("times")),
    )
    return rows.select(*keys, F.explode(found).alias("_w")).select(
        *keys, "_w.word", F.log(F.col("_w.times").cast("double")).alias("weight")
    )


def fingerprints(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``texts`` (``keys`` and ``text``) -> ``keys`` and ``print``, an array of samples."""
    least = bags(texts, keys).groupBy(*keys).agg(
        *(F.min(sample(F.col("word"), F.col("weight"), j)).alias(f"s{j}") for j in range(samples))
    )
    low = [F.col(f"s{j}").bitwiseAND(F.lit(_LOW)) for j in range(samples)]
    return least.select(*keys, F.array(*low).alias("print"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples that agree."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return same / F.lit(float(samples))


def as_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _ranges(docs: DataFrame) -> DataFrame:
    """``docs`` with ``part``, the range of the doc_id; null ids are a range below all."""
    parts = shuffle_parts(docs.sparkSession)
    shares = [k / parts for k in range(1, parts)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10_000)).first()[0] or []
    marks = F.array(*(F.lit(b).cast("long") for b in sorted(set(bounds)))) if bounds else F.array().cast("array<long>")
    above = F.size(F.filter(marks, lambda b: b < F.col("doc_id")))
    return docs.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(above))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``next_text``, the text of the following document."""
    spark = docs.sparkSession
    base = _ranges(docs.select("doc_id", text_or_empty().alias("text")))
    heads = base.groupBy("part").agg(F.max("doc_id").alias("head")).collect()  # one row a range
    heads.sort(key=lambda r: -r["part"])
    after = [(a["part"], b["head"]) for a, b in zip(heads, heads[1:] + heads[:1], strict=True)]
    links = spark.createDataFrame(after, "_part int, _head long")
    ends = (
        base.join(F.broadcast(links), F.col("doc_id").eqNullSafe(F.col("_head")))
        .groupBy("_part")
        .agg(F.min("text").alias("_end"))
    )
    order = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    return (
        base.withColumn("at", F.row_number().over(order))
        .withColumn("_lead", F.lead("text").over(order))
        .join(ends, F.col("part") == F.col("_part"), "left")
        .select(
            "part", "at", "doc_id", "text",
            F.col("_lead").isNull().alias("last"),
            F.coalesce("_lead", "_end").alias("next_text"),
        )
    )


def edited(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by the first as many of ``following``."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def compare_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    rows = with_next(docs)
    changed = edited(F.col("text"), F.col("next_text"))
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), changed.alias("text")),
        F.struct(F.lit(2).alias("kind"), F.when(F.col("last"), F.col("next_text")).alias("text")),
    )
    texts = rows.select("part", "at", F.explode(kinds).alias("t")).where("t.text IS NOT NULL")
    prints = fingerprints(texts.select("part", "at", "t.kind", "t.text"), ["part", "at", "kind"], samples)
    of_kind = lambda k: F.max(F.when(F.col("kind") == k, F.col("print")))
    each = prints.groupBy("part", "at").agg(
        of_kind(0).alias("own"), of_kind(1).alias("edit"), of_kind(2).alias("end")
    )
    following = F.lead("own").over(Window.partitionBy("part").orderBy("at"))
    each = each.withColumn("next", F.coalesce("end", following))
    told = rows.select(
        "part", "at", "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(changed, 256).alias("edited_sha256"),
    )
    return told.join(each, ["part", "at"]).select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), samples).alias("near_next"),
    )
