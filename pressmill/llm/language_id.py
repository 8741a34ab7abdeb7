"""Language ID with error-correcting output codes.

Every language has a codeword. For each bit a binary classifier on hashed byte trigrams
tells the languages with a 1 from those with a 0; a text gives a margin for each bit. The
decoded language is the one whose codeword loses least, bits weighted by how far they
could be trusted on training rows. A text whose bits are further from the codeword than
the code can correct, or whose two best languages lose nearly the same, is ambiguous.

All training rows give the trigram counts, summed in Spark to one number per language and
trigram; only that table, whose size the number of trigram buckets and languages bounds,
comes to the driver. The trust in bits and the scale of the score are measured on a sample
of at most about ``CALIBRATION_ROWS`` training rows.

Cases: a text that is null or has no letter is ``und`` with score 0; so is every text if
nothing was labelled. Texts are read whole, in blocks of bounded size. Ties between
languages go to the first by name. Repeated rows are learned as often as they stand there.
Added columns replace columns of the same name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.session import prepare_workers

BUCKETS = 1 << 16
CALIBRATION_ROWS = 2000
#: Bytes of text looked at together.
BLOCK = 1 << 20
UNKNOWN = "und"
#: Two languages closer than this in probability are not told apart.
CLOSE = 0.1


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # buckets x bits, mean gives the margins
    trust: np.ndarray  # of each bit
    sharpness: float


def codewords(languages: int) -> np.ndarray:
    """The exhaustive code up to six languages; beyond, the best of some random ones."""
    if languages <= 6:
        rows = [[1] * (1 << max(0, languages - 1))]
        for k in range(1, languages):
            run = 1 << (languages - 1 - k)
            rows.append([-1 if (c // run) % 2 == 0 else 1 for c in range(len(rows[0]))])
        code = np.array(rows, dtype=np.int8)
        return code[:, :-1] if languages > 1 else code  # the last column is the same for all
    bits = int(np.ceil(10 * np.log2(languages)))
    rng = np.random.default_rng(0)
    tries = (np.where(rng.random((languages, bits)) < 0.5, 1, -1).astype(np.int8) for _ in range(50))
    fit = [c for c in tries if (np.abs(c.sum(axis=0)) < languages).all()]
    return max(fit, key=_distance)


def _distance(code: np.ndarray) -> int:
    return min((int((a != b).sum()) for a, b in combinations(code, 2)), default=len(code[0]))


def _blocks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Trigram buckets of runs of texts: first, past last, buckets, where each text starts.
    A text over ``BLOCK`` bytes makes a run of its own."""
    first, parts, size = 0, [], 0
    for k, text in enumerate(texts):
        parts.append(text.lower().encode("utf-8", "replace") + b"  ")
        size += len(parts[-1])
        if size >= BLOCK or k + 1 == len(texts):
            data = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
            starts = np.cumsum([0, *map(len, parts)])[:-1]
            mixed = (data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * np.uint32(2654435761)
            grams = np.append(mixed >> np.uint32(16), [0, 0]).astype(np.int64)
            yield first, k + 1, grams, starts
            first, parts, size = k + 1, [], 0


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [x.as_py() or "" for x in batch.column("text")]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = _texts(batch), batch.column("lang").to_pylist()
        for lang in set(langs):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            for _, _, grams, _ in _blocks(mine):
                total += np.bincount(grams, minlength=BUCKETS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
            ["lang", "gram", "times"],
        )


def margins(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean log odds of every bit over the trigrams of every text."""
    out = np.zeros((len(texts), weights.shape[1]))
    for first, past, grams, starts in _blocks(texts):
        sums = np.add.reduceat(weights[grams], starts, axis=0)
        out[first:past] = sums / np.diff(np.append(starts, len(grams)))[:, None]
    return out


def _losses(found: np.ndarray, code: np.ndarray, trust: np.ndarray) -> np.ndarray:
    """Weighted logistic loss of every row against every codeword."""
    agree = found[:, None, :] * code[None, :, :]
    return (np.logaddexp(0, -agree) * trust).sum(axis=2) / trust.sum()


def decode(found: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the language, its probability and whether the text is ambiguous."""
    losses = _losses(found, model.code, model.trust) * model.sharpness
    odds = np.exp(losses.min(axis=1, keepdims=True) - losses)
    odds /= odds.sum(axis=1, keepdims=True)
    best = losses.argmin(axis=1)
    score = odds[np.arange(len(best)), best]
    second = np.sort(odds, axis=1)[:, -2] if odds.shape[1] > 1 else np.zeros(len(best))
    wrong = (np.sign(found) != model.code[best]).sum(axis=1)
    can_mend = (_distance(model.code) - 1) // 2
    return best, score, (wrong > can_mend) | (score - second < CLOSE)


def in_training(column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves another remainder by three than 1."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 3 != 1


def train(docs: DataFrame, learn: Column | None = None) -> Model | None:
    """A model of the labelled rows that ``learn`` picks; None if there are none."""
    spark = docs.sparkSession
    prepare_workers(spark)
    learn = in_training() if learn is None else learn
    rows = docs.where(learn & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = (
        rows.select("text", "lang")
        .mapInArrow(_gram_counts, "lang string, gram long, times long")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
        .toPandas()
    )
    if counts.empty:
        return None
    languages = sorted(counts["lang"].unique())
    table = np.full((len(languages), BUCKETS), 0.1)
    index = counts["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy()
    np.add.at(table, (index, counts["gram"].to_numpy()), counts["times"].to_numpy())
    table /= table.sum(axis=1, keepdims=True)  # large languages don't outweigh small ones
    code = codewords(len(languages))
    ones = (code == 1).astype(float)
    p = ones.T @ table / np.maximum(1, ones.sum(axis=0))[:, None]
    q = (1 - ones).T @ table / np.maximum(1, (1 - ones).sum(axis=0))[:, None]
    odds = np.log(p) - np.log(q) if len(languages) > 1 else np.zeros_like(p)
    weights = np.ascontiguousarray(odds.T, dtype=np.float32)
    model = Model(languages, code, weights, np.ones(code.shape[1]), 1.0)
    return _calibrated(model, rows) if len(languages) > 1 else model


def _calibrated(model: Model, rows: DataFrame) -> Model:
    share = CALIBRATION_ROWS / max(1, rows.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(F.coalesce(place, F.lit(0.0)) < share).limit(4 * CALIBRATION_ROWS)
    weights = model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = margins(_texts(batch), weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(found.tolist(), pa.list_(pa.float64()))], ["lang", "found"]
            )

    seen = sample.mapInArrow(run, "lang string, found array<double>").toPandas()
    if seen.empty:
        return model
    truth = seen["lang"].map({x: k for k, x in enumerate(model.languages)}).to_numpy()
    found = np.array(seen["found"].tolist())
    error = (np.sign(found) != model.code[truth]).mean(axis=0)
    error = np.clip(error, 0.5 / len(seen), 0.5 - 1e-3)
    model.trust = np.log((1 - error) / error)
    model.trust /= model.trust.max()
    losses = _losses(found, model.code, model.trust)
    rest = losses - losses[np.arange(len(truth)), truth][:, None]
    grid = [2.0**k for k in range(0, 9)]
    cost = [np.log(np.exp(np.minimum(-s * rest, 50)).sum(axis=1)).mean() for s in grid]
    model.sharpness = grid[int(np.argmin(cost))]
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous``, from the text alone."""
    spark = docs.sparkSession
    prepare_workers(spark)
    added = ("lang_pred", "score", "ambiguous")
    kept = [f for f in docs.schema.fields if f.name not in added]
    names = [f.name for f in kept]
    kinds = [T.StringType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in zip(added, kinds, strict=True))])
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = _texts(batch)
            letters = np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))
            if model is None:
                letters[:] = False
            lang = np.full(len(texts), UNKNOWN, dtype=object)
            score, unsure = np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            if letters.any():
                at = np.flatnonzero(letters)
                best, score[at], unsure[at] = decode(margins([texts[i] for i in at], model.weights), model)
                lang[at] = np.array(model.languages, dtype=object)[best]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)],
                [*names, *added],
            )

    return docs.select(*names).mapInArrow(run, schema)


def predict(docs: DataFrame) -> DataFrame:
    """Every document's language, learned from the others of the table."""
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", (~in_training()).alias("held_out"), "lang_pred", "score", "ambiguous")
