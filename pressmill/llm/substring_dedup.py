"""Substring dedup: repeated passages and near-equal paragraphs are found and cut out.

A passage may be pasted anywhere, so every window of ``MIN_WORDS`` words that stands in two
documents counts. Not all windows are sent around: each has a seed, the least hash of the
eight-word pieces in it, which is the same wherever the window stands. Documents meet by
seeds; only windows whose seed several documents have are then compared by themselves, all
of them. The document with the least id keeps a window; in the others, the words of
such windows go, up to the last word that is repeated.

Paragraphs are the lines of at least ``MIN_WORDS`` words, as sets of five-word shingles.
Different ones that may agree collide in a band of their MinHash values; the bands are tuned
to find a pair at the threshold with at least the wanted probability. What collides is settled
as in the n-gram join: hubs first, then all that is left of a bucket across components, by
bitmaps and exact Jaccard similarity. Of a component the paragraphs of the document with the
least id stay. Runs of removed words shorter than ``MIN_WORDS`` stay.

Cases: a null text stays null and an empty one empty; a text of fewer than sixteen words
stays as it is. What is repeated only inside one document stays.
Rows with the same id and text count as one document, others are documents of their own; a
null id comes after all others and is never the one that keeps a passage while another could. Texts of any length are read whole. An
empty table gives an empty result. Other columns are kept; ``spans`` and ``removed_words``
replace columns of that name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.llm.common import drop_stage, free_driver, shuffle_parts, stage
from pressmill.llm.meeting import NAMES, SCHEMA, entries, members
from pressmill.llm.ngram_join import distinct_tiles, settled, signature
from pressmill.llm.shingles import WIDTH, hashes_of, mixed, shingles
from pressmill.session import prepare_workers

SIMILARITY, RECALL = 0.8, 0.95
#: Words of a window, of the shortest paragraph and of the shortest passage that is cut out.
MIN_WORDS = 16
#: Documents of a map task that are looked at together, and from which passages are cut at once.
DOCUMENTS, CUT_DOCUMENTS = 4096, 256
#: Bytes of the texts that are read together; a longer text is read by itself.
BLOCK_BYTES = 1 << 18
LAST_ID = (1 << 63) - 1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = 4) -> tuple[int, int]:
    """Bands and rows of each: the strictest rows whose bands, at most ``most``, reach it."""
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands <= most or rows == 1:
            return bands, rows
    raise AssertionError


@dataclass
class Paragraphs:
    """Shingles of the paragraphs of some texts side by side, each ``start`` to ``stop - 1``,
    the place of each one's first, the number of its text, and the paragraphs themselves."""

    shingle: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    place: np.ndarray
    text: np.ndarray
    lines: list[bytes]

    @property
    def ids(self) -> np.ndarray:
        """64 bits for each multiset of shingles."""
        if not len(self.start):
            return np.zeros(0, dtype=np.int64)
        total = np.add.reduceat(mixed(self.shingle + np.uint64(1)), self.start)
        return mixed(total + (self.stop - self.start).astype(np.uint64)).view(np.int64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and the first paragraph of each id in each text, by text and id."""
        ids = self.ids
        order = np.lexsort((ids, self.text))
        return ids, order[_heads(self.text[order], ids[order])]

    def band_keys(self, bands: int, rows: int, some: np.ndarray) -> np.ndarray:
        """Of the paragraphs ``some``, a row for each band."""
        out = np.empty((bands, len(some)), dtype=np.int64)
        for b in range(bands):
            key = np.full(len(self.start), b, dtype=np.uint64)
            for r in range(rows):
                own = np.uint64(2 + b * rows + r)
                key = mixed(key + np.minimum.reduceat(mixed(self.shingle ^ mixed(own[None])[0]), self.start))
            out[b] = key[some].view(np.int64)
        return out


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where runs of rows begin that agree in all columns."""
    new = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.append(True, new)[: len(columns[0])])


class Block:
    """Some texts, read together: a step of numpy for all of them and not for each."""

    def __init__(self, texts: list[bytes]) -> None:
        lines = b"\n".join(texts).lower().split(b"\n")
        words = list(map(bytes.split, lines))
        size = np.fromiter(map(len, words), np.int64, len(words))
        line_text = np.repeat(np.arange(len(texts)), [t.count(b"\n") + 1 for t in texts])
        self._text = np.repeat(line_text, size)
        # Pieces that begin in one text and end in another are never looked at.
        self._five = shingles(hashes_of(list(chain.from_iterable(words))))
        place = np.cumsum(size) - size
        long = np.flatnonzero(size >= MIN_WORDS)
        place, size = place[long], size[long] - WIDTH + 1
        ends = np.cumsum(size)
        at = np.repeat(place - (ends - size), size) + np.arange(size.sum())
        self.found = Paragraphs(self._five[at], ends - size, ends, place, line_text[long], [lines[i] for i in long])

    def _inside(self) -> np.ndarray:
        """Places from which ``MIN_WORDS`` words of one text stand."""
        last = self._text[MIN_WORDS - 1 :]
        return np.flatnonzero(last == self._text[: len(last)])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """The ``MIN_WORDS`` words from every place on as a number each, and its text."""
        n, at = len(self._text) - MIN_WORDS + 1, self._inside()
        if n < 1:
            return np.zeros(0, dtype=np.int64), at
        whole = np.zeros(n, dtype=np.uint64)
        for k in (0, 5, 10, MIN_WORDS - WIDTH):
            whole = mixed(whole + self._five[k : k + n])
        return whole[at].view(np.int64), self._text[at]

    def seeds(self) -> np.ndarray:
        """The seed of every window."""
        at = self._inside()
        if not len(at):
            return np.zeros(0, dtype=np.int64)
        seed = mixed(mixed(self._five[:-3]) + self._five[3:])  # eight words
        for step in (1, 2, 4, 1):  # the least of nine
            seed = np.minimum(seed[:-step], seed[step:])
        return seed[at].view(np.int64)

    def window_texts(self) -> np.ndarray:
        return self._text[self._inside()]


def paragraphs(text: str | None) -> Paragraphs:
    return Block([_bytes(text)]).found


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _blocks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of about ``BLOCK_BYTES`` together, and the number of the first."""
    first, block, size = 0, [], 0
    for text in texts:
        block.append(_bytes(text.as_py()))
        size += len(block[-1])
        if size >= BLOCK_BYTES:
            yield first, block
            first, block, size = first + len(block), [], 0
    if block:
        yield first, block


def _among(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``table``."""
    if not len(table):
        return np.zeros(values.shape, dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _owner() -> Column:
    """What tells documents apart: 64 bits for id and text, as an id may repeat or be null."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = DOCUMENTS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _meeting_keys(bands: int, rows: int, parts: int):
    """Documents to entries of their seeds and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            keys, owners, told = [], [], part.column("owner").to_numpy()
            for first, texts in _blocks(part.column("text")):
                block, owner = Block(texts), told[first : first + len(texts)]
                seed, text = block.seeds(), block.window_texts()
                heads = _heads(text, seed)
                keys.append(seed[heads])
                owners.append(owner[text[heads]])
                found = block.found
                if found.lines:
                    _, one = found.distinct()
                    key, text = found.band_keys(bands, rows, one).ravel(), np.tile(found.text[one], bands)
                    order = np.lexsort((key, text))
                    key, text = key[order], text[order]
                    heads = _heads(text, key)
                    key, text, times = key[heads], text[heads], np.diff(np.append(heads, len(key)))
                    # Different paragraphs of one document meet too: it counts as two.
                    keys += [key, key[times > 1]]
                    owners += [owner[text], ~owner[text[times > 1]]]
            if keys:
                yield from entries([np.concatenate(keys), np.concatenate(owners)], parts)

    return run


def _numbers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64)).view(np.int64)


_SHARED = "cls long, owner long, doc long, keys array<long>, n long, sign binary, text string"
_SHARED_NAMES = [c.split()[0] for c in _SHARED.split(", ")]


def _shared(bands: int, rows: int, parts: int):
    """Documents with the ``keys`` that others have too: entries of the windows with such a
    seed, and a row for each paragraph with such a band key. Of equal paragraphs of a batch
    one has its text."""
    kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            keys, owners, docs, lines, seen = [], [], [], [], set()
            told = [part.column(c).to_numpy() for c in ("owner", "doc")]
            for first, texts in _blocks(part.column("text")):
                block = Block(texts)
                owner, doc = (c[first : first + len(texts)] for c in told)
                # A key is looked up among those of its own text, under a number of the text's own.
                met, own = part.column("keys").slice(first, len(texts)), _numbers(len(texts))
                table = np.sort(met.flatten().to_numpy() ^ np.repeat(own, np.diff(met.offsets.to_numpy())))
                seed, (whole, text) = block.seeds(), block.windows()
                heads = _heads(text, seed)
                here = _among(table, seed[heads] ^ own[text[heads]])
                here = np.repeat(here, np.diff(np.append(heads, len(seed))))
                keys.append(whole[here])
                owners.append(owner[text[here]])
                docs.append(doc[text[here]])
                found = block.found
                if found.lines:
                    ids, one = found.distinct()
                    key = found.band_keys(bands, rows, one)
                    here = _among(table, key ^ own[found.text[one]])
                    for k in np.flatnonzero(here.any(axis=0)):
                        at, shingle, line = one[k], (), None
                        cls, mine, text = int(ids[at]), key[here[:, k], k].tolist(), found.text[at]
                        if cls not in seen:
                            seen.add(cls)
                            shingle = np.unique(found.shingle[found.start[at] : found.stop[at]])
                            line = found.lines[at].decode()
                        sign = None if line is None else signature(shingle)
                        lines.append((cls, int(owner[text]), int(doc[text]), mine, len(shingle), sign, line))
            if lines:
                columns = [pa.array(c, t) for c, t in zip(zip(*lines, strict=True), kinds, strict=True)]
                none = [pa.nulls(len(lines), t) for t in (pa.int32(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *none], [*_SHARED_NAMES, *NAMES])
            if keys:
                for x in entries([np.concatenate(c) for c in (keys, owners, docs)], parts):
                    none = [pa.nulls(x.num_rows, t) for t in kinds]
                    yield pa.RecordBatch.from_arrays([*none, *x.columns], [*_SHARED_NAMES, *NAMES])

    return run


def _gone(told: DataFrame, group: str) -> DataFrame:
    """``owner, piece, keeper``: all of each group but what the first document has."""
    first = F.min(F.struct("doc", "owner")).alias("first")
    keepers = told.groupBy(group).agg(first)
    return told.join(keepers, group).where(F.col("owner") != F.col("first.owner")).select(
        "owner", "piece", F.col("first.doc").alias("keeper")
    )


def repeated_pieces(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``owner, piece, keeper``: the windows and paragraphs that go from a document and which
    document has them; and the staged tables that this reads."""
    spark = docs.sparkSession
    prepare_workers(spark)
    bands, rows = tune_bands()
    parts = shuffle_parts(spark)
    docs = docs.select("text", _owner().alias("owner"), F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"))
    found = docs.select("text", "owner").mapInArrow(_meeting_keys(bands, rows, parts), SCHEMA)
    met = stage(members(found, ["key", "owner"]).select("key", "owner"))
    free_driver(spark)
    wanted = met.groupBy("owner").agg(F.collect_set("key").alias("keys"))
    shared = stage(
        docs.join(wanted, "owner")
        .select("owner", "doc", "text", "keys")
        .mapInArrow(_shared(bands, rows, parts), f"{_SHARED}, {SCHEMA}")
    )
    drop_stage(met)
    free_driver(spark)
    pieces = members(shared.where("part IS NOT NULL"), ["piece", "owner", "doc"])
    pieces = stage(pieces.select("piece", "owner", "doc"))
    lines = stage(shared.where("cls IS NOT NULL").select(*_SHARED_NAMES))
    drop_stage(shared)
    free_driver(spark)
    tiles = distinct_tiles(stage(lines.select(F.explode("keys").alias("tile"), "cls").distinct()))
    classes = stage(
        lines.where("text IS NOT NULL").groupBy("cls").agg(
            F.max("n").alias("n"), F.max("sign").alias("sign"), F.min("text").alias("text")
        )
    )
    labels = settled(tiles, classes, classes.select("cls", "text"))
    stands = lines.select(F.col("cls").alias("piece"), "owner", "doc").distinct()
    told = stage(
        stands.join(labels, F.col("piece") == F.col("vertex"), "left").select(
            "piece", "owner", "doc", F.coalesce("component", "piece").alias("label")
        )
    )
    for done in (lines, classes):
        drop_stage(done)
    return _gone(pieces, "piece").unionByName(_gone(told, "label")), [pieces, told]


def passages(text: str, pieces: np.ndarray, keepers: np.ndarray) -> list[tuple[int, int, int, list[int]]]:
    """Runs of repeated words: first and last byte plus one, words, keepers."""
    block = Block([_bytes(text)])
    found, (whole, _) = block.found, block.windows()
    first = np.concatenate([np.arange(len(whole)), found.place])
    last = np.concatenate([first[: len(whole)] + MIN_WORDS, found.place + found.stop - found.start + WIDTH - 1])
    ids = np.concatenate([whole, found.ids])
    order = np.argsort(pieces)
    pieces, keepers = pieces[order], keepers[order]
    to = np.minimum(np.searchsorted(pieces, ids), len(pieces) - 1)
    at = np.flatnonzero(pieces[to] == ids)
    if not len(at):
        return []
    at = at[np.argsort(first[at], kind="stable")]
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    far = np.maximum.accumulate(last[at])
    cut = np.flatnonzero(np.append(True, first[at][1:] > far[:-1]))
    out = []
    for i, j in zip(cut, np.append(cut[1:], len(at)), strict=True):
        a, b = first[at[i]], far[j - 1]
        if b - a >= MIN_WORDS:
            out.append((int(starts[a]), int(ends[b - 1]), int(b - a), np.unique(keepers[to[at[i:j]]]).tolist()))
    return out


_SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("stop", T.LongType()),
            T.StructField("words", T.LongType()),
            T.StructField("kept_in", T.ArrayType(T.LongType())),
            T.StructField("passage", T.StringType()),
        ]
    )
)


_SPANS = pa.list_(
    pa.struct(
        [("start", pa.int64()), ("stop", pa.int64()), ("words", pa.int64()),
         ("kept_in", pa.list_(pa.int64())), ("passage", pa.string())]
    )
)


def _without_drops(kept: list[str]):
    """Documents with their ``_drops`` to what stays of them, few at once: the passages of a
    whole batch as Python objects would lie beside the batch and what is made of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, CUT_DOCUMENTS):
            texts, words, spans = [], [], []
            for text, drops in zip(part.column("text"), part.column("_drops"), strict=True):
                text, found = text.as_py(), []
                if text and drops.is_valid:
                    pairs = [drops.values.field(k).to_numpy() for k in ("piece", "keeper")]
                    text, found = _cut(text, *pairs)
                texts.append(text)
                words.append(sum(s["words"] for s in found))
                spans.append(found)
            made = {"text": pa.array(texts, pa.string())}
            columns = [made[c] if c in made else part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(words, pa.int64()), pa.array(spans, _SPANS)], [*kept, "removed_words", "spans"]
            )

    return run


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut from ``text``, ``removed_words``, and ``spans``: each
    with start and stop in code points, words, the documents that keep it and its text."""
    kept = [c for c in docs.columns if c not in ("spans", "removed_words")]
    docs = docs.select(*kept)
    pieces, staged = repeated_pieces(docs)
    drops = stage(
        pieces.groupBy(F.col("owner").alias("_owner")).agg(F.collect_set(F.struct("piece", "keeper")).alias("_drops"))
    )
    for done in staged:  # else all pieces would lie beside the texts that are shuffled next
        drop_stage(done)
    free_driver(docs.sparkSession)
    joined = docs.join(drops, _owner() == F.col("_owner"), "left")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("removed_words", T.LongType()), T.StructField("spans", _SPAN)]
    )

    return joined.select(*kept, "_drops").mapInArrow(_without_drops(kept), schema)


def _cut(text: str, pieces: np.ndarray, keepers: np.ndarray) -> tuple[str, list[dict]]:
    data, parts, spans, at = text.encode("utf-8", "replace"), [], [], 0
    for start, stop, words, kept_in in passages(text, pieces, keepers):
        before = len(data[:start].decode())
        passage = data[start:stop].decode()
        spans.append(
            {"start": before, "stop": before + len(passage), "words": words,
             "kept_in": [None if k == LAST_ID else k for k in kept_in], "passage": passage}
        )
        parts.append(data[at:start])
        at = stop
    parts.append(data[at:])
    return b"".join(parts).decode(), spans


def removed_passages(docs: DataFrame) -> DataFrame:
    """One row for every passage that was cut out."""
    cut = cut_repeats(docs.select("doc_id", "text")).where("removed_words > 0")
    return cut.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
