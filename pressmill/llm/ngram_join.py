"""N-gram Jaccard join: documents whose sets of word shingles agree by 80 % or more.

Equal sets are one class; what follows works on classes. A pair that reaches the threshold
shares a shingle among the rarest of either set (the first ``n - ceil(0.8 n) + 1`` in a
common order), so classes meet in tiles: such a shingle, and a band of set sizes. Sets
whose sizes rule each other out never share a tile's band; an odd band stands in two.

Inside a tile the signatures decide who is looked at. A signature is a bitmap in which
every shingle flips one bit; the number of bits in which two differ is at most the number
of shingles that only one has, which bounds the overlap from above. Pairs that pass are
settled by intersecting the sorted sets.

Only components are asked for, so a tile needs no pair inside a component:

1. every class is held against one hub of its tile, the class that shares most of its
   rare shingles; links give components. Repeated once with what is left.
2. in tiles that still hold several components, everything outside the largest one is
   held against all of the tile, block by block, and only what the signatures cannot
   rule out leaves the block.

The order comes from counts of all shingles of all documents in a fixed number of buckets,
rare ones first; any order is right, this one keeps tiles small. A map task sends one row
for a shingle however many of its documents have it, and rows of shingles that it saw
alone travel packed, so that the many that nobody shares cost little.

Cases: a text that is null or without words has the empty set and links with nothing; a
shorter text than five words is one shingle. Repeated rows and ids are documents of their
own; component_id is the least id that is not null. An empty table gives an empty result.
Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pressmill.llm.common import drop_stage, free_driver, numbered, shuffle_parts, stage
from pressmill.llm.components import components
from pressmill.llm.meeting import NAMES, SCHEMA, entries, members
from pressmill.llm.shingles import mixed, shingle_set
from pressmill.session import prepare_workers

#: Similarity in hundredths.
PERCENT = 80
#: Buckets of the shingle counts.
BUCKETS = 1 << 18
#: Documents of a map task that are looked at together, and classes in a block of a tile.
DOCUMENTS, BLOCK = 4096, 256
HUB_ROUNDS = 2
_SIGNED = np.int64


def agree(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the threshold, by exact intersection."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def signature(shingle: np.ndarray) -> bytes:
    """Parity bitmap of about two bits a shingle, a power of two wide."""
    width = 1 << max(6, (2 * len(shingle) - 1).bit_length())
    flips = np.bincount((shingle & np.uint64(width - 1)).astype(_SIGNED), minlength=width)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(signatures: list[bytes]) -> np.ndarray:
    """Signatures as rows of words, all folded to the narrowest."""
    width = min(map(len, signatures))
    out = np.empty((len(signatures), width // 8), dtype=np.uint64)
    for k, s in enumerate(signatures):
        words = np.frombuffer(s, dtype=np.uint64)
        out[k] = np.bitwise_xor.reduce(words.reshape(-1, width // 8), axis=0)
    return out


def may_agree(bits: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of sizes n and m whose signatures differ in ``bits`` can reach it."""
    most = np.minimum((n + m - bits) // 2, np.minimum(n, m))
    return 100 * most >= percent * (n + m - most)


def band(n: int, percent: int = PERCENT) -> int:
    """Sizes that can agree are in the same band or in neighbours."""
    return int(np.log(n) / np.log(100 / percent) + 1e-9)


def _class_id(shingle: np.ndarray) -> int:
    """64 bits for a set; 0 is the empty one."""
    if not len(shingle):
        return 0
    places = np.arange(1, len(shingle) + 1, dtype=np.uint64)
    seal = mixed(np.array([np.bitwise_xor.reduce(mixed(shingle + places)), len(shingle)], dtype=np.uint64))
    return int((seal[:1] * np.uint64(3) + seal[1:]).view(_SIGNED)[0]) or 1


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in batch.column("text"):
        yield shingle_set(text.as_py())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, DOCUMENTS):
            yield batch.slice(k, DOCUMENTS)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for part in _slices(batches):
        found = np.concatenate(list(_sets(part)))
        total += np.bincount((found >> np.uint64(46)).astype(_SIGNED), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "times"])


def _packed_counts(counts: pa.Table) -> pa.Table:
    columns = [pa.array([counts.column(c).to_numpy().tobytes()], pa.binary()) for c in ("bucket", "times")]
    return pa.table(columns, ["bucket", "times"])


def shingle_counts(docs: DataFrame) -> np.ndarray:
    """How many sets each bucket's shingles are in; ``BUCKETS`` numbers, whatever the input.
    The driver gets them packed: a row for each would cost it many times their size."""
    counts = (
        docs.select("text")
        .mapInArrow(_bucket_counts, "bucket long, times long")
        .groupBy("bucket")
        .agg(F.sum("times").alias("times"))
        .groupBy(F.shiftright("bucket", 12))
        .applyInArrow(_packed_counts, "bucket binary, times binary")
        .collect()
    )
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in counts:
        out[np.frombuffer(row["bucket"], np.int64)] = np.frombuffer(row["times"], np.int64)
    return out


def _described(parts: int, counts, kind: pa.DataType, row: pa.DataType):
    """Every document with its class, set size and signature, and entries of its rare
    shingles in each of its tiles."""
    told = ["doc_id", "row", "key", "key2", "cls", "n", "sign"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for part in _slices(batches):
            rows, seen, keys, owners = [], set(), [], []
            for found in _sets(part):
                cls = _class_id(found)
                rows.append((cls, len(found), signature(found) if cls else b""))
                if not cls or cls in seen:
                    continue
                seen.add(cls)
                rank = often[(found >> np.uint64(46)).astype(_SIGNED)]
                first = found[np.lexsort((found, rank))[: prefix_length(len(found))]]
                b = band(len(found))
                for tile in {b // 2, (b + 1) // 2}:
                    keys.append(mixed(first + np.uint64(tile)))
                    owners.append(np.full(len(first), cls, dtype=_SIGNED))
            ids, sizes, signs = zip(*rows, strict=True)
            none = [pa.nulls(len(rows), t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*map(part.column, told[:4]), pa.array(ids), pa.array(sizes), pa.array(signs, pa.binary()), *none],
                [*told, *NAMES],
            )
            if keys:
                for x in entries([np.concatenate(keys), np.concatenate(owners)], parts):
                    none = [pa.nulls(x.num_rows, t) for t in (kind, row, *[pa.int64()] * 4, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*none, *x.columns], [*told, *NAMES])

    return run


def described(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """One pass over the texts for what :func:`tiles` and the classes need."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts)  # BUCKETS numbers
    kinds = [docs.schema[c].dataType for c in ("doc_id", "row")]
    told = "doc_id {}, row {}".format(*(k.simpleString() for k in kinds))
    run = _described(shuffle_parts(spark), shared, *map(to_arrow_type, kinds))
    schema = f"{told}, key long, key2 long, cls long, n long, sign binary, {SCHEMA}"
    return stage(docs.select("doc_id", "row", "key", "key2", "text").mapInArrow(run, schema))


def tiles(found: DataFrame) -> DataFrame:
    """``tile, cls`` for every tile with at least two classes."""
    return distinct_tiles(stage(members(found, ["tile", "cls"]).select("tile", "cls").distinct()))


def distinct_tiles(met: DataFrame) -> DataFrame:
    # Documents that share a passage meet in many tiles; one of the same classes is enough.
    alike = met.groupBy("tile").agg(
        F.bit_xor("cls").alias("x"), F.bit_xor(F.xxhash64("cls")).alias("y"), F.count("*").alias("n")
    )
    one = alike.groupBy("x", "y", "n").agg(F.min("tile").alias("tile")).select("tile")
    return stage(met.join(one, "tile", "left_semi"))


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that reach the threshold: signatures first, then the sets."""
    told = classes.select("cls", "n", "sign")
    as_side = lambda x: told.select(*(F.col(c).alias(f"{c}_{x}") for c in told.columns))
    close = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    joined = (
        pairs.join(as_side("a"), F.col("a") == F.col("cls_a"))
        .join(as_side("b"), F.col("b") == F.col("cls_b"))
        .where(close)
        .select("a", "b", "n_a", "n_b", "sign_a", "sign_b")
    )
    passed = stage(joined.mapInArrow(_signed, "a long, b long"))
    text_of = lambda x: texts.select(F.col("cls").alias(f"cls_{x}"), F.col("text").alias(f"text_{x}"))
    return (
        passed.join(text_of("b"), F.col("b") == F.col("cls_b"))
        .select("a", "b", "text_b")
        .join(text_of("a"), F.col("a") == F.col("cls_a"))
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_exact, "a long, b long")
    )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        bits = []
        for x, y in zip(batch.column("sign_a").to_pylist(), batch.column("sign_b").to_pylist(), strict=True):
            u, v = folded([x, y])
            bits.append(int(np.bitwise_count(u ^ v).sum()))
        n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        keep = pa.array(may_agree(np.array(bits), n, m))
        yield batch.select(["a", "b"]).filter(keep)


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = zip(batch.column("text_a"), batch.column("text_b"), strict=True)
        keep = [agree(shingle_set(x.as_py()), shingle_set(y.as_py())) for x, y in texts]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _texts_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text for each class in ``wanted``, fetched by the key of one of its rows; rows that
    agree in id and text give one for each task that finds them."""
    some = classes.join(wanted.select("cls").distinct(), "cls", "left_semi").select("cls", "rep.key", "rep.key2")
    found = docs.select("key", "key2", "text").join(some, ["key", "key2"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keep = []
            for cls in batch.column("cls").to_pylist():
                keep.append(cls not in seen)
                seen.add(cls)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return stage(found.select("cls", "text").mapInArrow(once, "cls long, text string"))


def _labelled(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Tile members with their component, of tiles that hold several."""
    told = met.select("tile", "cls").join(labels, F.col("cls") == F.col("vertex"), "left").select(
        "tile", "cls", F.coalesce("component", "cls").alias("label")
    )
    several = (
        told.groupBy("tile")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
    )
    return stage(told.join(several.select("tile"), "tile", "left_semi"))


def _hub_pairs(met: DataFrame, turn: int) -> DataFrame:
    """Every class with the hub of its tile, if that is of another component. First the
    hub is the class that meets most others, later any other one."""
    shared = met.groupBy("cls").agg(F.count("*").alias("shared"))
    rank = F.col("shared") if turn == 0 else F.xxhash64("cls", "tile", F.lit(turn))
    ranked = met.join(shared, "cls").groupBy("tile").agg(
        F.max(F.struct(rank.alias("rank"), "cls", "label")).alias("hub")
    )
    return (
        met.join(ranked, "tile")
        .where(F.col("label") != F.col("hub.label"))
        .select(F.col("cls").alias("a"), F.col("hub.cls").alias("b"))
        .distinct()
    )


def _block_pairs(met: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs across components that the signatures allow, found block by block.

    Of a tile's classes those outside its most frequent component are the minority. Its
    blocks meet all blocks of the tile.
    """
    sizes = met.groupBy("tile", "label").count()
    main = sizes.groupBy("tile").agg(F.max(F.struct("count", "label"))["label"].alias("main"))
    rows = met.join(main, "tile").withColumn("minor", F.col("label") != F.col("main"))
    placed = stage(numbered(rows, ["tile", "minor"], [F.col("cls")], "_at").withColumn(
        "block", F.floor(F.col("_at") / BLOCK)
    ))
    blocks = placed.groupBy("tile").agg(
        (F.max(F.when(F.col("minor"), F.col("block"))) + 1).alias("minor_blocks"),
        F.coalesce(F.max(F.when(~F.col("minor"), F.col("block"))) + 1, F.lit(0)).alias("main_blocks"),
    )
    rows = placed.join(blocks, "tile").join(classes.select("cls", "n", "sign"), "cls")
    minor_ids = F.sequence(F.lit(0), F.col("minor_blocks") - 1)
    # As a left side: each minor block once for every block of the tile.
    own = F.when(F.col("minor"), F.col("block")).otherwise(F.col("minor_blocks") + F.col("block"))
    all_ids = F.sequence(F.lit(0), F.col("minor_blocks") + F.col("main_blocks") - 1)
    left = rows.where("minor").select("*", F.col("block").alias("i"), F.explode(all_ids).alias("j"), F.lit(0).alias("side"))
    right = rows.select("*", F.explode(minor_ids).alias("i"), own.alias("j"), F.lit(1).alias("side"))
    cells = left.unionByName(right).where("j >= i")  # two minor blocks meet once
    dealt = (
        cells.select("tile", "i", "j", "side", "cls", "label", "n", "sign")
        .repartition(shuffle_parts(met.sparkSession), "tile", "i", "j")
        .sortWithinPartitions("tile", "i", "j")
    )
    return dealt.mapInPandas(_cells, "a long, b long").distinct()


def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of every cell. The last cell of a frame may go on in the next."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        keys = frame[["tile", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        rest = frame.iloc[starts[-1] :]
        yield _pairs(_cell(frame.iloc[a:b]) for a, b in zip(starts, starts[1:], strict=False))
    if rest is not None:
        yield _pairs([_cell(rest)])


def _pairs(found) -> pd.DataFrame:
    rows = [x for x in found if len(x)]
    rows = np.concatenate(rows) if rows else np.zeros((0, 2), dtype=_SIGNED)
    return pd.DataFrame({"a": rows.min(axis=1), "b": rows.max(axis=1)})


def _cell(cell: pd.DataFrame) -> np.ndarray:
    """Pairs of different components that sizes and signatures allow."""
    cls, label, n, side = (cell[c].to_numpy() for c in ("cls", "label", "n", "side"))
    other = np.flatnonzero(side == 1)
    signs, pairs = None, []
    for k in np.flatnonzero(side == 0):
        m = n[other]
        near = other[
            (label[other] != label[k])
            & (100 * np.minimum(m, n[k]) >= PERCENT * np.maximum(m, n[k]))
        ]
        if len(near):
            signs = folded(list(cell["sign"])) if signs is None else signs
            bits = np.bitwise_count(signs[near] ^ signs[k]).sum(axis=1, dtype=_SIGNED)
            near = near[may_agree(bits, n[near], n[k])]
            pairs.append(np.stack([np.full(len(near), cls[k]), cls[near]], axis=1))
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), dtype=_SIGNED)


def settled(met: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Components of the classes that meet in tiles, ``vertex, component``: of ``met (tile,
    cls)``, ``classes (cls, n, sign)`` and ``texts (cls, text)``. No pair of a tile is lost."""
    spark = met.sparkSession
    # Made by Spark alone: local rows of Python would start workers that stay beside the others.
    labels = spark.range(0).select(F.col("id").alias("vertex"), F.col("id").alias("component"))
    tried = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    for k in range(HUB_ROUNDS + 1):
        met = _labelled(met, labels)
        if met.isEmpty():
            break
        pairs = _hub_pairs(met, k) if k < HUB_ROUNDS else _block_pairs(met, classes)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = stage(pairs.join(tried, ["a", "b"], "left_anti"))
        tried = tried.unionByName(pairs)
        # The links so far are told by their components.
        links = labels.toDF("u", "v").unionByName(_verified(texts, classes, pairs).toDF("u", "v"))
        labels = components(links)
        free_driver(spark)
    return labels


def linked_components(docs: DataFrame, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with their class and ``row``, and the component of every class but each
    least one."""
    prepare_workers(docs.sparkSession)
    row = F.lit(None).cast("long") if row is None else row
    told_apart = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text")]
    docs = docs.select(
        "doc_id", "text", row.alias("row"),
        F.xxhash64(*told_apart).alias("key"), F.xxhash64(F.lit("second"), *told_apart).alias("key2"),
    )
    found = described(docs, shingle_counts(docs))
    met = tiles(found.where("cls IS NULL"))
    told = stage(found.where("cls IS NOT NULL").select("doc_id", "row", "key", "key2", "cls", "n", "sign"))
    drop_stage(found)  # what is left of the packed entries stands in ``met``
    classes = stage(
        told.where("n > 0").groupBy("cls").agg(
            F.min(F.struct("key", "key2")).alias("rep"), F.max("n").alias("n"), F.max("sign").alias("sign")
        )
    )
    texts = _texts_of(docs, classes, met)
    return told.select("doc_id", "row", "cls", "n"), settled(met, classes, texts)


def ngram_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    classed, labels = linked_components(docs)
    told = classed.join(labels, F.col("cls") == F.col("vertex"), "left").select(
        "doc_id", "n", F.coalesce("component", "cls").alias("label")
    )
    least = told.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return told.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, row: Column) -> DataFrame:
    """``row`` of one document of each component that has words: that with the least id, a
    null id last, and the least ``row``."""
    classed, labels = linked_components(docs, row)
    told = classed.where("n > 0").join(labels, F.col("cls") == F.col("vertex"), "left")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    return told.groupBy(F.coalesce("component", "cls").alias("label")).agg(first.alias("row")).select("row")
