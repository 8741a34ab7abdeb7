"""Exact dedup: a minimal perfect hash over the digests of an earlier crawl.

The index has one row for each historical digest, cut into parts by digest. Row ``at``
of a part holds two independent things: the slot ``at`` (the full digest that the
hash sends there, and its winner), and the pilot of bucket ``at``. A lookup takes the
pilot of its bucket, gets its slot from it and compares the digest there byte by byte.
A digest that is not in the history is sent to some slot too; the comparison finds out.

Both joins of a lookup are on hash values of distinct digests, so equal texts, however
many, meet in one row per task before anything is shuffled.

Cases: a null text counts as empty. Of equal texts the one with the most code points
stays, then the smallest doc_id, a null doc_id last; of rows that agree in all that, one.
An empty table gives an empty result. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm.common import BLANKS, id_rank, stage, text_or_empty

#: A prime; pilots times residues stay below 2**62.
PRIME = 2_147_483_647
#: Digests in a part of the index, about.
PART_KEYS = 4096

INDEX_SCHEMA = (
    "part long, at int, m int, pilot int, digest binary, "
    "best struct<chars:int,known:boolean,inverse:long,unread:long>, rows long"
)


def digests(docs: DataFrame, is_old: Column, carried: tuple[str, ...] = ()) -> DataFrame:
    """One narrow row per document; ``row`` tells rows apart that agree in everything."""
    text = text_or_empty()
    squeezed = F.translate(text, BLANKS, "")
    return docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.char_length(text).alias("chars"),
        F.unhex(F.sha2(squeezed, 256)).alias("digest"),
        F.coalesce(is_old, F.lit(False)).alias("old"),
        *carried,
    )


def grouped(rows: DataFrame) -> DataFrame:
    """Distinct digests with their winner and size."""
    rank = id_rank()
    best = F.struct(
        F.col("chars"),
        rank["col1"].alias("known"),
        rank["col2"].alias("inverse"),
        F.bitwise_not("row").alias("unread"),
    )
    return rows.groupBy("digest").agg(F.max(best).alias("best"), F.count("*").alias("rows"))


def _word(digest: Column, start: int) -> Column:
    """Four bytes of the digest as a residue of the prime."""
    number = F.conv(F.hex(F.substring(digest, start, 4)), 16, 10).cast("long")
    return F.pmod(number, F.lit(PRIME))


def _placed(groups: DataFrame, parts: int) -> DataFrame:
    digest = F.col("digest")
    return groups.withColumns(
        {
            "part": F.pmod(_word(digest, 1), F.lit(parts)),
            "_b": _word(digest, 5),
            "_x": _word(digest, 9),
            "_y": _word(digest, 13),
        }
    )


def perfect_hash(b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots per bucket and the slot of every key, a permutation of 0..m-1.

    Buckets are served from the fullest down: each takes the first pilot that sends its
    keys to free slots. A bucket of one key takes any free slot, written as -slot-1.
    """
    m = len(b)
    bucket = b % m
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(m + 1))
    sizes = np.diff(starts)
    pilots = np.zeros(m, dtype=np.int32)
    slots = np.zeros(m, dtype=np.int64)
    free = np.ones(m, dtype=bool)
    for k in np.argsort(-sizes, kind="stable"):
        if sizes[k] < 2:
            break
        keys = order[starts[k] : starts[k + 1]]
        pilot = 0
        while True:
            to = (x[keys] + pilot * y[keys]) % PRIME % m
            if free[to].all() and len(set(to.tolist())) == len(to):
                break
            pilot += 1
        pilots[k], slots[keys], free[to] = pilot, to, False
    alone = np.flatnonzero(sizes == 1)
    rest = np.flatnonzero(free)
    pilots[alone] = -rest - 1
    slots[order[starts[alone]]] = rest
    return pilots, slots


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    b, x, y = (keys[c].to_numpy(np.int64) for c in ("_b", "_x", "_y"))
    pilots, slots = perfect_hash(b, x, y)
    inverse = np.empty(len(keys), dtype=np.int64)
    inverse[slots] = np.arange(len(keys))
    out = keys.iloc[inverse][["part", "digest", "best", "rows"]].reset_index(drop=True)
    return out.assign(at=np.arange(len(keys)), m=len(keys), pilot=pilots)[
        ["part", "at", "m", "pilot", "digest", "best", "rows"]
    ]


def build_index(groups: DataFrame) -> tuple[DataFrame, int]:
    """Index of distinct digests and its number of parts. A part is one bounded group."""
    groups = stage(groups)
    parts = max(1, -(-groups.count() // PART_KEYS))
    built = _placed(groups, parts).groupBy("part").applyInPandas(_build, INDEX_SCHEMA)
    return stage(built), parts


def look_up(groups: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """``groups`` with the slot that holds their digest, null where none does."""
    pilots = index.select("part", F.col("at").cast("long").alias("_bucket"), "m", "pilot")
    slots = index.select("part", F.col("at").cast("long").alias("slot"), F.col("digest").alias("_held"))
    sizes = index.groupBy("part").agg(F.first("m").alias("_m"))
    found = (
        _placed(groups, parts)
        .join(sizes, "part", "left")
        .withColumn("_bucket", F.pmod("_b", "_m"))
        .join(pilots, ["part", "_bucket"], "left")
        .withColumn(
            "slot",
            F.when(F.col("pilot") < 0, -F.col("pilot").cast("long") - 1).otherwise(
                F.pmod(F.pmod(F.col("_x") + F.col("pilot") * F.col("_y"), F.lit(PRIME)), F.col("m"))
            ),
        )
        .join(slots, ["part", "slot"], "left")
    )
    hit = F.col("_held") == F.col("digest")
    return found.select(
        "digest",
        "best",
        "rows",
        F.when(hit, F.col("part")).alias("part"),
        F.when(hit, F.col("slot")).alias("slot"),
    )


def verdicts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Winner and size for each digest of two crawls, of which one is history.

    New groups that the index knows are merged into their slot; the others are groups of
    their own, found by the byte check.
    """
    index, parts = build_index(grouped(old))
    looked = stage(look_up(grouped(new), index, parts))
    repeats = looked.where("slot IS NOT NULL").select(
        "part", F.col("slot").cast("int").alias("at"), F.col("best").alias("_best"), F.col("rows").alias("_rows")
    )
    known = index.join(repeats, ["part", "at"], "left").select(
        "digest",
        F.greatest("best", F.coalesce("_best", "best")).alias("best"),
        (F.col("rows") + F.coalesce("_rows", F.lit(0))).alias("group_size"),
    )
    fresh = looked.where("slot IS NULL").select("digest", "best", F.col("rows").alias("group_size"))
    return known.unionByName(fresh)


def exact_dedup(
    docs: DataFrame, is_old: Column | None = None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Every document with the document that stays for it, and its columns ``carried``.

    ``is_old`` says of a row whether it belongs to the earlier crawl; without it half of
    the doc_ids, by hash, are taken as that crawl. The result is the same either way.
    """
    if is_old is None:
        is_old = F.xxhash64("doc_id") < 0
    rows = stage(digests(docs, is_old, carried))
    found = verdicts(rows.where("old"), rows.where("NOT old"))
    best = F.col("best")
    return rows.join(found, "digest").select(
        "doc_id",
        F.when(best["known"], F.bitwise_not(best["inverse"])).alias("keep_id"),
        "group_size",
        (F.col("row") == F.bitwise_not(best["unread"])).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *carried,
    )
