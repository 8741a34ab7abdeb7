"""Token counts: pieces are counted once per distinct pre-token and joined to the
pre-token frequencies of the documents.

A pre-token here is a stretch that the tokenizer never joins across: what stands between
spaces or line ends, without a full stop or comma behind a letter. A task first gathers
frequencies for a batch of documents. What several of them share is counted there, once,
so a common word is never shuffled and no key is hot. The rest goes, as one row per
document and pre-token, to the task that owns the pre-token; its rows arrive sorted, so
each distinct one is counted once and joined to its run of rows without a table that could
outgrow the task. Each document then only adds up numbers: no ids are kept anywhere.

Cases: a null text counts as empty and has no tokens. Special strings in a text count as
the library counts them. Texts of any length are read whole; repeated rows are documents
of their own. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressmill.llm.common import shuffle_parts
from pressmill.session import prepare_workers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048
#: A pre-token in so many documents of a batch is counted where it was found.
SHARED = 2
#: Pre-tokens counted at once.
COUNTED = 8192
_STOP = re.compile(r"(?<=[a-z])(?=[.,][ \n])")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces(pretokens: list[str], path: str) -> np.ndarray:
    encode = _tokenizer(path).encode_batch_fast
    out = np.zeros(len(pretokens), dtype=np.int64)
    for k in range(0, len(pretokens), COUNTED):
        part = encode(pretokens[k : k + COUNTED], add_special_tokens=False)
        out[k : k + len(part)] = [len(x) for x in part]
    return out


def pretokens(text: str | None) -> Counter[str]:
    """Frequencies. Plain ASCII is folded as the tokenizer would, so that fewer differ."""
    text = text or ""
    if text.isascii() and "<|" not in text:
        text = _STOP.sub(" ", text.lower())
    found = Counter(text.replace("\n", " ").split(" "))
    found.pop("", None)
    return found


def _frequencies(path: str):
    """Batches of documents to rows: one for each document with what its shared
    pre-tokens add up to, one for each other pre-token with its frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers: dict[str, int] = {}
            size, word, times = [], array("q"), array("q")
            for text in batch.column("text"):
                found = pretokens(text.as_py())
                size.append(len(found))
                word.extend([numbers.setdefault(w, len(numbers)) for w in found])
                times.extend(found.values())
            doc = np.repeat(np.arange(len(size)), size)
            word, times = np.asarray(word), np.asarray(times)
            words = list(numbers)
            shared = np.bincount(word, minlength=len(words)) >= SHARED
            # Keys of documents start so too.
            shared |= np.fromiter((w.startswith("\0") for w in words), bool, len(words))
            each = np.zeros(len(words), dtype=np.int64)
            at = np.flatnonzero(shared)
            each[at] = pieces([words[i] for i in at], path)
            known = np.bincount(doc, times * each[word], len(size)).astype(np.int64)
            row, doc_id = batch.column("row"), batch.column("doc_id")
            n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            key = pc.binary_join_element_wise("\0", row.cast(pa.string()), "")
            yield _rows(key, row, doc_id, n_bytes, pa.array(known))
            rest = np.flatnonzero(~shared[word])
            names = pa.array(words, pa.string())
            for s in range(0, len(rest), 1 << 18):
                i = rest[s : s + (1 << 18)]
                none = [pa.nulls(len(i), doc_id.type), pa.nulls(len(i), pa.int64())]
                at, to = pa.array(word[i]), pa.array(doc[i])
                yield _rows(names.take(at), row.take(to), *none, pa.array(times[i]))

    return run


def _rows(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), ["key", "row", "doc_id", "n_bytes", "n"])


def _joined(path: str):
    """Rows sorted by key, with frequencies turned into tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, int] | None = None
        for batch in batches:
            coded = batch.column("key").dictionary_encode()
            words = coded.dictionary.to_pylist()
            each = np.ones(len(words), dtype=np.int64)
            at = [k for k, w in enumerate(words) if not w.startswith("\0")]
            if last and at and words[at[0]] == last[0]:
                each[at[0]] = last[1]
                at = at[1:]
            each[at] = pieces([words[k] for k in at], path)
            if words:
                last = (words[-1], int(each[-1]))
            n = batch.column("n").to_numpy() * each[coded.indices.to_numpy()]
            yield _rows(*batch.columns[:4], pa.array(n)).select(["row", "doc_id", "n_bytes", "n"])

    return run


def count_tokens(docs: DataFrame, path: str = WORD_BPE, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over ``limit`` tokens."""
    spark = docs.sparkSession
    prepare_workers(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = numbered.mapInArrow(
        _frequencies(path), f"key string, row long, doc_id {kind}, n_bytes long, n long"
    )
    owned = found.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key")
    return (
        owned.mapInArrow(_joined(path), f"row long, doc_id {kind}, n_bytes long, n long")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum("n").alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
