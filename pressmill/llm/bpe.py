"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a pre-token has one encoding, so it has one last token. A token that ends
at a prefix is that token exactly if it may follow the last token of the prefix before it.
An automaton gives, through its suffix links, all tokens that end at each place, and the
pair test says what may follow what; back-pointers then spell the ids. No merge is ever
carried out, and the time is linear in the text.

The pair test needs only merge ranks. Beside a seam stand the last sub-tokens of the left
token and the first sub-tokens of the right one, each living from its own merge until its
parent's. The seam gives way if some pair beside it has a merge while both live; of two
equal merges the left one comes first.

Texts are cut at the special strings, then before lone spaces and line ends: there the
pre-tokenizer always cuts. Such pieces repeat, so each worker keeps a bounded table of them.

Cases: a null text counts as empty and has no ids. A text of any length is encoded whole.
Every row gives one row, repeated ones too; an empty table gives an empty result. The added
columns replace columns of the same name; all others are kept as they are.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from pressmill.session import prepare_workers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: Entries that a worker's tables of pieces and pre-tokens hold before they start anew,
#: and the longest piece that goes into them.
CACHED, CACHED_CHARS = 250_000, 64
NEVER = 1 << 60


class PrefixEncoder:
    """Ids of a pre-token in the tokenizer's own alphabet."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]]):
        self.ranks = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(merges)}
        text = {i: t for t, i in vocab.items()}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for (a, b), k in self.ranks.items():
            self.halves.setdefault(vocab[text[a] + text[b]], (a, b, k))
        self.fits: dict[tuple[int, int], bool] = {}
        self.lengths = {}
        self.tokens = ahocorasick.Automaton()
        for i, t in text.items():
            if len(t) == 1 or i in self.halves and self._made_by_its_merge(i):
                self.tokens.add_word(t, i)
                self.lengths[i] = len(t)
        self.tokens.make_automaton()

    def _beside(self, token: int, half: int, until: int) -> list[tuple[int, int]]:
        """Sub-tokens at one edge, each with the rank of the merge that ends its life."""
        out = [(token, until)]
        while token in self.halves:
            parent = self.halves[token]
            token, until = parent[half], parent[2]
            out.append((token, until))
        return out

    def _seam_holds(self, left: int, right: int, until: int = NEVER) -> bool:
        for a, a_until in self._beside(left, 1, until):
            for b, b_until in self._beside(right, 0, until):
                rank = self.ranks.get((a, b), NEVER)
                if rank < a_until and rank <= b_until and rank < until:
                    return False
        return True

    def _made_by_its_merge(self, token: int) -> bool:
        a, b, rank = self.halves[token]
        return self._seam_holds(a, b, rank)

    def may_follow(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= CACHED:
                self.fits.clear()
            known = self.fits[left, right] = self._seam_holds(left, right)
        return known

    def encode(self, pretoken: str) -> list[int]:
        last = [-1] * (len(pretoken) + 1)
        lengths, fits = self.lengths, self.fits
        for end, token in self.tokens.iter(pretoken):
            end += 1
            if last[end] < 0:
                start = end - lengths[token]
                if start:
                    before = last[start]
                    ok = fits.get((before, token))
                    if ok is None:
                        ok = before >= 0 and self.may_follow(before, token)
                    if not ok:
                        continue
                last[end] = token
        ids, at = [], len(pretoken)
        while at:
            ids.append(last[at])
            at -= lengths[last[at]]
        ids.reverse()
        return ids


#: Blanks side by side, about which the pre-tokenizer looks at what follows.
_RUN = re.compile(r"\s\s|\n\Z")


#: The byte-level pre-tokenizer's pattern. Fixed value.
_PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: What libraries may class differently, as their Unicode versions do beyond the first Latin
#: blocks, and blank runs long enough for a matcher to give up on.
_BEYOND = re.compile(r"[^\x00-\u024f]|(?<!\s)\s{10000}")


class RankEncoder:
    """The same ids from the tokenizer library's merge loop, for callers that only need them.

    It takes ids for merge ranks, so they must rise as the merges do.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        made = [vocab[a + b] for a, b in merges]
        if made != sorted(made) or any(i > made[0] for t, i in vocab.items() if len(t) == 1):
            raise ValueError("ids don't follow the order of the merges")
        self.byte = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(self.byte[c] for c in t): i for t, i in vocab.items()}
        plain = tiktoken.Encoding("plain", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.of_text = plain.encode_ordinary
        whole = tiktoken.Encoding("whole", pat_str=_PRETOKEN, mergeable_ranks=ranks, special_tokens={})
        self.of_whole = whole.encode_ordinary

    def encode(self, pretoken: str) -> list[int]:
        return self.of_text(bytes(self.byte[c] for c in pretoken).decode())


class _Pieces(dict):
    """Piece behind a space, or with its line end before it, -> packed ids."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece: str) -> bytes:
        if piece[-1:] in (".", ",") and piece[:-1].isalpha():  # letters and others part
            ids = self[piece[:-1]] + self._encode(piece[-1])
        else:
            ids = self._encode(piece if piece[:1] == "\n" else f" {piece}")
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = ids
        return ids


class TextEncoder:
    """Whole texts to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, path: str, by_ranks: bool = False):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        model = described["model"]
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        kind = RankEncoder if by_ranks else PrefixEncoder
        self.merged = kind(model["vocab"], [tuple(m) for m in model["merges"]])
        self.of_text = getattr(self.merged, "of_text", self._of_letters)
        self.of_whole = getattr(self.merged, "of_whole", None)
        self.special = {x["content"]: x["id"] for x in described["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pretokens: dict[str, bytes] = {}
        self.pieces = _Pieces(self._piece)
        self.letters = _byte_letters()
        byte = {c: b for b, c in self.letters.items()}
        self.bytes = {i: bytes(byte[c] for c in t) for t, i in model["vocab"].items()}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}

    def _of_letters(self, text: str) -> list[int]:
        return self.merged.encode("".join([self.letters[b] for b in text.encode()]))

    def _piece(self, piece: str) -> bytes:
        bare = piece[1:] if piece[:1] == " " else piece
        if bare.isalpha():  # one pre-token
            return _packed(self.of_text(piece))
        out = []
        for pretoken, _ in self.split(piece):
            ids = self.pretokens.get(pretoken)
            if ids is None:
                ids = _packed(self.merged.encode(pretoken))
                if len(pretoken) <= CACHED_CHARS:
                    if len(self.pretokens) >= CACHED:
                        self.pretokens.clear()
                    self.pretokens[pretoken] = ids
            out.append(ids)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        if self.of_whole and not _BEYOND.search(text):
            return _packed(self.of_whole(text))
        if _RUN.search(text):
            if "  " in text or " \n" in text:
                return self._piece(text)
        else:
            text = text.replace("\n", " \n")
        first, *rest = text.split(" ")
        return self._piece(first) + b"".join(map(self.pieces.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(
            _packed([self.special[x]]) if x in self.special else self._plain(x)
            for x in self.cut.split(text)
            if x
        )

    def decode(self, packed: bytes) -> str:
        ids = array("I", packed)
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes in turn from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def text_encoder(path: str, by_ranks: bool = False) -> TextEncoder:
    """One for a worker process: its tables serve all tasks that run there."""
    return TextEncoder(path, by_ranks)


def _mapped(df: DataFrame, column: str, kind: T.DataType, function) -> DataFrame:
    """``df`` with ``column`` made by ``function(batch) -> values``, Arrow batch by batch."""
    prepare_workers(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name != column]
    schema = T.StructType([*kept, T.StructField(column, kind)])
    names = [f.name for f in kept]
    arrow = pa.large_binary() if isinstance(kind, T.BinaryType) else pa.large_string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(function(batch), arrow).cast(pa.binary() if arrow == pa.large_binary() else pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), made], [*names, column])

    return df.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str = BYTE_BPE, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``: packed little-endian unsigned 32-bit token ids of ``text``."""

    def run(batch: pa.RecordBatch) -> list[bytes]:
        encode = text_encoder(path).encode
        return [encode(x.as_py() or "") for x in batch.column(text)]

    return _mapped(docs, "ids", T.BinaryType(), run)


def decode_documents(df: DataFrame, path: str = BYTE_BPE, column: str = "decoded") -> DataFrame:
    """``df`` with the text that its packed ``ids`` stand for."""

    def run(batch: pa.RecordBatch) -> list[str]:
        decode = text_encoder(path).decode
        return [decode(x.as_py() or b"") for x in batch.column("ids")]

    return _mapped(df, column, T.StringType(), run)


def digests(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """Token number and digests of the ids and of the decoded text."""
    encoded = encode_documents(docs.select("doc_id", "text"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )
    return decode_documents(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
