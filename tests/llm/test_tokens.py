"""Token counts, encoding, decoding and packing against the library."""

import functools
import hashlib
import random
import zlib
from array import array
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pressmill.llm import bpe, packing, token_counts

ODD = [
    "  ", " ", "\n", "\t", "é", "日本", "a", "the", "'s", "<|endoftext|>", "12", "$$$", " ", "\x1c",
    "👍", "x" * 50, "İ", "ing", "\r\n", ".", ",", "\n\n", "THE", "ß", "²", "ａ",
]


@functools.lru_cache
def library(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("by_ranks", [False, True])
@given(st.one_of(st.lists(st.sampled_from(ODD), max_size=25).map("".join), st.text(max_size=60)))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_librarys(by_ranks, text):
    text = text.encode("utf-8", "ignore").decode()
    mine, theirs = bpe.text_encoder(bpe.BYTE_BPE, by_ranks), library_bytes()
    packed = mine.encode(text)
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert array("I", packed).tolist() == ids
    assert mine.decode(packed) == theirs.decode(ids, skip_special_tokens=False)


def library_bytes():
    return library(bpe.BYTE_BPE)


def test_long_pretokens_are_linear():
    e = bpe.text_encoder(bpe.BYTE_BPE)
    for text in ("ab" * 100_000, " " * 50_000 + "x", "é" * 30_000):
        assert e.decode(e.encode(text)) == text


def test_digests(frame, odd_rows):
    rows, lib = odd_rows, library_bytes()
    want = Counter()
    for doc_id, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
             hashlib.sha256(back.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(frame(rows)).collect())) == want


def test_encoding_keeps_other_columns(frame):
    df = bpe.decode_documents(bpe.encode_documents(frame([(1, "some text")])))
    row = df.first()
    assert row.decoded == "some text" and row.key == "k" and len(row.ids) == 8


def test_counts(frame, odd_rows):
    lib = library(token_counts.WORD_BPE)
    rng = random.Random(5)
    rows = odd_rows + [(i, "".join(rng.choice(ODD) for _ in range(40))) for i in range(100, 200)]
    want = Counter()
    for doc_id, text in rows:
        n = len(lib.encode(text or "", add_special_tokens=False).ids)
        want[doc_id, len((text or "").encode()), n, n > 2048] += 1
    assert Counter(map(tuple, token_counts.count_tokens(frame(rows)).collect())) == want


def test_empty(frame):
    none = frame([(1, "a")]).limit(0)
    assert token_counts.count_tokens(none).count() == 0
    assert bpe.digests(none).count() == packing.pack_documents(none).count() == 0


@given(st.sampled_from([7, 10, 64, 2048]), st.data())
@settings(max_examples=150, deadline=None)
def test_plan_places_every_piece(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(1, 60), max_size=40))
    sequences, placed = defaultdict(list), Counter()
    for r in packing.plan(counts, capacity):
        for k in range(r.high - r.low):
            sequences[r.sequence + k // r.each].append((r.offset + k % r.each * r.length, r.length))
            placed[r.length] += 1
    assert placed == Counter(counts)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in held) <= 2
    total = sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert len(sequences) >= max(large, -(-total // capacity))
    # Best fit of the small ones: all but one sequence that holds only those is over half full.
    light = [h for h in sequences.values() if 2 * sum(n for _, n in h) <= capacity and all(3 * n <= capacity for _, n in h)]
    assert len(light) <= 1


def test_packing(frame, odd_rows):
    rows, lib = odd_rows, library_bytes()
    want = Counter()
    for doc_id, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
        at, piece = 0, 0
        while at < len(ids):
            size = (len(ids) - at) % 2048 or 2048
            part = array("I", ids[at : at + size]).tobytes()
            want[doc_id, piece, at, size, zlib.crc32(part)] += 1
            at, piece = at + size, piece + 1
    found = packing.pack_documents(frame(rows)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) <= 1.1 * sum(r.length for r in found) / 2048 + 1


def test_whole_texts_of_the_first_latin_blocks():
    """Texts that go through the merge loop whole have the library's ids, others as well."""
    rng = random.Random(4)
    own, library = bpe.TextEncoder(bpe.BYTE_BPE, by_ranks=True), Tokenizer.from_file(bpe.BYTE_BPE)
    letters = [chr(k) for k in range(0x250)] + ["ɐ", "あ", " "]
    common = list("  \n\t'sdmtlvre09.,!a\u0085ª")
    texts = ["".join(rng.choice(common if rng.random() < 0.7 else letters) for _ in range(k % 40)) for k in range(3000)]
    texts += [" " * 9_999 + "x", " " * 20_000 + "x", "a" * 100_000, "<|endoftext|> a<|endoftext|>"]
    for text in texts:
        want = array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
        assert own.encode(text) == want, ascii(text[:40])
