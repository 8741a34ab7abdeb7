"""Sentence splitting and sentence rules as column expressions: G0-G13.

The splitter runs in the JVM in time linear in the text: the text is cut at every
place where a sentence could end, each piece is described once, and a fold over
the pieces decides which cuts hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.text import WHITESPACE, strip

# A sentence is kept if its length lies strictly between these.
MIN_LENGTH = 20
MAX_LENGTH = 512

# Words before a full stop that do not end a sentence.
ABBREVIATIONS = tuple(
    """
    mrs. ms. mr. dr. gov. sr. rev. r.n. pres. treas. sect. maj. ph.d. proc. fr. asst.
    p.f.c. prof. admr. engr. mgr. supt. admin. assoc. voc. hon. m.d. dpty. sec. capt.
    c.e.o. c.f.o. c.i.o. c.o.o. c.p.a. c.n.a. acct. llc. inc. dir. esq. lt. d.d. ed.
    revd. psy.d. v.p. senr. gen. prov. cmdr. sgt. sen. col. lieut. cpl. pfc. k.p.h.
    cent. deg. doz. ft. fur. gal. gr. in. kg. km. kw. l. lat. lb. long. mg. m.p.h. cc.
    qr. qt. sq. t. vol. w. wt. u.s. u.n. p.j. st. d.c. jan. feb. mar. apr. may. jun.
    jul. aug. sep. oct. nov. dec.
    """.split()
)

# Fixed value: terminator, whitespace, then what can open a sentence.
_CANDIDATE = r'(?<=[.?!])(?=\s+[A-Z"\d+(])'

#: Fewest pieces folded between two flushes of the sentences found. Appending to an
#: array copies it, so a flat fold over a book would cost its length squared; blocks
#: as long as there are blocks keep the copying small.
_BLOCK = 32

#: A sentence is noted as one number: its first piece and how many it has.
_COUNT_BITS = 32


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _describe(piece: Column, i: Column, abbreviations: tuple[str, ...]) -> Column:
    """What the fold needs to know about one piece of text, in numbers only.

    Marks and whitespace are one byte each, so byte lengths do for counting them.
    """
    size = F.octet_length(piece)
    gap = F.when(i == 0, 0).otherwise(size - F.octet_length(F.ltrim(piece, F.lit(WHITESPACE))))
    word = F.substring_index(piece, " ", -1)
    initial = (F.octet_length(word) == 2) & word.between("A.", "Z.") & word.endswith(".")
    known = F.lower(word).isin(*abbreviations)
    # A word is protected if a space precedes it. At the very start of the text an
    # abbreviation also needs a character before that space.
    before = size - F.octet_length(word) - F.when((i == 0) & ~initial, 1).otherwise(0)
    opened = F.octet_length(F.replace(piece, F.lit(")"))) - F.octet_length(F.replace(piece, F.lit("(")))
    return F.struct(
        i.alias("i"),
        F.char_length(piece).alias("n"),
        gap.alias("gap"),
        opened.alias("open"),
        (size - F.octet_length(F.replace(piece, F.lit('"')))).alias("quotes"),
        (initial | known).alias("protected"),
        before.alias("before"),
    )


def _kept_length(n: Column) -> Column:
    return (n > MIN_LENGTH) & (n < MAX_LENGTH)


def _state(opened, quotes, fresh, first, length, out) -> Column:
    return F.struct(
        opened.alias("open"),
        quotes.alias("quotes"),
        fresh.alias("fresh"),
        first.alias("first"),
        length.alias("length"),
        out.alias("out"),
    )


def _carry(state: Column, out: Column) -> Column:
    return _state(*[state[f] for f in ("open", "quotes", "fresh", "first", "length")], out)


def _step(state: Column, piece: Column) -> Column:
    """Add one piece: either the sentence ends with it or the sentence goes on.

    ``first`` and ``length`` describe the open sentence; a fresh one starts with
    this piece and does not count the gap it was cut at.
    """
    fresh = state["fresh"]
    opened = state["open"] + piece["open"]
    quotes = state["quotes"] + piece["quotes"]
    gap = F.when(fresh, piece["gap"]).otherwise(0)
    first = F.when(fresh, piece["i"]).otherwise(state["first"])
    length = state["length"] + piece["n"] - gap
    ends = ~(piece["protected"] & (piece["before"] > gap)) & (opened == 0) & (quotes % 2 == 0)
    note = F.shiftleft(first.cast("bigint"), _COUNT_BITS) + (piece["i"] - first + 1)
    found = F.when(_kept_length(length - 1), F.concat(state["out"], F.array(note)))
    return F.when(
        ends, _state(opened, quotes, F.lit(True), first, F.lit(0), found.otherwise(state["out"]))
    ).otherwise(_state(opened, quotes, F.lit(False), first, length, state["out"]))


def split_sentences(text: Column, abbreviations: tuple[str, ...] = ABBREVIATIONS) -> Column:
    """The sentences of ``text``, trimmed, as an array.

    A cut needs a terminator followed by whitespace and an opening character
    (G1), no initial (G2) or abbreviation (G3) before it, and balanced brackets
    (G4) and quotes (G5) so far. Sentences of unfit length are lost (G6, G7); if
    nothing is left the last piece is returned alone (G8).
    """
    none = F.array().cast("array<bigint>")

    def fold(text: Column, pieces: Column, described: Column) -> Column:
        last = F.element_at(described, -1)
        # All pieces but the last, which ends the text and is no cut.
        cuts = F.size(described) - 1
        block = F.greatest(F.lit(_BLOCK), F.sqrt(cuts).cast("int"))
        blocks = F.transform(
            F.sequence(F.lit(1), F.greatest(cuts, F.lit(1)), block),
            lambda at: F.slice(described, at, F.least(block, F.greatest(cuts + 1 - at, F.lit(0)))),
        )
        start = _state(
            F.lit(0), F.lit(0), F.lit(False), F.lit(0), F.lit(0), F.array().cast("array<array<bigint>>")
        )

        def block_step(state: Column, block: Column) -> Column:
            return F.aggregate(
                block,
                _carry(state, none),
                _step,
                lambda done: _carry(done, F.concat(state["out"], F.array(done["out"]))),
            )

        def sentence(note: Column) -> Column:
            first = F.shiftright(note, _COUNT_BITS).cast("int")
            count = note.bitwiseAND(F.lit((1 << _COUNT_BITS) - 1)).cast("int")
            return strip(F.array_join(F.slice(pieces, first + 1, count), ""))

        def finish(state: Column) -> Column:
            gap = F.when(state["fresh"], last["gap"]).otherwise(0)
            tail_length = state["length"] + last["n"] - gap
            # The tail is the end of the text, however long it is.
            tail = strip(F.right(text, tail_length))
            out = F.transform(F.flatten(state["out"]), sentence)
            return _bind(
                out,
                lambda out: F.when(_kept_length(tail_length), F.concat(out, F.array(tail)))
                .when(F.size(out) == 0, F.array(tail))
                .otherwise(out),
            )

        return F.aggregate(blocks, start, block_step, finish)

    def with_pieces(text: Column, pieces: Column) -> Column:
        described = F.transform(pieces, lambda p, i: _describe(p, i, abbreviations))
        return _bind(described, lambda d: fold(text, pieces, d))

    return _bind(text, lambda t: _bind(F.split(t, _CANDIDATE), lambda p: with_pieces(t, p)))


# Sentences and articles dropped after splitting, and the marker
# cut from the front of a lead sentence.
SLIDE_SHOW = "View the slide show"
HOLLYWOOD = "NEW YORK (Hollywood Reporter)"
_QUOTED = r"""(?s)^(?:'.*'|".*")"""
_LEAD_MARK = r"(?d).*?Reuters -"


def keep_sentences(sentences: Column) -> Column:
    """Drop quotations, slide show notes and empty sentences."""
    return F.filter(
        sentences, lambda s: (s != "") & ~s.rlike(_QUOTED) & ~F.contains(s, F.lit(SLIDE_SHOW))
    )


def strip_lead_dateline(sentences: Column) -> Column:
    """Cut the agency marker from the first sentence."""
    return F.transform(
        sentences,
        lambda s, i: F.when(
            (i == 0) & s.rlike(r"(?d)\A.*?Reuters -"), F.regexp_replace(s, _LEAD_MARK, "")
        ).otherwise(s),
    )


def lead_sentence(sentences: Column) -> Column:
    """The first sentence on one line, trimmed."""
    return strip(F.translate(F.get(sentences, F.lit(0)), "\n\r", ""))
