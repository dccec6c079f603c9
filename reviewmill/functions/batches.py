"""Text steps over Arrow batches: plain string work per text, where column expressions go character by character.

The functions travel with the plan, so executors need pyarrow but not this package.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Collection, Iterator, Sequence
from functools import reduce
from itertools import compress, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts are taken from a batch in groups of this many, so a task holds few of them as Python strings.
GROUP = 256

# Texts that are worked on as bytes are taken in blocks of about this size: small enough for memory, large enough for a pattern.
BLOCK_BYTES = 1 << 20

# Up to this many characters in all, words are looked for by one regular expression (an automaton in Arrow).
PATTERN_CHARS = 10_000

# Unicode white space without the blank; U+001C to U+001F count as such.
WHITE = r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN_BLANKS = f"(?:[{WHITE}]| [ {WHITE}])[ {WHITE}]*"
MARK = "\x01"

# Letters whose lower case Arrow may build otherwise than Python: beyond extended Latin, and U+0130. Punctuation and ideographs have none.
OTHER_LETTERS = r"[^\x00-\x{12f}\x{131}-\x{24f}\x{2000}-\x{20ff}\x{3000}-\x{9fff}]"

NEAR = ("bare", "back1", "back2", "back3", "next1", "next2")
HIT = pa.struct(
    [("at", pa.int32()), *[(name, pa.string()) for name in NEAR], ("value", pa.float64()), ("known3", pa.bool_()), ("next_known", pa.bool_())]
)


def readable(column: pa.Array) -> pa.Array:
    """The column with U+FFFD for bytes that are no UTF-8, as in the JVM."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        raw = column.cast(pa.binary(), safe=False).to_pylist()
        return pa.array([None if r is None else r.decode("utf-8", "replace") for r in raw], pa.string())


def groups(column: pa.Array) -> Iterator[pa.Array]:
    for start in range(0, len(column), GROUP):
        yield column.slice(start, GROUP)


def blocks(column: pa.Array, *others: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """The same rows of all columns, at least one and about ``BLOCK_BYTES`` of ``column`` at a time."""
    ends = bytes_of(column)[1]
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + BLOCK_BYTES, "right")) - 1)
        yield tuple(c.slice(start, stop - start) for c in (column, *others))
        start = stop


def in_lower_case(column: pa.Array) -> pa.Array:
    """Lower case as Python has it; only texts in other scripts are taken from Arrow for it."""
    plain = pc.string_is_ascii(column)
    if not plain.false_count:
        return pc.ascii_lower(column)
    others = pc.invert(plain).fill_null(False)
    others = pc.replace_with_mask(others, others, pc.match_substring_regex(column.filter(others), OTHER_LETTERS))
    lowered = pc.utf8_lower(column)
    if not others.true_count:
        return lowered
    return pc.replace_with_mask(lowered, others, pa.array([text.lower() for text in column.filter(others).to_pylist()], pa.string()))


def _collapsed(column: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.replace_substring_regex(column, UNEVEN_BLANKS, " "), " ")


def collapse_blanks() -> Callable[[Column], Column]:
    """Runs of white space to one blank, none at the ends."""
    return arrow_udf(lambda column: _collapsed(readable(column)), "string")


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, one behind the other, and where each begins, with the end of the last one."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _count_of(mark: str, column: pa.Array) -> pa.Array:
    """How often the ASCII character ``mark`` stands in a text."""
    numbers = [np.zeros(0, np.int64)]
    for (block,) in blocks(column):
        data, bounds = bytes_of(block)
        numbers.append(np.diff(np.searchsorted(np.flatnonzero(data == ord(mark)), bounds)))
    return pa.array(np.concatenate(numbers), pa.int32(), mask=column.is_null().to_numpy(zero_copy_only=False))


def _word_counts(cleaned: pa.Array) -> pa.Array:
    return pc.if_else(pc.equal(cleaned, ""), pa.scalar(0, pa.int32()), pc.add(_count_of(" ", cleaned), pa.scalar(1, pa.int32())))


def _holds(texts: pa.Array, words: Sequence[str]) -> pa.Array:
    """Whether a text holds one of ``words``; false for null."""
    if sum(map(len, words)) <= PATTERN_CHARS:
        return pc.match_substring_regex(texts, "|".join(map(re.escape, words))).fill_null(False)
    return pa.array([t is not None and any(w in t for w in words) for g in groups(texts) for t in g.to_pylist()], pa.bool_())


def _first_of(texts: pa.Array, lists: Sequence[Sequence[str]]) -> pa.Array:
    """The place of the first list with a word inside the text, null where there is none.

    One pattern of all words goes first, so that a text without any is read once; a text leaves with its list.
    """
    first = pa.nulls(len(texts), pa.int32())
    left = None
    words = [word for some in lists for word in some]
    if len(lists) > 1 and sum(map(len, words)) <= PATTERN_CHARS:
        left = _holds(texts, words)
        texts = texts.filter(left)
    for place, some in enumerate(lists):
        if not some or not len(texts):
            continue
        hit = _holds(texts, some)
        found = pc.if_else(hit, pa.scalar(place, pa.int32()), pa.scalar(None, pa.int32()))
        if left is None:
            first, left = found, pc.invert(hit)
        else:
            first = pc.replace_with_mask(first, left, found)
            left = pc.replace_with_mask(left, left, pc.invert(hit))
        texts = texts.filter(pc.invert(hit))
    return first


def _categories(lowered: pa.Array, keywords: Sequence[tuple[str, Sequence[str]]]) -> pa.Array:
    first = _first_of(lowered, [words for _, words in keywords])
    return pa.array([category for category, _ in keywords], pa.string()).take(first).fill_null("none")


def first_category(keywords: Sequence[tuple[str, Sequence[str]]]) -> Callable[[Column], Column]:
    """The first category with a keyword inside the text, "none" for a text without any and for null."""
    def tagged(column: pa.Array) -> pa.Array:
        return _categories(readable(column), keywords)

    return arrow_udf(tagged, "string")


def words_and_category(keywords: Sequence[tuple[str, Sequence[str]]]) -> Callable[[Column], Column]:
    """(words, category) of a cleaned text: its blank-separated words, and the first category in its lower-case form."""
    def facts(column: pa.Array) -> pa.Array:
        column = readable(column)
        return pa.StructArray.from_arrays([_word_counts(column), _categories(in_lower_case(column), keywords)], names=["words", "category"])

    return arrow_udf(facts, "words int, category string")


def bounds(text: str, place: int) -> tuple[int, int]:
    """Where the word at the character ``place`` begins and ends."""
    begin, end = text.rfind(" ", 0, place) + 1, text.find(" ", place)
    return begin, len(text) if end < 0 else end


def first_but(lowered: str, punctuation: str) -> int | None:
    """The place of the first word "but"."""
    place = lowered.find("but")
    while place >= 0:
        begin, end = bounds(lowered, place)
        if lowered[begin:end].strip(punctuation) == "but":
            return lowered.count(" ", 0, begin)
        place = lowered.find("but", end)
    return None


def _bare(words: pa.Array, punctuation: str) -> pa.Array:
    """Words without outer punctuation, unless at most two characters would be left."""
    stripped = pc.utf8_trim(words, punctuation)
    return pc.if_else(pc.less_equal(pc.utf8_length(stripped), 2), words, stripped)


def _word_bounds(blanks: np.ndarray, first: np.ndarray, bounds: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[list[int], list[int]]:
    """Where the words numbered ``at`` of the texts ``text`` begin and end in the bytes of a block; both 0 beyond the ends of a text.

    ``blanks`` are the places of the blanks of the block and one more number, ``first`` tells how many of them stand before each text.
    """
    here = (at >= 0) & (at <= first[text + 1] - first[text])
    place = np.where(here, first[text] + at, 0)
    begin = np.where(at > 0, blanks[place - 1] + 1, bounds[text])
    end = np.where(at < first[text + 1] - first[text], blanks[place], bounds[text + 1])
    return np.where(here, begin, 0).tolist(), np.where(here, end, 0).tolist()


def _lexicon_finder(
    values: dict[str, float], known: Sequence[str], punctuation: str, both: Sequence[str]
) -> tuple[Callable[[pa.Array, pa.Array], list[pa.Array]], list[str], str]:
    """What ``lexicon_words`` does with texts and their lower-case forms, with the names and types of its columns.

    Lower case adds and takes no blank, so a word has the same number in a text and in its lower-case form: it is
    looked up by its place there and cut out of the text by its number, from the bytes of a block of texts.
    """
    short = frozenset(t for t in values if len(t.strip(punctuation)) <= 2)
    # Other terms stand in a text without outer punctuation, and no word holds a blank.
    long = frozenset(t for t in values if t not in short and t == t.strip(punctuation) and " " not in t)
    listed = pa.array(sorted(known), pa.string())
    # A mark goes before whatever may begin a term; the words so marked are then looked up.
    pattern = None
    looked_for = long | {"but"}
    if long and "" not in short and sum(map(len, values)) <= PATTERN_CHARS:
        outer = "".join("\\" + c for c in punctuation)
        # The longest first, so that few of the marked words are only longer than a term.
        pattern = f"(^|[ {outer}])(" + "|".join(re.escape(t) for t in sorted(looked_for, key=lambda t: (-len(t), t))) + ")"
        # Emoticons anywhere; what they take of a word does not matter, since the whole word is looked up.
        emoticons = [re.escape(t) for t in sorted(short) if " " not in t]
        pattern += f"|({'|'.join(emoticons)})" if emoticons else "|(" + re.escape(MARK) + ")"

    def numbers_of_all(lowered: pa.Array, first: np.ndarray) -> Iterator[int]:
        """Text by text the places of words that are terms or "but", as numbers in the block."""
        for i, low in enumerate(lowered.to_pylist()):
            words = [] if low is None else low.split(" ")
            bare = map(str.strip, words, repeat(punctuation))
            hits = {*compress(count(), map(looked_for.__contains__, bare)), *compress(count(), map(short.__contains__, words))}
            yield from (int(first[i]) + i + at for at in sorted(hits))

    def find(texts: pa.Array, lowered: pa.Array) -> list[pa.Array]:
        counts, ats, worths, buts = [], [], [], []
        near: list[list[bytes]] = [[] for _ in NEAR]
        missing = texts.is_null().to_numpy(zero_copy_only=False)
        for low_case, block in blocks(lowered, texts):
            data, bounds = bytes_of(block.fill_null(""))
            low_data, low_bounds = bytes_of(low_case.fill_null(""))
            written, low = data.tobytes(), low_data.tobytes()
            low_blanks = np.append(np.flatnonzero(low_data == ord(" ")), len(low_data))
            first = np.searchsorted(low_blanks, low_bounds)
            if pattern and MARK.encode() not in low:
                marked = bytes_of(pc.replace_substring_regex(low_case.fill_null(""), pattern, rf"\1{MARK}\2\3"))[0]
                spots = np.flatnonzero(marked == ord(MARK))
                spots -= np.arange(len(spots))
                numbers = np.unique(np.searchsorted(low_blanks, spots) + np.searchsorted(low_bounds, spots, "right") - 1)
            else:
                numbers = np.fromiter(numbers_of_all(low_case, first), np.int64)
            text = np.searchsorted(first[:-1] + np.arange(len(block)), numbers, "right") - 1
            at = numbers - first[text] - text
            words = [low[b:e].decode() for b, e in zip(*_word_bounds(low_blanks, first, low_bounds, text, at))]
            terms = [word if word in short else word.strip(punctuation) for word in words]
            is_but = np.fromiter((word.strip(punctuation) == "but" for word in words), bool, len(words))
            kept = np.fromiter((term in long or term in short and term == word for term, word in zip(terms, words)), bool, len(words))
            first_but = np.full(len(block), -1)
            first_but[text[is_but][::-1]] = at[is_but][::-1]
            text, at = text[kept], at[kept]
            worths += [values[term] for term in compress(terms, kept)]
            same = len(data) == len(low_data) and bool((data[low_blanks[:-1]] == ord(" ")).all())
            blanks = low_blanks if same else np.append(np.flatnonzero(data == ord(" ")), len(data))
            for words, step in zip(near, (0, -1, -2, -3, 1, 2)):
                words += [written[b:e] for b, e in zip(*_word_bounds(blanks, first, bounds, text, at + step))]
            counts.append(np.bincount(text, minlength=len(block)))
            ats.append(at)
            buts.append(np.where(counts[-1] > 0, first_but, -1))
        bare = [_bare(pa.array(words, pa.binary()).cast(pa.string()), punctuation) for words in near]
        low_bare = [in_lower_case(words) for words in bare]
        known3, next_known = (pc.is_in(low_bare[i], listed) for i in (3, 4))
        counts, ats, buts = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (counts, ats, buts))
        rows = pa.StructArray.from_arrays([pa.array(ats, pa.int32()), *bare, pa.array(worths, pa.float64()), known3, next_known], fields=list(HIT))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), rows)
        # Whether a text mixes capitals matters where a hit or a word before it has one.
        capital = reduce(pc.or_, [pc.not_equal(words, low) for words, low in zip(bare[:4], low_bare)]).to_numpy(zero_copy_only=False)
        asked = np.zeros(len(texts), bool)
        asked[np.repeat(np.arange(len(texts)), counts)[capital]] = True
        asked = pa.array(asked)
        mixes = reduce(pc.and_, [pc.match_substring_regex(texts.filter(asked), part) for part in both])
        mixed = pc.replace_with_mask(pa.array(np.zeros(len(texts), bool), mask=missing), asked, mixes)
        return [lists, pa.array(buts, pa.int32(), mask=buts < 0), _count_of("!", texts), _count_of("?", texts), mixed]

    words = ", ".join(f"{name}: string" for name in NEAR)
    kind = f"hits array<struct<at: int, {words}, value: double, known3: boolean, next_known: boolean>>, but_at int, bangs int, marks int, mixed boolean"
    return find, ["hits", "but_at", "bangs", "marks", "mixed"], kind


def lexicon_words(
    values: dict[str, float], known: Sequence[str], punctuation: str, both: Sequence[str]
) -> Callable[[Column], Column]:
    """(hits, but_at, bangs, marks, mixed) of a text: its words that are terms of ``values`` with the words around them,
    the numbers of exclamation and question marks and, for texts with hits, the place of the first "but" and whether all patterns of
    ``both`` match, told where a hit or one of the three words before it has a capital.

    Words are separated by blanks and compared in lower case without outer punctuation; a term that is at most two
    characters long without punctuation (an emoticon) must be a word as it is written. A hit tells whether the word
    three words before and the next word are in ``known``.
    """
    find, names, kind = _lexicon_finder(values, known, punctuation, both)

    def found(column: pa.Array) -> pa.Array:
        column = readable(column)
        return pa.StructArray.from_arrays(find(column, in_lower_case(column)), names=names)

    return arrow_udf(found, kind)


def text_facts(
    keywords: Sequence[tuple[str, Sequence[str]]], values: dict[str, float], known: Sequence[str], punctuation: str, both: Sequence[str]
) -> Callable[[Column], Column]:
    """``collapse_blanks``, and the code points, ``words_and_category`` and ``lexicon_words`` of its result, in one pass over the texts.

    The field "text" is null where a text is the same without uneven blanks, so that only changed texts travel back.
    """
    find, names, kind = _lexicon_finder(values, known, punctuation, both)

    def facts(column: pa.Array) -> pa.Array:
        cleaned = _collapsed(readable(column))
        lowered = in_lower_case(cleaned)
        text = pc.if_else(pc.equal(column, cleaned), pa.scalar(None, cleaned.type), cleaned)
        columns = [text, pc.utf8_length(cleaned), _word_counts(cleaned), _categories(lowered, keywords), *find(cleaned, lowered)]
        return pa.StructArray.from_arrays(columns, names=["text", "length", "words", "category", *names])

    return arrow_udf(facts, f"text string, length int, words int, category string, {kind}")


def word_places(punctuation: str, wanted: Collection[str] | None = None) -> Callable[[Column], Column]:
    """(at, term) of the blank-separated words of a text: the place, and the word in lower case without outer punctuation,
    unless at most two characters would be left. With ``wanted`` only of these terms, each with the words of ``NEAR``."""
    kept = None if wanted is None else pa.array(sorted(wanted), pa.string())
    fields = [("at", pa.int32()), ("term", pa.string())] + ([] if wanted is None else [(name, pa.string()) for name in NEAR])
    kind = pa.struct(fields)

    def of(texts: pa.Array) -> pa.Array:
        lists = pc.split_pattern(texts, " ")
        words = lists.flatten()
        bare = _bare(words, punctuation)
        latin = pc.match_substring_regex(texts, OTHER_LETTERS).true_count == 0
        terms = pc.utf8_lower(bare) if latin else in_lower_case(bare)
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = np.arange(len(words))
        places = at - np.repeat(ends[:-1], np.diff(ends))
        columns = []
        if kept is not None:
            at = np.flatnonzero(pc.is_in(terms, kept).to_numpy(zero_copy_only=False))
            begin, end = (np.repeat(bound, np.diff(ends))[at] for bound in (ends[:-1], ends[1:]))
            for step in (0, -1, -2, -3, 1, 2):
                there = (at + step >= begin) & (at + step < end)
                columns.append(bare.take(pa.array(at + step, mask=~there)).fill_null(""))
            terms, places, ends = terms.take(pa.array(at)), places[at], np.searchsorted(at, ends)
        rows = pa.StructArray.from_arrays([pa.array(places, pa.int32()), terms, *columns], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    def placed(column: pa.Array) -> pa.Array:
        parts = [of(group) for group in groups(readable(column))]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(kind))

    return arrow_udf(placed, "array<struct<" + ", ".join(f"{name}: {'int' if name == 'at' else 'string'}" for name, _ in fields) + ">>")


def marks_of(punctuation: str, both: Sequence[str]) -> Callable[[Column], Column]:
    """(but_at, bangs, marks, mixed) of a text, as in ``lexicon_words``; but_at of every text."""
    def counted(column: pa.Array) -> pa.Array:
        column = readable(column)
        buts, bangs, asks = [], [], []
        for group in groups(column):
            for text, low in zip(group.to_pylist(), in_lower_case(group).to_pylist()):
                buts.append(None if low is None else first_but(low, punctuation))
                bangs.append(None if text is None else text.count("!"))
                asks.append(None if text is None else text.count("?"))
        counts = [pa.array(numbers, pa.int32()) for numbers in (buts, bangs, asks)]
        mixed = reduce(pc.and_, [pc.match_substring_regex(column, part) for part in both])
        return pa.StructArray.from_arrays([*counts, mixed], names=["but_at", "bangs", "marks", "mixed"])

    return arrow_udf(counted, "but_at int, bangs int, marks int, mixed boolean")


def first_listed(lists: Sequence[tuple[int, str, Sequence[str]]]) -> Callable[[Column], Column]:
    """(place, category) of the first of ``lists``, given in order, with a keyword inside the text."""
    kind = pa.struct([("place", pa.int32()), ("category", pa.string())])

    def tagged(column: pa.Array) -> pa.Array:
        first = _first_of(readable(column), [words for _, _, words in lists])
        return pa.array([{"place": place, "category": category} for place, category, _ in lists], kind).take(first)

    return arrow_udf(tagged, "place int, category string")


def _grams(text: str, sizes: Sequence[int]) -> set[str]:
    found: set[str] = set()
    for size in sizes:
        found.update(map("".join, zip(*[text[i:] for i in range(size)])) if size > 1 else text)
    return found


def distinct_grams(sizes: Sequence[int], wanted: Collection[str] | None = None) -> Callable[[Column], Column]:
    """The distinct grams of the given sizes of a text, or those of them that are ``wanted``."""
    sizes = sorted(set(sizes))
    kept = None if wanted is None else frozenset(wanted)

    def grams(column: pa.Array) -> pa.Array:
        def of(text: str | None) -> list[str] | None:
            if text is None:
                return None
            found = _grams(text, sizes)
            return list(found if kept is None else found & kept)

        parts = [pa.array(list(map(of, group.to_pylist())), pa.list_(pa.string())) for group in groups(readable(column))]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return arrow_udf(grams, "array<string>")


def first_filed(filed: dict[str, list[tuple[int, str, str]]]) -> Callable[[Column], Column]:
    """(place, category) of the first keyword inside a text; ``filed`` has (place, category, keyword) under one gram of each keyword."""
    sizes = sorted({len(gram) for gram in filed})
    under = {gram: sorted(keywords) for gram, keywords in filed.items()}
    names = frozenset(under)
    kind = pa.struct([("place", pa.int32()), ("category", pa.string())])

    def of(text: str | None) -> dict | None:
        first = None
        for gram in _grams(text, sizes) & names if text is not None else ():
            for place, category, keyword in under[gram]:
                if first is not None and (place, category) >= first:
                    break
                if keyword in text:
                    first = (place, category)
        return None if first is None else {"place": first[0], "category": first[1]}

    def tagged(column: pa.Array) -> pa.Array:
        parts = [pa.array(list(map(of, group.to_pylist())), kind) for group in groups(readable(column))]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return arrow_udf(tagged, "place int, category string")
