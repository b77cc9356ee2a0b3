"""Cutting texts into units that a tokenizer encodes one by one.

A unit's encoding does not depend on its neighbours, so a worker encodes each
distinct unit once and joins the results: equal to encoding the whole text.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_UNITS = 150_000
COUNT_UNITS = 600_000

#: White space of the tokenizers' patterns (Unicode White_Space), fixed values.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def gpt2_units(text: str) -> tuple[str, list[str]]:
    """First unit and the further ones, for patterns that give a word the one
    space before it.  A further unit stands for itself if it begins with a
    newline, else for itself with a space in front (see ``unit_text``).

    Texts are cut before a single space or newline that is followed by
    something else: there the pattern always begins a new match.
    """
    if _TWO_SPACES.search(text) is None:
        units = text.replace("\n", " \n").split(" ")
        return units[0], units[1:]
    units = _CUT.split(text)
    return units[0], [u[1:] if u[0] == " " else u for u in units[1:]]


def unit_text(unit: str) -> str:
    return unit if unit.startswith("\n") else " " + unit


def plain_units(text: str) -> list[str]:
    """Units for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ")


class UnitCache(dict):
    """unit -> what ``encode(unit)`` returns; emptied when it grows too large,
    so that its memory has a bound."""

    def __init__(self, encode, limit: int = CACHE_UNITS):
        super().__init__()
        self._encode, self._limit = encode, limit

    def __missing__(self, unit):
        if len(self) >= self._limit:
            self.clear()
        out = self[unit] = self._encode(unit)
        return out


#: Letters of ASCII and Latin-1 and the punctuation after them (no apostrophe),
#: with the white space that the unit may begin with.
_LETTERS, _MARKS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(rf"(\n?)( ?[{_LETTERS}]+)([{_MARKS}]*)")
_PLAIN_ARROW = rf"\A(?P<line>\n?)(?P<word> ?[{_LETTERS}]+)(?P<tail>[{_MARKS}]*)\z".replace(r"\xc0-\xd6\xd8-\xf6\xf8-\xff", "\xc0-\xd6\xd8-\xf6\xf8-\xff")
_PART_OF_PLAIN = re.compile(rf"\n? ?[{_LETTERS}]*[{_MARKS}]*")

GPT2_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: (normaliser, pre-tokenizer) of the tokenizers' files -> what becomes of a
#: plain unit's letters, and whether white space is kept.
_RULES = [
    (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, str, True),
    ({"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
     {"type": "Sequence", "pretokenizers": [
         {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
         {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
     lambda word: word.strip().lower(), False),
]

#: The characters that stand for bytes in the tokenizers' vocabularies.
_BYTE_LEVEL = {b: b if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE else None for b in range(256)}
_BYTE_LEVEL |= {b: 256 + i for i, b in enumerate(b for b, to in _BYTE_LEVEL.items() if to is None)}


def plain_words(unit: str) -> list[str] | None:
    """Matches of ``GPT2_PATTERN`` in a plain unit; None for other units."""
    m = _PLAIN.fullmatch(unit)
    return None if m is None else [x for x in m.groups() if x]


def known_rules(tokenizer) -> tuple[Callable[[str], str], bool] | None:
    """What the tokenizer makes of a plain unit's letters, and whether it keeps
    white space; None if its rules are others."""
    rules = [json.loads(x.__getstate__()) if x else None for x in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
    known = [own[2:] for own in _RULES if list(own[:2]) == rules]
    if not known or any(_PART_OF_PLAIN.fullmatch(t.content) for t in tokenizer.get_added_tokens_decoder().values()):
        return None
    return known[0]


def plain_encoder(tokenizer, width: str, limit: int) -> Callable[[str], bytes | None] | None:
    """For a tokenizer whose rules are known, a function that gives the ids of
    a plain unit by calls of the library's model for its letters and for its
    punctuation, which is what the rules make of it, without their cost (None
    for other units)."""
    rules = known_rules(tokenizer)
    if rules is None:
        return None
    (form, spaces), tokenize, match = rules, tokenizer.model.tokenize, _PLAIN.fullmatch
    numbers = [i.to_bytes(int(width[2:]), "little") for i in range(tokenizer.get_vocab_size())]

    def ids_of(piece: str) -> bytes:
        return b"".join([numbers[t.id] for t in tokenize(piece.encode("utf-8").decode("latin-1").translate(_BYTE_LEVEL))])
    words, tails = RecentCache(ids_of, limit), UnitCache(ids_of, 10_000)

    def encode(unit: str) -> bytes | None:
        m = match(unit)
        if m is None:
            return None
        line, word, tail = m.groups()
        ids = words[form(word)]
        if tail:
            ids += tails[tail]
        return tails[line] + ids if line and spaces else ids
    return encode


class RecentCache(UnitCache):
    """As ``UnitCache``, but what was asked for since it was emptied the time
    before is kept."""

    def __init__(self, encode, limit: int = CACHE_UNITS):
        super().__init__(encode, limit)
        self._older: dict = {}

    def __missing__(self, unit):
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        out = self._older.get(unit)
        out = self[unit] = self._encode(unit) if out is None else out
        return out


class UnitIds(dict):
    """unit -> its ids as bytes, of the numbers' type ``width``.  Plain units
    are encoded by the model alone as they are asked for, others by the library
    or, if ``learn`` was told of them, many at a call.  Emptied when it grows
    too large; what it held then is looked up until the next time."""

    def __init__(self, tokenizer, width: str, text_of=str, limit: int = CACHE_UNITS):
        super().__init__()
        self._tokenizer, self._width, self._text_of, self._limit = tokenizer, width, text_of, limit
        self.forget()

    def forget(self) -> None:
        """Gives the memory back."""
        self.clear()
        self._older: dict = {}
        self._plain = plain_encoder(self._tokenizer, self._width, self._limit)

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        ids = self._older.get(unit)
        if ids is None and self._plain is not None:
            ids = self._plain(self._text_of(unit))
        if ids is None:
            ids = self._bytes(self._tokenizer.encode(self._text_of(unit), add_special_tokens=False).ids)
        self[unit] = ids
        return ids

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self._width).tobytes()

    def expect(self, units) -> None:
        """Learns the units where single calls cost more."""
        if self._plain is None:
            self.learn(units)

    def learn(self, units) -> None:
        units = set(units)
        new = units.difference(self)
        if len(self) + len(new) > self._limit:
            self.clear()
            new = units
        new = list(new)
        for unit, found in zip(new, self._tokenizer.encode_batch_fast(list(map(self._text_of, new)), add_special_tokens=False), strict=True):
            self[unit] = self._bytes(found.ids)


_TWO_WHITE = "[\t-\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}"  # as ``_TWO_SPACES``, for Arrow


def gpt2_unit_lists(texts: pa.Array) -> pa.ListArray:
    """A list of units for each text, as ``gpt2_units`` gives them."""
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    odd = np.flatnonzero(pc.match_substring_regex(texts, _TWO_WHITE).to_numpy(zero_copy_only=False))
    if len(odd):
        own = pa.array([[head, *rest] for head, rest in map(gpt2_units, texts.take(pa.array(odd)).to_pylist())], lists.type)
        take = np.arange(len(lists))
        take[odd] = len(lists) + np.arange(len(odd))
        lists = pa.concat_arrays([lists, own]).take(pa.array(take))
    return lists


def plain_unit_lists(texts: pa.Array) -> pa.ListArray:
    """As ``plain_units``, for many texts."""
    return pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")


def word_lists(texts: pa.Array) -> pa.ListArray:
    """Words of each text (bytes, ASCII letters in lower case) as the pattern
    ``[^\\x20\\x09-\\x0D]+`` finds them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    units, offsets = flat_lists(lists)
    full = pc.greater(pc.binary_length(units), 0).to_numpy(zero_copy_only=False)  # white space at either end gives an empty unit
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(full)][offsets], pa.int32()), units.filter(pa.array(full)).cast(pa.binary()))


def flat_lists(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All members, and where each list begins and the last one ends."""
    offsets = lists.offsets.to_numpy()
    return lists.flatten(), offsets - offsets[0]


def pieces_of(pieces: list[bytes], width: str) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of numbers of the type ``width``, and the size of each."""
    return np.frombuffer(b"".join(pieces), width), np.fromiter(map(len, pieces), np.int64, len(pieces)) // np.dtype(width).itemsize


def gathered(pieces: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces with these numbers, one after the other, and their sizes."""
    data, sizes = pieces
    n = sizes[codes]
    at = np.repeat((np.cumsum(sizes) - sizes)[codes] - np.cumsum(n) + n, n)
    at += np.arange(len(at))
    return data[at], n


def spelled(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct units of ``gpt2_unit_lists`` with the space that belongs to
    further ones, each unit's number among them, and where every list ends."""
    units, offsets = flat_lists(lists)
    first = offsets[:-1]
    found, heads = units.dictionary_encode(), units.take(pa.array(first)).dictionary_encode()
    codes = found.indices.to_numpy().astype(np.int64)
    codes[first] = len(found.dictionary) + heads.indices.to_numpy()
    further = pc.if_else(pc.starts_with(found.dictionary, "\n"), found.dictionary, pc.binary_join_element_wise(pa.scalar(" "), found.dictionary, ""))
    return pa.concat_arrays([further, heads.dictionary]), codes, offsets[1:]


def plain_parts(units: pa.Array) -> tuple[list[np.ndarray], list[pa.Array], np.ndarray]:
    """What ``_PLAIN`` finds in units: for line, word and tail every unit's
    number among the distinct ones, and these; then which units are not plain
    (all their parts are empty)."""
    found = pc.extract_regex(units, _PLAIN_ARROW)
    numbers, distinct = [], []
    for i in range(3):
        own = pc.fill_null(pc.struct_field(found, [i]), "").dictionary_encode()
        numbers.append(own.indices.to_numpy())
        distinct.append(own.dictionary)
    return numbers, distinct, np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))


class WordIds(dict):
    """word -> its ids as bytes, what ``encode`` gives for a list of words;
    what was asked for since it was emptied the time before is kept."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int):
        super().__init__()
        self._encode, self._limit = encode, limit
        self._older: dict = {}

    def of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        out, new = [*map(self.get, words)], []
        for i, ids in enumerate(out):
            if ids is None:
                ids = out[i] = self._older.get(words[i])
                if ids is None:
                    new.append(i)
                else:
                    self[words[i]] = ids
        own = [words[i] for i in new]
        for i, ids in zip(new, self._encode(own), strict=True):
            out[i] = ids
        if len(self) + len(own) > self._limit:
            self._older = dict(self)
            self.clear()
        self.update((words[i], out[i]) for i in new[:self._limit])
        return out


class BatchIds:
    """Ids of many units at a call.  Plain units are cut into their words, and
    ``words`` gives the ids of a list of these; ``others`` those of a list of
    other units.  Both are told of distinct ones."""

    def __init__(self, width: str, words: Callable[[list[str]], list[bytes]] | None, others: Callable[[list[str]], list[bytes]], form=str, spaces: bool = True, limit: int = CACHE_UNITS):
        self._width, self._form, self._spaces, self._plain = width, form, spaces, words is not None
        self._words, self._others = WordIds(words, limit), WordIds(others, limit // 8)

    def of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces (``pieces_of``) of distinct units."""
        if not self._plain:
            return pieces_of(self._others.of(units.to_pylist()), self._width)
        (line, word, tail), distinct, other = plain_parts(units)
        lines, words, tails = (x.to_pylist() for x in distinct)
        own = self._words.of
        parts = [[own([x])[0] if x and self._spaces else b"" for x in lines], own(words if self._form is str else [*map(self._form, words)]),
                 [own([x])[0] if x else b"" for x in tails]]
        codes = np.stack([line, len(lines) + word, len(lines) + len(words) + tail], 1).astype(np.int64)
        codes[other, 1] = sum(map(len, parts)) + np.arange(len(other))
        data, sizes = gathered(pieces_of([*chain(*parts), *self._others.of(units.take(pa.array(other)).to_pylist())], self._width), codes.ravel())
        return data, sizes.reshape(-1, 3).sum(axis=1)

    def lists(self, units: pa.Array, codes: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """For each list of units, given by their numbers and by where the
        lists end, the ids of its units one after the other."""
        data, sizes = gathered(self.of(units), codes)
        out, stops = data.tobytes(), (np.r_[0, np.cumsum(sizes)][ends] * data.itemsize).tolist()
        return [out[a:b] for a, b in zip([0, *stops], stops, strict=False)]


def library_ids(tokenizer, width: str, limit: int = CACHE_UNITS) -> BatchIds:
    """Ids by the library: by calls of its model for words where the
    tokenizer's rules are known (see ``plain_encoder``), else as a whole."""
    size = int(width[2:])

    def whole(units: list[str]) -> list[bytes]:
        return [np.array(x.ids, width).tobytes() for x in tokenizer.encode_batch_fast(units, add_special_tokens=False)]
    rules = known_rules(tokenizer)
    if rules is None:
        return BatchIds(width, None, whole, limit=limit)
    tokenize, between = tokenizer.model.tokenize, chr(_BYTE_LEVEL[0])

    def model(words: list[str]) -> list[bytes]:
        flat, ends = [], [0]
        for word in "\0".join(words).encode("utf-8").decode("latin-1").translate(_BYTE_LEVEL).split(between) if words else ():
            flat += [t.id for t in tokenize(word)]
            ends.append(len(flat) * size)
        data = np.array(flat, width).tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return BatchIds(width, model, whole, *rules, limit=limit)


def parts_of(texts: pa.Array, size: int = 1 << 22):
    """Slices of texts of about so many bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(upto, (upto[start - 1] if start else 0) + size)) + 1
        yield texts.slice(start, end - start)
        start = min(end, len(texts))


def text_parts(texts: list, chars: int = 1 << 20):
    """Ranges of texts of about so many characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def library_tokenizer(path: str):
    """The tokenizers library's object, as it encodes by a plain call: strings
    of special tokens in a text are these tokens."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class WordCounts:
    """Counts (word, n) of a task as Arrow tables, handed on in parts of about
    ``limit`` words."""

    def __init__(self, limit: int = COUNT_UNITS):
        self._held: list[pa.Table] = []
        self._rows, self._limit = 0, limit

    def add(self, words: pa.Array, n: pa.Array) -> None:
        self._held.append(pa.table([words, n], ["word", "n"]))
        self._rows += len(words)

    def full(self) -> bool:
        if self._rows >= 2 * self._limit:
            self._sum()
        return self._rows >= 2 * self._limit or len(self._held) == 1 and self._rows >= self._limit

    def _sum(self) -> None:
        total = pa.concat_tables(self._held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        self._held, self._rows = [total.select(["word", "n_sum"]).rename_columns(["word", "n"])], len(total)

    def drain(self) -> list[pa.RecordBatch]:
        if len(self._held) > 1:
            self._sum()
        held, self._held, self._rows = self._held, [], 0
        return [b for t in held for b in t.to_batches()]


class Counts:
    """Counts of a task, handed on in parts of bounded size."""

    def __init__(self, limit: int = COUNT_UNITS):
        self._counter, self._limit = Counter(), limit

    def add(self, items) -> None:
        self._counter.update(items)

    def full(self) -> bool:
        return len(self._counter) >= self._limit

    def drain(self) -> tuple[list, list]:
        counter, self._counter = self._counter, Counter()
        return list(counter), list(counter.values())
