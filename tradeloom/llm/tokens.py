"""Token ids of whole texts by the tokenizers library, remembered per word.

A byte-level tokenizer never joins a space with what stands before it, unless the
space lies inside a run of white space, nor a letter with a mark behind it, nor a
single line break with a letter behind it. Texts without such runs are cut there
and put together from the ids of their words, so that a word met again costs a
lookup, whatever mark or line break follows it. All other texts go to the library
whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
#: Words and ids that one worker remembers, about 20 MB; beyond either it starts anew.
REMEMBERED = 600_000
REMEMBERED_IDS = 8_000_000
_JOINED = 200
_AT_ONCE = 64
# Unicode white space, and what Python counts as such.
_OTHER = r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_SPACE = f"[ {_OTHER}]"
# A space inside a run of white space, or after white space at the end of the text.
_RUN = f"{_SPACE} (?:{_SPACE}|\\z)"
# White space at an end of a word, not counting one space at its start.
_EDGE = f"\\A(?:[{_OTHER}]| {_SPACE})|{_SPACE}\\z"

Encoded = tuple[np.ndarray, np.ndarray]  # all ids, and where each text's or word's ids begin and end


def bounds_of(sizes: Sequence[int] | np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(np.asarray(sizes, dtype=np.int64))]


def together(parts: Sequence[Sequence[int] | np.ndarray]) -> Encoded:
    flat = [np.asarray(p, dtype=np.uint32) for p in parts]
    return np.concatenate([np.empty(0, np.uint32), *flat]), bounds_of([len(p) for p in flat])


class Memory:
    """Ids of words, learned once by ``encode``, which takes new words to their ids."""

    def __init__(self, encode: Callable[[pa.Array], Encoded]):
        self.encode = encode
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.bounds = np.empty(0, np.uint32), np.zeros(1, np.int32)

    def look(self, words: pa.Array) -> np.ndarray:
        """Number of each of the ``words``, large strings that may repeat."""
        if len(self.known) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        before = len(self.known)
        # A dictionary numbers its words by their first place: known ones keep their numbers.
        coded = pa.concat_arrays([self.known, words]).dictionary_encode()
        if len(coded.dictionary) > before:
            ids, bounds = self.encode(coded.dictionary.slice(before))
            self.bounds = np.concatenate([self.bounds, (bounds[1:] + len(self.ids)).astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.known = coded.dictionary
        return coded.indices.to_numpy()[before:]

    def expand(self, numbers: np.ndarray) -> Encoded:
        """Ids of a row of words, which are no more than its bytes, so that 32 bits count them."""
        starts = self.bounds[numbers]
        sizes = self.bounds[1:][numbers] - starts
        bounds = np.zeros(len(numbers) + 1, dtype=np.int32)
        np.cumsum(sizes, out=bounds[1:])
        starts -= bounds[:-1]
        at = np.repeat(starts, sizes)
        at += np.arange(len(at), dtype=np.int32)
        return self.ids[at], bounds


def splice(chosen: np.ndarray, one: Encoded, other: Encoded) -> Encoded:
    """Texts in order again: those ``chosen`` from ``one``, the rest from ``other``."""
    sizes = np.empty(len(chosen), dtype=np.int64)
    sizes[chosen], sizes[~chosen] = np.diff(one[1]), np.diff(other[1])
    mine = np.repeat(chosen, sizes)
    ids = np.empty(len(mine), dtype=np.uint32)
    ids[mine], ids[~mine] = one[0], other[0]
    return ids, bounds_of(sizes)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings without NULL, and where each begins and ends."""
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Large strings from their bytes, the other way round."""
    return pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data))


def _joined_by(*parts: pa.Array | str) -> pa.Array:
    """Large strings joined by the last part."""
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts])


def cut_words(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the words of texts begin: at each text, at spaces, at an ASCII mark or
    white space after an ASCII letter, and at a letter after a line break that has
    no white space before it."""
    letter = ((data | 32) - np.uint8(97)) < 26
    starts = data == 32
    starts[1:] |= letter[:-1] & ~letter[1:] & (data[1:] < 128)
    starts[2:] |= letter[2:] & (data[1:-1] == 10) & ((data[:-2] - np.uint8(33)) < 94)
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(starts)


class Tokens:
    """Ids of texts, as ``tokenizers`` gives them without special tokens added.

    ``special_text`` leaves the strings of special tokens in a text ordinary text;
    the library's default gives them their special ids. ``lead`` puts a space
    before each text.
    """

    def __init__(self, tokenizer: str = TOKENIZER, special_text: bool = False, lead: bool = False):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.lead = lead
        self.library = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self.library.encode_special_tokens = special_text
        # Words are remembered here; the library's own cache would only be filled with words met once.
        self.library.model._resize_cache(0)
        added = self.library.get_added_tokens_decoder().values()
        self.special = [] if special_text else [t.content for t in added]
        letters = set(ByteLevel.alphabet())
        self.lengths = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
        for piece, number in self.library.get_vocab().items():
            self.lengths[number] = len(piece) if set(piece) <= letters else len(piece.encode())
        self.words = Memory(self._words)

    def _whole(self, texts: list[str]) -> Encoded:
        # A few at a time, as the library's own results take many times the room of the ids.
        return together([
            np.asarray(found.ids, dtype=np.uint32) for i in range(0, len(texts), _AT_ONCE)
            for found in self.library.encode_batch_fast(texts[i : i + _AT_ONCE], add_special_tokens=False)])

    def _words(self, words: pa.Array) -> Encoded:
        """Words without white space at their ends are encoded many at a time, those
        without a space before them on lines of their own: their bytes tell the ids
        apart."""
        short = pc.and_(pc.less(pc.utf8_length(words), 64), pc.not_equal(words, ""))
        plain = pc.and_not(short, pc.match_substring_regex(words, _EDGE))
        spaced = pc.and_(plain, pc.starts_with(words, " "))
        lines = pc.and_not(plain, spaced)
        after_space = self._joined(words.filter(spaced))
        found, bounds = self._joined(_joined_by(words.filter(lines), "", "\n"))
        kept = np.ones(len(found), dtype=bool)
        kept[bounds[1:] - 1] = False  # the line break
        on_lines = found[kept], bounds - np.arange(len(bounds))
        rest = self._whole(words.filter(pc.invert(plain)).to_pylist())
        plain, spaced = (m.to_numpy(zero_copy_only=False) for m in (plain, spaced))
        return splice(plain, splice(spaced[plain], after_space, on_lines), rest)

    def _joined(self, words: pa.Array) -> Encoded:
        data, bounds = raw(words)
        ids, _ = self._whole(strings(data, np.unique(np.r_[bounds[::_JOINED], bounds[-1]])).to_pylist())
        return ids, np.r_[0, np.searchsorted(np.cumsum(self.lengths[ids]), bounds[1:], "right")]

    def encode(self, texts: pa.Array) -> Encoded:
        """All ids of an Arrow array of texts and the bounds of each text's; NULL counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        slow = pc.match_substring_regex(texts, _RUN)
        if self.lead:
            slow = pc.or_(slow, pc.starts_with(texts, " "))
            texts = _joined_by("", texts, " ")
        for text in self.special:
            slow = pc.or_(slow, pc.match_substring(texts, text))
        fast = ~slow.to_numpy(zero_copy_only=False)
        data, bounds = raw(texts if fast.all() else texts.filter(pa.array(fast)))
        starts = cut_words(data, bounds)
        ids, ends = self.words.expand(self.words.look(strings(data, np.r_[starts, len(data)])))
        found = ids, ends[np.searchsorted(starts, bounds)].astype(np.int64)
        if fast.all():
            return found
        return splice(fast, found, self._whole(texts.filter(slow).to_pylist()))


@lru_cache(maxsize=2)
def tokens_of(tokenizer: str = TOKENIZER, special_text: bool = False, lead: bool = False) -> Tokens:
    """The tokenizer of this process: a worker keeps it, and its words, from task to task."""
    return Tokens(tokenizer, special_text, lead)


def slices(texts: pa.Array, size: int) -> list[tuple[int, int]]:
    """Neighbouring texts of about ``size`` bytes together; a longer text alone."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    cuts = np.unique(np.r_[0, np.flatnonzero(np.diff(ends // size)) + 1, len(texts)]).tolist()
    return list(zip(cuts, cuts[1:]))
