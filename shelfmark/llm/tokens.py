"""Token ids of whole texts by a public tokenizer."""

from __future__ import annotations

from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

# Units whose ids a task remembers, with about 200 bytes each; beyond it the memory is emptied.
REMEMBERED = 500_000
# ASCII marks that form one piece, apart from the letters around them. The apostrophe is none of
# them: with some letters after it, it is a piece of its own kind.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# New units that the tokenizer's model gets in one call, and bytes of text that are taken apart at once.
AT_ONCE = 1000
LOT_BYTES = 1 << 20

LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
SPACE, LETTER, MARK, OTHER, LEAD = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[list(b" \t\n\r\x0b\x0c")] = SPACE
KIND[[b for b in range(128) if chr(b).isalpha()]] = LETTER
KIND[list(MARKS)] = MARK
KIND[0xC3:0xCA] = LEAD  # first bytes of U+00C0 to U+024F


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary (fixed by its format)."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """From UTF-8 texts to token ids, with the id ``end`` after each text if given.

    For byte-level tokenizers that lower-case, drop white space and never join what stands on both
    sides of it, so that the ids of a text are those of its words in turn. A word of Latin letters
    and ASCII marks falls into runs of either, which are units; any other word is one unit. Of many
    texts each different unit is looked up once, and encoded if it is not remembered: runs by the
    tokenizer's model, other words by the whole tokenizer. Texts with one of its special tokens are
    encoded whole.
    """

    def __init__(self, path: str, end: int | None = 0):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Lower-cased words may look like special tokens and are none: both are made without these.
        self.runs, self.words = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.runs.pre_tokenizer = WhitespaceSplit()
        self.words.normalizer, self.words.pre_tokenizer = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.end = [] if end is None else [end]
        self.letters = _byte_letters() | {32: " "}
        self.forget()

    def forget(self) -> None:
        self.code: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.bounds = np.zeros(1 << 18, np.int64)
        # Code 0 is the end of a text.
        self.flat[: len(self.end)] = self.end
        self.bounds[1] = len(self.end)

    def __call__(self, text: bytes | None) -> np.ndarray:
        return self.all(pa.array([text], pa.binary()))[0]

    def all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text of a string or binary column, in its order; a null text is empty."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        lot, long = bounds[:-1] // LOT_BYTES, np.diff(bounds) > LOT_BYTES
        cuts = [*np.flatnonzero(np.r_[True, (lot[1:] != lot[:-1]) | long[1:] | long[:-1]]).tolist(), len(lot)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            out += [self._long(data[bounds[a] : bounds[b]])] if long[a] else self._lot(data, bounds[a : b + 1])
        return out

    def _long(self, raw: np.ndarray) -> np.ndarray:
        """The ids of a text of any length, cut before white space."""
        whole = raw.tobytes()
        if any(s in whole for s in self.special):
            return np.array(self.whole(whole.decode(errors="replace")) + self.end, np.uint32)
        space = KIND[raw] == SPACE
        out, at = [], 0
        while at < len(raw):
            beyond = min(at + LOT_BYTES, len(raw))
            if beyond < len(raw):
                step = int(space[beyond:].argmax())
                beyond = beyond + step if space[beyond + step] else len(raw)
            ids = self._lot(raw, np.array([at, beyond]))[0]
            out.append(ids[: len(ids) - len(self.end)])
            at = beyond
        return np.concatenate([*out, np.array(self.end, np.uint32)])

    def _lot(self, data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        raw, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
        body, sizes, firsts = _units(raw, bounds)
        codes = np.insert(self._codes(body, sizes), firsts[1:], 0)
        start, length = self.bounds[codes], self.bounds[codes + 1] - self.bounds[codes]
        ends = np.cumsum(length)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(start - ends + length, length)]
        after = [0, *ends[firsts[1:] + np.arange(len(bounds) - 1)].tolist()]
        out = [ids[a:b] for a, b in zip(after, after[1:])]
        whole = raw.tobytes()
        if any(s in whole for s in self.special):
            for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                if any(s in whole[a:b] for s in self.special):
                    out[i] = np.array(self.whole(whole[a:b].decode(errors="replace")) + self.end, np.uint32)
        return out

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _codes(self, body: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The code of every unit; ``body`` has their bytes one after the other."""
        offsets = np.r_[0, np.cumsum(sizes)]
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
        ).dictionary_encode()
        at = np.frombuffer(units.dictionary.buffers()[1], np.int64)[: len(units.dictionary) + 1].tolist()
        joined = (units.dictionary.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        different = [joined[a:b] for a, b in zip(at, at[1:])]
        if len(self.code) > REMEMBERED:
            self.forget()
        codes = np.fromiter(map(self.code.get, different, repeat(0)), np.int64, len(different))
        new = np.flatnonzero(codes == 0)
        if len(new):
            codes[new] = self._remember([different[i] for i in new.tolist()])
        return codes[units.indices.to_numpy()]

    def _remember(self, units: list[bytes]) -> np.ndarray:
        """Codes of new units."""
        run = np.fromiter(map(_is_run, units), bool, len(units))
        sizes, ids = np.zeros(len(units), np.int64), []
        runs = np.flatnonzero(run)
        for low in range(0, len(runs), AT_ONCE):
            some = runs[low : low + AT_ONCE]
            spelled = b" ".join([units[i] for i in some.tolist()]).decode()
            if not spelled.isascii():
                spelled = spelled.lower().encode().decode("latin-1").translate(self.letters)
            found = self.runs.encode(spelled, add_special_tokens=False)
            sizes[some] = np.bincount(found.word_ids, minlength=len(some))
            ids.append(found.ids)
        others = np.flatnonzero(~run)
        for i in others.tolist():
            ids.append(self.words.encode(units[i].decode(errors="replace"), add_special_tokens=False).ids)
            sizes[i] = len(ids[-1])
        # Codes in the order in which the ids have come.
        order = np.r_[runs, others]
        n = len(self.code) + 1
        a = int(self.bounds[n])
        ends = a + np.cumsum(sizes[order])
        self.flat = _room(self.flat, int(ends[-1]))
        self.bounds = _room(self.bounds, n + len(units) + 1)
        self.flat[a : ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32, int(ends[-1]) - a)
        self.bounds[n + 1 : n + 1 + len(units)] = ends
        codes = np.empty(len(units), np.int64)
        codes[order] = np.arange(n, n + len(units))
        self.code.update(zip(units, codes.tolist()))
        return codes


def _units(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts, one after the other: the bytes of all units, their sizes, and each text's first unit.

    A-Z are lower-cased.
    """
    kind = KIND[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    # Latin letters of two bytes, but for two signs among them and one that lower() makes two of.
    lead = np.flatnonzero(kind == LEAD)
    kind[lead] = OTHER
    lead = lead[~edge[lead + 1]]
    letter = raw[lead].astype(int) << 8 | raw[lead + 1]
    lead = lead[(raw[lead + 1] & 0xC0 == 0x80) & (letter != 0xC397) & (letter != 0xC3B7) & (letter != 0xC4B0)]
    kind[lead] = kind[lead + 1] = LETTER
    edge = edge[:-1]
    ink = kind != SPACE
    other = np.flatnonzero(kind == OTHER)
    if len(other):
        # A word with any other byte is one unit.
        turn = ink.copy()
        turn[1:] ^= ink[:-1]
        limits = np.r_[np.flatnonzero(turn | edge), len(raw)]
        own = np.unique(np.searchsorted(limits, other, "right") - 1)
        sizes = limits[own + 1] - limits[own]
        kind[np.arange(sizes.sum()) + np.repeat(limits[own] - np.cumsum(sizes) + sizes, sizes)] = OTHER
    edge[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(edge)
    own = ink[starts]
    sizes = np.diff(np.r_[starts, len(raw)])[own]
    return LOWER[raw[ink]], sizes, np.searchsorted(starts[own], bounds)


def _is_run(unit: bytes) -> bool:
    """Letters alone, which the tokenizer's clean-up changes as str.lower() does, or marks alone."""
    if unit.isalpha() or not unit.strip(MARKS):
        return True
    spelled = unit.decode(errors="replace")
    return spelled.isalpha() and max(spelled) < "ɐ" and "İ" not in spelled


@lru_cache(maxsize=1)
def kept_encoder(path: str, end: int | None = 0) -> WordEncoder:
    """The encoder of this Python worker, which later tasks find with the words it remembers."""
    return WordEncoder(path, end)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.r_[array, np.zeros(max(size, len(array)), array.dtype)]
