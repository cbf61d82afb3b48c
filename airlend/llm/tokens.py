"""Whole texts to token ids, Arrow batch by Arrow batch, each distinct part encoded once.

The byte-level pattern (public_tokenizers.PATTERN) always starts a new pre-token at a space before a visible
Latin character, between a word and the punctuation after it, and on both sides of a single line break
between two such parts. A text can therefore be cut there and its parts encoded on their own: the ids are
those of the whole text. `LibraryEncoder` does so for the tokenizers library, slice by slice. `PartEncoder` does so for
any encoder and keeps the ids of the parts that a worker has met lately.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from airlend.llm.common import kept

#: Parts in each of two generations that a worker remembers; bounds its memory, not the results.
KEPT_PARTS = 250_000

#: Parts that a worker remembers of the library's, and their length: some 40 MB at most.
KEPT_DISTINCT, KEPT_BYTES = 500_000, 64

#: Bytes of text that are encoded at once.
SLICE_BYTES = 4_000_000

_CUT = re.compile(r" (?=[!-~À-ɏ])")
_OTHER_SPACE_RE2 = r" (?:[^!-~À-ɏ]|\z)"
_WORD, _MARKS = r"([A-Za-z0-9À-ÖØ-öø-ɏ]+)", r"([!-&(-/:-@\[-^`{-~]*)"
#: Parts in one text for the library.
GROUP_WORDS = 1_000
_SIMPLE = re.compile(f"{_WORD}{_MARKS}(?:\n{_WORD}{_MARKS})?")


class PartEncoder(dict):
    """`encode` gives the ids of texts. `encode_many` gives those of each string of a list as little-endian
    unsigned 32-bit integers.

    The dictionary holds the ids of parts. A part is named without the space before it, or, if there is none,
    with "\0" before it. Words and punctuation are parts as well, from which longer ones are put together.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]]):
        super().__init__()
        self.encode_many, self.older = encode_many, {}

    def _recall(self, parts: Iterable[str]) -> list[str]:
        """Those of the parts that are not remembered; the older half is forgotten at times."""
        unknown = [part for part in parts if part not in self]
        older = self.older
        self.update((part, older[part]) for part in unknown if part in older)
        return [part for part in unknown if part not in older]

    def learn(self, parts: set[str]) -> None:
        if len(self) > KEPT_PARTS:
            self.older = dict(self)
            self.clear()
        whole, made = set(), {}
        for part in self._recall(parts):
            space = "" if part[:1] != "\0" else "\0"
            found = _SIMPLE.fullmatch(part, len(space))
            if not found or not found[2] and found[3] is None:
                whole.add(part)
                continue
            pieces = [space + found[1], "\0" + found[2]]
            if found[3] is not None:
                pieces += ["\0\n", "\0" + found[3], "\0" + found[4]]
            made[part] = pieces = [x for x in pieces if x != "\0"]
            whole.update(pieces)
        new = self._recall(whole)
        self.update(zip(new, self.encode_many([x[1:] if x[:1] == "\0" else " " + x for x in new])))
        ids = self.__getitem__
        self.update([(part, b"".join(map(ids, pieces))) for part, pieces in made.items()])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of all texts (null: empty) as one array and the place of each text in it.

        Yields once for each slice of about SLICE_BYTES, so that very long texts or batches need no more memory
        than one text does. Each yield covers the next texts; the second array has one entry more than those.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            # Nothing made here refers to itself, and so many small objects make the collector slow.
            gc.disable()
            try:
                # Taken anew, because what is split from an array with an offset may come out wrong.
                found = self._encode_slice(texts.take(pa.array(np.arange(at, to))))
            finally:
                gc.enable()
            yield found
            at = to

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, _OTHER_SPACE_RE2).to_numpy(zero_copy_only=False)
        if odd.any():
            cut = [_CUT.split(t) if o else t.split(" ") for t, o in zip(texts.to_pylist(), odd)]
            sizes = np.fromiter(map(len, cut), "i8", len(cut))
            flat = pa.array(list(chain.from_iterable(cut)), pa.large_string())
        else:
            cut = pc.split_pattern(texts, " ")
            sizes = pc.list_value_length(cut).to_numpy().astype("i8")
            flat = cut.flatten()
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy().astype("i8")
        parts = coded.dictionary.to_pylist()
        # First parts have no space before them.
        firsts = np.cumsum(sizes) - sizes
        heads = ["\0" + part for part in flat.take(pa.array(firsts)).to_pylist()]
        codes[firsts] = len(parts) + np.arange(len(heads))
        parts += heads
        self.learn(set(parts))
        known = pa.array(list(map(self.__getitem__, parts)), pa.large_binary())
        found = known.take(pa.array(codes))
        ends = np.cumsum(pc.binary_length(found).to_numpy()) // 4
        values = ids_of(found.buffers()[2] or b"")[: int(ends[-1])]
        last = np.cumsum(sizes) - 1
        return values, np.concatenate([[0], ends[last]])


#: Characters that the pattern never takes for white space; letters and digits; marks but for "'" and "_".
_SEEN, _LETTER, _MARK = "!-~À-ɏ", "A-Za-z0-9À-ÖØ-öø-ɏ", r"!-&(-/:-@\[-^`{-~"


class LibraryEncoder:
    """`encode` gives the ids that the tokenizers library gives for whole texts, with its own default settings: strings
    of added tokens in a text become these tokens.

    The distinct parts of a slice are encoded once, many to a call, one on each line: the pattern cuts on both sides
    of a line break between two characters that are seen. Texts are cut at spaces before such characters, at
    single line breaks between them, and between a letter or digit and the mark after it. A part without a space
    before it begins with "\0". Parts with other characters are encoded one by one, and texts with an added token's
    string as they are. Up to KEPT_DISTINCT parts of up to KEPT_BYTES bytes are remembered from slice to slice, as Arrow
    arrays, which bounds the memory and not the results.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values() if token.content]
        ids = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_break = ids[0] if len(ids) == 1 else None
        self.parts, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of all texts (null: empty) as one array and the place of each text in it.

        Yields once for each slice of about SLICE_BYTES, so that very long texts or batches need no more memory
        than one text does. Each yield covers the next texts; the second array has one entry more than those.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            # Taken anew, because what is split from an array with an offset may come out wrong.
            yield self._encode_slice(texts.take(pa.array(np.arange(at, to))))
            at = to

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._encode_parts(texts)
        values, bounds = self._encode_parts(pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), texts))
        lists = [values[a:b] for a, b in zip(bounds, bounds[1:])]
        for k in np.flatnonzero(whole):
            lists[k] = np.array(self.tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, "<u4")
        return np.concatenate(lists).astype("<u4"), np.cumsum([0, *map(len, lists)])

    def _encode_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, _OTHER_SPACE_RE2).to_numpy(zero_copy_only=False)
        odd |= pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        cut = pc.replace_substring_regex(texts, f"([{_SEEN}])\n([{_SEEN}])", "\\1 \0\n \0\\2")
        cut = pc.replace_substring_regex(cut, f"([{_LETTER}])([{_MARK}])", "\\1 \0\\2")
        if odd.any():
            lists = [_CUT.split(t) if o else c.split(" ") for t, c, o in zip(texts.to_pylist(), cut.to_pylist(), odd)]
            sizes = np.fromiter(map(len, lists), "i8", len(lists))
            flat = pa.array(list(chain.from_iterable(lists)), pa.large_string())
        else:
            cut = pc.split_pattern(cut, " ")
            sizes = pc.list_value_length(cut).to_numpy().astype("i8")
            flat = cut.flatten()
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy().astype("i8")
        # First parts have no space before them.
        firsts = np.cumsum(sizes) - sizes
        heads = pc.binary_join_element_wise(pa.scalar("\0", pa.large_string()), flat.take(pa.array(firsts)), pa.scalar("", pa.large_string()))
        codes[firsts] = len(coded.dictionary) + np.arange(len(heads))
        known, place = self._encode_distinct(pa.concat_arrays([coded.dictionary, heads]))
        found = known.take(pa.array(place[codes]))
        ends = np.cumsum(pc.binary_length(found).to_numpy()) // 4
        values = ids_of(found.buffers()[2] or b"")[: int(ends[-1])]
        last = np.cumsum(sizes) - 1
        return values, np.concatenate([[0], ends[last]])

    def _encode_distinct(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids as bytes, and the place of each part's ids among them."""
        place = pc.fill_null(pc.index_in(parts, value_set=self.parts), -1).to_numpy().astype("i8")
        unknown = np.flatnonzero(place < 0)
        if not len(unknown):
            return self.ids, place
        asked = parts.take(pa.array(unknown))
        new = pc.unique(asked)
        place[unknown] = len(self.parts) + pc.index_in(asked, value_set=new).to_numpy()
        names, ids = pa.concat_arrays([self.parts, new]), pa.concat_arrays([self.ids, self._encode_new(new)])
        self._keep(names, ids, place)
        return ids, place

    def _keep(self, names: pa.Array, ids: pa.Array, place: np.ndarray) -> None:
        """Remember the parts; if they are too many those of this slice only, and never long ones."""
        kept = pc.binary_length(names).to_numpy() <= KEPT_BYTES
        if len(names) > KEPT_DISTINCT:
            used = np.zeros(len(names), bool)
            used[place] = True
            kept &= used
            kept[np.flatnonzero(kept)[KEPT_DISTINCT:]] = False
        rows = pa.array(np.flatnonzero(kept))
        self.parts, self.ids = names.take(rows), ids.take(rows)

    def _encode_new(self, parts: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(parts, rf"\A\x00?[{_SEEN}]+\z").to_numpy(zero_copy_only=False)
        plain &= self.line_break is not None
        spaced = ~pc.starts_with(parts, "\0").to_numpy(zero_copy_only=False)
        encoded, order = [], []
        for chosen, encode in ((plain & spaced, self._lines), (plain & ~spaced, self._lines), (~plain, self._one_by_one)):
            rows = np.flatnonzero(chosen)
            if len(rows):
                # With the space before it, or without the mark that there is none.
                some = parts.take(pa.array(rows)).to_pylist()
                encoded.append(encode([x[1:] if x[:1] == "\0" else " " + x for x in some]))
                order.append(rows)
        back = np.empty(len(parts), "i8")
        back[np.concatenate(order)] = np.arange(len(parts))
        return pa.concat_arrays(encoded).take(pa.array(back))

    def _one_by_one(self, texts: list[str]) -> pa.Array:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return pa.array([array("I", one.ids).tobytes() for one in found], pa.large_binary())

    def _lines(self, texts: list[str]) -> pa.Array:
        lines = ["\n".join(texts[at : at + GROUP_WORDS]) for at in range(0, len(texts), GROUP_WORDS)]
        ids = []
        for one in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
            ids += [np.array(one.ids, "<u4"), np.array([self.line_break], "<u4")]
        ids = np.concatenate(ids)
        breaks = np.flatnonzero(ids == self.line_break)
        if len(breaks) != len(texts):  # not a pattern that cuts there
            return self._one_by_one(texts)
        ends = 4 * (breaks - np.arange(len(breaks)))
        buffers = [None, pa.py_buffer(np.concatenate([[0], ends]).astype("i8")), pa.py_buffer(ids[ids != self.line_break].tobytes())]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), buffers)


def library_encoder(path: str) -> LibraryEncoder:
    """The tokenizers library's ids under the file at `path`; one for each worker process, until other work comes."""
    return kept(f"library {path}", lambda: LibraryEncoder(path))


def ids_of(text_bytes: bytes) -> np.ndarray:
    return np.frombuffer(text_bytes, dtype="<u4")
