"""Token ids of whole texts with a public tokenizer, one library call per distinct piece.

Both supported tokenizers cut a text at white space before anything else, so the ids of a text are
the ids of its pieces in a row. Pieces repeat a lot; each worker keeps the ids of those it has
seen. Pieces of letters alone are words to both tokenizers, so the library's model gets them as
words; it cuts all others itself. Texts in which white space is not plain (or that name special
tokens) go to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillwise.llm.common import worker_cache

#: Texts with these are encoded whole: rare white space, joiners and special tokens.
UNUSUAL = re.compile(
    r"[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁤　﻿]|<\|"
)
#: Bytes of pieces and ids that one generation of a worker's memory holds, and what an entry costs
#: besides; two generations are kept (speed only). Longer pieces are not kept.
GENERATION_BYTES, ENTRY_BYTES, LONGEST_KEPT = 96 << 20, 160, 1024
#: Bytes of text that are cut into pieces at once.
BLOCK_BYTES = 4 << 20
#: What is cut off behind a letter: neither tokenizer joins it to letters, as they do apostrophes.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Lines that are one word to both tokenizers: Latin-1 letters, which stay letters in lower case.
WORDS = re.compile("^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$", re.M)


def id_type(vocabulary: int) -> str:
    return "uint16" if vocabulary <= 1 << 16 else "uint32"


_SPACE, _LETTER, _MARK = np.zeros((3, 256), dtype=bool)
_SPACE[[9, 10, 13, 32]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(MARKS.encode())] = True
#: Second bytes of the Latin-1 letters that begin with C3.
_ACCENTED = np.zeros(256, dtype=bool)
_ACCENTED[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
#: Byte-level characters (UTF-16) of the bytes of words; line feeds, which stand between, stay.
_BYTE_CHARACTERS = np.arange(256, dtype="<u2")
_BYTE_CHARACTERS[32] = 0x120
_BYTE_CHARACTERS[0x80:0xA1] = np.arange(0x122, 0x143)
_BYTE_CHARACTERS[0xAD] = 0x143


def cut_at_spaces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts that follow each other in ``data``, beginning at ``starts``.

    A byte-level tokenizer cuts at white space so: the last character of a run belongs to the word
    behind it if it is a space and stands alone otherwise; what is before it is a piece. Both tokenizers
    cut between a Latin-1 letter and a mark behind it.
    """
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[starts] = True
    first[n] = True
    space = np.r_[_SPACE[data], False]
    before = np.r_[False, space[:-1]]
    begins = np.flatnonzero(space & (~before | first))
    ends = np.flatnonzero(before & (~space | first))
    ends_word = ends[~first[ends]]
    cuts = first.copy()
    cuts[begins] = True
    cuts[ends_word - 1] = True
    cuts[ends_word[data[ends_word - 1] != 32]] = True
    marks = np.flatnonzero(_MARK[data] & ~first[:-1])
    behind = data[marks - 1]
    cuts[marks[_LETTER[behind] | (_ACCENTED[behind] & (data[marks - 2] == 0xC3))]] = True
    return np.flatnonzero(cuts[:n])


class Encoder:
    """``encode_many(texts)`` gives the ids of each text as a numpy array. ``spaced`` says whether
    white space counts. The pieces of a block of texts are numbered by their dictionary in Arrow, so
    only distinct pieces are looked up, and only unknown ones are asked of the library."""

    def __init__(self, path: str, spaced: bool):
        # Tasks are the parallelism here; threads of the library would only compete with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.words = Tokenizer(self.library.model)
        self.type = np.dtype(id_type(self.library.get_vocab_size(with_added_tokens=True)))
        self.spaced = spaced
        # Stands between pieces; its id occurs in no piece that lacks its character.
        divider = "\n" if spaced else " | "
        self.divider = divider, self.library.encode(divider, add_special_tokens=False).ids[0]
        # Ids of a piece as bytes; False if a text with it is encoded whole.
        self.seen: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}
        self.held = 0

    def _between(self, ids: list[int], pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces from those of all, in which the divider's id stands between; none if it is
        not that often there."""
        ids = np.array(ids, self.type)
        step = self.type.itemsize
        cuts = np.flatnonzero(ids == self.divider[1]) * step
        if len(cuts) != len(pieces) - 1:
            return {}
        raw = ids.tobytes()
        return {p: raw[a:b] for p, a, b in zip(pieces, [0, *(cuts + step).tolist()], [*cuts.tolist(), len(raw)])}

    def _ask(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, in one call for the words and one for all others that can be told
        apart by the divider's id."""
        divider = self.divider[0]
        words = WORDS.findall("\n".join(pieces))
        answer = {}
        if words:
            # A line feed's byte-level character is U+010A.
            joined = "\n".join(words)
            raw = np.frombuffer((joined if self.spaced else joined.lower()).encode(), np.uint8)
            lines = _BYTE_CHARACTERS[raw].tobytes().decode("utf-16-le")
            between = "\n\u010a\n" if self.spaced else f"\n{divider.strip()}\n"
            asked = lines.replace("\n", between).split("\n")
            found = self.words.encode_batch_fast([asked], is_pretokenized=True, add_special_tokens=False)
            answer = self._between(found[0].ids, words)
        if len(answer) < len(pieces):
            bare = divider.strip(" ")
            plain = [p for p in pieces if p not in answer and bare not in p and not p.isspace()]
            if plain:
                found = self.library.encode_batch_fast([divider.join(plain)], add_special_tokens=False)
                answer |= self._between(found[0].ids, plain)
        if len(answer) < len(pieces):
            rest = [p for p in pieces if p not in answer]
            found = self.library.encode_batch_fast(rest, add_special_tokens=False)
            answer |= {p: np.array(f.ids, self.type).tobytes() for p, f in zip(rest, found)}
        return answer

    def _lookup(self, pieces: list[str]) -> list[bytes | bool]:
        """What is known or now asked about distinct pieces."""
        if self.held > GENERATION_BYTES:
            self.older, self.seen, self.held = self.seen, {}, 0
        found = list(map(self.seen.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        names = [pieces[i] for i in missing]
        values = list(map(self.older.get, names))
        new = [p for p, ids in zip(names, values) if ids is None]
        if new:
            answer = {}
            if UNUSUAL.search("\0".join(new)):
                answer = {p: False for p in new if UNUSUAL.search(p)}
                new = [p for p in new if p not in answer]
            answer |= self._ask(new)
            values = [answer[p] if ids is None else ids for p, ids in zip(names, values)]
        for i, ids in zip(missing, values):
            found[i] = ids
        kept = zip(names, values)
        if max(map(len, names), default=0) > LONGEST_KEPT:
            kept = [(p, ids) for p, ids in kept if len(p) <= LONGEST_KEPT]
            names, values = [p for p, _ in kept], [ids for _, ids in kept]
        self.seen.update(kept)
        self.held += sum(map(len, names)) + sum(map(len, filter(None, values))) + ENTRY_BYTES * len(names)
        return found

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.encode_column(pa.array(texts, pa.string())))

    def _encode_block(self, data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of texts that follow each other in ``data`` and end at ``ends``."""
        sizes = np.diff(ends, prepend=0)
        cuts = cut_at_spaces(data, (ends - sizes)[sizes > 0])
        offsets = pa.py_buffer(np.r_[cuts, len(data)].astype(np.int32))
        numbered = pa.StringArray.from_buffers(len(cuts), offsets, pa.py_buffer(data)).dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not self.spaced:
            # This vocabulary is one of lower case.
            bare = [p.strip(" \t\n\r") for p in distinct]
            bare = [p.lower() if p.isascii() else p for p in bare]
            kinds = list(dict.fromkeys(p for p in bare if p))
            known = dict(zip(kinds, self._lookup(kinds)))
            known[""] = b""
            ids = [known[p] for p in bare]
        else:
            ids = self._lookup(distinct)
        gathered = pa.array([i or b"" for i in ids], pa.binary()).take(numbered.indices)
        _, upto, joined = gathered.buffers()
        upto = np.frombuffer(upto, np.int32)[: len(cuts) + 1] // self.type.itemsize
        out = np.frombuffer(joined or b"", self.type)
        place = np.searchsorted(cuts, np.r_[0, ends])
        found = [out[upto[a] : upto[b]] for a, b in zip(place[:-1].tolist(), place[1:].tolist())]
        whole = np.array([i is False for i in ids], dtype=bool)
        if whole.any():
            owner = np.searchsorted(ends, cuts[whole[numbered.indices.to_numpy()]], side="right")
            for i in np.unique(owner).tolist():
                text = data[ends[i] - sizes[i] : ends[i]].tobytes().decode()
                found[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.type)
        return found

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def encode_column(self, column: pa.Array):
        """Ids of every text of an Arrow column in order (null: empty), some texts at a time."""
        texts = pc.fill_null(column, "").cast(pa.large_string())
        _, places, raw = texts.buffers()
        if not len(texts):
            return
        places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(raw or b"", np.uint8)
        low = 0
        while low < len(texts):
            # As many texts as a block holds, one at least.
            high = max(low + 1, int(np.searchsorted(places, places[low] + BLOCK_BYTES, side="right")) - 1)
            yield from self._encode_block(data[places[low] : places[high]], places[low + 1 : high + 1] - places[low])
            low = high


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    kept = worker_cache().__dict__.setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path, spaced)
    return kept[path]
