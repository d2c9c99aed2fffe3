"""Encoding texts inside tasks. The tokenizers library encodes every distinct stretch once; texts are joined from them."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stretches remembered per Python worker (about 200 bytes each; as many older ones), and the longest that is remembered.
REMEMBERED = 450_000
LONGEST = 64

_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
#: White space at an end or next to white space.
_UNEVEN = rf"\A[{_SPACES}]|[{_SPACES}]\z|[{_SPACES}][{_SPACES}]"
#: A word of Latin-1 letters, and one with up to three marks behind it. Both tokenizers cut between letters and marks.
_WORD = r"\n?[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKED = rf"\A(?P<stem>{_WORD})(?P<marks>[!-&(-/:-@\[-`{{-~]{{1,3}})\z"
_SAFE_CUT = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))")
#: Words that are encoded as one text.
_TOGETHER = 20_000


class Encoder:
    """Token ids of texts as packed little-endian integers of ``dtype``.

    A text is cut where the tokenizer surely cuts too, so that the parts' ids are the text's ids. With ``spaced`` (byte
    level) that is before a single space or line feed between two other characters, which belongs to what follows; without
    it (white space is dropped by the tokenizer) at every space and line feed.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = spaced
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values(), default=0) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        #: Tokens at the border of two words: with ``spaced`` those that begin with a space or line feed, else the last of a word.
        self.border = np.zeros(size, bool)
        self.border[[i for t, i in vocabulary.items() if (t[:1] in ("Ġ", "Ċ") if spaced else t.endswith("</w>"))]] = True

    def direct(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        if self.dtype.itemsize == 2 and sys.byteorder == "little":
            return [array("H", e.ids).tobytes() for e in encoded]
        return [np.array(e.ids, self.dtype).tobytes() for e in encoded]

    def words(self, words: list[str]) -> list[bytes]:
        """``direct`` of words of letters, many in one text that is cut at the tokens of their borders.

        With ``spaced`` a space or line feed is in front of each.
        """
        out: list[bytes] = []
        width = self.dtype.itemsize
        for begin in range(0, len(words), _TOGETHER):
            part = words[begin : begin + _TOGETHER]
            raw = self.direct([("" if self.spaced else " ").join(part)])[0]
            at = np.flatnonzero(self.border[np.frombuffer(raw, self.dtype)]) * width
            if len(at) != len(part):  # a tokenizer without such borders
                out += self.direct(part)
                continue
            edges = [*at.tolist(), len(raw)] if self.spaced else [0, *(at + width).tolist()]
            out += [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return out

    def cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Stretches of all texts, in which order the texts come there, and how many each has."""
        rows = pa.array(texts, pa.large_string())
        order = np.arange(len(texts))
        if not self.spaced:
            lists = pc.split_pattern(pc.replace_substring(rows, "\n", " "), " ")
            return lists.flatten(), order, np.diff(lists.offsets.to_numpy())
        uneven = pc.match_substring_regex(rows, _UNEVEN).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.replace_substring(rows.filter(pa.array(~uneven)), "\n", " \n"), " ")
        own = [_SAFE_CUT.split(texts[i]) for i in np.flatnonzero(uneven)]
        stretches = pa.concat_arrays([lists.flatten(), pa.array([s for c in own for s in c], pa.large_string())])
        counts = np.concatenate([np.diff(lists.offsets.to_numpy()), np.array([len(c) for c in own], np.int64)])
        return stretches, np.concatenate([order[~uneven], order[uneven]]), counts

    def learnt(self, stretches: list[str], plain: np.ndarray) -> list[bytes]:
        """Ids of distinct stretches, remembered; ``plain`` tells words of Latin-1 letters."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        ids = list(map(self.known.get, stretches))
        words: list[int] = []
        others: list[int] = []
        for i in [i for i, x in enumerate(ids) if x is None]:
            if (found := self.older.get(stretches[i])) is not None:
                ids[i] = self.known[stretches[i]] = found
            else:
                (words if plain[i] else others).append(i)
        for places, encoded in ((others, self.direct), (words, self.words)):
            own = [stretches[i] for i in places]
            behind = [u if u[:1] == "\n" else " " + u for u in own] if self.spaced else own
            for i, u, x in zip(places, own, encoded(behind), strict=True):
                ids[i] = x
                if len(u) <= LONGEST:
                    self.known[u] = x
        return ids

    def marked(self, marks: list[str]) -> list[bytes]:
        """Ids of distinct marks, remembered."""
        if len(self.marks) > REMEMBERED:
            self.marks = {}
        new = [m for m in marks if m not in self.marks]
        self.marks.update(zip(new, self.direct(new), strict=True))
        return [self.marks[m] for m in marks]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        texts = list(texts)
        if not texts:
            return []
        stretches, order, counts = self.cut(texts)
        firsts = None
        if self.spaced:
            # Nothing is in front of a text's first stretch.
            rest = np.ones(len(stretches), bool)
            rest[np.cumsum(counts) - counts] = False
            firsts = self.direct(stretches.filter(pa.array(~rest)).to_pylist())
            stretches, counts = stretches.filter(pa.array(rest)), counts - 1
        coded = stretches.dictionary_encode()
        # A word of Latin-1 letters and the marks behind it are encoded apart.
        parts = pc.extract_regex(coded.dictionary, _MARKED)
        stems = pc.coalesce(pc.struct_field(parts, "stem"), coded.dictionary).dictionary_encode()
        marks = pc.fill_null(pc.struct_field(parts, "marks"), "").dictionary_encode()
        plain = pc.match_substring_regex(stems.dictionary, rf"\A{_WORD}\z").to_numpy(zero_copy_only=False)
        ids = self.learnt(stems.dictionary.to_pylist(), plain)
        n_stems = len(ids)
        ids += self.marked(marks.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(ids), self.dtype)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        pairs = np.stack([stems.indices.to_numpy(), n_stems + marks.indices.to_numpy()], axis=1)
        flat = gathered(flat, lengths, pairs.ravel())
        lengths = lengths[pairs].sum(axis=1)
        places = coded.indices.to_numpy()
        raw = gathered(flat, lengths, places).tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths[places])])[np.cumsum(counts)] * self.dtype.itemsize
        out = [b""] * len(texts)
        begin = 0
        for j, (i, end) in enumerate(zip(order.tolist(), ends.tolist(), strict=True)):
            out[i] = firsts[j] + raw[begin:end] if firsts is not None else raw[begin:end]
            begin = end
        return out


def gathered(flat: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of runs of ``lengths`` that lie one behind the other in ``flat`` those at ``places``, one behind the other."""
    own = lengths[places]
    begins = (np.cumsum(lengths) - lengths)[places]
    return flat[np.repeat(begins - (np.cumsum(own) - own), own) + np.arange(own.sum())]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """One per Python worker, with what it remembers; workers are used again by later tasks."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced)
    return _ENCODERS[path, spaced]


def slices(texts: list[str], most: int = 4_000_000) -> Iterable[slice]:
    """Runs of texts of about ``most`` characters, so that a batch of long texts is not held in several forms."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))
