"""Encoding texts with a public tokenizer file, inside tasks.

Some tokenizers cut texts into runs of letters, digits and marks before anything else, so that no token and no
rule reaches from one to the next. For those a text's tokens are the tokens of its runs one after the other, and
a worker asks the library for each different run once. Others are given whole texts.
"""

from __future__ import annotations

import json
import re
from functools import cache, cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from tidegauge.llm.words import SPACE, ragged, text_bytes

#: Different pieces that a worker remembers before it starts anew.
REMEMBERED = 1_000_000


#: Fixed value: the runs of characters that a tokenizer without white space encodes apart.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_ONE_RUN = re.compile(r"[a-z]+|[0-9]|[!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{}~]+")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LETTER, _DIGIT, _MARK, _OTHER = 1, 2, 3, 4
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
_KIND[list(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{}~")] = _MARK
_KIND[SPACE] = 0


def segments(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts that a tokenizer with ``RUNS`` encodes apart, and the number of pieces of each text.

    Texts are cut at ASCII white space and where ASCII letters, marks and single digits meet: there a run ends, and
    neither composition of characters nor an added token (in ``<|`` and ``|>``) reaches over it. Apostrophes,
    ``<``, ``|`` and bytes beyond ASCII are never cut off. Pieces of ASCII are lower-cased, as the tokenizer does.
    """
    data, offsets = text_bytes(column)
    kind = _KIND[data]
    solid = kind > 0
    cut = np.empty_like(solid)
    cut[:1] = True
    cut[1:] = ((kind[1:] != kind[:-1]) & (kind[1:] != _OTHER) & (kind[:-1] != _OTHER)) | (kind[1:] == _DIGIT) & (kind[:-1] == _DIGIT)
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    # a piece of other bytes begins behind white space, too
    cut[1:] |= (kind[:-1] == 0) & solid[1:]
    starts = np.flatnonzero(cut & solid)
    keep = data[solid]
    at = (np.cumsum(solid) - 1)[starts] if len(starts) else starts
    if len(starts):
        other = np.add.reduceat((kind[solid] == _OTHER).astype(np.int32), at) > 0
        lengths = np.diff(np.append(at, len(keep)))
        upper = (keep >= 65) & (keep <= 90) & ~np.repeat(other, lengths)
        keep = keep + upper.astype(np.uint8) * np.uint8(32)
    ends = np.append(at, len(keep)).astype(np.int32)
    strings = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(keep))
    return strings, np.diff(np.searchsorted(starts, offsets))


class Vocabulary:
    """A tokenizer file (``.json`` for tokenizers, ``.model`` for sentencepiece), without special tokens added."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.path, self.remembered = path, remembered
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = None
        else:
            self.library = Tokenizer.from_file(path)
            self.pieces = None
        self._forget()

    @cached_property
    def words_apart(self) -> bool:
        """Whether the file splits texts into the runs below, by its own description (see ``segments``)."""
        if self.library is None:
            return False
        with open(self.path, encoding="utf-8") as f:
            told = json.load(f)
        steps = (told["normalizer"] or {}).get("normalizers", [])
        first = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        added = [t["content"] for t in told["added_tokens"] if not t["lstrip"] and not t["rstrip"]]
        return (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": "\\s+"}, " ")
            and (first.get("type"), first.get("behavior"), first.get("invert")) == ("Split", "Removed", True)
            and first["pattern"] == {"Regex": RUNS}
            and len(added) == len(told["added_tokens"])
            and all(re.fullmatch(r"<\|\w+\|>", t) for t in added)
        )

    @property
    def size(self) -> int:
        return self.library.get_vocab_size() if self.library else self.pieces.get_piece_size()

    def whole(self, texts: list[str]) -> list[list[int]]:
        if self.library:
            return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return self.pieces.encode(texts, num_threads=1)

    def offsets(self, text: str) -> np.ndarray:
        """Where each token of a text begins, in code points."""
        if self.library:
            found = self.library.encode(text, add_special_tokens=False).offsets
            return np.fromiter((a for a, _ in found), np.int64, len(found))
        found = self.pieces.encode(text, out_type="immutable_proto").pieces
        return np.fromiter((p.begin for p in found), np.int64, len(found))

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.begins = np.zeros(1, np.int64)

    def _places(self, distinct: list[str]) -> np.ndarray:
        """The number under which each of these different words is remembered; new words are encoded."""
        if len(self.places) + len(distinct) > self.remembered:
            self._forget()
        found = np.fromiter(map(self.places.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown.tolist()]
            ids = self._runs(new)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            found[unknown] = np.arange(len(self.places), len(self.places) + len(new))
            self.places.update(zip(new, found[unknown].tolist()))
            self.ids = np.concatenate([self.ids, flat])
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(lengths)])
        return found

    @cached_property
    def _spelled(self) -> dict[int, str]:
        """How the library spells lower-case letters of Latin-1 for its merges."""
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {ord(c): spell(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}

    def _runs(self, pieces: list[str]) -> list[list[int]]:
        """The ids of pieces of ``segments``. A piece that is one run for sure goes straight to the library's merges."""
        merge, spelled, other = self.library.model.tokenize, self._spelled, []
        out: list[list[int]] = []
        for piece in pieces:
            if piece.isascii() and _ONE_RUN.fullmatch(piece):
                out.append([t.id for t in merge(piece)])
            elif _LATIN.fullmatch(piece):
                out.append([t.id for t in merge(piece.lower().translate(spelled))])
            else:
                other.append(len(out))
                out.append([])
        for i, ids in zip(other, self.whole([pieces[i] for i in other])):
            out[i] = ids
        return out

    def _remembered(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The remembered number of every piece, and the count of pieces of each text."""
        pieces, counts = segments(column)
        if not len(pieces):
            return np.empty(0, np.int64), counts
        pieces = pieces.dictionary_encode()
        # by numpy: some ten times faster than to_pylist
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        return self._places(distinct)[pieces.indices.to_numpy(zero_copy_only=False)], counts

    def counts(self, column: pa.Array) -> np.ndarray:
        """The number of tokens of each text; nulls are empty."""
        if not self.words_apart:
            return np.array([len(x) for x in self.whole([x or "" for x in column.to_pylist()])], np.int64)
        places, words = self._remembered(column)
        sums = np.concatenate([[0], np.cumsum(np.diff(self.begins)[places])])
        ends = np.cumsum(words)
        return sums[ends] - sums[ends - words]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each; nulls are empty."""
        if not self.words_apart:
            found = self.whole([x or "" for x in column.to_pylist()])
            counts = np.array([len(x) for x in found], np.int64)
            return np.fromiter((i for ids in found for i in ids), np.int32, int(counts.sum())), counts
        places, words = self._remembered(column)
        lengths = np.diff(self.begins)[places]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(words)
        return self.ids[ragged(self.begins[places], lengths)], sums[ends] - sums[ends - words]


@cache
def vocabulary(path: str, remembered: int = REMEMBERED) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path, remembered)


def public(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)

