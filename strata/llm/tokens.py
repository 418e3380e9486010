"""Token ids of whole texts with a public tokenizer file.

``Encoder`` (tokenizers library) and ``PieceEncoder`` (sentencepiece) encode a
text piecewise and remember the ids of each distinct piece. The supported
kinds split at white space and between a letter and a punctuation mark before
any merge, or have no vocabulary entry across these places, so ids of pieces,
joined, equal the ids of the whole text. Other kinds are encoded whole.

Texts are first cut at every space, by Arrow: a unit is a space and what follows
it. A piece never reaches over a space that no other space follows, so the ids
of units, joined, are those of the text too. Only the distinct units of a batch
are cut into pieces, only the distinct pieces looked up; Arrow puts their ids
back in the places of the text.
"""

from __future__ import annotations

import contextlib
import gc
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bound of each of an encoder's two generations of remembered pieces
CACHE_BYTES = 48 << 20
#: texts that are encoded at once, so that a piece is looked up once for many uses
GROUP_BYTES = 8 << 20

_WS = "\t-\r \x85\xa0  -     　"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
# a word up to a following mark, or any other run up to white space
_RUN = f"[{_LETTERS}]++(?:(?=[.,!?;:%&$*#|])|[^{_WS}]*+)|[^{_WS}]++"
_KEEP_SPACE = re.compile(f"[ ]?(?:{_RUN})|[{_WS}]+(?![^{_WS}])|[{_WS}]")
_DROP_SPACE = re.compile(f"[ ](?:{_RUN})?|{_RUN}")


def _listed(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each span, one after another."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _spaced(piece: str) -> bool:
    """Whether the piece is a space and something that isn't."""
    return piece[:1] == " " and piece[1:2] != "" and not piece[1:2].isspace()


@contextlib.contextmanager
def no_cycles() -> Iterator[None]:
    """Without the cyclic collector, which would walk the remembered pieces
    again and again; nothing here makes cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class _Remembering:
    """Ids of pieces, remembered in two generations of at most ``cache_bytes``
    each: when the younger is full it becomes the older one, and pieces met
    again move back."""

    ENTRY = 160  # bytes of a piece, its ids and their place in a dict, without the characters

    def __init__(self, cache_bytes: int):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cache_bytes, self.size = cache_bytes, 0

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _learn(self, pieces: set[str]) -> None:
        known = pieces & self.old.keys()
        new = list(pieces - known)
        if self.size > self.cache_bytes:
            self.old, self.young, self.size = self.young, {}, 0
        self.young.update((x, self.old[x]) for x in known if x in self.old)
        new += [x for x in known if x not in self.young]  # of a generation that has just gone
        self.young.update(zip(new, self._encode_pieces(new), strict=True))
        self.size += self.ENTRY * len(pieces) + 2 * sum(map(len, pieces))

    def coded(self, flat: list[str]) -> list[bytes]:
        """Ids of each piece."""
        coded = list(map(self.young.get, flat))
        missing, i = [], -1
        with contextlib.suppress(ValueError):  # no further piece is unknown
            while True:
                missing.append(i := coded.index(None, i + 1))
        if missing:
            self._learn({flat[i] for i in missing})
            for i in missing:
                coded[i] = self.young[flat[i]]
        return coded

    def joined(self, split: list[list[str]]) -> list[bytes]:
        """Ids of texts given as their pieces."""
        coded = self.coded(list(chain.from_iterable(split)))
        return [b"".join(coded[i:j]) for i, j in pairwise(accumulate(map(len, split), initial=0))]


class Encoder(_Remembering):
    """Encodes lists of texts to little-endian unsigned 32-bit ids.

    A special token's string in a text is that token, as the library has it,
    or ordinary text with ``special_as_text``. NULL counts as the empty text.
    """

    def __init__(self, path: str, special_as_text: bool = False, cache_bytes: int = CACHE_BYTES):
        super().__init__(cache_bytes)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()
                 if not (special_as_text and t.special)]
        self.special = re.compile("|".join(map(re.escape, added))).search if added else None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        steps = [s.get("type") for s in norm.get("normalizers", [])]
        split = (pre.get("pretokenizers") or [{}])[0]
        self.lower = "Lowercase" in steps
        self.pieces = self.word = None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            self.pieces, self.word, self.glue = _KEEP_SPACE, _spaced, ""
            self.begins, self.ends = self._ids(lambda t: t.startswith("\u0120")), None  # a space, as this kind spells it
        elif split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert"):
            self.pieces, self.word, self.glue = _DROP_SPACE, re.compile(f" ?[{_LETTERS}]+").fullmatch, " "
            suffix = spec["model"].get("end_of_word_suffix") or ""
            self.begins, self.ends = None, self._ids(lambda t: bool(suffix) and t.endswith(suffix))

    def _ids(self, wanted) -> np.ndarray:
        vocab = self.tokenizer.get_vocab()
        flags = np.zeros(max(vocab.values()) + 1, dtype=bool)
        flags[[i for t, i in vocab.items() if wanted(t)]] = True
        return flags

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of single words, encoded together and cut where the ids show
        that a word begins or ends."""
        joined = self.glue.join([w.lstrip(" ") for w in words]) if self.glue else "".join(words)
        ids = np.frombuffer(self._encode([joined])[0], dtype="<u4")
        cuts = np.flatnonzero(self.begins[ids]) if self.begins is not None else np.flatnonzero(self.ends[ids]) + 1
        at = [*(cuts * 4).tolist(), len(ids) * 4] if self.begins is not None else [0, *(cuts * 4).tolist()]
        if len(at) != len(words) + 1:
            return self._encode(words)
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        words = [x for x in pieces if self.word(x)]
        coded = {}
        for i in range(0, len(words), 512):
            coded.update(zip(words[i:i + 512], self._encode_words(words[i:i + 512]), strict=True))
        others = [x for x in pieces if x not in coded]
        coded.update(zip(others, self._encode(others), strict=True))
        return [coded[x] for x in pieces]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if self.pieces is None:
            return self._encode(texts)
        whole = [i for i, t in enumerate(texts) if self.special(t)] if self.special else []
        coded = dict(zip(whole, self._encode([texts[i] for i in whole]), strict=True))
        if self.lower:  # ASCII only: other letters are the tokenizer's business
            texts = [t.encode().lower().decode() for t in texts]
        if not self.glue:  # spaces in a row can be one piece
            wide = [i for i, t in enumerate(texts) if "  " in t and i not in coded]
            coded |= zip(wide, self.joined([self.pieces.findall(texts[i]) for i in wide]), strict=True)
        out = self._by_units(["" if i in coded else t for i, t in enumerate(texts)])
        for i, x in coded.items():
            out[i] = x
        return out

    def _cut(self, units: pa.Array) -> tuple[list[str], np.ndarray]:
        """The pieces of units, and where those of each unit begin (and end)."""
        # a unit that begins with white space could join with the one before
        if len(units) and not pc.any(pc.match_substring_regex(units, f"^(?:$|[{_WS}])")).as_py():
            whole = pa.ListArray.from_arrays(pa.array([0, len(units)], pa.int32()), units)
            flat = self.pieces.findall(" " + pc.binary_join(whole, pa.scalar(" ", units.type))[0].as_py())
            begins = np.flatnonzero(pc.starts_with(pa.array(flat, pa.large_string()), " ").to_numpy(zero_copy_only=False))
            if len(begins) == len(units):
                return flat, np.append(begins, len(flat))
        split = [self.pieces.findall(" " + x) for x in _listed(units)]
        return list(chain.from_iterable(split)), np.cumsum([0, *map(len, split)])

    def _by_units(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        pieces, at = self._cut(coded.dictionary)
        places = coded.indices.to_numpy().astype(np.int64)
        if not self.glue:  # no space before the first
            first = [self.pieces.findall(t.partition(" ")[0]) for t in texts]
            places[ends[:-1]] = np.arange(len(at) - 1, len(at) - 1 + len(texts))
            at = np.append(at, at[-1] + np.cumsum([len(x) for x in first]))
            pieces += chain.from_iterable(first)
        distinct = pa.array(pieces, pa.large_string()).dictionary_encode()
        ids = pa.array(self.coded(_listed(distinct.dictionary)), pa.large_binary())
        size = np.diff(at)[places]
        found = ids.take(pa.array(distinct.indices.to_numpy()[_spans(at[places], size)]))
        if not len(found):
            return [b""] * len(texts)
        upto = np.frombuffer(found.buffers()[1], dtype="<i8")
        upto = upto[np.append(0, np.cumsum(size))[ends]].tolist()
        raw = memoryview(found.buffers()[2] or b"")
        return [bytes(raw[i:j]) for i, j in pairwise(upto)]

    def entries(self) -> list[bytes]:
        """Bytes of every id of a byte-level tokenizer."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that are spelled as themselves
        spelled = {chr(b): b for b in plain}
        spelled |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        out = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            out[i] = bytes(spelled[c] for c in t)
        return out


class PieceEncoder(_Remembering):
    """As ``Encoder`` for a sentencepiece model; control strings in a text are
    ordinary text and the model's space before a text is added."""

    SPACE = "\u2581"  # how the model spells a space

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        super().__init__(cache_bytes)
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        self.spelling = [self.model.id_to_piece(i) for i in range(size)]
        entries = [p for i, p in enumerate(self.spelling) if not self.model.is_byte(i)]
        letter = re.compile(f"[{_LETTERS}]").fullmatch
        beside = {x if letter(y) else y for p in entries for x, y in zip(p, p[1:], strict=False) if letter(x) or letter(y)}
        marks = re.escape("".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in beside))
        self.pieces = re.compile(
            f" *+(?:[{_LETTERS}]++(?=[{marks} \n]|$)|[{marks}]++(?=[{_LETTERS} \n]|$)|[^ \n]++)| ++|\n").findall
        probe = self.model.encode("\n")
        self.lead = len(probe)
        self.entries_of_text = entries
        # pieces are encoded after a line end, which must join with nothing
        self.split = len(probe) == 2 and self.model.is_byte(probe[1]) and not any(
            re.search(f"[^{self.SPACE}]{self.SPACE}|\n", p) for p in entries)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        return [array("I", x[self.lead:]).tobytes() for x in self.model.encode(["\n" + p for p in pieces], num_threads=1)]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if t and (not self.split or self.SPACE in t)}
        out = self.joined([self.pieces(" " + t) if t and i not in whole else [] for i, t in enumerate(texts)])
        for i in whole:
            out[i] = array("I", self.model.encode(texts[i])).tobytes()
        return out

    def entries(self) -> list[bytes]:
        """Bytes of every id."""
        return [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else
                b"" if self.model.is_control(i) or self.model.is_unknown(i) else p.replace(self.SPACE, " ").encode()
                for i, p in enumerate(self.spelling)]


class BothEncoder(_Remembering):
    """Ids by two encoders at once, from one pass over each text's pieces: runs
    up to a mark or white space, with the white space before them. Texts come
    with the space that the second encoder would add."""

    ENTRY = 330

    def __init__(self, a: Encoder, b: PieceEncoder, cache_bytes: int = 3 * CACHE_BYTES // 2):
        super().__init__(cache_bytes)
        self.a, self.b = a, b
        self.pieces = re.compile(f"[{_WS}]*+(?:{_RUN})|[{_WS}]++").findall
        self.split = a.pieces is _KEEP_SPACE and a.special is None and b.split
        # texts with white space that joins with something in the second vocabulary are encoded apart
        joining = {c for p in b.entries_of_text if len(p) > 1 for c in p if re.match(f"[{_WS}]", c)}
        self.apart = re.compile(f"[{b.SPACE}{re.escape(''.join(joining))}]").search

    def _encode_pieces(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        return list(zip(self.a._encode_pieces(pieces), self.b._encode_pieces(pieces), strict=True))

    def __call__(self, spaced: list[str]) -> tuple[list[bytes], list[bytes]]:
        if not self.split:
            return self.a(spaced), self.b([t[1:] for t in spaced])
        apart = [i for i, t in enumerate(spaced) if self.apart(t)]
        split = [self.pieces(t) for t in spaced]
        for i in apart:
            split[i] = []
        flat = self.coded(list(chain.from_iterable(split)))
        ends = list(accumulate(map(len, split), initial=0))
        out = tuple([b"".join([x[k] for x in flat[i:j]]) for i, j in pairwise(ends)] for k in (0, 1))
        for i in apart:
            out[0][i], out[1][i] = self.a([spaced[i]])[0], self.b([spaced[i][1:]])[0]
        return out


_encoders: dict[tuple, _Remembering] = {}


def encoder(path: str, special_as_text: bool = False, cache_bytes: int = CACHE_BYTES) -> Encoder:
    """The process's encoder for a tokenizer file (its cache outlives a task)."""
    key = (path, special_as_text, cache_bytes)
    if key not in _encoders:
        _encoders[key] = Encoder(path, special_as_text, cache_bytes)
    return _encoders[key]


def piece_encoder(path: str) -> PieceEncoder:
    """As ``encoder``, for a sentencepiece model."""
    if (path,) not in _encoders:
        _encoders[path,] = PieceEncoder(path)
    return _encoders[path,]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
