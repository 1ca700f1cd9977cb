"""Token ids by the tokenizers and sentencepiece libraries, loaded once in each worker process.

A text is cut into units at places where no token can lie across, each different unit of a batch is
encoded once by the library, and units met often stay known in the worker: a text's ids are its
units' ids one after another. Places are taken only where the tokenizer's own rules make them safe:

* a byte-level BPE with the usual pattern (no normaliser, no prefix space) ends a pre-token before
  the first white space after other characters, and before the last white space of a run if
  something follows. A single space is such a place unless white space stands on both its sides
  (or it ends the text, or stands before a special string, after other white space); such spaces stay inside their unit;
* between a CJK ideograph and a full-width mark, for a unit that is still very long;
* a sentencepiece model whose pieces hold the space mark only in front is cut at single spaces
  between words, if a probe gives equal ids.

Any other tokenizer gets every text whole.

A byte-level unit of plain letters, digits and marks is cut once more, into its pre-tokens (the library's
own pattern, over classes of characters that no version of Unicode disputes), so that a word is encoded once
whatever marks and line ends stand about it. The library's model gets them in the byte alphabet of the vocabulary,
apart from one another already; the library's pre-tokenizer, which costs more than its model, sees the other units only.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import json
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strandline.llm import _text

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

DEFAULT = "byte_bpe_50k.json"
#: Bytes of text whose units are looked up, and new ones encoded, together.
BATCH_BYTES = 1 << 23
#: Code points from which a unit is cut further, and up to which it is remembered.
PART = 1 << 16
REMEMBERED = 48
#: Units that are encoded in one text.
TOGETHER = 4096
#: Units in each of the two generations that a worker process remembers.
MOST_UNITS = 1 << 18

_CJK = re.compile("(?<=[一-鿿])(?=[、。！，：；？])")
_WORDS = re.compile(r"(?<=\w) (?=\w)")

_LETTERS = r"A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F\u0391-\u03A1\u03A3-\u03CE\u0400-\u0481"
_MARKS = r"!-/:-@\[-`{-~\u00A1-\u00A9\u00AB\u00AC\u00AE-\u00B1\u00B4\u00B6-\u00B8\u00BB\u00BF\u00D7\u00F7\u2010-\u2027\u2030-\u205E\u20AC"
#: A unit of plain characters, and its pre-tokens once a space is put before it.
_PLAIN = re.compile(rf"[{_LETTERS}0-9{_MARKS}]+(?:[\t\n\r]+[{_LETTERS}0-9{_MARKS}]+)*")
_PRE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\s+(?!\S)|\s+")
#: What stands between pre-tokens, and before each that no space goes before; no plain unit holds either.
_APART, _BEFORE = "\0", "\1"
_PROBE = "naïve Straße, it's 12:30!\n\n(«Ωδός»)\tЖук… o'mine ¿a_b?"


def _byte_letters() -> str:
    """The letter of each byte in a byte-level vocabulary; a space for _APART."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    letters = [chr(b) if b in own else chr(next(others)) for b in range(256)]
    letters[ord(_APART)] = " "
    return "".join(letters)


_BYTE_LETTERS = _byte_letters()


def tokenizer_path(name: str = DEFAULT) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def model_alone(path: str):
    """The tokenizer's own model behind cuts at white space, for pre-tokens in letters of bytes."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    out = Tokenizer(tokenizer(path).model)
    out.pre_tokenizer = WhitespaceSplit()
    return out


@functools.cache
def sentencepiece(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def cuttable(path: str) -> bool:
    """Whether single spaces are safe places for this tokenizer."""
    if path.endswith(".model"):
        sp = sentencepiece(path)
        inner = any("▁" in sp.id_to_piece(i)[1:].lstrip("▁") for i in range(sp.get_piece_size()))
        return not inner and sp.encode("one two, three") == [*sp.encode("one"), *sp.encode("two, three")]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    added = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"])) for x in spec["added_tokens"])
    return bool(plain and added and spec.get("normalizer") is None and spec.get("truncation") is None)


class Encoder:
    """Ids of texts as little-endian uint32 bytes."""

    def __init__(self, path: str):
        self.path, self.model = path, path.endswith(".model")
        self.safe = cuttable(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # pre-tokens that no space goes before
        self.plain = False
        if self.safe and not self.model:
            vocabulary = tokenizer(path).get_vocab()
            self.leads = np.zeros(max(vocabulary.values()) + 1, bool)
            self.leads[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
            self.special = [x.content for x in tokenizer(path).get_added_tokens_decoder().values()]
            special = "".join("|" + re.escape(x) for x in self.special)
            #: a space that is no safe place, and every space that is one
            self.unsafe = re.compile(rf"\s (?=\s|\Z{special})")
            self.places = re.compile(rf"(?<!\s) |(?<=\s) (?!\s|\Z{special})")
            self.before = vocabulary.get(_BYTE_LETTERS[ord(_BEFORE)])
            first, *rest = _PRE.findall(" " + _PROBE)
            self.plain = self.before is not None and [b"".join([*self._encode_apart([first[1:]]), *self._encode_apart(rest, bare=True)])] == self._encode([" " + _PROBE])

    def _encode(self, units: list[str]) -> list[bytes]:
        if self.model:
            found = sentencepiece(self.path).encode(units, num_threads=1)
        else:
            found = [x.ids for x in tokenizer(self.path).encode_batch_fast(units, add_special_tokens=False)]
        return [np.array(x, "<u4").tobytes() for x in found]

    def _encode_apart(self, pre: list[str], bare: bool = False) -> Iterator[bytes]:
        """The ids of each plain pre-token after a space, or with bare after none, many in one call of the library.

        In the ids a token with a space in front begins each pre-token, or one that is put before each.
        """
        lead = _BEFORE + _APART if bare else " "
        groups = [pre[k : k + TOGETHER] for k in range(0, len(pre), TOGETHER)]
        texts = [codecs.charmap_decode((lead + (_APART + lead).join(g)).encode(), "strict", _BYTE_LETTERS)[0] for g in groups]
        for own, x in zip(groups, model_alone(self.path).encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(x.ids, "<u4")
            at = np.flatnonzero(ids == self.before if bare else self.leads[ids])
            if len(at) != len(own):
                raise ValueError(f"{len(at)} of {len(own)} pre-tokens found again in their ids")
            data, at = ids.tobytes(), (at * 4).tolist()
            yield from [data[i + 4 * bare : j] for i, j in itertools.pairwise([*at, len(data)])]

    def _learn_plain(self, units: list[str]) -> None:
        """Enter the ids of each unit of plain characters after a space, and of the first pre-token of each."""
        known, older = self.known, self.older
        pairs = [(u, head) for u in units if (head := u.rstrip(string.punctuation)) != u and head.isalpha()]
        cut = {u: _PRE.findall(" " + u) for u in set(units).difference([u for u, _ in pairs]) if not u.isalpha()}
        firsts = {head for _, head in pairs}.union([pre[0][1:] for pre in cut.values()])
        firsts.difference_update([w for w in firsts if w in known])
        known.update([(w, older[w]) for w in firsts if w in older])
        words = [u for u in units if u.isalpha()]
        words += firsts.difference(words).difference(older)
        known.update(zip(words, self._encode_apart(words), strict=True))
        if len(self.bare) > MOST_UNITS:
            self.bare = {}
        bare = self.bare
        tails = {u[len(head) :] for u, head in pairs}.union(*[pre[1:] for pre in cut.values()])
        new = list(tails.difference(bare))
        bare.update(zip(new, self._encode_apart(new, bare=True), strict=True))
        known.update([(u, known[head] + bare[u[len(head) :]]) for u, head in pairs])
        known.update([(u, b"".join([known[pre[0][1:]], *[bare[p] for p in pre[1:]]])) for u, pre in cut.items()])

    def _plain(self, units: list[str]) -> list[str]:
        """Those units that consist of plain characters and hold no special string."""
        if not self.plain:
            return []
        own, joined = [u for u in units if _PLAIN.fullmatch(u)], _APART.join(units)
        for x in self.special:
            if x in joined:
                own = [u for u in own if x not in u]
        return own

    def _learn_spaced(self, units: list[str]) -> None:
        """Enter the ids of each unit after a space, many in one call of the library.

        Plain units go to the model by pre-tokens. Others without white space at their ends and spaces inside
        are encoded as one text: in its ids a token with a space in front begins each unit.
        """
        plain = self._plain(units)
        self._learn_plain(plain)
        units = list(set(units).difference(plain))
        odd = [u for u in units if not u or not u.isprintable() or " " in u]
        apart = [u for u in odd if not u or u[0].isspace() or u[-1].isspace() or " " in u]
        self.known.update(zip(apart, self._encode([" " + u for u in apart]), strict=True))
        if apart:
            units = list(set(units).difference(apart))
        groups = [units[k : k + TOGETHER] for k in range(0, len(units), TOGETHER)]
        for own, data in zip(groups, self._encode([" " + " ".join(g) for g in groups]), strict=True):
            at = np.flatnonzero(self.leads[np.frombuffer(data, "<u4")])
            if len(at) != len(own):
                raise ValueError(f"{len(at)} of {len(own)} units found again in their ids")
            at = (at * 4).tolist()
            self.known.update(zip(own, [data[i:j] for i, j in zip(at, [*at[1:], len(data)], strict=True)], strict=True))

    def units(self, text: str) -> list[str]:
        """The units of a text; all but the first stand after a single space, which is left out."""
        if not self.safe:
            return [text]
        if self.model:
            return _WORDS.split(text) if len(text) > PART else [text]
        return self.places.split(text) if self.unsafe.search(text) else text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; texts should be about BATCH_BYTES together.

        Arrow splits texts and numbers their different units, so that only these are Python strings.
        """
        easy = [k for k, t in enumerate(texts) if self.safe and not self.model and not self.unsafe.search(t)]
        odd = sorted(set(range(len(texts))).difference(easy))
        split = pa.array([self.units(texts[k]) for k in odd], pa.list_(pa.string()))
        if easy:
            split = pa.concat_arrays([pc.split_pattern(pa.array([texts[k] for k in easy], pa.string()), " "), split])
        every, offsets = split.flatten(), split.offsets.to_numpy()
        first = np.zeros(len(every), bool)
        first[offsets[:-1]] = True
        later = every.filter(pa.array(~first)).dictionary_encode()
        heads = _text.listed(every.filter(pa.array(first)))
        del split, every
        own = np.empty(len(first), np.int32)  # the place of each unit in found
        own[~first], own[first] = later.indices.to_numpy(), np.arange(len(heads)) + len(later.dictionary)
        units = _text.listed(later.dictionary)
        del later
        found = [*self._known_or_new(units), *self._heads(heads)]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        begin, length = (np.cumsum(sizes) - sizes)[own], sizes[own]
        end = np.concatenate([[0], np.cumsum(length)])
        ids = np.frombuffer(b"".join(found), "<u4")[np.arange(end[-1]) + np.repeat(begin - end[:-1], length)]
        cuts = end[offsets]
        return [ids[cuts[k] : cuts[k + 1]].tobytes() for k in np.argsort(easy + odd)]

    def _known_or_new(self, units: list[str]) -> list[bytes]:
        """The ids of each of some different units, which stand after a space."""
        if len(self.known) > MOST_UNITS:  # units that are met again move to the new generation
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        out = list(map(known.get, units))
        if older:
            again = [(k, x) for k, y in enumerate(out) if y is None and (x := older.get(units[k])) is not None]
            for k, x in again:
                out[k] = known[units[k]] = x
        new = [k for k, x in enumerate(out) if x is None]
        lead = "" if self.model else " "
        long_ = [k for k in new if len(units[k]) > REMEMBERED]
        short = [units[k] for k in new if len(units[k]) <= REMEMBERED]
        if self.model:
            known.update(zip(short, self._encode(short), strict=True))
        else:
            self._learn_spaced(short)
        for k in new:
            out[k] = known.get(units[k])
        for k in long_:
            out[k] = self._whole(lead + units[k])
        return out

    def _heads(self, units: list[str]) -> list[bytes]:
        """First units, which no space goes before, encoded in one call but for very long ones."""
        out = self._encode([u if len(u) <= PART else "" for u in units])
        return [self._whole(u) if len(u) > PART else x for u, x in zip(units, out, strict=True)]

    def _whole(self, unit: str) -> bytes:
        parts = _CJK.split(unit) if len(unit) > PART and self.safe and not self.model else [unit]
        return b"".join(self._encode(parts))


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(column: pa.Array, path: str, batch_bytes: int = BATCH_BYTES) -> Iterator[bytes]:
    """Ids of each text of an Arrow column (null: empty) as uint32 bytes, without added special tokens.

    Special strings in a text are special tokens, as is the library's default. Only about
    batch_bytes of the column are Python strings at any time.
    """
    own = encoder(path)
    _, offsets = _text.strings(column)
    for lo, hi in _text.blocks(offsets, batch_bytes):
        yield from own.encode([t or "" for t in column.slice(lo, hi - lo).to_pylist()])


def ids(text: str, path: str) -> np.ndarray:
    """Token ids of one text."""
    return np.frombuffer(encoder(path).encode([text])[0], "<u4")
