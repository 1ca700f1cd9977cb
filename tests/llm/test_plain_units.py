"""Units of plain characters are encoded by pre-tokens: the ids are the library's, and no word is encoded again for its marks."""

import random
import re

import numpy as np
import pyarrow as pa

from strandline.llm import _tokens


class _Seen:
    """A tokenizer that keeps what it is given."""

    def __init__(self, own, texts):
        self._own, self._texts = own, texts

    def __getattr__(self, name):
        return getattr(self._own, name)

    def encode_batch_fast(self, texts, **options):
        self._texts.extend(texts)
        return self._own.encode_batch_fast(texts, **options)


def test_a_word_is_encoded_once_whatever_stands_about_it(monkeypatch):
    path, seen = _tokens.tokenizer_path(), []
    for name in ("tokenizer", "model_alone"):
        if hasattr(_tokens, name):
            own = _Seen(getattr(_tokens, name)(path), seen)
            monkeypatch.setattr(_tokens, name, lambda _, own=own: own)
    encoder = _tokens.Encoder(path)
    encoder.encode(["x strandline"])
    del seen[:]
    encoder.encode(["x strandline, strandline; strandline\nBut strandline's strandline!) strandline-2."])
    assert not any("strandline" in x for x in seen)


def test_plain_units_have_the_ids_of_the_library():
    path = _tokens.tokenizer_path()
    t, rng = _tokens.tokenizer(path), random.Random(5)
    plain = [c for c in map(chr, range(1, 0x20AD)) if re.fullmatch(rf"[{_tokens._LETTERS}0-9{_tokens._MARKS}]", c)]
    assert len(plain) > 700
    parts = ["'s", "'ll", "'re", "n't", "''", "\n", "\n\n", "\t", "\r\n", " ", " ", " ", "  ", "<|endoftext|>", " ", " ", "漢字、", "\x01", "\x00", "😀", "²", "word", "été", ""]
    texts = [f"a{c}b {c}1 x{c} {c}{c}\n{c} '{c} {c}" for c in plain]
    texts += ["".join(rng.choice(parts if rng.random() < 0.5 else plain) for _ in range(rng.randrange(40))) for _ in range(4000)]
    want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    for batch_bytes in (500, 1 << 20):
        encoder = _tokens.Encoder(path)
        assert encoder.plain
        got = [encoder.encode(texts[k : k + batch_bytes // 50]) for k in range(0, len(texts), batch_bytes // 50)]
        assert [np.frombuffer(x, "<u4").tolist() for xs in got for x in xs] == want
    assert encoder.encode([]) == [] and list(_tokens.encoded(pa.array([], pa.string()), path)) == []


def test_memory_of_units_is_bounded_and_changes_nothing(monkeypatch):
    path, rng = _tokens.tokenizer_path(), random.Random(6)
    monkeypatch.setattr(_tokens, "MOST_UNITS", 30)
    own, words = _tokens.Encoder(path), ["".join(rng.choices("abcdeé", k=3)) for _ in range(90)]
    for _ in range(30):
        text = " ".join(rng.choice(words) + rng.choice(["", ",", ".", ".\nIt", "'s"]) for _ in range(20))
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == _tokens.tokenizer(path).encode(text, add_special_tokens=False).ids
        assert len(own.known) <= 30 + 2 * 20 and len(own.older) <= 30 + 2 * 20 and len(own.bare) <= 30 + 2 * 20
