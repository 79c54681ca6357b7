"""Token ids from the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re

import numpy as np

#: Pieces a worker remembers. Style "word" forgets all when full and starts again; style "byte" forgets, at every half, what
#: it did not meet since the half before. Speed only, never results.
REMEMBERED = 500_000

# Characters up to U+024F whose class and lower case are the same in every Unicode version; others take the plain path.
_SIMPLE = re.compile("[\\t\\n\\r -~\u00a0-\u012f\u0131-\u024f]*").fullmatch
_L, _N, _S = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\\t\\n\\r \u00a0"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
# letters stand before the endings, which begin with no letter or space: most pieces are words
_BYTE_LEVEL = re.compile(f" [{_L}]+|[{_L}]+|{_ENDINGS}| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
_WORD_LEVEL = re.compile(f"{_ENDINGS}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+").findall

#: The character that byte-level BPE writes for each byte: printable bytes stand for themselves, the others come after 255.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)}.difference(_PRINTABLE)))}


class Known(dict):
    """What `find` gives for a key, found once."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key):
        found = self[key] = self.find(key)
        return found


class Encoder:
    """Ids of texts as little-endian integers, equal to `Tokenizer.encode(text, add_special_tokens=False)`.

    style "byte" is for byte-level BPE with the usual splitting pattern, "word" for lower-case BPE with word ends,
    "plain" for any other tokenizer. The first two split simple texts (Latin letters) as the tokenizer itself does and
    remember the ids of each piece; unknown pieces go to the library (together in style "word", in style "byte" one by one
    and straight to its model, since each is what the model is given). Other texts go to it whole, and so do texts
    that hold an added token such as <|endoftext|>, which the library does not split.
    """

    def __init__(self, path: str, style: str, dtype: str = "<u2", remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.style, self.dtype, self.remembered = style, np.dtype(dtype), remembered
        if self.library.get_vocab_size() > np.iinfo(self.dtype).max:
            raise ValueError(f"{dtype} is too narrow for {self.library.get_vocab_size()} ids")
        self.known: dict[str, bytes] = {}
        # in lower case: a superset of the texts in which the library may find an added token
        self.added = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        if style == "word":
            self.closes = np.zeros(self.library.get_vocab_size(), bool)
            for token, i in self.library.get_vocab().items():
                self.closes[i] = token.endswith("</w>")
        elif style == "byte":
            self.model = self.library.model
            self.known = Known(self._piece)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        name = piece.encode().decode("latin-1").translate(_BYTE_NAMES)
        return np.array([token.id for token in self.model.tokenize(name)], self.dtype).tobytes()

    def _renew(self) -> None:
        """Pieces known so far are taken over when they are met again; what was known before them is forgotten."""
        older = dict(self.known)
        self.known = Known(lambda piece: older.get(piece) or self._piece(piece))

    def _learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 1000):
            part = pieces[at : at + 1000]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.closes[ids]) + 1
            starts = np.append(0, ends[:-1])
            if len(ends) != len(part):
                self.known.update((p, self._whole(p)) for p in part)
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            self.known.update(zip(part, (raw[a:b] for a, b in zip((starts * width).tolist(), (ends * width).tolist()))))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if self.style == "plain":
            return [self._whole(t or "") for t in texts]
        out: list = []
        for text in texts:
            lowered = text.lower() if text else ""
            if text and _SIMPLE(text) and not any(token in lowered for token in self.added):
                out.append(_BYTE_LEVEL(text) if self.style == "byte" else _WORD_LEVEL(lowered))
            else:
                out.append(self._whole(text) if text else b"")
        if self.style == "byte":
            if len(self.known) > self.remembered // 2:
                self._renew()
            find = self.known.__getitem__
            return [b"".join(map(find, x)) if isinstance(x, list) else x for x in out]
        if len(self.known) > self.remembered:
            self.known = {}
        unknown: set[str] = set()
        for pieces in out:
            if isinstance(pieces, list):
                unknown.update(pieces)
        self._learn(list(unknown.difference(self.known)))
        find = self.known.__getitem__
        return [b"".join(map(find, x)) if isinstance(x, list) else x for x in out]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, style: str, dtype: str = "<u2") -> Encoder:
    """One per worker process and tokenizer, so that what it remembers lasts between tasks."""
    if (path, style, dtype) not in _encoders:
        _encoders[path, style, dtype] = Encoder(path, style, dtype)
    return _encoders[path, style, dtype]
