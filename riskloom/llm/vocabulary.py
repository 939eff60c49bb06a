"""Token ids by a public tokenizer, with the ids of frequent words kept.

A tokenizer that drops white space encodes each run of non-space characters
alone, so a text's ids are the ids of its pieces in turn. Pieces are kept in a
bounded dictionary per Python worker.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import regex

# Characters on which Python and the tokenizer agree about case, letters and
# digits; a text with any other character is encoded whole by the library.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-įı-ɏ]*")
# The tokenizer's own split (fixed values), and the same for lower-case ASCII.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
KEPT = 400_000
TOGETHER = 1 << 20
_encoders: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """The encoder of a tokenizer definition (JSON text), one per Python worker."""
    key = hash(definition)
    if key not in _encoders:
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def definition(path: str) -> str:
    """The tokenizer file as text: it travels with the task, so only the driver reads the path."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class Encoder:
    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = parts["model"].get("end_of_word_suffix")
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        kinds = [n["type"] for n in (parts.get("normalizer") or {}).get("normalizers", [])]
        # pieces can be kept only for lower-casing word tokenizers with this split
        self.by_piece = bool(suffix) and kinds == ["NFC", "Replace", "Lowercase"]
        if self.by_piece:
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self.bits = max(1, int(self.tokenizer.get_vocab_size()).bit_length())
        splits = [n["type"] for n in (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.plain = self.tokenizer
        if self.by_piece and splits == ["Split", "ByteLevel"]:
            # pieces are normalized and split already: the same model without these two steps
            parts["normalizer"], parts["pre_tokenizer"]["pretokenizers"][0] = None, {"type": "WhitespaceSplit"}
            self.plain = Tokenizer.from_str(json.dumps(parts))
        self.words = Kept(self._make)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text without added special tokens."""
        return next(self.many([text]))

    def many(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; unknown words of neighbouring texts are encoded together."""
        group, unknown, size = [], set(), 0
        for i, text in enumerate(texts):
            size += len(text)
            if self.by_piece and PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                words = text.lower().split()
                parts = list(map(self.words.new.get, words))
                gaps = [(at, words[at]) for at, ids in enumerate(parts) if ids is None]
                unknown.update(w for _, w in gaps)
                group.append((parts, gaps))
            else:
                group.append(text)
            if size >= TOGETHER or i == len(texts) - 1:
                learned = self.words.learn(unknown)
                for found in group:
                    if isinstance(found, str):
                        yield np.array(self.tokenizer.encode(found, add_special_tokens=False).ids, dtype="<u4")
                    else:
                        parts, gaps = found
                        for at, w in gaps:
                            parts[at] = learned[w]
                        yield np.frombuffer(b"".join(parts), dtype="<u4")
                group, unknown, size = [], set(), 0

    def _make(self, words: list[str], known: Callable[[str], bytes | None]) -> dict[str, bytes]:
        """Ids of runs of non-space characters and of the pieces they are cut into.

        A piece alone is cut into itself, so words and pieces share one dictionary.
        """
        cut = {w: (ASCII_SPLIT if w.isascii() else SPLIT).findall(w) for w in words if not w.isalpha()}
        made = dict.fromkeys(w for w in words if w.isalpha())
        for piece in set(chain.from_iterable(cut.values())):
            made[piece] = known(piece)
        unknown = [piece for piece, ids in made.items() if ids is None]
        made.update(zip(unknown, self._encode(unknown), strict=True))
        found = made.__getitem__
        made.update({w: b"".join(map(found, pieces)) for w, pieces in cut.items() if len(pieces) > 1})
        return made

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces: encoded as one text and cut at the ends of words."""
        (found,) = self.plain.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4")
        cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(cuts) != len(pieces) or (cuts and cuts[-1] != len(ids)):
            raise ValueError("the tokenizer splits its input in an unknown way")
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *cuts], cuts, strict=False)]


class Kept:
    """What ``make`` gives for at most twice ``KEPT`` strings.

    Beyond that the latest ``KEPT`` become the old ones, and those of them that are met
    again are new ones once more. As long as all fit, none is made twice.
    """

    def __init__(self, make):
        self.make = make
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, names: set[str]) -> dict[str, bytes]:
        """A dictionary that has all the names."""
        missing = names.difference(self.new)
        if len(self.new) + len(missing) > (KEPT if self.old else 2 * KEPT):
            latest = islice(self.new.items(), max(0, len(self.new) - KEPT), None)
            self.old, self.new = dict(latest), {}
            missing = names
        unknown = []
        for n in missing:
            if (found := self.old.get(n)) is None:
                unknown.append(n)
            else:
                self.new[n] = found
        if unknown:
            self.new.update(self.make(unknown, self.known))
        return self.new

    def known(self, name: str) -> bytes | None:
        found = self.new.get(name)
        return self.old.get(name) if found is None else found
