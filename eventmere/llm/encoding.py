"""Ids of texts from tokenizer files, each distinct piece of text encoded once.

A tokenizer first cuts a text with a pattern and then merges inside what it cut. So a
text's ids are those of its pieces, wherever the pattern is sure to cut: pieces, and in
them the runs the pattern gives, are encoded once per task and remembered. The library
does all merging. Only pieces of plain characters are cut here; any other piece, and
any piece with a special token's string, is left whole to the library.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import filterfalse

import numpy as np

#: Pieces and runs that a task remembers, about; some 200 bytes each, in two tables.
KNOWN = 250_000
#: Runs that are encoded as one text, and pieces that are looked at together.
LINES = 200
#: White space in the sense of the patterns.
WHITE = "\t-\r \u0085   -     　"
#: Neither letters, digits nor white space.
MARKS = ".,;:!?)]}\"'"
#: No line break, no combining marks, no controls, no letter whose lower case has another length.
PLAIN = "[\t -~¡-¬®-įı-ɏ]+"


def vocabulary_file(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def library() -> type:
    """The tokenizers library, with the threads Spark leaves it."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer


@contextmanager
def no_collection() -> Iterator[None]:
    """Without Python's cycle collector, which would go through all remembered pieces again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def drop_most(known: dict, needed: Iterable, limit: int) -> dict:
    """What to remember: all, or if that gets too much what is needed now, which later texts need most."""
    return known if len(known) < limit else {k: known[k] for k in needed if k in known}


class Recent:
    """Values by key in two tables: the newer one becomes the older when it has enough, and the older one goes.

    What is asked for again comes into the newer one, so that of very many keys the frequent ones stay.
    """

    def __init__(self):
        self.new, self.old = {}, {}

    def renew(self, limit: int) -> None:
        """Remember about ``limit`` keys, and what one call adds."""
        if len(self.new) >= limit // 2:
            self.new, self.old = {}, self.new

    def absent(self, keys: set) -> list:
        """Those of the keys that are in neither table; the others are in the newer one from now on."""
        left = list(filterfalse(self.new.__contains__, keys))
        again = list(filter(self.old.__contains__, left))
        self.new.update(zip(again, map(self.old.__getitem__, again)))
        return list(filterfalse(self.new.__contains__, left)) if again else left


class Encoder:
    """Serialized ids of pieces of text by a tokenizers file.

    ``pattern`` is the one the file cuts with, and ``lower`` says that it makes lower
    case first; it must keep letters, with at most one space before them, in one run,
    and the ``MARKS`` after them in another.
    Without a pattern every piece is left whole to the library.
    """

    def __init__(self, blob: bytes, width: int, pattern: str | None = None, lower: bool = False, plain_special: bool = False):
        import regex

        Tokenizer = library()
        self.whole = Tokenizer.from_str(blob.decode())
        self.whole.encode_special_tokens = plain_special
        config = json.loads(blob)
        names = [t["content"] for t in config.get("added_tokens", [])]
        self.special = None if plain_special or not names else regex.compile("|".join(map(regex.escape, names)))
        config |= {"normalizer": None, "added_tokens": [], "post_processor": None}
        bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
        lines = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Isolated", "invert": False}
        config["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [lines, bytes_only]}
        self.merges = Tokenizer.from_str(json.dumps(config)) if pattern else None
        self.pattern, self.plain = regex.compile(pattern or ""), regex.compile(PLAIN)
        self.type, self.lower = f"<u{width}", lower
        self.runs = Recent()
        # Whether lower-case letters alone are one run as they are.
        self.letters = bool(pattern) and lower and not any(n.isalpha() for n in ([] if plain_special else names))

    def texts(self, texts: list[str], by: object = None) -> list[bytes]:
        """The library's own ids of whole texts."""
        found = (by or self.whole).encode_batch_fast(texts, add_special_tokens=False)
        sizes = [len(e) for e in found]
        data = np.array([i for e in found for i in e.ids], self.type).tobytes()
        edges = (np.cumsum([0, *sizes]) * int(self.type[2:])).tolist()
        return [data[i:j] for i, j in zip(edges, edges[1:])]

    def merged(self, runs: list[str]) -> list[bytes]:
        """Ids of runs without line breaks, each merged by itself: many are encoded as the lines of one text."""
        out, size = [], int(self.type[2:])
        line = self.merges.encode("\n", add_special_tokens=False).ids
        for start in range(0, len(runs), LINES):
            own = runs[start : start + LINES]
            ids = np.array(self.merges.encode_batch_fast(["\n".join(own)], add_special_tokens=False)[0].ids, self.type)
            ends = np.append(np.flatnonzero(ids == line[0]), len(ids))
            if len(line) == 1 and len(ends) == len(own):
                data, edges = ids.tobytes(), (ends * size).tolist()
                out += [data[i:j] for i, j in zip([0, *[e + size for e in edges]], edges)]
            else:  # a file without one id for a line break
                out += self.texts(own, self.merges)
        return out

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, before and after which the pattern is sure to cut."""
        if self.merges is None:
            return self.texts(pieces)
        if not self.letters:
            return self._cut_pieces(pieces)
        # The caller remembers pieces; those that are one run need not be remembered as runs too.
        single = [p.isalpha() and p.isascii() and p.islower() for p in pieces]
        runs = iter(self.merged([p for p, s in zip(pieces, single) if s]))
        others = iter(self._cut_pieces([p for p, s in zip(pieces, single) if not s]))
        return [next(runs if s else others) for s in single]

    def _cut_pieces(self, pieces: list[str]) -> list[bytes]:
        cut = [runs for start in range(0, len(pieces), LINES) for runs in self._cut(pieces[start : start + LINES])]
        own = {runs for runs in cut if type(runs) is str}
        own.update(*[runs for runs in cut if type(runs) is tuple])
        self.runs.renew(KNOWN)
        new = self.runs.absent(own)
        self.runs.new.update(zip(new, self.merged(new)))
        whole = iter(self.texts([piece for piece, runs in zip(pieces, cut) if runs is None]))
        get = self.runs.new.__getitem__
        return [get(runs) if type(runs) is str else next(whole) if runs is None else b"".join(map(get, runs)) for runs in cut]

    def _cut(self, pieces: list[str]) -> list[str | tuple[str, ...] | None]:
        """A run, or several, of each piece; None where the piece has other than plain characters, or a special token's string."""
        if not self._is_plain(" ".join(pieces)):
            return [self._runs(p.lower() if self.lower else p) if self._is_plain(p) else None for p in pieces]
        # Plain pieces have no line breaks.
        texts = "\n".join(pieces).lower().split("\n") if self.lower else pieces
        return [t if t.isalpha() else self._runs(t) for t in texts]

    def _runs(self, text: str) -> str | tuple[str, ...]:
        letters = text.rstrip(MARKS)
        if letters.isalpha() or letters[:1] == " " and letters[1:].isalpha():
            # Letters are one run, and so are the marks after them.
            return (letters, text[len(letters) :]) if len(letters) < len(text) else text
        return tuple(self.pattern.findall(text))

    def _is_plain(self, text: str) -> bool:
        return bool(self.plain.fullmatch(text)) and not (self.special and self.special.search(text))
