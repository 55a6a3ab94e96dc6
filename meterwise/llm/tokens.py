"""Token ids of whole texts by a public tokenizer file.

A byte-pair tokenizer never merges across the start of a word, so the ids of a text are
those of its words in a row. Words are encoded once by the tokenizers library and kept in
a bounded cache of the worker process; texts with the strings of special tokens go through
the library whole.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from itertools import chain

from pyspark import cloudpickle

from meterwise.llm.common import worker_large

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Unicode's white space, as the tokenizers' patterns have it.
SPACE = "\t-\r \x85\xa0  -     　"
# Words with the blank before them, and runs of white space but for that blank.
SPACED = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Where str.split() parts words, and the patterns do not.
UNLIKE_SPLIT = re.compile("[\x1c-\x1f]")
# White space other than blanks and line ends: one set, as alternatives take ten times as long.
ODD_SPACE = re.compile(f"[\0\t\v-\r\x85\xa0{SPACE[6:]}]")
# Characters that are split into words before the new ones are encoded together; few, so that
# a core still has the words at hand.
BLOCK = 250_000
# New pieces that are encoded as one text.
TOGETHER = 50
# Marks that are one pretoken after letters, however many; an apostrophe may open a word.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Words alone, for tokenizers that drop white space.
BARE = re.compile(f"[^{SPACE}]+")


class PieceIds:
    """Little-endian unsigned 32-bit ids of pieces of text, in two generations: what has not
    been met since the older one was filled goes, frequent pieces stay."""

    LIMIT = 1_000_000

    def __init__(self, path: str, spaced: bool, limit: int | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.LIMIT = limit or self.LIMIT
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        # A pretoken between pieces that are encoded together, and its id: if it has one
        # id, that is in no piece without its character.
        self.between = "\n" if spaced else " \x01 "
        own = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.between_id = own[0] if len(own) == 1 else None

    def whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def encoded(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, words some at a time."""
        import numpy as np

        mark = self.between.strip(" ")
        joint = [
            i for i, x in enumerate(pieces) if mark not in x and not x.isspace()
        ] if self.between_id is not None else []
        out: list[bytes | None] = [None] * len(pieces)
        groups = [joint[low : low + TOGETHER] for low in range(0, len(joint), TOGETHER)]
        texts = [self.between.join([pieces[i] for i in at]) for at in groups]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for at, one in zip(groups, found):
            ids = np.asarray(one.ids, "<u4")
            ends = np.flatnonzero(ids == self.between_id)
            if len(ends) != len(at) - 1:
                continue  # they are encoded one by one
            starts = [0, *(4 * ends + 4).tolist()]
            ends = [*(4 * ends).tolist(), 4 * len(ids)]
            flat = ids.tobytes()
            for i, a, b in zip(at, starts, ends):
                out[i] = flat[a:b]
        alone = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(alone, self.whole([pieces[i] for i in alone])):
            out[i] = ids
        return out

    def parts(self, piece: str) -> tuple[str, str] | None:
        """Pieces that give the same ids: letters and marks after them are two pretokens."""
        head = piece.rstrip(MARKS)
        if len(head) < len(piece) and (head.lstrip(" ") if self.spaced else head.lower()).isalpha():
            return head, piece[len(head) :]
        return None

    def learn(self, pieces: list[str]) -> None:
        """Have the ids of all `pieces`, which are not in the young generation, in it."""
        young, old = self.young, self.old
        known = list(map(old.get, pieces))
        young.update((x, ids) for x, ids in zip(pieces, known) if ids is not None)
        new = [x for x, ids in zip(pieces, known) if ids is None]
        parts = list(map(self.parts, new))
        needed = dict.fromkeys(chain.from_iterable(p or (x,) for x, p in zip(new, parts)))
        plain = [x for x in needed if x not in young]
        young.update(zip(plain, self.encoded(plain)))
        young.update((x, young[p[0]] + young[p[1]]) for x, p in zip(new, parts) if p)

    def pieces(self, text: str) -> list[str] | None:
        """The text cut where no pretoken crosses; None if special tokens forbid it."""
        if "<|" in text and any(s in text for s in self.special):
            return None
        if not self.spaced:
            # ASCII letters are lower-cased where white space is dropped.
            if text.isascii():
                text = text.lower()
            return BARE.findall(text) if UNLIKE_SPLIT.search(text) else text.split()
        # A blank opens a piece, unless white space precedes it; a line end is one.
        if odd_space(text):
            return SPACED.findall(text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = []
        for block in blocks(texts, BLOCK):
            if len(self.young) > self.LIMIT // 2:
                self.old, self.young = self.young, {"": b""}
            get = self.young.get
            rows = [self.pieces(t) for t in block]
            found = [None if r is None else list(map(get, r)) for r in rows]
            # What the cache lacks, with its places.
            gaps = [
                [i for i, ids in enumerate(f) if ids is None] if f and None in f else ()
                for f in found
            ]
            new = {r[i] for r, at in zip(rows, gaps) for i in at}
            if new:
                self.learn(list(new))
            for text, row, ids, at in zip(block, rows, found, gaps):
                for i in at:
                    ids[i] = self.young[row[i]]
                out.append(self.whole([text])[0] if row is None else b"".join(ids))
        return out


def odd_space(text: str) -> bool:
    """Whether white space is other than lone blanks and line ends between words."""
    doubled = any(two in text for two in ("  ", "\n\n", " \n", "\n "))
    return doubled or text.endswith("\n") or ODD_SPACE.search(text) is not None


def blocks(texts: list[str], size: int) -> Iterator[list[str]]:
    """Consecutive texts of about `size` characters."""
    block, held = [], 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def encoder(path: str, spaced: bool, limit: int | None = None) -> Callable[[list[str]], list[bytes]]:
    """Encode texts to the bytes of their ids. `spaced`: blanks are part of tokens. `limit`:
    pieces that the cache of a worker holds, some 170 bytes each."""
    return worker_large(f"ids {path} {spaced} {limit}", lambda: PieceIds(path, spaced, limit)).of
