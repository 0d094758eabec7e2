"""Token ids of whole texts by public tokenizer files, each distinct chunk encoded once.

A text's ids are those of its pre-tokens in order. For texts of Latin letters
the pre-tokens (words, numbers, marks) are found here, lower-cased first where
the vocabulary is. In texts with other characters a chunk is what stands
between white space, with one space before it where the vocabulary keeps
spaces; no pre-token crosses such a border. Texts with unusual white space or
separators go to the tokenizer whole.

A process remembers short chunks up to a number of bytes, then starts anew;
long ones (whole texts among them) are encoded where they stand and forgotten.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .common import remembers

#: Bytes of chunks, their places and their ids that a process remembers, about; then it starts anew.
REMEMBERED = 192 << 20
#: Characters of a chunk that is remembered, at most; and bytes that one takes in Python besides its text and ids.
SHORT, ENTRY = 64, 180
#: Characters of texts that are split into chunks at once.
AT_ONCE = 2_000_000
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff]")
#: Beyond these, letters and numbers need the tokenizer's own tables.
OTHER = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")
# The pre-token patterns of the two vocabularies, for texts without OTHER characters.
LATIN_SPACED = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
LATIN_LOWER = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: The letters that byte-level vocabularies write bytes with: printable ones of Latin-1 stay, others follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512)))  # noqa: B905

_encoders: dict = {}
remembers("encoding", _encoders.clear)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, path: str, keeps_spaces: bool, remembered: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_spaces, self.remembered = keeps_spaces, remembered or REMEMBERED
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held, self.size, self.n_ids = 0, 0, 0
        self.starts, self.lengths, self.ids = (np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32), np.zeros(1 << 12, np.uint32))

    def _append(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Chunks' ids at the end of what is held; the arrays grow by doubling."""
        size, n_ids = self.size + len(lengths), self.n_ids + len(ids)
        while size > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        if n_ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), n_ids - len(self.ids)), np.uint32)])
        self.starts[self.size : size] = self.n_ids + np.cumsum(lengths) - lengths
        self.lengths[self.size : size], self.ids[self.n_ids : n_ids] = lengths, ids
        self.size, self.n_ids = size, n_ids

    def split(self, text: str) -> list[str]:
        if not OTHER.search(text):
            return LATIN_SPACED.findall(text) if self.keeps_spaces else LATIN_LOWER.findall(text.lower())
        if UNUSUAL.search(text):
            return [text]
        chunks = SPACED.findall(text) if self.keeps_spaces else text.split()
        return [c for chunk in chunks for c in ([chunk] if OTHER.search(chunk) else self.split(chunk))]

    def learn(self, chunks: list[str], known: dict[str, int]) -> None:
        """Encodes new chunks: Latin pre-tokens by the model alone, others with all that goes before it; ``known`` gets their places."""
        other = [c for c in chunks if OTHER.search(c)]
        latin = list(set(chunks).difference(other)) if other else chunks
        new = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        tokenize = self.tokenizer.model.tokenize
        new += [[t.id for t in tokenize(c.encode().decode("latin-1").translate(LETTERS))] for c in latin]
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        known.update(zip(other + latin, range(self.size, self.size + len(new))))  # noqa: B905
        self._append(lengths, np.fromiter((i for x in new for i in x), np.uint32, int(lengths.sum())))

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > self.remembered:
            self.forget()
        parts = [self.split(t) for t in texts]
        chunks = [c for p in parts for c in p]
        new = [c for c in set(chunks) if c not in self.known]
        short, long = [c for c in new if len(c) <= SHORT], [c for c in new if len(c) > SHORT]
        if short:
            before = self.n_ids
            self.learn(short, self.known)
            self.held += ENTRY * len(short) + 2 * sum(map(len, short)) + 4 * (self.n_ids - before)
        size, n_ids, places = self.size, self.n_ids, self.known
        if long:
            passing: dict[str, int] = {}
            self.learn(long, passing)
            at = np.fromiter((passing[c] if len(c) > SHORT else places[c] for c in chunks), np.int64, len(chunks))
        else:
            at = np.fromiter(map(places.__getitem__, chunks), np.int64, len(chunks))
        lengths = self.lengths[at].astype(np.int64)
        ends = np.cumsum(lengths)
        found = self.ids[np.repeat(self.starts[at] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        self.size, self.n_ids = size, n_ids  # long chunks are forgotten
        if len(self.ids) > max(1 << 20, 4 * n_ids):
            self.ids = self.ids[: max(n_ids, 1 << 12)].copy()
        last = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        ends = np.concatenate([[0], ends])[last]
        return found, np.diff(ends, prepend=0)

    def __call__(self, texts: list[str | None]):
        """Yields (ids, number of ids of each text) for some texts after others."""
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > AT_ONCE:
                yield self._encode(some)
                some, size = [], 0
        if some:
            yield self._encode(some)


def encoder(path: str, keeps_spaces: bool, remembered: int | None = None) -> Encoder:
    """The encoder of this process for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, keeps_spaces, remembered)
    return _encoders[path]
