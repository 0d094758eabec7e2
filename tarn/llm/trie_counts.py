"""Token counts under a unigram vocabulary, by forward scores shared in a trie.

The best segmentation of a word has the highest sum of piece scores. Forward
scores depend on the prefix only, so distinct pre-tokens (a word mark and the
word) go into a trie and each prefix is scored once; the node that ends a word
stores its token count. Each process keeps its trie from batch to batch and
starts anew when it holds enough nodes, which is checked every few thousand
words, and nothing is shuffled: a hot word costs one lookup wherever it stands.
A word of over ``LONG`` characters doesn't join the trie: its forward scores
are streamed, of which only as many are kept as a piece can be long, and it
isn't remembered. Nodes and the bytes of remembered words are bounded, so
memory is, whatever the texts are.

The vocabulary's file orders pieces by rank and has no probabilities; a piece
of rank r scores -log(r + 2), as under Zipf's law, and a byte of a character
that no piece holds scores worse than all. Equal scores take fewer tokens.

Defined cases: null and empty texts have no words and 0 tokens. Repeated rows
count alike; an empty table gives an empty result. Columns other than the two
that are named aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import tokenizer_path

MARK = "▁"
NODES = 2_000_000
#: Bytes of remembered words, with what Python takes for each.
WORD_BYTES, ENTRY = 96 << 20, 120
#: Characters of a word beyond which it is streamed, and words after which the trie's size is looked at.
LONG = 256
AT_ONCE = 4096

_tries: dict = {}


def vocabulary(path: str) -> tuple[dict[str, float], float]:
    """Pieces with their scores, and the score of a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): -math.log(r + 2) for r, i in enumerate(own)}
    return scores, min(scores.values()) - 10.0


class Trie:
    def __init__(self, scores: dict[str, float], byte_score: float):
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores))
        self.start()

    def start(self) -> None:
        self.children: dict[int, int] = {}  # by node and character
        self.forward, self.tokens = [0.0], [0]
        self.words: dict[bytes, int] = {}  # of whole words that aren't very long, for the lookup
        self.held = 0

    def count(self, word: bytes) -> int:
        """Tokens of a word, which joins the trie if it isn't very long."""
        text, node, path = MARK + word.decode("utf-8", "replace"), 0, [0]
        if len(text) > LONG:
            return self.streamed(text)
        children, forward, tokens, scores = self.children, self.forward, self.tokens, self.scores
        for end, c in enumerate(text, 1):
            edge = node << 21 | ord(c)
            child = children.get(edge)
            if child is None:
                size = len(c.encode("utf-8", "replace"))
                best, least = forward[node] + size * self.byte_score, tokens[node] + size
                for begin in range(max(0, end - self.longest), end):
                    piece = text[begin:end]
                    if piece in scores:
                        at = path[begin]
                        total = forward[at] + scores[piece]
                        if total > best or total == best and tokens[at] < least:
                            best, least = total, tokens[at] + 1
                child = children[edge] = len(forward)
                forward.append(best)
                tokens.append(least)
            node = child
            path.append(node)
        return tokens[node]

    def streamed(self, text: str) -> int:
        """Tokens of a word by forward scores of which the last few are kept."""
        keep, scores = self.longest, self.scores
        forward, tokens = [0.0] * keep, [0] * keep  # of the last prefixes, by length modulo keep
        for end in range(1, len(text) + 1):
            size, before = len(text[end - 1].encode("utf-8", "replace")), (end - 1) % keep
            best, least = forward[before] + size * self.byte_score, tokens[before] + size
            for begin in range(max(0, end - keep), end):
                piece = text[begin:end]
                if piece in scores:
                    total, count = forward[begin % keep] + scores[piece], tokens[begin % keep] + 1
                    if total > best or total == best and count < least:
                        best, least = total, count
            forward[end % keep], tokens[end % keep] = best, least
        return tokens[len(text) % keep]


def _counter(path: str, nodes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _tries:
            _tries[path] = Trie(*vocabulary(path))
        trie = _tries[path]
        for batch in batches:
            words, tokens = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for k, text in enumerate(batch.column(1).cast(pa.binary())):
                own = (text.as_py() or b"").split()
                words[k] = len(own)
                for at in range(0, len(own), AT_ONCE):
                    some = own[at : at + AT_ONCE]
                    passing: dict[bytes, int] = {}  # words too long to be remembered
                    for w in set(some):
                        if len(w) > LONG:
                            passing[w] = trie.count(w)
                        elif w not in trie.words:
                            trie.words[w] = trie.count(w)
                            trie.held += len(w) + ENTRY
                    tokens[k] += sum(passing[w] if len(w) > LONG else trie.words[w] for w in some) if passing else sum(map(trie.words.__getitem__, some))
                    if len(trie.forward) > nodes or trie.held > WORD_BYTES:
                        trie.start()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(tokens)], names=["doc_id", "n_words", "n_tokens"])

    return count


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model") -> DataFrame:
    """One row for each row of ``df``: doc_id, n_words and n_tokens."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counter(tokenizer_path(model), NODES), "doc_id long, n_words long, n_tokens long")
