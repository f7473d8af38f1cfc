"""Token counts by trie-shared dynamic programming.

A text's pre-tokens are its words, each with the word mark before it.  Under a unigram model the
best segmentation of a pre-token is found by forward scores, one for each of its prefixes.  Distinct
pre-tokens go into a trie, whose nodes hold the forward score of their prefix: a prefix that many
pre-tokens share is scored once, and the node where a pre-token ends holds its token count.  Each
Python worker keeps one trie for all its tasks, of at most ``MAX_NODES`` nodes; then it starts a
new one.  Counts do not depend on it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches, utf8, words

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
MAX_NODES = 1_000_000
#: Longer pre-tokens are scored without a place in the trie.
MAX_SHARED = 64


class Unigram:
    """Piece scores: log-probabilities of Zipf's law over the ranks of a public vocabulary."""

    def __init__(self, pieces: Iterable[str]) -> None:
        listed = [p for p in dict.fromkeys(pieces) if p]
        total = math.log(sum(1 / (k + 1) for k in range(len(listed))) or 1)
        self.scores = {p: -math.log(k + 1) - total for k, p in enumerate(listed)}
        self.longest = max(map(len, listed), default=0)
        #: Score of a code point that is no piece, one token of its own.
        self.unknown = -math.log(len(listed) + 1) - total - 10.0


def load(path: str | None = None) -> Unigram:
    """The pieces of a sentencepiece file, in rank order, without control and byte pieces."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return Unigram(sp.id_to_piece(k) for k in range(sp.vocab_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)))


class Node:
    """A prefix: its forward score, the tokens on the best path, its children, its terminal count."""

    __slots__ = ("children", "count", "score", "terminal")

    def __init__(self, score: float, count: int) -> None:
        self.score, self.count = score, count
        self.children: dict[str, Node] = {}
        self.terminal: int | None = None


class Trie:
    """Forward scores shared by the prefixes of all pre-tokens that were inserted."""

    def __init__(self, model: Unigram, max_nodes: int = MAX_NODES) -> None:
        self.model, self.max_nodes = model, max_nodes
        self.root, self.size = Node(0.0, 0), 1

    def _forward(self, text: str, end: int, scores: list[float], counts: list[int]) -> tuple[float, int]:
        """Best score of text[:end] and its tokens; of equal scores the fewest tokens."""
        model = self.model
        best, count = scores[end - 1] + model.scores.get(text[end - 1], model.unknown), counts[end - 1] + 1
        for start in range(max(0, end - model.longest), end - 1):
            if (own := model.scores.get(text[start:end])) is not None:
                score = scores[start] + own
                if score > best or (score == best and counts[start] + 1 < count):
                    best, count = score, counts[start] + 1
        return best, count

    def count(self, token: str) -> int:
        """Tokens of the best segmentation of a pre-token."""
        if len(token) > MAX_SHARED:
            return self._unshared(token)
        node, depth = self.root, 0
        path = [node]
        for sign in token:  # down the shared prefix
            if (child := node.children.get(sign)) is None:
                break
            node, depth = child, depth + 1
            path.append(node)
        if depth < len(token):
            if self.size > self.max_nodes:
                self.root, self.size = Node(0.0, 0), 1
                return self.count(token)
            scores, counts = [n.score for n in path], [n.count for n in path]
            for end in range(depth + 1, len(token) + 1):
                score, count = self._forward(token, end, scores, counts)
                scores.append(score)
                counts.append(count)
                node.children[token[end - 1]] = child = Node(score, count)
                node = child
            self.size += len(token) - depth
        if node.terminal is None:
            node.terminal = node.count
        return node.terminal

    def _unshared(self, token: str) -> int:
        scores, counts = [0.0], [0]
        for end in range(1, len(token) + 1):
            score, count = self._forward(token, end, scores, counts)
            scores.append(score)
            counts.append(count)
        return counts[-1]


_tries: dict[str | None, Trie] = {}


def token_counts(docs: DataFrame, *, model_path: str | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_distinct (of the text) and n_tokens of every row.

    A code point outside the vocabulary is one token.  Null and empty texts have none; a pre-token
    may be as long as its text; repeated rows come out as often as they came in.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model_path not in _tries:
            _tries[model_path] = Trie(load(model_path))
        trie = _tries[model_path]
        texts = [Counter(words(t)) for t in batch.column(1).to_pylist()]
        # sorted, pre-tokens of one prefix follow each other down the same branch
        counts = {w: trie.count(MARK + w.decode(errors="replace")) for w in sorted(set().union(*texts))}
        columns = [[sum(t.values()) for t in texts], [len(t) for t in texts], [sum(n * counts[w] for w, n in t.items()) for t in texts]]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_pretokens", "n_distinct", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), utf8("text")).mapInArrow(batches(make), "doc_id long, n_pretokens long, n_distinct long, n_tokens long")
