"""Operator 3, token counts: a linear longest-match automaton.

Greedy word-piece splitting always takes the longest vocabulary piece at the
current position. The vocabulary is compiled into a trie with failure links;
each node also has the number of pieces that are popped when its link is
taken. Counting the pieces of a word is then one walk over its bytes, with no
backtracking and without building a piece (time linear in the word).

Words are pre-split as by the vocabulary file; the word end is part of the
last symbol, so pieces that close a word only match there. A word that has no
split counts one unknown token.

Defined cases: NULL counts as empty text (0 words, 0 tokens); repeated rows
are counted row by row; extra columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import json
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import CACHE_WORDS, Encoder, byte_symbols, default_vocabulary
from .common import held, id_text, map_batches


class LongestMatch:
    """Trie, failure links and popped-token counts of a vocabulary of symbol tuples."""

    def __init__(self, pieces):
        self.next: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for s in piece:
                child = self.next[node].get(s)
                if child is None:
                    child = len(self.next)
                    self.next[node][s] = child
                    self.next.append({})
                    final.append(False)
                node = child
            final[node] = True
        n = len(self.next)
        self.fail, self.pops = [-1] * n, [0] * n  # fail -1: no split goes on from here
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for s, v in self.next[u].items():
                if final[v]:
                    self.fail[v], self.pops[v] = 0, 1
                elif u:
                    z, popped = self.fail[u], self.pops[u]
                    while z >= 0 and s not in self.next[z]:
                        z, popped = self.fail[z], popped + self.pops[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.next[z][s], popped
                queue.append(v)

    def count(self, symbols) -> int:
        """Greedy longest-match pieces of the word; 1 if it has no split."""
        node, total = 0, 0
        nxt, fail, pops = self.next, self.fail, self.pops
        for s in symbols:
            while s not in nxt[node]:
                total += pops[node]
                node = fail[node] if node else -1
                if node < 0:
                    return 1
            node = nxt[node][s]
        while node:
            total += pops[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


class Counter:
    """Word and token counts of whole texts, with a bounded table of counted words."""

    def __init__(self, path: str):
        self.split = Encoder(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end, byte = model["end_of_word_suffix"], {c: b for b, c in enumerate(byte_symbols())}

        def symbols(piece: str):
            closed = piece.endswith(end)
            raw = [byte[c] for c in (piece[:-len(end)] if closed else piece)]
            return [*raw[:-1], raw[-1] + 256] if closed and raw else raw
        self.machine = LongestMatch([symbols(p) for p in model["vocab"] if all(c in byte for c in p.removesuffix(end))])
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        raw = word.encode("utf-8")
        self.known[word] = n = self.machine.count([*raw[:-1], raw[-1] + 256])
        return n

    def count_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of every text; special tokens count one each."""
        bounds, index, words = self.split.split_batch(texts)
        get, word = self.known.get, self.word
        each = np.array([1 if isinstance(w, tuple) else get(w) or word(w) for w in words] or [0], np.int64)
        total = np.concatenate([[0], np.cumsum(each[index])])
        return np.diff(bounds), total[bounds[1:]] - total[bounds[:-1]]


def counter(path: str) -> Counter:
    return held(("counter", path), lambda: Counter(path))


COUNTS = "doc_id long, n_words long, n_tokens long"


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every whole text."""
    path = path or default_vocabulary()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counter(path)
        words, tokens = c.count_batch(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                          names=["doc_id", "n_words", "n_tokens"])
    return map_batches(id_text(docs), run, COUNTS, holds=True)
