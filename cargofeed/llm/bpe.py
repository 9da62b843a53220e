r"""Operator 4, BPE encoding and decoding with a tokenization automaton.

:class:`TokenAutomaton` compiles the merge list into a deterministic automaton
over tokens by successive merge gadgets. It starts with one state and a loop
per base symbol. The merge ``(u, v) -> w`` adds an arc ``w`` wherever an arc
``u`` is followed by an arc ``v`` (to the state the ``v`` arc leads to) and
leads all ``u`` arcs to a copy of their target without the arc ``v``. Accepted
token sequences are exactly the tokenizations BPE produces. Where the ``u``
arcs lead never depends on their source, so a state is stored as its
difference from the state it was copied from: ``(parent, removed token,
merge number)``, and whether it has an arc ``x`` is read from the state's
table of removed tokens along the left spine of ``x``.

A pre-split word is encoded in one pass over its bytes: every prefix has one
valid tokenization, so each position keeps its last token, and from the state
that token leads to the arcs are followed whose labels match the next bytes.
Decoding emits arc labels. The driver compiles the automaton once and broadcasts
its tables (their size depends on the vocabulary file alone). Words repeat, so each
worker keeps a bounded table of encoded words; texts never leave the executors.

Text preparation is that of the vocabulary file: special-token strings of the
raw text become their ids, NFC, white space to one space, lower case, the
file's split pattern, bytes of each word, word end on the last byte.

Defined cases: NULL counts as empty text (no tokens; digests of empty
strings); repeated rows and ties are encoded alike, row by row; extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import id_text, map_batches

#: Words kept per worker: about 200 bytes each with their ids.
CACHE_WORDS = 450_000
WORD_END = "</w>"
#: Texts below this code point take the fast split.
LATIN = 0x250
#: Longer words are encoded one at a time.
STEP_BYTES = 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class TokenAutomaton:
    """Deterministic automaton of a merge list; symbols are 0..255 and, for the last byte of a word, 256..511."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = WORD_END):
        symbols = byte_symbols()
        n = max(vocab.values()) + 1
        self.born = [0] * n          # merge number that made the token
        self.left = [-1] * n         # left part of the token
        state = [0] * n              # where arcs of the token lead
        self.removed: list[dict[int, int]] = [{}]  # per state: removed token -> merge number
        spelled: list[tuple[int, ...] | None] = [None] * n
        for b in range(256):
            for sym, name in ((b, symbols[b]), (b + 256, symbols[b] + end)):
                if name in vocab:
                    spelled[vocab[name]] = (sym,)
        for k, (a, b) in enumerate(merges, 1):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            spelled[w] = spelled[u] + spelled[v]
            if not self._arc(state[u], v):
                continue  # no path u v is left: this merge never applies
            self.born[w], self.left[w] = k, u
            state[w] = state[v]
            copy = dict(self.removed[state[u]])
            copy[v] = k
            self.removed.append(copy)
            state[u] = len(self.removed) - 1
        self.state = state
        #: trie of arc labels: symbol -> child, and the token that ends here
        self.next: list[dict[int, int]] = [{}]
        self.token = [-1]
        live = [t for t, syms in enumerate(spelled) if syms and (len(syms) == 1 or self.born[t])]
        self.width = [len(syms) if syms else 0 for syms in spelled]
        #: the next shorter token that is a prefix of the token
        self.shorter = [-1] * n
        for tok in sorted(live, key=lambda t: self.width[t]):
            syms = spelled[tok]
            if syms:
                node = 0
                for s in syms:
                    if self.token[node] >= 0:
                        self.shorter[tok] = self.token[node]
                    child = self.next[node].get(s)
                    if child is None:
                        child = len(self.next)
                        self.next[node][s] = child
                        self.next.append({})
                        self.token.append(-1)
                    node = child
                self.token[node] = tok

    def _arc(self, state: int, x: int) -> bool:
        """Whether ``state`` has an arc ``x``. A removed arc ``y`` also lacks every
        token that was made later from ``y`` on the left."""
        removed = None if self.removed is None else self.removed[state]
        later = 1 << 60
        while x >= 0 and state:
            at = self._gone.one(state << 20 | x) if removed is None else removed.get(x, -1)
            if 0 <= at <= later:  # equal: the merge of a token with itself
                return False
            later, x = self.born[x], self.left[x]
        return True

    def encode(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the one accepted path that spells it.

        Longest arcs are tried first. A prefix has one valid tokenization, so a
        position from which no path went on is never tried again.
        """
        n = len(word)
        if not n:
            return []
        syms = [*word[:-1], word[-1] + 256]
        child, token, shorter, width, arc, lead = self._child, self.token, self.shorter, self.width, self._arc, self.state
        out: list[int] = []
        at, state, dead = 0, 0, set()
        tok = self._longest(syms, 0, n)
        while True:
            while tok >= 0 and (at + width[tok] in dead or (state and not arc(state, tok))):
                tok = shorter[tok]
            if tok >= 0:
                out.append(tok)
                at += width[tok]
                if at == n:
                    return out
                state = lead[tok]
                node, tok = 0, -1
                for j in range(at, n):
                    node = child(node, syms[j])
                    if node < 0:
                        break
                    if token[node] >= 0:
                        tok = token[node]
            else:  # no arc goes on from here: take the last one back
                if not out:
                    raise ValueError("the vocabulary has no path for this word")
                dead.add(at)
                last = out.pop()
                at -= width[last]
                state = lead[out[-1]] if out else 0
                tok = shorter[last]

    def _child(self, node: int, symbol: int) -> int:
        return self._trie.one(node << 9 | symbol) if self.next is None else self.next[node].get(symbol, -1)

    def _longest(self, syms: list[int], at: int, n: int) -> int:
        node, tok = 0, -1
        for j in range(at, n):
            node = self._child(node, syms[j])
            if node < 0:
                break
            if self.token[node] >= 0:
                tok = self.token[node]
        return tok

    # -- the same automaton as flat tables, for many words at once ------------------

    def tables(self) -> None:
        """Transition and removed-arc tables with open addressing, for numpy."""
        if hasattr(self, "_trie"):
            return
        sizes = [len(d) for d in self.next]
        keys = (np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << 9
                | np.fromiter((s for d in self.next for s in d), np.int64, sum(sizes)))
        self._trie = _Hash(keys, np.fromiter((c for d in self.next for c in d.values()), np.int32, sum(sizes)))
        sizes = [len(d) for d in self.removed]
        keys = (np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << 20
                | np.fromiter((t for d in self.removed for t in d), np.int64, sum(sizes)))
        self._gone = _Hash(keys, np.fromiter((k for d in self.removed for k in d.values()), np.int32, sum(sizes)))
        self.removed = self.next = None  # the tables have it all, in a third of the memory
        self._token, self._lead = np.array(self.token, np.int32), np.array(self.state, np.int64)
        self._born, self._left = np.array(self.born, np.int64), np.array(self.left, np.int64)
        self._width = np.array(self.width, np.int64)

    def _arcs(self, state: np.ndarray, tok: np.ndarray) -> np.ndarray:
        """Vectorized :meth:`_arc`."""
        ok = np.ones(len(tok), bool)
        live = np.flatnonzero(state > 0)
        x, s = tok[live].astype(np.int64), state[live] << 20
        later = np.full(len(live), 1 << 60)
        while len(live):
            at = self._gone.get(s | x)
            gone = (at >= 0) & (at <= later)
            ok[live[gone]] = False
            up = self._left[x]
            go = ~gone & (up >= 0)
            live, s, later, x = live[go], s[go], self._born[x[go]], up[go]
        return ok

    def encode_many(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each of many words."""
        ids, count = self.encode_flat(words)
        return np.split(ids, np.cumsum(count)[:-1])

    def encode_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of many words, one after the other, and the number of each word's ids.

        Positions go in step, one table transition for all words at a time.
        """
        self.tables()
        lens = np.array([*map(len, words)], np.int64)
        first = np.cumsum(lens + 1) - (lens + 1)  # one position more than bytes
        total = int((lens + 1).sum())
        sym = np.zeros(total, np.int64)
        byte = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        sym[:] = byte
        sym[first + lens - 1] += 256
        last, back = np.full(total, -1, np.int64), np.zeros(total, np.int64)
        state = np.full(total, -1, np.int64)
        state[first] = 0
        left = lens.copy()
        word_of = np.arange(len(words))
        for i in range(int(lens.max())):
            word_of = word_of[left[word_of] > i]
            here = first[word_of] + i
            go = state[here] >= 0
            here, end = here[go], (first + lens)[word_of][go]
            node, at = np.zeros(len(here), np.int64), here
            while len(at):
                node = self._trie.get(node << 9 | sym[at]).astype(np.int64)
                at = at + 1
                ok = node >= 0
                node, at, here, end = node[ok], at[ok], here[ok], end[ok]
                tok = self._token[node]
                cand = np.flatnonzero((tok >= 0) & (state[at] < 0))
                if len(cand):
                    cand = cand[self._arcs(state[here[cand]], tok[cand])]
                    to = at[cand]
                    last[to], back[to], state[to] = tok[cand], here[cand], self._lead[tok[cand]]
                more = at < end
                node, at, here, end = node[more], at[more], here[more], end[more]
        # walk back from the word ends
        at, live = first + lens, np.arange(len(words))
        steps = []
        while len(live):
            if (last[at[live]] < 0).any():
                raise ValueError("the vocabulary has no path for a word")
            steps.append((live, last[at[live]]))
            at[live] = back[at[live]]
            live = live[at[live] > first[live]]
        count = np.zeros(len(words), np.int64)
        for live, _ in steps:
            count[live] += 1
        # the last token was met first: each step fills one place further from the end
        end, out = np.cumsum(count), np.empty(int(count.sum()), "<u4")
        for k, (live, tok) in enumerate(steps):
            out[end[live] - 1 - k] = tok
        return out, count


class _Hash:
    """Fixed open-addressing table of 64-bit keys; missing keys give -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 1.6).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[todo[free]]
            mine = self.keys[slot] == keys[todo]
            self.values[slot[mine]] = values[todo[mine]]
            todo, slot = todo[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def one(self, key: int) -> int:
        slot = ((key * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)) >> int(self.shift)
        while (found := int(self.keys[slot])) >= 0:
            if found == key:
                return int(self.values[slot])
            slot = (slot + 1) & self.mask
        return -1

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(-1))
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot_t = slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot_t]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot_t[hit]]
            todo = todo[~hit & (found >= 0)]
        return out


WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _class_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte and of each character below LATIN: 0 space, 1 letter, 2 number, 3 other; 4: lead byte."""
    chars = np.full(LATIN, 3, np.uint8)
    for c in range(LATIN):
        kind = unicodedata.category(chr(c))[0]
        chars[c] = 0 if chr(c) in "\t\n\v\f\r \x85\xa0" else 1 if kind == "L" else 2 if kind == "N" else 3
    by_byte = np.full(256, 4, np.uint8)
    by_byte[:128] = chars[:128]
    return by_byte, chars


_BYTE, _CHAR = _class_tables()


def _latin_words(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """Words of lower-case Latin UTF-8 text by WORD_PATTERN, and the byte each starts at."""
    buf = np.frombuffer(data, np.uint8)
    n = len(buf)
    kind = _BYTE[buf]
    lead = np.flatnonzero((buf >= 0xC0) & (kind == 4))
    if len(lead):
        kind[lead] = kind[lead + 1] = _CHAR[((buf[lead].astype(np.int64) & 31) << 6) | (buf[lead + 1] & 63)]
    start = np.empty(n, bool)
    if n:
        start[0] = True
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        start[lead + 1] = False  # the second byte of a character starts nothing
    # contractions: an apostrophe that starts a token and the letters after it
    quote = np.flatnonzero((buf == 39) & start)
    quote = quote[quote + 1 < n]
    one = buf[quote + 1]
    two = np.where(quote + 2 < n, buf[np.minimum(quote + 2, n - 1)], 0) if n else one
    size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
    size[((one == 114) | (one == 118)) & (two == 101)] = 2
    size[(one == 108) & (two == 108)] = 2
    quote, size = quote[size > 0], size[size > 0]
    start[quote + 1] = False
    after = quote + 1 + size
    start[after[after < n]] = True
    keep = kind != 0
    first = np.flatnonzero(start & keep)
    place = np.cumsum(keep)
    offsets = np.append(place[first] - 1, place[-1] if n else 0).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(buf[keep].tobytes())), first


class Encoder:
    """Encodes whole texts as the vocabulary file's tokenizer does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.automaton = TokenAutomaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.automaton.tables()
        self.label = {i: s for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label.update({i: s for s, i in self.special.items()})
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"), regex.V0)
        self.beyond = re.compile(f"[^\x00-{chr(LATIN - 1)}]|\u0130")
        self.simple = pattern == WORD_PATTERN  # the split that split_batch does on bytes
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.forget()

    #: Words this copy keeps at most.
    most_words = CACHE_WORDS

    def forget(self) -> None:
        """Empty the table of known words; special tokens (keyed as tuples) are always in it."""
        ids = [*self.special.values()]
        self.known: dict[str | tuple[str], int] = {(s,): k for k, s in enumerate(self.special)}
        self.spelled: list[str | None] = [*self.special]
        self.pool, self.used = np.array(ids or [0], "<u4"), len(ids)
        self.first, self.size = np.arange(max(1, len(ids))), np.ones(max(1, len(ids)), np.int64)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "spelled", "pool", "used", "first", "size")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()

    def _add(self, words: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        n, at = len(self.known), self.used
        while len(self.pool) < at + len(ids):
            self.pool = np.concatenate([self.pool, np.empty(len(self.pool) + (1 << 16), "<u4")])
        while len(self.first) < n + len(words):
            self.first, self.size = (np.concatenate([a, np.empty(len(a) + (1 << 14), np.int64)]) for a in (self.first, self.size))
        self.pool[at:at + len(ids)] = ids
        self.used += len(ids)
        self.first[n:n + len(words)] = at + np.cumsum(count) - count
        self.size[n:n + len(words)] = count
        self.known.update(zip(words, range(n, n + len(words))))
        self.spelled += [None] * len(words)

    def learn(self, words: list[str]) -> None:
        """Encode new words together; very long ones singly."""
        raw = [w.encode("utf-8") for w in words]
        short = [(w, r) for w, r in zip(words, raw, strict=True) if len(r) <= STEP_BYTES]
        for w, r in zip(words, raw, strict=True):
            if len(r) > STEP_BYTES:
                ids = np.array(self.automaton.encode(r), "<u4")
                self._add([w], ids, np.array([len(ids)]))
        if short:
            self._add([w for w, _ in short], *self.automaton.encode_flat([r for _, r in short]))

    def places(self, words: list) -> np.ndarray:
        """Place of each distinct word in the table; those the worker has not met yet are encoded together."""
        def find() -> np.ndarray:
            return np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        found = find()
        new = np.flatnonzero(found < 0).tolist()
        if new and len(self.known) + len(new) > self.most_words:
            self.forget()
            found = find()
            new = np.flatnonzero(found < 0).tolist()
        if new:
            self.learn([words[i] for i in new])
            found = find()
        return found

    def label_of(self, place: int) -> str:
        """Decoded text of a known word: its labels joined by a space."""
        out = self.spelled[place]
        if out is None:
            a = int(self.first[place])
            out = self.spelled[place] = " ".join(map(self.label.__getitem__, self.pool[a:a + int(self.size[place])].tolist()))
        return out

    def split(self, text: str) -> list[str]:
        """Prepared and pre-split words of a text without special tokens."""
        # lower case one character at a time, so no final-sigma rule
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def split_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Words of many texts at once: bounds per text, index of each word, distinct words.

        Texts of Latin characters (NFC leaves them alone) are split together on
        byte classes; the others, and those with special tokens, one by one.
        """
        fast = [self.simple and "<|" not in t and (t.isascii() or not self.beyond.search(t)) for t in texts]
        raw = [t.lower().encode("utf-8") if f else b"" for t, f in zip(texts, fast, strict=True)]
        words, at = _latin_words(b"\n".join(raw))
        lines = np.cumsum([0, *(len(r) + 1 for r in raw)])
        coded = words.dictionary_encode()
        index, known = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
        bounds = np.searchsorted(at, lines)
        if all(fast):
            return bounds, index, known
        place = {w: i for i, w in enumerate(known)}
        parts, sizes = [], []
        for k, (text, f) in enumerate(zip(texts, fast, strict=True)):
            if f:
                part = index[bounds[k]:bounds[k + 1]]
            else:
                found = []
                for w, special in self.pieces(text):
                    w = (w,) if special else w  # a special token is not the word spelled like it
                    if w not in place:
                        place[w] = len(known)
                        known.append(w)
                    found.append(place[w])
                part = np.array(found, np.int64)
            parts.append(part)
            sizes.append(len(part))
        return np.cumsum([0, *sizes]), np.concatenate(parts), known

    def pieces(self, text: str) -> list[tuple[str, bool]]:
        """``(word or special token, whether it is special)`` of any text."""
        out = []
        for part in self.cut.split(text) if self.cut is not None else [text]:
            if part in self.special:
                out.append((part, True))
            elif part:
                out += [(w, False) for w in self.split(part)]
        return out

    def encode(self, text: str, labels: bool = False) -> tuple[bytes, str]:
        """Little-endian 32-bit ids and, if asked for, the decoded text (labels joined by a space)."""
        return self.encode_batch([text], labels)[0]

    def _flat(self, index: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given by their index among distinct ones, and the bounds of each word's ids."""
        first, size = self.first[place], self.size[place]
        lens = size[index]
        ends = np.zeros(len(index) + 1, np.int64)
        np.cumsum(lens, out=ends[1:])
        kind = np.int32 if max(int(ends[-1]), self.used) < 2 ** 31 else np.int64
        where = np.repeat((first[index] - ends[:-1]).astype(kind), lens)
        where += np.arange(int(ends[-1]), dtype=kind)
        return self.pool[where], ends

    def encode_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts as one 32-bit array, and the bounds of each text's ids in it."""
        bounds, index, words = self.split_batch(texts)
        flat, ends = self._flat(index, self.places(words))
        return flat, ends[bounds]

    def encode_batch(self, texts: list[str], labels: bool = False) -> list[tuple[bytes, str]]:
        """Ids and, if asked for, decoded text of every text."""
        bounds, index, words = self.split_batch(texts)
        place = self.places(words)
        flat, ends = self._flat(index, place)
        cuts = ends[bounds].tolist()
        ids = [flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if not labels:
            return [(i, "") for i in ids]
        spelled = np.empty(len(words), object)
        spelled[:] = [*map(self.label_of, place.tolist())]
        text = spelled[index].tolist()
        return [(i, " ".join(text[a:b])) for i, a, b in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def decode(self, ids: list[int]) -> str:
        """Emit the label of every arc."""
        return " ".join(map(self.label.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The compiled automaton of a vocabulary file (its size depends on the file alone)."""
    return Encoder(path)


def shared_encoder(docs: DataFrame, path: str) -> Broadcast:
    """The encoder compiled once on the driver; each worker's copy keeps its own table of known words."""
    return docs.sparkSession.sparkContext.broadcast(encoder(path))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


TOKENS = "doc_id long, ids binary, decoded string"


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: ids as little-endian 32-bit integers, and their decoded text."""
    shared = shared_encoder(docs, path or default_vocabulary())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = shared.value.encode_batch(batch.column("text").to_pylist(), labels=True)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
            names=["doc_id", "ids", "decoded"])
    return map_batches(id_text(docs), run, TOKENS)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digests of :func:`encode_documents`, taken in the worker so that ids and texts are not sent on."""
    shared = shared_encoder(docs, path or default_vocabulary())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for ids, decoded in shared.value.encode_batch(batch.column("text").to_pylist(), labels=True):
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest()))
        n, a, b = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return map_batches(id_text(docs), run, DIGESTS)
