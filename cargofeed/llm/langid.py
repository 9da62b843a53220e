"""Operator 1, language ID: cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A text is
parsed against each of them into longest matches: a phrase goes on while the
automaton has a transition and a new phrase starts where it has none. The
language that explains the text with the fewest phrases, each weighted with
the bits that name a place in that language's training text, wins.

Training reads a bounded sample: per language, documents with a non-null label
and ``crc32(doc_id) % 3 <> 1`` (rows without an id too), in the order of a hash of their id,
as many whole texts as fit into ``SAMPLE_CHARS`` characters. Texts of more than
``SAMPLE_TEXT`` code points are not in the sample; a language that has no other
is learned from its shortest text, whole. Prediction reads
whole texts and nothing but the text.

Parsing runs in step over many texts: the automata are transition tables over
normalised characters (lower case, anything that is no letter is one space).
Long texts are run in blocks of ``BLOCK`` characters, first each from the start of a
phrase, then again from the state in which the block before ended, up to where both
runs meet (mostly after a few phrases). Phrases are those of one parse of the whole text.

Defined cases: NULL text or text without a letter (Unicode category L; digits of any
kind, fractions and Roman numerals are none) is ``und`` with score 0, and
so is every text if no labelled text was found. Ties go to the alphabetically
first language. Repeated rows are predicted alike; extra columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, map_batches

#: Characters of training text per language, and code points of the longest text sampled.
SAMPLE_CHARS = 60_000
SAMPLE_TEXT = 3_000
#: Documents per language that the sample is drawn from, about.
SAMPLE_DOCS = 100
#: Long texts are run in blocks of this many characters.
BLOCK = 512
#: Blocks whose start state changed are run again in step this often; what is left after that, one by one.
ROUNDS = 4
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def held_out(col="doc_id"):
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(3)) == 1


def training_sample(docs: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Normalised training text per language."""
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(), F.lit(False))))
    short = F.length("text") <= SAMPLE_TEXT
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.when(short, 1)).alias("n")).collect()}
    if not sizes:
        return {}
    spread = 1_000_000
    take = F.lit(0)
    for lang, n in sizes.items():  # three times what is needed, by hash; all of a small language
        take = F.when(F.col("lang") == lang, min(spread, -(-3 * SAMPLE_DOCS * spread // max(1, n)))).otherwise(take)
    picked = (rows.withColumn("h", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(spread)))
              .filter(short & (F.col("h") < take)).select("lang", "h", "doc_id", "text"))
    out: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["h"], r["doc_id"] is None, r["doc_id"] or 0, r["text"])):
        part = normalise(r["text"])
        if part and (not size.get(r["lang"]) or size[r["lang"]] + len(part) <= chars):
            out.setdefault(r["lang"], []).append(part)
            size[r["lang"]] = size.get(r["lang"], 0) + len(part) + 1
    long = [lang for lang in sizes if lang not in out]
    if long:  # one text of each such language
        least = F.min_by("text", F.struct(F.length("text"), "text"))
        with_letter = rows.filter(F.col("lang").isin(long) & F.col("text").rlike(r"\p{L}"))
        for r in with_letter.groupBy("lang").agg(least.alias("text")).collect():
            out[r["lang"]] = [normalise(r["text"])]
    return {lang: " ".join(parts) for lang, parts in sorted(out.items()) if any(parts)}


def suffix_automaton(text: str, symbol: dict[str, int], width: int) -> np.ndarray:
    """Transition table (state * width + symbol -> state * width, or -1) of all substrings."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for ch in text:
        c = symbol[ch]
        cur = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.full(len(step) * width, -1, np.int32)
    for state, arcs in enumerate(step):
        for c, to in arcs.items():
            table[state * width + c] = to * width
    return table


def _advance(table: np.ndarray, state: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after one more symbol each, and the phrases that end with it."""
    to = table[state + sym]
    more = np.zeros(len(to), np.int8)
    miss = np.flatnonzero(to < 0)
    if len(miss):
        again = table[sym[miss]]  # a phrase ends; the next one starts with this character,
        more[miss] = (state[miss] > 0).astype(np.int8) + (again < 0)  # or is it, if no text has it
        to[miss] = np.maximum(again, 0)
    return to, more


def _join_blocks(table, flat, start, size, before, after, end, total) -> None:
    """Correct ``end`` (state after each block) and ``total`` (phrases ended in it) of blocks run from state 0.

    A block is run from its old and its new start state together until the states
    meet: from there on nothing differs. If they don't meet, the next block's start changes too.
    """
    begin = np.zeros(len(start), np.int32)
    todo = np.flatnonzero(before >= 0)
    for _ in range(ROUNDS):
        todo = todo[end[before[todo]] != begin[todo]]
        if not len(todo):
            return
        old, new = begin[todo], end[before[todo]]
        begin[todo] = new
        at, changed, i = todo, [], 0
        while len(at):
            sym = flat[start[at] + i]
            old, less = _advance(table, old, sym)
            new, more = _advance(table, new, sym)
            total[at] += more - less
            i += 1
            over = (size[at] == i) & (old != new)
            if over.any():
                end[at[over]] = new[over]
                changed.append(at[over])
            on = (old != new) & ~over
            at, old, new = at[on], old[on], new[on]
        todo = np.concatenate(changed) if changed else todo[:0]
        todo = after[todo]
        todo = todo[todo >= 0]
    # periodic text, whose runs need not meet: from each such block on in order, every block once
    arc = memoryview(table)
    for j in todo[np.argsort(start[todo])].tolist():
        while j >= 0 and end[before[j]] != begin[j]:
            old, new = int(begin[j]), int(end[before[j]])
            begin[j] = new
            for sym in flat[start[j]:start[j] + size[j]].tolist():
                a, b, root = arc[old + sym], arc[new + sym], arc[sym]
                if a < 0:
                    total[j] -= (old > 0) + (root < 0)
                    a = max(root, 0)
                if b < 0:
                    total[j] += (new > 0) + (root < 0)
                    b = max(root, 0)
                old, new = a, b
                if old == new:
                    break
            else:
                end[j] = new
                j = int(after[j])
                continue
            break


class CrossParser:
    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        alphabet = sorted(set().union(*map(set, samples.values()), " "))
        symbol = {c: i for i, c in enumerate(alphabet)}
        width = len(alphabet) + 1  # the last symbol is a character no language has
        self.space, self.unknown = symbol[" "], len(alphabet)
        self.tables = [suffix_automaton(samples[lang], symbol, width) for lang in self.langs]
        self.bits = np.array([math.log2(len(samples[lang]) + 1) for lang in self.langs])
        self.code = np.full(0x3000, self.unknown, np.int16)
        self.far = {}
        for c, i in symbol.items():
            if ord(c) < len(self.code):
                self.code[ord(c)] = i
            else:
                self.far[ord(c)] = i

    def _symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out = np.where(points < len(self.code), self.code[np.minimum(points, len(self.code) - 1)], self.unknown)
        for c, i in self.far.items():
            out[points == c] = i
        return out

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each normalised text against each language."""
        if not texts:
            return np.zeros((0, len(self.langs)), np.int64)
        data = [self._symbols(t) for t in texts]
        lens = np.array([*map(len, data)], np.int64)
        blocks = -(-lens // BLOCK)
        of = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(lens) - lens, blocks) + nth * BLOCK
        size = np.minimum(BLOCK, lens[of] - nth * BLOCK)
        flat = np.concatenate(data).astype(np.int32)
        order = np.argsort(-size, kind="stable")
        start, size, of, nth = start[order], size[order], of[order], nth[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        last = nth == blocks[of] - 1
        before = np.where(nth > 0, rank[np.maximum(order - 1, 0)], -1)
        after = np.where(last, -1, rank[np.minimum(order + 1, len(order) - 1)])
        count = np.zeros((len(of), len(self.langs)), np.int64)
        alive = np.searchsorted(-size, -np.arange(1, BLOCK + 1), "right")  # blocks longer than the step
        for k, table in enumerate(self.tables):
            state = np.zeros(len(of), np.int32)
            total = count[:, k]
            for i in range(int(size[0])):
                n = alive[i]
                state[:n], more = _advance(table, state[:n], flat[start[:n] + i])
                total[:n] += more
            _join_blocks(table, flat, start, size, before, after, state, total)
            total += last & (state > 0)
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(out, of, count)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        clean = [normalise(t) if t and _LETTER.search(t) else "" for t in texts]
        at = [i for i, t in enumerate(clean) if t]
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if at and self.langs:
            cost = self.phrases([clean[i] for i in at]) * self.bits
            best = cost.argmin(axis=1)
            # shares of 1 / cost^8: near 1 when the others need clearly more phrases
            share = (cost.min(axis=1, keepdims=True) / cost) ** 8
            score[at] = 1 / share.sum(axis=1)
            for i, b in zip(at, best.tolist(), strict=True):
                lang[i] = self.langs[b]
        return lang, score


def _parser(samples: dict[str, str]) -> CrossParser:
    return held(("langid", hash(tuple(sorted(samples.items())))), lambda: CrossParser(samples))


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, samples: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    samples = training_sample(docs) if samples is None else samples
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # at most SAMPLE_CHARS per language

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _parser(shared.value).predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"])
    narrow = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                         F.col("text").cast("string"))
    return map_batches(narrow, run, PREDICTED, holds=True)


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents with a language, all columns; ``und`` ones go. Each row is judged by its own text."""
    from .common import per_row

    samples = training_sample(docs)
    return per_row(docs, lambda rows: _keep(rows, samples))


def _keep(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    found = identify(docs, samples).groupBy("doc_id").agg(
        F.count("*").alias("n_rows"), F.bool_and(F.col("lang_pred") != UNDETERMINED).alias("ok"))
    from .common import BROADCAST_IDS, stage

    found = stage(found, "languages")
    gone = found.filter("NOT ok").select(F.col("doc_id").alias("__gone"))
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone.hint("shuffle_hash")
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("__gone")), "left_anti")
