r"""Operator 9, chat formatting: columnar byte assembly.

Each Arrow batch of turns is formatted without building a string per row:
segment lengths (header, content, footer), cumulative offsets and scatter
indices are computed in numpy, and headers, contents and footers are copied
into one preallocated Arrow buffer that becomes the output column.

Template, one segment per turn::

    system     <<SYS>>text<</SYS>>
    user       [INST] text [/INST]
    assistant  [ANS] text</s>            (the text is under the loss mask)
    other      [ROLE]name[/ROLE]text<</ROLE>>

A control string inside a text (or a role name) gets a backslash after its
first character, one more if backslashes stand there already, so a control
string never occurs in the output except as markup and :func:`parse` restores
the text exactly.

Defined cases: NULL text and NULL role count as empty strings (the empty role
is an "other" role). Turns are ordered by ``turn`` (NULL first), ties and
repeated rows by their formatted segment; none is dropped. A NULL ``conv_id`` is one
conversation of its own. Empty tables give empty tables; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches

HEADERS = {"system": b"<<SYS>>", "user": b"[INST] ", "assistant": b"[ANS] "}
FOOTERS = {"system": b"<</SYS>>", "user": b" [/INST]", "assistant": b"</s>"}
OTHER = (b"[ROLE]", b"[/ROLE]", b"<</ROLE>>")
CONTROL = r"(</?SYS>>|/?INST\]|ANS\]|/?ROLE\]|</ROLE>>|/?s>)"  # after the first character
_ESCAPE = r"([<\[])(\\*)" + CONTROL
_UNESCAPE = re.compile((r"([<\[])(\\*)\\" + CONTROL).encode())

SEGMENTS = "conv_id long, turn long, segment binary, loss_start int, loss_len int"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, pattern=_ESCAPE, replacement=r"\1\2\\\3")


def unescape(raw: bytes) -> bytes:
    return _UNESCAPE.sub(rb"\1\2\3", raw) if b"\\" in raw else raw


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, start: np.ndarray, lens: np.ndarray) -> None:
    """``out[at[i] : at[i] + lens[i]] = data[start[i] : start[i] + lens[i]]`` for all i."""
    total = int(lens.sum())
    if total:
        base = np.cumsum(lens) - lens
        step = np.arange(total, dtype=np.int64)
        out[np.repeat(at - base, lens) + step] = data[np.repeat(start - base, lens) + step]


def _bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Data, starts and lengths of a large_string/large_binary column without nulls."""
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(1, np.uint8)
    return data, offsets[:-1].astype(np.int64), np.diff(offsets)


def assemble(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Format a batch ``conv_id, turn, role, text`` into SEGMENTS."""
    role = pc.fill_null(batch.column("role").cast(pa.large_string()), "")
    text = escape(pc.fill_null(batch.column("text").cast(pa.large_string()), ""))
    kinds = pa.array([*HEADERS])
    kind = pc.fill_null(pc.index_in(role, value_set=kinds.cast(pa.large_string())), len(HEADERS)).to_numpy().astype(np.int64)
    names = pc.if_else(pa.array(kind == len(HEADERS)), escape(role), pa.scalar("", pa.large_string()))

    def marks(table: list[bytes]):
        return (np.frombuffer(b"".join(table), np.uint8),
                np.cumsum([0, *map(len, table)])[:-1].astype(np.int64)[kind], np.array([*map(len, table)], np.int64)[kind])

    n = batch.num_rows
    # five pieces per turn: opening, role name, its end, content, closing
    pieces = [marks([*HEADERS.values(), OTHER[0]]), _bytes_of(names),
              marks([b""] * len(HEADERS) + [OTHER[1]]), _bytes_of(text), marks([*FOOTERS.values(), OTHER[2]])]
    lens = np.stack([p[2] for p in pieces], axis=1)
    ends = np.cumsum(lens.ravel())
    at = (ends - lens.ravel()).reshape(n, len(pieces))
    out = pa.allocate_buffer(int(ends[-1]) if n else 0)
    view = np.frombuffer(out, np.uint8)
    for i, (data, start, size) in enumerate(pieces):
        _scatter(view, at[:, i], data, start, size)
    offsets = np.concatenate([at[:, 0], ends[-1:]]).astype(np.int64)
    segment = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), out])
    loss = kind == [*HEADERS].index("assistant")
    return pa.RecordBatch.from_arrays(
        [batch.column("conv_id").cast(pa.int64()), batch.column("turn").cast(pa.int64()), segment.cast(pa.binary()),
         pa.array(np.where(loss, at[:, 3] - at[:, 0], 0).astype(np.int32)),
         pa.array(np.where(loss, lens[:, 3], 0).astype(np.int32))],
        names=["conv_id", "turn", "segment", "loss_start", "loss_len"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """One formatted segment per turn with the byte span under the loss mask.

    Concatenating the segments of a conversation by ``(turn, segment)`` gives
    its training text; a segment per turn keeps the work even however long
    one conversation is.
    """
    narrow = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                          F.col("role").cast("string"), F.col("text").cast("string"))
    return map_batches(narrow, assemble, SEGMENTS)


_MARK = re.compile(rb"<<SYS>>|\[INST\] |\[ANS\] |\[ROLE\]")
_CLOSE = {b"<<SYS>>": (b"system", b"<</SYS>>"), b"[INST] ": (b"user", b" [/INST]"), b"[ANS] ": (b"assistant", b"</s>")}


def parse(formatted: bytes) -> list[tuple[bytes, bytes, int, int]]:
    """``(role, text, content start, content end)`` of each turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        mark = _MARK.match(formatted, at)
        if not mark:
            raise ValueError(f"no turn starts at byte {at}")
        at = mark.end()
        if mark[0] == OTHER[0]:
            end = formatted.index(OTHER[1], at)
            role, at, close = unescape(formatted[at:end]), end + len(OTHER[1]), OTHER[2]
        else:
            role, close = _CLOSE[mark[0]]
        end = formatted.index(close, at)
        turns.append((role, unescape(formatted[at:end]), at, end))
        at = end + len(close)
    return turns


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _code_points(raw: bytes) -> int:
    return len(raw.decode("utf-8", "surrogatepass")) if not raw.isascii() else len(raw)


def _digest(batches):
    """Stream sorted segments; the state is one conversation's running hashes."""
    class State:
        def __init__(self, conv):
            self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def row(self):
            return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)

    def out(rows):
        cols = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          names=[f.split()[0] for f in DIGESTS.split(", ")])

    state, seen = None, False
    for batch in batches:
        done = []
        for conv, raw, start, size in zip(batch.column("conv_id").to_pylist(), batch.column("segment").to_pylist(),
                                          batch.column("loss_start").to_pylist(), batch.column("loss_len").to_pylist(), strict=True):
            if not seen or state.conv != conv:
                if seen:
                    done.append(state.row())
                state, seen = State(conv), True
            state.chars += _code_points(raw)
            for role, text, _, _ in parse(raw):
                state.n += 1
                state.turns.update(role + b"\n" + text + b"\n")
            masked = unescape(raw[start:start + size])
            state.loss.update(masked)
            state.loss_chars += _code_points(masked)
        if done:
            yield out(done)
    if seen:
        yield out([state.row()])


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Read every conversation back from its formatted segments, in order.

    A hash over a conversation is sequential by definition, so one task
    streams it; it holds one Arrow batch and the running hashes, never the
    conversation. The sort spills.
    """
    ordered = segments.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.mapInArrow(_digest, DIGESTS)


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7 of the contract: control strings inside both texts."""
    tricky = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                 "conv_id long, turn long, role string, text string")


#: The template in SQL: every turn formatted, and the digests of what it was made of.
ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(</?SYS>>|/?INST\]|ANS\]|/?ROLE\]|</ROLE>>|/?s>)', '\1\2\\\3', 'g') AS esc,
         regexp_replace(role, '([<\[])(\\*)(</?SYS>>|/?INST\]|ANS\]|/?ROLE\]|</ROLE>>|/?s>)', '\1\2\\\3', 'g') AS name
  FROM t),
f AS (
  SELECT *, CASE role WHEN 'system' THEN '<<SYS>>' || esc || '<</SYS>>' WHEN 'user' THEN '[INST] ' || esc || ' [/INST]'
                      WHEN 'assistant' THEN '[ANS] ' || esc || '</s>'
                      ELSE '[ROLE]' || name || '[/ROLE]' || esc || '<</ROLE>>' END AS segment FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, segment)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, segment)) AS loss_sha256,
       CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
