"""Chat formatting: whole conversations as marked-up text, token ids, and loss masks aligned by offsets.

A turn is rendered as ``### role: text</turn>`` and a line feed. A backslash before
a control string (``###``, ``</turn>``, a backslash; in roles also a colon)
keeps it apart from the markers, so every text comes back exactly.

A conversation is rendered turn after turn and encoded once, with character offsets. The
spans of the turns' texts are sorted; the tokens that meet a span are found by binary search in the
token ends and starts, and clipped to it. The loss mask covers the texts of the trained roles.

A conversation longer than ``block_chars`` is encoded in blocks cut between turns. That
changes no token: a turn ends in ``>`` and a line feed and starts with ``#``, and the
pre-tokeniser always divides there. Rows are dealt by ranges of (conversation, turn),
so a huge conversation is rendered and encoded by many tasks; only its running digests
(``digests``) are sequential, which reads the blocks as a stream and holds one at a time.

Rows are ordered by turn, ties by role and text; a null turn comes first, a null
role or text is empty, a null ``conv_id`` is a conversation of its own. Repeated rows are separate turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "### ", ": ", "</turn>\n"
_TEXT_MARKS = re.compile(r"\\|###|</turn>")
_ROLE_MARKS = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]++|\\(?:\\|###|</turn>|:))*+): "
                   r"((?:[^\\<]++|\\(?:\\|###|</turn>)|<(?!/turn>))*+)</turn>\n")
_ORDER = ["conv_id", "turn", "role", "text_hash", "text"]
_BLOCK_SHAPE = ("conv_id long, turn long, role string, text_hash long, part long, n_turns long, formatted string, "
                "ids binary, mask_from array<int>, mask_to array<int>, span_from array<int>, span_to array<int>")


def escape(text: str, role: bool = False) -> str:
    return (_ROLE_MARKS if role else _TEXT_MARKS).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns, and where each turn's text lies in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role, role=True) + MID, escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def mask(offsets: list[tuple[int, int]], spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token range and clipped characters of each span: (first token, one past the last, spans).

    Token offsets may leave out a leading space and repeat a character that several
    tokens share, so a token is taken to reach from the end of the one before.
    """
    if not offsets or not len(spans):
        return np.zeros(0, int), np.zeros(0, int), np.zeros((0, 2), int)
    end = np.maximum.accumulate(np.array(offsets)[:, 1])
    start = np.concatenate(([0], end[:-1]))
    spans = spans[spans[:, 1] > spans[:, 0]]
    lo = np.searchsorted(end, spans[:, 0], side="right")
    hi = np.searchsorted(start, spans[:, 1], side="left")
    clipped = np.column_stack((np.maximum(start[lo], spans[:, 0]), np.minimum(end[hi - 1], spans[:, 1])))
    return lo, hi, clipped


def _format_rows(tokenizer: str, trained: tuple[str, ...], block_chars: int):
    columns = [c.split()[0] for c in _BLOCK_SHAPE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = Tokenizer.from_file(tokenizer)
        tok.encode_special_tokens = True
        ready, size, turns, chars, key, part = [], 0, [], 0, None, 0

        def close():
            nonlocal turns, chars, part, size
            if turns:
                text, spans = render(turns)
                loss = np.array([s for s, (role, _) in zip(spans, turns) if role in trained], int).reshape(-1, 2)
                ready.append((key, part, len(turns), text, loss))
                size += len(text)
                turns, chars, part = [], 0, part + 1

        def done() -> pd.DataFrame:
            nonlocal ready, size
            rows = []
            codes = tok.encode_batch([r[3] for r in ready], add_special_tokens=False)
            for (k, p, n, text, loss), code in zip(ready, codes):
                lo, hi, spans = mask(code.offsets, loss)
                rows.append((*k, p, n, text, np.array(code.ids, "<u4").tobytes(), lo, hi, spans[:, 0], spans[:, 1]))
            ready, size = [], 0
            out = pd.DataFrame(rows, columns=columns)
            for c in ("conv_id", "turn", "text_hash"):
                out[c] = pd.array([None if pd.isna(x) else int(x) for x in out[c]], "Int64")
            return out
        conv = ()
        for pdf in batches:
            for c, t, r, h, x in zip(*(pdf[c] for c in _ORDER)):
                c, t = (None if pd.isna(v) else int(v) for v in (c, t))
                if conv != (c,) or chars >= block_chars:
                    close()
                    key = (c, t, r, h)
                    if conv != (c,):
                        conv, part = (c,), 0
                turns.append((r, x))
                chars += len(x)
            if size > 1_000_000:
                yield done()
        close()
        yield done()
    return run


def format_conversations(conversations: DataFrame, tokenizer: str, trained: tuple[str, ...] = ("assistant",),
                         block_chars: int = 65_536) -> DataFrame:
    """Formatted blocks of ``conversations`` (conv_id, turn, role, text), one row a block.

    ``formatted``: the text; ``ids``: token ids, little-endian unsigned 32-bit; ``mask_from``,
    ``mask_to``: token ranges under the loss mask; ``span_from``, ``span_to``: their
    characters in ``formatted``. A conversation's blocks in order of (turn, role, text_hash,
    part) make up its whole text.
    """
    spark = conversations.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.xxhash64(text).alias("text_hash"), text.alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *_ORDER[:4]).sortWithinPartitions(*_ORDER[:4])
    return dealt.mapInPandas(_format_rows(tokenizer, trained, block_chars), _BLOCK_SHAPE)


def _digest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state, conv = None, ()

    def row():
        return (conv[0], state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])
    for pdf in batches:
        out = []
        for c, text, a, b in zip(pdf["conv_id"], pdf["formatted"], pdf["span_from"], pdf["span_to"]):
            c = None if pd.isna(c) else int(c)
            if conv != (c,):
                if conv:
                    out.append(row())
                conv = (c,)
                state = {"n": 0, "chars": 0, "loss_chars": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
            for role, body in parse(text):
                state["turns"].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                state["n"] += 1
            for i, j in zip(a, b):
                body = unescape(text[i:j])
                state["loss"].update(body.encode("utf-8", "surrogatepass"))
                state["loss_chars"] += len(body)
            state["chars"] += len(text)
        yield _digest_frame(out)
    if conv:
        yield _digest_frame([row()])


def _digest_frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    out["conv_id"] = pd.array(out["conv_id"].tolist(), "Int64")
    return out


def digests(blocks: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted blocks: turns, text under the loss mask, and their SHA-256.

    The turns are parsed from the text and unescaped; the loss text is what lies under the mask.
    """
    order = ["conv_id", "turn", "role", "text_hash", "part"]
    rows = blocks.select(*order, "formatted", "span_from", "span_to").repartition("conv_id").sortWithinPartitions(*order)
    return rows.mapInPandas(_digest_rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                          "loss_sha256 string, formatted_chars long")
