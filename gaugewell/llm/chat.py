"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the sorted
spans of the turns that carry loss are intersected with the token spans by binary search.
Control strings are tokens of their own, so no token crosses the edge of a turn.

Control strings inside texts are escaped: a backslash goes in after their first
character, and one more where backslashes already stand there, so the way back is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = (TURN, TEXT, END)
LOSS_ROLES = ("assistant",)

# Openings of control strings, of this template and of other well-known ones: <| </s> <s> [INST] [/INST]
_TAIL = r"(?=\||/?s>|/?INST\])"
_PLAIN = re.compile(r"([<\[])(\\*)" + _TAIL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _TAIL)
_RENDERED = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]], loss_roles=LOSS_ROLES) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the sorted character spans that carry loss."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role in loss_roles and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(r), unescape(t)) for r, t in _RENDERED.findall(formatted)]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens overlap a span: for each token the last span that starts before its end, by binary search."""
    if not spans:
        return np.zeros(len(starts), bool)
    lo, hi = np.array(spans).T
    at = np.searchsorted(lo, ends, side="left") - 1
    return (at >= 0) & (hi[np.maximum(at, 0)] > starts) & (ends > starts)


def masked_spans(starts: list[int], ends: list[int], mask: list[bool]) -> list[tuple[int, int]]:
    """Character spans under the mask; tokens of one split character count once."""
    spans: list[list[int]] = []
    for lo, hi, on in zip(starts, ends, mask):
        if on:
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], hi)
            else:
                spans.append([lo, hi])
    return [(a, b) for a, b in spans]


def load_tokenizer(path: str):
    """The tokenizer with the control strings as tokens of their own."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROLS])
    return tokenizer


def format_conversations(conversations: DataFrame, tokenizer_path: str, loss_roles=LOSS_ROLES) -> DataFrame:
    """One row per conversation: conv_id, formatted, ids, starts, ends, mask.

    Input: conv_id, turn, role, text.  Turns are taken by turn, then role, then text; NULL
    roles and texts are empty, a NULL turn comes first, a NULL conv_id is one conversation,
    repeated rows are turns of their own.  ``starts`` and ``ends`` are the tokens' places in
    ``formatted``, in code points; ``mask`` marks the tokens that carry loss.
    Rows are sorted inside a partition and read as a stream, so a task holds one
    conversation at a time.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)

        def rows(done: list[tuple[object, list]]) -> pa.RecordBatch:
            rendered = [render(turns, loss_roles) for _, turns in done]
            encoded = tokenizer.encode_batch([r for r, _ in rendered], add_special_tokens=False)
            ids, starts, ends, masks = [], [], [], []
            for (_, spans), e in zip(rendered, encoded):
                at = np.array(e.offsets, np.int32).reshape(-1, 2)
                ids.append(e.ids)
                starts.append(at[:, 0])
                ends.append(at[:, 1])
                masks.append(loss_mask(at[:, 0], at[:, 1], spans))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, _ in done], id_type),
                    pa.array([r for r, _ in rendered], pa.string()),
                    pa.array(ids, ints),
                    pa.array(starts, ints),
                    pa.array(ends, ints),
                    pa.array(masks, pa.list_(pa.bool_())),
                ],
                ["conv_id", "formatted", "ids", "starts", "ends", "mask"],
            )

        conv, turns, done, size = object(), [], [], 0
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if c != conv:
                    if turns:
                        done.append((conv, turns))
                    if size > 500_000:
                        yield rows(done)
                        done, size = [], 0
                    conv, turns = c, []
                turns.append((role or "", text or ""))
                size += len(text or "") + 40
        if turns:
            done.append((conv, turns))
        if done:
            yield rows(done)

    ordered = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        run,
        f"conv_id {kind}, formatted string, ids array<int>, starts array<int>, ends array<int>, mask array<boolean>",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output of :func:`format_conversations` says, read from it alone.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens,
    n_loss_tokens.
    """
    from hashlib import sha256

    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = "n_turns turns_sha256 loss_chars loss_sha256 formatted_chars n_tokens n_loss_tokens".split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, starts, ends, mask in zip(*(batch.column(n) for n in ("formatted", "starts", "ends", "mask"))):
                text, mask = text.as_py(), mask.as_py()
                turns = parse(text)
                spans = masked_spans(starts.as_py(), ends.as_py(), mask)
                loss = "".join(unescape(text[lo:hi]) for lo, hi in spans)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((len(turns), sha256(whole.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(text), len(mask), sum(mask)))
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["conv_id", *names]
            )

    return formatted.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "n_tokens long, n_loss_tokens long",
    )
