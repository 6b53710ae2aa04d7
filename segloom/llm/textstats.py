"""Counts over whole texts, as bytes: what quality rules and the quality classifier look at."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from segloom.llm.common import spans_of, text_bytes

SYMBOLS = b"#*$%&|<>"
#: Classes of bytes: the index of the first group that has it. Later groups are ranges.
GROUPS = (b"\n", b" ", b"\t\v\f\r", SYMBOLS, b"!", b".", b",", b"?;:", b"\"'()[]{}", b"-_/\\+=~^@`")
UPPER, LOWER, DIGIT, LEAD, CONT, CONTROL = range(len(GROUPS), len(GROUPS) + 6)
CLASSES = 16


def _classes() -> np.ndarray:
    table = np.full(256, CONTROL, np.uint8)
    table[ord("A") : ord("Z") + 1], table[ord("a") : ord("z") + 1], table[ord("0") : ord("9") + 1] = UPPER, LOWER, DIGIT
    table[128:192], table[192:] = CONT, LEAD
    for i, group in enumerate(GROUPS):
        table[np.frombuffer(group, np.uint8)] = i
    return table


CLASS_OF = _classes()


def pair_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text the counts of its CLASSES x CLASSES pairs of neighbouring byte classes, as float64 rows."""
    n = len(at) - 1
    out = np.zeros((n, CLASSES * CLASSES))
    for i, j in spans_of(at):
        part = CLASS_OF[data[at[i] : at[j]]]
        if len(part) < 2:
            continue
        row = np.repeat(np.arange(j - i, dtype=np.int32), np.diff(at[i : j + 1]))
        same = row[1:] == row[:-1]
        pair = (row[:-1] * 256 + part[:-1].astype(np.int32) * 16 + part[1:])[same]
        out[i:j] = np.bincount(pair, minlength=(j - i) * 256)[: (j - i) * 256].reshape(j - i, 256)
    return out


def class_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each text the counts of its byte classes, int64."""
    n = len(at) - 1
    out = np.zeros((n, CLASSES), np.int64)
    for i, j in spans_of(at):
        row = np.repeat(np.arange(j - i, dtype=np.int32), np.diff(at[i : j + 1]))
        out[i:j] = np.bincount(row * 16 + CLASS_OF[data[at[i] : at[j]]], minlength=(j - i) * 16)[: (j - i) * 16].reshape(j - i, 16)
    return out


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """How many words lie in a window of `width` words that the text holds twice or more, the first one included."""
    grams = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    first: dict[tuple, int] = {}
    hit = [first.setdefault(g, i) for i, g in enumerate(grams)]
    again = np.zeros(len(grams) + 1, bool)
    where = np.array(hit)
    later = np.nonzero(where != np.arange(len(hit)))[0]
    again[later] = again[where[later]] = True
    starts = np.nonzero(again)[0]
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


#: Columns of stats(), all long.
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bang", "n_stay", "n_stop", "n_distinct")


def stats(column: pa.Array) -> list[np.ndarray]:
    """COLUMNS for each text of a string column; null counts as empty."""
    data, at = text_bytes(column)
    counts = class_counts(data, at)
    n = len(at) - 1
    out = np.zeros((len(COLUMNS), n), np.int64)
    raw = data.tobytes()
    for i in range(n):
        text = raw[at[i] : at[i + 1]]
        words = text.split()
        m = len(words)
        out[0, i] = m
        if m:
            out[5, i], out[3, i] = line_counts(text)
            distinct = len(set(words))
            out[11, i] = distinct
            if distinct < m:  # else no word, so no window, comes twice
                out[4, i] = repeat_words(words)
                out[9, i] = sum(map(bytes.__eq__, words[1:], words))
    white = counts[:, :3].sum(1)
    out[1] = counts.sum(1) - counts[:, CONT] - white
    out[2], out[6], out[7], out[8], out[10] = counts[:, 3], counts[:, UPPER], counts[:, LOWER], counts[:, 4], counts[:, 5] + counts[:, 6]
    return list(out)


__all__ = ["COLUMNS", "class_counts", "line_counts", "pair_counts", "repeat_words", "stats"]
