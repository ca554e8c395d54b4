"""Token counts (operator 3): offset-mapped attribution of tokens to sections.

Each whole text is encoded once. Token ends are running sums of the tokens' byte lengths, mapped
to characters by counting UTF-8 lead bytes; sections are character ranges that tile the text in
order. An interval join by binary search finds the sections a token overlaps. A token that
crosses a boundary goes by `rule`: "most" (default) to the section that holds most of its
characters, the earliest of equals; "first" to the section of its first character. Every token
is allocated once, so a text's section counts add up to its token count. A character whose bytes
several tokens share counts for each of them.

By default a text's sections are its lines, each with its line feed. Another rule is a function
from a text to its ascending section ends (the last being its length).

Edge cases: null and empty texts have no tokens and no sections; empty sections get 0 tokens;
null ids are kept; repeated rows are counted each; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import DEFAULT, byte_lengths, encode

SCHEMA = "doc_id long, n_tokens long, n_sections int, n_crossing long, section_tokens array<int>"


def line_ends(text: str) -> np.ndarray:
    """Character ends of the lines of a text, each with its line feed."""
    ends, at = [], 0
    for line in text.split("\n")[:-1]:
        at += len(line) + 1
        ends.append(at)
    return np.array(ends + [len(text)] * (at < len(text)), np.int64)


def spans(text: str, vocabulary: str = DEFAULT) -> tuple[np.ndarray, np.ndarray]:
    """First and last character (exclusive) of each token of a non-empty text."""
    ends = np.cumsum(byte_lengths(vocabulary)[encode(text, vocabulary)])
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) == len(text):
        return np.concatenate([[0], ends[:-1]]), ends
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before a byte
    starts = np.concatenate([[0], ends[:-1]])
    return before[starts + 1] - 1, before[ends]


def allocate(first: np.ndarray, last: np.ndarray, ends: np.ndarray, rule: str = "most") -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens cross a boundary."""
    low = np.searchsorted(ends, first, side="right")
    high = np.searchsorted(ends, last - 1, side="right")
    crossing = np.flatnonzero(high > low)
    if rule == "most":
        for t in crossing:
            edges = np.concatenate([[first[t]], ends[low[t] : high[t]], [last[t]]])
            low[t] += int(np.argmax(np.diff(edges)))
    return np.bincount(low, minlength=len(ends)), len(crossing)


def token_counts(docs: DataFrame, sections: Callable[[str], np.ndarray] = line_ends, rule: str = "most", vocabulary: str = DEFAULT) -> DataFrame:
    """doc_id, n_tokens, n_sections, n_crossing and section_tokens of each row; one narrow pass."""
    if rule not in ("most", "first"):
        raise ValueError(f"unknown rule {rule!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text in b.column("text"):
                text = text.as_py()
                if text:
                    first, last = spans(text, vocabulary)
                    counts, crossing = allocate(first, last, sections(text), rule)
                    row = len(first), len(counts), crossing, counts.astype(np.int32)
                else:
                    row = 0, 0, 0, np.zeros(0, np.int32)
                for c, x in zip(out, row, strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.int32()))], ["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
