"""Token counts per section: a document is encoded once, its token spans are joined to its sections."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary cuts a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(1)
def encoder(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(t) for t in ranks]
    return tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


def sections(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines of a text, line ends included; an empty text has one empty section."""
    ends = [m.end() for m in re.finditer(rb"\n", text)]
    if not ends or ends[-1] < len(text) or not text:
        ends.append(len(text))
    return np.array([0, *ends[:-1]]), np.array(ends)


def attribute(sizes: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section and how many of its tokens reach beyond it. ``rule`` deals a token that crosses a boundary:
    ``start`` to the section of its first byte, ``end`` of its last, ``split`` by bytes (counts are then fractions)."""
    stop = np.cumsum(sizes)
    first, last = (np.searchsorted(ends, x, "right") for x in (stop - sizes, stop - 1))
    n, cross = len(starts), first != last
    over = np.bincount(first[cross], minlength=n)[:n]
    if rule != "split":
        return np.bincount(first if rule == "start" else last, minlength=n)[:n].astype(float), over
    counts = np.bincount(first[~cross], minlength=n)[:n].astype(float)
    for a, b, lo, hi, size in zip(first[cross], last[cross], (stop - sizes)[cross], stop[cross], sizes[cross]):
        for k in range(a, b + 1):
            counts[k] += (min(hi, ends[k]) - max(lo, starts[k])) / size
    return counts, over


def count(docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "start") -> DataFrame:
    """doc_id, section (0 first), n_bytes, n_tokens and n_crossing for each line of each row.

    The vocabulary file (under 1 MB) is read on the driver and travels with the task. Null and empty texts have one
    section without tokens; equal rows give equal rows; the sections of a document sum up to its tokens. One text is
    held at a time.
    """
    with open(vocabulary, "rb") as f:
        known = f.read()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, lengths = encoder(known)
        for batch in batches:
            out, held = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text if isinstance(text, str) else ""
                starts, ends = sections(text.encode())
                counts, over = attribute(lengths[encode.encode_ordinary(text)], starts, ends, rule)
                out.append(pd.DataFrame({"doc_id": pd.array([doc_id] * len(starts), "Int64"), "section": np.arange(len(starts)),
                                         "n_bytes": ends - starts, "n_tokens": counts, "n_crossing": over}))
                held += len(starts)
                if held > 20_000:
                    yield pd.concat(out)
                    out, held = [], 0
            if out:
                yield pd.concat(out)

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInPandas(
        run, "doc_id long, section long, n_bytes long, n_tokens double, n_crossing long")
