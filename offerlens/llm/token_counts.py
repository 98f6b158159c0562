"""Token counts of sections, from one encoding of each whole document.

A document is encoded once with a byte-level BPE vocabulary. Its tokens concatenate to its
bytes, so running lengths give the span of every token; spans are joined with the sections'
intervals by binary search. Tokens that lie in two sections or more are allocated by rule:

* ``start``: to the section of their first byte;
* ``most``: to the section with most of their bytes, the earlier one on a tie (the
  production rule: a word that brings the space before it counts where the word is);
* ``split``: to every section by its share of their bytes.

Sections are sentences: they end behind a line break, or behind the white space that follows
a full stop, a question mark or an exclamation mark. Counts of the sections add up to the
document's under every rule.

Defined results: a missing or empty text is one empty section without tokens; repeated rows
give equal rows; special tokens' strings are ordinary text; texts are never cut.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranks of the vocabulary; readable by every executor, and never part of this repository.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are split before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("start", "most", "split")

_loaded: dict = {}


def encoder(path: str):
    """(encode, byte length of every token) of the vocabulary, read once per process."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        coding = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        _loaded[path] = coding.encode_ordinary, lengths
    return _loaded[path]


def sentence_bounds(data: np.ndarray) -> np.ndarray:
    """Byte bounds of the sentences; a text always has one."""
    if len(data) < 2:
        return np.array([0, len(data)])
    space = (data[:-1] == 32) | ((data[:-1] >= 9) & (data[:-1] <= 13))
    ended = np.zeros(len(space), dtype=bool)
    ended[1:] = np.isin(data[:-2], (33, 46, 63))
    cuts = np.flatnonzero((data[:-1] == 10) | (space & ended)) + 1
    return np.concatenate(([0], cuts, [len(data)]))


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, tokens of each section that reach into another one).

    ``ends`` are the byte ends of consecutive tokens, ``bounds`` those of the sections.
    """
    n = len(bounds) - 1
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends, "left") - 1
    shares, touched = np.bincount(first, minlength=n).astype(float), np.zeros(n, dtype=np.int64)
    crossing = np.flatnonzero(last > first)
    if not len(crossing):
        return shares, touched
    # One row per crossing token and section it lies in.
    spread = last[crossing] - first[crossing] + 1
    token = np.repeat(crossing, spread)
    section = np.arange(len(token)) - np.repeat(np.cumsum(spread) - spread, spread) + first[token]
    np.add.at(touched, section, 1)
    if rule == "start":
        return shares, touched
    part = np.minimum(bounds[section + 1], ends[token]) - np.maximum(bounds[section], starts[token])
    np.subtract.at(shares, first[crossing], 1)
    if rule == "split":
        np.add.at(shares, section, part / (ends[token] - starts[token]))
    else:
        order = np.lexsort((section, -part, token))
        best = order[np.concatenate(([True], token[order][1:] != token[order][:-1]))]
        np.add.at(shares, section[best], 1)
    return shares, touched


def section_counts(docs: DataFrame, rule: str = "most", vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """(doc_id, section, start_char, end_char, n_tokens, n_crossing), one row per section of every row."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lengths = encoder(vocabulary)
        for batch in batches:
            made: list[tuple] = []
            rows = 0
            for row, whole in enumerate(batch.column(1)):
                whole = whole.as_py() or ""
                data = np.frombuffer(whole.encode("utf-8"), dtype=np.uint8)
                bounds = sentence_bounds(data)
                ends = np.cumsum(lengths[np.array(encode(whole), dtype=np.int64)])
                tokens, touched = attribute(ends, bounds, rule)
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
                n = len(tokens)
                made.append((np.full(n, row), np.arange(n), chars[:-1], chars[1:], tokens, touched))
                rows += n
                if rows > 50_000:
                    yield _batch(batch.column(0), made)
                    made, rows = [], 0
            if rows:
                yield _batch(batch.column(0), made)

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string")).mapInArrow(
        counts, "doc_id long, section long, start_char long, end_char long, n_tokens double, n_crossing long"
    )


def _batch(doc_ids: pa.Array, made: list[tuple]) -> pa.RecordBatch:
    row, *columns = (np.concatenate(values) for values in zip(*made, strict=True))
    return pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(row)), *map(pa.array, columns)],
        names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"],
    )
