"""Quality rules: base counts of words, lines and symbols, and repetition found by a suffix array over words.

The suffix array of each text is built by prefix doubling, for many texts at once, sorting only suffixes that are
still tied. The longest common prefix of neighbours gives each word position the longest repeated word sequence that
starts there; the union of these spans is the union of all maximal repeated substrings. A text fails when repeated
passages of `min_passage` words or more cover over `max_covered` of its words, or when the longest repeat is longer than
`max_longest` words and that is over `max_longest_share` of the text (a long text may quote one long passage twice).
Repeats of `min_repeat` words are counted only: clean documents have up to 49 percent of their words in repeats of 8.

Defined results: null text has no words and fails the base rule; an empty text too. Other columns are ignored and
repeated rows kept. Memory in a task follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quotewell.llm import words
from quotewell.llm.memory import tidy

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


MIN_PASSAGE = 20  # the longest repeat in a labelled document that passes the base rule has 13 words


def _per_text(where: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the ascending positions fall into each text."""
    return np.diff(np.searchsorted(where, offsets))


def repeat_lengths(labels: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word position the length of the longest sequence from there that occurs again in the same text."""
    n = len(labels)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    _, rank, counts = np.unique(words.mix(labels + doc.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[rank]  # tied suffixes share the place of the first of them
    end = bounds[1:][doc]
    sizes = np.zeros(n + 1, np.int64)
    np.add.at(sizes, rank, 1)
    tied = np.flatnonzero(sizes[rank] > 1)
    levels, step = [(1, rank.copy())], 1
    while len(tied):
        ahead = tied + step
        behind = np.where(ahead < end[tied], rank[np.minimum(ahead, n - 1)], -1)
        order = np.lexsort((behind, rank[tied]))
        tied, behind = tied[order], behind[order]
        group = rank[tied]
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_part = new_group | np.concatenate([[True], behind[1:] != behind[:-1]])
        index = np.arange(len(tied))
        start = np.maximum.accumulate(np.where(new_group, index, 0))
        part = np.maximum.accumulate(np.where(new_part, index, 0))
        rank[tied] = group + part - start
        alone = new_part & np.concatenate([new_part[1:], [True]])
        tied = tied[~alone]
        step *= 2
        if len(tied):
            levels.append((step, rank.copy()))
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    first_words = levels[0][1]
    near = np.flatnonzero(first_words[suffixes[1:]] == first_words[suffixes[:-1]])  # neighbours that share a word
    i, j = suffixes[near], suffixes[near + 1]
    common = np.zeros(len(near), np.int64)
    for length, ranks in reversed(levels):
        a, b = i + common, j + common
        fits = (a < end[i]) & (b < end[j])
        common += length * (fits & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)]))
    np.maximum.at(out, i, common)
    np.maximum.at(out, j, common)
    return out


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a span [p, p + lengths[p]) of at least `least` words."""
    starts = np.flatnonzero(lengths >= least)
    edge = np.zeros(len(lengths) + 1, np.int64)
    edge[: len(lengths)] += np.bincount(starts, minlength=len(lengths))
    edge += np.bincount(starts + lengths[starts], minlength=len(lengths) + 1)[: len(lengths) + 1] * -1
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, min_repeat: int, min_passage: int = MIN_PASSAGE) -> dict[str, np.ndarray]:
    """Counts for each text of a slice."""
    w = words.Words(data, offsets)
    n_texts = len(offsets) - 1
    breaks = np.union1d(np.flatnonzero(data == 10), offsets[1:])  # line ends
    starts = np.concatenate([[0], breaks[:-1] + (data[np.minimum(breaks[:-1], len(data) - 1)] == 10)]) if len(breaks) else np.empty(0, np.int64)
    # A text that starts where a line ended without a newline starts there; one after a newline starts behind it.
    starts = np.minimum(np.maximum(starts, 0), breaks) if len(breaks) else starts
    text_of = np.searchsorted(offsets, starts, "right") - 1
    full = np.searchsorted(w.starts, breaks) > np.searchsorted(w.starts, starts)
    starts, ends, text_of = starts[full], breaks[full], text_of[full]
    lines = words.mix(words.run_hashes(data, starts, ends) + text_of.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    _, firsts = np.unique(lines, return_index=True)
    lengths = repeat_lengths(w.hash, w.doc, w.bounds)
    longest = np.zeros(n_texts, np.int64)
    np.maximum.at(longest, w.doc, lengths)
    return {
        "n_words": w.counts,
        "word_chars": _per_text(np.flatnonzero(words.code_points(data) & ~words.WHITE[data]), offsets),
        "n_symbols": _per_text(np.flatnonzero(_SYMBOL[data]), offsets),
        "n_dup_lines": np.bincount(text_of, minlength=n_texts) - np.bincount(text_of[firsts], minlength=n_texts),
        "n_repeat_words": np.bincount(w.doc, weights=covered(lengths, 3), minlength=n_texts).astype(np.int64),
        "longest_repeat": longest,
        "n_covered_words": np.bincount(w.doc, weights=covered(lengths, min_repeat), minlength=n_texts).astype(np.int64),
        "n_passage_words": np.bincount(w.doc, weights=covered(lengths, min_passage), minlength=n_texts).astype(np.int64),
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "n_covered_words"]


def verdicts(
    c: dict[str, np.ndarray], min_words: int, max_repeat_percent: int, max_covered: float, max_longest: int, max_longest_share: float
) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of counted texts."""
    failed = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > max_repeat_percent * c["n_words"])
    repeats = c["n_passage_words"] > max_covered * c["n_words"]
    long = (c["longest_repeat"] > max_longest) & (c["longest_repeat"] > max_longest_share * c["n_words"])
    return failed, ~(failed | repeats | long)


# A longest repeat that is not periodic covers twice its share: at less than half of max_covered, each of the two limits
# rejects texts that the other keeps.
LIMITS = {"min_words": 50, "max_repeat_percent": 50, "max_covered": 0.2, "max_longest": 30, "max_longest_share": 0.05}


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", min_repeat: int = 8, min_passage: int = MIN_PASSAGE, **limits: float) -> DataFrame:
    """(key, counts, base_failed, kept) of every row, without a shuffle. `limits` replace LIMITS."""
    limits = {**LIMITS, **limits}
    numbers = [*COUNTS, "n_passage_words"]
    names = [key, *numbers, "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.slices(batch.column(1)):
                c = measure(data, offsets, min_repeat, min_passage)
                verdict = verdicts(c, **limits)
                arrays = [batch.column(0).slice(a, b - a), *(pa.array(c[n].astype(np.int64)) for n in numbers), *map(pa.array, verdict)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    counts = ", ".join(f"{n} bigint" for n in numbers)
    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {counts}, base_failed boolean, kept boolean")


def kept_rows(docs: DataFrame, text: str = "text", min_repeat: int = 8, min_passage: int = MIN_PASSAGE, **limits: float) -> DataFrame:
    """The rows of `docs`, with all their columns as they are, whose text is kept."""
    limits = {**LIMITS, **limits}
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in words.slices(batch.column(at)):
                _, kept = verdicts(measure(data, offsets, min_repeat, min_passage), **limits)
                yield batch.slice(a, b - a).filter(pa.array(kept))

    return docs.mapInArrow(tidy(run), docs.schema)
