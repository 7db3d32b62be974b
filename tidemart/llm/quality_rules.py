"""Quality rules from repeated substrings (suffix array, longest common prefixes).

Words are runs of characters other than the six ASCII white space characters.
For each text the operator sorts its word suffixes and takes the longest common
prefix of neighbours; runs of neighbours that share at least ``min_words``
words are the intervals of the maximal repeated substrings. The union of all
their occurrences over the text's characters (``repeat_chars``) and the
longest one (``longest_repeat``) give the verdict.

Suffixes are sorted for a slice of texts at once: the key of a suffix begins
with its text's number, so equal substrings of two texts are never neighbours.
Work is per text, in one pass, with no shuffle; a text of any length is sorted
as a whole.

Defined cases: a null or empty text has no words and fails; a null id and
repeated rows pass through, one result row per input row; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm.common import map_texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_WORDS_IN_TEXT = 50
MAX_REPEAT_PERCENT = 50

OUT = T.StructType([T.StructField(c, T.LongType()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars", "longest_repeat",
)] + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])


def repetition_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5,
                     max_fraction: float = 0.3, max_longest: int = 50) -> DataFrame:
    """One row per input row: counts, repeat spans and the verdict ``kept``.

    A text is kept when it passes the base rules, the repeated substrings of at
    least ``min_words`` words cover at most ``max_fraction`` of its word
    characters, and none of them is longer than ``max_longest`` words.
    """
    if min_words < 3:
        raise ValueError("suffixes are sorted from three words on")

    def run(texts: list[bytes]) -> dict:
        return measure(texts, min_words, max_fraction, max_longest)

    return map_texts(df, [id_col], text_col, run, OUT)


def measure(texts: list[bytes], min_words: int, max_fraction: float, max_longest: int) -> dict:
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], dtype=np.int64)
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for ws in words for w in ws), dtype=np.int64,
                       count=int(n_words.sum()))
    doc = np.repeat(np.arange(len(texts)), n_words)
    width = np.fromiter((code_points(w) for w in ids), dtype=np.int64, count=len(ids))[flat] if len(flat) else flat
    word_chars = np.bincount(doc, weights=width, minlength=len(texts)).astype(np.int64)
    covered3, spans, longest = repeats(flat, doc, len(texts), min_words)
    n_repeat = np.bincount(doc[covered3], minlength=len(texts)).astype(np.int64)
    repeat_chars = np.bincount(doc[spans], weights=width[spans], minlength=len(texts)).astype(np.int64)
    failed = (n_words < MIN_WORDS_IN_TEXT) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    fraction = repeat_chars / np.maximum(word_chars, 1)
    return {
        "n_words": n_words, "word_chars": word_chars,
        "n_symbols": [len(t) - len(t.translate(None, SYMBOLS)) for t in texts],
        "n_dup_lines": [dup_lines(t) for t in texts],
        "n_repeat_words": n_repeat, "repeat_chars": repeat_chars, "longest_repeat": longest,
        "base_failed": failed, "kept": ~failed & (fraction <= max_fraction) & (longest <= max_longest),
    }


def code_points(word: bytes) -> int:
    return len(word) if word.isascii() else len(word.decode("utf-8", "replace"))


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def repeats(words: np.ndarray, doc: np.ndarray, n_docs: int, min_words: int):
    """Suffix order by prefix doubling over (text, words), then prefix lengths of neighbours.

    Returns masks over all word positions: inside a 3-word window found twice,
    inside a maximal repeat of ``min_words`` or more; and the longest repeat of
    each text. Suffixes whose first three words are unique in their text cannot
    begin a repeat of three words and are not sorted further.
    """
    n = len(words)
    covered3, spans, longest = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n_docs, dtype=np.int64)
    if n < 4:
        return covered3, spans, longest
    at = np.arange(n)
    end = np.searchsorted(doc, doc, side="right")  # one past the last word of the suffix's text
    word = dense(doc * (int(words.max()) + 1) + words)

    def later(k: int) -> np.ndarray:  # 0 past the text's end
        return np.where(at + k < end, word[np.minimum(at + k, n - 1)] + 1, 0)

    triple = dense(dense(word * (n + 1) + later(1)) * (n + 1) + later(2))
    size = np.bincount(triple)
    rank = (np.cumsum(size) - size)[triple]  # how many suffixes come before the class
    live = np.flatnonzero((size[triple] > 1) & (at + 2 < end))
    if not len(live):
        return covered3, spans, longest
    for k in range(3):
        covered3[live + k] = True
    levels, h = [], 3
    while True:  # ranks by prefixes of 3, 6, 12, ... words; a suffix alone in its class keeps its rank
        levels.append((h, rank.copy()))
        nxt = np.where(live + h < end[live], rank[np.minimum(live + h, n - 1)] + 1, 0)
        order = np.lexsort((nxt, rank[live]))
        live, own, nxt = live[order], rank[live][order], nxt[order]
        where = np.arange(len(live))
        new_class = np.r_[True, own[1:] != own[:-1]]
        new = new_class | np.r_[True, nxt[1:] != nxt[:-1]]
        rank[live] = own + np.maximum.accumulate(np.where(new, where, 0)) - np.maximum.accumulate(
            np.where(new_class, where, 0))
        if new.all():
            break
        h *= 2
    suffix = live
    a, b = suffix[:-1].copy(), suffix[1:].copy()
    lcp = np.zeros(len(a), dtype=np.int64)
    for h, full in reversed(levels):
        ok = (a + lcp + h <= end[a]) & (b + lcp + h <= end[b])
        same = ok & (full[np.where(ok, a + lcp, 0)] == full[np.where(ok, b + lcp, 1)])
        lcp += h * same
    for _ in range(2):
        ok = (a + lcp < end[a]) & (b + lcp < end[b])
        lcp += ok & (word[np.where(ok, a + lcp, 0)] == word[np.where(ok, b + lcp, 0)])
    # a neighbour pair that extends to the left lies inside the pair one word earlier, so the union
    # over all neighbour pairs is the union of the maximal repeats
    big = (lcp >= min_words) & (doc[a] == doc[b])
    np.maximum.at(longest, doc[a[big]], lcp[big])
    edge = np.zeros(n + 1, dtype=np.int64)
    for start in (a[big], b[big]):
        np.add.at(edge, start, 1)
        np.add.at(edge, start + lcp[big], -1)
    spans = np.cumsum(edge)[:n] > 0
    return covered3, spans, longest


def dense(key: np.ndarray) -> np.ndarray:
    """Order-preserving ranks of equal keys."""
    return np.unique(key, return_inverse=True)[1].reshape(-1)
