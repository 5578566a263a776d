"""Quality rules by repetition coverage: how much of a text lies inside its repeated word n-grams and lines."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybank.llm.common import filter_texts, map_texts

# The symbols and windows of the base rules, and limits on repeated text (shares of characters). Those on
# most frequent n-grams and lines are the usual published ones. Those on repeated n-grams lie five points higher: a header
# that comes again as footer is a tenth of many a short text that is labelled good.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
BASE_WINDOW = 3
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
REPEAT_LIMITS = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
LINE_LIMIT = 0.20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Coverage:
    """What the rules see of one text.

    Shares are of the characters in words, and count what repeats something earlier in the text: a line, the most
    frequent n-gram beyond its first occurrence, or any n-gram found before. A text without words has none.
    """
    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    line_share: float = 0.0
    top_shares: dict[int, float] = field(default_factory=dict)
    repeat_shares: dict[int, float] = field(default_factory=dict)

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words

    @property
    def kept(self) -> bool:
        return not (self.base_failed or self.line_share > LINE_LIMIT
                    or any(v > TOP_LIMITS[n] for n, v in self.top_shares.items())
                    or any(v > REPEAT_LIMITS[n] for n, v in self.repeat_shares.items()))


def _characters(raw: bytes) -> int:
    """Code points: UTF-8 bytes that don't continue one."""
    return int(np.count_nonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)) if raw else 0


def _inside(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of `size` words lie in a window of `width` words at one of the starts."""
    steps = np.zeros(size + 1, dtype=np.int32)
    steps[starts] += 1
    steps[starts + width] -= 1
    return np.cumsum(steps[:size]) > 0


def coverage(text: str | None) -> Coverage:
    """Null and empty texts have no words and fail the base rules."""
    raw = (text or "").encode()
    words = raw.split()
    out = Coverage(len(words))
    if not words:
        out.n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
        return out
    out.n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    line_chars = 0
    for line in raw.split(b"\n"):
        if line in seen:
            out.n_dup_lines += 1
            line_chars += _characters(line.translate(None, SPACES))
        elif line.strip(SPACES):
            seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    sizes = np.array([len(w.decode()) for w in number], dtype=np.int64)[ids]
    out.word_chars = int(sizes.sum())
    out.line_share = line_chars / out.word_chars
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    rolling, run_chars = mixed, np.concatenate(([0], np.cumsum(sizes)))
    for width in range(2, max(REPEAT_LIMITS) + 1):
        if len(words) < width:
            break
        rolling = rolling[:-1] * _BASE + mixed[width - 1:]
        order = np.argsort(rolling, kind="stable")
        new = np.concatenate(([True], rolling[order[1:]] != rolling[order[:-1]]))
        if new.all():                                   # no window twice: none of a greater width either
            for rest in range(width, max(REPEAT_LIMITS) + 1):
                if rest in TOP_LIMITS:
                    out.top_shares[rest] = 0.0
                elif rest in REPEAT_LIMITS:
                    out.repeat_shares[rest] = 0.0
            break
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(order)))
        if width in TOP_LIMITS:
            chars = run_chars[order[first] + width] - run_chars[order[first]]
            out.top_shares[width] = min(1.0, float((chars * (counts - 1)).max()) / out.word_chars)
        if width == BASE_WINDOW:
            out.n_repeat_words = int(_inside(order[np.repeat(counts > 1, counts)], width, len(words)).sum())
        if width in REPEAT_LIMITS:
            again = _inside(order[~new], width, len(words))
            out.repeat_shares[width] = float(sizes[again].sum()) / out.word_chars
    return out


MEASURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
       T.StructField("dup_line_share", T.DoubleType())]
    + [T.StructField(f"top_{n}gram_share", T.DoubleType()) for n in TOP_LIMITS]
    + [T.StructField(f"dup_{n}gram_share", T.DoubleType()) for n in REPEAT_LIMITS])


def _row(text: str | None) -> tuple:
    c = coverage(text)
    return (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.base_failed, c.kept, c.line_share,
            *(c.top_shares.get(n, 0.0) for n in TOP_LIMITS), *(c.repeat_shares.get(n, 0.0) for n in REPEAT_LIMITS))


def repetition(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, counts, shares, verdicts), one row for each row of `docs`; repeated rows and null ids come back as they are.

    A text is kept if it passes the base rules (50 words or more, at most half of them in 3-word windows found twice)
    and every limit above on repeated lines, on its most frequent 2- to 4-grams and on repeated 5- to 10-grams, each
    measured in characters of words. Null texts count as empty.
    """
    return map_texts(docs, [id_column], text_column, MEASURES, lambda: lambda texts: map(_row, texts))


def keep_varied(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that pass the rules, all columns as they are."""
    return filter_texts(docs, text_column, lambda: lambda texts: [coverage(t).kept for t in texts])
