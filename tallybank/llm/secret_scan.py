"""Secrets in texts: three fixed patterns, and tokens that a battery of randomness tests takes for random."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.llm.common import ASCII_LOWER, map_texts, rewrite_texts

# The base patterns with their least lengths, and the kinds in their order.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
REDACTED = "[REDACTED]"

#: Tokens shorter than this hold too little evidence for the tests.
TOKEN_LEAST = 12
#: Tolerated share of false discoveries among the tokens taken from one text.
FALSE_DISCOVERIES = 0.001
#: The evidence for a token is scaled by this times its combined test value. That value is spread evenly from 0 to 1 over
#: random tokens, so the scale is 1 on average there, and the evidence keeps its bound.
FIT_SCALE = 2.0
#: Where that value is lower the tests rule out a random token, as in AbAbAbAb, and there is no evidence at all.
FIT_LEAST = 0.001
#: Chance that a structured token keeps to its kind of character (lower, upper, digit, sign) from one to the next.
STAY = 0.9
# Shares of letters in running text, per thousand, a to z.
LETTER_SHARES = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)

_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Alphabets by name, the narrowest first; a token has the first one that holds all its characters.
ENCODINGS = (("decimal", _DIGIT), ("hex", _DIGIT + "abcdef"), ("hex_upper", _DIGIT + "ABCDEF"), ("lower", _LOWER),
             ("upper", _UPPER), ("base32", _UPPER + "234567"), ("lower_digits", _LOWER + _DIGIT),
             ("upper_digits", _UPPER + _DIGIT), ("alphanumeric", _UPPER + _LOWER + _DIGIT),
             ("base64", _UPPER + _LOWER + _DIGIT + "+/"), ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
             ("mixed", _UPPER + _LOWER + _DIGIT + "+/-_"))


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters.encode())] = True
    return out


_IN_HEX, _IN_TOKEN = _table(_DIGIT + "abcdef"), _table(_UPPER + _LOWER + _DIGIT + "+/-_")
_KIND_OF = np.full(256, 3, dtype=np.int64)
_NATURAL = np.zeros(256)                          # chance of a character among those of its kind, in structured tokens
for _k, _chars in enumerate((_LOWER, _UPPER, _DIGIT)):
    _codes = list(_chars.encode())
    _KIND_OF[_codes] = _k
    _NATURAL[_codes] = 0.1 if _k == 2 else np.array(LETTER_SHARES) / sum(LETTER_SHARES)
_NATURAL[list(b"+/-_")] = 0.25
_LOG_NATURAL = np.log(np.where(_NATURAL > 0, _NATURAL, 1.0))
_LETTER_OF = np.full(256, -1, dtype=np.int64)      # 0 to 25 for letters of either case
for _chars in (_LOWER, _UPPER):
    _LETTER_OF[list(_chars.encode())] = np.arange(26)
_LOG_KIND = np.where(_KIND_OF[:, None] == _KIND_OF[None, :], math.log(STAY), math.log((1 - STAY) / 3))
#: Added to each count of one letter behind another.
PAIR_SMOOTHING = 0.5
#: Texts are joined up to so many code points before their letters are counted; the blank between them parts words.
COUNTED_CHARS = 1 << 18
_CLASSES = ("0189", "234567", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "-_")
_CLASS_OF = np.zeros(256, dtype=np.uint8)
for _k, _chars in enumerate(_CLASSES):
    _CLASS_OF[list(_chars.encode())] = 1 << _k
# Length of the first alphabet that holds all characters of a set of classes.
_SIZE_OF = np.array([next(len(a) for _, a in ENCODINGS if all(set(c) <= set(a) for k, c in enumerate(_CLASSES) if held >> k & 1))
                     for held in range(256)])


def _runs(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least that length, as (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def token_runs(codes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of token characters of at least that length, each with the '=' behind it if these end it as padding.

    A '=' between token characters parts them, as in NAME=value.
    """
    inside, size = _IN_TOKEN[codes], len(codes)
    out = []
    for start, end in _runs(inside, least):
        padded = end
        while padded < size and codes[padded] == ord("="):
            padded += 1
        out.append((start, end if padded < size and inside[padded] else padded))
    return out


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(value: float, freedom: int) -> float:
    """Upper tail of the chi-squared distribution, by the cube-root transformation."""
    spread = 2 / (9 * freedom)
    return _tail(((value / freedom) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def uniformity(ranks: np.ndarray, size: int) -> float:
    """Chi-squared test that characters are spread evenly, over groups of neighbours large enough for the test."""
    groups = max(2, min(size, len(ranks) // 5))
    edges = np.arange(groups + 1) * size // groups
    expected = np.diff(edges) * len(ranks) / size
    seen = np.bincount(np.searchsorted(edges, ranks, side="right") - 1, minlength=groups)
    return _chi_tail(float(((seen - expected) ** 2 / expected).sum()), groups - 1)


def runs_test(ranks: np.ndarray, size: int) -> float:
    """Wald-Wolfowitz test on the upper and lower half of the alphabet, two-sided."""
    high = ranks >= size / 2
    n, n1 = len(high), int(high.sum())
    n0 = n - n1
    if not n0 or not n1:
        return 2.0 ** (1 - n)
    runs = 1 + int(np.count_nonzero(high[1:] != high[:-1]))
    mean = 1 + 2 * n0 * n1 / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 1.0 if variance <= 0 else min(1.0, 2 * _tail(max(0.0, abs(runs - mean) - 0.5) / math.sqrt(variance)))


def serial_correlation(ranks: np.ndarray) -> float:
    """Test that neighbours are uncorrelated, two-sided."""
    centred = ranks - ranks.mean()
    power = float((centred ** 2).sum())
    if not power:
        return 2.0 ** (1 - len(ranks))
    r = float((centred[1:] * centred[:-1]).sum()) / power
    return min(1.0, 2 * _tail(abs(r + 1 / len(ranks)) * math.sqrt(len(ranks))))


def encoding_of(token: bytes) -> tuple[str, str] | None:
    held = set(token.decode())
    return next(((n, a) for n, a in ENCODINGS if held <= set(a)), None)


class Structured:
    """Log chances of structured tokens: those of two models, of which a token has the larger.

    Both keep to a kind of character with the chance STAY. One has the fixed shares of letters, the other the chances of
    a letter behind another among the words of the corpus: row 26 of `pairs` counts first letters, rows 0 to 25 what
    follows each letter. Without counts its letters are spread evenly, so tokens of letters alone are no evidence.
    """

    def __init__(self, pairs: np.ndarray | None = None):
        counts = (np.zeros((27, 26)) if pairs is None else pairs) + PAIR_SMOOTHING
        logs = np.log(counts / counts.sum(axis=1, keepdims=True))
        fixed = np.broadcast_to(_LOG_NATURAL, (256, 256))
        letter = _LETTER_OF >= 0
        before = np.where(letter, _LETTER_OF, 26)
        seen = np.where(letter[None, :], logs[before[:, None], np.where(letter, _LETTER_OF, 0)[None, :]], fixed)
        first = np.where(letter, logs[26, np.where(letter, _LETTER_OF, 0)], _LOG_NATURAL)
        self.models = [(_LOG_NATURAL - math.log(4), fixed + _LOG_KIND), (first - math.log(4), seen + _LOG_KIND)]

    def natural(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = []
        for first, behind in self.models:
            sums = np.concatenate(([0.0], np.cumsum(behind[codes[:-1], codes[1:]])))
            out.append(sums[ends - 1] - sums[starts] + first[codes[starts]])
        return np.maximum(*out)


UNTRAINED = Structured()


def pair_counts(text: str | None) -> np.ndarray:
    """Counts of first letters (row 26) and of letters behind letters in the plain words of a text: whole runs of token
    characters that are lower-case letters, the first of either case. Random tokens of several kinds are none."""
    out = np.zeros((27, 26), dtype=np.int64)
    codes = np.frombuffer((text or "").encode(), dtype=np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], _IN_TOKEN[codes].view(np.int8), [0]))))
    runs = edges.reshape(-1, 2)
    runs = runs[runs[:, 1] - runs[:, 0] >= 2]
    other = np.concatenate(([0], np.cumsum(~((codes >= ord("a")) & (codes <= ord("z"))))))
    runs = runs[(other[runs[:, 1]] == other[runs[:, 0] + 1]) & (_LETTER_OF[codes[runs[:, 0]]] >= 0)]
    if len(runs):
        edges = np.zeros(len(codes) + 1, dtype=np.int8)
        edges[runs[:, 0] + 1], edges[runs[:, 1]] = 1, -1
        inside = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int8))
        out[26] = np.bincount(_LETTER_OF[codes[runs[:, 0]]], minlength=26)
        out[:26] = np.bincount(_LETTER_OF[codes[inside - 1]] * 26 + _LETTER_OF[codes[inside]],
                               minlength=676).reshape(26, 26)
    return out


def letter_pairs(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The sum of `pair_counts` over all rows. A task hands on 702 numbers, and so does the sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((27, 26), dtype=np.int64)
        for batch in batches:
            held, size = [], 0
            for text in batch.column(0):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size >= COUNTED_CHARS:
                    total += pair_counts(" ".join(held))
                    held, size = [], 0
            total += pair_counts(" ".join(held))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(702)), pa.array(total.ravel())], names=["pair", "n"])

    parts = docs.select(docs[text_column].cast("string").alias("text")).mapInArrow(run, "pair long, n long")
    out = np.zeros(702, dtype=np.int64)
    for row in parts.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[row["pair"]] = row["n"]
    return out.reshape(27, 26)


def chances(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, structured: Structured = UNTRAINED) -> np.ndarray:
    """For each token, rising and without padding: a bound on the chance that a structured token looks as random as it."""
    held = np.bitwise_or.reduceat(np.append(_CLASS_OF[codes], np.uint8(0)), np.column_stack((starts, ends)).ravel())[::2]
    ratio = -(ends - starts) * np.log(_SIZE_OF[held]) - structured.natural(codes, starts, ends)
    return np.exp(-np.clip(ratio, 0.0, 700.0))


def judge_token(token: bytes, structured: Structured = UNTRAINED) -> tuple[float, float]:
    """(fit, chance): the combined value of the battery under a random token, and a bound on the chance that a
    structured token looks as random as this one. Longer tokens can reach smaller chances."""
    token = token.rstrip(b"=")
    found = encoding_of(token) if len(token) >= TOKEN_LEAST else None
    if found is None:
        return 0.0, 1.0
    alphabet = found[1].encode()
    rank_of = np.zeros(256, dtype=np.int64)
    rank_of[list(alphabet)] = np.arange(len(alphabet))
    codes = np.frombuffer(token, dtype=np.uint8)
    ranks = rank_of[codes]
    values = (uniformity(ranks, len(alphabet)), runs_test(ranks, len(alphabet)), serial_correlation(ranks))
    fisher = -2 * sum(math.log(max(v, 1e-300)) for v in values)
    return _chi_tail(fisher, 6), float(chances(codes, np.array([0]), np.array([len(codes)]), structured)[0])


def _unpadded(raw: bytes, start: int, end: int) -> int:
    return start + len(raw[start:end].rstrip(b"="))


def random_tokens(raw: bytes, tokens: list[tuple[int, int]], structured: Structured = UNTRAINED) -> list[tuple[int, int]]:
    """The tokens taken for random, under the step-up control of false discoveries over all tokens of the text.

    The evidence of a token is how much likelier it is as a random than as a structured one, times FIT_SCALE times the
    combined value of its three tests. Under structured tokens its mean is 1 at most, at every length, so the k tokens of
    most evidence are taken where each has n / (k * FALSE_DISCOVERIES) of n tokens. A token that could not even be the
    last of n needs no tests.
    """
    if not tokens:
        return []
    starts = np.array([s for s, _ in tokens])
    ends = np.array([_unpadded(raw, s, e) for s, e in tokens])
    most = FIT_SCALE / chances(np.frombuffer(raw, dtype=np.uint8), starts, ends, structured)
    tested = np.flatnonzero(most >= 1 / FALSE_DISCOVERIES).tolist()
    fits = [judge_token(raw[starts[i]:ends[i]], structured)[0] for i in tested]
    evidence = sorted((-most[i] * (fit if fit >= FIT_LEAST else 0.0), i) for i, fit in zip(tested, fits, strict=True))
    last = max((k for k, (e, _) in enumerate(evidence, 1) if -e * k * FALSE_DISCOVERIES >= len(tokens)), default=0)
    return [tokens[i] for _, i in evidence[:last]]


def _reaches_beyond(start: int, end: int, base: list[tuple[int, int]]) -> bool:
    """Whether some place of the span is in none of the base spans, which are in order."""
    for s, e in base:
        if s > start:
            break
        start = max(start, e)
    return start < end


def secrets_of(text: str | None, structured: Structured = UNTRAINED) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans in code points, by start, then kind. Null texts count as empty."""
    if not text:
        return []
    raw = text.encode()
    lower = raw.translate(ASCII_LOWER)
    spans = []
    if any(name in lower for name in _NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    codes = np.frombuffer(raw, dtype=np.uint8)
    in_hex, tokens = _runs(_IN_HEX[codes], HEX_LEAST), token_runs(codes, TOKEN_LEAST)
    if in_hex or tokens:
        place = None if len(raw) == len(text) else np.concatenate(([0], np.cumsum((codes & 0xC0) != 0x80)))
        point = (lambda i: i) if place is None else (lambda i: int(place[i]))
        spans += [(point(a), 2, point(b)) for a, b in in_hex]
        base = sorted((s, e) for s, _, e in spans)
        spans += [(point(a), 3, point(b)) for a, b in random_tokens(raw, tokens, structured)
                  if _reaches_beyond(point(a), point(_unpadded(raw, a, b)), base)]
    return sorted(spans)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FOUND = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                     + [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())])


def _row(text: str | None, structured: Structured = UNTRAINED) -> tuple:
    spans = secrets_of(text, structured)
    return (*(sum(kind == k for _, kind, _ in spans) for k in range(len(KINDS))),
            spell([s for s in spans if s[1] < 3]), spell(spans))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", pairs: np.ndarray | None = None) -> DataFrame:
    """(id, counts by kind, base_spans, spans), one row for each row of `docs`; spans as kind:start:end, comma-joined.

    Base spans are the leftmost non-overlapping matches of each pattern, without those below its least length. A span
    of kind `random` is a run of token characters, with '=' only as padding at its end, that reaches beyond the base
    spans it overlaps and survives the control of false discoveries over tests and likelihood. `pairs` are the letter
    counts of another corpus; without them those of `docs` are taken, in a pass of their own. Null and empty texts have
    no spans.
    """
    pairs = letter_pairs(docs, text_column) if pairs is None else pairs

    def start():
        structured = Structured(pairs)
        return lambda texts: (_row(t, structured) for t in texts)

    return map_texts(docs, [id_column], text_column, FOUND, start)


def redact(text: str | None, structured: Structured = UNTRAINED) -> str | None:
    """The text with every span, overlapping ones joined, replaced by a marker; texts without spans stay as they are."""
    out, at = [], 0
    for start, _, end in secrets_of(text, structured):
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact_secrets(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars",
                   pairs: np.ndarray | None = None) -> DataFrame:
    """All rows of `docs` with secrets replaced in their texts, and the lengths of changed texts set anew. Letter counts
    as in `scan`."""
    pairs = letter_pairs(docs, text_column) if pairs is None else pairs

    def start():
        structured = Structured(pairs)
        return lambda texts: [redact(t, structured) for t in texts]

    return rewrite_texts(docs, text_column, length_column, start)
