"""Plain versions of the operators, for comparison on small tables."""

import base64
import collections
import hashlib
import re

import public_tokenizers
import tiktoken
import xxhash

WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = re.findall(WORD, lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest reachable id by id; prints: (id, fingerprint) pairs."""
    distinct = sorted({p for _, p in prints})
    parent = {p: p for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = collections.defaultdict(list)
    for doc, p in prints:
        if doc is not None:
            least[find(p)].append(doc)
    return [(doc, f"{p:016x}", min(least[find(p)], default=None)) for doc, p in prints]


def base_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def repeat_share(text, width):
    """Share of word characters in windows of `width` words that were there before."""
    words = re.findall(WORD, text or "")
    seen, covered = set(), set()
    for i in range(len(words) - width + 1):
        window = tuple(words[i:i + width])
        if window in seen:
            covered.update(range(i, i + width))
        seen.add(window)
    total = sum(map(len, words))
    return sum(len(words[i]) for i in covered) / total if total else 0.0


def base_secrets(text):
    kinds = (("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
             ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16))
    spans = [(m.start(), k, name, m.end()) for k, (name, pattern, part, least) in enumerate(kinds)
             for m in re.finditer(pattern, text or "") if len(m[part]) >= least]
    return ",".join(f"{name}:{start}:{end}" for start, _, name, end in sorted(spans))


def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_digest(ids):
    return hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def offsets_digest(text, tokens):
    """Start and end of each token in code points, where a part of a character stands for the whole of it."""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    out, at = [], 0
    for token in tokens:
        out += [owner[at], owner[at + len(token) - 1] + 1]
        at += len(token)
    return ids_digest(out)


def pair_counts(texts):
    """(letter before or '', letter) -> count, in the plain words of all texts."""
    out = collections.Counter()
    for text in texts:
        for word in re.findall(r"[A-Za-z0-9+/_-]{2,}", text or ""):
            if re.fullmatch("[A-Za-z][a-z]+", word):
                out.update(zip(("", *word.lower()), word.lower()))
    return out


def plain_words(text):
    return re.findall(WORD, re.sub(r"[!-/:-@\[-`{-~]", " ", (text or "").lower()))


def window_matches(text, items):
    """item -> best similarity over all windows of the item's size, of those at 0.8 or more."""
    words, out = plain_words(text), {}

    def shingles(ws):
        return collections.Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    for item, item_text in items:
        own = plain_words(item_text)
        if len(own) < 5:
            continue
        held = shingles(own)
        if not held.keys() & shingles(words).keys():
            continue
        for s in range(len(words) - len(own) + 1):
            there = shingles(words[s:s + len(own)])
            both = sum((held & there).values())
            alike = both / (held.total() + there.total() - both)
            if alike >= 0.8:
                out[item] = max(out.get(item, 0), alike)
    return out
