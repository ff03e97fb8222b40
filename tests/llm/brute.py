"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import regex

from tidemark.llm import fingerprints as imatch
from tidemark.llm import near_dups, quality, secrets
from tidemark.llm.words import FOLD, find_words, mix


def enough(lines: list[str]) -> bool:
    words = sum(bool(regex.fullmatch(r"[\p{L}\p{M}]{2,}[.,;:!?]?", word)) for line in lines for word in re.split("[ \t]", line))
    return words >= 10 or sum(len(regex.findall(r"[\p{L}\p{N}]", line)) for line in lines) >= 200


def dedup_lines(docs: list[tuple]) -> dict:
    """{(id, text): (new text, lines removed)}; the first place of a chunk stays."""
    first: dict[tuple, tuple] = {}
    made = {}
    for id, text in sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0)):
        lines = (text or "").split("\n")
        at = [first.setdefault(pair, (id, text, i)) for i, pair in enumerate(zip(lines, lines[1:]))]
        again = [a[:2] != (id, text) or i >= a[2] + 2 for i, a in enumerate(at)]
        gone: set[int] = set()
        i = 0
        while i < len(at):
            stop = i
            while again[i] and stop + 1 < len(at) and again[stop + 1] and at[stop + 1] == (*at[stop][:2], at[stop][2] + 1):
                stop += 1
            if again[i] and enough(lines[i : stop + 2]):
                gone |= {*range(i, stop + 2)}
            i = stop + 1
        made[id, text] = ("\n".join(line for i, line in enumerate(lines) if i not in gone), len(gone)) if gone else (text, 0)
    return made


def secret_spans(text: str) -> list[str]:
    found = []
    assign = secrets.ASSIGN.replace("(?i)", "")
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 18), (2, "hex", "[0-9a-f]+", 16)):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                found.append((m.start(), rank, m.end(), kind))
    added = []
    for m in re.finditer(secrets.CANDIDATE, text):
        run = m[0]
        if not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)) or any(re.search(p, run) for p in secrets.ALLOWED):
            continue
        kind = "entropy_hex" if re.search(secrets.ALL_HEX, run) else "entropy_base64"
        hits = []
        for i in range(len(run) - secrets.WINDOW + 1):
            counts = Counter(run[i : i + secrets.WINDOW]).values()
            entropy = -sum(c / secrets.WINDOW * math.log2(c / secrets.WINDOW) for c in counts)
            if entropy >= secrets.BITS[kind] - 1e-6:
                hits.append(i)
        if hits:
            span = (m.start() + hits[0], secrets.KINDS.index(kind), m.start() + hits[-1] + secrets.WINDOW, kind)
            if not any(b[0] <= span[0] and b[2] >= span[2] for b in found):
                added.append(span)
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found + added)]


def near_classes(docs: list[tuple]) -> list[int]:
    """A class number for each (id, text), by comparing all pairs."""
    runs = []
    for _, text in docs:
        words = (text or "").split()
        runs.append({tuple(words[i : i + near_dups.RUN]) for i in range(max(1, len(words) - near_dups.RUN + 1))} if words else {()})
    by_run = defaultdict(list)
    for i, found in enumerate(runs):
        for run in found:
            by_run[run].append(i)
    pairs = {(a, b) for found in by_run.values() for n, b in enumerate(found) for a in found[:n]}
    parent = list(range(len(docs)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if len(runs[a] & runs[b]) >= near_dups.SIMILARITY * len(runs[a] | runs[b]) - 1e-9:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return [root(i) for i in range(len(docs))]


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def search_distance(item: str, text: str) -> int:
    """The least distance of ``item`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


@cache
def _scrambled(x: int) -> int:
    return int(mix(np.array([x % 2**64], dtype=np.uint64))[0])


def _distinct_words(text: str) -> set[str]:
    return {"".join(c.lower() if c.isascii() else c for c in word) for word in re.split("[\t\n\v\f\r ]+", text) if word}


def fingerprints(corpus: list[str], texts: list[str]) -> list[list[int]]:
    """I-Match values of ``texts`` by the lexicon of ``corpus``, one subset after the other."""
    df = Counter(word for text in corpus for word in _distinct_words(text))
    known = sorted({*df, *(word for text in texts for word in _distinct_words(text))})
    hashed = dict(zip(known, find_words(pa.array(known), FOLD).hashes.tolist(), strict=True))
    least, most = math.floor(len(corpus) ** (1 - imatch.BAND[1])), math.ceil(len(corpus) ** (1 - imatch.BAND[0]))
    places = {hashed[word] >> 64 - imatch.BITS for word, n in df.items() if least <= n <= most}
    made = []
    for text in texts:
        terms = sorted(hashed[word] for word in _distinct_words(text))
        terms = [t for t in terms if t >> 64 - imatch.BITS in places] or terms
        draws = [[_scrambled(t + 0x9E3779B97F4A7C15 * (subset + 1)) for t in terms] for subset in range(imatch.SUBSETS)]
        subsets = [[d for d in drawn if d < 2 ** (64 - depth)] for depth in imatch.DEPTHS for drawn in draws]
        subsets.append(terms)
        made.append([max(_scrambled(sum(map(_scrambled, s))) >> 48, 1) if s else 0 for s in subsets])
    return made


def likeness(a: list[int], b: list[int]) -> float:
    some = [(x, y) for x, y in zip(a, b, strict=True) if x or y][: imatch.COMPARED]
    return sum(x == y for x, y in some) / len(some) if some else 1.0


def ftrl(rows: list[dict[int, float]], labels: list[int]) -> tuple[dict[int, float], float]:
    """Weights and intercept by the update of each coordinate on its own; the intercept has no penalty."""
    z: dict = defaultdict(float)
    n: dict = defaultdict(float)

    def weight(at) -> float:
        if at is None:
            return -z[at] / ((quality.BETA + math.sqrt(n[at])) / quality.ALPHA)
        if abs(z[at]) <= quality.L1:
            return 0.0
        shrunk = z[at] - math.copysign(quality.L1, z[at])
        return -shrunk / ((quality.BETA + math.sqrt(n[at])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for row, label in zip(rows, labels, strict=True):
            full = {**row, None: 1.0}
            current = {at: weight(at) for at in full}
            error = 1 / (1 + math.exp(-sum(current[at] * value for at, value in full.items()))) - label
            for at, value in full.items():
                step = error * value
                sigma = (math.sqrt(n[at] + step**2) - math.sqrt(n[at])) / quality.ALPHA
                z[at] += step - sigma * current[at]
                n[at] += step**2
    return {at: weight(at) for at in z if at is not None}, weight(None)
