"""Secret scans: patterns, and sliding-window entropy over candidate strings.

Patterns find what has the form of a secret.  The entropy scan finds what merely looks random:
over every candidate string (a long run of key characters) a window slides, character counts
are updated by the character that enters and the one that leaves, and a window whose Shannon
entropy exceeds the bound of its character class marks its place.  Known harmless forms are
suppressed by an allow-list, in the entropy scan only, and only the part that it matches.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from sparkmart.llm.common import appended

#: The pattern kinds, in order, with the least length of what they have to hold.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs of 32 and more: a shorter run holds no match
MIN_ASSIGN, MIN_ACCESS = 8, 16

ENTROPY = "entropy"
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HAS_DIGIT = re.compile(r"[0-9]")
#: Bits a character that a window has to reach, by the narrowest class that holds the string or the window.
#: Strings of letters alone are words, however long, and are never secrets by entropy.
BOUNDS = {"digits": math.inf, "hex": 3.0, "one_case": 3.6, "mixed": 3.8}
#: The parts of a candidate that are harmless, and what is harmless as a whole: words with separators.
ALLOWED = re.compile(
    r"(?i)(?<![0-9a-f])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-f])"  # UUID
    r"|(?<![a-z0-9])sha(1|256|384|512)-[a-z0-9+/]+={0,2}|(?<![a-z0-9+])[a-z0-9+]*(example|abcdefgh|01234567|12345678)[a-z0-9+]*"
)
WORDS = re.compile(r"(?i)(/?[a-z]+[0-9]{0,4}[/_=-])+[a-z0-9]{0,12}")

_n_log_n = [n * math.log2(n) if n else 0.0 for n in range(WINDOW + 1)]


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern kinds, each leftmost and without overlap."""
    found = []
    if "=" in text or ":" in text:
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


def char_class(candidate: str) -> str | None:
    """The narrowest class of a candidate's characters; None for letters without a digit."""
    if not HAS_DIGIT.search(candidate):
        return None
    letters = re.sub(r"[^A-Za-z]", "", candidate)
    if not letters:
        return "digits"
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hex"
    return "one_case" if letters.islower() or letters.isupper() else "mixed"


def _limit_of(window: str) -> float:
    """What the S of `high_windows` may be in a window by itself."""
    kind = char_class(window)
    return -math.inf if kind is None else (math.log2(WINDOW) - BOUNDS[kind]) * WINDOW + 1e-9


def high_windows(candidate: str, bound: float, by_window: bool = False) -> Iterator[tuple[int, int]]:
    """Merged spans of the windows whose entropy reaches the bound, or with ``by_window`` that of their own class.

    With n of the W characters equal, a character adds n log n to S, and the entropy is
    log W - S / W: one step changes the terms of two characters only.
    """
    limit = (math.log2(WINDOW) - bound) * WINDOW + 1e-9
    widest = (math.log2(WINDOW) - min(BOUNDS.values())) * WINDOW + 1e-9 if by_window else limit
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _n_log_n[min(n + 1, WINDOW)] - _n_log_n[n]
        if i >= WINDOW - 1:
            if total <= limit or (total <= widest and total <= _limit_of(candidate[i - WINDOW + 1 : i + 1])):
                if i - WINDOW + 1 > end:
                    if start >= 0:
                        yield start, end
                    start = i - WINDOW + 1
                end = i + 1
            old = candidate[i - WINDOW + 1]
            n = counts[old]
            counts[old] = n - 1
            total += _n_log_n[n - 1] - _n_log_n[n]
    if start >= 0:
        yield start, end


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    for m in CANDIDATE.finditer(text):
        for at, part in unallowed(m.group()):
            kind = char_class(part)
            if kind is None or BOUNDS[kind] == math.inf or WORDS.fullmatch(part):
                continue
            at += m.start()
            found += [(at + a, at + b, ENTROPY) for a, b in high_windows(part, BOUNDS[kind], by_window=True)]
    return found


def unallowed(candidate: str) -> Iterator[tuple[int, str]]:
    """What the allow-list leaves of a candidate, with its places, where a window fits in."""
    at = 0
    for a, b in [*(m.span() for m in ALLOWED.finditer(candidate)), (len(candidate), len(candidate))]:
        if a - at >= WINDOW:
            yield at, candidate[at:a]
        at = b


_order = {kind: i for i, kind in enumerate((*KINDS, ENTROPY))}


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], _order[s[2]], s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in ordered(spans))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the pattern kinds, their digest, and all spans (code points).

    Null text is empty text and has no span; every row gives one row, repeated ids too.
    """

    def compute(batch):
        out = []
        for text in batch.column("text").to_pylist():
            base = pattern_spans(text or "")
            kinds = [s[2] for s in base]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            out.append((*(kinds.count(k) for k in KINDS), digest, joined(base + entropy_spans(text or ""))))
        return list(zip(*out))

    fields = [("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"), ("spans", "string")]
    return appended(docs.select("doc_id", "text"), fields, compute, keep=["doc_id"])


def masked(text: str, mask: str) -> str:
    """The text with every span, overlapping ones merged, replaced by ``mask``."""
    out, at = [], 0
    spans = sorted((a, b) for a, b, _ in pattern_spans(text) + entropy_spans(text))
    for a, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with secrets in ``text`` masked; a null text stays null.

    ``n_chars``, where the table has it, is counted anew for the texts that changed.
    """
    counted = "n_chars" in docs.columns

    def compute(batch):
        texts = batch.column("text").to_pylist()
        new = [None if t is None else masked(t, mask) for t in texts]
        if not counted:
            return [new]
        sizes = batch.column("n_chars").to_pylist()
        return [new, [n if a == b else len(b) for a, b, n in zip(texts, new, sizes)]]

    fields = [("text", "string")] + ([("n_chars", docs.schema["n_chars"].dataType.simpleString())] if counted else [])
    names = [f[0] for f in fields]
    source = docs.select([c for c in docs.columns])
    changed = appended(source, fields, compute) if names else source
    return changed.select(docs.columns)
