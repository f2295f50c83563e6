"""Secret scan: fixed patterns, and entropy of sliding windows over candidate strings.

Three patterns give the base spans. On top, every candidate string (a run of
characters that keys are made of) is cut into runs of one character class (hex,
letters and digits, base64), and a window slides over it. The Shannon entropy of
the window is kept up by counts: one character comes in, one goes out, and only
their two terms change. Windows at or above their class's threshold merge into a
span. Strings on the allow list are suppressed: words without a digit, paths, names
joined by separators, dates and version numbers, and what the caller adds.

The scan is one Arrow call on the text column: no shuffle, and a text is always
seen whole.

Defined cases: a NULL or empty text has no spans; equal texts have equal spans;
base spans are never suppressed; an entropy span that lies wholly inside a base span is
left out, as the base span says the same; one that reaches beyond it stays. Positions
are code points, the end exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN, ACCESS, HEX, ENTROPY = "assign", "access", "hex", "entropy"
# The kinds in the order in which spans of one start are listed.
KINDS = (ASSIGN, ACCESS, HEX, ENTROPY)

# The patterns. Key words count in either case, ASCII letters only.
KEY_WORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE_LENGTH = 6


def _either_case(word: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", word)


ASSIGN_PATTERN = re.compile(
    f"({'|'.join(map(_either_case, KEY_WORDS))})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run of the class is taken whole, so a least length can stand in the pattern.
ACCESS_PATTERN = re.compile("AKIA[A-Z0-9]{16,}")
HEX_PATTERN = re.compile("[0-9a-f]{24,}")


class CharClass(NamedTuple):
    """Characters whose runs are measured, and the bits a window must reach."""

    name: str
    pattern: re.Pattern
    window: int
    threshold: float


CLASSES = (
    CharClass("hex", re.compile("[0-9a-fA-F]{20,}"), 20, 3.0),
    CharClass("alphanumeric", re.compile("[0-9A-Za-z]{20,}"), 20, 3.7),
    CharClass("base64", re.compile("[0-9A-Za-z+/=_-]{24,}"), 24, 3.9),
)
CANDIDATE = re.compile("[A-Za-z0-9+/=_-]{20,}")
# The entropy of every other string is measured, be its digits ever so few.
ALLOWED = (
    re.compile(r"[A-Za-z+/=_-]*"),  # no digit: words and names
    re.compile(r"[0-9+/=_-]*"),  # no letter: numbers, dates, rules
    # Names with up to four digits, joined by separators. Every part is taken for good, so
    # that a string is read once, whatever follows a long run of separators.
    re.compile(r"(?:[A-Za-z]*+[0-9]{0,4}+[/_=+-]++)*+[A-Za-z]*+[0-9]{0,4}+"),
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    found = []
    if ":" in text or "=" in text:
        for m in ASSIGN_PATTERN.finditer(text):
            if m.end(2) - m.start(2) >= VALUE_LENGTH:
                found.append((m.start(), m.end(), ASSIGN))
    if "AKIA" in text:
        found.extend((*m.span(), ACCESS) for m in ACCESS_PATTERN.finditer(text))
    found.extend((*m.span(), HEX) for m in HEX_PATTERN.finditer(text))
    return found


def window_entropies(run: str, size: int) -> Iterable[tuple[int, float]]:
    """(start, bits) of every window; counts are kept up, never made anew.

    With c the counts, the entropy is log2(size) - sum(c * log2(c)) / size.
    """
    term = [0.0, 0.0] + [c * math.log2(c) for c in range(2, size + 2)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= size:
            out = run[i - size]
            c = counts[out]
            total += term[c - 1] - term[c]
            counts[out] = c - 1
        if i >= size - 1:
            yield i - size + 1, math.log2(size) - total / size


def allowed(string: str, allow: tuple[re.Pattern, ...]) -> bool:
    return any(p.fullmatch(string) for p in allow)


def entropy_spans(text: str, allow: tuple[re.Pattern, ...] = ALLOWED) -> list[tuple[int, int, str]]:
    found: list[tuple[int, int]] = []
    for candidate in CANDIDATE.finditer(text):
        if allowed(candidate[0], allow):
            continue
        for cls in CLASSES:
            for run in cls.pattern.finditer(text, *candidate.span()):
                if allowed(run[0], allow):
                    continue
                for start, bits in window_entropies(run[0], cls.window):
                    if bits >= cls.threshold:
                        start += run.start()
                        found.append((start, start + cls.window))
    merged: list[list[int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(start, end, ENTROPY) for start, end in merged]


def find_secrets(
    text: str, allow: tuple[re.Pattern, ...] = ALLOWED
) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans, each by start, then kind as listed."""
    order = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(base_spans(text), key=order)
    more = [
        s for s in entropy_spans(text, allow) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)
    ]
    return base, sorted(base + more, key=order)


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCAN_TYPE = "n_assign long, n_access long, n_hex long, n_entropy long, base string, spans string"


def scan_udf(allow: tuple[re.Pattern, ...] = ALLOWED):
    """Counts by kind, base spans and all spans of each text."""

    @F.arrow_udf(SCAN_TYPE)
    def scan(texts: pa.Array) -> pa.Array:
        names = ("n_assign", "n_access", "n_hex", "n_entropy", "base", "spans")
        columns: dict[str, list] = {name: [] for name in names}
        for value in texts:
            base, spans = find_secrets(value.as_py() or "", allow)
            for kind in KINDS:
                columns[f"n_{kind}"].append(sum(s[2] == kind for s in spans))
            columns["base"].append(_written(base))
            columns["spans"].append(_written(spans))
        return pa.StructArray.from_arrays([pa.array(columns[n]) for n in names], names)

    return scan


def redact(text: str, mask: str, allow: tuple[re.Pattern, ...] = ALLOWED) -> str:
    """The text with every span replaced; spans that overlap become one mask."""
    out, at = [], 0
    for start, end, _ in find_secrets(text, allow)[1]:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact_udf(mask: str, allow: tuple[re.Pattern, ...] = ALLOWED):
    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        values = (value.as_py() for value in texts)
        return pa.array([v if v is None else redact(v, mask, allow) for v in values], pa.string())

    return masked


def scan_secrets(docs: DataFrame, allow: tuple[re.Pattern, ...] = ALLOWED) -> DataFrame:
    """doc_id, spans by kind, and the spans as text, for each row of ``docs``."""
    found = docs.select("doc_id", scan_udf(allow)(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def redact_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with its columns, secrets in ``text`` masked; ``n_chars`` follows suit."""
    masked = docs.withColumn("text", redact_udf(mask)(F.col("text")))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
