"""Secret scans: three base patterns, and sliding-window entropy over candidate strings.

Base kinds are assign (a secret's name, a separator and a value), access (key ids) and hex
(long runs of hex digits). The method adds entropy spans: for each character class, runs of
its characters are candidates; a window slides over each, its Shannon entropy kept up to
date by one count that rises and one that falls. Windows over the class's threshold, joined
where they overlap, are a span, unless the run lacks a kind of character that the class needs,
base spans cover it, or it lies in the host or path of a link. Known strings (ALLOWED) are cut out of
the runs, and what stands before and after them is scanned.

Spans are in code points, ends exclusive, over the whole text. Null texts count as empty and
have no spans; very long texts and runs take time in proportion to their length.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from ordermill.llm.common import flat, free_name, map_texts

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
VALUE_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24

KINDS = ("assign", "access", "hex", "entropy")
MASK = "[secret]"


class CharClass(NamedTuple):
    """Characters of a class, the window, the entropy in bits that a window must exceed."""

    name: str
    chars: str
    window: int
    bits: float
    needs: tuple[str, ...]


CLASSES = (
    CharClass("hex", "0-9A-Fa-f", 24, 3.0, ("0-9", "A-Fa-f")),
    CharClass("base64", "A-Za-z0-9+/=_-", 20, 3.8, ("0-9", "A-Z", "a-z")),
    # Keys of one case: 36 characters, so random windows have about 3.8 bits.
    CharClass("lower", "0-9a-z", 20, 3.5, ("0-9", "a-z")),
    CharClass("upper", "0-9A-Z", 20, 3.5, ("0-9", "A-Z")),
)
RUNS = {c.name: re.compile(f"[{c.chars}]{{{c.window},}}") for c in CLASSES}

def _stretch(alphabet: str, least: int) -> str:
    """A pattern for the beginnings of alphabet from least characters on, the longest first."""
    rest = ""
    for char in reversed(alphabet[least:]):
        rest = f"(?:{char}{rest})?"
    return alphabet[:least] + rest


ALNUM = "0-9A-Za-z"
_WORDS = "example|placeholder|your[-_]?(?:api|secret|token|key)|x{6,}"
# Strings that look random but are none: fixed shapes, alphabets and the words of placeholders.
ALLOWED = re.compile(
    "|".join(
        [
            rf"(?<![{ALNUM}])(?i:[0-9a-f]{{8}}-(?:[0-9a-f]{{4}}-){{3}}[0-9a-f]{{12}})(?![{ALNUM}])",
            r"(?i:sha(?:1-[0-9a-z+/]{27}=|256-[0-9a-z+/]{43}=|384-[0-9a-z+/]{64}|512-[0-9a-z+/]{86}==))"
            rf"(?![{ALNUM}+/=])",
            rf"(?i:sha(?:1-[0-9a-f]{{40}}|256-[0-9a-f]{{64}}|512-[0-9a-f]{{128}}))(?![{ALNUM}])",
            rf"(?<![{ALNUM}+/])[{ALNUM}+/]{{30}}EXAMPLEKEY(?![{ALNUM}+/])",
            _stretch("abcdefghijklmnopqrstuvwxyz", 10),
            _stretch("0123456789abcdefghijklmnopqrstuvwxyz", 13),
            _stretch("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 10),
            # Words of placeholders, with an end of their own: random letters may spell one too.
            rf"(?i:(?<![{ALNUM}])(?:{_WORDS})|(?:{_WORDS})(?![{ALNUM}]))",
        ]
    )
)
# Host, port and path of a link; the path ends at a quote, a comma, '@', '=', a query and so on.
# What ends before '@', or before ':' without a port, are a user's name and password.
LINK = re.compile(r"(?:://|www\.)[A-Za-z0-9.-]*+(?::[0-9]++)?+(?:/[A-Za-z0-9/._~%:+!*$-]*+)?+")

# A segment of a link's path that has no separators, as keys in links have none.
SEGMENT = re.compile(rf"(?<=/)[{ALNUM}]{{20,}}(?![{ALNUM}._~%+-])")

FIELDS = [
    StructField("n_assign", LongType()),
    StructField("n_access", LongType()),
    StructField("n_hex", LongType()),
    StructField("base_sha256", StringType()),
    StructField("spans", StringType()),
]

Span = tuple[int, int, int]  # start, index of the kind, end


def base_spans(text: str) -> list[Span]:
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE_CHARS
    ]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= HEX_CHARS]
    return sorted(found)


@lru_cache
def _terms(window: int) -> list[float]:
    return [0.0] + [c * math.log2(c) for c in range(1, window + 2)]


def hot_windows(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Spans of run in which every window's entropy is over bits, overlapping ones joined.

    With counts c of the characters of a window of w, its entropy is log2(w) - sum(c log2 c) / w.
    """
    term, counts, total = _terms(window), {}, 0.0
    spans: list[tuple[int, int]] = []
    most = (math.log2(window) - bits) * window
    for end, char in enumerate(run, 1):
        c = counts.get(char, 0)
        total += term[c + 1] - term[c]
        counts[char] = c + 1
        if end > window:
            gone = run[end - window - 1]
            c = counts[gone]
            total += term[c - 1] - term[c]
            counts[gone] = c - 1
        if end >= window and total < most - 1e-9:
            start = end - window
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
    return spans


def links(text: str) -> list[tuple[int, int]]:
    """Hosts and paths of links, in order."""
    found = (m.span() for m in LINK.finditer(text))
    return [(a, b) for a, b in found if text[b : b + 1] not in ("@", ":", "=")]


def pieces(run: re.Match, allowed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of a run when the strings of the allow list are cut out."""
    at, end = run.span()
    left = []
    place = bisect.bisect_right(allowed, at, key=lambda known: known[1])
    while place < len(allowed) and allowed[place][0] < end:
        left.append((at, allowed[place][0]))
        at = allowed[place][1]
        place += 1
    return [*left, (at, end)]


def covered(base: list[Span]) -> Callable[[int, int], bool]:
    """A test whether one of the base spans, which are in order, covers start to end."""
    starts = [start for start, _, _ in base]
    # The farthest end of the spans that begin so far: one search answers the test.
    reach = list(accumulate((end for _, _, end in base), max))

    def test(start: int, end: int) -> bool:
        place = bisect.bisect_right(starts, start) - 1
        return place >= 0 and end <= reach[place]

    return test


def within(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of spans, in order and apart from each other, covers start to end."""
    place = bisect.bisect_right(spans, (start, math.inf)) - 1
    return place >= 0 and end <= spans[place][1]


def entropy_spans(text: str, base: list[Span]) -> list[Span]:
    found: set[Span] = set()
    known = covered(base)
    mixed = CLASSES[1]
    allowed: list[tuple[int, int]] | None = None
    for kind in CLASSES:
        for run in RUNS[kind.name].finditer(text):
            if not all(re.search(f"[{part}]", run[0]) for part in kind.needs):
                continue
            if not hot_windows(run[0], kind.window, kind.bits):
                continue
            if allowed is None:
                allowed = [m.span() for m in ALLOWED.finditer(text)]
                linked = links(text)
            for left, right in pieces(run, allowed):
                for start, end in hot_windows(text[left:right], kind.window, kind.bits):
                    start, end = left + start, left + end
                    if not within(linked, start, end) and not known(start, end):
                        found.add((start, 3, end))
    for left, right in linked if allowed is not None else ():
        # In a link only whole segments are judged, by the strictest class.
        for segment in SEGMENT.finditer(text, left, right):
            if not all(re.search(f"[{part}]", segment[0]) for part in mixed.needs):
                continue
            for run in pieces(segment, allowed):
                for start, end in hot_windows(text[slice(*run)], mixed.window, mixed.bits):
                    start, end = run[0] + start, run[0] + end
                    if not known(start, end):
                        found.add((start, 3, end))
    return sorted(found)


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    return base, sorted([*base, *entropy_spans(text, base)])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


CANDIDATE = np.zeros(256, bool)
CANDIDATE[[ord(c) for c in map(chr, range(128)) if re.match(f"[{CLASSES[1].chars}]", c)]] = True
SHORTEST = min(HEX_CHARS, *(c.window for c in CLASSES))


def suspects(texts: pa.Array) -> np.ndarray:
    """Whether a text can have any span: a long run of candidate characters, or a name."""
    data, offsets = flat(texts)
    marked = np.zeros(len(texts), bool)
    if not len(data):
        return marked
    inner = CANDIDATE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inner, [False]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    # A run over the end of a text only makes a text a suspect for nothing.
    long = np.flatnonzero(ends - starts >= SHORTEST)
    for start, end in zip(starts[long], ends[long], strict=True):
        first, last = np.searchsorted(offsets, [start, end - 1], side="right") - 1
        marked[first : last + 1] = True
    for i, text in enumerate(texts.to_pylist()):
        if not marked[i]:
            folded = text.lower()
            marked[i] = any(name in folded for name in ASSIGN_NAMES) or b"AKIA" in text
    return marked


NOTHING = hashlib.sha256(b"").hexdigest()


def _scanner() -> Callable[[pa.Array], list]:
    def scan(texts: pa.Array) -> list:
        n = len(texts)
        counts = np.zeros((3, n), np.int64)
        shas, spans = [NOTHING] * n, [""] * n
        for i in np.flatnonzero(suspects(texts)):
            base, every = find_spans(texts[int(i)].as_py().decode())
            for _, kind, _ in base:
                counts[kind, i] += 1
            shas[i] = hashlib.sha256(joined(base).encode()).hexdigest()
            spans[i] = joined(every)
        return [*counts, shas, spans]

    return scan


def scan_secrets(df: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """df with n_assign, n_access, n_hex, base_sha256 and spans."""
    return map_texts(df, text, FIELDS, _scanner, drop_text=drop_text)


def masked(text: str, spans: list[Span]) -> str:
    """text with each stretch of spans that overlap or touch replaced by MASK."""
    parts, at = [], 0
    for start, _, end in spans:
        if start > at or not parts:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _masker() -> Callable[[pa.Array], list]:
    def mask(texts: pa.Array) -> list:
        found = texts.to_pylist()
        made = [None] * len(found)
        for i in np.flatnonzero(suspects(texts)):
            whole = found[i].decode()
            made[i] = masked(whole, spans) if (spans := find_spans(whole)[1]) else None
        return [made]

    return mask


def mask_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """df with every span of its texts replaced by MASK; other texts, nulls too, stay."""
    name = free_name(df, "masked")
    made = map_texts(df, text, [StructField(name, StringType())], _masker)
    whole = F.coalesce(F.col(name), F.col(f"`{text}`")).alias(text)
    return made.select(*[whole if c == text else F.col(f"`{c}`") for c in df.columns])
