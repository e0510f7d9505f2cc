"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A vocabulary learnt from ordinary text spends few tokens on words and many on
random characters. A run of 16 or more key characters, with a letter (under 20
characters: with a digit, or capitals after small letters), that
yields fewer than ``max_ratio`` characters a token is reported as ``random``,
unless it has the form of a known digest, a UUID or an identifier (words joined
by separators, with a number at the end, words by the same ratio), or lies
inside a span that a pattern has found. Of any other run, the stretches between
``= / _ -`` are judged as well: each run of adjoining stretches of 16 or more
characters that falls furthest below the ratio, separators not counted.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelstat.llm.common import text_blocks
from reelstat.llm.tokens import VOCABULARY, encoding

#: Fixed patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "random"]

#: Characters of a run that is judged, and of one that may be of letters in one case.
LEAST, PLAIN = 16, 20
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")
_STRETCH = re.compile(r"[A-Za-z0-9+]+")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
_DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}
_UUID = re.compile(r"(?<![A-Za-z0-9+])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9+])")
_IDENTIFIER = re.compile(r"[+/_=-]*+[A-Za-z][A-Za-z+/_=-]*+[0-9]{0,8}+[/=]*+")  # never tries a character twice


def _tokens(s: str, vocabulary: str) -> int:
    return len(encoding(vocabulary).encode_ordinary(s))


def _known_form(s: str) -> bool:
    return bool(_UUID.fullmatch(s) or (len(s) in _DIGEST_LENGTHS and _DIGEST.fullmatch(s)))


def _named(s: str, vocabulary: str, max_ratio: float) -> bool:
    """Whether a run has the form of an identifier of words; words under four letters tell nothing."""
    if not _IDENTIFIER.fullmatch(s):
        return False
    words = re.findall(r"[A-Za-z]{4,}", s)
    return sum(map(len, words)) < (PLAIN if len(s) >= PLAIN else LEAST) or sum(map(len, words)) >= max_ratio * sum(_tokens(w, vocabulary) for w in words)


def _telling(s: str) -> bool:
    """Whether a run is long or varied enough for its ratio to tell something."""
    return len(s) >= PLAIN or bool(_MIXED.search(s))


def _random_parts(s: str, vocabulary: str, max_ratio: float) -> list[tuple[int, int]]:
    """Runs of adjoining stretches with the most tokens beyond ``max_ratio``, from the best on, none overlapping."""
    known = [m.span() for m in _UUID.finditer(s)]
    stretches, groups = [], []
    for m in _STRETCH.finditer(s):
        if any(a <= m.start() and m.end() <= b for a, b in known) or _known_form(m[0]):
            groups.append(stretches)
            stretches = []
        else:
            stretches.append((*m.span(), max_ratio * _tokens(m[0], vocabulary) - len(m[0])))
    groups.append(stretches)
    out = []
    while groups:
        group = groups.pop()
        best, total, sums, first, least = (0.0, 0, 0), 0.0, [], 0, (0.0, 0)
        for j, (_, end, gain) in enumerate(group):
            sums.append(total)
            total += gain
            while first <= j and group[first][0] <= end - LEAST:
                least = min(least, (sums[first], first)) if first else (sums[0], 0)
                first += 1
            if first and total - least[0] > best[0]:
                best = (total - least[0], least[1], j + 1)
        if best[0] > 0:
            _, i, j = best
            span = group[i][0], group[j - 1][1]
            if any(map(str.isalpha, s[span[0]:span[1]])) and _telling(s[span[0]:span[1]]) and not _named(s[span[0]:span[1]], vocabulary, max_ratio):
                out.append(span)
            groups += [group[:i], group[j:]]
    return out


class _Outer:
    """Tells whether one of the spans holds a place."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        ordered = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in ordered]
        self.ends = list(accumulate((b for _, b in ordered), max))  # the farthest end of the spans up to here

    def hold(self, start: int, end: int) -> bool:
        n = bisect_right(self.starts, start)
        return n > 0 and self.ends[n - 1] >= end


def find_spans(text: str | None, vocabulary: str = VOCABULARY, max_ratio: float = 2.0) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind as listed; none for a null or empty text."""
    if not text:
        return []
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    found, outer = list(spans), _Outer(spans)
    for m in _CANDIDATE.finditer(text):
        s, at = m[0], m.start()
        if outer.hold(at, m.end()) or _known_form(s):
            continue
        whole = len(s) < max_ratio * _tokens(s, vocabulary) and _telling(s) and not _named(s, vocabulary, max_ratio)
        for a, b in [(0, len(s))] if whole else _random_parts(s, vocabulary, max_ratio):
            if not outer.hold(at + a, at + b):
                found.append(("random", at + a, at + b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str | None, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping spans replaced by one mark."""
    if not spans:
        return text
    out, at, open_until = [], 0, -1
    for _, start, end in sorted(spans, key=lambda x: x[1]):
        if start >= open_until:
            out += [text[at:start], mark]
        open_until = at = max(open_until, end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = 2.0, spans_column: str = "secret_spans",
         clean_column: str = "redacted_text") -> DataFrame:
    """The rows with ``secret_spans`` (array of kind, start, end) and ``redacted_text`` in front of all columns.

    Null texts have no spans and stay null. Rows are judged one by one, so
    repeated rows repeat. New columns take the place of equally named ones.
    """
    new = StructType.fromDDL(f"{spans_column} array<struct<kind string, start long, end long>>, {clean_column} string")
    rest = [c for c in docs.columns if c not in new.names]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans, clean = [], []
            for _, _, texts in text_blocks(batch, text):
                for t in texts:
                    found = find_spans(t, vocabulary, max_ratio)
                    spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                    clean.append(redacted(t, found))
            yield pa.RecordBatch.from_arrays([pa.array(spans, kind), pa.array(clean, pa.string())] +
                                             [batch.column(batch.schema.get_field_index(c)) for c in rest], new.names + rest)

    kept = docs.select(*rest)
    return kept.mapInArrow(run, StructType(new.fields + kept.schema.fields))


def digest_columns(spans: str = "secret_spans") -> dict:
    """Counts and digests of a span column: n_assign, n_access, n_hex, base_sha256, spans."""
    as_text = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = f"filter({spans}, s -> s.kind <> 'random')"
    counts = {f"n_{k}": F.expr(f"cast(size(filter({spans}, s -> s.kind = '{k}')) as long)") for k in KINDS[:3]}
    return counts | {"base_sha256": F.expr(f"sha2({as_text.format(base)}, 256)"), "spans": F.expr(as_text.format(spans))}
