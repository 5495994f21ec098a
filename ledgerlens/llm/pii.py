"""Personal data in texts, also behind simple disguises, with exact source offsets.

Plain identifiers are found in the text itself. Then a transducer rewrites
look-alike letters and digits, spelled digits and at/dot disguises, remembering
for every piece where it came from; identifiers that only show up in the rewritten
text are mapped back to the source characters and added.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import per_row

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behind only skips starts inside a run of digits, which match nothing that the run's start didn't.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII letters.
_LOOKALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "ο": "o", "α": "a", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "​": "", "‌": "", "‍": "", "⁠": "", "﻿": "", "­": "",
}
_DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}

# Words and numbers that a disguise can be made of. A number is only taken whole.
_PART = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:(?P<digit>{'|'.join(_DIGITS)})|(?P<plus>plus)|(?P<dot>dot|point)|(?P<at>at)|(?P<number>[0-9]+))(?![A-Za-z0-9])")
_GAP = re.compile(r"[\s-]+")
_BRACKETS = re.compile(r"(?i)[(\[{<]\s*(at|dot)\s*[)\]}>]")
# Last labels of host names that make a bare "at" or "dot" a disguise.
_ENDINGS = frozenset("com org net edu gov mil info biz io co app dev me ai tv xyz site online tech shop blog cloud email name pro de fr es it nl uk eu us ca ch at be pl se ru jp cn in br au dk no fi cz pt gr ie nz za mx kr".split())
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
#: Digits, spelled or not, from which on a run with any spelled digit is rewritten; one of three spelled digits always is.
_RUN_DIGITS = 9
_FOREIGN = re.compile(r"[^\x00-\x7fÀ-ɏ]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of identifiers as they stand, leftmost and non-overlapping within a kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def _around(text: str, start: int, end: int) -> tuple[int, int]:
    """The piece with the white space on both sides."""
    while start > 0 and text[start - 1].isspace():
        start -= 1
    while end < len(text) and text[end].isspace():
        end += 1
    return start, end


def _spelled(text: str, parts: list[re.Match]) -> list[tuple[int, int, str]]:
    """Runs of spelled digits, numbers and spoken points with nothing but spaces and hyphens between, as digits."""
    out, run = [], []

    def flush():
        while run and run[-1].lastgroup in ("dot", "plus"):
            run.pop()
        while run and run[0].lastgroup == "dot":
            run.pop(0)
        words = sum(m.lastgroup == "digit" for m in run)
        if words and (words >= 3 or words + sum(len(m[0]) for m in run if m.lastgroup == "number") >= _RUN_DIGITS):
            out.append((run[0].start(), run[-1].end(), "".join({"digit": lambda w: _DIGITS[w.lower()], "dot": lambda w: ".", "plus": lambda w: "+", "number": str}[m.lastgroup](m[0]) for m in run)))
        run.clear()

    for m in parts:
        if m.lastgroup == "at":
            continue
        if run and (m.lastgroup == "plus" or not _GAP.fullmatch(text, run[-1].end(), m.start())):
            flush()
        run.append(m)
    flush()
    return out


def _spoken(text: str, parts: list[re.Match]) -> list[tuple[int, int, str]]:
    """Bare "at" and "dot" between white space that make up a host name, an address or numbers, left to right in one pass."""
    out: list[tuple[int, int, str]] = []
    hosts: set[int] = set()
    chain: list[tuple[int, int, int]] = []  # (start, end) of each "dot" with its white space, end of what follows

    def flush():
        known = [k for k, (_, b, e) in enumerate(chain) if text[b:e].rsplit(".", 1)[-1].lower() in _ENDINGS]
        for k, (a, b, _) in enumerate(chain):
            if (known and k <= known[-1]) or (text[a - 1].isdigit() and text[b].isdigit()):
                out.append((a, b, "."))
        if known:
            first = chain[0][0]
            while first > 0 and (text[first - 1] in _NAME or text[first - 1] == "."):
                first -= 1
            hosts.add(first)
        chain.clear()

    ats = []
    for m in parts:
        if m.lastgroup not in ("at", "dot"):
            continue
        a, b = _around(text, *m.span())
        if a == m.start() or b == m.end() or a == 0 or b == len(text) or text[a - 1] not in _LOCAL or text[b] not in _NAME:
            continue
        if m.lastgroup == "at":
            ats.append((a, b))
        elif m[0].lower() == "dot" and text[a - 1] in _NAME:
            if chain and chain[-1][2] != a:
                flush()
            chain.append((a, b, _HOST.match(text, b).end()))
    flush()
    for a, b in ats:
        if b not in hosts:
            # before a host as it stands, only what looks like a mailbox's name
            start = a
            while start > 0 and text[start - 1] in _LOCAL:
                start -= 1
            host = _HOST.match(text, b)[0]
            if "." not in host or host.rsplit(".", 1)[1].lower() not in _ENDINGS or not any(c in "._+%0123456789" for c in text[start:a]):
                continue
        out.append((a, b, "@"))
    return out


def _edits(text: str) -> list[tuple[int, int, str]]:
    """Rewrites (start, end, replacement), sorted and without overlaps; of two that overlap the first stays, or the longer."""
    found: list[tuple[int, int, str]] = []
    if not text.isascii():
        for m in _FOREIGN.finditer(text):
            c = m[0]
            new = _LOOKALIKE.get(c)
            if new is None and (d := unicodedata.decimal(c, None)) is not None:
                new = str(d)
            if new is None and "！" <= c <= "～":
                new = chr(ord(c) - 0xFEE0)
            if new is not None:
                found.append((m.start(), m.end(), new))
    parts = list(_PART.finditer(text))
    found += _spelled(text, parts)
    for m in _BRACKETS.finditer(text):
        found.append((*_around(text, *m.span()), "@" if m[1].lower() == "at" else "."))
    if any(m.lastgroup in ("at", "dot") for m in parts):
        found += _spoken(text, parts)
    found.sort(key=lambda e: (e[0], -e[1]))
    out, end = [], 0
    for e in found:
        if e[0] >= end:
            out.append(e)
            end = e[1]
    return out


def disguised_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans, in source offsets, of identifiers that only the rewritten text shows."""
    edits = _edits(text)
    if not edits:
        return []
    pieces, norm_at, rows, at, pos = [], [], [], 0, 0  # rows: (source start, source end, rewritten)
    for s, e, new in edits:
        for a, b, t, changed in ((at, s, text[at:s], False), (s, e, new, True)):
            if t:
                pieces.append(t)
                norm_at.append(pos)
                rows.append((a, b, changed))
                pos += len(t)
        at = e
    if at < len(text):
        pieces.append(text[at:])
        norm_at.append(pos)
        rows.append((at, len(text), False))
    out = []
    for kind, s, e in plain_spans("".join(pieces)):
        i, j = bisect_right(norm_at, s) - 1, bisect_right(norm_at, e - 1) - 1
        start = rows[i][0] if rows[i][2] else rows[i][0] + s - norm_at[i]
        end = rows[j][1] if rows[j][2] else rows[j][0] + e - norm_at[j]
        if any(a < end and b > start for a, b, _ in edits[max(0, bisect_right(edits, (start,)) - 1) : bisect_right(edits, (end,))]):
            out.append((kind, start, end))
    return out


def all_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain, all) spans; a disguised span is added unless a span of its kind already covers it."""
    if not text:
        return [], []
    base = sorted(plain_spans(text), key=lambda x: (x[1], KINDS.index(x[0])))
    full = list(base)
    own = {kind: [(s, e) for k, s, e in base if k == kind] for kind in KINDS}
    for k, s, e in disguised_spans(text):
        # plain spans of a kind don't overlap: only the last that begins by s can cover
        at = bisect_right(own[k], (s, len(text))) - 1
        if at < 0 or own[k][at][1] < e:
            full.append((k, s, e))
    return base, sorted(full, key=lambda x: (x[1], KINDS.index(x[0])))


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) as kind:start:end lists per row: every span of every whole text; null and empty texts have none."""

    def run(b):
        base, full = zip(*[all_spans(t) for t in b.column(1).to_pylist()]) if b.num_rows else ((), ())
        return {"doc_id": b.column(0), "base": [join_spans(x) for x in base], "spans": [join_spans(x) for x in full]}

    return per_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, base string, spans string")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, digest of the base spans, and all spans with their own counts.

    n_<kind> counts the base spans that base_sha256 covers; n_<kind>_all also the disguised ones in ``spans``.
    Repeated rows are returned each, null ids are kept, other columns are ignored.
    """
    count = lambda c, k: (F.length(c) - F.length(F.replace(c, F.lit(f"{k}:"), F.lit("")))) / (len(k) + 1)
    found = find(docs)
    cols = [count(F.col("base"), k).cast("long").alias(f"n_{k}") for k in KINDS]
    more = [count(F.col("spans"), k).cast("long").alias(f"n_{k}_all") for k in KINDS]
    return found.select("doc_id", *cols, F.sha2("base", 256).alias("base_sha256"), "spans", *more)
