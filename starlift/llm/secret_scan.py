"""Secret scans: fixed patterns, plus password guess cost on values in a credential context.

Base kinds (assign, access, hex) are leftmost, non-overlapping matches of their patterns that reach their lengths.
The method looks at every value in a credential context (``password: ...``, ``pin is ...``) that no base span covers:
a dynamic program over its places finds the cheapest segmentation into common words, dates, repeats, keyboard walks
and brute-force spans; the cost is log10 of the guesses, the product over segments with the usual factorial of their
number. A value of at least MIN_COST is a secret of kind "guess". A value that only stands for a secret (``<your-password>``,
``$DB_TOKEN``) is none, nor is a plain lower-case word after "is" (``the password is described below``).

No shuffle: each text is scanned whole in its row. Defined results: null text counts as empty; repeated rows give
repeated results; positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from starlift.llm.common import texts

#: log10 of guesses from which a value is taken for a secret.
MIN_COST = 8.0
#: Longest span looked up as a word (none of the list is longer).
MAX_SEGMENT = 32

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Where a name or a part of it begins: after no letter or digit (``_`` parts names), or at the capital of camelCase.
_PART = r"(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"
# long key words may follow any letters (dbpassword); short ones and the form "... is" need a part of their own (spin, compass)
_CONTEXT = re.compile(r"""(?:(?:pass(?:word|wd|phrase|code)|secret|token|credentials?|api[_.-]?key|auth[_.-]?key|private[_.-]?key|access[_.-]?key|PART(?:pass|pwd|pin))"""
                      r"""(?:[_.-]?(?:access[_.-]?)?(?:key|id|value)|[_.-]?\d{1,4})?["']?\x20*[:=]\x20*"""
                      r"""|PART(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|api[_-]?key|auth[_-]?key|private[_-]?key)["']?\x20is\x20)["']?([^\s"']{6,})""".replace("PART", _PART), re.I | re.A)
_CONTEXT_HINT = re.compile(r"pass|pwd|pin|secret|token|credential|key", re.I | re.A)

#: Values that only stand for a secret: <your-password>, ${DB_PASSWORD}, $(cat key), $DB_TOKEN, %TOKEN%, {{ token }}, [redacted].
_STAND_IN = re.compile(r"<[^<>]*>|\$?\{.*\}|\$\(.*\)?|\$[A-Z_][A-Z0-9_]*|%[A-Za-z_][A-Za-z0-9_]*%|\{\{.*|\[[^\[\]]*\]", re.A)
#: A lower-case word with the marks that end a phrase; after "... is" it continues the sentence.
_PROSE = re.compile(r"[a-z]+(?:-[a-z]+)*[.,;:!?)]*", re.A)

#: Own short list, most guessed first: its place is the number of guesses.
WORDS = {w: k + 1 for k, w in enumerate(
    "password admin welcome login letmein qwerty dragon monkey football baseball master shadow sunshine princess secret "
    "hello freedom whatever trustno summer winter spring autumn love iloveyou test guest root user default changeme "
    "access pass server system data home work family money google computer internet service mustang michael jordan "
    "superman batman hunter ranger buster soccer hockey tiger lion eagle star moon the and you for api key token prod dev".split())}
#: Rows of the keyboard.
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_BESIDE = {frozenset(p) for row in _ROWS for p in zip(row, row[1:])} | {
    frozenset((a, row[k])) for up, row in zip(_ROWS, _ROWS[1:]) for k in range(len(row)) for a in up[k:k + 2]}
_COLUMN = {c: 2 * k + r for r, row in enumerate(_ROWS) for k, c in enumerate(row)}
_LEET = str.maketrans("@4301!5$7", "aaeoiisst")
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)")


def _segments(v: str):
    """(start, end, log10 guesses) of every word, date, repeat and keyboard walk in a value."""
    n, low = len(v), v.lower()
    plain = low.translate(_LEET)
    for i in range(n):
        for j in range(i + 2, min(n, i + MAX_SEGMENT) + 1):
            word = WORDS.get(low[i:j])
            leet = WORDS.get(plain[i:j]) if word is None else None
            if word or leet:
                extra = (v[i:j] != low[i:j]) + 2 * (leet is not None)
                yield i, j, math.log10(word or leet) + 0.31 * extra
        m = _DATE.match(v, i)
        if m:
            yield i, m.end(), 2.1 if m.end() - i == 4 else 4.6
    for size, least in ((1, 3), (2, 2), (3, 2), (4, 2)):
        i = 0
        while i + size * least <= n:
            j = i + size
            while v[j:j + size] == v[i:i + size]:
                j += size
            if j - i >= size * least:
                yield i, j, size * math.log10(_alphabet(v[i:i + size])) + math.log10((j - i) // size)
                i = j - size + 1
            else:
                i += 1
    i = 0
    while i < n - 2:
        j, turns = i + 1, 0
        while j < n and frozenset((low[j - 1], low[j])) in _BESIDE:
            turns += j - i >= 2 and (_COLUMN[low[j]] > _COLUMN[low[j - 1]]) != (_COLUMN[low[j - 1]] > _COLUMN[low[j - 2]])
            j += 1
        if j - i >= 3:
            yield i, j, math.log10(47) + math.log10(j - i) + 0.7 * turns
        i = max(i + 1, j - 1)


def _alphabet(s: str) -> int:
    return sum(k for k, f in ((26, str.islower), (26, str.isupper), (10, str.isdigit)) if any(map(f, s))) + 33 * (not s.isalnum()) or 33


def guess_cost(value: str, enough: float = math.inf) -> float:
    """log10 of the guesses of the cheapest segmentation, or ``enough`` when every segmentation costs that or more.

    ``best[i]`` holds the costs of the first i signs by number of segments and kind of the last one. A cost only grows
    along a segmentation, so a state that reaches ``enough`` is dropped; as 12! is above 10 ** 8, a bounded ``enough``
    leaves few states a place, and a value of any length is decided whole, in time linear in its length.
    """
    unit = math.log10(max(10, _alphabet(value)))
    ending: dict[int, list] = {}
    for i, j, c in _segments(value):
        ending.setdefault(j, []).append((i, c))
    # (segments, whether the last one is brute force): neighbouring brute-force signs are one segment
    best: list[dict] = [{(0, False): 0.0}]
    for j in range(1, len(value) + 1):
        here: dict = {}

        def put(k, brute, cost, here=here):
            if cost + _ways(k) < enough and cost < here.get((k, brute), math.inf):
                here[k, brute] = cost

        for i, c in ending.get(j, ()):
            for (k, _), cost in best[i].items():
                put(k + 1, False, cost + c)
        for (k, brute), cost in best[j - 1].items():
            put(k if brute else k + 1, True, cost + unit)
        # a state with more segments and no less cost never wins
        kept: dict = {}
        least = {False: math.inf, True: math.inf}
        for (k, brute), cost in sorted(here.items()):
            if cost < least[brute]:
                kept[k, brute] = least[brute] = cost
        best.append(kept)
    return min((cost + _ways(k) for (k, _), cost in best[-1].items()), default=enough)


def _ways(segments: int) -> float:
    """log10 of the orders of so many segments."""
    return math.lgamma(segments + 1) / math.log(10)


def is_stand_in(context: str, value: str) -> bool:
    """Whether a value in its context (the match up to the value) names or describes a secret instead of being one."""
    bare = value.rstrip(".,;:)")
    return bool(_STAND_IN.fullmatch(value) or _STAND_IN.fullmatch(bare)
                or context[-4:].lower() == " is " and _PROSE.fullmatch(value))


def find_spans(text: str, min_cost: float = MIN_COST) -> tuple[list, list]:
    """Base spans and spans of the method, each (start, kind number, end)."""
    base = []
    if _ASSIGN_HINT.search(text):
        base += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    base.sort()
    more = []
    if _CONTEXT_HINT.search(text):
        # spans of one kind don't overlap, so the last one that starts before the value's end is the one to look at
        taken = [([s for s, k, _ in base if k == kind], [e for _, k, e in base if k == kind]) for kind in range(3)]
        for m in _CONTEXT.finditer(text):
            s, e = m.span(1)
            last = [(ends, bisect_left(starts, e) - 1) for starts, ends in taken]
            if any(k >= 0 and ends[k] > s for ends, k in last) or is_stand_in(text[m.start():s], m.group(1)):
                continue
            if guess_cost(m.group(1), min_cost) >= min_cost:
                more.append((s, 3, e))
    return base, more


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scanner(min_cost: float):
    def run(batches):
        for b in batches:
            rows = []
            for x in b.column("text"):
                base, more = find_spans(x.as_py(), min_cost)
                n = [sum(k == j for _, k, _ in base) for j in range(3)]
                rows.append((*n, len(more), hashlib.sha256(_join(base).encode()).hexdigest(), _join(sorted(base + more))))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])
    return run


def secrets(docs: DataFrame, min_cost: float = MIN_COST) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans."""
    return texts(docs).mapInArrow(_scanner(min_cost), "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
