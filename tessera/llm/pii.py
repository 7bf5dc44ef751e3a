"""Personal data, also in disguise, with spans in the source text.

The base patterns are searched in the text as it is. Then a chain of
transducers normalises disguises; each maps a text to a text and keeps, for
every character it puts out, the source span it came from:

1. homoglyphs (Cyrillic, Greek, full-width forms, digits of other scripts,
   typographic dashes and spaces) become ASCII, zero-width characters vanish;
2. the letters O, o, I and l in runs that are mostly digits become digits;
3. runs of spelled digits become digits ("plus one five five five");
4. "[at]", "(dot)", "&#64;", " at ... dot ..." become "@" and ".", also between
   numbers ("10[.]0[.]0[.]1").

The same patterns are searched in the result, and a match that touches a
changed character and no span found before is mapped back to the source. Base
spans always stay as they are.

Defined results: a null text is empty (and stays null when masked); repeated
rows are treated alike; an empty table gives an empty result; texts of any
length are scanned whole; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import append_columns

KINDS = ("email", "ip", "card", "phone")
# An address starts where its run of local characters does (or the last match ended),
# a number where its digits do: no run is entered twice.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_PATTERN = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: list[int]) -> bool:
    odd = sum(digits[-1::-2])
    even = sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def valid(kind: str, match: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        parts = [p.lstrip("0") or "0" for p in match.split(".")]
        return all(len(p) <= 3 and int(p) <= 255 for p in parts)
    digits = [int(d) for d in _DIGITS.findall(match)]
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of
    ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each "@" outwards."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        yield from _addresses(text)
    else:
        for m in _PATTERN[kind].finditer(text):
            yield m.span()


def find_plain(text: str) -> list[tuple[str, int, int]]:
    """Base matches ``(kind, start, end)``, leftmost and non-overlapping per
    kind, by start, then kind as listed. The tests before a pattern only skip
    texts that lack a character every match has."""
    if not _DIGITS.search(text):
        kinds = ("email",) if "@" in text else ()
    else:
        kinds = KINDS if "@" in text else KINDS[1:]
        if "+" not in text:
            kinds = tuple(k for k in kinds if k != "phone")
    found = [(s, KINDS.index(k), e) for k in kinds for s, e in _matches(k, text) if valid(k, text[s:e])]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


# --- fixed values: characters that look like ASCII ones ---------------------
_LOOKALIKE = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "З": "3",
    # Greek
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # hyphens, dashes and minus
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2212": "-",
    # full stops and a middle dot
    "\u2024": ".", "\u3002": ".", "\uff61": ".", "\u00b7": ".",
    # spaces
    "\u00a0": " ", "\u2007": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
    # zero width
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "", "\u00ad": "",
}
_SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
            "six": "6", "seven": "7", "eight": "8", "nine": "9"}
# ---------------------------------------------------------------------------
_FULL_WIDTH = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
HOMOGLYPHS = _LOOKALIKE | _FULL_WIDTH
_HOMOGLYPH = re.compile("[" + re.escape("".join(HOMOGLYPHS)) + r"]|(?![0-9])\d")
_DIGIT_LETTERS = {"O": "0", "o": "0", "I": "1", "l": "1"}
_DIGIT_LETTER = re.compile("[OoIl]")
_MIXED_HINT = re.compile(r"[0-9][ ().-]{0,2}[OoIl]|[OoIl][ ().-]{0,2}[0-9]")
_MIXED_RUN = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl]+(?:[ ().-]{1,2}[0-9OoIl]+)*(?![A-Za-z0-9])")
_WORD = "|".join(_SPELLED)
# two or more spelled digits in a row; "plus" and "dot" between or before them
_SPELLED_RUN = re.compile(
    rf"(?:\bplus[ ,-]+)?\b(?:{_WORD}|[0-9]+)\b(?:(?:[ ,-]+(?:(?:dot|point)[ ,-]+)?)(?:{_WORD}|[0-9]+)\b)+",
    re.IGNORECASE)
_SPELLED_ONE = re.compile(rf"\b(?:{_WORD})\b", re.IGNORECASE)
_SPELLED_PART = re.compile(r"[0-9]+|[A-Za-z]+")
_LABEL = r"[A-Za-z0-9][A-Za-z0-9-]*"
_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|&#0*64;|&#x0*40;|&commat;|%40)"
_DOT = r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*"
# bracketed, or both bare words before a usual top-level name: "name at host dot org"
_TOP = "com|org|net|edu|gov|mil|int|info|biz|io|co|eu|us|uk|de|fr|es|it|nl|ch|at|ca|au"
_LETTERED = (
    rf"[A-Za-z0-9._%+-]+(?:{_DOT}[A-Za-z0-9_%+-]+)*{_AT}{_LABEL}(?:(?:{_DOT}|\s+dot\s+|\.){_LABEL})+"
    rf"|[A-Za-z0-9._%+-]+(?:\s+dot\s+[A-Za-z0-9_%+-]+)*\s+at\s+{_LABEL}(?:(?:{_DOT}|\s+dot\s+){_LABEL})*"
    rf"(?:{_DOT}|\s+dot\s+)(?:{_TOP})\b"
    rf"|[A-Za-z0-9._%+-]+@{_LABEL}(?:(?:{_DOT}|\s+dot\s+|\.){_LABEL})+")
_NUMBERED = rf"[0-9]+(?:(?:{_DOT}|\s+dot\s+|\.)[0-9]+){{3}}"
_LETTERED_HERE = re.compile(_LETTERED, re.IGNORECASE)
_NUMBERED_HERE = re.compile(_NUMBERED, re.IGNORECASE)
_NUMBERED_NEXT = re.compile(rf"(?<![0-9]){_NUMBERED}", re.IGNORECASE)
_RUN = re.compile(r"[A-Za-z0-9._%+-]+", re.IGNORECASE)
# a run and the parts that dots of one kind join to it
_CHAIN = re.compile(rf"[A-Za-z0-9._%+-]+(?:(?:{_DOT}([A-Za-z0-9_%+-]+))+|(?:\s+dot\s+([A-Za-z0-9_%+-]+))+)",
                    re.IGNORECASE)
_GAP = re.compile(rf"{_AT}|{_DOT}|\s+(?:at|dot)\s+", re.IGNORECASE)
# as _AT and _DOT, without the blanks before them
_HINT = re.compile(r"\bdot\b|[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]|&#0*64;|&#x0*40;|&commat;|%40", re.IGNORECASE)


class Mapped:
    """A text whose characters know their source spans and whether they were
    put there by a transducer."""

    def __init__(self, text: str, start: list[int], end: list[int], changed: list[bool]):
        self.text, self.start, self.end, self.changed = text, start, end, changed

    @classmethod
    def plain(cls, text: str) -> Mapped:
        n = len(text)
        return cls(text, list(range(n)), list(range(1, n + 1)), [False] * n)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace the (ordered, disjoint) spans of ``edits``; every character
        of a replacement maps to the whole source span it replaces."""
        text, start, end, changed, at = [], [], [], [], 0
        for s, e, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:s])
            start += self.start[at:s]
            end += self.end[at:s]
            changed += self.changed[at:s]
            if new:
                text.append(new)
                start += [self.start[s]] * len(new)
                end += [self.end[e - 1]] * len(new)
                changed += [True] * len(new)
            at = e
        return Mapped("".join(text), start, end, changed)


def _homoglyphs(m: Mapped) -> Mapped:
    return m.rewrite([
        (x.start(), x.end(), HOMOGLYPHS[x[0]] if x[0] in HOMOGLYPHS else str(unicodedata.decimal(x[0])))
        for x in _HOMOGLYPH.finditer(m.text)])


def _digit_letters(m: Mapped) -> Mapped:
    edits = []
    for run in _MIXED_RUN.finditer(m.text):
        digits = len(_DIGITS.findall(run[0]))
        letters = [x for x in _DIGIT_LETTER.finditer(m.text, run.start(), run.end())]
        if letters and digits >= 2 * len(letters):
            edits += [(x.start(), x.end(), _DIGIT_LETTERS[x[0]]) for x in letters]
    return m.rewrite(edits)


def _spelled_digits(m: Mapped) -> Mapped:
    edits = []
    for run in _SPELLED_RUN.finditer(m.text):
        if not _SPELLED_ONE.search(run.group()):
            continue
        last = run.start()
        for part in _SPELLED_PART.finditer(m.text, run.start(), run.end()):
            word = part.group().lower()
            new = {"plus": "+", "dot": ".", "point": "."}.get(word) or _SPELLED.get(word, word)
            # separators between the parts vanish
            if part.start() > last:
                edits.append((last, part.start(), ""))
            if new != part.group():
                edits.append((part.start(), part.end(), new))
            last = part.end()
    return m.rewrite(edits)


def _lettered(text: str, at: int) -> re.Match[str] | None:
    """The next disguised address. A run of local characters is tried at its start
    only, and of a chain of runs the first and the last: what fails there fails at
    those between, which lead on to the same end."""
    while run := _RUN.search(text, at):
        if found := _LETTERED_HERE.match(text, run.start()):
            return found
        chain = _CHAIN.match(text, run.start())
        # ("%40" is an "at" inside a run)
        at = max(chain.start(1), chain.start(2)) if chain and "%40" not in chain.group() else run.end()
    return None


def _disguises(text: str) -> Iterator[re.Match[str]]:
    """Leftmost non-overlapping disguised addresses and numbers."""
    name, number = _lettered(text, 0), _NUMBERED_NEXT.search(text)
    while name or number:
        found = name if name and (not number or name.start() <= number.start()) else number
        yield found
        at = found.end()
        if name and name.start() < at:
            name = _lettered(text, at)
        if number and number.start() < at:
            number = _NUMBERED_HERE.match(text, at) or _NUMBERED_NEXT.search(text, at)


def _at_and_dot(m: Mapped) -> Mapped:
    edits = []
    for x in _disguises(m.text):
        # split the match into its labels; what lies between is "@" or "."
        for gap in _GAP.finditer(m.text, x.start(), x.end()):
            is_dot = "dot" in gap[0].lower() or "." in gap[0]
            edits.append((gap.start(), gap.end(), "." if is_dot else "@"))
    return m.rewrite(edits)


def find_disguised(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Matches of the normalised text that need a changed character, as source
    spans, none touching a span of ``taken`` or another of the result."""
    m = None
    if not text.isascii() and _HOMOGLYPH.search(text):
        m = _homoglyphs(Mapped.plain(text))
    flat = text if m is None else m.text
    if _MIXED_HINT.search(flat):
        m = _digit_letters(m or Mapped.plain(text))
        flat = m.text
    if _SPELLED_ONE.search(flat) and _SPELLED_RUN.search(flat):
        m = _spelled_digits(m or Mapped.plain(text))
        flat = m.text
    low = flat.lower()
    if ("dot" in low or any(c in flat for c in "[({<&%")) and _HINT.search(flat):
        m = _at_and_dot(m or Mapped.plain(text))
    if m is None:
        return []
    out: list[tuple[str, int, int]] = []
    starts: list[int] = []      # of the taken stretches, joined where they touch
    ends: list[int] = []
    for s, e in sorted((s, e) for _, s, e in taken):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for kind, s, e in find_plain(m.text):
        a, b = min(m.start[s:e]), max(m.end[s:e])
        if b - a != e - s or any(m.changed[s:e]):      # longer: something vanished inside
            i = bisect_right(ends, a)                  # the first stretch that ends behind a
            if i == len(starts) or b <= starts[i]:
                out.append((kind, a, b))
                starts.insert(i, a)
                ends.insert(i, b)
    return out


def find_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the spans that the normalised text adds."""
    if not text:
        return [], []
    base = find_plain(text)
    return base, find_disguised(text, base)


def _in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in _in_order(spans))


SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                  ("end", pa.int64()), ("base", pa.bool_())]))


def with_spans(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` plus ``name``, the array of ``kind, start, end, base`` found in
    ``text`` (code points, end exclusive)."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for text in batch.column(at).to_pylist():
            base, more = find_spans(text)
            own = set(base)
            rows.append([{"kind": x[0], "start": x[1], "end": x[2], "base": x in own}
                         for x in _in_order(base + more)])
        return [pa.array(rows, _SPAN_ARROW)]

    return append_columns(docs, run, [T.StructField(name, SPAN)])


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, the digest of the
    base spans and all spans as text."""
    names = [f"n_{k}" for k in KINDS]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, digests, joined = [[] for _ in KINDS], [], []
        for text in batch.column(1).to_pylist():
            base, more = find_spans(text)
            for i, kind in enumerate(KINDS):
                counts[i].append(sum(x[0] == kind for x in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            joined.append(_joined(base + more))
        return [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                pa.array(joined, pa.string())]

    fields = [*(T.StructField(n, T.LongType()) for n in names),
              T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return append_columns(docs.select("doc_id", "text"), run, fields).drop("text")


def mask_text(text: str | None) -> str | None:
    """The text with every span (touching ones as one) replaced by its kind."""
    base, more = find_spans(text)
    if not base and not more:
        return text
    out, at, until = [], 0, 0
    for kind, s, e in _in_order(base + more):
        if s >= until:
            out += [text[at:s], f"[{kind.upper()}]"]
        until = at = max(until, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``, and ``n_chars``, if
    there is such a column, set to the new length where the text changed."""
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([mask_text(t) for t in batch.column(at).to_pylist()], pa.string())]

    out = append_columns(docs, run, [T.StructField("__masked", T.StringType())])
    new = {"text": F.col("__masked")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("__masked") == F.col("text"), F.col("n_chars")).otherwise(
            F.coalesce(F.length("__masked").cast(kind), F.col("n_chars")))
    return out.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))
