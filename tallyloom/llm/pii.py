"""Personal data found through disguises, with spans in the source text.

Base patterns run on the text as it is. Then transducers rewrite it step by step: look-alike characters to ASCII, invisible characters away, runs of
spelled digits to digits, and "at"/"dot" in brackets or between words to the signs. Bare dots count on both sides of an "@" and between the four numbers of an ip. The separators between spelled
digits go, but an ip is also looked for where their dots stay. A tape keeps for every
rewritten character the source characters it stands for, so that what the same patterns find on the tape maps back to source offsets. Spans that only the tape shows are
added; base spans stay.

Offsets are code points, ends exclusive. Null text is empty and has no spans. Spans may overlap between kinds; redaction joins those that do.
Patterns run in linear time on long texts. Repeated rows get equal results; columns other than doc_id and text pass through `redact` untouched.
"""

from __future__ import annotations

import copy
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare

Span = tuple[int, int, str]
KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done, "email"
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    doubled = [(2 * d - 9 * (d > 4)) if k % 2 else d for k, d in enumerate(map(int, reversed(digits)))]
    return sum(doubled) % 10 == 0


def detect(text: str) -> list[Span]:
    """Base spans of all kinds, by start and then kind."""
    found = list(emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Tape:
    """A rewritten text; character i stands for source characters begin[i] to end[i]."""

    def __init__(self, text: str):
        self.text, self.begin = text, np.arange(len(text))
        self.end = self.begin + 1
        self.changed = np.zeros(len(text), bool)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the ranges, which are in order and do not overlap."""
        if not edits:
            return
        text, begin, end, changed, done = [], [], [], [], 0
        for a, b, new in edits:
            text += [self.text[done:a], new]
            begin += [self.begin[done:a], np.full(len(new), self.begin[a])]
            end += [self.end[done:a], np.full(len(new), self.end[b - 1])]
            changed += [self.changed[done:a], np.ones(len(new), bool)]
            done = b
        self.text = "".join([*text, self.text[done:]])
        self.begin, self.end, self.changed = (np.concatenate([*x, y[done:]]) for x, y in ((begin, self.begin), (end, self.end), (changed, self.changed)))

    def source(self, start: int, stop: int) -> tuple[int, int]:
        return int(self.begin[start]), int(self.end[stop - 1])


# Letters that look like ASCII ones: of other scripts, and the Latin ones that a match without regard to case takes for i and s.
LOOKALIKES = dict(zip("аеорсухіјѕԁԛԝһӏАВЕКМНОРСТХІЈЅοανρτυιΑΒΕΖΗΙΚΜΝΟΡΤΥΧıİſ", "aeopcyxijsdqwhlABEKMHOPCTXIJSoavptuiABEZHIKMNOPTYXiIs"))
SIGNS = {"。": ".", "｡": ".", "․": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹫": "@"}
# Characters that cannot be part of a disguise: ASCII, accented Latin letters and common typographic signs.
UNUSUAL = re.compile(r"[^\x00-\x7f¡-¶¸-įĲ-ž‘-‟•…€]")
DIGITS = {word: str(value) for words in ("zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun", "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve") for value, word in enumerate(words.split())}
SPELLED = "|".join(sorted(DIGITS, key=len, reverse=True))
AT, DOT = "at|arroba|chez", "dot|punto|punkt|point"
# Digits, spelled or plain, with separators or spoken dots between them.
DIGIT_GAP = rf"(?:[ ,.-]{{1,2}}| (?:{DOT}) )"
DIGIT_RUN = re.compile(rf"(?:(?:\bplus|\+) ?)?\b((?:{SPELLED}|[0-9]++)(?:{DIGIT_GAP}(?:{SPELLED}|[0-9]++)\b){{2,}}+)", re.I)
DIGIT_TOKEN = re.compile(rf"\b(?:({SPELLED})|[0-9]+)\b", re.I)
SAYS_DIGIT = re.compile(rf"\b(?:{SPELLED})\b", re.I)
CHANGED_GAP = re.compile(rf"(?<=[0-9]){DIGIT_GAP}(?=[0-9])", re.I)
# What a run needs: this many spelled digits in a row, or single digits in a row of which one is spelled, or dots for an ip.
SPELLED_ROW, SINGLE_ROW, IP_DOTS = 3, 4, 3
BRACKETED = re.compile(rf"\s?[\[({{<]\s?(?:({AT})|({DOT}))\s?[\])}}>]\s?", re.I)
# Without brackets the words are common, so "at" must be followed by a name and a spoken dot, and only the plainest words count.
BARE_AT, BARE_DOTS = "at|arroba", "dot|punto|punkt"
BARE = re.compile(rf"(?<=[A-Za-z0-9]) (?:{BARE_AT}) (?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)* (?:{BARE_DOTS}) [A-Za-z0-9])", re.I)
BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9]) (?:{BARE_DOTS}) (?=[A-Za-z0-9])", re.I)
# Four numbers with a bare dot among their dots; "point" is plain enough there.
BARE_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:\.| (?:{DOT}) )[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
IP_DOT = re.compile(rf" (?:{DOT}) ", re.I)
HOST = re.compile(r"[A-Za-z0-9.-]+")
DOT_BEHIND, LONGEST_DOT = re.compile(rf" (?:{BARE_DOTS}) \Z", re.I), 2 + max(map(len, BARE_DOTS.split("|")))
SAYS_DOT = re.compile(rf"\b(?:{BARE_DOTS})\b|(?<=[0-9]) (?:{DOT}) (?=[0-9])|[\[({{<]\s?(?:{AT}|{DOT})\s?[\])}}>]", re.I)


def plain_character(c: str) -> str:
    """What a character looks like; an invisible one is nothing."""
    if c in LOOKALIKES or c in SIGNS:
        return LOOKALIKES.get(c) or SIGNS[c]
    kind = unicodedata.category(c)
    if kind == "Cf":
        return ""
    if kind == "Nd":
        return str(unicodedata.digit(c))
    if kind == "Zs":
        return " "
    known = unicodedata.normalize("NFKC", c)
    return known if len(known) == 1 and known.isascii() else c


def show_characters(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), new) for m in UNUSUAL.finditer(tape.text) if (new := plain_character(m.group())) != m.group()])


def digit_runs(text: str) -> Iterator[tuple[int, list[re.Match]]]:
    """Start and tokens of the runs that may be a number in disguise."""
    for run in DIGIT_RUN.finditer(text):
        tokens = list(DIGIT_TOKEN.finditer(text, run.start(1), run.end(1)))
        spelled = single = longest_spelled = longest_single = dots = 0
        mixed = False
        for k, t in enumerate(tokens):
            spelled = spelled + 1 if t.group(1) else 0
            single = single + 1 if t.group(1) or len(t.group()) == 1 else 0
            mixed = single > 0 and (mixed or bool(t.group(1)))
            longest_spelled = max(longest_spelled, spelled)
            longest_single = max(longest_single, single if mixed else 0)
            dots += k > 0 and text[tokens[k - 1].end() : t.start()].strip() not in ("", ",", "-", "--", ",-", "-,", ",,")
        if longest_spelled >= SPELLED_ROW or longest_single >= SINGLE_ROW or (dots >= IP_DOTS and any(t.group(1) for t in tokens)):
            yield run.start(), tokens


def show_digits(tape: Tape) -> Tape | None:
    """Digits of a run without the gaps between them; if that takes dots away, the tape on which they stay is returned."""
    edits = []
    for start, tokens in digit_runs(tape.text):
        if tokens[0].start() > start:
            edits.append((start, tokens[0].start(), "+"))
        edits += [(t.start(), t.end(), DIGITS.get(t.group().lower(), t.group())) for t in tokens if t.group(1) or len(t.group()) == 1]
    tape.rewrite(edits)
    # Between single digits that were rewritten, the separators go.
    gaps = [g for g in CHANGED_GAP.finditer(tape.text) if tape.changed[g.start() - 1] and tape.changed[g.end()]]
    spoken = [any(c.isalpha() for c in g.group()) for g in gaps]
    dotted = None
    if any(s or "." in g.group() for s, g in zip(spoken, gaps)):
        dotted = copy.copy(tape)
        dotted.rewrite([(g.start(), g.end(), "." if "." in g.group() else "") for s, g in zip(spoken, gaps) if not s])
    tape.rewrite([(g.start(), g.end(), "") for g in gaps])
    return dotted


def dot_before(text: str, end: int) -> tuple[int, int] | None:
    """The bare dot before the word of a local part that ends here."""
    start = end
    while start and text[start - 1] in LOCAL_PART:
        start -= 1
    if start < end and (dot := DOT_BEHIND.search(text, max(0, start - LONGEST_DOT), start)):
        return BARE_DOT.match(text, dot.start()) and dot.span()
    return None


def show_signs(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), "@" if m.group(1) else ".") for m in BRACKETED.finditer(tape.text)])
    edits = []
    for m in BARE.finditer(tape.text):
        edits.append((m.start(), m.end(), "@"))
    tape.rewrite(edits)
    dots = []
    for m in re.finditer("@", tape.text):
        at = m.end()
        while (word := HOST.match(tape.text, at)) and (dot := BARE_DOT.match(tape.text, word.end())):
            dots.append((dot.start(), dot.end()))
            at = dot.end()
        at = m.start()
        while dot := dot_before(tape.text, at):
            dots.append(dot)
            at = dot[0]
    for m in BARE_IP.finditer(tape.text):
        dots += [d.span() for d in IP_DOT.finditer(tape.text, m.start(), m.end())]
    edits, done = [], 0
    for a, b in sorted(set(dots)):
        if a >= done:
            edits.append((a, b, "."))
            done = b
    tape.rewrite(edits)


def counted(digits: str, source: str) -> bool:
    """Whether an ip is no ip but four single digits in sentences or lines of their own, as in counting: "one. two. three. four"."""
    return len(digits) == 7 and re.search(r"\.\s|\s\.", source) is not None


def added(text: str, base: list[Span]) -> list[Span]:
    """Spans that only show on the rewritten text."""
    odd = not text.isascii() and UNUSUAL.search(text)
    spelled, says = SAYS_DIGIT.search(text) and any(digit_runs(text)), SAYS_DOT.search(text)
    if not (odd or spelled or says):
        return []
    tape, dotted = Tape(text), None
    show_characters(tape)
    if odd or spelled:
        dotted = show_digits(tape)
    if odd or says:
        show_signs(tape)
    if not tape.changed.any() and len(tape.text) == len(text):
        return []
    known = set(base)
    covered = {k: [(a, b) for a, b, kind in base if kind == k] for k in KINDS}
    found = {(*tape.source(a, b), kind) for a, b, kind in detect(tape.text)}
    if dotted is not None:
        show_signs(dotted)
        found |= {(*dotted.source(a, b), "ip") for a, b, kind in detect(dotted.text) if kind == "ip" and not counted(dotted.text[a:b], text[slice(*dotted.source(a, b))])}
    return [s for s in found - known if not any(a <= s[0] and s[1] <= b for a, b in covered[s[2]])]


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each by start and then kind."""
    base = detect(text)
    return base, sorted({*base, *added(text, base)}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def hide(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named after the first."""
    out, done = [], 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every document; counts are of base spans."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    counts = [f"n_{k}" for k in KINDS]
    names = ["doc_id", *counts, "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                found = [find(t or "") for t in part.column("text").to_pylist()]
                numbers = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                more = pa.array([len(every) - len(base) for base, every in found], pa.int64())
                digests = pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *numbers, digests, pa.array([shown(every) for _, every in found], pa.string()), more], names)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, and n_chars counted anew where there is such a column. A null text stays null."""
    prepare(docs.sparkSession)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch):
                texts = [None if t is None else hide(t, find(t)[1]) for t in part.column("text").to_pylist()]
                columns = {n: c for n, c in zip(part.schema.names, part.columns)} | {"text": pa.array(texts, pa.string())}
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, schema)
