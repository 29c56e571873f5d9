"""Personal data in plain and in disguised form.

Two layers look for e-mail and IP addresses, card and phone numbers:

* The plain forms, in the text as it stands: leftmost, non-overlapping matches
  per kind.  IP parts are at most 255, a card has 12 to 19 digits that pass the
  Luhn test, a phone number has 9 to 15 digits; a match that fails is dropped
  and not tried again in another length.
* Three transducers rewrite the text, one after the other: look-alike and
  invisible characters (letters of other scripts, full-width and styled forms,
  foreign digits, O and l among digits), digits spelled as words, and the
  ``at``/``dot`` disguises of addresses.  Each writes segments that know the
  characters they come from, so a match in the last text is traced back through
  all of them to code points of the source.  Only matches that touch a
  rewritten segment are new, and one that meets a plain span of its kind is not
  added: plain spans always stay.

Every scan is linear in the text, whose length is not limited.
"""

from __future__ import annotations

import bisect
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import two

# The kinds, in the order that breaks ties, and the forms of each.
KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGITS_AND_DOTS = re.compile(r"[0-9][0-9.]++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Every '@' ends at most one run of local characters, so each is looked at once."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL_CHARS))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        low = m.end() if m else at + 1
        at = text.find("@", low)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    out = []
    for run in DIGITS_AND_DOTS.finditer(text):
        if run.group().count(".") < 3:
            continue
        for m in IP.finditer(text, run.start(), run.end()):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append(m.span())
    return out


def luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(d) if i % 2 == 0 else int(doubled[int(d)])
               for i, d in enumerate(reversed(digits))) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):  # a run of fewer digits is no card; a longer one is one match
        digits = NOT_DIGIT.sub("", m.group())
        if len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text)
            if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15]


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    return sorted((a, k, b) for k, kind in enumerate(KINDS) for a, b in FINDERS[kind](text))


# --- transducers -------------------------------------------------------------

class Rewritten:
    """A text written from another one: unchanged stretches and replacements.

    ``edits``: (start, end, replacement) in the source, in order, apart."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        pieces, self.out, self.src, self.changed, at, n = [], [], [], [], 0, 0
        for start, end, new in edits:
            for a, b, s, changed in ((at, start, source[at:start], False), (start, end, new, True)):
                if s or changed:
                    self.out.append(n)
                    self.src.append((a, b))
                    self.changed.append(changed)
                    pieces.append(s)
                    n += len(s)
            at = end
        if at < len(source):
            self.out.append(n)
            self.src.append((at, len(source)))
            self.changed.append(False)
            pieces.append(source[at:])
        self.text = "".join(pieces)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """The span of the source that wrote [start, end), and whether a
        replacement took part in it.  Characters deleted at its edges stay out."""
        i = bisect.bisect_right(self.out, start) - 1
        j = bisect.bisect_left(self.out, end) - 1
        first, last = self.src[i], self.src[j]
        a = first[0] if self.changed[i] else first[0] + start - self.out[i]
        b = last[1] if self.changed[j] else last[0] + end - self.out[j]
        return a, b, any(self.changed[i:j + 1])


# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТХУаеіјорсухѕԁһԛԝӏ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονικρυα",
    "ABESIJKMHOPCTXYaeijopcyxsdhqwl" "ABEZHIKMNOPTYXovikpua"))
# Signs that stand for the ASCII ones of the forms above.
SIGNS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "•": ".", "·": ".", "․": ".",
         "。": ".", "｡": ".", "∙": "."}
# Characters that are not seen.
UNSEEN = "­​‌‍‎‏⁠﻿"
FORM_CHARS = frozenset(LOCAL_CHARS + "@ ()")


def _plain_char(code: int) -> str | None:
    """The ASCII character of the forms that a compatibility form or a foreign digit stands for."""
    c = chr(code)
    n = unicodedata.normalize("NFKC", c)
    if len(n) == 1 and n in FORM_CHARS:
        return n
    d = unicodedata.decimal(c, None)
    return None if d is None else str(d)


#: Every character that the first transducer rewrites.
CHARS = ({c: p for c in range(0x80, 0x20000) if (p := _plain_char(c)) is not None}
         | {ord(a): b for a, b in (LOOK_ALIKES | SIGNS).items()} | {ord(c): "" for c in UNSEEN})
_ODD = re.compile("[" + "".join(map(re.escape, map(chr, sorted(CHARS)))) + "]")
_TOKEN = re.compile(r"\S+")
# O and l among digits: a stretch of digits, such letters and the signs of numbers.
_AMONG_DIGITS = re.compile(r"(?<![A-Za-z0-9])[+(]{0,2}[0-9OolI](?:[().-]{0,2}[0-9OolI])*+(?![A-Za-z0-9@])")
_LETTERS_AS_DIGITS = str.maketrans("OolI", "0011")
_MIXED = re.compile(r"[0-9][().-]{0,2}[OolI]|[OolI][().-]{0,2}[0-9]")


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    """Edits to ASCII.  Letters change only in tokens that are ASCII afterwards:
    a word that is really written in another script stays."""
    edits, seen = [], 0
    for odd in _ODD.finditer(text):
        if odd.start() < seen:
            continue
        if odd.group().isspace() or odd.group() in UNSEEN:
            edits.append((odd.start(), odd.end(), CHARS[ord(odd.group())]))
            continue
        # the token that holds it: back to a space, on to the next one
        start = odd.start()
        while start > seen and not text[start - 1].isspace():
            start -= 1
        end = _TOKEN.match(text, odd.start()).end()
        token = text[start:end]
        whole = token.translate(CHARS).isascii()
        for i, c in enumerate(token, start):
            if i >= seen and ord(c) in CHARS and (whole or not c.isalpha()):
                if not edits or edits[-1][0] < i:
                    edits.append((i, i + 1, CHARS[ord(c)]))
        seen = end
    return edits


def letters_among_digits(text: str) -> list[tuple[int, int, str]]:
    return [(m.start() + i, m.start() + i + 1, c.translate(_LETTERS_AS_DIGITS))
            for m in _AMONG_DIGITS.finditer(text) if _MIXED.search(m.group())
            for i, c in enumerate(m.group()) if c in "OolI"]


# The digits' names in the languages of the texts, and words that go with them.
DIGIT_WORDS = {word: digit for line in (
    "zero one two three four five six seven eight nine", "oh",
    "null eins zwei drei vier fünf sechs sieben acht neun", "null ein zwo",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve")
    for digit, word in zip("0123456789", line.split())}
REPEATS = {"double": 2, "triple": 3}
SIGN_WORDS = {"plus": "+", "mas": "+", "más": "+"}
POINT_WORDS = ("dot", "point", "punkt", "punto")
#: Spaces inside a disguise: few, so that no long run of spaces is read again and again.
_GAP = "[ ]{0,8}"
_ONE = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_ITEM = rf"(?:(?:{'|'.join(REPEATS)})[ -][ -]{{0,8}})?(?:{_ONE}|[0-9]++)"
#: Spelled numbers: items with spaces, hyphens or commas between; points only between items.
_SPELLED = re.compile(
    rf"(?<!\w)(?:(?:{'|'.join(SIGN_WORDS)})[ ]{_GAP})?{_ITEM}"
    rf"(?:(?:{_GAP}[,-]{_GAP}|[ ]{_GAP}(?:(?:{'|'.join(POINT_WORDS)})[ ]{_GAP})?)"
    rf"{_ITEM})++(?!\w)", re.I)
_WORD_OR_NUMBER = re.compile(r"\w+")
_ANY_DIGIT_WORD = re.compile(
    rf"(?<!\w)(?:{_ONE})[ ,-][ ,-]{{0,8}}(?:{'|'.join(REPEATS)}|{'|'.join(POINT_WORDS)}|{_ONE}|[0-9])", re.I)


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of spelled digits become digits, one replacement per item and gap.
    A run must spell at least four digits: shorter ones are prose."""
    edits = []
    if not _ANY_DIGIT_WORD.search(text):
        return edits
    for m in _SPELLED.finditer(text):
        run, at, times, spelled = [], m.start(), 1, 0
        for w in _WORD_OR_NUMBER.finditer(text, m.start(), m.end()):
            word = w.group().lower()
            if word in REPEATS:
                times = REPEATS[word]
                continue
            if word in SIGN_WORDS:
                new = SIGN_WORDS[word]
            elif word in POINT_WORDS:
                new = "."
            elif word in DIGIT_WORDS:
                new, spelled = DIGIT_WORDS[word] * times, spelled + times
            else:
                new = word * times
            if new != text[at:w.end()]:
                run.append((at, w.end(), new))
            at, times = w.end(), 1
        if spelled >= 4:
            edits += run
    return edits


# How '@' and '.' are written out, and endings of domains that a
# disguise without brackets must have (with brackets any label ends a domain).
AT_WORDS, DOT_WORDS = ("at", "arroba", "arobase", "klammeraffe"), ("dot", "punkt", "point", "punto")
ENDINGS = frozenset("com org net edu gov mil int info biz io co ai app dev me tv eu de fr es uk us ch at "
                    "it nl be se no dk fi pl pt ie ca au nz jp cn in br mx ru".split())
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"


def _sign(sign: str, words: tuple[str, ...]) -> str:
    w = "|".join(words)
    return (rf"(?:{_GAP}{_OPEN}{_GAP}(?:{w}|{re.escape(sign)}){_GAP}{_CLOSE}{_GAP}"
            rf"|[ ]{_GAP}(?:{w})[ ]{_GAP}|{_GAP}[_*](?:{w})[_*]{_GAP})")


_AT = re.compile(_sign("@", AT_WORDS) + rf"|[ ]{_GAP}@{_GAP}|@[ ]{_GAP}", re.I)
_AT_HINT = re.compile(rf"(?:{'|'.join(AT_WORDS)})|@[ ]|[ ]@|{_OPEN}[ ]*@", re.I)
_DOT = re.compile(_sign(".", DOT_WORDS) + r"|\.", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]++")


def _bracketed(sign: str) -> bool:
    return any(c in sign for c in "[({<_*")


def at_and_dot(text: str) -> list[tuple[int, int, str]]:
    """Edits of written-out '@' and '.' that lie in an address: a local part, a
    sign, labels with dots between.  A bare word ``at``, or an '@' with spaces,
    counts only where some dot is written out too or the address is bracketed,
    and only before a common ending, so that prose with "at" stays."""
    edits, done = [], 0
    if not _AT_HINT.search(text):
        return edits
    for m in _AT.finditer(text):
        if m.start() <= done or text[m.start() - 1] not in LOCAL_CHARS:
            continue
        label = _LABEL.match(text, m.end())
        dots, last = [], None
        while label:
            last = label
            dot = _DOT.match(text, label.end())
            label = _LABEL.match(text, dot.end()) if dot else None
            if label:
                dots.append(dot)
        if not dots:
            continue
        bare = not _bracketed(m.group())
        written = [d for d in dots if d.group() != "."]
        if bare:
            if not written or last.group().lower() not in ENDINGS:
                # a shorter address may still end in a common ending
                while dots and (last.group().lower() not in ENDINGS or not written):
                    last = _ending_before(text, dots)
                    dots.pop()
                    written = [d for d in dots if d.group() != "."]
                    if last is None:
                        break
                if not dots or not written or last is None:
                    continue
        else:
            # bare dot words after a bracketed sign may be prose: keep up to a common ending
            while dots and dots[-1].group() != "." and not _bracketed(dots[-1].group()) \
                    and last.group().lower() not in ENDINGS:
                last = _ending_before(text, dots)
                dots.pop()
            if not dots:
                continue
        edits += _local_dots(text, done, m.start())
        edits.append((m.start(), m.end(), "@"))
        edits += [(d.start(), d.end(), ".") for d in written if d in dots]
        done = last.end()
    return edits


def _ending_before(text, dots):
    """The label that ends before the last of ``dots``."""
    start = dots[-2].end() if len(dots) > 1 else None
    return _LABEL.match(text, start) if start is not None else None


#: Characters that a written-out dot takes at most.
_DOT_CHARS = 48
_DOT_BEFORE = re.compile(_sign(".", DOT_WORDS) + r"$", re.I)


def _local_dots(text: str, low: int, end: int) -> list[tuple[int, int, str]]:
    """Written-out dots inside a local part that ends at ``end``: "jo dot doe at ..."."""
    out = []
    while True:
        start = end
        while start > low and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = _DOT_BEFORE.search(text, max(low, start - _DOT_CHARS), start) if start < end else None
        if not m or m.start() <= low or text[m.start() - 1] not in LOCAL_CHARS:
            return out[::-1]
        out.append((m.start(), m.end(), "."))
        end = m.start()


#: The transducers, in the order in which they read each other's text.
TRANSDUCERS = (look_alikes, letters_among_digits, spelled_digits, at_and_dot)


def disguised_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, plain form) of what only the rewritten text shows."""
    steps = []
    for transducer in TRANSDUCERS:
        now = steps[-1].text if steps else text
        edits = transducer(now)
        if edits:
            steps.append(Rewritten(now, edits))
    out = []
    if steps:
        last = steps[-1].text
        for a, k, b in plain_spans(last):
            start, end, touched = a, b, False
            for step in reversed(steps):
                start, end, changed = step.back(start, end)
                touched |= changed
            if touched:
                out.append((start, k, end, last[a:b]))
    return out


def all_spans(text: str) -> list[tuple[int, int, int, str, bool]]:
    """(start, kind number, end, plain form, whether it is plain), sorted by start and kind."""
    plain = plain_spans(text)
    ends = [[(a, b) for a, k, b in plain if k == kind] for kind in range(len(KINDS))]
    found = [(a, k, b, text[a:b], True) for a, k, b in plain]
    for a, k, b, form in disguised_spans(text):
        i = bisect.bisect_left(ends[k], (b,)) - 1  # the last plain span that starts before b
        if i < 0 or ends[k][i][1] <= a:
            found.append((a, k, b, form, False))
    return sorted(found)


# --- which texts need a closer look -------------------------------------------
# Arrow's regular expressions are automata: one fast pass each over a whole batch.
# Each says yes to every text in which the scan that it stands for could find
# something.

_W = "|".join(AT_WORDS)
_WRITTEN_DOT = (rf" {{0,8}}{_OPEN} {{0,8}}(?:{'|'.join(DOT_WORDS)}|\.)|[ _*] {{0,8}}(?:{'|'.join(DOT_WORDS)})[ _*]")
HINTS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": "(?:[0-9][ -]?){11}[0-9]",
         "phone": r"\+[0-9]"}
DISGUISE_HINTS = (
    "[" + "".join(f"\\x{{{c:x}}}" for c in sorted(CHARS)) + "]",
    r"[0-9][().-]{0,2}[OolI]|[OolI][().-]{0,2}[0-9]",
    rf"(?i)(?:{_ONE})[ ,-]{{1,17}}(?:{'|'.join(REPEATS)}|{'|'.join(POINT_WORDS)}|{_ONE}|[0-9])"
    rf"[ ,-]{{1,17}}(?:{'|'.join(REPEATS)}|{'|'.join(POINT_WORDS)}|{_ONE}|[0-9])",
    rf"(?i)(?:{_OPEN}|[_*]) {{0,8}}(?:{_W}|@) {{0,8}}(?:{_CLOSE}|[_*])|@ | @"
    rf"| (?:{_W}) {{1,9}}[a-z0-9-]+(?:\.[a-z0-9-]+)*(?:{_WRITTEN_DOT})",
)


def spans_of(texts: pa.Array) -> list[list[tuple[int, int, int, str, bool]]]:
    """:func:`all_spans` of every text of an Arrow array."""
    look = {k: pc.match_substring_regex(texts, p).to_pylist() for k, p in HINTS.items()}
    odd = [any(x) for x in zip(*(pc.match_substring_regex(texts, p).to_pylist() for p in DISGUISE_HINTS))]
    out: list[list] = [[] for _ in odd]
    for i in sorted({i for flags in (*look.values(), odd) for i, f in enumerate(flags) if f}):
        text = texts[i].as_py()
        if odd[i]:
            out[i] = all_spans(text)
        else:
            out[i] = sorted((a, k, b, text[a:b], True) for k, kind in enumerate(KINDS) if look[kind][i]
                            for a, b in FINDERS[kind](text))
    return out


SPAN = "struct<kind: string, start: bigint, end: bigint, form: string, plain: boolean>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("form", pa.string()), ("plain", pa.bool_())]))


def find_identifiers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, spans) for every row: its identifiers by start, then kind
    (e-mail, IP, card, phone), in code points of the text as given, ends exclusive.

    ``form`` is the identifier in plain writing, ``plain`` says whether it stood
    so in the text.  NULL and empty texts have an empty list; texts may have any
    length; repeated rows and NULL ids stay as they are; no rows give no rows;
    only the two columns are read, whatever else is there.  One pass, no shuffle."""
    rows = two(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": e, "form": form, "plain": plain}
                      for a, k, e, form, plain in found] for found in spans_of(b.column("_text"))]
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(spans, _ARROW_SPAN)], names=["_id", "spans"])

    found = rows.mapInArrow(run, f"_id long, spans array<{SPAN}>")
    return found.withColumnRenamed("_id", id_col)


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind and the digest of the plain spans, all spans as text, and
    how many were disguised, from the rows of :func:`find_identifiers`."""
    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)))

    def of_kind(kind):
        return F.size(F.filter(plain, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    plain = F.filter("spans", lambda s: s.plain)
    counts = [of_kind(kind) for kind in KINDS]
    return found.select(id_col, *counts, F.sha2(written(plain), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s.plain)).cast("long").alias("n_disguised"))
