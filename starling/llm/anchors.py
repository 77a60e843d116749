"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over each whole text and reports anchors: at-signs,
schemes, plus signs and digit contacts, and words that announce an identifier.  Each
anchor starts a small deterministic parser that expands left and right to the span's
boundaries and validates it; anchors inside a span already read are skipped, so the
work is linear in the text.

Base kinds, each leftmost and non-overlapping within its kind:
  email  local part, at-sign, two or more dot-separated labels
  ip     four dot-separated numbers, each at most 255
  card   14 to 19 digits, single blanks or hyphens between, with a right Luhn sum
  phone  a plus sign and 10 to 15 digits with blanks, dots, hyphens and brackets
Added by the method:
  url      scheme://host..., host with a dot or a port, closing punctuation left out
  account  an identifier of 6 to 40 letters, digits and hyphens after a cue ("IBAN",
           "account no.", "token ="), with 6 digits at least; an IBAN needs its check sum

Defined results: a null or empty text has no spans; offsets are code points, ends
exclusive; equal texts give equal spans; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import replace_column, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
REDACTED = ("email", "ip", "card", "phone", "account")

# words that announce an identifier; each is looked for in lower, upper and capitalised form
CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn", "token",
        "api_key", "apikey", "secret")

DIGITS = frozenset("0123456789")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])*")
DIALLED = re.compile(r"[ ().0-9-]*")
REST = re.compile(r"[^\s<>\"'`{}|\\^]+")
HOST = re.compile(r"(?:[^/?#@]*@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)(:[0-9]+)?")
IDENTIFIER = re.compile(r"(?:[ _-]?(?:no|nr|number|id)\b\.?)?[ \t]*[:=#]?[ \t]*[\"']?([A-Za-z0-9])")
# an IBAN in print: country, check digits, then groups of four
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
PLAIN_ID = re.compile(r"[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*")


@functools.lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("://", ("url", 3))
    for x in "0123456789":
        a.add_word("+" + x, ("phone", 2))
        for y in "0123456789":
            a.add_word(f"{x}.{y}", ("ip", 3))
            for sep in ("", " ", "-"):
                a.add_word(x + sep + y, ("card", 2 + len(sep)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            a.add_word(form, ("account", len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    moved = s[4:] + s[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def parse_email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    m = DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def parse_ips(text: str, at: int, floor: int) -> tuple[list[tuple[int, int]], int]:
    """Spans in the dotted run around ``at``, and the run's end: parts in fours, failing ones dropped."""
    start = at
    while start > floor and text[start - 1] in DIGITS:
        start -= 1
    run = DOTTED.match(text, start)
    parts, pos = [], start
    for p in run.group().split("."):
        parts.append((pos, pos + len(p)))
        pos += len(p) + 1
    found = []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i:i + 4]
        if all(e - s <= 3 or not text[s:e - 3].strip("0") for s, e in four) \
                and all(int(text[max(s, e - 3):e]) <= 255 for s, e in four):
            found.append((four[0][0], four[3][1]))
    return found, run.end()


def parse_phone(text: str, at: int) -> tuple[int, int] | None:
    """The longest dialled run after '+d' that ends in a digit, one sign at least between."""
    m = DIALLED.match(text, at + 2)
    end = m.end()
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    return (at, end) if end - (at + 2) >= 2 else None


def parse_url(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in SCHEME:
        start -= 1
    while start < at and not (text[start].isascii() and text[start].isalpha()):
        start += 1
    rest = REST.match(text, at + 3)
    if start == at or not rest:
        return None
    end = rest.end()
    while end > at + 3 and text[end - 1] in ".,;:!?)]":
        end -= 1
    host = HOST.match(text, at + 3, end)
    return (start, end) if host and ("." in host[1] or host[2]) else None


def parse_account(text: str, begin: int, end: int) -> tuple[int, int] | None:
    """The identifier after a cue that stands at [begin, end)."""
    if (begin and (text[begin - 1].isalnum())) or (end < len(text) and text[end].isalnum()):
        return None
    m = IDENTIFIER.match(text, end)
    if not m:
        return None
    iban = IBAN.match(text, m.start(1))
    if iban and iban_ok(iban.group()):
        return iban.span()
    plain = PLAIN_ID.match(text, m.start(1), m.start(1) + 64)
    size = plain.end() - plain.start()
    digits = sum(c in DIGITS for c in plain.group())
    return plain.span() if 6 <= size <= 40 and digits >= 6 else None


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All (start, end, kind) of a text, by start, then kind in the listed order."""
    spans: list[tuple[int, int, str]] = []
    read = dict.fromkeys(KINDS, 0)      # per kind: everything before is read
    for last, (kind, length) in automaton().iter(text):
        begin = last - length + 1
        if begin < read[kind]:
            continue
        one = None
        if kind == "card":
            run = GROUPED.match(text, begin)
            read[kind] = run.end()
            digits = run.group().replace(" ", "").replace("-", "")
            one = run.span() if 14 <= len(digits) <= 19 and luhn(digits) else None
        elif kind == "email":
            one = parse_email(text, begin, read[kind])
            read[kind] = one[1] if one else begin + 1
        elif kind == "ip":
            found, read[kind] = parse_ips(text, begin, read[kind])
            spans += [(s, e, kind) for s, e in found]
        elif kind == "phone":
            one = parse_phone(text, begin)
            if one:
                read[kind] = one[1]
                if not 10 <= sum(c in DIGITS for c in text[one[0]:one[1]]) <= 15:
                    one = None
        elif kind == "url":
            one = parse_url(text, begin, read[kind])
            read[kind] = one[1] if one else last + 1
        else:
            one = parse_account(text, begin, last + 1)
            if one:
                read[kind] = one[1]
        if one:
            spans.append((*one, kind))
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def redact_text(text: str, kinds=REDACTED) -> str:
    """The text with spans of the given kinds replaced by [KIND]; overlapping ones by one mark."""
    out, at, end = [], 0, -1
    for s, e, kind in find_spans(text):
        if kind not in kinds:
            continue
        if s < end:
            end = max(end, e)
            at = end
            continue
        out += [text[at:s], f"[{kind.upper()}]"]
        at = end = e
    out.append(text[at:])
    return "".join(out)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("kind", T.StringType())]))


def detect(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key and ``spans`` (array of start, end, kind)."""
    given = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"))
    schema = T.StructType([T.StructField("k", given.schema["k"].dataType), T.StructField("spans", SPANS)])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def work(batches):
        for batch in batches:
            for piece in slices(batch, "t"):
                found = [[{"start": s, "end": e, "kind": k} for s, e, k in find_spans(t.decode("utf-8", "replace"))]
                         if t else [] for t in piece.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("k"), pa.array(found, arrow)], names=["k", "spans"])

    return given.mapInArrow(work, schema).withColumnRenamed("k", key)


def redact(df: DataFrame, text: str = "text", kinds=REDACTED) -> DataFrame:
    """The input with personal data in its text replaced; other columns pass through."""
    names = df.columns
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = f"c{[n.lower() for n in names].index(text.lower())}"

    def work(batches):
        for batch in batches:
            for piece in slices(batch, at):
                done = [redact_text(t, kinds) if t else t for t in piece.column(at).to_pylist()]
                yield replace_column(piece, at, pa.array(done, pa.string()))

    out = plain.mapInArrow(work, T.StructType([T.StructField(f.name, f.dataType, True) for f in plain.schema]))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
