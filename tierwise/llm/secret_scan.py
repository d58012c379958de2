"""Secrets in source, configuration and prose, by assignment-aware lexing.

Three base patterns are matched as they stand (``assign``, ``access``,
``hex``).  Beside them each text is lexed into name-literal pairs: every
``=``, ``:``, ``:=`` or ``=>`` with a name of any length before it and a string
(also in triple quotes, or added up of several), a block of indented lines
(``password: |``), the strings handed to a call, a bare word
or another name behind it, ``--flag value`` pairs, ``<name>literal</name>``
elements, and the password of ``scheme://user:password@host``.  Literals
assigned to a name are its constants; a name assigned to another name takes all
of that one's constants, so that ``k = "..."; db_password = k`` is found at the
literal, in any order, over any number of names and assignments.  An unquoted word without digits
that no name leads on from is a literal if it does not look like words, or is
all that follows ``NAME=`` on a line of its own.  Placeholders are whole known
phrases; a literal with blanks is a sentence unless most of it is no words.
A literal's score is the weight of the most telling word in the names it reaches times how
random it looks; from :data:`THRESHOLD` on it is reported as ``literal``.

Rows are scanned independently in Arrow batches; nothing is shuffled.

Defined cases: null and empty texts have no spans; long texts are scanned
whole; equal rows give equal results; an empty table gives an empty result; other
columns, whatever their names, are ignored; offsets are code points, end
exclusive; a literal added up of several strings is one span from the first to
the last.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5
MIN_LITERAL = 8

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

# Words in names that announce a secret, and their weight.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "passcode": 0.9, "secret": 1.0,
             "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0,
             "accesskey": 1.0, "auth": 0.7, "bearer": 0.8, "pass": 0.7, "key": 0.6}
# Literals that stand for a secret.
_PHRASE = (r"(?:(?:your|my|the|example|sample|dummy|default|test)[-_. ]?){1,3}"
           r"(?:(?:own|super|db|database|api|app|user|admin|secret|access|private|client|auth|service|new|old)[-_. ]?){0,3}"
           r"(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|key|credentials?|value|string|name|account|domain|host|server)?"
           r"(?:[-_. ]?(?:goes[-_. ]?)?here)?(?:\.(?:com|org|net))?\d{0,3}")
PLACEHOLDERS = re.compile(rf"(?i)^(change[-_]?me|{_PHRASE}|placeholder|none|null|true|false|undefined|"
                          r"redacted|x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|os\.environ.*|process\.env.*)$")

_OPERATOR = re.compile(r":=|=>|[=:]")
_STRING = r"""(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+')"""
_TRIPLE = re.compile(r"""[ \t]*(?:[bruf]{0,2}\"\"\"(.*?)(?:\"\"\"|\Z)|[bruf]{0,2}\'\'\'(.*?)(?:\'\'\'|\Z))""", re.S | re.I)
_ADDED = re.compile(rf"""[ \t]*({_STRING})((?:\s*(?:\+|\.\.?|\\\n)\s*{_STRING})+)""", re.A)
_BLOCK = re.compile(r"[ \t]*[|>][+-]?\d?[+-]?[ \t]*\n")
_CALL = re.compile(rf"""[ \t]*[A-Za-z_$][\w$.:]*[ \t]*\(((?:[^()"'\n]|{_STRING}|\([^()\n]*\))*+)\)""", re.A)
_VALUE = re.compile(r"""[ \t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|([A-Za-z_$][\w$.]*)(?=[ \t]*(?:[;,)}\n]|$))|([^\s"'`,;(){}<>]+))""", re.A)
_STRINGS = re.compile(_STRING)
_FLAG = re.compile(r"""(?<!\S)--?([A-Za-z][\w-]*)[ \t]+(?!-)["']?([^\s"']+)""", re.A)
_ELEMENT = re.compile(r"<([A-Za-z][\w.:-]*)>([^<>\n]+)</\1>", re.A)
_USERINFO = re.compile(r"://[^\s:/@]*:([^\s/@]+)@", re.A)
_PLAIN_LINE = re.compile(r"(?:export[ \t]+)?\Z", re.A)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def name_weight(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)


def word_like(text: str) -> bool:
    """Made up of words or numbers as identifiers and sentences are: parts of
    three characters on average, long ones with some vowels, no digit within."""
    text = text.strip(".,;:!?()[]\"'")
    parts = _PARTS.findall(text)
    if not parts:
        return True
    if re.search(r"\d[A-Za-z]|[A-Za-z]\d+[A-Za-z]", text):
        return False
    letters = [p.lower() for p in parts if not p.isdigit()]
    if len(letters) > 1 and sum(map(len, letters)) < 3 * len(letters):
        return False
    return all(5 * sum(c in "aeiouy" for c in p) >= len(p) for p in letters if len(p) > 4)


def randomness(literal: str) -> float:
    """0 to 1: entropy per character, against that of random base64."""
    if len(literal) < MIN_LITERAL or PLACEHOLDERS.match(literal):
        return 0.0
    if re.search(r"\s", literal):  # a sentence, unless most of it is no words
        parts = literal.split()
        literal = "".join(parts)
        if 2 * sum(len(p) for p in parts if not word_like(p)) <= len(literal) or len(literal) < MIN_LITERAL:
            return 0.0
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in Counter(literal).values())
    kinds = sum(bool(re.search(p, literal)) for p in (r"[a-z]", r"[A-Z]", r"\d", r"[^A-Za-z0-9]"))
    return min(1.0, bits / 3.5) * (0.5 if kinds == 1 else 1.0)


_NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_$.-")


def name_before(text: str, end: int) -> tuple[str, int, int] | None:
    """The name that ends before ``end`` (blanks and up to two quotes or
    brackets between), with its place."""
    while end > 0 and text[end - 1] in " \t":
        end -= 1
    for _ in range(2):
        if end > 0 and text[end - 1] in "\"'`]":
            end -= 1
    start = end
    while start > 0 and text[start - 1] in _NAME_CHARS:
        start -= 1
    while start < end and not (text[start].isalpha() or text[start] in "_$"):
        start += 1
    return (text[start:end], start, end) if start < end else None


def _bare_literal(text: str, name: tuple[str, int, int], value: re.Match) -> bool:
    """Whether an unquoted word without digits may be a literal: no reference
    by its looks, or all that follows ``NAME=`` on a line of its own."""
    word = value[4]
    if word.startswith("$"):
        return False
    if not word_like(word):
        return True
    start = text.rfind("\n", 0, name[1]) + 1
    end = text.find("\n", value.end())
    return (not re.search(r"[.$]", word) and _PLAIN_LINE.match(text[start:name[1]]) is not None
            and text[name[2]:value.start(4)] == "=" and not text[value.end():end if end >= 0 else len(text)].strip())


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    body = text[start:end]
    return start + len(body) - len(body.lstrip()), end - len(body) + len(body.rstrip())


def _indented(text: str, key: int, start: int) -> tuple[int, int]:
    """The lines from ``start`` that are indented deeper than the line of
    ``key``."""
    depth = lambda a, b: len(text[a:b]) - len(text[a:b].lstrip(" \t"))
    line = text.rfind("\n", 0, key) + 1
    own, end = depth(line, key), start
    while end < len(text):
        stop = text.find("\n", end)
        stop = len(text) if stop < 0 else stop
        if text[end:stop].strip() and depth(end, stop) <= own:
            break
        end = stop + 1
    return _trimmed(text, start, min(end, len(text)))


def _literals(text: str, operator: str, name: tuple[str, int, int], at: int) -> list[tuple[tuple[int, int], str]] | None:
    """Literals, as (span, content), that the value at ``at`` spells out beyond
    a plain string or word; None if it is one of those."""
    if m := _TRIPLE.match(text, at):
        span = _trimmed(text, *m.span(m.lastindex))
        return [(span, text[slice(*span)])]
    if operator == ":" and (m := _BLOCK.match(text, at)):
        span = _indented(text, name[1], m.end())
        return [(span, "".join(text[slice(*span)].split()))] if span[0] < span[1] else []
    if m := _ADDED.match(text, at):
        parts = [s.span() for s in _STRINGS.finditer(text, m.start(1), m.end())]
        return [((parts[0][0] + 1, parts[-1][1] - 1), "".join(text[a + 1:b - 1] for a, b in parts))]
    if m := _CALL.match(text, at):
        found = [(s.start() + 1, s.end() - 1) for s in _STRINGS.finditer(text, m.start(1), m.end(1))]
        # Names handed to the call (of a variable, a file) read as words.
        return [((a, b), text[a:b]) for a, b in found if not word_like(text[a:b])]
    return None


def literal_spans(text: str) -> list[tuple[int, int, float, str]]:
    """(start, end, score, name) of the literals that reach a telling name."""
    if "=" not in text and ":" not in text and "--" not in text and "</" not in text:
        return []
    # What names are assigned: literals, and words that may be other names.
    constants: dict[str, list[tuple[tuple[int, int], str]]] = {}
    words: list[tuple[str, str, tuple[int, int], bool]] = []
    for m in _OPERATOR.finditer(text):
        if text[m.end():m.end() + 1] in ("=", ":") or text[m.end():m.end() + 2] == "//" or text[m.start() - 1:m.start()] in ("=", ":", "!", "<", ">"):
            continue
        name = name_before(text, m.start())
        if not name:
            continue
        found = _literals(text, m[0], name, m.end())
        if found is not None:
            constants.setdefault(name[0], []).extend(found)
            continue
        value = _VALUE.match(text, m.end())
        if not value:
            continue
        k = value.lastindex
        if k == 4:
            bare = bool(re.search(r"\d", value[4])) or _bare_literal(text, name, value)
            words.append((name[0], value[4], value.span(4), bare))
        else:
            constants.setdefault(name[0], []).append((value.span(k), value[k]))
    named = set(constants) | {name for name, *_ in words}
    leads: dict[str, list[str]] = {}
    for name, word, span, bare in words:
        if word in named:
            leads.setdefault(name, []).append(word)
        elif bare:
            constants.setdefault(name, []).append((span, word))

    best: dict[tuple[int, int], tuple[float, str]] = {}

    def reach(name: str, weight: float, span: tuple[int, int], literal: str) -> None:
        score = weight * randomness(literal)
        if score > best.get(span, (0.0, ""))[0]:
            best[span] = score, name

    # From the most telling names on: every name is visited once, by the most
    # telling one that leads to it.
    seen: set[str] = set()
    for weight, origin in sorted(((name_weight(n), n) for n in named), key=lambda x: (-x[0], x[1])):
        if not weight:
            break
        open_ = [origin]
        while open_:
            name = open_.pop()
            if name in seen:
                continue
            seen.add(name)
            for span, literal in constants.get(name, ()):
                reach(origin, weight, span, literal)
            open_ += leads.get(name, ())
    for pattern in (_FLAG, _ELEMENT):
        for m in pattern.finditer(text):
            reach(m[1], name_weight(m[1]), m.span(2), m[2])
    for m in _USERINFO.finditer(text):
        reach("password", name_weight("password"), m.span(1), m[1])
    return [(*span, score, name) for span, (score, name) in best.items() if score >= THRESHOLD]


_SPANS = "array<struct<start:bigint,end:bigint,kind:int,name:string,score:double>>"


def _scan(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()),
                               ("name", pa.string()), ("score", pa.float64())]))
    for batch in batches:
        out = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            spans = [(s, e, KINDS.index(k), None, None) for k, s, e in base_spans(text)]
            spans += [(s, e, 3, n, x) for s, e, x, n in literal_spans(text)]
            out.append([dict(zip(("start", "end", "kind", "name", "score"), x)) for x in sorted(spans, key=lambda x: x[:3])])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], names=["doc_id", "spans"])


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: array of (start, end, kind: index into
    :data:`KINDS`, name, score), by start, then kind."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_scan, f"doc_id long, spans {_SPANS}"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and text forms of the spans of :func:`secrets`."""
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
