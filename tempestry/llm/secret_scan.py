"""Secret scans that understand assignments.

Source and configuration text is read as statements that bind a name to literals or to
other names. Values travel through names that were bound before, and a literal is
scored by the name it ends up under and by itself. These spans are added to the plain
patterns.
"""

import hashlib
import math
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tempestry.llm.common import emit

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "lexed")

# One pass over names, literals and operators. What opens a comment ends a statement, and
# the comment is read like any other text: a secret in it is one.
_TOKEN = re.compile(
    r"""(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*)
      | (?P<quoted>"(?:[^"\\\n]|\\[\s\S])*"|'(?:[^'\\\n]|\\[\s\S])*'|`(?:[^`\\\n]|\\[\s\S])*`)
      | (?P<subscript>\[[\x20\t]*(?:"[^"\\\n]*"|'[^'\\\n]*')[\x20\t]*\])
      | (?P<heredoc><<[\-~]?[\x20\t]*(?P<q>["']?)(?P<word>[A-Za-z_][A-Za-z0-9_]*)(?P=q)[^\n]*\n)
      | (?P<block>[|>][+\-0-9]*[\x20\t]*\n)
      | (?P<bind>:=|=>|==|!=|<=|>=|=|:)
      | (?P<plus>\+|\.\.)
      | (?P<gap>[\x20\t]+|\\\r?\n)
      | (?P<line>\n)
      | (?P<open>\()
      | (?P<close>\))
      | (?P<end>[;,{}\[\]])
      | (?P<other>.)""",
    re.VERBOSE,
)
# A line that gives a name a bare value, as configuration files do.
_SETTING = re.compile(
    r"^[\x20\t]*(?:export[\x20\t]+|set[\x20\t]+)?([A-Za-z_][A-Za-z0-9_.\-]*)[\x20\t]*[=:][\x20\t]*([^\s\"'#;,]+)[\x20\t]*$",
    re.MULTILINE,
)
# A bare value that may be a name or a word is none.
_WORD = re.compile(r"[A-Za-z_][A-Za-z_.\-]*")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:\-]*)(?:\s[^<>]*)?>\s*([^<>\s](?:[^<>]*[^<>\s])?)\s*</\1\s*>")
_PAIR = re.compile(r"""\b(?:key|name)\s*=\s*["']([^"'<>\n]+)["']\s+value\s*=\s*["']([^"'<>\n]+)["']""", re.I)
#: Name parts and how much they say that the value is secret.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "pass": 3, "passphrase": 3, "secret": 3, "token": 3,
    "credential": 3, "credentials": 3, "apikey": 3, "privatekey": 3, "accesskey": 3,
    "authkey": 3, "auth": 2, "private": 2, "access": 1, "api": 1, "key": 1, "bearer": 2,
}
_HINT = re.compile(r"pass|pwd|secret|token|credential|api|key|auth|private|bearer", re.I | re.A)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def name_score(name):
    """Weight of the sensitive parts of a name such as ``dbPassword`` or ``api_key``."""
    parts = [w.lower() for w in _WORDS.findall(name)]
    score = sum(SENSITIVE.get(p, 0) for p in parts)
    return score + sum(SENSITIVE.get(a + b, 0) for a, b in zip(parts, parts[1:]))


class Value:
    """A literal of the text, or other values one after the other.

    Values are shared, so a name that holds another twice over, line after line, takes as
    much memory as its lines do; what it would read is never built.
    """

    __slots__ = ("span", "parts", "measure")

    def __init__(self, span=None, parts=()):
        self.span, self.parts, self.measure = span, parts, None


#: Lengths beyond this count as this.
_LONG = 1e15


def _measured(text, value):
    """Length, shares of the characters, and whether any is white space; kept at the value."""
    waiting = [value]
    while waiting:
        at = waiting[-1]
        if at.measure is not None:
            waiting.pop()
        elif at.span is not None:
            literal = text[slice(*at.span)]
            n = len(literal)
            at.measure = n, {c: k / n for c, k in Counter(literal).items()}, any(c.isspace() for c in literal)
        elif below := [p for p in at.parts if p.measure is None]:
            waiting += below
        else:
            known = [p.measure for p in at.parts]
            n = sum(m[0] for m in known)
            shares = Counter()
            for length, part, _ in known:
                for c, share in part.items():
                    shares[c] += share * length / n
            at.measure = min(n, _LONG), dict(shares), any(m[2] for m in known)
    return value.measure


def literal_score(length, shares, spaced):
    """How much a literal looks random: its length, its entropy and its digits."""
    if length < 8 or spaced:
        return 0.0
    entropy = -sum(p * math.log2(p) for p in shares.values() if p > 0)
    mixed = any(c.isdigit() for c in shares) + any(c.isalpha() for c in shares)
    return entropy if mixed == 2 else entropy - 1.5


#: What a literal has to score by itself, whatever its name.
FLOOR = 1.5


def _secret(text, name, value):
    weight = name_score(name)
    if weight < 2:
        return False
    score = literal_score(*_measured(text, value))
    return score >= FLOOR and weight + score >= 5.5


def _indented(text, start, line_start):
    """Where the lines from ``start`` end that are indented further than the line before them."""
    depth = len(text[line_start:start]) - len(text[line_start:start].lstrip(" \t"))
    end = start
    while end < len(text):
        stop = text.find("\n", end)
        stop = len(text) if stop < 0 else stop + 1
        line = text[end:stop]
        if line.strip() and len(line) - len(line.lstrip(" \t")) <= depth:
            break
        end = stop
    return end


def _lines(text, start, end):
    """The lines of a block as literals, without the white space around them."""
    out, at = [], start
    for line in text[start:end].splitlines(keepends=True):
        inner = line.strip()
        if inner:
            a = at + line.index(inner)
            out.append(Value((a, a + len(inner))))
        at += len(line)
    return out


def bindings(text):
    """``(name, Value)`` of the statements, names replaced by what they stand for.

    A value is a sequence of literals and known names joined by ``+`` or standing side by
    side, over lines after a ``+``, a backslash or inside a bracket. Subscripts and quoted
    keys are names, as are those with a type before the ``=``. Each line of an indented
    block or a here-document is bound by itself.
    """
    known, out = {}, []
    name = bound = typed = None
    parts, inside, joined, at = [], False, False, 0

    def close():
        nonlocal name, bound, typed, parts, inside
        if bound is not None and parts:
            value = parts[0] if len(parts) == 1 else Value(parts=tuple(parts))
            known[bound] = value
            out.append((bound, value))
        name, bound, typed, parts, inside = None, None, None, [], False

    while at < len(text) and (m := _TOKEN.match(text, at)):
        kind, at = m.lastgroup, m.end()
        if kind in ("q", "word"):
            kind = "heredoc"
        if kind == "gap" or (kind == "line" and (inside or joined)):
            continue
        joined = kind == "plus" and bound is not None
        if kind == "open" and bound is not None and not parts:
            inside = True
        elif kind == "bind":
            if m.group() in ("=", ":", ":=", "=>") and name is not None and not parts and bound is None:
                bound = typed if typed is not None and m.group() == "=" else name
                typed = bound if m.group() == ":" else None
            else:
                close()
        elif kind == "quoted":
            inner = (m.start() + 1, m.end() - 1)
            if bound is None:
                name = text[slice(*inner)]  # a quoted key
            else:
                parts.append(Value(inner))
        elif kind == "subscript" and bound is None:
            name = m.group().strip("[] \t")[1:-1]
        elif kind in ("block", "heredoc") and bound is not None and not parts:
            if kind == "block":
                end = _indented(text, at, text.rfind("\n", 0, m.start()) + 1)
            else:
                stop = re.compile(rf"^[\x20\t]*{m.group('word')}\b", re.MULTILINE).search(text, at)
                end = stop.start() if stop else at
            out += [(bound, line) for line in _lines(text, at, end)]
            at = max(at, end)
            close()
        elif kind == "plus":
            pass
        elif kind != "name":
            close()
        elif bound is None:
            name = m.group()
        elif m.group() in known:
            parts.append(known[m.group()])
        elif parts:
            close()  # prose goes on after a literal
            name = m.group()
        else:
            name, bound = m.group(), None  # maybe a type
    close()
    for m in (*_ELEMENT.finditer(text), *_PAIR.finditer(text)):
        out.append((m.group(1), Value(m.span(2))))
    for m in _SETTING.finditer(text):
        if not _WORD.fullmatch(m.group(2)):
            out.append((m.group(1), Value(m.span(2))))
    return out


def base_spans(text):
    """Spans of the plain patterns, ``(start, kind, end)``."""
    out = []
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        out += [
            (m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6
        ]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def lexed_spans(text, found):
    """Literals bound to sensitive names that no span of ``found`` holds already."""
    if not _HINT.search(text) or not ("=" in text or ":" in text or "</" in text):
        return []
    waiting = [value for name, value in bindings(text) if _secret(text, name, value)]
    seen, spans = set(), set()
    while waiting:
        value = waiting.pop()
        if id(value) in seen:
            continue
        seen.add(id(value))
        if value.span is None:
            waiting += value.parts
        elif value.span[0] < value.span[1]:
            spans.add(value.span)
    return sorted(
        (a, 3, b) for a, b in spans if not any(x <= a and b <= y for x, _, y in found)
    )


def scan(text):
    """All spans of a text and those of the plain patterns."""
    base = base_spans(text)
    return sorted(base + lexed_spans(text, base)), base


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_COUNTS = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64())]
_FOUND = pa.schema([*_COUNTS, ("base_sha256", pa.string()), ("spans", pa.string())])


def find_secrets(docs: DataFrame, key="doc_id") -> DataFrame:
    """One row per document: its key, counts of the base kinds, base_sha256, spans.

    Offsets are code points, ends exclusive; spans are listed by start, then kind, as
    ``kind:start:end``. A null or empty text has no span, and the digest of nothing.
    Null and repeated keys are rows like any other, other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()

    def find(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                spans, base = scan(text or "")
                kinds = Counter(k for _, k, _ in base)
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((kinds[0], kinds[1], kinds[2], digest, listed(spans)))
            columns = zip(*rows) if rows else ((),) * 5
            out = emit(_FOUND, **dict(zip(_FOUND.names, columns)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], names=[key, *_FOUND.names])

    return docs.select(key, "text").mapInArrow(
        find,
        f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def redact(text, mark="[secret]"):
    """The text with every span replaced by ``mark``; overlapping spans become one."""
    out, at = [], 0
    for a, _, b in scan(text)[0]:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def without_secrets(docs: DataFrame, mark="[secret]") -> DataFrame:
    """All rows of ``docs``, columns as given, secrets in ``text`` replaced by ``mark``.

    ``n_chars``, where there is such a column, follows the new text. A null text stays
    null.
    """

    @pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redact(t, mark))

    columns = docs.columns
    out = docs.withColumn("__clean", clean("text"))
    if "n_chars" in columns:
        changed = ~F.col("__clean").eqNullSafe(F.col("text"))
        length = F.length("__clean").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__clean")).select(*columns)
