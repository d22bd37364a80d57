"""Operator 2: assignment-aware secret scan of whole texts.

Base kinds (regular expressions, leftmost and non-overlapping per kind; ASCII case folding only): ``assign``,
``access``, ``hex``. The method adds kind ``literal``: a lexer reads source and configuration syntax
(``name = "literal"``, ``name: literal``, ``name => ...``, ``name=literal``, ``"name": "literal"``,
``export NAME=literal``, ``<name>literal</name>``, ``--name literal``) into name-literal pairs, propagates constants
(``a = "..."`` then ``password = a``, and ``+`` of literals and known names, over line ends too), and scores each value by
how sensitive its target name is and by how random the value looks. The literals of a value that reaches the threshold
are spans of their own text, unless a base span covers them. A password inside a URL (``//user:password@``) counts as a
pair with the name ``password``. A constant is kept as references to its parts with sums over its characters, so a value
joined from any number of literals, of any length, is judged whole.

Spans are code points, end exclusive. The text is scanned where it lies: no shuffle, memory bounded by one batch.
Only lines with an assignment mark next to a name or literal are lexed.

Defined results: null and empty texts have no spans and the hash of the empty text; repeated rows give repeated
results; a null doc_id stays null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import documents, ship, slices, text_column

#: The base patterns, the least length of what must be long enough, and the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "literal")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: Weight of each part of a target name; a name scores the largest weight of its parts, 0 if none is listed.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "secrets": 0.9, "token": 0.9, "tokens": 0.7, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.6, "authorization": 0.7, "bearer": 0.8, "signature": 0.5, "salt": 0.5, "private": 0.6, "key": 0.5, "access": 0.4, "client": 0.2, "session": 0.5, "cookie": 0.4, "dsn": 0.6, "conn": 0.3, "connection": 0.3,
}
#: Sum of a pair's name score and literal score from which the literal is a finding.
THRESHOLD = 1.4
LEAST_LITERAL = 6
#: Texts of literals that are no secrets.
_DUMMY = re.compile(r"(?i)(?:x+|\*+|\.+|changeme|example|placeholder|password|secret|none|null|true|false|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)")
_MARK = re.compile(r"""[A-Za-z0-9_\])"']\x20*(?:=>|:=|=|:)[\x20\n]*["'`A-Za-z0-9/+$_]|--[A-Za-z]|</""")
_HINT = re.compile(r"[=:]|--[A-Za-z]|</")
_TOKEN = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)|(?P<tag><(?P<tagname>[A-Za-z_][\w.-]*)>(?P<tagtext>[^<\n]+)</)|(?P<flag>--(?P<flagname>[A-Za-z][\w-]*))|(?P<name>[A-Za-z_][\w.-]*)|(?P<op>=>|:=|==|!=|<=|>=|=|:|\+)|(?P<bare>[A-Za-z0-9+/][A-Za-z0-9+/_.=-]*)|(?P<other>\S)""",
    re.ASCII,
)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_VALUE = re.compile(r"[A-Za-z0-9+/_.=~!@#$%^&*-]+")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
#: The end of a line that goes on: an assignment mark or a plus after a name or literal.
_OPEN = re.compile(r"""[A-Za-z0-9_"'`]\x20*(?:=>|:=|=|\+|\+\x20*\\)\x20*$""")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\s/:@]+:([^\s/@]+)@")


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    score = max((NAME_WEIGHTS.get(p, 0.0) for p in parts), default=0.0)
    pairs = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    if pairs & {"apikey", "privatekey", "accesskey", "secretkey", "authtoken", "clientsecret", "signingkey", "encryptionkey"}:
        score = 1.0
    return score


class Value:
    """A literal, or literals joined: its parts, and sums over its characters."""

    __slots__ = ("place", "parts", "n", "counts", "head", "tail", "plain")

    def __init__(self, text: str, place: tuple[int, int]):
        self.place, self.parts, self.n, self.counts = place, (), len(text), Counter(text)
        self.head, self.tail, self.plain = text[:64], text[-64:], bool(_VALUE.fullmatch(text)) or not text

    @classmethod
    def joined(cls, parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        out = cls("", (0, 0))
        out.place, out.parts, out.n, out.plain = None, tuple(parts), sum(p.n for p in parts), all(p.plain for p in parts)
        for p in parts:
            out.counts.update(p.counts)
            out.head, out.tail = (out.head + p.head)[:64], (out.tail + p.tail)[-64:]
        return out

    def literals(self, seen: set[int]) -> Iterator[tuple[int, int]]:
        """The places of all its literals; ``seen`` holds the parts that were listed before."""
        stack = [self]
        while stack:
            v = stack.pop()
            if id(v) not in seen:
                seen.add(id(v))
                if v.place:
                    yield v.place
                stack += v.parts

    def score(self) -> float:
        """0 to 1: bits by the characters' entropy, for values that look like no words; less for one kind of character."""
        n = self.n
        if n < LEAST_LITERAL or not self.plain or _DUMMY.fullmatch(self.head if n <= 64 else self.head + "\0" + self.tail):
            return 0.0
        bits = -sum(c * math.log2(c / n) for c in self.counts.values())
        kinds = sum(any(f(c) for c in self.counts) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in self.counts)
        one = 0.65 if n >= (10 if all(map(str.isdigit, self.counts)) else 16) else 0.4
        return min(1.0, bits / 40) * (1.0 if kinds > 1 else one)


def literal_score(text: str) -> float:
    return Value(text, (0, 0)).score()


def _lines(text: str) -> Iterator[tuple[int, str]]:
    """Each line with an assignment mark, once, with its start; a line that ends in one goes on with the next."""
    at = 0
    while m := _HINT.search(text, at):
        start = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.end())
        while end >= 0 and _OPEN.search(text, max(start, end - 64), end):
            end = text.find("\n", end + 1)
        end = len(text) if end < 0 else end
        line = text[start:end]
        if _MARK.search(line):
            yield start, line
        at = end


def assignments(text: str) -> list[tuple[str, Value]]:
    """Names with their values, in order."""
    known: dict[str, Value] = {}
    out: list[tuple[str, Value]] = [("password", Value(m[1], m.span(1))) for m in _URL.finditer(text)] if "://" in text else []
    for base, line in _lines(text):
        tokens = [m for m in _TOKEN.finditer(line)]
        k = 0
        while k < len(tokens):
            m = tokens[k]
            name, at = None, k + 1
            if m["tag"]:
                inner = m["tagtext"].strip()
                start = base + m.start("tagtext") + m["tagtext"].find(inner)
                out.append((m["tagname"], Value(inner, (start, start + len(inner)))))
            elif m["flag"]:
                name = m["flagname"]
                if at < len(tokens) and tokens[at]["op"] == "=":
                    at += 1
            elif (m["name"] or m["string"]) and at < len(tokens) and tokens[at]["op"] in ("=", ":", ":=", "=>"):
                name = m["name"] or m["string"][1:-1]
                at += 1
                if at < len(tokens) and tokens[at - 1]["op"] == ":" and tokens[at]["name"] and at + 1 < len(tokens) and tokens[at + 1]["op"] == "=":
                    at += 2  # name: type = value
            if name is None or at >= len(tokens):
                k += 1
                continue
            parts: list[Value] = []
            while at < len(tokens):
                v = tokens[at]
                if v["string"]:
                    parts.append(Value(v["string"][1:-1], (base + v.start() + 1, base + v.end() - 1)))
                elif v["name"] and v["name"] in known:
                    parts.append(known[v["name"]])
                elif (v["bare"] or v["name"]) and not parts:
                    run = _RUN.match(line, v.start())
                    parts.append(Value(run[0], (base + run.start(), base + run.end())))
                    while at + 1 < len(tokens) and tokens[at + 1].start() < run.end():
                        at += 1
                else:
                    break
                at += 1
                if at < len(tokens) and tokens[at]["op"] == "+":
                    at += 1
                else:
                    break
            if parts:
                known[name] = Value.joined(parts)
                out.append((name, known[name]))
            k = max(k + 1, at - 1 if at < len(tokens) and tokens[at - 1]["string"] is None else at)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds' spans, by kind and start."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return out


def scan_text(text: str, threshold: float = THRESHOLD) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans, and all spans; each by start, then kind."""
    key = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(base_spans(text), key=key)
    starts, reach = [x for _, x, _ in base], []
    for _, _, y in base:
        reach.append(max(y, reach[-1] if reach else 0))
    more: set[tuple[str, int, int]] = set()
    seen: set[int] = set()
    for name, value in assignments(text):
        score = name_score(name)
        if score and score + value.score() >= threshold:
            for a, b in value.literals(seen):
                k = bisect_right(starts, a)  # the base spans that start at or before a
                if b > a and not (k and reach[k - 1] >= b):
                    more.add(("literal", a, b))
    return base, sorted([*base, *more], key=key) if more else base


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"


def _scan(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows: dict[str, list] = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal")}
        for text in text_column(batch).to_pylist():
            base, spans = scan_text(text, threshold)
            n = Counter(k for k, _, _ in spans)
            for kind in KINDS[:3]:
                rows[f"n_{kind}"].append(n[kind])
            rows["n_literal"].append(n["literal"])
            rows["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            rows["spans"].append(_joined(spans))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in rows.items())], names=["doc_id", *rows])


def scan_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts and spans of every document."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _scan(b, threshold), _SCHEMA)


def redact_text(text: str | None, mark: str = "[{kind}]", threshold: float = THRESHOLD) -> str | None:
    """The text with every span replaced; overlapping spans become one, named by the first."""
    if not text:
        return text
    spans = scan_text(text, threshold)[1]
    if not spans:
        return text
    merged: list[list] = []
    for kind, a, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    out, at = [], 0
    for kind, a, b in merged:
        out += [text[at:a], mark.format(kind=kind)]
        at = b
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns; secrets in ``text`` replaced, ``n_chars`` (if there) brought up to date."""
    ship(docs.sparkSession)
    names = docs.columns

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pa.array([redact_text(t, threshold=threshold) for t in batch.column("text").to_pylist()], pa.string())
            columns = {n: batch.column(n) for n in names} | {"text": texts}
            if "n_chars" in columns:
                changed = pc.fill_null(pc.not_equal(texts, batch.column("text").cast(pa.string())), False)
                columns["n_chars"] = pc.if_else(changed, pc.utf8_length(texts).cast(columns["n_chars"].type), columns["n_chars"])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(edit, docs.schema)


def op2_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))
