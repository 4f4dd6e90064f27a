"""Secret scan with a trigram inverted index.

From the syntax tree of every rule's regex a Boolean query over trigrams is derived: what any
match must contain. Each Arrow batch of documents is an index segment: the postings of the
trigrams that the queries mention are built over the segment's (ASCII lower-cased) bytes,
postings are intersected and united as the queries say, and only documents left are verified
with the regex. Rules whose regex requires no trigram scan every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SET_LIMIT = 24
SEGMENT_BYTES = 4 << 20
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, or the match is dropped; group ``span`` is what is found."""
    kind: str
    regex: str
    group: int = 0
    least: int = 0
    span: int = 0


def _either(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: The base rules, then those added.
BASE_RULES = (
    Rule("assign", "(" + _either("password|passwd|secret|token|api_?key")
         + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
#: Possessive repeats have no upper length: what follows is not of their class, so none is tried again.
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}+"),
    # Of a run of token characters only the first eyJ is tried, once: what follows the run is the same for all of them.
    Rule("jwt", r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))"
                r"(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)", span=1),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,30}://[A-Za-z0-9._~%+-]++:[A-Za-z0-9._~%+-]{4,}+@"),
)


# A query is True (no requirement), ("tri", t), ("and", [..]) or ("or", [..]).
def _and(parts):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _or(parts):
    return True if any(p is True for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[str]):
    """What holds if one of ``strings`` occurs."""
    return _or([_and([("tri", s[i:i + 3]) for i in range(len(s) - 2)]) for s in sorted(strings)])


def _analyse(nodes) -> tuple[set[str] | None, object]:
    """(the lower-cased strings the expression matches, if few, else None; its query)."""
    done, run, whole = [], {""}, True
    for op, arg in nodes:
        exact, query = _node(op, arg)
        if exact is not None and len(run) * len(exact) <= _SET_LIMIT:
            run = {a + b for a in run for b in exact}
            continue
        whole = False
        done.append(_of_strings(run))
        if exact is None:
            done.append(query)
            run = {""}
        else:
            run = exact
    return (run if whole else None), _and([*done, _of_strings(run)])


def _node(op, arg):
    if op is sre.LITERAL:
        return ({chr(arg).lower()}, True) if arg < 128 else (None, True)
    if op is sre.IN:
        chars = {chr(v).lower() for o, v in arg if o is sre.LITERAL and v < 128}
        if len(chars) <= 8 and all(o is sre.LITERAL and v < 128 for o, v in arg):
            return chars, True
        return None, True
    if op is sre.SUBPATTERN:
        return _analyse(arg[-1])
    if op is sre.BRANCH:
        parts = [_analyse(x) for x in arg[1]]
        if all(e is not None for e, _ in parts):
            union = set().union(*(e for e, _ in parts))
            if len(union) <= _SET_LIMIT:
                return union, _of_strings(union)
        return None, _or([q for _, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, inner = arg
        exact, query = _analyse(inner)
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, True
        return None, (query if least > 0 else True)
    if op is sre.AT:
        return {""}, True
    return None, True


def trigram_query(regex: str):
    """The Boolean trigram query that every text with a match satisfies; True: no requirement."""
    return _analyse(sre_parser.parse(regex))[1]


def _trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(_trigrams, query[1]))


def _evaluate(query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    if query is True:
        return np.ones(n, bool)
    if query[0] == "tri":
        return postings[query[1]]
    join = np.logical_and if query[0] == "and" else np.logical_or
    return join.reduce([_evaluate(q, postings, n) for q in query[1]])


class Scanner:
    """Rules with their queries and regexes, compiled once in each task."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        self.regex = [re.compile(r.regex, re.ASCII) for r in rules]
        self.query = [trigram_query(r.regex) for r in rules]
        self.names = sorted(set().union(*map(_trigrams, self.query)))
        self.number = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(self.names):
            self.number[int.from_bytes(t.encode("ascii"), "big")] = i + 1
        self.fold = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

    def postings(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """For each trigram of the queries, which of the segment's texts hold it."""
        table = np.zeros((len(self.names) + 1, len(texts)), bool)
        for first, data, starts in self._segments(texts):
            b = np.frombuffer(data, np.uint8).astype(np.uint32)
            number = self.number[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]
            at = np.flatnonzero(number)
            table[number[at], first + np.searchsorted(starts, at, "right") - 1] = True
        return {t: table[i + 1] for i, t in enumerate(self.names)}

    def _segments(self, texts: list[bytes]):
        """Runs of texts of about SEGMENT_BYTES, zero bytes between; (number of the first, bytes, starts)."""
        first, run, size = 0, [], 0
        for i, t in enumerate([*texts, None]):
            if run and (t is None or size + len(t) > SEGMENT_BYTES):
                starts = np.cumsum([0, *(len(x) + 3 for x in run[:-1])])
                yield first, (b"\0\0\0".join(run) + b"\0\0\0").translate(self.fold), starts
                first, run, size = i, [], 0
            if t is not None:
                run.append(t)
                size += len(t) + 3

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, number of the rule, end) of each text's matches, sorted; code points."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.postings([t.encode("utf-8", "surrogatepass") for t in texts])
        for k, (rule, regex, query) in enumerate(zip(self.rules, self.regex, self.query)):
            for i in np.flatnonzero(_evaluate(query, postings, len(texts))).tolist():
                out[i] += [(m.start(rule.span), k, m.end(rule.span)) for m in regex.finditer(texts[i])
                           if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [sorted(x) for x in out]


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``found``, an array of (kind, start, end) sorted by start
    and the order of the rules. Matches of a rule are leftmost and do not overlap; those of different
    rules may. Null text is empty: no spans. Repeated rows get the same spans; an empty table no rows."""
    rules = tuple(rules)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for b in batches:
            found = scanner.spans([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(
                [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in x] for x in found], _FOUND)], ["id", "found"])
    kind = own.schema["id"].dataType.simpleString()
    return (own.mapInArrow(run, f"id {kind}, found array<struct<kind:string,start:long,end:long>>")
            .withColumnRenamed("id", id_col))
