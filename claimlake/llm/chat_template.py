"""Compiler of a small sandboxed template language for conversations.

Text, ``{{ expression }}``, ``{% for x in xs %}``, ``{% if %}/{% elif %}/{% else %}``, and
``{% generation %}`` marks. Expressions know literals, variables, fields of dictionaries, ``== != and or
not +`` and filters; no attribute of a Python object, call or import can be reached. A
template is parsed to a syntax tree, constants are folded, and the tree becomes Python closures
that yield pieces of text and mark the generated ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Lit:
    value: object


@dataclass(frozen=True)
class Var:
    name: str


@dataclass(frozen=True)
class Field:
    base: object
    name: str


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    arg: object


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Out:
    expr: object


@dataclass(frozen=True)
class If:
    branches: tuple        # (condition, body) pairs
    otherwise: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<num>\d+)"""
                    r"""|(?P<name>[A-Za-z]\w*)|(?P<op>==|!=|[|+.()\[\]]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"can't read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent: or, and, not, comparison, sum, filters, fields."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.at, self.filters = _tokens(source), 0, filters

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, kind: str | None = None, value: str | None = None) -> str:
        if self.at >= len(self.tokens) or kind and self.tokens[self.at][0] != kind or value and self.tokens[self.at][1] != value:
            raise TemplateError(f"expected {value or kind} at token {self.at + 1}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        e = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return e

    def _chain(self, word: str, part: Callable):
        e = part()
        while self.peek(word):
            self.take()
            e = Op(word, (e, part()))
        return e

    def either(self):
        return self._chain("or", lambda: self._chain("and", self.negated))

    def negated(self):
        if self.peek("not"):
            self.take()
            return Op("not", (self.negated(),))
        e = self._chain("+", self.filtered)
        if self.peek("==", "!="):
            return Op(self.take(), (e, self._chain("+", self.filtered)))
        return e

    def filtered(self):
        e = self.primary()
        while self.peek("|", ".", "["):
            if self.take() == "|":
                name = self.take("name")
                if name not in self.filters:
                    raise TemplateError(f"no filter {name}")
                e = Filter(name, e)
            elif self.tokens[self.at - 1][1] == ".":
                e = Field(e, self.take("name"))
            else:
                e = Field(e, self._string(self.take("str")))
                self.take(value="]")
        return e

    @staticmethod
    def _string(quoted: str) -> str:
        return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1], flags=re.S)

    def primary(self):
        if self.peek("("):
            self.take()
            e = self.either()
            self.take(value=")")
            return e
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Lit(self._string(value))
        if kind == "num":
            return Lit(int(value))
        if kind == "name" and value not in ("and", "or", "not"):
            return Lit(_CONSTANTS[value]) if value in _CONSTANTS else Var(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str, filters: Mapping[str, Callable]) -> tuple:
    """The syntax tree: a tuple of nodes."""
    parts, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            parts.append(("text", template[at:m.start()]))
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        parts.append(("text", template[at:]))
    expr = lambda s: _Expression(s, filters).whole()

    def block(i: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
        nodes: list = []
        while i < len(parts):
            kind, value = parts[i]
            word = value.split(None, 1)[0] if kind == "tag" and value else ""
            if kind == "tag" and word in ends:
                return tuple(nodes), i
            i += 1
            if kind == "text":
                nodes.append(Text(value))
            elif kind == "out":
                nodes.append(Out(expr(value)))
            elif word == "for":
                m = re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", value, re.S)
                if not m:
                    raise TemplateError(f"can't read {value!r}")
                body, i = block(i, ("endfor",))
                nodes.append(For(m[1], expr(m[2]), body))
                i += 1
            elif word == "if":
                branches, otherwise, cond = [], (), value[2:]
                while True:
                    body, i = block(i, ("elif", "else", "endif"))
                    branches.append((expr(cond), body))
                    word, _, cond = parts[i][1].partition(" ")
                    i += 1
                    if word == "elif":
                        continue
                    if word == "else":
                        otherwise, i = block(i, ("endif",))
                        i += 1
                    break
                nodes.append(If(tuple(branches), otherwise))
            elif word == "generation":
                body, i = block(i, ("endgeneration",))
                nodes.append(Generation(body))
                i += 1
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(nodes), i
    return block(0, ())[0]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: _text(a) + _text(b),
    "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a,
}


def fold_expression(e, filters: Mapping[str, Callable]):
    if isinstance(e, Op):
        args = tuple(fold_expression(a, filters) for a in e.args)
        if e.kind in ("and", "or") and isinstance(args[0], Lit):
            return args[1] if bool(args[0].value) == (e.kind == "and") else args[0]
        return Lit(_OPS[e.kind](*(a.value for a in args))) if all(isinstance(a, Lit) for a in args) else Op(e.kind, args)
    if isinstance(e, Filter):
        arg = fold_expression(e.arg, filters)
        return Lit(filters[e.name](_text(arg.value))) if isinstance(arg, Lit) else Filter(e.name, arg)
    if isinstance(e, Field):
        return Field(fold_expression(e.base, filters), e.name)
    return e


def fold(nodes: Iterable, filters: Mapping[str, Callable]) -> tuple:
    """The tree with constant expressions evaluated, decided branches taken and texts joined."""
    out: list = []

    def put(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            node = Text(out.pop().value + node.value)
        if node != Text(""):
            out.append(node)
    for n in nodes:
        if isinstance(n, Out):
            e = fold_expression(n.expr, filters)
            put(Text(_text(e.value)) if isinstance(e, Lit) else Out(e))
        elif isinstance(n, If):
            branches, otherwise = [], fold(n.otherwise, filters)
            for cond, body in n.branches:
                cond, body = fold_expression(cond, filters), fold(body, filters)
                if isinstance(cond, Lit):
                    if cond.value:
                        otherwise = body
                        break
                    continue
                branches.append((cond, body))
            if branches:
                put(If(tuple(branches), otherwise))
            else:
                for x in otherwise:
                    put(x)
        elif isinstance(n, For):
            put(For(n.name, fold_expression(n.over, filters), fold(n.body, filters)))
        elif isinstance(n, Generation):
            if body := fold(n.body, filters):
                put(Generation(body))
        else:
            put(n)
    return tuple(out)


def _expression(e, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    if isinstance(e, Lit):
        return lambda scope, v=e.value: v
    if isinstance(e, Var):
        return lambda scope, n=e.name: scope.get(n)
    if isinstance(e, Field):
        base = _expression(e.base, filters)

        def field(scope, n=e.name):
            v = base(scope)
            return v.get(n) if isinstance(v, dict) else None
        return field
    if isinstance(e, Filter):
        arg, run = _expression(e.arg, filters), filters[e.name]
        return lambda scope: run(_text(arg(scope)))
    args = [_expression(a, filters) for a in e.args]
    if e.kind == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if e.kind == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    run = _OPS[e.kind]
    return lambda scope: run(*(a(scope) for a in args))


Pieces = Iterator[tuple[str, bool]]


def _body(nodes: tuple, filters: Mapping[str, Callable]) -> Callable[[dict, bool], Pieces]:
    steps = [_node(n, filters) for n in nodes]

    def run(scope, marked):
        for s in steps:
            yield from s(scope, marked)
    return run


def _node(n, filters: Mapping[str, Callable]) -> Callable[[dict, bool], Pieces]:
    if isinstance(n, Text):
        return lambda scope, marked: ((n.value, marked),)
    if isinstance(n, Out):
        e = _expression(n.expr, filters)
        return lambda scope, marked: ((_text(e(scope)), marked),)
    if isinstance(n, Generation):
        body = _body(n.body, filters)
        return lambda scope, marked: body(scope, True)
    if isinstance(n, If):
        branches = [(_expression(c, filters), _body(b, filters)) for c, b in n.branches]
        otherwise = _body(n.otherwise, filters)

        def choose(scope, marked):
            for c, b in branches:
                if c(scope):
                    return b(scope, marked)
            return otherwise(scope, marked)
        return choose
    over, body = _expression(n.over, filters), _body(n.body, filters)

    def loop(scope, marked):
        for x in over(scope) or ():
            yield from body({**scope, n.name: x}, marked)
    return loop


def compile_template(template: str, filters: Mapping[str, Callable] | None = None) -> Callable[[dict], Pieces]:
    """A function that renders a scope of plain values, and iterators of them, piece by piece:
    (text, whether it is generated)."""
    known = {"trim": str.strip, "upper": str.upper, "lower": str.lower, **(filters or {})}
    run = _body(fold(parse(template, known), known), known)
    return lambda scope: run(scope, False)
