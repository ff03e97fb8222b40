"""A small sandboxed template language, compiled to Python closures.

``{{ expression }}`` writes a value, ``{% for x in y %}``, ``{% if %}``/``{% elif %}``/
``{% else %}`` and ``{% set x = y %}`` control, ``{% generation %}`` ... ``{%
endgeneration %}`` marks what a model is to learn. Expressions have strings, integers,
true, false, none, names, ``a.b`` and ``a['b']`` on mappings only, ``==``, ``!=``, ``not``,
``and``, ``or``, ``+``, parentheses and the filters handed in. Nothing else can be
reached: no attributes of Python objects, no calls, no statements.

A template is parsed into a syntax tree, constant parts of which are computed once, and
turned into one closure per node.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any, NamedTuple


class TemplateError(ValueError):
    """A template that the language does not have."""


class Text(NamedTuple):
    text: str


class Write(NamedTuple):
    value: Any


class Loop(NamedTuple):
    name: str
    over: Any
    body: list


class Choice(NamedTuple):
    branches: list[tuple[Any, list]]


class Assign(NamedTuple):
    name: str
    value: Any


class Generation(NamedTuple):
    body: list


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Item(NamedTuple):
    of: Any
    key: Any


class Filter(NamedTuple):
    of: Any
    name: str


class Unary(NamedTuple):
    of: Any


class Binary(NamedTuple):
    sign: str
    left: Any
    right: Any


_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[-+|.()\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"true": True, "false": False, "none": None}


def _lex(source: str) -> list[tuple[str, str]]:
    found, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:]!r}")
        kind = ("string", "number", "name", "sign")[m.lastindex - 1]
        found.append((kind, m[m.lastindex]))
        at = m.end()
    return found


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, tokens: list[tuple[str, str]]):
        self.tokens, self.at = tokens, 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", None)
        return None if kind == "string" else text

    def take(self, text: str) -> bool:
        if self.peek() == text:
            self.at += 1
            return True
        return False

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def whole(self) -> Any:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> Any:
        node = self.both()
        while self.take("or"):
            node = Binary("or", node, self.both())
        return node

    def both(self) -> Any:
        node = self.negated()
        while self.take("and"):
            node = Binary("and", node, self.negated())
        return node

    def negated(self) -> Any:
        return Unary(self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Any:
        node = self.summed()
        while (sign := self.peek()) in ("==", "!="):
            self.at += 1
            node = Binary(sign, node, self.summed())
        return node

    def summed(self) -> Any:
        node = self.filtered()
        while self.take("+"):
            node = Binary("+", node, self.filtered())
        return node

    def filtered(self) -> Any:
        node = self.reached()
        while self.take("|"):
            node = Filter(node, self.name())
        return node

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return text

    def reached(self) -> Any:
        node = self.atom()
        while True:
            if self.take("."):
                node = Item(node, Const(self.name()))
            elif self.take("["):
                node = Item(node, self.either())
                self.need("]")
            else:
                return node

    def atom(self) -> Any:
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), text[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(text))
        if kind == "name":
            return Const(_WORDS[text]) if text in _WORDS else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def _expression(source: str) -> Any:
    return _Expression(_lex(source)).whole()


def parse(source: str) -> list:
    """The syntax tree of a template."""
    parts, at = [], 0
    for m in _PART.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        parts.append(("write", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    nodes, rest = _body(parts, 0, ())
    if rest < len(parts):
        raise TemplateError(f"unexpected {parts[rest][1]!r}")
    return nodes


def _body(parts: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[list, int]:
    nodes: list = []
    while at < len(parts):
        kind, source = parts[at]
        at += 1
        if kind == "text":
            nodes.append(Text(source))
            continue
        if kind == "write":
            nodes.append(Write(_expression(source)))
            continue
        word, _, rest = source.partition(" ")
        if word in ends:
            return nodes, at - 1
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"unexpected {source!r}")
            body, at = _body(parts, at, ("endfor",))
            nodes.append(Loop(m[1], _expression(m[2]), body))
        elif word == "if":
            branches, test = [], _expression(rest)
            while True:
                body, at = _body(parts, at, ("elif", "else", "endif"))
                branches.append((test, body))
                if at == len(parts):
                    raise TemplateError("endif is missing")
                word, _, rest = parts[at][1].partition(" ")
                if word == "endif":
                    break
                test, at = (_expression(rest) if word == "elif" else Const(True)), at + 1
            nodes.append(Choice(branches))
        elif word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError(f"unexpected {source!r}")
            nodes.append(Assign(name.strip(), _expression(value)))
            continue
        elif word == "generation":
            body, at = _body(parts, at, ("endgeneration",))
            nodes.append(Generation(body))
        else:
            raise TemplateError(f"unexpected {source!r}")
        if at == len(parts):
            raise TemplateError(f"the end of {source!r} is missing")
        at += 1
    return nodes, at


_SIGNS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _shown(a) + _shown(b),
}


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _reach(of: Any, key: Any) -> Any:
    if not isinstance(of, dict):
        raise TemplateError("only mappings have items")
    return of.get(key)


def fold(node: Any, filters: dict[str, Callable[[str], str]]) -> Any:
    """The tree with constant parts computed, choices decided by constants made, and
    neighbouring texts joined."""
    if isinstance(node, list):
        made: list = []
        for child in node:
            child = fold(child, filters)
            for part in child if isinstance(child, list) else [child]:
                if isinstance(part, Text) and made and isinstance(made[-1], Text):
                    made[-1] = Text(made[-1].text + part.text)
                elif not isinstance(part, Text) or part.text:
                    made.append(part)
        return made
    if isinstance(node, Write):
        value = fold(node.value, filters)
        return Text(_shown(value.value)) if isinstance(value, Const) else Write(value)
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, Choice):
        open_: list = []
        for test, body in node.branches:
            test, body = fold(test, filters), fold(body, filters)
            if isinstance(test, Const) and not test.value:
                continue
            open_.append((test, body))
            if isinstance(test, Const):
                break
        if not open_:
            return []
        return open_[0][1] if isinstance(open_[0][0], Const) else Choice(open_)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"there is no filter {node.name!r}")
        of = fold(node.of, filters)
        return Const(filters[node.name](_shown(of.value))) if isinstance(of, Const) else Filter(of, node.name)
    if isinstance(node, Unary):
        of = fold(node.of, filters)
        return Const(not of.value) if isinstance(of, Const) else Unary(of)
    if isinstance(node, Binary):
        left, right = fold(node.left, filters), fold(node.right, filters)
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(_SIGNS[node.sign](left.value, right.value))
        return Binary(node.sign, left, right)
    if isinstance(node, Item):
        return Item(fold(node.of, filters), fold(node.key, filters))
    return node


class Output:
    """What has been written, its length, and the marked spans."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


Value = Callable[[dict], Any]
Step = Callable[[dict, Output], None]


def _value(node: Any, filters: dict[str, Callable[[str], str]]) -> Value:
    match node:
        case Const(value):
            return lambda scope: value
        case Name(name):
            return lambda scope: scope.get(name)
        case Item(of, key):
            base, at = _value(of, filters), _value(key, filters)
            return lambda scope: _reach(base(scope), at(scope))
        case Filter(of, name):
            base, change = _value(of, filters), filters[name]
            return lambda scope: change(_shown(base(scope)))
        case Unary(of):
            base = _value(of, filters)
            return lambda scope: not base(scope)
        case Binary("and", left, right):
            a, b = _value(left, filters), _value(right, filters)
            return lambda scope: a(scope) and b(scope)
        case Binary("or", left, right):
            a, b = _value(left, filters), _value(right, filters)
            return lambda scope: a(scope) or b(scope)
        case Binary(sign, left, right):
            a, b, join = _value(left, filters), _value(right, filters), _SIGNS[sign]
            return lambda scope: join(a(scope), b(scope))
    raise TemplateError(f"unexpected {node!r}")


def _step(node: Any, filters: dict[str, Callable[[str], str]]) -> Step:
    match node:
        case Text(text):
            return lambda scope, out: out.write(text)
        case Write(value):
            shown = _value(value, filters)
            return lambda scope, out: out.write(_shown(shown(scope)))
        case Assign(name, value):
            made = _value(value, filters)
            return lambda scope, out: scope.__setitem__(name, made(scope))
        case Loop(name, over, body):
            items, inner = _value(over, filters), _steps(body, filters)

            def loop(scope: dict, out: Output) -> None:
                for item in items(scope) or ():
                    inner({**scope, name: item}, out)

            return loop
        case Choice(branches):
            tests = [(_value(test, filters), _steps(body, filters)) for test, body in branches]

            def choose(scope: dict, out: Output) -> None:
                for test, body in tests:
                    if test(scope):
                        return body(scope, out)

            return choose
        case Generation(body):
            inner = _steps(body, filters)

            def mark(scope: dict, out: Output) -> None:
                start = out.length
                inner(scope, out)
                out.spans.append((start, out.length))

            return mark
    raise TemplateError(f"unexpected {node!r}")


def _steps(nodes: list, filters: dict[str, Callable[[str], str]]) -> Step:
    steps = [_step(node, filters) for node in nodes]

    def run(scope: dict, out: Output) -> None:
        for step in steps:
            step(scope, out)

    return run


class Template:
    """A compiled template."""

    def __init__(self, source: str, filters: dict[str, Callable[[str], str]] | None = None):
        self.tree = fold(parse(source), filters or {})
        self._run = _steps(self.tree, filters or {})

    def render(self, **scope: Any) -> tuple[str, list[tuple[int, int]]]:
        """The text, and the spans written within generation marks."""
        out = Output()
        self._run(dict(scope), out)
        return "".join(out.parts), out.spans
