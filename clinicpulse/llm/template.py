"""A small sandboxed template language, compiled to Python closures.

Text stands as it is. ``{{ expression }}`` prints; ``{% if %} {% elif %} {% else %} {% endif %}`` chooses;
``{% for name in expression %} {% endfor %}`` repeats over the given messages; ``{% generation %}
{% endgeneration %}`` marks what a model is to learn. Expressions know names, fields (``message.role``), strings,
``==``, ``!=``, ``not``, ``and``, ``or``, ``+`` and the given filters (``| escape``). There are no calls, no
attributes and no imports: a name is looked up in the given values, a field in a mapping, and nothing else.

Parsing gives a syntax tree; constants are folded; every node becomes a closure that yields (text, learnt) pieces,
so that a conversation of any length is rendered message by message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, fields, is_dataclass

Piece = tuple[str, bool]
Filters = Mapping[str, Callable[[str], str]]

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_SIGN = re.compile(r"""\s*(?:(?P<name>[A-Za-z_]\w*)|(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<op>==|!=|[.|+()]))""")
_ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template is not well-formed, or asks for something the language does not have."""


@dataclass(frozen=True)
class Constant:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    name: str


@dataclass(frozen=True)
class Filtered:
    of: object
    name: str


@dataclass(frozen=True)
class Not:
    of: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Print:
    of: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class _Expression:
    """Recursive descent over one tag's expression."""

    def __init__(self, source: str) -> None:
        self.signs: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _SIGN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected sign in {source!r}")
            self.signs.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def _next(self, *values: str) -> str | None:
        if self.at < len(self.signs) and self.signs[self.at][1] in values and self.signs[self.at][0] != "text":
            self.at += 1
            return self.signs[self.at - 1][1]
        return None

    def whole(self) -> object:
        node = self.either()
        if self.at != len(self.signs):
            raise TemplateError(f"unexpected {self.signs[self.at][1]!r}")
        return node

    def _chain(self, ops: tuple[str, ...], below: Callable[[], object]) -> object:
        node = below()
        while op := self._next(*ops):
            node = Binary(op, node, below())
        return node

    def either(self) -> object:
        return self._chain(("or",), self.both)

    def both(self) -> object:
        return self._chain(("and",), self.negated)

    def negated(self) -> object:
        return Not(self.negated()) if self._next("not") else self.compared()

    def compared(self) -> object:
        return self._chain(("==", "!="), self.added)

    def added(self) -> object:
        return self._chain(("+",), self.operand)

    def operand(self) -> object:
        if self.at == len(self.signs):
            raise TemplateError("an expression ends too early")
        kind, value = self.signs[self.at]
        self.at += 1
        if kind == "text":
            node = Constant(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        elif kind == "name" and value not in ("and", "or", "not"):
            node = Name(value)
        elif value == "(":
            node = self.either()
            if not self._next(")"):
                raise TemplateError("a bracket is not closed")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while op := self._next(".", "|"):
            if self.at == len(self.signs) or self.signs[self.at][0] != "name":
                raise TemplateError(f"a name must follow {op!r}")
            name = self.signs[self.at][1]
            self.at += 1
            if name.startswith("_"):
                raise TemplateError(f"{name!r} is not open to templates")
            node = Field(node, name) if op == "." else Filtered(node, name)
        return node


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of nodes."""
    parts = [p for p in _TAG.split(source) if p]
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes: list[object] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(Print(_Expression(part[2:-2]).whole()))
            elif not part.startswith("{%"):
                nodes.append(Print(Constant(part)))
            else:
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return tuple(nodes), f"{word} {rest}".strip()
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(nodes), ""

    def choice(test: str) -> If:
        then, end = block("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        if word == "elif":
            return If(_Expression(test).whole(), then, (choice(rest),))
        other = block("endif")[0] if word == "else" else ()
        return If(_Expression(test).whole(), then, other)

    def statement(word: str, rest: str) -> object:
        if word == "if":
            return choice(rest)
        if word == "generation" and not rest:
            return Generation(block("endgeneration")[0])
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
            if m:
                return For(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return block()[0]


def _apply(op: str, left: object, right: object) -> object:
    if op == "==":
        return left == right
    if op == "!=":
        return left != right
    if op == "+":
        return _text(left) + _text(right)
    return (left and right) if op == "and" else (left or right)


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value)


def fold(node: object, filters: Filters) -> object:
    """The same expression with everything that does not depend on the messages worked out."""
    if isinstance(node, Filtered):
        of = fold(node.of, filters)
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        return Constant(filters[node.name](_text(of.value))) if isinstance(of, Constant) else Filtered(of, node.name)
    if isinstance(node, Field):
        return Field(fold(node.of, filters), node.name)
    if isinstance(node, Not):
        of = fold(node.of, filters)
        return Constant(not of.value) if isinstance(of, Constant) else Not(of)
    if isinstance(node, Binary):
        left, right = fold(node.left, filters), fold(node.right, filters)
        if isinstance(left, Constant) and isinstance(right, Constant):
            return Constant(_apply(node.op, left.value, right.value))
        return Binary(node.op, left, right)
    return node


def fold_all(nodes: tuple, filters: Filters) -> tuple:
    """Fold expressions, choose constant branches, and join neighbouring constant texts."""
    out: list[object] = []
    for node in nodes:
        if isinstance(node, Print):
            node = Print(fold(node.of, filters))
            if isinstance(node.of, Constant):
                value = _text(node.of.value)
                if out and isinstance(out[-1], Print) and isinstance(out[-1].of, Constant):
                    value = _text(out.pop().of.value) + value
                node = Print(Constant(value))
        elif isinstance(node, If):
            test = fold(node.test, filters)
            then, other = fold_all(node.then, filters), fold_all(node.other, filters)
            if isinstance(test, Constant):
                out = list(fold_all((*out, *(then if test.value else other)), filters))
                continue
            node = If(test, then, other)
        elif isinstance(node, For):
            node = For(node.name, fold(node.over, filters), fold_all(node.body, filters))
        elif isinstance(node, Generation):
            node = Generation(fold_all(node.body, filters))
        out.append(node)
    return tuple(out)


def _value(node: object, filters: Filters) -> Callable[[Mapping], object]:
    """A closure that works an expression out."""
    if isinstance(node, Constant):
        return lambda values, v=node.value: v
    if isinstance(node, Name):
        return lambda values, name=node.name: values.get(name)
    of = _value(node.left if isinstance(node, Binary) else node.of, filters)
    if isinstance(node, Field):

        def field(values: Mapping) -> object:
            holder = of(values)
            return holder.get(node.name) if isinstance(holder, Mapping) else None

        return field
    if isinstance(node, Filtered):
        apply = filters[node.name]
        return lambda values: apply(_text(of(values)))
    if isinstance(node, Not):
        return lambda values: not of(values)
    right, op = _value(node.right, filters), node.op
    if op == "and":
        return lambda values: of(values) and right(values)
    if op == "or":
        return lambda values: of(values) or right(values)
    return lambda values: _apply(op, of(values), right(values))


def _closure(node: object, learnt: bool, filters: Filters) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Print):
        value = _value(node.of, filters)

        def show(values: dict) -> Iterator[Piece]:
            yield _text(value(values)), learnt

        return show
    if isinstance(node, If):
        test = _value(node.test, filters)
        then, other = _sequence(node.then, learnt, filters), _sequence(node.other, learnt, filters)
        return lambda values: (then if test(values) else other)(values)
    if isinstance(node, Generation):
        return _sequence(node.body, True, filters)
    over, body = _value(node.over, filters), _sequence(node.body, learnt, filters)

    def repeat(values: dict) -> Iterator[Piece]:
        items = over(values)
        if items is None or isinstance(items, (str, Mapping)) or not isinstance(items, Iterable):
            raise TemplateError("only the given messages can be repeated over")
        for item in items:
            yield from body({**values, node.name: item})

    return repeat


def _sequence(nodes: tuple, learnt: bool, filters: Filters) -> Callable[[dict], Iterator[Piece]]:
    parts = [_closure(node, learnt, filters) for node in nodes]

    def run(values: dict) -> Iterator[Piece]:
        for part in parts:
            yield from part(values)

    return run


def compiled(source: str, filters: Filters) -> Callable[[dict], Iterator[Piece]]:
    """Parse, fold and compile a template; the closure takes the values and yields (text, learnt) pieces."""
    return _sequence(fold_all(parse(source), filters), False, filters)


def walks_turn_by_turn(source: str, filters: Filters) -> bool:
    """Whether a template is one walk over ``messages`` that looks at nothing but the message at hand, so that messages
    rendered one by one, on any task, give the same text together."""
    nodes = fold_all(parse(source), filters)
    if len(nodes) != 1 or not isinstance(nodes[0], For) or nodes[0].over != Name("messages"):
        return False
    return not _mentions(nodes[0].body, "messages")


def _mentions(node: object, name: str) -> bool:
    if isinstance(node, tuple):
        return any(_mentions(n, name) for n in node)
    if node == Name(name):
        return True
    return is_dataclass(node) and any(_mentions(getattr(node, f.name), name) for f in fields(node))
