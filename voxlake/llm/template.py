"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}  {# comment #}  {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in e %} ... {% endfor %} (with loop.first, loop.last, loop.index0, loop.index)  {% set x = e %}
    {% generation %} ... {% endgeneration %}: what the model is to say, the loss mask

`{%-` and `-%}` drop white space beside a tag. Expressions have strings, whole numbers, true, false, none, names, `a.b`,
`a['b']`, `+ ~ == != < <= > >= in not and or`, parentheses, `x if c else y`, and filters `x | name`. There are no calls and
no attributes of Python objects: a dot reads a key of a mapping, so a template reaches nothing but its input.

`compile_template(source)` parses to a syntax tree, folds constants (expressions, text, branches) and makes nested
generator closures; `render(context)` yields (text, generated) pieces one by one and never holds a whole conversation,
so `messages` may be any iterator.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """The template can't be parsed, or reads what its input doesn't have."""


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Item:
    base: Any
    key: Any


@dataclass
class Op:
    op: str
    args: list


@dataclass
class Filter:
    name: str
    arg: Any


@dataclass
class Text:
    value: str


@dataclass
class Output:
    expr: Any


@dataclass
class If:
    arms: list  # (condition, body)
    rest: list


@dataclass
class For:
    name: str
    source: Any
    body: list


@dataclass
class Set:
    name: str
    expr: Any


@dataclass
class Generation:
    body: list


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<num>\d+)|(?P<str>'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(?P<name>[A-Za-z][A-Za-z0-9_]*)|(?P<op>==|!=|<=|>=|[+~<>()\[\].|]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "not in": lambda a, b: a not in b, "~": lambda a, b: show(a) + show(b),
}


def show(value: Any) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value)


def plus(a: Any, b: Any) -> Any:
    return a + b if isinstance(a, int) and isinstance(b, int) else show(a) + show(b)


_BINARY["+"] = plus


class _Expressions:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r} in {source!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *wanted: str) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        return value if kind in ("op", "name") and value in wanted else None

    def take(self, *wanted: str) -> str | None:
        found = self.peek(*wanted)
        self.at += found is not None
        return found

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def whole(self):
        out = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def choice(self):
        value = self.either()
        if self.take("if"):
            condition = self.either()
            self.need("else")
            return Op("if", [condition, value, self.choice()])
        return value

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Op("or", [left, self.both()])
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Op("and", [left, self.negated()])
        return left

    def negated(self):
        return Op("not", [self.negated()]) if self.take("not") else self.compared()

    def compared(self):
        left = self.summed()
        while op := self.take("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if op == "not":
                self.need("in")
                op = "not in"
            left = Op(op, [left, self.summed()])
        return left

    def summed(self):
        left = self.filtered()
        while op := self.take("+", "~"):
            left = Op(op, [left, self.filtered()])
        return left

    def filtered(self):
        value = self.reached()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
            if kind != "name":
                raise TemplateError("a filter's name is missing")
            self.at += 1
            value = Filter(name, value)
        return value

    def reached(self):
        value = self.single()
        while op := self.take(".", "["):
            if op == ".":
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
                if kind != "name":
                    raise TemplateError("a key is missing behind '.'")
                self.at += 1
                value = Item(value, Const(name))
            else:
                value = Item(value, self.choice())
                self.need("]")
        return value

    def single(self):
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "num":
            return Const(int(value))
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "name":
            return Const(_WORDS[value]) if value in _WORDS else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list:
    """The template's syntax tree: a list of nodes."""
    root: list = []
    stack: list[tuple[str, Any, list]] = [("", None, root)]
    at, trim = 0, False

    def text(value: str, cut: bool) -> None:
        value = value.lstrip() if trim else value
        value = value.rstrip() if cut else value
        if value:
            stack[-1][2].append(Text(value))

    for m in _TAG.finditer(source):
        text(source[at : m.start()], bool(m[1] or m[4]))
        at, trim = m.end(), bool(m[3] or m[6])
        body = stack[-1][2]
        if m[2] is not None:
            body.append(Output(_Expressions(m[2]).whole()))
        elif m[5] is not None:
            word, _, rest = m[5].strip().partition(" ")
            if word == "if":
                node = If([], [])
                body.append(node)
                node.arms.append((_Expressions(rest).whole(), []))
                stack.append(("if", node, node.arms[-1][1]))
            elif word == "elif" and stack[-1][0] == "if":
                node = stack.pop()[1]
                node.arms.append((_Expressions(rest).whole(), []))
                stack.append(("if", node, node.arms[-1][1]))
            elif word == "else" and stack[-1][0] == "if":
                node = stack.pop()[1]
                stack.append(("else", node, node.rest))
            elif word == "for":
                found = re.fullmatch(r"\s*([A-Za-z][A-Za-z0-9_]*)\s+in\s+(.+)", rest, re.S)
                if not found:
                    raise TemplateError(f"for {rest!r}")
                node = For(found[1], _Expressions(found[2]).whole(), [])
                body.append(node)
                stack.append(("for", node, node.body))
            elif word == "generation":
                node = Generation([])
                body.append(node)
                stack.append(("generation", node, node.body))
            elif word == "set":
                found = re.fullmatch(r"\s*([A-Za-z][A-Za-z0-9_]*)\s*=(?!=)\s*(.+)", rest, re.S)
                if not found:
                    raise TemplateError(f"set {rest!r}")
                body.append(Set(found[1], _Expressions(found[2]).whole()))
            elif word in ("endif", "endfor", "endgeneration") and stack[-1][0] in ({"endif": ("if", "else")}.get(word, (word[3:],))):
                stack.pop()
            else:
                raise TemplateError(f"unexpected tag {m[5].strip()!r}")
    text(source[at:], False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} isn't closed")
    return root


def fold_expression(e, filters: Mapping[str, Callable]):
    if isinstance(e, Item):
        return Item(fold_expression(e.base, filters), fold_expression(e.key, filters))
    if isinstance(e, Filter):
        if e.name not in filters:
            raise TemplateError(f"no filter {e.name!r}")
        arg = fold_expression(e.arg, filters)
        return _folded(lambda: filters[e.name](arg.value), Filter(e.name, arg)) if isinstance(arg, Const) else Filter(e.name, arg)
    if isinstance(e, Op):
        args = [fold_expression(a, filters) for a in e.args]
        if e.op == "if" and isinstance(args[0], Const):
            return args[1] if args[0].value else args[2]
        if e.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (e.op == "and") else args[0]
        if all(isinstance(a, Const) for a in args) and e.op in (*_BINARY, "not"):
            values = [a.value for a in args]
            return _folded(lambda: not values[0] if e.op == "not" else _BINARY[e.op](*values), Op(e.op, args))
        return Op(e.op, args)
    return e


def _folded(value: Callable[[], Any], rest):
    """The constant, or the expression as it is: what fails does so only where it is reached."""
    try:
        return Const(value())
    except (TypeError, ValueError):
        return rest


def fold(nodes: list, filters: Mapping[str, Callable]) -> list:
    """Constant expressions become text, decided branches go, neighbouring texts become one."""
    out: list = []
    for n in nodes:
        new = [n]
        if isinstance(n, Output):
            e = fold_expression(n.expr, filters)
            new = [Text(show(e.value))] if isinstance(e, Const) else [Output(e)]
        elif isinstance(n, If):
            arms, rest = [], fold(n.rest, filters)
            for condition, body in n.arms:
                condition = fold_expression(condition, filters)
                if not isinstance(condition, Const):
                    arms.append((condition, fold(body, filters)))
                elif condition.value:
                    rest = fold(body, filters)
                    break
            new = [If(arms, rest)] if arms else rest
        elif isinstance(n, For):
            new = [For(n.name, fold_expression(n.source, filters), fold(n.body, filters))]
        elif isinstance(n, Generation):
            new = [Generation(fold(n.body, filters))]
        elif isinstance(n, Set):
            new = [Set(n.name, fold_expression(n.expr, filters))]
        for x in new:
            if isinstance(x, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].value + x.value)
            elif not (isinstance(x, Text) and not x.value):
                out.append(x)
    return out


def _key(base: Any, key: Any) -> Any:
    if isinstance(base, Mapping):
        return base.get(key)
    if isinstance(base, (list, tuple)) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else None
    raise TemplateError(f"{type(base).__name__} has no {key!r}")


def evaluator(e, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(e, Const):
        return lambda c, v=e.value: v
    if isinstance(e, Name):
        return lambda c, n=e.name: c.get(n)
    if isinstance(e, Item):
        base, key = evaluator(e.base, filters), evaluator(e.key, filters)
        return lambda c: _key(base(c), key(c))
    if isinstance(e, Filter):
        f, arg = filters[e.name], evaluator(e.arg, filters)
        return lambda c: f(arg(c))
    args = [evaluator(a, filters) for a in e.args]
    if e.op == "if":
        return lambda c: args[1](c) if args[0](c) else args[2](c)
    if e.op == "and":
        return lambda c: args[0](c) and args[1](c)
    if e.op == "or":
        return lambda c: args[0](c) or args[1](c)
    if e.op == "not":
        return lambda c: not args[0](c)
    f = _BINARY[e.op]
    return lambda c: f(args[0](c), args[1](c))


Piece = tuple[str, bool]


def closure(nodes: list, filters: Mapping[str, Callable], generated: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_step(n, filters, generated) for n in nodes]

    def run(c: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(c)

    return run


def _step(n, filters: Mapping[str, Callable], generated: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(n, Text):
        piece = (n.value, generated)
        return lambda c: (piece,)
    if isinstance(n, Output):
        value = evaluator(n.expr, filters)
        return lambda c: ((show(value(c)), generated),)
    if isinstance(n, Generation):
        return closure(n.body, filters, True)
    if isinstance(n, Set):
        value = evaluator(n.expr, filters)

        def assign(c: dict):
            c[n.name] = value(c)
            return ()

        return assign
    if isinstance(n, If):
        arms = [(evaluator(e, filters), closure(body, filters, generated)) for e, body in n.arms]
        rest = closure(n.rest, filters, generated)

        def choose(c: dict):
            return next((body for condition, body in arms if condition(c)), rest)(c)

        return choose
    source, body = evaluator(n.source, filters), closure(n.body, filters, generated)

    def loop(c: dict):
        items, index = iter(source(c) or ()), 0
        now = next(items, loop)
        while now is not loop:
            following = next(items, loop)
            inner = {**c, n.name: now, "loop": {"first": index == 0, "last": following is loop, "index0": index, "index": index + 1}}
            yield from body(inner)
            now, index = following, index + 1

    return loop


@dataclass
class Template:
    source: str
    filters: Mapping[str, Callable] = field(default_factory=dict)

    def __post_init__(self):
        self.tree = fold(parse(self.source), self.filters)
        self._run = closure(self.tree, self.filters, False)

    def render(self, context: Mapping[str, Any]) -> Iterator[Piece]:
        """(text, generated) pieces; empty ones are left out."""
        try:
            yield from (p for p in self._run(dict(context)) if p[0])
        except (TypeError, AttributeError) as e:
            raise TemplateError(str(e)) from e


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Template:
    base = {"trim": lambda x: show(x).strip(), "upper": lambda x: show(x).upper(), "lower": lambda x: show(x).lower(), "length": len}
    return Template(source, base | dict(filters or {}))
