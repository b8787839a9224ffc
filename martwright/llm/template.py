"""A small sandboxed template language, compiled to Python closures.

Syntax: text, ``{{ expression }}``, ``{% for x in expression %}``, ``{% if %} {% elif %} {% else %}``,
``{% set x = expression %}``, ``{% generation %} ... {% endgeneration %}`` and ``{# comment #}``. Expressions have
string, integer, true/false/none literals, names, ``a.b`` and ``a['b']`` (keys of mappings only), ``== != < > in``,
``and or not``, ``+`` and ``~`` (joins as text), parentheses and the filters in :data:`FILTERS`. Nothing can be called
and no Python attribute is reachable.

A template is parsed into a syntax tree, constant parts are folded, and the rest becomes closures. Rendering is lazy:
it yields (text, inside a generation block) and takes any iterable of messages, so a conversation of any length passes
through with one message of look-ahead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

Env = dict[str, Any]


class TemplateError(ValueError):
    """The template can't be parsed, or asks for what the sandbox doesn't have."""


def escape_marks(text: str) -> str:
    """Make ``<|`` impossible in ``text``: a backslash goes into ``<``, any backslashes, ``|``. Reversible."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape_marks(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def one_line(text: str) -> str:
    """Put a text on one line, reversibly."""
    return text.replace("\\", "\\\\").replace("\n", "\\n")


def many_lines(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable[..., Any]] = {
    "escape": lambda v: escape_marks(_text(v)),
    "line": lambda v: one_line(_text(v)),
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else len(_text(v)),
    "default": lambda v, other="": other if v is None else v,
}


# Syntax tree ------------------------------------------------------------------------------------------------------


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Get:
    of: Any
    key: Any


@dataclass
class Op:
    kind: str
    parts: list


@dataclass
class Filter:
    name: str
    of: Any
    more: list


@dataclass
class Out:
    value: Any


@dataclass
class Set_:
    name: str
    value: Any


@dataclass
class For:
    name: str
    over: Any
    body: list


@dataclass
class If:
    branches: list = field(default_factory=list)  #: (condition, body)


@dataclass
class Generation:
    body: list


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(
    r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[<>+~|().,\[\]]))",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def parse(self) -> Any:
        tree = self._either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def _peek(self, *texts: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in texts

    def _take(self, *texts: str) -> bool:
        if self._peek(*texts):
            self.at += 1
            return True
        return False

    def _need(self, text: str) -> None:
        if not self._take(text):
            raise TemplateError(f"{text!r} is missing")

    def _either(self) -> Any:
        parts = [self._both()]
        while self._take("or"):
            parts.append(self._both())
        return parts[0] if len(parts) == 1 else Op("or", parts)

    def _both(self) -> Any:
        parts = [self._not()]
        while self._take("and"):
            parts.append(self._not())
        return parts[0] if len(parts) == 1 else Op("and", parts)

    def _not(self) -> Any:
        return Op("not", [self._not()]) if self._take("not") else self._compared()

    def _compared(self) -> Any:
        left = self._joined()
        for kind in ("==", "!=", "<", ">", "in"):
            if self._take(kind):
                return Op(kind, [left, self._joined()])
        return left

    def _joined(self) -> Any:
        tree = self._filtered()
        while self._peek("+", "~"):
            kind = self.tokens[self.at][1]
            self.at += 1
            tree = Op(kind, [tree, self._filtered()])
        return tree

    def _filtered(self) -> Any:
        tree = self._reached()
        while self._take("|"):
            name = self._word()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            more = []
            if self._take("("):
                while not self._take(")"):
                    more.append(self._either())
                    self._take(",")
            tree = Filter(name, tree, more)
        return tree

    def _word(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def _reached(self) -> Any:
        tree = self._atom()
        while True:
            if self._take("."):
                tree = Get(tree, Const(self._word()))
            elif self._take("["):
                tree = Get(tree, self._either())
                self._need("]")
            else:
                return tree

    def _atom(self) -> Any:
        if self._take("("):
            tree = self._either()
            self._need(")")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(text))
        if kind == "name":
            return Const(_WORDS[text]) if text in _WORDS else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> list:
    """The syntax tree of a template."""
    root: list = []
    open_tags: list[tuple[str, Any, list]] = []
    body, at = root, 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            body.append(Out(Const(source[at : m.start()])))
        at = m.end()
        if m[1] is not None:
            body.append(Out(_Expression(m[1]).parse()))
        elif m[2] is not None:
            word, _, rest = m[2].strip().partition(" ")
            if word == "for":
                name, found, over = rest.partition(" in ")
                if not found or not name.strip().isidentifier():
                    raise TemplateError("write: for name in expression")
                node: Any = For(name.strip(), _Expression(over).parse(), [])
                body.append(node)
                open_tags.append(("endfor", node, body))
                body = node.body
            elif word == "if":
                node = If([(_Expression(rest).parse(), [])])
                body.append(node)
                open_tags.append(("endif", node, body))
                body = node.branches[-1][1]
            elif word in ("elif", "else"):
                if not open_tags or open_tags[-1][0] != "endif":
                    raise TemplateError(f"{word} without if")
                node = open_tags[-1][1]
                node.branches.append((_Expression(rest).parse() if word == "elif" else Const(True), []))
                body = node.branches[-1][1]
            elif word == "generation":
                node = Generation([])
                body.append(node)
                open_tags.append(("endgeneration", node, body))
                body = node.body
            elif word == "set":
                name, found, value = rest.partition("=")
                if not found or not name.strip().isidentifier():
                    raise TemplateError("write: set name = expression")
                body.append(Set_(name.strip(), _Expression(value).parse()))
            elif open_tags and word == open_tags[-1][0]:
                _, _, body = open_tags.pop()
            else:
                raise TemplateError(f"unexpected {word!r}")
    if open_tags:
        raise TemplateError(f"{open_tags[-1][0]} is missing")
    if at < len(source):
        body.append(Out(Const(source[at:])))
    return root


# Folding ----------------------------------------------------------------------------------------------------------


def _apply(kind: str, values: list) -> Any:
    if kind == "not":
        return not values[0]
    a, b = values
    if kind == "+":
        return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)
    if kind == "~":
        return _text(a) + _text(b)
    if kind == "in":
        return a in b if isinstance(b, (str, list, tuple, dict)) else False
    if kind in "<>" and (a is None or b is None):
        return False
    return {"==": a == b, "!=": a != b}[kind] if kind in ("==", "!=") else a < b if kind == "<" else a > b


def fold_expression(tree: Any) -> Any:
    if isinstance(tree, Get):
        return Get(fold_expression(tree.of), fold_expression(tree.key))
    if isinstance(tree, Filter):
        of, more = fold_expression(tree.of), [fold_expression(x) for x in tree.more]
        if all(isinstance(x, Const) for x in (of, *more)):
            return Const(FILTERS[tree.name](of.value, *(x.value for x in more)))
        return Filter(tree.name, of, more)
    if isinstance(tree, Op):
        parts = [fold_expression(x) for x in tree.parts]
        if tree.kind in ("and", "or"):
            stop = tree.kind == "or"
            left: list = []
            for x in parts:
                if isinstance(x, Const) and x is not parts[-1] and bool(x.value) is not stop:
                    continue
                left.append(x)
                if isinstance(x, Const) and bool(x.value) is stop:
                    break
            return left[0] if len(left) == 1 else Op(tree.kind, left)
        if all(isinstance(x, Const) for x in parts):
            return Const(_apply(tree.kind, [x.value for x in parts]))
        return Op(tree.kind, parts)
    return tree


def fold(body: list) -> list:
    """Fold constants: constant output becomes text, neighbouring texts merge, dead branches go."""
    out: list = []
    for node in body:
        if isinstance(node, Out):
            value = fold_expression(node.value)
            value = Const(_text(value.value)) if isinstance(value, Const) else value
            if isinstance(value, Const) and out and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                out[-1] = Out(Const(out[-1].value.value + value.value))
            elif not isinstance(value, Const) or value.value:
                out.append(Out(value))
        elif isinstance(node, Set_):
            out.append(Set_(node.name, fold_expression(node.value)))
        elif isinstance(node, For):
            out.append(For(node.name, fold_expression(node.over), fold(node.body)))
        elif isinstance(node, Generation):
            out.append(Generation(fold(node.body)))
        else:
            branches = []
            for condition, inner in node.branches:
                condition = fold_expression(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner)))
                if isinstance(condition, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                out += branches[0][1]
            elif branches:
                out.append(If(branches))
    return out


# Closures ---------------------------------------------------------------------------------------------------------


def _value(tree: Any) -> Callable[[Env], Any]:
    if isinstance(tree, Const):
        value = tree.value
        return lambda env: value
    if isinstance(tree, Name):
        name = tree.name
        return lambda env: env.get(name)
    if isinstance(tree, Get):
        of, key = _value(tree.of), _value(tree.key)

        def get(env: Env) -> Any:
            holder = of(env)
            return holder.get(key(env)) if isinstance(holder, Mapping) else None

        return get
    if isinstance(tree, Filter):
        work, of, more = FILTERS[tree.name], _value(tree.of), [_value(x) for x in tree.more]
        return lambda env: work(of(env), *(x(env) for x in more))
    kind, parts = tree.kind, [_value(x) for x in tree.parts]
    if kind in ("and", "or"):
        stop = kind == "or"

        def either(env: Env) -> Any:
            value = None
            for part in parts:
                value = part(env)
                if bool(value) is stop:
                    break
            return value

        return either
    return lambda env: _apply(kind, [x(env) for x in parts])


Run = Callable[[Env], Iterator[tuple[str, bool]]]


def _sequence(body: list) -> Run:
    runs = [_node(x) for x in body]

    def run(env: Env) -> Iterator[tuple[str, bool]]:
        for r in runs:
            yield from r(env)

    return runs[0] if len(runs) == 1 else run


def _node(node: Any) -> Run:
    if isinstance(node, Out):
        value = _value(node.value)

        def out(env: Env) -> Iterator[tuple[str, bool]]:
            yield _text(value(env)), False

        return out
    if isinstance(node, Set_):
        name, value = node.name, _value(node.value)

        def assign(env: Env) -> Iterator[tuple[str, bool]]:
            env[name] = value(env)
            yield from ()

        return assign
    if isinstance(node, Generation):
        body = _sequence(node.body)

        def generation(env: Env) -> Iterator[tuple[str, bool]]:
            yield "".join(text for text, _ in body(env)), True

        return generation
    if isinstance(node, For):
        name, over, body = node.name, _value(node.over), _sequence(node.body)

        def loop(env: Env) -> Iterator[tuple[str, bool]]:
            items = iter(over(env) or ())
            missing = object()
            item, i = next(items, missing), 0
            while item is not missing:
                after = next(items, missing)
                place = {"index0": i, "index": i + 1, "first": i == 0, "last": after is missing}
                yield from body({**env, name: item, "loop": place})
                item, i = after, i + 1

        return loop
    branches = [(_value(condition), _sequence(inner)) for condition, inner in node.branches]

    def choose(env: Env) -> Iterator[tuple[str, bool]]:
        for condition, inner in branches:
            if condition(env):
                yield from inner(env)
                return

    return choose


class Template:
    """A compiled template."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.tree = fold(parse(source))
        self._run = _sequence(self.tree)

    def __reduce__(self):
        return Template, (self.source,)

    def render(self, messages: Iterable[Mapping[str, Any]], **names: Any) -> Iterator[tuple[str, bool]]:
        """Text in order, and whether it was made inside a generation block."""
        return (x for x in self._run({"messages": messages, **names}) if x[0])
