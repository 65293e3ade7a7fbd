"""A small sandboxed template language for conversations.

``{{ value }}`` prints, ``{% ... %}`` is a statement, ``{# ... #}`` a comment; a hyphen inside
a mark (``{%-``, ``-%}``) eats the white space beside it.  Statements are ``for x in list``,
``if`` / ``elif`` / ``else``, ``set x = value`` and ``generation``, each but ``set`` closed by
``end...``.  Values are texts, whole numbers, ``true``, ``false``, ``none``, lists, names,
``a.b`` and ``a[b]`` (keys of mappings and places of lists, never Python attributes),
``x if c else y``, ``or and not``, comparisons, ``in``, ``~`` (joins as text), ``+ - * // %`` of
numbers, and filters: ``value | name(arguments)``.  There are no calls, imports or endless
loops, so a template's cost is bounded by its own size and the message's.

A template is parsed into a tree, constant parts are folded, and the rest becomes Python
closures.  Text printed inside ``generation`` is reported as spans of the output.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field


class TemplateError(ValueError):
    """A template that does not follow the language."""


# --- the tree --------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Call:
    """A pure function of its arguments: operators, access, filters."""

    function: Callable
    arguments: tuple


@dataclass(frozen=True)
class Choice:
    """Short-circuits.  ``a or b`` has one node as condition and ``then``, ``a and b`` one as
    condition and ``otherwise``; such a node is computed once.
    """

    condition: object
    then: object
    otherwise: object


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class Assign:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    condition: object
    then: tuple
    otherwise: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- values ----------------------------------------------------------------------------


def to_text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value) if isinstance(value, str | int) else _refuse("print", value)


def _refuse(what: str, *values: object):
    kinds = ", ".join(type(v).__name__ for v in values)
    raise TemplateError(f"cannot {what}: {kinds}")


def _item(holder: object, key: object) -> object:
    """A key of a mapping or a place of a list or text; none where there is no such."""
    if isinstance(holder, dict):
        return holder.get(key)
    if isinstance(holder, list | str) and isinstance(key, int):
        return holder[key] if -len(holder) <= key < len(holder) else None
    return _refuse("look up", holder, key)


def _numbers(function: Callable, what: str) -> Callable:
    def checked(a, b):
        whole = all(isinstance(v, int) and not isinstance(v, bool) for v in (a, b))
        if not whole or (what == "divide" and b == 0):
            _refuse(what, a, b)
        return function(a, b)

    return checked


def _add(a, b):
    if isinstance(a, str) and isinstance(b, str):
        return a + b
    return _numbers(operator.add, "add")(a, b)


def _contains(a, b):
    return a in b if isinstance(b, list | str | dict) else _refuse("search", b)


COMPARISONS = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}
SUMS = {
    "+": _add,
    "-": _numbers(operator.sub, "subtract"),
    "~": lambda a, b: to_text(a) + to_text(b),
}
PRODUCTS = {
    "*": _numbers(operator.mul, "multiply"),
    "//": _numbers(operator.floordiv, "divide"),
    "%": _numbers(operator.mod, "divide"),
}


class Escape:
    """Hides the opener of control strings inside texts, reversibly.

    A backslash goes between the opener's first character and its rest, one more where there
    are some already.  Text so treated holds no opener, hence no control string.
    """

    def __init__(self, opener: str = "<|"):
        if len(opener) < 2 or len(set(opener)) < len(opener) or "\\" in opener:
            raise TemplateError("an opener has two or more different characters, no backslash")
        first, rest = re.escape(opener[0]), re.escape(opener[1:])
        self.opener = opener
        self._plain = re.compile(f"{first}(\\\\*){rest}")
        self._hidden = re.compile(f"{first}\\\\(\\\\*){rest}")

    def hide(self, text: str) -> str:
        mark = self.opener
        if mark[0] not in text:
            return text
        return self._plain.sub(lambda m: f"{mark[0]}\\{m[1]}{mark[1:]}", text)

    def show(self, text: str) -> str:
        mark = self.opener
        return self._hidden.sub(lambda m: f"{mark[0]}{m[1]}{mark[1:]}", text)

    def hide_line(self, text: str) -> str:
        """The same for text that must stay on one line."""
        return self.hide(text).replace("\\", "\\\\").replace("\n", "\\n")

    def show_line(self, text: str) -> str:
        plain = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)
        return self.show(plain)


def filters_of(escape: Escape) -> dict[str, Callable]:
    return {
        "escape": lambda v: escape.hide(to_text(v)),
        "escape_line": lambda v: escape.hide_line(to_text(v)),
        "trim": lambda v: to_text(v).strip(),
        "upper": lambda v: to_text(v).upper(),
        "lower": lambda v: to_text(v).lower(),
        "length": lambda v: len(v) if isinstance(v, str | list | dict) else _refuse("measure", v),
        "default": lambda v, other: other if v is None else v,
        "replace": lambda v, a, b: to_text(v).replace(a, b) if a else _refuse("replace", a),
        "join": lambda v, by="": by.join(map(to_text, v)),
        "first": lambda v: _item(v, 0),
        "last": lambda v: _item(v, -1),
    }


# --- parsing ---------------------------------------------------------------------------

_MARKS = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#-?.*?-?#\})", re.DOTALL)
_TOKENS = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<sign>==|!=|<=|>=|//|[-+~*%<>()\[\].,|=:]))",
    re.DOTALL,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_KEYWORDS = {"if", "else", "and", "or", "not", "in"}


def _tokens(code: str) -> list[tuple[str, str]]:
    found, at = [], 0
    code = code.rstrip()
    while at < len(code):
        match = _TOKENS.match(code, at)
        if not match:
            raise TemplateError(f"cannot read {code[at:at + 20]!r}")
        found.append((match.lastgroup, match[match.lastgroup]))
        at = match.end()
    return found


class _Expression:
    """Recursive descent over the tokens of one mark."""

    def __init__(self, code: str, filters: dict[str, Callable]):
        self.tokens, self.at, self.filters = _tokens(code), 0, filters

    def peek(self, *wanted: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][1] in wanted and (
            self.tokens[self.at][0] != "text"
        )

    def take(self, *wanted: str) -> str | None:
        if self.peek(*wanted):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def value(self):
        then = self.either()
        if not self.take("if"):
            return then
        condition = self.either()
        otherwise = self.value() if self.take("else") else Const(None)
        return Choice(condition, then, otherwise)

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Choice(left, left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Choice(left, self.negated(), left)
        return left

    def negated(self):
        if self.take("not"):
            return Call(operator.not_, (self.negated(),))
        left = self.chain(self.product, SUMS)
        if sign := self.take(*COMPARISONS):
            return Call(COMPARISONS[sign], (left, self.chain(self.product, SUMS)))
        if self.take("in"):
            return Call(_contains, (left, self.chain(self.product, SUMS)))
        if self.take("not"):
            self.need("in")
            found = Call(_contains, (left, self.chain(self.product, SUMS)))
            return Call(operator.not_, (found,))
        return left

    def product(self):
        return self.chain(self.filtered, PRODUCTS)

    def chain(self, part: Callable, signs: dict[str, Callable]):
        left = part()
        while sign := self.take(*signs):
            left = Call(signs[sign], (left, part()))
        return left

    def filtered(self):
        value = self.primary()
        while True:
            if self.take("."):
                value = Call(_item, (value, Const(self.name())))
            elif self.take("["):
                value = Call(_item, (value, self.value()))
                self.need("]")
            elif self.take("|"):
                name = self.name()
                if name not in self.filters:
                    raise TemplateError(f"unknown filter {name!r}")
                rest = self.list_until(")") if self.take("(") else ()
                value = Call(self.filters[name], (value, *rest))
            else:
                return value

    def list_until(self, close: str) -> tuple:
        found = []
        while not self.take(close):
            found.append(self.value())
            if not self.peek(close):
                self.need(",")
        return tuple(found)

    def primary(self):
        if self.take("("):
            value = self.value()
            self.need(")")
            return value
        if self.take("["):
            return Call(lambda *items: list(items), self.list_until("]"))
        if self.take("-"):
            return Call(SUMS["-"], (Const(0), self.filtered()))
        if self.at >= len(self.tokens):
            raise TemplateError("expected a value")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            body = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
            return Const(body)
        if kind == "number":
            return Const(int(token))
        if kind == "name" and token.lower() in _WORDS:
            return Const(_WORDS[token.lower()])
        if kind == "name" and token not in _KEYWORDS:
            return Name(token)
        raise TemplateError(f"unexpected {token!r}")


class _Parser:
    def __init__(self, source: str, filters: dict[str, Callable]):
        self.filters = filters
        self.parts: list[tuple[str, str]] = []
        pieces = _MARKS.split(source)
        for i, piece in enumerate(pieces):
            if i % 2:
                inner = piece[2:-2]
                self.parts.append((piece[1], inner.removeprefix("-").removesuffix("-").strip()))
                continue
            if i and pieces[i - 1][-3] == "-":
                piece = piece.lstrip()
            if i + 1 < len(pieces) and pieces[i + 1][2] == "-":
                piece = piece.rstrip()
            if re.search(r"\{[{%#]", piece):
                raise TemplateError("a mark is not closed")
            self.parts.append(("", piece))
        self.at = 0

    def parse(self) -> tuple:
        body, closing = self.body(())
        assert not closing
        return body

    def body(self, closers: tuple[str, ...]) -> tuple[tuple, str]:
        """Nodes up to one of the closing statements, and that statement."""
        nodes = []
        while self.at < len(self.parts):
            kind, code = self.parts[self.at]
            self.at += 1
            if kind == "" and code:
                nodes.append(Print(Const(code)))
            elif kind == "{":
                nodes.append(Print(self.expression(code)))
            elif kind == "%":
                word, _, rest = code.partition(" ")
                if word in closers:
                    return tuple(nodes), code
                nodes.append(self.statement(word, rest))
        if closers:
            raise TemplateError(f"expected {' or '.join(closers)}")
        return tuple(nodes), ""

    def expression(self, code: str):
        reader = _Expression(code, self.filters)
        value = reader.value()
        reader.end()
        return value

    def statement(self, word: str, rest: str):
        if word == "if":
            return self.branches(rest)
        if word == "set":
            reader = _Expression(rest, self.filters)
            name = reader.name()
            reader.need("=")
            value = reader.value()
            reader.end()
            return Assign(name, value)
        if word == "for":
            reader = _Expression(rest, self.filters)
            name = reader.name()
            reader.need("in")
            items = reader.value()
            reader.end()
            return For(name, items, self.body(("endfor",))[0])
        if word == "generation" and not rest:
            return Generation(self.body(("endgeneration",))[0])
        raise TemplateError(f"unknown statement {word!r}")

    def branches(self, condition: str):
        then, closing = self.body(("elif", "else", "endif"))
        word, _, rest = closing.partition(" ")
        if word == "elif":
            otherwise = (self.branches(rest),)
        else:
            otherwise = self.body(("endif",))[0] if word == "else" else ()
        return If(self.expression(condition), then, otherwise)


# --- folding ---------------------------------------------------------------------------


def fold(node, known: dict[str, object]):
    """The expression with every constant part computed."""
    match node:
        case Name(name) if name in known:
            return Const(known[name])
        case Call(function, arguments):
            folded = tuple(fold(a, known) for a in arguments)
            if all(isinstance(a, Const) for a in folded):
                return Const(function(*[a.value for a in folded]))
            return Call(function, folded)
        case Choice(condition, then, otherwise):
            chosen = fold(condition, known)
            if isinstance(chosen, Const):
                return fold(then if chosen.value else otherwise, known)
            yes = chosen if then is condition else fold(then, known)
            no = chosen if otherwise is condition else fold(otherwise, known)
            return Choice(chosen, yes, no)
    return node


def fold_body(nodes: Sequence, known: dict[str, object]) -> tuple:
    """Constant branches chosen, constant prints joined; a name set anew is unknown after."""
    done: list = []
    known = dict(known)
    for node in nodes:
        match node:
            case Print(value):
                value = fold(value, known)
                if isinstance(value, Const):
                    value = Const(to_text(value.value))
                    if done and isinstance(done[-1], Print) and isinstance(done[-1].value, Const):
                        value = Const(done.pop().value.value + value.value)
                done.append(Print(value))
            case Assign(name, value):
                value = fold(value, known)
                if isinstance(value, Const):
                    known[name] = value.value
                else:
                    known.pop(name, None)
                done.append(Assign(name, value))
            case If(condition, then, otherwise):
                condition = fold(condition, known)
                if isinstance(condition, Const):
                    chosen = fold_body(then if condition.value else otherwise, known)
                    done.extend(chosen)
                    changed = _assigned(chosen)
                else:
                    then, otherwise = fold_body(then, known), fold_body(otherwise, known)
                    done.append(If(condition, then, otherwise))
                    changed = _assigned(then) | _assigned(otherwise)
                for name in changed:
                    known.pop(name, None)
            case For(name, items, body):
                inner = {k: v for k, v in known.items() if k not in _assigned(body)}
                for hidden in (name, "loop"):
                    inner.pop(hidden, None)
                done.append(For(name, fold(items, known), fold_body(body, inner)))
            case Generation(body):
                folded = fold_body(body, known)
                done.append(Generation(folded))
                for name in _assigned(folded):
                    known.pop(name, None)
    return tuple(done)


def _assigned(nodes: Sequence) -> set[str]:
    """Names that statements set for what follows them; a loop keeps its own to itself."""
    names: set[str] = set()
    for node in nodes:
        match node:
            case Assign(name, _):
                names.add(name)
            case If(_, then, otherwise):
                names |= _assigned(then) | _assigned(otherwise)
            case Generation(body):
                names |= _assigned(body)
    return names


# --- closures --------------------------------------------------------------------------


@dataclass
class Output:
    """What has been printed, and the spans of it inside ``generation``."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    inside: bool = False

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def value_closure(node) -> Callable[[dict], object]:
    match node:
        case Const(value):
            return lambda env: value
        case Name(name):
            return lambda env: env.get(name)
        case Call(function, (only,)):
            one = value_closure(only)
            return lambda env: function(one(env))
        case Call(function, arguments):
            several = [value_closure(a) for a in arguments]
            return lambda env: function(*[a(env) for a in several])
        case Choice(condition, then, otherwise):
            test = value_closure(condition)
            if then is condition:
                other = value_closure(otherwise)
                return lambda env: test(env) or other(env)
            if otherwise is condition:
                other = value_closure(then)
                return lambda env: test(env) and other(env)
            yes, no = value_closure(then), value_closure(otherwise)
            return lambda env: yes(env) if test(env) else no(env)
    raise TypeError(node)


def body_closure(nodes: Sequence) -> Callable[[dict, Output], None]:
    steps = [_step(node) for node in nodes]

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def _step(node) -> Callable[[dict, Output], None]:
    match node:
        case Print(Const(text)):
            return lambda env, out: out.put(text)
        case Print(value):
            read = value_closure(value)
            return lambda env, out: out.put(to_text(read(env)))
        case Assign(name, value):
            read = value_closure(value)

            def assign(env, out):
                env[name] = read(env)

            return assign
        case If(condition, then, otherwise):
            test, yes, no = value_closure(condition), body_closure(then), body_closure(otherwise)
            return lambda env, out: yes(env, out) if test(env) else no(env, out)
        case For(name, items, body):
            read, inner = value_closure(items), body_closure(body)

            def loop(env, out):
                found = read(env)
                if not isinstance(found, list):
                    _refuse("loop over", found)
                run_loop(name, found, 0, len(found), inner, env, out)

            return loop
        case Generation(body):
            inner = body_closure(body)

            def generation(env, out):
                if out.inside:
                    raise TemplateError("generation inside generation")
                out.inside, start = True, out.length
                inner(env, out)
                out.inside = False
                out.spans.append((start, out.length))

            return generation
    raise TypeError(node)


def run_loop(name, items, first, total, inner, env, out) -> None:
    for i, item in enumerate(items, first):
        place = {"index": i + 1, "index0": i, "first": i == 0, "last": i + 1 == total}
        inner({**env, name: item, "loop": {**place, "length": total}}, out)


def _uses(node, name: str) -> bool:
    if isinstance(node, Name):
        return node.name == name
    if isinstance(node, tuple):
        return any(_uses(n, name) for n in node)
    if isinstance(node, Const) or not hasattr(node, "__dataclass_fields__"):
        return False
    return any(_uses(getattr(node, f), name) for f in node.__dataclass_fields__)


class Template:
    """A compiled template over ``messages``, a list of mappings.

    It must hold exactly one loop over ``messages``, at its top level, and use them nowhere
    else: then a conversation can be rendered piece by piece, each on another machine.
    ``variables`` are constants and are folded in; other names are ``none``.
    """

    def __init__(self, source: str, opener: str = "<|", variables: dict | None = None):
        self.source, self.opener, self.variables = source, opener, dict(variables or {})
        filters = filters_of(Escape(opener))
        self.tree = fold_body(_Parser(source, filters).parse(), self.variables)
        loops = [
            i
            for i, node in enumerate(self.tree)
            if isinstance(node, For) and node.items == Name("messages")
        ]
        rest = [n.body if i in loops else n for i, n in enumerate(self.tree)]
        if len(loops) != 1 or _uses(tuple(rest), "messages"):
            raise TemplateError("a template needs one loop over messages at its top level")
        (at,) = loops
        self._name = self.tree[at].name
        self._before = body_closure(self.tree[:at])
        self._turn = body_closure(self.tree[at].body)
        self._after = body_closure(self.tree[at + 1 :])

    def __reduce__(self):
        return Template, (self.source, self.opener, self.variables)

    def render(
        self, messages: list[dict], first: int = 0, total: int | None = None
    ) -> tuple[str, list[tuple[int, int]]]:
        """The text of messages ``first`` and following of ``total``, and its generated spans.

        What stands before the loop is printed with the first message, what stands after it
        with the last.  Spans are in code points of the returned text.
        """
        total = first + len(messages) if total is None else total
        env: dict = {}
        out, unseen = Output(), Output()
        self._before(env, out if first == 0 else unseen)
        run_loop(self._name, messages, first, total, self._turn, env, out)
        if first + len(messages) == total:
            self._after(env, out)
        return "".join(out.parts), out.spans
