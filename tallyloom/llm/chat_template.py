"""Chat formatting: a compiler from a small sandboxed template language to Python closures.

A template is parsed into a syntax tree, constant parts of the tree are folded, and the tree becomes nested closures that write
pieces of text and note the spans between `{% generation %}` and `{% endgeneration %}`, which a trainer takes as the loss mask.

The language: text, `{{ expression }}`, `{# comment #}`, `for`, `if`/`elif`/`else`, `set`, `generation`; a `-` inside a tag takes
white space away. Expressions have literals, names, `.key` and `[index]` on maps and lists, filters, comparison, arithmetic, `~`,
`and`, `or`, `not`, `in`, `a if b else c`. It is a sandbox because there is nothing else: no calls, no attributes of Python
objects, no loops but over given lists. Expressions and statements nest up to `DEEPEST`, and no tree is higher than `HIGHEST`. `-`, `*`
and `%` are for numbers, `+` is for two numbers or two texts; numbers have 64 bits, and a text that `+`, `~` or `replace` makes
longer than its parts has up to `LONGEST` code points. Whatever does not hold to this is a `TemplateError`.

Control strings (anything that begins with `<|`) cannot come from a text: `escape` puts one more backslash between `<` and `|`,
and reading back takes one away, whatever the text had there.

Rows with a null conv_id belong to no conversation and are left out. A null text or role is empty. Turns are ordered by turn
(null first), then role, then text; repeated rows are turns of their own. Columns other than these four are not read. A
conversation is one row of the result, so it has to fit into memory; nothing in it is cut. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common

CHATML = (
    "{% for m in messages %}<|im_start|>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.content | escape }}{% endgeneration %}"
    "{% else %}{{ m.content | escape }}{% endif %}<|im_end|>\n{% endfor %}"
    "{% if add_generation_prompt %}<|im_start|>assistant\n{% endif %}"
)
DEEPEST = 50
HIGHEST = 200
LONGEST = 1 << 28
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\+)\|")


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    return _OPENING.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "<" + m[1][1:] + "|", text)


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "<|nl|>")


def unescape_line(text: str) -> str:
    return unescape(text.replace("<|nl|>", "\n"))


def _joined(a: Any, b: Any) -> str:
    a, b = _text(a), _text(b)
    if len(a) + len(b) > LONGEST:
        raise TemplateError("the text gets too long")
    return a + b


def _replaced(x: Any, a: Any, b: Any) -> str:
    x, a, b = _text(x), _text(a), _text(b)
    if len(b) > len(a) and len(x) + x.count(a) * (len(b) - len(a)) > max(LONGEST, len(x)):
        raise TemplateError("the text gets too long")
    return x.replace(a, b)


def _number(work: Callable[[Any, Any], Any]) -> Callable[[Any, Any], Any]:
    def apply(a: Any, b: Any) -> Any:
        if not (isinstance(a, (int, float)) and isinstance(b, (int, float))):
            raise TemplateError("arithmetic is for numbers")
        found = work(a, b)
        if abs(found) >= 1 << 63:
            raise TemplateError("the number gets too large")
        return found

    return apply


def _sum(a: Any, b: Any) -> Any:
    return _joined(a, b) if isinstance(a, str) and isinstance(b, str) else _number(operator.add)(a, b)


def _checked(work: Callable[..., Any], what: str) -> Callable[..., Any]:
    """Values of the wrong kind, or too many of them, are a fault of the template."""

    def apply(*values: Any) -> Any:
        try:
            return work(*values)
        except (TypeError, ArithmeticError) as problem:
            raise TemplateError(f"{what}: {problem}") from None

    return apply


FILTERS: dict[str, Callable[..., Any]] = {
    "escape": lambda x: escape(_text(x)), "escape_line": lambda x: escape_line(_text(x)), "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "length": len,
    "default": lambda x, other="": other if x is None else x, "replace": _replaced,
}
BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "+": _sum, "-": _number(operator.sub), "*": _number(operator.mul), "%": _number(operator.mod), "~": _joined,
    "in": lambda a, b: a in b,
}
# Binding strength, weakest first.
LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("~",), ("+", "-"), ("*", "%"))


def _text(value: Any) -> str:
    return "" if value is None else str(value)


# -- syntax tree -----------------------------------------------------------------------------------


@dataclass
class Node:
    kind: str
    value: Any = None
    parts: list[Node] = field(default_factory=list)
    height: int = field(init=False)

    def __post_init__(self) -> None:
        self.height = 1 + max((p.height for p in self.parts), default=0)
        if self.height > HIGHEST:
            raise TemplateError("nested too deeply")


_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|<=|>=|[-<>+*%~|.,()\[\]]))"""
)
_BACKSLASHED = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


class Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        while source[at:].strip():
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup or "", found[found.lastgroup or 0]))
            at = found.end()
        self.at = 0
        self.depth = 0

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else ""

    def take(self, wanted: str = "") -> tuple[str, str]:
        if self.at >= len(self.tokens) or wanted and self.peek() != wanted:
            raise TemplateError(f"expected {wanted or 'more'} after {[t for _, t in self.tokens[: self.at]]}")
        self.at += 1
        return self.tokens[self.at - 1]

    def name(self) -> str:
        kind, text = self.take()
        if kind != "name":
            raise TemplateError(f"{text!r} is not a name")
        return text

    def whole(self) -> Node:
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def deeper(self) -> None:
        self.depth += 1
        if self.depth > DEEPEST:
            raise TemplateError("nested too deeply")

    def choice(self) -> Node:
        self.deeper()
        node = self.level(0)
        if self.peek() == "if":
            self.take()
            test = self.level(0)
            self.take("else")
            node = Node("choice", None, [test, node, self.choice()])
        self.depth -= 1
        return node

    def level(self, k: int) -> Node:
        if k == len(LEVELS):
            return self.filtered()
        if LEVELS[k] == ("not",):
            times = 0
            while self.peek() == "not":
                self.take()
                times += 1
            node = self.level(k + 1)
            # Two of them make a truth value of whatever there is.
            for _ in range(min(times, 2 - times % 2)):
                node = Node("not", None, [node])
            return node
        node = self.level(k + 1)
        while self.peek() in LEVELS[k]:
            mark = self.take()[1]
            node = Node(mark if mark in ("and", "or") else "binary", mark, [node, self.level(k + 1)])
        return node

    def filtered(self) -> Node:
        node = self.postfix()
        while self.peek() == "|":
            self.take()
            name, parts = self.name(), [node]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.peek() == "(":
                self.take()
                while self.peek() != ")":
                    parts.append(self.choice())
                    if self.peek() != ")":
                        self.take(",")
                self.take(")")
            node = Node("filter", name, parts)
        return node

    def postfix(self) -> Node:
        node = self.atom()
        while self.peek() in (".", "["):
            if self.take()[1] == ".":
                node = Node("item", None, [node, Node("constant", self.name())])
            else:
                node = Node("item", None, [node, self.choice()])
                self.take("]")
        return node

    def atom(self) -> Node:
        kind, text = self.take()
        if kind == "text":
            return Node("constant", re.sub(r"\\(.)", lambda m: _BACKSLASHED.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            # No 64-bit number has more digits.
            if len(text) > 19 or int(text) >= 1 << 63:
                raise TemplateError("the number is too large")
            return Node("constant", int(text))
        if kind == "name":
            return Node("constant", _WORDS[text]) if text in _WORDS else Node("name", text)
        if text == "(":
            node = self.choice()
            self.take(")")
            return node
        if text == "-":
            self.deeper()
            node = Node("binary", "-", [Node("constant", 0), self.postfix()])
            self.depth -= 1
            return node
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> Node:
    """The tree of a whole template."""
    pieces = _TAG.split(source)
    for k in range(1, len(pieces), 2):
        if pieces[k].startswith(("{{-", "{%-")):
            pieces[k - 1] = pieces[k - 1].rstrip()
        if pieces[k].endswith(("-}}", "-%}")):
            pieces[k + 1] = pieces[k + 1].lstrip()
    at = depth = 0

    def block(*ends: str) -> tuple[Node, str, str]:
        nonlocal at
        parts: list[Node] = []
        while at < len(pieces):
            piece, tag = pieces[at], at % 2 == 1
            at += 1
            if not tag:
                if piece:
                    parts.append(Node("text", piece))
                continue
            body = piece[2:-2].strip("-").strip()
            if piece.startswith("{{"):
                parts.append(Node("write", None, [Expression(body).whole()]))
            elif piece.startswith("{%"):
                word, _, rest = body.partition(" ")
                if word in ends:
                    return Node("block", None, parts), word, rest
                parts.append(statement(word, rest.strip()))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return Node("block", None, parts), "", ""

    def statement(word: str, rest: str) -> Node:
        nonlocal depth
        depth += 1
        if depth > DEEPEST:
            raise TemplateError("nested too deeply")
        node = inner(word, rest)
        depth -= 1
        return node

    def inner(word: str, rest: str) -> Node:
        if word == "for":
            name, _, of = rest.partition(" in ")
            return Node("for", Expression(name).name(), [Expression(of).whole(), block("endfor")[0]])
        if word == "if":
            test = Expression(rest).whole()
            inside, end, more = block("elif", "else", "endif")
            if end == "elif":
                return Node("if", None, [test, inside, statement("if", more.strip())])
            other = block("endif")[0] if end == "else" else Node("block")
            return Node("if", None, [test, inside, other])
        if word == "set":
            name, _, of = rest.partition("=")
            return Node("set", Expression(name).name(), [Expression(of).whole()])
        if word == "generation":
            return Node("generation", None, [block("endgeneration")[0]])
        raise TemplateError(f"no statement {word!r}")

    return block()[0]


# -- folding ---------------------------------------------------------------------------------------


def fold(node: Node) -> Node:
    """The same tree with constant expressions computed, decided branches chosen and neighbouring texts joined."""
    parts = [fold(p) for p in node.parts]
    node = Node(node.kind, node.value, parts)
    constant = [p.kind == "constant" for p in parts]
    if node.kind in ("binary", "not", "filter", "item") and all(constant):
        return Node("constant", _expression(node)({}))
    if node.kind in ("choice", "if") and constant[0]:
        return parts[1] if parts[0].value else parts[2]
    if node.kind in ("and", "or") and constant[0]:
        return parts[1] if bool(parts[0].value) == (node.kind == "and") else parts[0]
    if node.kind == "write" and constant[0]:
        return Node("text", _text(parts[0].value))
    if node.kind == "block":
        joined: list[Node] = []
        for part in (q for p in parts for q in (p.parts if p.kind == "block" else [p])):
            if part.kind == "text" and joined and joined[-1].kind == "text":
                joined[-1] = Node("text", joined[-1].value + part.value)
            elif part.kind != "text" or part.value:
                joined.append(part)
        return Node("block", None, joined)
    return node


# -- closures --------------------------------------------------------------------------------------

Env = dict[str, Any]


def _item(of: Any, key: Any) -> Any:
    if isinstance(of, dict):
        return of.get(key) if isinstance(key, (str, int)) else None
    if isinstance(of, (list, str)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    return None


def _expression(node: Node) -> Callable[[Env], Any]:
    kind, value = node.kind, node.value
    parts = [_expression(p) for p in node.parts]
    if kind == "constant":
        return lambda env: value
    if kind == "name":
        return lambda env: env.get(value)
    if kind == "item":
        of, key = parts
        if node.parts[1].kind == "constant":
            key_value = node.parts[1].value
            return lambda env: _item(of(env), key_value)
        return lambda env: _item(of(env), key(env))
    if kind == "filter":
        apply = _checked(FILTERS[value], value)
        if len(parts) == 1:
            only = parts[0]
            return lambda env: apply(only(env))
        return lambda env: apply(*(p(env) for p in parts))
    if kind == "binary":
        (left, right), work = parts, _checked(BINARY[value], value)
        return lambda env: work(left(env), right(env))
    if kind == "not":
        return lambda env: not parts[0](env)
    if kind == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if kind == "or":
        return lambda env: parts[0](env) or parts[1](env)
    if kind == "choice":
        return lambda env: parts[1](env) if parts[0](env) else parts[2](env)
    raise TemplateError(f"{kind} is not an expression")


class Writer:
    """Pieces of text and the spans of them that are generated."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[int] = []

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _statement(node: Node) -> Callable[[Env, Writer], None]:
    kind, value = node.kind, node.value
    if kind == "text":
        return lambda env, out: out.write(value)
    if kind == "write":
        of = _expression(node.parts[0])
        return lambda env, out: out.write(_text(of(env)))
    if kind == "block":
        steps = [_statement(p) for p in node.parts]

        def run_block(env: Env, out: Writer) -> None:
            for step in steps:
                step(env, out)

        return run_block
    if kind == "if":
        test, yes, no = _expression(node.parts[0]), _statement(node.parts[1]), _statement(node.parts[2])
        return lambda env, out: yes(env, out) if test(env) else no(env, out)
    if kind == "set":
        of = _expression(node.parts[0])
        return lambda env, out: env.__setitem__(value, of(env))
    if kind == "generation":
        inside = _statement(node.parts[0])

        def run_generation(env: Env, out: Writer) -> None:
            start = out.length
            inside(env, out)
            out.spans += [start, out.length]

        return run_generation
    if kind == "for":
        of, inside = _expression(node.parts[0]), _statement(node.parts[1])

        def run_for(env: Env, out: Writer) -> None:
            rows = of(env) or []
            if not isinstance(rows, list):
                raise TemplateError("only lists can be looped over")
            for k, row in enumerate(rows):
                loop = {"index": k + 1, "index0": k, "first": k == 0, "last": k == len(rows) - 1, "length": len(rows)}
                inside(env | {value: row, "loop": loop}, out)

        return run_for
    raise TemplateError(f"{kind} is not a statement")


@functools.lru_cache(maxsize=16)
def compiled(template: str) -> Callable[[Env], tuple[str, list[int]]]:
    """A function from the template's variables to the text and the flat list of generated spans, in code points."""
    run = _statement(fold(parse(template)))

    def render(env: Env) -> tuple[str, list[int]]:
        out = Writer()
        run(dict(env), out)
        return "".join(out.pieces), out.spans

    return render


# -- conversations ---------------------------------------------------------------------------------


def format_all(conversations: DataFrame, template: str = CHATML, **variables: Any) -> DataFrame:
    """conv_id, formatted, loss_spans (start, end, start, end, ... in code points)."""
    c = conversations
    rows = c.select(
        c["conv_id"].cast("long").alias("conv_id"),
        F.struct(
            c["turn"].cast("long").alias("turn"), F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
            F.coalesce(c["text"].cast("string"), F.lit("")).alias("content"),
        ).alias("row"),
    ).where("conv_id is not null")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("messages"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        render = compiled(template)
        made = [render({"messages": m, **variables}) for m in batch["messages"].to_pylist()]
        texts, spans = zip(*made, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch["conv_id"], pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int64()))],
            ["conv_id", "formatted", "loss_spans"],
        )

    return common.map_arrow(whole, step, "conv_id long, formatted string, loss_spans array<long>")


_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text that the CHATML template made."""
    found, at = [], 0
    while turn := _TURN.match(formatted, at):
        found.append((unescape_line(turn[1]), unescape(turn[2])))
        at = turn.end()
    if at != len(formatted):
        raise TemplateError(f"no turn at {formatted[at : at + 40]!r}")
    return found


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and their loss spans say."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [x.split()[0] for x in schema.split(", ")]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, spans in zip(batch["formatted"].to_pylist(), batch["loss_spans"].to_pylist(), strict=True):
            found = turns(text)
            whole = "".join(f"{role}\n{said}\n" for role, said in found)
            loss = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
            digest = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
            rows.append((len(found), digest[0], len(loss), digest[1], len(text)))
        return pa.RecordBatch.from_arrays([batch["conv_id"], *(pa.array(x) for x in zip(*rows, strict=True))], names)

    return common.map_arrow(formatted, step, schema)
