"""Chat formatting by a template compiler.

A template is parsed into a syntax tree, constant parts are folded, and the
tree becomes Python closures: generators that yield ``(text, under_loss)``
chunks, so a conversation is rendered message by message and never held whole.
The language is closed: text, ``{{ expr }}``, ``{% for x in messages %}``,
``{% if %}/{% elif %}/{% else %}``, ``{% set %}`` and
``{% generation %}..{% endgeneration %}``, which marks what the loss covers.
Expressions have literals, names, ``x.field`` (``role`` and ``text`` of a
message; ``first`` and ``index0`` of ``loop``), ``== != not and or ~`` and the
filters below; there are no calls and no way to reach a Python object.

Control strings inside a role or text are escaped reversibly: a backslash is
doubled and one is put into every ``<|`` (and for a line feed of a role), so
that only the template can write ``<|``.

Spark deals whole conversations by id and sorts their rows by (turn, role,
text); a task streams over the sorted rows, so its memory does not depend on
the length of a conversation.  The digests chain over its turns, which makes
one task read a long conversation from start to end.

Defined results: null roles and texts are empty; rows that share a turn follow
each other by role and text, repeated rows are turns of their own; rows whose
conversation id is null form one conversation.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
CHATML = ("{% for m in messages %}<|im_start|>{{ m.role | escape_line }}\n"
          "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
          "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>\n{% endfor %}")


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(s: str) -> str:
    return escape(s).replace("\n", "\\n")


def unescape(s: str) -> str:
    return re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], s)


FILTERS = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}
FIELDS = ("role", "text", "first", "index0")


class TemplateError(ValueError):
    pass


# ---- parsing

_TAG = re.compile(r"\{%-?\s*(.*?)\s*-?%\}|\{\{\s*(.*?)\s*\}\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|(==|!=|[~|.()\[\]])|(\w+))")


def parse(template: str):
    """Syntax tree of a template: a list of nodes."""
    items, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            items.append(("text", template[at:m.start()]))
        items.append(("tag", m[1]) if m[1] is not None else ("print", m[2]))
        at = m.end()
    if at < len(template):
        items.append(("text", template[at:]))
    body, rest = _block(items, 0, ())
    if rest != len(items):
        raise TemplateError("unexpected end tag")
    return body


def _block(items, i, until):
    out = []
    while i < len(items):
        kind, value = items[i]
        if kind == "text":
            out.append(("lit", value))
        elif kind == "print":
            out.append(("print", _expr(value)))
        else:
            word = value.split(None, 1)[0] if value else ""
            if word in until:
                return out, i
            if word == "for":
                m = re.fullmatch(r"for\s+(\w+)\s+in\s+messages", value)
                if not m:
                    raise TemplateError(f"only 'for x in messages' is known: {value}")
                body, i = _block(items, i + 1, ("endfor",))
                out.append(("for", m[1], body))
            elif word == "generation":
                body, i = _block(items, i + 1, ("endgeneration",))
                out.append(("generation", body))
            elif word == "set":
                m = re.fullmatch(r"set\s+(\w+)\s*=\s*(.+)", value, re.S)
                if not m:
                    raise TemplateError(f"bad set: {value}")
                out.append(("set", m[1], _expr(m[2])))
            elif word == "if":
                arms, cond = [], _expr(value[2:])
                while True:
                    body, i = _block(items, i + 1, ("elif", "else", "endif"))
                    arms.append((cond, body))
                    end = items[i][1]
                    if end == "endif":
                        break
                    cond = ("const", True) if end == "else" else _expr(end[4:])
                out.append(("if", arms))
            else:
                raise TemplateError(f"unknown tag: {value}")
        i += 1
    if until:
        raise TemplateError(f"missing {until[-1]}")
    return out, i


def _expr(source: str):
    tokens, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"bad expression: {source}")
        string, number, sign, word = m.groups()
        tokens.append(("const", re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], string[1:-1])) if string is not None
                      else ("const", int(number)) if number else ("op", sign) if sign else
                      ("op", word) if word in ("and", "or", "not") else ("name", word))
        at = m.end()
    tokens.append(("end", None))
    pos = 0

    def peek(*ops):
        return tokens[pos][0] == "op" and tokens[pos][1] in ops

    def take():
        nonlocal pos
        pos += 1
        return tokens[pos - 1]

    def chain(below, *ops):
        left = below()
        while peek(*ops):
            op = take()[1]
            left = ("op", op, left, below())
        return left

    def value():
        if peek("not"):
            take()
            return ("not", value())
        if peek("("):
            take()
            inner = either()
            if not peek(")"):
                raise TemplateError(f"missing bracket: {source}")
            take()
        else:
            kind, v = take()
            if kind not in ("const", "name"):
                raise TemplateError(f"bad expression: {source}")
            inner = (kind, v)
        while peek(".", "[", "|"):
            op, (_, v) = take()[1], take()
            if op == "|":
                if v not in FILTERS:
                    raise TemplateError(f"unknown filter: {v}")
                inner = ("filter", v, inner)
            else:
                if v not in FIELDS:
                    raise TemplateError(f"unknown field: {v}")
                if op == "[" and take() != ("op", "]"):
                    raise TemplateError(f"missing bracket: {source}")
                inner = ("field", v, inner)
        return inner

    def joined():
        return chain(value, "~")

    def compared():
        return chain(joined, "==", "!=")

    def both():
        return chain(compared, "and")

    def either():
        return chain(both, "or")

    tree = either()
    if tokens[pos][0] != "end":
        raise TemplateError(f"bad expression: {source}")
    return tree


# ---- folding

_OPS = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "~": lambda a, b: f"{a}{b}",
        "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold_expr(e):
    if e[0] == "op":
        a, b = fold_expr(e[2]), fold_expr(e[3])
        return ("const", _OPS[e[1]](a[1], b[1])) if a[0] == b[0] == "const" else ("op", e[1], a, b)
    if e[0] == "not":
        a = fold_expr(e[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if e[0] in ("filter", "field"):
        a = fold_expr(e[2])
        return ("const", FILTERS[e[1]](str(a[1]))) if e[0] == "filter" and a[0] == "const" else (e[0], e[1], a)
    return e


def fold(body):
    """The same body with constant expressions evaluated, dead arms gone and literal text joined."""
    out = []
    for node in body:
        if node[0] == "print":
            e = fold_expr(node[1])
            node = ("lit", str(e[1])) if e[0] == "const" else ("print", e)
        elif node[0] == "for":
            node = ("for", node[1], fold(node[2]))
        elif node[0] == "generation":
            node = ("generation", fold(node[1]))
        elif node[0] == "set":
            node = ("set", node[1], fold_expr(node[2]))
        elif node[0] == "if":
            arms = []
            for cond, inner in node[1]:
                cond = fold_expr(cond)
                if cond[0] == "const" and not cond[1]:
                    continue
                arms.append((cond, fold(inner)))
                if cond[0] == "const":
                    break
            if not arms or arms[0][0][0] == "const":
                out += arms[0][1] if arms else []
                continue
            node = ("if", arms)
        out.append(node)
    joined = []
    for node in out:
        if node[0] == "lit" and joined and joined[-1][0] == "lit":
            joined[-1] = ("lit", joined[-1][1] + node[1])
        elif node != ("lit", ""):
            joined.append(node)
    return joined


# ---- closures

def _value(e):
    if e[0] == "const":
        return lambda env, v=e[1]: v
    if e[0] == "name":
        return lambda env, n=e[1]: env.get(n, "")
    if e[0] == "field":
        inner, name = _value(e[2]), e[1]

        def field(env):
            holder = inner(env)
            return holder.get(name, "") if isinstance(holder, dict) else ""
        return field
    if e[0] == "filter":
        inner, f = _value(e[2]), FILTERS[e[1]]
        return lambda env: f(str(inner(env)))
    if e[0] == "not":
        inner = _value(e[1])
        return lambda env: not inner(env)
    a, b, op = _value(e[2]), _value(e[3]), e[1]
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    f = _OPS[op]
    return lambda env: f(a(env), b(env))


def _run(body):
    steps = [_step(node) for node in body]

    def run(env, loss):
        for step in steps:
            yield from step(env, loss)
    return run


def _step(node):
    kind = node[0]
    if kind == "lit":
        return lambda env, loss, s=node[1]: ((s, loss),)
    if kind == "print":
        e = _value(node[1])
        return lambda env, loss: ((str(e(env)), loss),)
    if kind == "generation":
        inner = _run(node[1])
        return lambda env, loss: inner(env, True)
    if kind == "set":
        e, name = _value(node[2]), node[1]

        def assign(env, loss):
            env[name] = e(env)
            return ()
        return assign
    if kind == "if":
        arms = [(_value(c), _run(b)) for c, b in node[1]]

        def choose(env, loss):
            for cond, inner in arms:
                if cond(env):
                    return inner(env, loss)
            return ()
        return choose
    inner, name = _run(node[2]), node[1]

    def loop(env, loss):
        for i, message in enumerate(env["messages"]):
            env[name], env["loop"] = message, {"first": i == 0, "index0": i}
            yield from inner(env, loss)
    return loop


def compile_template(template: str):
    """``render(messages) -> iterator of (text, under_loss)``; messages are dicts with role and text."""
    run = _run(fold(parse(template)))
    return lambda messages: run({"messages": messages}, False)


# ---- reading back

def read_back(chunks):
    """Turns of a rendered conversation: yields (role, text) from the output alone, turn by turn."""
    pending: list[str] = []
    for text, _ in chunks:
        pending.append(text)
        if END not in text:
            continue
        whole = "".join(pending)
        at = 0
        while (stop := whole.find(END, at)) >= 0:
            first = whole.index(START, at) + len(START)
            role, _, body = whole[first:stop].partition("\n")
            yield unescape(role), unescape(body)
            at = stop + len(END)
        pending = [whole[at:]]


def digest_conversation(render, messages) -> tuple:
    """(n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from the rendered output."""
    turns, loss, n, chars, loss_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
    span: list[str] = []

    def watched():
        nonlocal chars, loss_chars
        for text, under in itertools.chain(render(messages), [("", False)]):
            chars += len(text)
            if under:
                span.append(text)
            elif span:
                plain = unescape("".join(span))
                loss_chars += len(plain)
                loss.update(plain.encode())
                span.clear()
            yield text, under

    for role, text in read_back(watched()):
        n += 1
        turns.update(f"{role}\n{text}\n".encode())
    return n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars


def _rows(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 256):       # few rows as Python strings at a time
            part = batch.slice(start, 256)
            yield from zip(*(part.column(c).to_pylist() for c in ("id", "role", "text")))


def format_conversations(turns: DataFrame, template: str = CHATML, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per conversation: id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``with_text`` adds ``formatted`` and ``loss_spans`` (start and length in code points), which hold a
    conversation whole.
    """
    compile_template(template)                            # faults show on the driver
    spec = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    if with_text:
        spec += ", formatted string, loss_spans array<array<long>>"
        names += ["formatted", "loss_spans"]
        types += [pa.string(), pa.list_(pa.list_(pa.int64()))]

    def run(batches):
        render, out = compile_template(template), []
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        id_type = first.schema.field("id").type

        def flush():
            cols = [list(c) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [id_type, *types])], names)

        for key, rows in itertools.groupby(_rows(itertools.chain([first], batches)), key=lambda r: r[0]):
            messages = ({"role": r or "", "text": t or ""} for _, r, t in rows)
            if with_text:
                messages = list(messages)
                chunks = list(render(messages))
                spans, at = [], 0
                for text, under in chunks:
                    if under:
                        spans.append([at, len(text)])
                    at += len(text)
                extra = ("".join(c[0] for c in chunks), spans)
            out.append((key, *digest_conversation(render, messages), *(extra if with_text else ())))
            if len(out) >= (64 if with_text else 2000):
                yield flush()
                out.clear()
        if out:
            yield flush()

    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
            .mapInArrow(run, f"id {kind}, {spec}"))
