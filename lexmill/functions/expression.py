"""Arithmetic expressions of wikitext (#expr, #ifexpr)."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column

from lexmill.functions.lazy import mapped


class ExpressionError(ValueError):
    pass


_TOKEN = re.compile(r"\s*(?:(?P<number>[0-9]+\.?[0-9]*|\.[0-9]+)|(?P<word>[A-Za-z]+)|(?P<sign>\*\*|<=|>=|<>|!=|[-+*/^()<>=−]))")
#: Stands for a number that is not known yet: a code point that is no character.
OPEN = "\ufdd0"
_OPEN_TOKEN = re.compile(_TOKEN.pattern.replace("(?P<number>", f"(?P<number>{OPEN}|"))

# Binding strength of the operators; equal strength binds to the left.
BINARY = {"e": 10, "^": 8, "**": 8, "*": 7, "/": 7, "div": 7, "mod": 7, "fmod": 7, "+": 6, "-": 6, "round": 5, "=": 4, "<": 4, ">": 4, "<=": 4, ">=": 4, "!=": 4, "<>": 4, "and": 3, "or": 2}
SIGNS = {"-": 10, "+": 10}
FUNCTIONS = {"not", "sin", "cos", "tan", "asin", "acos", "atan", "exp", "ln", "abs", "floor", "trunc", "ceil", "sqrt"}
CONSTANTS = {"pi": math.pi, "e": math.e}


def _call(name: str, x: float) -> float:
    if name in ("asin", "acos") and not -1 <= x <= 1:
        raise ExpressionError(f"Invalid argument for {name}: < -1 or > 1")
    if name == "ln" and x <= 0:
        raise ExpressionError("Invalid argument for ln: <= 0")
    if name == "sqrt" and x < 0:
        raise ExpressionError("In sqrt: Result is not a number")
    if name == "not":
        return float(x == 0)
    if name in ("floor", "ceil", "trunc"):
        return float(getattr(math, name)(x)) if math.isfinite(x) else x
    try:
        return {"ln": math.log, "abs": abs}.get(name, getattr(math, name, None))(x)
    except OverflowError:
        return math.inf


def rounded(x: float, digits: int) -> float:
    """Half away from zero after scaling in binary."""
    if abs(digits) > 308 or not math.isfinite(x):
        return x
    scale = 10.0 ** abs(digits)
    scaled = x * scale if digits >= 0 else x / scale
    if not math.isfinite(scaled):
        return x
    whole = math.copysign(math.floor(abs(scaled) + 0.5), x)
    return whole / scale if digits >= 0 else whole * scale


def _combine(op: str, a: float, b: float) -> float:
    match op:
        case "+":
            return a + b
        case "-":
            return a - b
        case "*":
            return a * b
        case "/" | "div":
            if b == 0:
                raise ExpressionError("Division by zero")
            return a / b
        case "mod":
            whole = int(math.trunc(b))
            if whole == 0:
                raise ExpressionError("Division by zero")
            return float(math.fmod(math.trunc(a), whole))
        case "fmod":
            if b == 0:
                raise ExpressionError("Division by zero")
            return math.fmod(a, b)
        case "^" | "**":
            try:
                out = a**b
            except OverflowError:
                return math.inf
            except ZeroDivisionError:
                return math.inf
            return math.nan if isinstance(out, complex) else out
        case "e":
            try:
                return a * 10.0**b
            except OverflowError:
                return math.inf
        case "round":
            return rounded(a, int(math.trunc(b)))
        case "and":
            return float(a != 0 and b != 0)
        case "or":
            return float(a != 0 or b != 0)
        case "=":
            return float(a == b)
        case "!=" | "<>":
            return float(a != b)
        case "<":
            return float(a < b)
        case ">":
            return float(a > b)
        case "<=":
            return float(a <= b)
        case _:
            return float(a >= b)


def evaluate(text: str) -> float:
    """The value; raises ExpressionError. Nesting is limited to 100 levels."""
    return _parsed(text, _TOKEN, float, lambda x: -x, _call, _combine)


def prepared(text: str) -> Callable[[float], float] | None:
    """The value as a function of the number at each OPEN, which has digits only; null where a text must be evaluated as a whole."""
    if re.search(rf"[0-9.{OPEN}]{OPEN}|{OPEN}[0-9.]", text):
        return None

    def number(token: str):
        return (lambda v: v) if token == OPEN else lambda v, x=float(token): x

    def combine(op: str, a, b):
        apply = partial(_combine, op)
        return lambda v: apply(a(v), b(v))

    try:
        return _parsed(text, _OPEN_TOKEN, number, lambda x: lambda v: -x(v), lambda name, x: lambda v: _call(name, x(v)), combine)
    except ExpressionError:
        return None


def _parsed(text: str, token: re.Pattern, number: Callable, negated: Callable, call: Callable, combine: Callable):
    tokens: list[tuple[str, str]] = []
    at, text = 0, text.replace("&lt;", "<").replace("&gt;", ">").replace("&minus;", "-").rstrip()
    while at < len(text):
        m = token.match(text, at)
        if not m:
            raise ExpressionError(f"Unrecognized punctuation character \"{text[at:].strip()[:1]}\"")
        tokens.append((m.lastgroup, m[m.lastgroup].lower().replace("−", "-")))
        at = m.end()
    place = 0

    def peek() -> tuple[str, str]:
        return tokens[place] if place < len(tokens) else ("end", "")

    def operand(depth: int):
        nonlocal place
        kind, value = peek()
        place += 1
        if kind == "number":
            return number(value)
        if value in SIGNS:
            x = climb(SIGNS[value] + 1, depth + 1)
            return negated(x) if value == "-" else x
        if kind == "word" and value in FUNCTIONS:
            return call(value, climb(10, depth + 1))
        if kind == "word" and value in CONSTANTS:
            return number(CONSTANTS[value])
        if value == "(":
            x = climb(0, depth + 1)
            if peek()[1] != ")":
                raise ExpressionError("Unclosed bracket")
            place += 1
            return x
        if kind == "end":
            raise ExpressionError("Missing operand")
        if kind == "word" and value not in BINARY:
            raise ExpressionError(f'Unrecognized word "{value}"')
        raise ExpressionError(f"Unexpected {value} operator")

    def climb(least: int, depth: int):
        nonlocal place
        if depth > 100:
            raise ExpressionError("Stack exhausted")
        left = operand(depth)
        while True:
            kind, op = peek()
            if kind == "end" or op == ")":
                return left
            strength = BINARY.get(op)
            if strength is None:
                raise ExpressionError("Unexpected number" if kind == "number" else f'Unrecognized word "{op}"' if kind == "word" and op not in FUNCTIONS | set(CONSTANTS) else f"Unexpected {op} operator")
            if strength < least:
                return left
            place += 1
            left = combine(op, left, climb(strength + 1, depth + 1))

    result = climb(0, 0)
    if peek()[0] != "end":
        raise ExpressionError("Unexpected closing bracket")
    return result


def shown(x: float) -> str:
    """Shortest decimal text; 0 for zero."""
    if math.isnan(x) or math.isinf(x):
        raise ExpressionError("Result is not a number")
    if x == 0:
        return "0"
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else format(x, ".14g")


def error_text(message: str) -> str:
    return f'<strong class="error">Expression error: {message}.</strong>'


def expr(text: str) -> str:
    """The value as text; empty for empty text, error markup on failure."""
    if not text.strip():
        return ""
    try:
        return shown(evaluate(text))
    except ExpressionError as e:
        return error_text(str(e))


def truth(text: str) -> bool | None:
    """Whether the value is not 0; empty is false, an error is null."""
    if not text.strip():
        return False
    try:
        value = evaluate(text)
        return value != 0 if math.isfinite(value) else None
    except ExpressionError:
        return None


def expr_column(x: Column | str) -> Column:
    return mapped(expr, "string", x)


def truth_column(x: Column | str) -> Column:
    return mapped(truth, "boolean", x)
