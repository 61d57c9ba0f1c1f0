"""Modules of templates as Python functions: frames, loading, data and errors as scripts know them."""

from __future__ import annotations

import json
import traceback as _traceback
from collections.abc import Callable, Iterator, Mapping
from types import MappingProxyType
from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from lexmill.wikitext.expand import Expander


class ScriptError(Exception):
    """An error a module raises on purpose; value is what it was raised with."""

    def __init__(self, value: object, level: int = 1):
        super().__init__(value if isinstance(value, str) else repr(value))
        self.value, self.level = value, level


def error(value: object, level: int = 1) -> None:
    raise ScriptError(value, level)


def check(value, message: object = "assertion failed!", *rest):
    """The values given, if the first is neither null nor false; else an error."""
    if value is None or value is False:
        raise ScriptError(message)
    return (value, message, *rest) if rest or message != "assertion failed!" else value


def protected(function: Callable, *args) -> tuple:
    """(True, results...) of a call, or (False, error) if it fails."""
    try:
        out = function(*args)
    except ScriptError as e:
        return False, e.value
    except Exception as e:  # noqa: BLE001 - whatever a module raises is its error
        return False, str(e)
    return (True, *out) if isinstance(out, tuple) else (True, out)


def type_name(value: object) -> str:
    """nil, boolean, number, string, function or table."""
    if value is None:
        return "nil"
    for kinds, name in ((bool, "boolean"), ((int, float), "number"), ((str, bytes), "string")):
        if isinstance(value, kinds):
            return name
    return "function" if callable(value) and not isinstance(value, Mapping) else "table"


def check_type(name: str, place: int, value: object, expected: str, nil_ok: bool = False) -> None:
    """An error in the usual words if an argument is of another type."""
    if type_name(value) != expected and not (nil_ok and value is None):
        raise ScriptError(f"bad argument #{place} to '{name}' ({expected} expected, got {type_name(value)})")


def trace() -> str:
    """Where the calls stand, innermost last."""
    return "stack traceback:\n" + "".join(_traceback.format_stack()[:-1])


class Table(dict):
    """A table with a metatable: ``__index`` gives missing keys, ``__newindex`` takes new ones, ``__call`` and ``__tostring`` do as they say."""

    meta: Mapping | None = None

    def __missing__(self, key):
        index = (self.meta or {}).get("__index")
        if callable(index) and not isinstance(index, Mapping):
            return index(self, key)
        return index.get(key) if isinstance(index, Mapping) and not isinstance(index, Table) else index[key] if index is not None else None

    def __setitem__(self, key, value):
        put = (self.meta or {}).get("__newindex")
        if put is None or key in self:
            super().__setitem__(key, value)
        elif isinstance(put, Mapping):
            put[key] = value
        else:
            put(self, key, value)

    def __call__(self, *args):
        return self.meta["__call"](self, *args)

    def __str__(self):
        shown = (self.meta or {}).get("__tostring")
        return shown(self) if shown else "table"

    __hash__ = object.__hash__


def set_meta(table: Table, meta: Mapping | None) -> Table:
    if (table.meta or {}).get("__metatable") is not None:
        raise ScriptError("cannot change a protected metatable")
    table.meta = meta
    return table


def get_meta(table: object):
    meta = getattr(table, "meta", None) or {}
    return meta.get("__metatable", table.meta if isinstance(table, Table) else None)


def clone(value):
    """A deep copy; tables that occur twice are copied once, metatables are shared."""
    done: dict[int, object] = {}

    def copy(x):
        if not isinstance(x, (dict, list)):
            return x
        if id(x) in done:
            return done[id(x)]
        out = done[id(x)] = type(x)()
        if isinstance(x, list):
            out.extend(copy(y) for y in x)
        else:
            for k, v in x.items():
                dict.__setitem__(out, copy(k), copy(v))
            if isinstance(x, Table):
                out.meta = x.meta
        return out

    return copy(value)


class Strict(dict):
    """Globals in which a name must be set before it is read, and only by ``declare``."""

    def declare(self, **names):
        dict.update(self, names)

    def __missing__(self, key):
        raise ScriptError(f"tried to read nil global {key}")

    def __setitem__(self, key, value):
        if key not in self:
            raise ScriptError(f"tried to write global {key}")
        super().__setitem__(key, value)


def frozen(value):
    """Data nobody can change: mappings read-only, lists as tuples."""
    if isinstance(value, dict):
        return MappingProxyType({k: frozen(v) for k, v in value.items()})
    return tuple(map(frozen, value)) if isinstance(value, (list, tuple)) else value


class Library:
    """The modules of a wiki: name -> mapping of functions, or a function that makes it when first needed.

    Every module is made once; data are made once, read-only, and may hold no functions.
    """

    def __init__(self, modules: Mapping[str, object], pages: Callable[[str], str | None] = lambda _: None, data: Mapping[str, object] | None = None):
        self.modules, self.pages, self.data = modules, pages, dict(data or {})
        self.loaded: dict[str, object] = {}
        self.warnings: list[str] = []

    def require(self, name: str):
        bare = name.removeprefix("Module:")
        if bare not in self.loaded:
            if bare not in self.modules:
                raise ScriptError(f"module '{name}' not found")
            made = self.modules[bare]
            self.loaded[bare] = made(self) if callable(made) and not isinstance(made, Mapping) else made
        return self.loaded[bare]

    def load_data(self, name: str):
        key = f"data:{name}"
        if key not in self.loaded:
            value = self.require(name)
            if not isinstance(value, (Mapping, list, tuple)) or any(callable(v) for v in _values(value)):
                raise ScriptError(f"data for module '{name}' must be a table without functions")
            self.loaded[key] = frozen(value)
        return self.loaded[key]

    def load_json_data(self, title: str):
        text = self.pages(title)
        if text is None:
            raise ScriptError(f"bad argument #1 to 'mw.loadJsonData' ('{title}' is not a valid JSON page)")
        try:
            return frozen(json.loads(text))
        except ValueError as e:
            raise ScriptError(f"bad argument #1 to 'mw.loadJsonData' ('{title}' is not a valid JSON page)") from e

    def external_data(self, name: str, languages: tuple[str, ...] = ("en",)):
        """A data page with its localised texts in the first language it has; an error if it is not known."""
        if name not in self.data:
            raise ScriptError(f"data page '{name}' is not known")
        return _localised(self.data[name], languages)

    def export(self, module: str, function: str) -> Callable:
        """A function of a module, or the usual error."""
        exports = self.require(module)
        found = exports.get(function) if isinstance(exports, Mapping) else getattr(exports, function, None)
        if found is None:
            raise ScriptError(f'The function "{function}" does not exist.')
        if not callable(found):
            raise ScriptError(f'"{function}" is not a function.')
        return found

    def warn(self, text: str) -> None:
        self.warnings.append(text)


def _values(value) -> Iterator[object]:
    stack = [value]
    while stack:
        x = stack.pop()
        yield x
        stack += list(x.values()) if isinstance(x, Mapping) else list(x) if isinstance(x, (list, tuple)) else []


def _localised(value, languages: tuple[str, ...]):
    if isinstance(value, list):
        return [_localised(x, languages) for x in value]
    if isinstance(value, dict):
        if value and all(isinstance(v, str) for v in value.values()) and any(code in value for code in languages):
            return next(value[code] for code in languages if code in value)
        return {k: _localised(v, languages) for k, v in value.items()}
    return value


class Frame:
    """What a module sees of the call: its arguments, its parent, and the page around it."""

    def __init__(self, expander: Expander, title: str, args: Mapping[str, str], parent: Frame | None = None):
        self.expander, self.title, self.args, self.parent = expander, title, dict(args), parent

    def get_parent(self) -> Frame | None:
        return self.parent

    def get_title(self) -> str:
        return self.title

    def new_child(self, title: str | None = None, args: Mapping[str, str] | None = None) -> Frame:
        return Frame(self.expander, title or self.title, args or {}, self)

    def preprocess(self, text: str) -> str:
        return self.expander.expand(text, self.args, 1)

    def expand_template(self, title: str, args: Mapping[str, str] | None = None) -> str:
        """A template with these arguments, taken as they are; an error if there is none."""
        source = self.expander.context.pages(title)
        if source is None:
            raise ScriptError(f'frame:expandTemplate: template "{title}" does not exist')
        return self.expander.template(title, source, {str(k): str(v) for k, v in (args or {}).items()})

    def call_parser_function(self, name: str, *args: str) -> str:
        from lexmill.wikitext.expand import FUNCTIONS

        function = FUNCTIONS.get(name.lower())
        if function is None:
            raise ScriptError(f'callParserFunction: function "{name}" was not found')
        first, *rest = args or ("",)
        return function(self.expander, str(first), [str(a) for a in rest], str.strip)

    def extension_tag(self, name: str, content: str = "", args: Mapping[str, str] | None = None) -> str:
        return self.call_parser_function("#tag", name, content, *[f"{k}={v}" for k, v in sorted((args or {}).items())])
