"""Modules of templates: frames, loading, errors, metatables."""

from __future__ import annotations

import pytest

from lexmill.wikitext import expand, modules
from lexmill.wikitext.modules import Frame, Library, ScriptError, Strict, Table


def _show(frame: Frame):
    return f"{frame.get_title()}|{frame.args}|{frame.get_parent().args}|{frame.get_parent().get_title()}"


def _boom(frame: Frame):
    modules.check_type("boom", 1, frame.args.get("1"), "number", True)


MODULES = {
    "m": {
        "show": _show, "boom": _boom, "none": lambda f: None, "text": 3, "pre": lambda f: f.preprocess("{{{1}}}{{t|{{{1}}}}}"), "tpl": lambda f: f.expand_template("t", {"1": "{{x}}"}), "lost": lambda f: f.expand_template("no"),
        "fn": lambda f: f.call_parser_function("lc", "ABC") + f.call_parser_function("#if", "", "a", "b"), "tag": lambda f: f.extension_tag("ref", "x", {"name": "n", "group": "g"}), "child": lambda f: f.new_child("C", {"1": "v"}).preprocess("{{{1}}}"),
    },
    "data": {"a": [1, {"b": 2}]}, "bad": {"f": print}, "lazy": lambda library: {"other": library.require("Module:data")},
}


@pytest.mark.parametrize(
    ("call", "out"),
    [
        ("m|show|x|k= v ", "Module:m|{'1': 'x', 'k': 'v'}|{}|P"), ("m|none", ""), ("m|pre|q", "q<q>"), ("m|tpl", "<{{x}}>"), ("m|fn", "abcb"), ("m|tag", '<ref group="g" name="n">x</ref>'), ("m|child", "v"),
        ("m|boom|x", "bad argument #1 to 'boom' (number expected, got string)"), ("m|lost", 'template "no" does not exist'), ("m|gone", 'The function "gone" does not exist.'), ("m|text", '"text" is not a function.'), ("nope|x", "module 'nope' not found"),
    ],
)
def test_invoke(call, out):
    context = expand.Context(title="P", modules=Library(MODULES), pages={"t": "<{{{1}}}>"}.get)
    got = expand.Expander(context).expand("{{#invoke:" + call + "}}")
    assert got == out if "error" not in got else out.replace("<", "&lt;") in got


def test_loading():
    library = Library(MODULES, {"d.json": '{"a": [1]}', "e.json": "{"}.get, {"t": [{"en": "x", "de": "y"}, 3]})
    assert library.require("lazy")["other"] is library.require("data")
    data = library.load_data("data")
    assert data["a"] == (1, {"b": 2}) and library.load_data("data") is data
    with pytest.raises(TypeError):
        data["a"] = 1
    assert library.load_json_data("d.json")["a"] == (1,) and library.external_data("t", ("fr", "de")) == ["y", 3]
    for call in (lambda: library.load_data("bad"), lambda: library.load_json_data("e.json"), lambda: library.load_json_data("no"), lambda: library.external_data("no"), lambda: library.require("no")):
        with pytest.raises(ScriptError):
            call()
    library.warn("w")
    assert library.warnings == ["w"]


def test_basics():
    assert modules.protected(lambda x: x + 1, 2) == (True, 3) and modules.protected(modules.error, {"code": 1}) == (False, {"code": 1})
    assert modules.protected(lambda: 1 / 0) == (False, "division by zero") and modules.protected(lambda: (1, 2)) == (True, 1, 2)
    assert [modules.type_name(x) for x in (None, True, 1.5, "a", {}, [], len)] == ["nil", "boolean", "number", "string", "table", "table", "function"]
    assert modules.check(1) == 1
    with pytest.raises(ScriptError, match="no"):
        modules.check(None, "no")
    assert "stack traceback" in modules.trace()
    strict = Strict()
    strict.declare(a=1)
    strict["a"] = 2
    assert strict["a"] == 2
    for use in (lambda: strict["b"], lambda: strict.__setitem__("b", 1)):
        with pytest.raises(ScriptError):
            use()


def test_metatables():
    base, log = {"x": 1}, {}
    t = modules.set_meta(Table(own=2), {"__index": base, "__newindex": log, "__call": lambda self, y: y * 2, "__tostring": lambda self: "T"})
    t["new"] = 5
    assert (t["x"], t["own"], t["none"], log, t(4), str(t)) == (1, 2, None, {"new": 5}, 8, "T")
    assert modules.get_meta(t)["__index"] is base and modules.get_meta({}) is None
    shared = {"k": 1}
    whole = Table(a=shared, b=shared, c=[shared])
    copy = modules.clone(whole)
    assert copy == whole and copy["a"] is copy["b"] is copy["c"][0] and copy["a"] is not shared
    sealed = modules.set_meta(Table(), {"__metatable": "locked"})
    assert modules.get_meta(sealed) == "locked"
    with pytest.raises(ScriptError):
        modules.set_meta(sealed, None)
    assert modules.set_meta(Table(), {"__index": lambda self, key: key * 2})["ab"] == "abab"
