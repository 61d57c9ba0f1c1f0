"""HTML elements put together piece by piece."""

from __future__ import annotations

import html
import re

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class Element:
    """A node of a tree; without a name it only holds its children."""

    def __init__(self, name: str | None = None, closing: bool | None = None):
        if name is not None and not re.fullmatch(r"[A-Za-z0-9]+", name):
            raise ValueError(f"invalid tag name {name}")
        self.name, self.void = name, name in VOID if closing is None else not closing
        self.parent: Element | None = None
        self.children: list = []
        self.attributes: dict[str, str] = {}
        self.classes: list[str] = []
        self.styles: list[tuple[str | None, str]] = []

    def tag(self, name: str) -> Element:
        """A new child, which is returned."""
        child = Element(name)
        child.parent = self
        self.children.append(child)
        return child

    def node(self, child: Element | None) -> Element:
        if child is not None:
            self.children.append(child)
        return self

    def wikitext(self, *texts) -> Element:
        """Texts up to the first null are added as they are."""
        for text in texts:
            if text is None:
                break
            self.children.append(str(text))
        return self

    def newline(self) -> Element:
        return self.wikitext("\n")

    def attr(self, name: str, value) -> Element:
        if not re.fullmatch(r"[^\s\"'<>/=]+", name):
            raise ValueError(f"invalid attribute {name}")
        if name == "style":
            self.styles = [(None, str(value))] if value is not None else []
        elif name == "class":
            self.classes = str(value).split() if value is not None else []
        elif value is None:
            self.attributes.pop(name, None)
        else:
            self.attributes[name] = str(value)
        return self

    def get_attr(self, name: str) -> str | None:
        return self._all().get(name)

    def add_class(self, name: str | None) -> Element:
        if name:
            self.classes += [c for c in name.split() if c not in self.classes]
        return self

    def css(self, name: str, value) -> Element:
        """A style property, which replaces an earlier one; null takes it away."""
        self.styles = [s for s in self.styles if s[0] != name]
        if value is not None:
            self.styles.append((name, str(value)))
        return self

    def css_text(self, text: str | None) -> Element:
        if text is not None:
            self.styles.append((None, text))
        return self

    def done(self) -> Element:
        return self.parent or self

    def all_done(self) -> Element:
        at = self
        while at.parent:
            at = at.parent
        return at

    def _all(self) -> dict[str, str]:
        out = dict(self.attributes)
        if self.classes:
            out["class"] = " ".join(self.classes)
        if self.styles:
            out["style"] = ";".join(v.rstrip(";") if k is None else f"{k}:{v}" for k, v in self.styles)
        return out

    def __str__(self) -> str:
        inner = "".join(map(str, self.children))
        if self.name is None:
            return inner
        shown = "".join(f' {k}="{html.escape(v)}"' for k, v in self._all().items())
        return f"<{self.name}{shown} />" if self.void else f"<{self.name}{shown}>{inner}</{self.name}>"


def create(name: str | None = None) -> Element:
    return Element(name)
