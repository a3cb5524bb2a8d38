"""Nested settings: inheritance, dotted keys, values from text. Settings are not data and stay on the driver."""

from __future__ import annotations

import ast
from collections.abc import Iterable, Mapping
from typing import Any

DELETE = "_delete_"


def merge(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """``over`` on top of ``base``, nested; a mapping with ``_delete_`` true replaces what is below it."""
    out = dict(base)
    for k, v in over.items():
        if isinstance(v, Mapping):
            below = out.get(k)
            plain = {a: b for a, b in v.items() if a != DELETE}
            out[k] = merge(below if isinstance(below, Mapping) and not v.get(DELETE) else {}, plain)
        else:
            out[k] = v
    return out


def nest(flat: Mapping[str, Any]) -> dict[str, Any]:
    """Dotted keys as nested mappings."""
    out: dict[str, Any] = {}
    for key, value in flat.items():
        *path, last = key.split(".")
        at = out
        for p in path:
            at = at.setdefault(p, {})
        at[last] = value
    return out


def parse(text: str) -> Any:
    """A number, boolean, None, list or tuple written as text, else the text."""
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    if text.lower() in ("none", "null"):
        return None
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def load(layers: Iterable[Mapping[str, Any]], options: Mapping[str, str] | None = None) -> dict[str, Any]:
    """Layers from the most general on, then ``a.b=value`` options."""
    out: dict[str, Any] = {}
    for layer in layers:
        out = merge(out, layer)
    return merge(out, nest({k: parse(v) for k, v in (options or {}).items()}))


class Registry:
    """Makers by name; a name can be taken once."""

    def __init__(self):
        self.made: dict[str, Any] = {}

    def add(self, name: str):
        def keep(f):
            if name in self.made:
                raise KeyError(f"{name} is taken")
            self.made[name] = f
            return f

        return keep

    def get(self, name: str):
        return self.made[name]
