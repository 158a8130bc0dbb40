"""A small reader of protobuf's text format, and what the engine takes from a tile's metadata."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from ..functions.transforms import FLIPS, tile_transform

_TOKEN = re.compile(r"""\s+|\#[^\n]*|(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<word>[A-Za-z_][A-Za-z0-9_.]*)|(?P<number>[-+]?(?:0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)[fF]?)|(?P<sign>[{}<>\[\]:;,-])|(?P<other>.)""", re.S)
_WHOLE = re.compile(r"[-+]?(0[xX][0-9a-fA-F]+|0|[1-9]\d*)")
#: Metadata fields by which versions differ: first and last version that know them, and from which they are required.
FEATURES = {
    "zpiezo.nidaq.um_max": (0, 0, None), "zpiezo.um_max": (1, 9, None), "resonant_wrap": (0, 1, None), "autotile": (1, 9, 1), "flyback_scans": (2, 9, None),
    "surface_scan": (3, 9, 3), "surface_probe": (3, 9, None), "pockels.laser": (4, 9, 4), "surface_find.response": (4, 4, None), "surface_find.offset_um": (5, 9, None),
    "trip_detect": (6, 9, None), "trip_detect.ichan": (6, 7, None), "trip_detect.area_threshold": (6, 7, None), "autotile.use_explore": (7, 9, None),
    "trip_detect.threshold": (8, 9, None), "trip_detect.max_reset_count": (9, 9, None), "pmt": (9, 9, None),
}


def tokens(text: str) -> list[tuple[str, str]]:
    out = []
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "other":
            raise ValueError(f"unexpected character {m.group()!r} at {m.start()}")
        if kind:
            out.append((kind, m.group(kind)))
    return out


def _value(kind: str, raw: str):
    if kind == "string":
        return raw[1:-1].encode().decode("unicode_escape")
    if kind == "number":
        body = raw.rstrip("fF") if not raw.lower().startswith(("0x", "-0x")) else raw
        return int(body, 0) if _WHOLE.fullmatch(body) else float(body)
    return {"true": True, "false": False}.get(raw, raw)


def parse(text: str) -> dict[str, list]:
    """Every field as the list of its values, in order; messages are such dicts."""
    toks, at = tokens(text), 0

    def message(end: str | None) -> dict[str, list]:
        nonlocal at
        out: dict[str, list] = {}
        while at < len(toks):
            kind, name = toks[at]
            if name == end:
                at += 1
                return out
            at += 1
            if name in ";," and kind == "sign":
                continue
            if kind != "word":
                raise ValueError(f"a field's name was expected, not {name!r}")
            if at < len(toks) and toks[at][1] == ":":
                at += 1
            values = out.setdefault(name, [])
            if at >= len(toks):
                raise ValueError(f"{name} has no value")
            opened = toks[at][1]
            if toks[at][0] == "sign" and opened in "{<":
                at += 1
                values.append(message("}" if opened == "{" else ">"))
            elif opened == "[":
                at += 1
                while toks[at][1] != "]":
                    if toks[at][1] != ",":
                        values.append(_value(*toks[at]))
                    at += 1
                at += 1
            else:
                values.append(_value(*toks[at]))
                at += 1
        if end:
            raise ValueError(f"{end!r} is missing")
        return out

    return message(None)


# tiles of a run share their scope's message; stacks differ, and would push the scopes out
@lru_cache(1024)
def _scope(text: str) -> tuple[dict[str, list], frozenset[str]]:
    """A scope's message and its features, for those that change nothing in it."""
    scope = parse(text)
    return scope, _fields(scope)


def render(message: dict[str, list], indent: str = "") -> str:
    out = []
    for name, values in message.items():
        for v in values:
            if isinstance(v, dict):
                out.append(f"{indent}{name} {{\n{render(v, indent + '  ')}{indent}}}\n")
            else:
                word = str(v).lower() if isinstance(v, bool) else v if isinstance(v, str) and re.fullmatch(r"[A-Z][A-Za-z0-9_]*", v) else '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"' if isinstance(v, str) else v
                out.append(f"{indent}{name}: {word}\n")
    return "".join(out)


def _paths(message: dict[str, list], at: str = "") -> set[str]:
    out = set()
    for name, values in message.items():
        out.add(f"{at}.{name}")
        for v in values:
            if isinstance(v, dict):
                out |= _paths(v, f"{at}.{name}")
    return out


def _fields(scope: dict[str, list]) -> frozenset[str]:
    """Those of FEATURES that the message has."""
    return _features(frozenset(_paths(scope)))


# messages of one kind of scope have the same fields, whatever their values
@lru_cache(256)
def _features(paths: frozenset[str]) -> frozenset[str]:
    return frozenset(name for name in FEATURES if any(p.endswith("." + name) for p in paths))


@lru_cache(1024)
def _fits(there: frozenset[str], version: int) -> bool:
    return all((first <= version <= last) if name in there else (required is None or version < required) for name, (first, last, required) in FEATURES.items())


def accepts(scope: dict[str, list], version: int) -> bool:
    return _fits(_fields(scope), version)


def detect(scope: dict[str, list]) -> str | None:
    """The oldest version that accepts the message."""
    return _oldest(_fields(scope))


def _oldest(there: frozenset[str]) -> str | None:
    return next((f"v{v}" for v in range(10) if _fits(there, v)), None)


def _nm(value: float, scale: float) -> int:
    """Single-precision product, truncated, as the metadata's unit conversion is defined."""
    return int(np.float32(value) * np.float32(scale))


def tile(scope_text: str, stack_text: str, folder: str, version: str | None = None) -> dict:
    """format, origin and shape in nm, volume path and rotation; raises where a needed field is missing or the version does not fit."""
    (scope, there), stack = _scope(scope_text), parse(stack_text)
    found = version or _oldest(there)
    if found is None or found not in FLIPS or not _fits(there, int(found[1:])):
        raise ValueError(f"the metadata does not fit {found or 'any version'}")
    fov = scope["fov"][0]
    folder = folder.rstrip("/")
    ext = str(scope["stack_extension"][0]).removeprefix(".")
    return {
        "format": found, "path": folder,
        "ori": [_nm(stack[f"{a}_mm"][0], 1e6) for a in "xyz"], "shape": [_nm(fov[f"{a}_size_um"][0], 1e3) for a in "xyz"],
        "rotation": float(fov.get("rotation_radians", [0.0])[0]), "volume": f"{folder}/{folder.rpartition('/')[2]}-{scope['file_prefix'][0]}.%.{ext}",
    }


def transform(meta: dict, dims: list[int]) -> list[float]:
    m = tile_transform(meta["ori"], meta["shape"], dims, FLIPS[meta["format"]], meta["rotation"])
    return m.astype(np.float32).ravel().tolist()


def moved(stack_text: str, scope_text: str, ori=None, shape=None) -> tuple[str, str]:
    """The two texts with another origin or shape (nm)."""
    stack, scope = parse(stack_text), parse(scope_text)
    for k, a in enumerate("xyz"):
        if ori is not None:
            stack[f"{a}_mm"] = [ori[k] / 1e6]
        if shape is not None:
            scope["fov"][0][f"{a}_size_um"] = [shape[k] / 1e3]
    return render(stack), render(scope)
