"""The part of YAML that configurations use: nested mappings and lists by indentation, flow lists and mappings, plain and quoted scalars, comments.

Anchors, tags, block scalars and several documents are not read, and say so.
"""

from __future__ import annotations

import re

_NUMBER = re.compile(r"[-+]?(?:\d[\d_]*)(?:\.\d*)?(?:[eE][-+]?\d+)?|[-+]?\.\d+(?:[eE][-+]?\d+)?")
_KEY = re.compile(r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s"'\[\]{},#&*!|>%@`-][^#:]*?|-?[^\s"'\[\]{},#&*!|>%@`:-][^#:]*?)\s*:(?=\s|$)\s*""")
_WORDS = {"null": None, "~": None, "": None, "true": True, "false": False, ".inf": float("inf"), "-.inf": float("-inf"), ".nan": float("nan")}


def loads(text: str):
    """The value of a document."""
    lines = []
    for raw in text.split("\n"):
        line = _uncommented(raw)
        if line.strip() and not (line.strip() == "---" and not lines):
            if "\t" in line[: len(line) - len(line.lstrip())]:
                raise ValueError(f"a tab in the indentation: {raw!r}")
            lines.append((len(line) - len(line.lstrip(" ")), line.strip()))
    value, at = _block(lines, 0, lines[0][0] if lines else 0)
    if at < len(lines):
        raise ValueError(f"unexpected indentation: {lines[at][1]!r}")
    return value


def _uncommented(line: str) -> str:
    quote = ""
    for i, c in enumerate(line):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'" and (not i or line[i - 1] in " [{,:-"):
            quote = c
        elif c == "#" and (not i or line[i - 1].isspace()):
            return line[:i].rstrip()
    return line.rstrip()


def _block(lines: list, at: int, indent: int):
    """The mapping, list or scalar that begins at a line, and the line after it."""
    if at >= len(lines):
        return None, at
    text = lines[at][1]
    if text == "-" or text.startswith("- "):
        out: list = []
        while at < len(lines) and lines[at][0] == indent and (lines[at][1] == "-" or lines[at][1].startswith("- ")):
            rest = lines[at][1][1:].lstrip()
            if rest:  # what follows the dash is a block of its own, indented by the dash
                inner = indent + len(lines[at][1]) - len(rest)
                lines[at] = (inner, rest)
                value, at = _block(lines, at, inner)
            else:
                deeper = at + 1 < len(lines) and lines[at + 1][0] > indent
                value, at = _block(lines, at + 1, lines[at + 1][0]) if deeper else (None, at + 1)
            out.append(value)
        return out, at
    if not _KEY.match(text):
        parts = [text]
        while at + 1 < len(lines) and lines[at + 1][0] >= indent and text[0] in "[{" and not _closed(" ".join(parts)):
            at += 1
            parts.append(lines[at][1])
        return _flow(" ".join(parts)), at + 1
    made: dict = {}
    while at < len(lines) and lines[at][0] == indent and (found := _KEY.match(lines[at][1])):
        key, rest = _scalar(found[1]), lines[at][1][found.end() :]
        if key in made:
            raise ValueError(f"two values for {key!r}")
        at += 1
        if rest:
            while rest[0] in "[{" and not _closed(rest) and at < len(lines):
                rest, at = f"{rest} {lines[at][1]}", at + 1
            made[key] = _flow(rest)
        elif at < len(lines) and (lines[at][0] > indent or lines[at][0] == indent and lines[at][1].startswith("-")):
            made[key], at = _block(lines, at, lines[at][0])
        else:
            made[key] = None
    return made, at


def _closed(text: str) -> bool:
    depth, quote = 0, ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        else:
            depth += (c in "[{") - (c in "]}")
    return depth <= 0


def _flow(text: str):
    """A scalar, or a list or mapping in brackets."""
    if text[0] in "&*!|>%@`":
        raise ValueError(f"not read here: {text!r}")
    if text[0] not in "[{":
        return _scalar(text)
    if not _closed(text) or text[-1] != {"[": "]", "{": "}"}[text[0]]:
        raise ValueError(f"an open bracket: {text!r}")
    items, depth, quote, begin = [], 0, "", 1
    for i, c in enumerate(text[1:-1], 1):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
        elif c == "," and not depth:
            items.append(text[begin:i].strip())
            begin = i + 1
    items.append(text[begin:-1].strip())
    items = [x for x in items if x]
    if text[0] == "[":
        return [_flow(x) for x in items]
    out = {}
    for x in items:
        found = _KEY.match(x)
        if not found:
            raise ValueError(f"no key: {x!r}")
        out[_scalar(found[1])] = _flow(x[found.end() :]) if x[found.end() :] else None
    return out


def _scalar(text: str):
    if text[0] == text[-1] == "'" and len(text) > 1:
        return text[1:-1].replace("''", "'")
    if text[0] == text[-1] == '"' and len(text) > 1:
        return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1])
    if text.lower() in _WORDS:
        return _WORDS[text.lower()]
    if _NUMBER.fullmatch(text):
        plain = text.replace("_", "")
        return int(plain) if re.fullmatch(r"[-+]?\d+", plain) else float(plain)
    return text
