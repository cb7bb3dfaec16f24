"""A small reader of YAML front matter: one header text -> maps, lists and scalars.

Covers what headers hold: nested block maps and lists, flow style, plain, quoted, literal and folded scalars, comments,
anchors, aliases and merge keys.  Scalars resolve as in YAML 1.1 (``yes`` is true, ``~`` is null); dates and
times stay text, and so do infinities and NaN, as JSON has none.  Complex keys (``? key``), tabs as indentation and several
documents in one header are errors, as are headers nested over 100 deep or that grow by aliases beyond 100,000 values.
"""

from __future__ import annotations

import re

# fixed values: scalar patterns of YAML 1.1
_NULL = {"", "~", "null", "Null", "NULL"}
_TRUE = {"yes", "Yes", "YES", "true", "True", "TRUE", "on", "On", "ON"}
_FALSE = {"no", "No", "NO", "false", "False", "FALSE", "off", "Off", "OFF"}
_INT = [(re.compile(r"[-+]?0b[01_]+"), 2), (re.compile(r"[-+]?0[0-7_]+"), 8), (re.compile(r"[-+]?(?:0|[1-9][0-9_]*)"), 10),
        (re.compile(r"[-+]?0x[0-9a-fA-F_]+"), 16)]
_FLOAT = re.compile(r"[-+]?(?:[0-9][0-9_]*\.[0-9_]*|\.[0-9][0-9_]*)(?:[eE][-+][0-9]+)?")
_BASE_60 = re.compile(r"[-+]?[0-9][0-9_]*(?::[0-5]?[0-9])+(\.[0-9_]*)?")
_TYPED = {"!!bool", "!!float", "!!int", "!!null"}
_ESCAPES = {"0": "\0", "a": "\a", "b": "\b", "t": "\t", "n": "\n", "v": "\v", "f": "\f", "r": "\r", "e": "\x1b", " ": " ", '"': '"',
            "/": "/", "\\": "\\", "N": "\x85", "_": "\xa0", "L": "\u2028", "P": "\u2029"}
_QUOTED = re.compile(r""""(?:\\.|[^"\\])*"|'(?:''|[^'])*'""", re.S)
_KEY = re.compile(r"""("(?:\\.|[^"\\])*"|'(?:''|[^'])*'|(?![-?:](?:\s|$))[^\s\[\]{}#&*!|>'"%@`,](?:(?!:(?:\s|$)|\s#).)*)\s*:(?:\s+|$)""")
_PROPERTY = re.compile(r"([&!][^\s,\[\]{}]*)(?:\s+|$)")
_BLOCK = re.compile(r"([|>])([-+]?)([1-9]?)([-+]?)\s*(?:#.*)?$")
MAX_DEPTH, MAX_VALUES = 100, 100_000


class YamlError(ValueError):
    pass


def scalar(text: str):
    """The value of a plain scalar."""
    if text in _NULL:
        return None
    if text in _TRUE or text in _FALSE:
        return text in _TRUE
    for pattern, base in _INT:
        if pattern.fullmatch(text) and re.search(r"\d", text):
            digits = re.sub(r"_|(?<=[-+])0[bx]|^0[bx]", "", text)
            return int(digits, base)
    if _FLOAT.fullmatch(text):
        return float(text.replace("_", ""))
    if m := _BASE_60.fullmatch(text):
        total = 0.0 if m[1] is not None else 0
        for part in text.lstrip("+-").replace("_", "").split(":"):
            total = total * 60 + (float(part) if m[1] is not None else int(part))
        return -total if text[0] == "-" else total
    return text


def _fold(lines: list[str], quoted: bool = False) -> str:
    """Lines of one scalar: a break is a space, blank lines are breaks (the line of a closing quote is never blank)."""
    out, blank = lines[0], 0
    for i, line in enumerate(lines[1:], 2):
        if not line and not (quoted and i == len(lines)):
            blank += 1
            continue
        out += ("\n" * blank or " ") + line
        blank = 0
    return out


def unquote(text: str) -> str:
    lines = text[1:-1].split("\n")
    if len(lines) > 1:
        lines = [lines[0].rstrip(" \t")] + [x.strip(" \t") for x in lines[1:-1]] + [lines[-1].lstrip(" \t")]
    if text[0] == "'":
        return _fold(lines, True).replace("''", "'")
    for i in range(len(lines) - 2, -1, -1):  # a break after a backslash is none
        if re.search(r"(?<!\\)(?:\\\\)*\\$", lines[i]):
            lines[i:i + 2] = [lines[i][:-1] + lines[i + 1]]

    def escape(m: re.Match) -> str:
        if m[1]:
            return chr(int(m[1][1:], 16))
        if m[2] not in _ESCAPES:
            raise YamlError(f"unknown escape \\{m[2]}")
        return _ESCAPES[m[2]]

    return re.sub(r"\\(?:(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8})|(.))", escape, _fold(lines, True), flags=re.S)


_MARK = re.compile(r"""(?:^|(?<=[\s,\[{:]))["']|(?:^|(?<=\s))#[^\n]*""")


def _uncomment(text: str) -> str:
    """Without comments; quoted parts are kept, also those that go on over lines."""
    out, at = "", 0
    while m := _MARK.search(text, at):
        if m[0][0] == "#":
            out += text[at:m.start()]
            at = m.end()
            continue
        quoted = _QUOTED.match(text, m.start())
        end = quoted.end() if quoted else m.end()
        out += text[at:end]
        at = end
    return out + text[at:]


class Header:
    """The lines of a header and a place among them; indentation decides what belongs to what."""

    def __init__(self, text: str):
        self.lines = [line.rstrip("\r") for line in text.split("\n")]
        self.at = 0
        self.anchors: dict[str, object] = {}
        self.values = 0

    def peek(self) -> tuple[int, str] | None:
        """Indentation and text of the next line that is neither blank nor a comment."""
        while self.at < len(self.lines):
            line = self.lines[self.at]
            text = line.lstrip(" ")
            if text.strip() and text[0] != "#":
                if text[0] == "\t":
                    raise YamlError("a tab indents")
                return len(line) - len(text), text.rstrip()
            self.at += 1
        return None

    def node(self, indent: int, depth: int):
        """The value that starts at the next line, whose indentation is ``indent``."""
        if depth > MAX_DEPTH:
            raise YamlError("nested too deep")
        text = self.peek()[1]
        if text == "-" or text.startswith("- "):
            return self.sequence(indent, depth)
        if text == "?" or text.startswith("? "):
            raise YamlError("complex keys are not read")
        if _KEY.match(text):
            return self.mapping(indent, depth)
        return self.value(text, indent - 1, depth)

    def sequence(self, indent: int, depth: int) -> list:
        out = []
        while (found := self.peek()) and found[0] == indent and (found[1] == "-" or found[1].startswith("- ")):
            rest = found[1][1:].lstrip()
            if not rest or rest[0] == "#":
                self.at += 1
                below = self.peek()
                out.append(self.node(below[0], depth + 1) if below and below[0] > indent else None)
            else:  # what follows the dash is a line of its own, indented by the dash
                inner = indent + len(found[1]) - len(rest)
                self.lines[self.at] = " " * inner + rest
                m = _PROPERTY.match(rest)
                if m and _KEY.match(rest[m.end():]):  # a property of the first key
                    self.lines[self.at] = " " * (inner + m.end()) + rest[m.end():]
                    out.append(self.node(inner + m.end(), depth + 1))
                elif rest == "-" or rest[:2] in ("- ", "? ") or _KEY.match(rest):
                    out.append(self.node(inner, depth + 1))
                else:
                    out.append(self.value(rest, indent, depth + 1))
        self._below(indent)
        return out

    def mapping(self, indent: int, depth: int) -> dict:
        out: dict = {}
        merged: list[dict] = []
        while (found := self.peek()) and found[0] == indent and (m := _KEY.match(found[1])):
            key = unquote(m[1]) if m[1][0] in "\"'" else m[1].rstrip()
            value = self.value(found[1][m.end():], indent, depth + 1, of_key=True)
            if key == "<<" and m[1][0] not in "\"'":
                for one in value if isinstance(value, list) else [value]:
                    if not isinstance(one, dict):
                        raise YamlError("only maps merge")
                    merged.append(one)
            else:
                out[key] = value
        self._below(indent)
        for one in merged:
            out = {k: v for k, v in one.items() if k not in out} | out
        return out

    def _below(self, indent: int) -> None:
        found = self.peek()
        if found and found[0] >= indent and not (found[0] == indent and self._sibling_list(found[1])):
            raise YamlError(f"line {self.at + 1} does not belong here")

    def _sibling_list(self, text: str) -> bool:
        return _KEY.match(text) is not None or text == "-" or text.startswith("- ")

    def value(self, rest: str, indent: int, depth: int, of_key: bool = False):
        """What stands after a key or dash at ``indent``, on its line and on the deeper ones below."""
        anchor = tag = None
        while m := _PROPERTY.match(rest):
            anchor, tag = (m[1][1:], tag) if m[1][0] == "&" else (anchor, m[1])
            rest = rest[m.end():]
        if tag == "!!str" and rest and rest[0] not in "|>[{\"'*#":
            rest = "'" + _uncomment(rest).strip().replace("'", "''") + "'"
        value = self._value(rest, indent, depth, of_key)
        if tag in _TYPED and isinstance(value, str):
            value = scalar(value)
        self.values += 1
        if self.values > MAX_VALUES:
            raise YamlError("too many values")
        if anchor:
            self.anchors[anchor] = value
        return value

    def _value(self, rest: str, indent: int, depth: int, of_key: bool):
        if depth > MAX_DEPTH:
            raise YamlError("nested too deep")
        if not rest or rest[0] == "#":
            self.at += 1
            below = self.peek()
            if below and below[0] > indent:
                return self.node(below[0], depth)
            if of_key and below and below[0] == indent and (below[1] == "-" or below[1].startswith("- ")):
                return self.sequence(indent, depth)
            return None
        if m := _BLOCK.match(rest):
            return self.block(m, indent)
        if rest[0] in "\"'":
            return self.quoted(rest, indent)
        if rest[0] in "[{":
            return self.flow(rest, indent, depth)
        if rest[0] == "*":
            return self.alias(_uncomment(rest).strip()[1:])
        if rest[0] in "|>%@`&,]}" :
            raise YamlError(f"a plain value cannot start with {rest[0]}")
        lines = [_uncomment(rest).strip()]
        self.at += 1
        while lines[-1] == rest.strip() or len(lines) > 1:  # a comment ends a plain value
            line = self.lines[self.at] if self.at < len(self.lines) else "."
            text = line.strip()
            if text and (len(line) - len(line.lstrip(" ")) <= indent or text[0] == "#") or self.at >= len(self.lines):
                break
            if text and _KEY.match(text):
                raise YamlError(f"line {self.at + 1}: a map inside a plain value")
            lines.append(_uncomment(text).strip())
            self.at += 1
        while len(lines) > 1 and not lines[-1]:
            lines.pop()
        return scalar(lines[0]) if len(lines) == 1 else _fold(lines)

    def alias(self, name: str):
        self.at += 1
        return self._named(name)

    def _named(self, name: str):
        if name not in self.anchors:
            raise YamlError(f"no anchor {name}")
        held = [self.anchors[name]]
        while held:
            one = held.pop()
            self.values += 1
            if self.values > MAX_VALUES:
                raise YamlError("too many values")
            held += one.values() if isinstance(one, dict) else one if isinstance(one, list) else []
        return self.anchors[name]

    def block(self, m: re.Match, indent: int) -> str:
        """A literal (|) or folded (>) scalar."""
        chomp, given = m[2] or m[4], m[3]
        self.at += 1
        lines = []
        depth = max(indent, 0) + int(given) if given else None
        while self.at < len(self.lines):
            line = self.lines[self.at]
            own = len(line) - len(line.lstrip(" "))
            if line.strip():
                if depth is None:
                    depth = own
                if own < depth or own <= indent:
                    break
            lines.append(line[depth:] if depth is not None else "")
            self.at += 1
        body = len(lines)
        while body and not lines[body - 1].strip(" "):
            body -= 1
        tail = len(lines) - body
        lines = lines[:body]
        if m[1] == ">":
            text, last, blank = "", None, 0
            for line in lines:
                if not line:
                    blank += 1
                    continue
                deep = line[0] in " \t"
                if last is None:
                    text += "\n" * blank
                else:
                    text += "\n" * (blank + 1) if deep or last else "\n" * blank or " "
                text += line
                last, blank = deep, 0
        else:
            text = "\n".join(lines)
        if chomp == "+":
            return text + "\n" * (tail + bool(lines))
        return text if chomp == "-" or not lines else text + "\n"

    def _more(self, text: str, indent: int) -> str:
        self.at += 1
        if self.at >= len(self.lines):
            raise YamlError("a quoted or flow value does not end")
        line = self.lines[self.at]
        if line.strip() and len(line) - len(line.lstrip(" ")) <= indent:
            raise YamlError(f"line {self.at + 1}: a value goes on without indentation")
        return text + "\n" + line

    def quoted(self, text: str, indent: int) -> str:
        while not (m := _QUOTED.match(text)):
            text = self._more(text, indent)
        if _uncomment(" " + text[m.end():]).strip():
            raise YamlError("text after a quoted value")
        self.at += 1
        return unquote(m[0])

    def flow(self, text: str, indent: int, depth: int):
        while True:
            source = _uncomment(text)
            if _balanced(source):
                break
            text = self._more(text, indent)
        self.at += 1
        value, at = self._flow(source, 0, depth)
        if source[at:].strip():
            raise YamlError("text after a flow value")
        return value

    def _flow(self, s: str, at: int, depth: int):
        if depth > MAX_DEPTH:
            raise YamlError("nested too deep")
        at = _skip(s, at)
        anchor = tag = None
        while m := _PROPERTY.match(s, at):
            anchor, tag = (m[1][1:], tag) if m[1][0] == "&" else (anchor, m[1])
            at = _skip(s, m.end())
        if s[at:at + 1] in ("[", "{"):
            value, at = self._flow_group(s, at, depth)
        elif m := _QUOTED.match(s, at):
            value, at = unquote(m[0]), m.end()
        else:
            m = re.compile(r"(?:(?!:(?:[\s,\[\]{}]|$))[^,\[\]{}])*").match(s, at)
            plain = _fold([x.strip() for x in m[0].strip().split("\n")])
            value, at = (self._named(plain[1:]) if plain[:1] == "*" else plain if tag == "!!str" else scalar(plain)), m.end()
        if tag in _TYPED and isinstance(value, str):
            value = scalar(value)
        self.values += 1
        if self.values > MAX_VALUES:
            raise YamlError("too many values")
        if anchor:
            self.anchors[anchor] = value
        return value, _skip(s, at)

    def _flow_group(self, s: str, at: int, depth: int):
        is_map, close = s[at] == "{", "}" if s[at] == "{" else "]"
        out: dict | list = {} if is_map else []
        at = _skip(s, at + 1)
        while s[at:at + 1] != close:
            if at >= len(s):
                raise YamlError("a flow value does not end")
            start = at
            item, at = self._flow(s, at, depth + 1)
            if s[at:at + 1] == ":":
                key = s[start:at].strip()
                key = unquote(key) if key[:1] in ("'", '"') else key
                value, at = self._flow(s, at + 1, depth + 1)
                if is_map and key == "<<" and isinstance(value, dict):
                    out = value | out
                elif is_map:
                    out[key] = value
                else:
                    out.append({key: value})
            elif is_map:
                out["" if item is None else str(s[start:at]).strip()] = None
            else:
                out.append(item)
            if s[at:at + 1] == ",":
                at = _skip(s, at + 1)
            elif s[at:at + 1] != close:
                raise YamlError("a comma is missing in a flow value")
        return out, at + 1


def _skip(s: str, at: int) -> int:
    while at < len(s) and s[at] in " \t\n":
        at += 1
    return at


def _balanced(text: str) -> bool:
    open_, at = 0, 0
    while at < len(text):
        if text[at] in "\"'" and (at == 0 or text[at - 1] in " \t\n,[{:"):
            m = _QUOTED.match(text, at)
            if not m:
                return False
            at = m.end()
            continue
        open_ += (text[at] in "[{") - (text[at] in "]}")
        at += 1
        if open_ == 0:
            return True
    return False


def load(text: str):
    """The value of a header text; an empty one is None."""
    header = Header(text)
    first = header.peek()
    if first is None:
        return None
    if first[1] in ("---", "...") or first[1].startswith("%"):
        raise YamlError("several documents or directives")
    value = header.node(first[0], 0)
    if header.peek() is not None:
        raise YamlError(f"line {header.at + 1} does not belong here")
    return value
