"""Job configs as they are written: JSON with comments, unquoted keys and strings, dotted keys, and substitutions.

``loads`` gives plain dicts, lists, strings, numbers, booleans and None. What is read:

* comments from ``#`` or ``//`` to the end of the line, and commas or line ends between entries;
* ``key = value``, ``key : value``, ``key { ... }``, ``a.b.c = value``, ``key += value``;
* objects that are given twice are merged, any other value replaces what was there;
* strings in double quotes with JSON's escapes, in triple quotes as they are, and unquoted up to the end of the value;
* ``${path}`` and ``${?path}`` (nothing if missing), in values and inside unquoted text, resolved at the end, so that a path may
  be given later; values next to each other are joined: objects merged, lists appended, the rest as text.

``include`` is not supported and is an error, as are cycles of substitutions. Durations and sizes stay text or numbers.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

_NUMBER = re.compile(r"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$")
_WORDS = {"true": True, "false": False, "null": None}
#: Characters that end an unquoted text.
_ENDS = set('$"{}[]:=,+#`^?!@*&\\\n')


class HoconError(ValueError):
    """A config that cannot be read, with the line."""


@dataclass
class _Substitution:
    path: str
    optional: bool


@dataclass
class _Joined:
    """Values next to each other that can be joined only when substitutions are known; ``before`` is what the key had."""

    parts: list = field(default_factory=list)


_NOTHING = object()


class _Reader:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def fail(self, what: str):
        raise HoconError(f"line {self.text.count(chr(10), 0, self.at) + 1}: {what}")

    def skip(self, lines: bool = True) -> bool:
        """Go over blanks and comments (and line ends); whether a line ended."""
        ended = False
        while self.at < len(self.text):
            c = self.text[self.at]
            if c == "#" or self.text.startswith("//", self.at):
                end = self.text.find("\n", self.at)
                self.at = len(self.text) if end < 0 else end
            elif c == "\n" and not lines:
                return ended
            elif c.isspace() or c == "﻿":
                ended |= c == "\n"
                self.at += 1
            else:
                return ended
        return ended

    def peek(self, n: int = 1) -> str:
        return self.text[self.at : self.at + n]

    def quoted(self) -> str:
        if self.peek(3) == '"""':
            end = self.text.find('"""', self.at + 3)
            if end < 0:
                self.fail("an unfinished text")
            while self.text.startswith('"', end + 3):  # quotes in excess belong to the text
                end += 1
            found, self.at = self.text[self.at + 3 : end], end + 3
            return found
        found = re.compile(r'"(\\.|[^"\\\n])*"').match(self.text, self.at)
        if not found:
            self.fail("an unfinished text")
        self.at = found.end()
        return json.loads(found[0])

    def unquoted(self) -> str:
        start = self.at
        while self.at < len(self.text) and self.peek() not in _ENDS and self.peek(2) != "//":
            self.at += 1
        return self.text[start : self.at]

    def key(self) -> list[str]:
        """A path: names divided by dots, each quoted or not."""
        path: list[str] = []
        name: list[tuple[bool, str]] = []  # (quoted, text) of the name so far

        def finished() -> str:
            """The name; blanks around unquoted text at its ends do not belong to it."""
            texts = [t for _, t in name]
            if name and not name[0][0]:
                texts[0] = texts[0].lstrip()
            if name and not name[-1][0]:
                texts[-1] = texts[-1].rstrip()
            if not "".join(texts):
                self.fail("a key is missing")
            return "".join(texts)

        while True:
            c = self.peek()
            if c == '"':
                name = [n for n in name if n[0] or n[1].strip()] + [(True, self.quoted())]
            elif c and c not in _ENDS:
                *whole, rest = self.unquoted().split(".")
                for part in whole:
                    name = name + [(False, part)] if part.strip() or not name else name
                    path.append(finished())
                    name = []
                if rest.strip():
                    name.append((False, rest))
            else:
                return [*path, finished()]

    def members(self, closing: str) -> dict:
        found: dict = {}
        while True:
            self.skip()
            while self.peek() == ",":
                self.at += 1
                self.skip()
            if self.peek() == closing:
                self.at += len(closing)
                return found
            if not self.peek():
                self.fail(f"'{closing}' is missing") if closing else None
                return found
            path = self.key()
            if path[0].split(maxsplit=1)[:1] == ["include"] and self.peek() not in "=:{":
                self.fail("include is not supported")
            self.skip()
            add = self.peek(2) == "+="
            if add:
                self.at += 2
            elif self.peek() in ("=", ":"):
                self.at += 1
            elif self.peek() != "{":
                self.fail(f"no value for {'.'.join(path)}")
            self.put(found, path, self.value(), add)

    @staticmethod
    def put(into: dict, path: list[str], value, add: bool) -> None:
        for name in path[:-1]:
            if not isinstance(into.get(name), dict):
                into[name] = {}
            into = into[name]
        name, before = path[-1], into.get(path[-1], _NOTHING)
        if add:
            into[name] = _Joined([[] if before is _NOTHING else before, [value]])
        elif isinstance(value, dict) and isinstance(before, dict):
            _merge(before, value)
        elif before is not _NOTHING and isinstance(value, dict) and isinstance(before, (_Joined, _Substitution)):
            into[name] = _Joined([before, value])
        else:
            into[name] = value

    def value(self):
        """Values next to each other, up to the end of the line, a comma or a closing bracket."""
        parts: list = []
        self.skip()
        while True:
            blank_from = self.at
            self.skip(lines=False)
            blank = self.text[blank_from : self.at] if parts and "#" not in self.text[blank_from : self.at] else ""
            c = self.peek()
            if not c or c in ",}]\n":
                break
            if blank.strip() == "" and blank and parts:
                parts.append(blank)
            if c == "{":
                self.at += 1
                parts.append(self.members("}"))
            elif c == "[":
                self.at += 1
                parts.append(self.items())
            elif c == '"':
                parts.append(("text", self.quoted()))
            elif c == "$":
                found = re.compile(r"\$\{(\??)\s*([^}\n]+?)\s*\}").match(self.text, self.at)
                if not found:
                    self.fail("an unfinished substitution")
                self.at = found.end()
                parts.append(_Substitution(found[2], bool(found[1])))
            else:
                text = self.unquoted()
                if not text:
                    self.fail(f"unexpected {c!r}")
                parts.append(text)
        while parts and isinstance(parts[-1], str) and not parts[-1].strip():
            parts.pop()
        if not parts:
            self.fail("a value is missing")
        if len(parts) > 1:
            return _Joined(parts)
        return _plain(parts[0])

    def items(self) -> list:
        found: list = []
        while True:
            self.skip()
            while self.peek() == ",":
                self.at += 1
                self.skip()
            if self.peek() == "]":
                self.at += 1
                return found
            if not self.peek():
                self.fail("']' is missing")
            found.append(self.value())


def _plain(part):
    """The value of one part: quoted text as it is, other text as a word or number if it is one."""
    if isinstance(part, tuple):
        return part[1]
    if not isinstance(part, str):
        return part
    text = part.strip()
    if text in _WORDS:
        return _WORDS[text]
    if _NUMBER.match(text):
        return float(text) if re.search("[.eE]", text) else int(text)
    return text


def _merge(into: dict, more: dict) -> None:
    for k, v in more.items():
        if isinstance(v, dict) and isinstance(into.get(k), dict):
            _merge(into[k], v)
        else:
            into[k] = v


class _Resolver:
    def __init__(self, root: dict):
        self.root, self.open = root, []

    def find(self, path: str):
        at = self.root
        for name in re.findall(r'"[^"]*"|[^.]+', path):
            name = name.strip('"').strip()
            at = self.value(at) if isinstance(at, (_Joined, _Substitution)) else at
            if not isinstance(at, dict) or name not in at:
                return _NOTHING
            at = at[name]
        return at

    def value(self, v):
        """``v`` without substitutions; ``_NOTHING`` for an optional one that leads nowhere."""
        if isinstance(v, dict):
            pairs = ((k, self.value(x)) for k, x in v.items())
            return {k: x for k, x in pairs if x is not _NOTHING}
        if isinstance(v, list):
            return [x for x in map(self.value, v) if x is not _NOTHING]
        if isinstance(v, _Substitution):
            if v.path in self.open:
                raise HoconError(f"${{{v.path}}} leads to itself")
            self.open.append(v.path)
            found = self.find(v.path)
            found = found if found is _NOTHING else self.value(found)
            self.open.pop()
            if found is _NOTHING and not v.optional:
                raise HoconError(f"${{{v.path}}} leads nowhere")
            return found
        return self.joined(v.parts) if isinstance(v, _Joined) else v

    def joined(self, parts: list):
        known = [(p, p[1] if isinstance(p, tuple) else p if isinstance(p, str) else self.value(p)) for p in parts]
        known = [(p, v) for p, v in known if v is not _NOTHING]
        solid = [v for p, v in known if not (isinstance(p, str) and not p.strip())]
        if not solid:
            return _NOTHING
        if all(isinstance(v, dict) for v in solid):
            out: dict = {}
            for v in solid:
                _merge(out, v)
            return out
        if all(isinstance(v, list) for v in solid):
            return [x for v in solid for x in v]
        if any(isinstance(v, (dict, list)) for v in solid):
            raise HoconError("objects, lists and texts cannot be joined")
        if len(solid) == 1:
            return _plain(solid[0]) if isinstance(solid[0], str) and isinstance(known[0][0], str) else solid[0]
        text = [json.dumps(v) if isinstance(v, bool) or v is None else str(v) for _, v in known]
        return "".join(text).strip() if isinstance(parts[0], str) or isinstance(parts[-1], str) else "".join(text)


def loads(text: str) -> dict:
    """The config in ``text``."""
    reader = _Reader(text)
    reader.skip()
    if reader.peek() == "{":
        reader.at += 1
        root = reader.members("}")
        reader.skip()
        if reader.peek():
            reader.fail("text behind the config")
    else:
        root = reader.members("")
    return _Resolver(root).value(root)
