"""Formulas in TeX's notation as plain text.

A scanner gives commands, braces and text; commands take their arguments, nested to any depth, from what follows.  There is
no recursion, so depth has no limit.  Braces that don't match are closed at the end of the text, or ignored.
"""

from __future__ import annotations

import re
import unicodedata

_SCAN = re.compile(r"\\(?P<name>[A-Za-z]+)\*?[ ]?|\\(?P<sign>.)|(?P<brace>[{}\[\]])|(?P<text>[^\\{}\[\]]+)|(?P<end>\\$)", re.S)

#: Signs by the names of their commands; Greek letters by Unicode's names.
SIGNS = {
    "times": "×", "pm": "±", "mp": "∓", "cdot": "·", "div": "÷", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "ll": "≪", "gg": "≫",
    "approx": "≈", "sim": "∼", "simeq": "≃", "equiv": "≡", "propto": "∝", "infty": "∞", "to": "→", "rightarrow": "→", "leftarrow": "←", "leftrightarrow": "↔", "Rightarrow": "⇒",
    "partial": "∂", "nabla": "∇", "sum": "∑", "prod": "∏", "int": "∫", "circ": "∘", "degree": "°", "prime": "′", "ldots": "…", "cdots": "⋯", "dots": "…",
    "in": "∈", "notin": "∉", "subset": "⊂", "cup": "∪", "cap": "∩", "forall": "∀", "exists": "∃", "hbar": "ℏ", "ell": "ℓ", "perp": "⊥", "parallel": "∥", "langle": "⟨", "rangle": "⟩",
    "bullet": "•", "dagger": "†", "AA": "Å", "aa": "å", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "ss": "ß", "quad": " ", "qquad": " ", "lbrace": "{", "rbrace": "}",
}
SIGNS |= {n: unicodedata.lookup(f"GREEK SMALL LETTER {'LAMDA' if n == 'lambda' else n.upper()}") for n in "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi chi psi omega".split()}
SIGNS |= {n: unicodedata.lookup(f"GREEK CAPITAL LETTER {'LAMDA' if n == 'Lambda' else n.upper()}") for n in "Gamma Delta Theta Lambda Xi Pi Sigma Upsilon Phi Psi Omega".split()}
SIGNS |= {"varepsilon": "ε", "varphi": "φ", "vartheta": "θ"}
#: Signs after a backslash.
ESCAPED = {",": " ", ";": " ", ":": " ", "!": "", " ": " ", "\\": " ", "\n": " ", "(": "", ")": "", "[": "", "]": "", "/": ""}
#: Marks over or under a letter, by command.
MARKS = {"hat": "\u0302", "widehat": "\u0302", "bar": "\u0304", "overline": "\u0304", "vec": "\u20d7", "tilde": "\u0303", "widetilde": "\u0303", "dot": "\u0307", "ddot": "\u0308", "acute": "\u0301", "grave": "\u0300", "check": "\u030c", "breve": "\u0306"}
MARKS |= {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "H": "\u030b", "r": "\u030a"}
#: Commands whose arguments are written in another way, with their number; all others are left out, and their arguments stay.
ARGUMENTS = {"frac": 2, "dfrac": 2, "tfrac": 2, "binom": 2, "sqrt": 1, "begin": 1, "end": 1, "label": 1, "color": 1}


def _written(name: str, args: list[str], option: str | None) -> str:
    a, b = (*args, "", "")[:2]
    if name in MARKS:
        return unicodedata.normalize("NFC", a[:1] + MARKS[name]) + a[1:] if a else ""
    if name.endswith("frac"):
        return f"{a}/{b}"
    if name == "binom":
        return f"({a} {b})"
    if name == "sqrt":
        return f"{option or ''}√({a})"
    return ""


class _Frame:
    """What stands between two braces: its text so far, and commands that wait for arguments."""

    def __init__(self, closer: str = ""):
        self.closer, self.out, self.waiting = closer, [], []

    def put(self, item: str) -> None:
        while self.waiting:
            name, args, _ = self.waiting[-1]
            args.append(item)
            # The columns of a table are an argument of its environment.
            if len(args) < (2 if name == "begin" and args[0] in ("array", "tabular") else ARGUMENTS.get(name, 1)):
                return
            item = _written(*self.waiting.pop())
        self.out.append(item)

    def closed(self) -> str:
        while self.waiting:
            self.out.append(_written(*self.waiting.pop(0)))
        return "".join(self.out)


def plain(t: str) -> str:
    """The text of a formula: fractions as a/b, roots as √(a), marks over their letters, names of signs as signs; other commands and braces go."""
    frames = [_Frame()]
    for m in _SCAN.finditer(t):
        top = frames[-1]
        name = m["name"] or (m["sign"] if m["sign"] in MARKS else None)
        if name in ("left", "right", "big", "Big", "bigl", "bigr", "displaystyle", "limits"):
            continue
        if name in MARKS or name in ARGUMENTS:
            top.waiting.append((name, [], None))
        elif name:
            if name in SIGNS:
                # A space after a sign's name only ends the name, unless a word follows that it would stick to.
                top.put(SIGNS[name] + (" " if m[0].endswith(" ") else ""))
        elif m["sign"]:
            top.put(ESCAPED.get(m["sign"], m["sign"]))
        elif m["brace"] == "{":
            frames.append(_Frame("}"))
        elif m["brace"] == "[" and top.waiting and top.waiting[-1][0] == "sqrt" and not top.waiting[-1][1]:
            frames.append(_Frame("]"))
        elif m["brace"] == "}":
            while len(frames) > 1 and frames[-1].closer == "]":
                _unclosed(frames)
            if len(frames) > 1:
                item = frames.pop().closed()
                frames[-1].put(item)
        elif m["brace"] == "]" and top.closer == "]":
            option = frames.pop().closed()
            name, args, _ = frames[-1].waiting.pop()
            frames[-1].waiting.append((name, args, option))
        elif m["brace"]:
            top.put(m["brace"])
        elif m["text"]:
            text = m["text"]
            while top.waiting and text.strip():
                text = text.lstrip()
                top.put(text[0])
                text = text[1:]
            if text and not (top.waiting and not text.strip()):
                top.out.append(text)
    while len(frames) > 1:
        _unclosed(frames)
    return frames[0].closed()


def _unclosed(frames: list[_Frame]) -> None:
    """An opened bracket or brace without its end: an option is text after all."""
    frame = frames.pop()
    frames[-1].put(("[" if frame.closer == "]" else "") + frame.closed())
