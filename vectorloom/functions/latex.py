"""LaTeX markup to readable text with built-in expressions only.

This is a stated subset: comments, line breaks, math delimiters, environments,
symbol macros, accents, fractions, roots, citations, references and links.
An unknown macro is dropped and its braced argument kept.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_GREEK = (
    "alpha beta gamma delta zeta eta theta iota kappa lambda mu nu xi omicron pi rho "
    "sigma tau upsilon chi psi omega"
).split()

# Macros whose text is not given by the Greek rule below.
_FIXED_SYMBOLS = {
    "epsilon": "ϵ", "varepsilon": "ε", "phi": "ϕ", "varphi": "φ", "Phi": "Φ",
    "vartheta": "ϑ", "varrho": "ϱ", "varsigma": "ς", "varpi": "ϖ",
    "times": "×", "div": "÷", "pm": "±", "mp": "∓", "cdot": "·", "ast": "∗", "star": "⋆",
    "circ": "∘", "bullet": "∙", "oplus": "⊕", "ominus": "⊖", "otimes": "⊗", "odot": "⊙",
    "dagger": "†", "ddagger": "‡", "cap": "∩", "cup": "∪", "wedge": "∧", "vee": "∨",
    "setminus": "∖", "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠",
    "ll": "≪", "gg": "≫", "lesssim": "≲", "gtrsim": "≳", "sim": "∼", "simeq": "≃",
    "approx": "≈", "equiv": "≡", "cong": "≅", "propto": "∝", "in": "∈", "ni": "∋",
    "notin": "∉", "subset": "⊂", "supset": "⊃", "subseteq": "⊆", "supseteq": "⊇",
    "emptyset": "∅", "forall": "∀", "exists": "∃", "neg": "¬", "nabla": "∇", "partial": "∂",
    "infty": "∞", "sum": "∑", "prod": "∏", "int": "∫", "oint": "∮", "perp": "⊥",
    "parallel": "∥", "mid": "∣", "angle": "∠", "langle": "⟨", "rangle": "⟩", "lceil": "⌈",
    "rceil": "⌉", "lfloor": "⌊", "rfloor": "⌋", "to": "→", "rightarrow": "→",
    "leftarrow": "←", "leftrightarrow": "↔", "Rightarrow": "⇒", "Leftarrow": "⇐",
    "Leftrightarrow": "⇔", "mapsto": "↦", "uparrow": "↑", "downarrow": "↓",
    "longrightarrow": "⟶", "longleftarrow": "⟵", "hbar": "ℏ", "ell": "ℓ", "Re": "ℜ",
    "Im": "ℑ", "aleph": "ℵ", "prime": "′", "dots": "…", "ldots": "…", "cdots": "⋯",
    "vdots": "⋮", "ddots": "⋱", "sqrt": "√", "ss": "ß", "ae": "æ", "AE": "Æ", "oe": "œ",
    "OE": "Œ", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "aa": "å", "AA": "Å", "i": "ı",
    "j": "ȷ", "S": "§", "P": "¶", "copyright": "©", "pounds": "£", "degree": "°",
    "item": " * ", "quad": "  ", "qquad": "    ", "LaTeX": "LaTeX", "TeX": "TeX",
    "sin": "sin", "cos": "cos", "tan": "tan", "log": "log", "ln": "ln", "exp": "exp",
    "lim": "lim", "min": "min", "max": "max", "inf": "inf", "sup": "sup", "det": "det",
    "dim": "dim", "ker": "ker", "arg": "arg", "deg": "deg", "gcd": "gcd", "Pr": "Pr",
}
# Accent macro -> combining character.
_ACCENTS = {
    "`": "\u0300", "'": "\u0301", "^": "\u0302", "~": "\u0303", "=": "\u0304", "u": "\u0306",
    ".": "\u0307", '"': "\u0308", "r": "\u030a", "H": "\u030b", "v": "\u030c", "d": "\u0323",
    "c": "\u0327", "k": "\u0328", "b": "\u0331",
}


def _symbols() -> dict[str, str]:
    table = {}
    for name in _GREEK:
        spelled = "LAMDA" if name == "lambda" else name.upper()
        table[name] = unicodedata.lookup(f"GREEK SMALL LETTER {spelled}")
        table[name.capitalize()] = unicodedata.lookup(f"GREEK CAPITAL LETTER {spelled}")
    return {**table, **_FIXED_SYMBOLS}


def _accented() -> dict[str, str]:
    """Every accent and letter that Unicode has as one composed character."""
    table = {}
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123))]
    for accent, mark in _ACCENTS.items():
        for letter in letters:
            composed = unicodedata.normalize("NFC", letter + mark)
            if len(composed) == 1:
                table[accent + letter] = composed
    return table


def _sql_map(table: dict[str, str]) -> str:
    quoted = ("'" + x.replace("'", "\\'") + "'" for pair in table.items() for x in pair)
    return f"map({', '.join(quoted)})"


@cache
def _lookups() -> tuple[str, str]:
    """SQL of the symbol and accent tables; written as text, they are built in one call.

    Symbols are grouped by first letter, as literal maps are searched from the front.
    """
    groups: dict[str, dict[str, str]] = {}
    for name, value in _symbols().items():
        groups.setdefault(name[0], {})[name] = value
    symbols = ", ".join(f"'{letter}', {_sql_map(group)}" for letter, group in groups.items())
    return f"map({symbols})", _sql_map(_accented())


# Escaped characters wait as noncharacters, which no text may carry.
_ESCAPED = "$%&#_{}"
_WAITING = "".join(chr(0xFDD0 + i) for i in range(len(_ESCAPED)))
# Marks an accent in its short form: backslash, mark, accent, letter.
_ACCENT = "\ufdd8"
_ARG = r"\s*\{([^{}]*)\}"
# Macros with arguments, innermost first, repeated for nesting.
_ARGUMENT_RULES = (
    (r"\\(?:text|textbf|textit|textrm|textsf|texttt|textsc|emph|mathrm|mathbf|mathit|mathsf"
     r"|mathcal|mathbb|mathfrak|mathscr|boldsymbol|bm|operatorname|mbox|hbox|underline|overline"
     r"|bar|hat|tilde|vec|dot|ddot)\*?" + _ARG, "$1"),
    (r"\\[dt]?frac" + _ARG + _ARG, "$1/$2"),
    (r"\\sqrt" + _ARG, "√($1)"),
    (r"\\footnote" + _ARG, "[$1]"),
    (r"\\href" + _ARG + _ARG, "$2 <$1>"),
    (r"\\url" + _ARG, "<$1>"),
    (r"\\cite[a-zA-Z]*\*?(?:\[[^\]]*\])*" + _ARG, "<cit.>"),
    (r"\\(?:ref|autoref|cref)" + _ARG, "<ref>"),
    (r"\\eqref" + _ARG, "(<ref>)"),
    (r"\\label" + _ARG, ""),
    (r"\\begin\{(?:array|tabular)\*?\}(?:\[[^\]]*\])?" + _ARG, " "),
    (r"\\(?:begin|end)" + _ARG, " "),
)
_BRACES = r"[^{}]"


def _arguments(text: Column) -> Column:
    """Macros with arguments, innermost first, as many rounds as the text's braces are deep."""

    def one_round(current: Column, _: Column) -> Column:
        changed = current
        for pattern, replacement in _ARGUMENT_RULES:
            changed = F.regexp_replace(changed, pattern, replacement)
        return F.when(F.rlike(current, F.lit(r"\\[A-Za-z]+\*?\s*[\[{]")), changed).otherwise(current)

    braces = F.split(F.regexp_replace(text, _BRACES, ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(1).alias("most"))

    def step(state: Column, sign: Column) -> Column:
        now = F.greatest(state["now"] + F.when(sign == "{", 1).when(sign == "}", -1).otherwise(0), F.lit(0))
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    depth = F.aggregate(braces, start, step, lambda state: state["most"])
    return F.aggregate(F.sequence(F.lit(1), depth), text, one_round)


def _accents(text: Column) -> Column:
    """All ways to write an accent brought to the short form."""
    text = F.regexp_replace(text, r"\\([`'^\"~=.])\s*\{?\\([ij])(?![A-Za-z])\}?", r"\\$1{$2}")
    text = F.regexp_replace(text, r"\\([`'^\"~=.])\s*\{?([A-Za-z])\}?", rf"\\{_ACCENT}$1$2")
    return F.regexp_replace(
        text, r"\\([cvuHkrbd])(?:\s*\{([A-Za-z])\}|\s+([A-Za-z])(?![A-Za-z]))", rf"\\{_ACCENT}$1$2$3"
    )


# Finds a text that the rules below could change, in one pass: one comparison for a letter.
_MARKUP = r"[\\%${}~&`'-](?<=[\\%${}~&]|--|``|''|!`|\?`)"


def _plain(text: Column) -> Column:
    """Characters that mean something without a backslash."""
    # Two patterns are several times faster than translate(), which looks up every character.
    text = F.regexp_replace(F.regexp_replace(text, "[${}]", ""), "[~&]", " ")
    for source, target in (("---", "—"), ("--", "–"), ("``", "“"), ("''", "”"), ("!`", "¡"), ("?`", "¿")):
        text = F.replace(text, F.lit(source), F.lit(target))
    return text


def _piece(piece: Column, symbols: Column, accented: Column) -> Column:
    """One backslash and what follows it, up to the next backslash."""
    second = F.substring(piece, 2, 1)
    name = F.regexp_extract(piece, r"^.([A-Za-z]+)", 1)
    symbol = F.try_element_at(F.try_element_at(symbols, second), name)
    return (
        F.when(~F.startswith(piece, F.lit("\\")), piece)
        .when(
            second == F.lit(_ACCENT),
            F.concat(
                F.coalesce(F.try_element_at(accented, F.substring(piece, 3, 2)), F.substring(piece, 4, 1)),
                F.substring(piece, 5, _REST),
            ),
        )
        .when(
            F.rlike(second, F.lit("[A-Za-z]")),
            F.concat(F.coalesce(symbol, F.lit("")), F.substr(piece, F.length(name) + 2)),
        )
        .otherwise(
            F.concat(F.when(second.isin(*",;: /"), F.lit(" ")).otherwise(F.lit("")), F.substring(piece, 3, _REST))
        )
    )


# "To the end" for substring().
_REST = 2**31 - 1


def latex_to_text(text: Column) -> Column:
    """Readable text of a LaTeX fragment; rows without a backslash take a short way, rows without any markup stay."""
    full = F.replace(text, F.lit("\\\\"), F.lit(" "))
    for escaped, waiting in zip(_ESCAPED, _WAITING):
        full = F.replace(full, F.lit("\\" + escaped), F.lit(waiting))
    full = _arguments(_accents(F.regexp_replace(full, r"%[^\n]*", "")))
    full = F.regexp_replace(full, r"(\\[A-Za-z]+)\*", "$1")
    symbols, accented = map(F.expr, _lookups())
    pieces = F.transform(F.split(full, r"(?=\\)"), lambda p: _piece(p, symbols, accented))
    restored = F.transform(
        F.array(_plain(F.array_join(pieces, ""))),
        lambda x: F.when(F.rlike(x, F.lit(f"[{_WAITING}]")), F.translate(x, _WAITING, _ESCAPED)).otherwise(x),
    )
    full = F.get(restored, F.lit(0))
    short = _plain(F.regexp_replace(text, r"%[^\n]*", ""))
    return F.when(~F.rlike(text, F.lit(_MARKUP)), text).when(F.contains(text, F.lit("\\")), full).otherwise(short)
