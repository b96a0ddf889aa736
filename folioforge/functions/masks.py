"""Parts of a text that are not read as text, and brackets that do not pair outside them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What is not rendered, the earlier form first where two begin at one place.
HIDDEN = {
    "frontmatter": r"\A---\n.*?^---[ \t]*$",
    "fence": r"^ {0,3}(?P<mark>```+|~~~+)[^\n]*$.*?(?:^ {0,3}(?P=mark)[ \t]*$|\Z)",
    "comment": r"<!--.*?-->",
    "code": r"(?<!`)(?P<ticks>`+)(?!`)[^\n]*?(?<!`)(?P=ticks)(?!`)",
    "target": r"(?<=\])\([^()\n]*\)",
}
# Pairs of delimiters.
PAIRS = {"“": "”", "‘": "’", "「": "」", "『": "』", "（": "）", "［": "］", "〈": "〉", "《": "》", "【": "】", "〔": "〕"}

_HIDDEN = re.compile("|".join(f"(?:{x})" for x in HIDDEN.values()), re.M | re.S)
_VISIBLE = re.compile(r"[^\n]")
_DELIMITER = re.compile("[" + re.escape("".join(PAIRS) + "".join(PAIRS.values())) + "]")


def masked(text: str, mark: str = " ") -> str:
    """The text with hidden parts overwritten; length and line feeds stay, so places do too."""
    return _HIDDEN.sub(lambda m: _VISIBLE.sub(mark, m.group()), text)


def unpaired(text: str) -> list[tuple[int, str, str]]:
    """Place, code and sign of every delimiter that does not pair, over one stack of all kinds.

    Each kind also keeps the list of its open places, so a closer finds its opener without
    a walk down the stack: it is out of order if another kind was opened later and is open
    still, and such an opener leaves from the middle.
    """
    closes = {b: a for a, b in PAIRS.items()}
    opened: dict[str, list[int]] = {a: [] for a in PAIRS}
    stack: list[int] = []
    gone: set[int] = set()
    out = []
    for m in _DELIMITER.finditer(text):
        ch, at = m.group(), m.start()
        if ch in PAIRS:
            opened[ch].append(at)
            stack.append(at)
        elif not opened[closes[ch]]:
            out.append((at, "unmatched-closing-delimiter", ch))
        else:
            own = opened[closes[ch]].pop()
            gone.add(own)
            if stack[-1] != own:
                out.append((at, "misnested-closing-delimiter", ch))
            while stack and stack[-1] in gone:
                gone.discard(stack.pop())
    out += [(at, "unmatched-opening-delimiter", ch) for ch, places in opened.items() for at in places]
    return sorted(out)


def mask(text: Column, mark: str = " ") -> Column:
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([masked(t, mark) if t is not None else None for t in x], dtype=object)

    return run(text)


def delimiter_problems(text: Column) -> Column:
    """Array of place (from 0), code and sign; hidden parts are passed over."""

    @F.pandas_udf("array<struct<place:long,code:string,sign:string>>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([[{"place": p, "code": c, "sign": s} for p, c, s in unpaired(masked(t or ""))] for t in x], dtype=object)

    return run(text)
