"""Service codes in free text: markers, run-together codes, groups, and what a line is.

``Codes`` is plain Python, for grouped operators; ``service_tokens`` is the
Arrow form over a column, whose result explodes into rows.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean

# Patterns of printed service lists.
TOKEN = re.compile(r"\b(?:[A-Z][A-Z0-9-]{0,7}|[FN]\d{1,3})\b")
GROUP_NUMBER = re.compile(r"(?:^|\s)(?:[1-9]|[12]\d|3[01])(?:\s|$)")
NUMBERED = re.compile(r"[FN]\d{1,3}")
CONTACT_WORDS = {"PHONE", "INTAKE", "TOLL", "FREE", "HOTLINE"}
ALIASES = {"PL": "PI"}
BULLETS = "♦◆◇◊■▪●•·�"
MARKERS = (
    (r"\b[Ii]'(?=\d)", "F"),
    (r"(?<=\d)(?=[FN]\d)", " "),
    (r"\(cid:\d+\)", " | "),
    (f"[{BULLETS}]+", " | "),
    (r"(?<![A-Za-z0-9])[sS](?![A-Za-z0-9])", " | "),
)


def normalize_markers(text: str | None) -> str:
    """Group markers in every printed form become bars."""
    out = []
    for char in text or "":
        number = unicodedata.numeric(char, None)
        if number is not None and "CIRCLED" in unicodedata.name(char, "") and float(number).is_integer():
            out.append(f" |{int(number)}| ")
        else:
            out.append(char)
    value = unicodedata.normalize("NFKC", "".join(out))
    for pattern, new in MARKERS:
        value = re.sub(pattern, new, value)
    return clean(value)


class Codes:
    """Codes known in one directory: those asked and those of the fallback list."""

    def __init__(self, known):
        self.known = frozenset(known)
        self.split = lru_cache(maxsize=50_000)(self._split)

    def _split(self, token: str) -> tuple[str, ...] | None:
        """Fewest known pieces of two letters or more, longest first piece at ties; None if there are not two."""
        if token in self.known:
            return (token,)
        best: list[tuple[str, ...] | None] = [None] * len(token) + [()]
        for at in range(len(token) - 2, -1, -1):
            options = [(token[at:end], *best[end]) for end in range(len(token), at + 1, -1) if best[end] is not None and token[at:end] in self.known]
            best[at] = min(options, key=len, default=None)
        return best[0] if best[0] and len(best[0]) > 1 else None

    def pieces(self, token: str) -> tuple[str, ...]:
        alias = ALIASES.get(token, token)
        token = alias if alias in self.known else token
        return self.split(token) or (token,)

    def is_known(self, code: str) -> bool:
        return code in self.known or bool(NUMBERED.fullmatch(code))

    def parse(self, text: str | None, delimiter: str) -> tuple[list[tuple[int, str]], list[str]]:
        """((group, code) in order, each once; unknown tokens in order, each once)."""
        value = normalize_markers(text)
        groups = re.split(r"\s*/\s*", value) if delimiter == "slash" else re.split(r"\|\d*\||\|", value)
        found: dict[tuple[int, str], None] = {}
        unknown: dict[str, None] = {}
        for group, part in enumerate(groups, start=1):
            for token in TOKEN.findall(part.upper()):
                for code in () if token in CONTACT_WORDS else self.pieces(token):
                    (found if self.is_known(code) else unknown)[(group, code) if self.is_known(code) else code] = None
        return list(found), list(unknown)

    def is_service_line(self, line: str) -> bool:
        """Whether a line reads as codes rather than prose."""
        value = normalize_markers(line)
        if re.search(r"\|\d+\|", value):
            return True
        tokens = TOKEN.findall(value.upper())
        pieces = [p for t in tokens for p in self.pieces(t)]
        hits = sum(map(self.is_known, pieces))
        if not hits:
            return False
        share, lower = hits / len(pieces), any(c.islower() for c in value)
        return bool(
            GROUP_NUMBER.search(value) or len(re.findall(r"[+&~/]", value)) >= 2 or (len(tokens) == 1 and hits == 1 and len(value) <= 4) or (hits >= 3 and share >= 0.60) or (not lower and share >= 0.35)
        )


def service_tokens(text: Column, known: list[str], delimiter: str = "circled") -> Column:
    """struct(codes: array of (group_index, code), unknown: array) of each text."""

    def run(texts: pd.Series) -> pd.DataFrame:
        codes = Codes(known)
        parsed = [codes.parse(t, delimiter) for t in texts]
        return pd.DataFrame({"codes": [[{"group_index": str(g), "code": c} for g, c in p[0]] for p in parsed], "unknown": [p[1] for p in parsed]})

    return F.pandas_udf(run, "codes array<struct<group_index:string,code:string>>, unknown array<string>")(text)


def split_codes(token: Column, known: list[str]) -> Column:
    """Pieces of run-together codes; null where a token doesn't part into known ones."""

    def run(tokens: pd.Series) -> pd.Series:
        codes = Codes(known)
        return tokens.map(lambda t: None if t is None or codes.split(t) is None else list(codes.split(t)))

    return F.pandas_udf(run, "array<string>")(token)
