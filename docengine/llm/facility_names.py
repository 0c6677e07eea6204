"""The parts of a facility's name as people type it: place, initials and kind."""

from __future__ import annotations

import re
import unicodedata

from .vocabulary import Vocabulary

_NOISE = re.compile(r"\[[^\]]*\]|\s[–-]\s*open sea site\b|\*", re.I)
_TOKEN = re.compile(r"[^\W\d_][\w'’.]*")


def folded(text: str) -> str:
    """Lower case, without marks."""
    text = unicodedata.normalize("NFKD", text).replace("’", "'").replace("ß", "ss")
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def _acronym(token: str, kinds: tuple[str, ...]) -> tuple[str, str] | None:
    """Initials of the place and the kind, if a token is an acronym of both."""
    up = token.upper()
    for kind in sorted(kinds, key=len, reverse=True):
        if len(up) == len(kind) + 2 and up.endswith(kind):
            return up[:2].lower(), kind
    return None


def parse(name: str, vocabulary: Vocabulary) -> dict | None:
    """``tokens`` (the place's words, in order), ``initials``, ``kinds`` (a set; empty: not told), ``acronym``; None if no place is named.

    What follows a comma is a region if a place stands before it, the place itself if only a kind does.
    """
    text = " ".join(folded(_NOISE.sub(" ", name)).split())
    kinds: set[str] = set()
    for phrase, codes in vocabulary.phrases.items():
        if phrase in text:
            kinds, text = set(codes), text.replace(phrase, " ")
            break
    votes: dict[str, float] = {}
    tokens: list[str] = []
    initials: list[str] = []
    acronym = None
    for part in text.split(","):
        mine, single = [], []
        for raw in _TOKEN.findall(part.replace("-", " ").replace("/", " ")):
            t = raw.rstrip(".'")
            codes = None if t in vocabulary.fillers else vocabulary.codes(t)
            if codes is not None:
                for c in codes:
                    votes[c] = votes.get(c, 0) + 1 / len(codes)
            elif t in vocabulary.fillers:
                continue
            elif len(t) == 1:
                single.append((t, len(mine)))
            elif 4 <= len(t) <= 7 and (found := _acronym(t, vocabulary.kinds)) and (sum(c in "aeiou" for c in t) < 2 or raw.isupper() or sum(c in "AEIOU" for c in found[1]) > 1):
                acronym = found
            else:
                mine.append(t.replace("'", ""))
        if mine:
            tokens = mine
            initials = single
            break
        initials = initials or single
    if not tokens:
        return None
    if acronym:
        kinds = kinds or {acronym[1]}
    if not kinds and votes:
        top = max(votes.values())
        kinds = {k for k, v in votes.items() if v >= top - 1e-9}
    return {"tokens": tokens, "initials": [(c, p) for c, p in initials][:1], "kinds": kinds, "acronym": acronym[0] if acronym else ""}
