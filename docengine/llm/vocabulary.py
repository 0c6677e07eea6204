"""What a register's names are made of beside the names of places: data that the operators are given."""

from __future__ import annotations

from dataclasses import dataclass, field

from .lcs import lcs_ratio

ALIKE, LEAST = 0.85, 6  # likeness to a known word, and letters from which a typing variant counts


@dataclass(frozen=True)
class Vocabulary:
    """``kinds``: codes that acronyms end with; ``phrases``: kinds by phrase; ``words``: codes by word, parted by blanks, none for a
    word without a kind; ``fillers``: words that are no part of a name. All in lower case without marks, but for the codes."""

    kinds: tuple[str, ...] = ()
    phrases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    words: dict[str, str] = field(default_factory=dict)
    fillers: frozenset[str] = frozenset()

    memo: dict[str, list[str] | None] = field(default_factory=dict, compare=False, repr=False)

    def codes(self, word: str) -> list[str] | None:
        """Codes of a known word, of two known words written as one, or of a word of which it is a typing variant; None if it is unknown."""
        if word not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[word] = self._codes(word)
        return self.memo[word]

    def _codes(self, word: str) -> list[str] | None:
        words = self.words
        if word in words:
            return words[word].split()
        for i in range(3, len(word) - 2):
            if word[:i] in words and word[i:] in words:
                return [*words[word[:i]].split(), *words[word[i:]].split()]
        if len(word) >= LEAST:
            letters = set(word)
            near = [(-lcs_ratio(w, word), w) for w in words if len(w) >= LEAST and abs(len(w) - len(word)) <= 1 and len(letters.difference(w)) <= 2]
            if near and -min(near)[0] >= ALIKE:
                return words[min(near)[1]].split()
        return None


# Codes of the kinds of marine facility, as acronyms end with them.
KINDS = ("BTF", "BTS", "FL", "MTB", "NMEPG", "OETA", "TGP", "TSDZ", "TT", "TTS", "WETC", "WTS")
# Phrases for a kind in other languages, without marks.
PHRASES = {
    "site d'essais houlomoteur": ("WTS", "WETC"), "centro de ensayos de olas": ("WTS", "WETC"), "site d'essais hydrolien": ("TTS", "TSDZ"), "zona de ensayos de mareas": ("TTS", "TSDZ"),
    "zone d'essais en mer": ("OETA",), "area de ensayos marinos": ("OETA",), "centre national d'essais marins": ("NMEPG",), "centro nacional de ensayos marinos": ("NMEPG",),
    "bassin de traction": ("TT",), "bassin d'essais marin": ("MTB",), "estacion de ensayo en dique": ("BTS",), "station d'essai sur digue": ("BTS",), "banco de ensayo de palas": ("BTF",),
    "banc d'essai de pales": ("BTF",), "laboratoire de canal hydraulique": ("FL",), "laboratorio de canal": ("FL",), "planta de gradiente termico": ("TGP",), "centrale thermique des mers": ("TGP",), "canal de remolque": ("TT",), "tanque de ensayos marinos": ("MTB",),
}
# Words and abbreviations that speak for kinds.
WORDS = {
    "blade": "BTF", "facility": "BTF", "facil": "BTF", "fac": "BTF", "blattprufstand": "BTF", "breakwater": "BTS", "station": "BTS", "stn": "BTS", "sta": "BTS", "flume": "FL", "laboratory": "FL", "lab": "FL", "labs": "FL",
    "stromungslabor": "FL", "basin": "MTB", "bsn": "MTB", "meeresversuchsbecken": "MTB", "marine": "MTB NMEPG", "marin": "MTB NMEPG", "mar": "MTB NMEPG", "national": "NMEPG", "natl": "NMEPG", "nat'l": "NMEPG", "nat": "NMEPG", "proving": "NMEPG", "ground": "NMEPG",
    "ocean": "OETA", "oc": "OETA", "area": "OETA", "thermal": "TGP", "gradient": "TGP", "plant": "TGP", "plt": "TGP", "stream": "TSDZ", "demonstration": "TSDZ", "demo": "TSDZ", "dem": "TSDZ", "zone": "TSDZ", "zn": "TSDZ", "tidal": "TTS TSDZ", "tid": "TTS TSDZ",
    "towing": "TT", "tank": "TT", "tk": "TT", "schlepptank": "TT", "wave": "WTS WETC", "centre": "WETC", "center": "WETC", "ctr": "WETC", "cen": "WETC", "energy": "WETC NMEPG OETA", "engy": "WETC NMEPG OETA", "en": "WETC NMEPG OETA",
    "site": "TTS WTS", "ts": "TTS WTS", "test": "", "testing": "", "tst": "",
}
# Words that are no part of a place's name.
FILLERS = {"the", "old", "at", "of", "and", "de", "du", "des", "la", "le", "der", "in"}

MARINE = Vocabulary(KINDS, PHRASES, WORDS, frozenset(FILLERS))
