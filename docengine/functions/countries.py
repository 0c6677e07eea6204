"""Country names in one form."""

from __future__ import annotations

import re

# Other forms of country names.
OTHER_FORMS = {
    "usa": "united states", "us": "united states", "u.s.": "united states", "u.s.a.": "united states", "united states of america": "united states", "uk": "united kingdom", "u.k.": "united kingdom", "gb": "united kingdom",
    "great britain": "united kingdom", "britain": "united kingdom", "england": "united kingdom", "scotland": "united kingdom", "wales": "united kingdom", "northern ireland": "united kingdom", "eire": "ireland", "republic of ireland": "ireland",
    "ie": "ireland", "irl": "ireland", "fr": "france", "dk": "denmark", "danmark": "denmark", "no": "norway", "norge": "norway", "se": "sweden", "sverige": "sweden", "es": "spain", "españa": "spain", "espana": "spain", "pt": "portugal",
    "cn": "china", "p.r. china": "china", "pr china": "china", "prc": "china", "people's republic of china": "china", "kr": "republic of korea", "korea": "republic of korea", "south korea": "republic of korea", "s. korea": "republic of korea",
    "korea, republic of": "republic of korea", "rok": "republic of korea", "nl": "netherlands", "the netherlands": "netherlands", "holland": "netherlands", "nederland": "netherlands", "be": "belgium", "belgië": "belgium", "belgique": "belgium",
    "it": "italy", "italia": "italy", "jp": "japan", "nippon": "japan", "ca": "canada", "cl": "chile", "mx": "mexico", "méxico": "mexico", "in": "india", "nz": "new zealand", "au": "australia", "sg": "singapore", "mc": "monaco",
    "de": "germany", "deutschland": "germany",
}


def canonical_country(text: str | None) -> str:
    """The usual name, lower case; blank where missing."""
    name = re.sub(r"\s+", " ", text or "").strip().lower()
    return OTHER_FORMS.get(name, name)
