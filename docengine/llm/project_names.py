"""The parts of an undertaking's name: place, owner or device, kind of technology."""

from __future__ import annotations

import re
from functools import lru_cache

from .facility_names import folded
from .lcs import lcs_ratio

# Words of names that tell the kind, the stage or nothing.
GENERIC = set(
    """wave tidal tid test tst testing energy engy en power park farm converter conv turbine turb project proj prj marine mar marin stream current plant plt river array thermal ocean oc osmotic salinity otec barrage lagoon
    wind platform pilot demonstration demo dem prototype phase sea trial deployment site sites testsite facility facil fac centre center ctr cen station stn sta basin bsn laboratory lab labs flume tank towing blade breakwater
    gradient zone zn area ground proving national natl nat range hybrid by at the of and ts old new name open inc ltd gmbh sas sl as co renewables systems system company hydro blue energia turbines energies tech technology proto drive flow buoy""".split()
)
# Technologies a resource may stand for; others are open to all.
RESOURCES = {"wave": {"wave"}, "tidal": {"tidal stream", "tidal range"}, "riverine": {"river current"}, "ocean current": {"ocean current"}, "thermal gradient": {"otec"}, "salinity gradient": {"salinity gradient"}}
CLOSED = {"wave", "tidal stream", "tidal range", "river current", "ocean current", "otec", "salinity gradient"}
# Words of regions and waters that are no place of their own.
REGION = set("coast islands isles province county district region delta fjords shore outer southern central north upper lower west east cape harbour".split())

_LONG = sorted(g for g in GENERIC if len(g) >= 6)
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_SLUG = re.compile(r"https?://(?:www\.)?([a-z0-9]+)-([a-z0-9]+)\.")


@lru_cache(100_000)
def _words(text: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(folded(text)))


def words(text: str) -> list[str]:
    return list(_words(text))


@lru_cache(100_000)
def is_generic(word: str) -> bool:
    """Whether a word is generic, two such words in one, or a typing variant of one of six letters or more."""
    if word in GENERIC or any(word[:i] in GENERIC and word[i:] in GENERIC for i in range(3, len(word) - 2)):  # two written as one
        return True
    letters = set(word)
    # letters a word has alone bound the common subsequence from above
    return len(word) >= 6 and any(abs(len(g) - len(word)) <= 1 and len(letters.difference(g)) <= 2 and lcs_ratio(g, word) >= 0.85 for g in _LONG)


def telling(text: str) -> list[str]:
    """The words of a name that are neither kind nor stage nor number."""
    return [w for w in words(text) if len(w) > 3 and not any(c.isdigit() for c in w) and not is_generic(w)]


def slug(url: str) -> tuple[str, ...]:
    m = _SLUG.match((url or "").strip().lower())
    return m.groups() if m else ()


def place_of(name: str, device: str, developer: str, website: str, location: str) -> tuple[str, ...]:
    """The words of a project's place, from its website or what its name leaves beside device and developer."""
    if s := slug(website):
        return s
    text = folded(name or "")
    own = set(words(device or "")) | set(words(developer or "")[:1])
    for mark in (" at ", ","):
        head, found, tail = text.rpartition(mark)
        if found and (t := telling(tail)):
            return tuple(t)
    rest = [w for w in telling(text) if w not in own]
    return tuple(rest if len(rest) >= 2 else telling(text))


def owners(device: str, developer: str) -> tuple[str, ...]:
    """Words that name the device or the developer."""
    return tuple(dict.fromkeys(w for w in [*words(device or ""), *words(developer or "")] if len(w) > 3 and not is_generic(w)))


def lead_of(name: str) -> list[str]:
    """Words of an undertaking's name that can only be its developer's: before the mark that leads to the place, or after "by"."""
    text = folded(name or "")
    head, found, tail = text.rpartition(" by ")
    if found and telling(tail):
        return telling(tail)
    for mark in (" - ", " at ", ", "):
        head, found, tail = text.rpartition(mark)
        if found and len(telling(tail)) >= 1:
            lead = telling(head)
            return lead if len(lead) == 1 and words(head)[0] == lead[0] and not any(c.isdigit() for c in head) and len(words(head)) > 1 and is_generic(words(head)[1]) else []
    return []


def resource_fits(resource: str, technology: str) -> bool | None:
    """Whether resources and a technology can be one; None if either is open."""
    kinds = [k.strip() for k in (resource or "").lower().split(",") if k.strip() in RESOURCES]
    tech = (technology or "").lower().strip()
    if not kinds or tech not in CLOSED:
        return None
    return any(tech in RESOURCES[k] for k in kinds)
