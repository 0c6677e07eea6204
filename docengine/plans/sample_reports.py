"""Small reports with country chapters, for the operators of chapters, sections and entries."""

from __future__ import annotations

_BODY = ["The work of the year went on as it had been planned by the people in charge of it.", "Nothing else of note has to be told of the other months of that year in this place."]


def _chapter(country: str, author: str, sections: list[tuple[str, list[str]]]) -> list[str]:
    out = [country, *([author] if author else [])]
    for heading, lines in sections:
        out += [heading, *lines]
    return out


_PROJECTS = ["Blue Head Array", "A turbine of 500 kW was installed off the Sovar Coast in 2016 and tested at sea until autumn.", "• A second device of 20 kW will be launched near Tebogan Bay in 2018.", "The buoy of 1.2 MW was removed in 2019 at a depth of 35 m, 3 km from shore."]

REPORTS = (
    (1, ["Contents", "DENMARK", "FRANCE", "SPAIN", *_BODY * 5, *_chapter("DENMARK", "Author: A. Person", [("OVERVIEW", _BODY * 5), ("PROJECTS IN THE WATER", _PROJECTS), ("OPEN SEA TEST SITES", ["The Blue Head Test Site is open to all devices of the sea."])]),
         *_chapter("FRANCE", "Report prepared by: B. Other", [("C. Third, Some Ministry", []), ("INTRODUCTION", _BODY * 6), ("Planned deployments", _PROJECTS[1:])]), "APPENDICES", *_BODY * 2]),
    (2, [*_chapter("1. SPAIN", "", [("National Strategy", _BODY * 6), ("R&D PROJECTS", _PROJECTS)]), "EUROPEAN", "COMMISSION", "SUPPORTING POLICIES", *_BODY * 9, "ITALY", *_BODY * 2, "JAPAN", "OVERVIEW", *_BODY * 8]),
    (3, ["A report without a chapter", *_BODY, "TECHNOLOGY DEMONSTRATION", *_PROJECTS, "REFERENCES", *_BODY]),
    (4, [*_chapter("KOREA", "", [("OVERVIEW", _BODY)]), *_BODY * 8, *_chapter("REPUBLIC OF KOREA", "AUTHORS", [("D. Fourth", []), ("E. Fifth", []), ("OVERVIEW", _BODY * 9), ("TEST SITES", _BODY), ("TEST SITE NAME", _BODY[:1])]), "Membership of the Executive Committee", *_BODY]),
    (5, []),
)
TEXTS = tuple((i, "\n".join(lines)) for i, lines in REPORTS)
