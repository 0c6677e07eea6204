"""Per-document statistics of text, to tell prose from lists, tables and junk."""

from __future__ import annotations

import math
import re
from collections import Counter
from operator import and_


NAMES = (
    "n_lines", "n_words", "mean_word_length", "mean_line_length", "line_length_spread", "symbol_ratio", "digit_ratio", "letter_ratio", "upper_ratio", "wide_ratio",
    "marked_share", "same_marker_share", "ended_share", "last_ended", "sentences_per_line", "words_per_sentence", "common_share", "cell_share", "same_cells_share", "cells_per_line",
    "gap_share", "distinct_lines", "top_line_share", "distinct_words", "flip_share", "joined_share", "backslash_ratio", "longest_word", "rare_letter_ratio", "vowel_ratio", "char_entropy", "short_line_share",
    "colon_share", "single_char_share", "common_bigram_share", "mixed_word_share", "lead_digit_share", "statement_share", "max_words_line", "wrapped_share",
    "prose_chars", "marked_chars", "cell_chars", "top_sentence_share", "sentences", "semicolon_items", "tag_ratio", "ends_in_digit", "leader_ratio", "lower_start_share", "capital_words", "known_per_line", "distinct_trigrams",
)

_MARK = re.compile(r"^\s*(?:[-–—*•▪●◦‣·>#+o]\s+|\[[ xX]?\]\s*|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.):]\s+|\d{1,3}\s*[-–]\s+)")
_END = re.compile(r"[.!?…。！？][\"'”’)\]]*\s*$")
_SENTENCE = re.compile(r"[.!?](?=\s|$|[\"'”’)])|[。！？]")
_GAP = re.compile(r"\S(?: {2,}|\t)(?=\S)")
_FLIP = re.compile(r"[a-zà-ÿ][A-ZÀ-Þ]")
_MIXED = re.compile(r"(?<!\S)(?=\S*[a-z])(?=\S*[A-Z])(?=\S*\d)[A-Za-z0-9+/=]{16,}(?!\S)")
_JOINED = re.compile(r"[^\W\d_][.,;:!?|~^*_][^\W\d_]")
_VOWELS = set("aeiouyáéíóúàèìòùâêîôûäëïöüåøæœãõAEIOUYÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜÅØÆŒÃÕ")
_TRIM = "\"'“”‘’«»()[]{}.,;:!?…"


def _is_wide(c: str) -> bool:
    return "぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "가" <= c <= "힯"


def _char(c: str) -> tuple[int, ...]:
    """Whether a character is blank, letter, digit, upper case, wide, debris of a conversion, vowel."""
    return c.isspace(), c.isalpha(), c.isdigit(), c.isupper(), _is_wide(c), c in "ÃÂÐÑÅâ€™ï¿½¢¬±»�ð" or "\x80" <= c < "\xa0", c in _VOWELS


def _word(w: str, common: frozenset[str]) -> tuple:
    """A word's bare form, whether it is common, its odd turns of case, joints, mixture, sentence ends, capital."""
    bare = w.strip(_TRIM).lower()
    return bare, bare in common, len(_FLIP.findall(w)) - w.count("kW"), len(_JOINED.findall(w)), len(_MIXED.findall(w)), len(_SENTENCE.findall(w)), w[0].isupper()


class Memo(dict):
    """What is known of words; it forgets all when it has grown too large."""

    def __init__(self, common: frozenset[str], most: int = 200_000):
        super().__init__()
        self.common, self.most, self.chars = common, most, {}

    def __missing__(self, w: str) -> tuple:
        got = _word(w, self.common)
        if len(w) < 64:
            if len(self) >= self.most:
                self.clear()
            self[w] = got
        return got


def features(text: str, common: frozenset[str], memo: Memo | None = None) -> list[float]:
    """The statistics of ``NAMES`` for one text that is not blank; the whole text counts.

    ``memo`` keeps what is known of words and characters between calls.
    """
    memo = Memo(common) if memo is None else memo
    lines = [x for x in re.split(r"[\r\n\x0b\x0c\u2028\u2029]+", text) if x.strip()]
    chars = Counter(text)
    size = len(text)
    blank = letters = digits = upper = wide = rare = vowels = 0
    entropy = 0.0
    for c, k in chars.items():
        got = memo.chars.get(c)
        if got is None:
            memo.chars[c] = got = _char(c)
        blank += got[0] * k
        letters += got[1] * k
        digits += got[2] * k
        upper += got[3] * k
        wide += got[4] * k
        rare += got[5] * k
        vowels += got[6] * k
        entropy -= k / size * math.log2(k / size)
    visible, latin = max(1, size - blank), max(1, letters - wide)
    words = text.split()
    told_of = list(map(memo.__getitem__, words))
    cols = list(zip(*told_of)) or [()] * 7
    bare, known = cols[0], cols[1]
    if "" in bare:
        bare, known = [g[0] for g in told_of if g[0]], [g[1] for g in told_of if g[0]]
    flips, joints, mixed, ends, capitals = map(sum, cols[2:])
    n, m = max(1, len(lines)), max(1, len(words))
    lengths = [len(x.strip()) for x in lines] or [0]
    mean = sum(lengths) / len(lengths)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in lengths) / len(lengths))
    marks = Counter()
    ended = statements = colon = lead = single = gaps = wrapped = prose = marked = celled = tail = lower = known_lines = seen = 0
    cells, counts = Counter(), []
    for i, line in enumerate(lines):
        s = line.strip()
        if k := _MARK.match(line):
            marks[re.sub(r"\w+", "1", k.group().strip())] += 1
        is_end = bool(_END.search(s))
        ended += is_end
        many = s.count(" ")
        statements += is_end and many >= 4
        colon += ":" in s[1:40] or " – " in s[:60] or " = " in s[:60]
        lead += s[:1].isdigit()
        tail += s[-1:].isdigit()
        lower += s[:1].islower()
        own = s.split()
        hits = sum(cols[1][seen : seen + len(own)])
        seen += len(own)
        known_lines += hits > 0
        if not k and ((len(own) >= 5 and hits >= 0.12 * len(own)) or (wide and sum(map(_is_wide, s)) > 0.3 * len(s) and (is_end or len(s) > 30))):
            prose += len(s)
        marked += len(s) if k else 0
        wrapped += not is_end and many >= 3 and i + 1 < len(lines) and lines[i + 1].lstrip()[:1].islower()
        best, kind = 0, ""
        for d in "\t|;,":
            if (c := line.count(d)) and (d != "," or ", " not in line) and (d != ";" or "; " not in line):
                if c > best:
                    best, kind = c, d
        if g := len(_GAP.findall(line.strip())):
            gaps += 1
            if g > best:
                best, kind = g, "  "
        counts.append(best)
        celled += len(s) if best >= 2 else 0
        if best:
            cells[kind, best] += 1
    repeats = Counter(x.strip() for x in lines)
    single = sum(map((1).__eq__, map(len, bare)))
    said = Counter(x.strip() for x in re.split(r"(?<=[.!?。！？])\s*", text) if len(x.strip()) > 3)
    told = max(1, sum(said.values()))
    body = max(1.0, sum(lengths))
    pairs = sum(map(and_, known, known[1:]))
    return [
        len(lines), len(words), sum(map(len, words)) / m, mean, deviation / max(1, mean), (visible - letters - digits) / visible, digits / visible, letters / visible, upper / max(1, letters), wide / max(1, letters),
        sum(marks.values()) / n, max(marks.values(), default=0) / n, ended / n, float(bool(lines and _END.search(lines[-1]))), ends / n, m / max(1, ends), sum(known) / max(1, len(bare)), sum(c > 0 for c in counts) / n, max(cells.values(), default=0) / n, sum(counts) / n,
        gaps / n, len(repeats) / n, max(repeats.values(), default=0) / n, len(set(bare)) / max(1, len(bare)), max(0, flips) / m, joints / m, chars["\\"] / visible, max(map(len, words), default=0), rare / visible, vowels / latin, entropy, sum(x < 45 for x in lengths) / len(lengths),
        colon / n, single / m, pairs / max(1, len(bare) - 1), mixed / m, lead / n, statements / n, max((x.count(" ") for x in lines), default=0), wrapped / n,
        prose / body, marked / body, celled / body, max(said.values(), default=0) / told if told >= 3 else 0.0, ends, text.count("; "), sum(chars[c] for c in "<>{}&") / visible, tail / n, text.count("...") * 3 / visible, lower / n, capitals / m, known_lines / n, len(set(zip(bare, bare[1:], bare[2:]))) / max(1, len(bare) - 2) if len(bare) > 12 and wide < 0.2 * letters else 1.0,
    ]
