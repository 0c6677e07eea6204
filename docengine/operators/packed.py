"""Fields that hold several values: one row per value, with its position.

The scan works on the Arrow buffers of a whole batch at once: a running count of quotes gives each byte its parity,
delimiters count only at even parity, their places are the child offsets of a list array, and the flattened list carries
the ordinal of the parent row. Only rows whose quotes are ambiguous go through the exact scanner.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

PIECE, LONG = 1 << 20, 4 << 20  # bytes of text scanned at once; characters above which a text is scanned alone, without arrays per byte
_QUOTE, _ESCAPE, _OPEN, _CLOSE, _SLASH, _COMMA = (ord(c) for c in '"\\[]/,')
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STRONG = np.zeros(256, bool)
_STRONG[[ord(c) for c in "|;\t\n\r"]] = True
_ANY = _STRONG.copy()
_ANY[[_SLASH, _COMMA]] = True
_ODD = np.zeros(256, bool)  # beyond ASCII, and separators that only Unicode takes for blanks
_ODD[128:] = _ODD[28:32] = True
_NEAR_BLANKS = np.zeros(256, bool)
_NEAR_BLANKS[[_QUOTE, _SLASH, 9, 10, 13]] = True
_QUOTED = re.compile(r'"[^"]*+(?:""[^"]*+)*+"')
_LISTED = re.compile(r'"(?:[^"\\]|\\.)*+"?|(?:[^",\\]|\\\\|\\"|\\)++|,', re.S)
_LIST = re.compile(r'\[\s*".*"\s*\]', re.S)
_PLACES = {False: re.compile(r'["|;,/\t\n\r]'), True: re.compile(r'["|;,/]|\s')}


def _exact(text: str, atomic: bool) -> list[str]:
    """The items of one text, delimiter by delimiter: what the scan of whole batches gives for rows without doubt.

    A quote opens only at the start of an item and closes only at its end; else it is a mark like any other. A list in
    brackets whose first and last item are quoted is cut at commas outside quotes, which a backslash escapes.
    """
    text = text.strip()
    if _LIST.fullmatch(text) and len(_unescaped_quotes(text)) % 2 == 0:
        items, now = [], []
        for m in _LISTED.finditer(text[1:-1]):
            if m.group() == ",":
                items.append("".join(now))
                now = []
            else:
                now.append(m.group())
        items = [x.strip() for x in [*items, "".join(now)]]
        return [y for x in items if (y := _unescaped(x) if len(x) > 1 and x[0] == x[-1] == '"' else x).strip()]
    cuts: dict[str, list[int]] = {"strong": [], "slash": [], "comma": [], "blank": []}
    fresh, at, n = 0, 0, len(text)
    while m := _PLACES[atomic].search(text, at):
        i, c = m.start(), m.group()
        at = i + 1
        if c == '"':
            if text[fresh:i].strip() == "" and (q := _QUOTED.match(text, i)):
                end = q.end()
                rest = end + (len(text[end:]) - len(text[end:].lstrip(" "))) if text[end : end + 1] == " " else end
                if rest == n or text[rest] in "|;,/\t\n\r" or (atomic and text[end].isspace()):
                    at = end
            continue
        fresh = at
        kind = "strong" if c in "|;\t\n\r" else "comma" if c == "," else "blank" if c != "/" else ""
        if c == "/" and (atomic or (0 < i < n - 1 and text[i - 1].isspace() and text[i + 1].isspace())):
            kind = "slash"
        if kind:
            cuts[kind].append(i)
    used = sorted(x for k in cuts for x in cuts[k]) if atomic else cuts["strong"] or cuts["slash"] or cuts["comma"]
    items = [_unquoted(text[a:b].strip()) for a, b in zip([0, *(i + 1 for i in used)], [*used, n])]
    return [x for x in items if x.strip()]


def _unescaped_quotes(text: str) -> list[str]:
    return re.findall(r'(?<!\\)(?:\\\\)*+"', text)


def _unquoted(item: str) -> str:
    """An item without the quotes around it; doubled quotes inside stand for one."""
    if len(item) >= 2 and item[0] == '"' and item[-1] == '"':
        inner = item[1:-1]
        if '"' not in inner.replace('""', ""):
            return inner.replace('""', '"').strip()
    return item


def _unescaped(item: str) -> str:
    try:
        value = json.loads(item, strict=False)
        return value.strip() if isinstance(value, str) else item
    except ValueError:
        return _unquoted(item)


def split_packed(values: pa.Array, atomic: bool = False) -> pa.ListArray:
    """The list of values packed in each string; null and blank strings have an empty list.

    ``atomic``: no value holds a delimiter or white space (ids, years), so each of them separates. Otherwise a row is cut
    at ``|``, ``;``, tabs and line ends together; if it has none, at ``/`` between blanks; if none, at commas. A JSON list of
    strings is read as such. Empty items are dropped, outer quotes removed, inner ones kept as meant.
    """
    n = len(values)
    values = pc.fill_null(values.cast(pa.large_string()), "")
    if n == 0:
        return pa.array([], pa.list_(pa.string()))
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    off = np.frombuffer(values.buffers()[1], np.int64, n + 1, values.offset * 8)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[off[0] : off[n]]
    off = off - off[0]
    size = len(data)
    if size == 0:
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.string()))
    row = np.repeat(np.arange(n), np.diff(off))
    index = np.arange(size)
    space = _SPACE[data]
    # first byte at or after, and last byte at or before, that is no blank
    ahead = np.append(np.minimum.accumulate(np.where(space, size, index)[::-1])[::-1], size)
    back = np.append(np.maximum.accumulate(np.where(space, -1, index)), -1)
    start = np.minimum(ahead[off[:-1]], off[1:])
    end = np.maximum(np.where(off[1:] > off[:-1], back[off[1:] - 1] + 1, off[:-1]), start)
    at = lambda place, inside: np.where(inside, data[np.clip(place, 0, size - 1)], 0)
    filled = end > start
    second = ahead[np.minimum(start + 1, size)]
    penult = back[np.maximum(end - 2, 0)]
    is_list = filled & (at(start, filled) == _OPEN) & (at(end - 1, filled) == _CLOSE) & (at(second, second < end) == _QUOTE) & (at(penult, penult > second) == _QUOTE)
    # quotes, without those a JSON list escapes
    slashless = np.maximum.accumulate(np.where(data == _ESCAPE, -1, index))
    run = np.where(index > 0, index - 1 - np.append(-1, slashless[:-1]), 0)
    quote = (data == _QUOTE) & ~(is_list[row] & (run % 2 == 1))
    count = np.cumsum(quote)
    before = np.where(off[:-1] > 0, count[np.maximum(off[:-1] - 1, 0)], 0)
    outside = (count - before[row]) % 2 == 0
    odd = ~np.where(off[1:] > off[:-1], outside[np.maximum(off[1:] - 1, 0)], True)
    # a quote that opens inside an item must not hide a delimiter
    opens = quote & ~outside
    left = back[np.maximum(index - 1, 0)]
    first = index == start[row]
    proper = opens & (first | ((left >= off[row]) & _ANY[data[np.maximum(left, 0)]] & (index > off[row])))
    if atomic:
        proper |= opens & (index > 0) & space[np.maximum(index - 1, 0)]
    opener = np.maximum.accumulate(np.where(opens, index, -1))
    marks = _ANY[data] | (space if atomic else False)
    hides = ~outside & ~quote & marks & (opener >= 0) & ~is_list[row]
    ambiguous = np.zeros(n, bool)
    ambiguous[row[hides & ~proper[np.maximum(opener, 0)]]] = True
    # nor one that does not close at an item's end
    closes = quote & outside
    after = ahead[np.minimum(index + 1, size)]
    shut = (after >= off[1:][row]) | _ANY[data[np.minimum(after, size - 1)]]
    if atomic:
        shut |= space[np.minimum(index + 1, size - 1)]
    hiders = np.zeros(size + 1, bool)
    hiders[opener[hides]] = True
    ambiguous[row[closes & ~shut & hiders[opener]]] = True
    # what only Unicode takes for a blank counts where blanks decide
    strange = np.bincount(row[_ODD[data]], minlength=n) > 0
    ambiguous |= odd | strange & (np.full(n, atomic) | (np.bincount(row[_NEAR_BLANKS[data]], minlength=n) > 0))
    is_list &= ~odd
    # delimiters
    has = lambda mask: np.bincount(row[mask], minlength=n) > 0
    body = (index >= start[row]) & (index < end[row])
    strong, comma = outside & _STRONG[data] & body, outside & (data == _COMMA) & body
    slash = outside & (data == _SLASH) & body
    in_list = is_list[row]
    if atomic:
        cut = np.where(in_list, comma, strong | comma | slash | (outside & space & body))
    else:
        slash &= np.append(False, space[:-1]) & np.append(space[1:], False) & (index > start[row]) & (index < end[row] - 1)
        level = np.where(has(strong), 0, np.where(has(slash), 1, 2))
        cut = np.where(in_list, comma, np.choose(level[row], [strong, slash, comma]))
    cut &= ~ambiguous[row]
    start, end = start + is_list, end - is_list
    places = np.flatnonzero(cut)
    counts = np.bincount(row[places], minlength=n) + 1
    stops = np.cumsum(counts)
    total = int(stops[-1])
    last = np.zeros(total, bool)
    last[stops - 1] = True
    head = np.append(True, last[:-1])
    parent = np.repeat(np.arange(n), counts)
    lo, hi = np.empty(total, np.int64), np.empty(total, np.int64)
    lo[head], hi[last] = start, end
    lo[~head], hi[~last] = places + 1, places
    a = np.minimum(ahead[np.minimum(lo, size)], hi)
    b = np.maximum(np.where(hi > 0, back[np.maximum(hi - 1, 0)] + 1, a), a)
    keep = (b > a) & ~ambiguous[parent]
    a, b, parent = a[keep], b[keep], parent[keep]
    wrapped = (b - a >= 2) & (data[a] == _QUOTE) & (data[b - 1] == _QUOTE) if len(a) else np.zeros(0, bool)
    inner = np.cumsum(np.append(0, data == _QUOTE))
    plain = wrapped & (inner[b] - inner[a] == 2)
    escaped = np.cumsum(np.append(0, data == _ESCAPE))
    special = (wrapped & ~plain) | (is_list[parent] & wrapped & (escaped[b] > escaped[a]))
    plain &= ~special
    a, b = a + plain, b - plain
    # gather the bytes of all items into one buffer
    length = np.maximum(b - a, 0)
    ends = np.cumsum(length)
    if total := int(ends[-1]) if len(ends) else 0:
        source = np.arange(total) - np.repeat(ends - length, length) + np.repeat(a, length)
        flat = data[source].tobytes()
    else:
        flat = b""
    items = pa.StringArray.from_buffers(len(a), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(flat))
    items = pc.utf8_trim_whitespace(items)
    if special.any() or ambiguous.any():
        parts = items.to_pylist()
        for i in np.flatnonzero(special):
            parts[i] = _unescaped(parts[i]) if is_list[parent[i]] else _unquoted(parts[i])
        for r in np.flatnonzero(ambiguous):
            more = _exact(values[int(r)].as_py(), atomic)
            parts += more
            parent = np.append(parent, np.full(len(more), r))
        order = np.argsort(parent, kind="stable")
        items, parent = pc.utf8_trim_whitespace(pa.array(parts, pa.string()).take(pa.array(order))), parent[order]
    full = pc.greater(pc.binary_length(items), 0)
    mask = np.asarray(full.to_numpy(zero_copy_only=False), bool)
    items, parent = items.filter(full), parent[mask]
    child = np.append(0, np.cumsum(np.bincount(parent, minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(child), items)


def _pieces(values: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``PIECE`` bytes each, so that the scan's arrays stay small whatever the texts' length."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0), np.int64)
    cut = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE, prepend=0)) if len(sizes) else []
    lo = 0
    for hi in [*(int(c) for c in cut if c > 0), len(sizes)]:
        if hi > lo:
            yield lo, hi
            lo = hi


def _split_piece(values: pa.Array, atomic: bool) -> pa.ListArray:
    if len(values) > 1 or (values[0].as_py() or "") == "" or len(values[0].as_py()) <= LONG:
        return split_packed(values, atomic)
    items = pc.utf8_trim_whitespace(pa.array(_exact(values[0].as_py(), atomic), pa.string()))  # one very long text
    return pa.array([[x for x in items.to_pylist() if x]], pa.list_(pa.string()))


def unpack(df: DataFrame, value: str = "value", atomic: bool = False) -> DataFrame:
    """Each value packed in column ``value`` as a row, in place of it: ``pos`` from 1, ``value``, ``n_values`` of its field.

    All other columns are carried along, but for columns named ``pos`` and ``n_values``, which the results replace. Rows without
    a value give none, repeated rows and values each their own. No shuffle.
    """
    rest = [c for c in df.columns if c not in (value, "pos", "n_values")]
    schema = df.select(*rest, F.lit(0).cast("int").alias("pos"), value, F.lit(0).cast("int").alias("n_values")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, lo, hi in ((b, *r) for b in batches for r in _pieces(b.column(b.schema.get_field_index(value)))):
            batch = whole.slice(lo, hi - lo)
            lists = _split_piece(batch.column(batch.schema.get_field_index(value)), atomic)
            parents = lists.value_parent_indices() if hasattr(lists, "value_parent_indices") else pc.list_parent_indices(lists)
            offsets = lists.offsets.to_numpy()
            p = np.asarray(parents)
            pos = (np.arange(len(p)) - offsets[p] + 1).astype(np.int32)
            cols = [batch.column(batch.schema.get_field_index(c)).take(parents) for c in rest]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pos), lists.flatten(), pa.array(np.diff(offsets)[p].astype(np.int32))], names=[*rest, "pos", value, "n_values"])

    return df.mapInArrow(run, schema)
