"""Wrappers of hosts: union-free regular expressions inferred by aligning token streams.

A stream is the markup tokens of a text and the lines of text between them. A wrapper is a sequence of fixed nodes, each
a markup token, a text that all texts of the host share, a text slot (`#`), or a repeated group, which is a wrapper of
its own, and between them gaps: the tokens that only some texts have there, in any order, each optional or repeated.

Two wrappers are aligned as the method names it. What both have in order stays; texts that differ become a slot. Where
one side has markup that the other has not, squares are looked for there: neighbouring stretches that begin and end with
the same tokens, or else are equal but for their texts, however wide. Squares become one repeated group, in which what
only some of them have is optional, and the two sides are aligned again. Only what is left then goes to the gaps. So an
alignment is never longer than the shorter of the two and the number of different tokens.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np

SLOT = "#"
#: Literals of more characters are kept as their beginning and a hash.
LITERAL_CHARS = 64
#: Fixed nodes of both sides, multiplied, up to which a table of all pairs is held; beyond, one side is halved first.
MOST_CELLS = 1 << 20

Gap = dict[str, bool]  # symbol: more than once
Wrapper = tuple[list[tuple], list[Gap]]  # fixed nodes (symbol or the wrapper of a group, repeated), and the gaps around them


def literal(line: str) -> str:
    """The symbol of a line of text: the line in quotes, with single spaces."""
    plain = " ".join(line.split())
    if len(plain) > LITERAL_CHARS:
        plain = f"{plain[: LITERAL_CHARS // 2]}…{hashlib.blake2b(plain.encode('utf-8', 'surrogatepass'), digest_size=12).hexdigest()}"
    return json.dumps(plain, ensure_ascii=False)


def is_text(symbol: str | Wrapper) -> bool:
    return isinstance(symbol, str) and (symbol == SLOT or symbol[0] == '"')


def _repeats(keys: list) -> Iterator[tuple[int, int, int]]:
    """(start, width, times) of the stretches of keys that follow themselves, the narrowest first, from markup on if there is a choice."""
    size, counts = len(keys), Counter(keys)
    if len(counts) == size:
        return
    numbers = {k: i for i, k in enumerate(counts)}
    codes = np.array([numbers[k] for k in keys])
    widths: Iterable[int] = range(1, size // 2 + 1)
    if sum(c * c for c in counts.values() if c > 1) < size:
        places: dict = {}
        for i, k in enumerate(keys):
            places.setdefault(k, []).append(i)
        widths = sorted({j - i for at in places.values() for i in at for j in at if 0 < j - i <= size // 2})
    for width in widths:
        equal = codes[:-width] == codes[width:]
        if np.count_nonzero(equal) < width:
            continue
        ends = np.concatenate([[-1], np.flatnonzero(~equal), [len(equal)]])
        taken = 0
        for before, after in zip(ends[:-1].tolist(), ends[1:].tolist()):
            start = max(before + 1, taken)
            if after - start >= width:
                times, over = divmod(after - start, width)
                start = next((i for i in range(start, start + over + 1) if not is_text(keys[i])), start)
                yield start, width, times + 1
                taken = start + width * (times + 1)


def _part(w: Wrapper, low: int, high: int) -> Wrapper:
    """Nodes low to high - 1 of a wrapper, with the gaps between them."""
    return w[0][low:high], [{}, *w[1][low + 1 : high], {}]


def _with_group(w: Wrapper, low: int, high: int, group: Wrapper, repeated: bool) -> Wrapper:
    """w with a group, or the one node of a group, for nodes low to high - 1."""
    nodes, gaps = group
    alone = len(nodes) == 1 and not any(gaps)
    node = (nodes[0][0], repeated or nodes[0][1]) if alone else (group, repeated)
    return [*w[0][:low], node, *w[0][high:]], [*w[1][: low + 1], *w[1][high:]]


def _marked(w: Wrapper) -> bool:
    """Whether markup is fixed in a wrapper, as it must be in a group."""
    return any(not is_text(s) for s, _ in w[0])


def _square(w: Wrapper, low: int, high: int) -> Wrapper:
    """Nodes low to high - 1 as one square; a group alone is the square that it repeats."""
    return w[0][low][0] if high - low == 1 and not isinstance(w[0][low][0], str) else _part(w, low, high)


def _of_squares(w: Wrapper, cuts: list[int]) -> Wrapper:
    """The wrapper of neighbouring squares, which begin at cuts and end at the last; what stands between two may precede each."""
    out = _square(w, cuts[0], cuts[1])
    for low, high in zip(cuts[1:], cuts[2:]):
        made = align(out, _square(w, low, high))
        out = made[0], [_either(made[1][0], w[1][low]), *made[1][1:]]
    return out


def of_stream(symbols: Iterable[str]) -> Wrapper:
    """The wrapper of one stream: equal neighbours, and equal neighbouring stretches, are one repeated node."""
    nodes: list[tuple] = [(s, False) for s in symbols]
    w: Wrapper = nodes, [{} for _ in range(len(nodes) + 1)]
    while found := _narrowest(_repeats([_key(s) for s, _ in w[0]])):
        for start, width, times in reversed(found):
            w = _with_group(w, start, start + width * times, _of_squares(w, [start + width * i for i in range(times + 1)]), True)
    return w


def _narrowest(repeats: Iterator[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    return list(next((of for _, of in groupby(repeats, lambda r: r[1])), []))


def symbols(w: Wrapper) -> set[str]:
    """All symbols of a wrapper, of its groups and gaps too."""
    out = {s for gap in w[1] for s in gap}
    for s, _ in w[0]:
        out |= {s} if isinstance(s, str) else symbols(s)
    return out


def _key(symbol: str | Wrapper) -> str:
    """Equal symbols have equal keys, and so have groups that are equal."""
    return symbol if isinstance(symbol, str) else dumped(symbol)


def _shape(symbol: str | Wrapper) -> str:
    """As the key, with slots for texts; a group that begins and ends with markup is known by these."""
    if isinstance(symbol, str):
        return SLOT if is_text(symbol) else symbol
    shapes = [_shape(s) for s, _ in symbol[0]]
    ends = [shapes[0], shapes[-1]] if shapes and SLOT not in (shapes[0], shapes[-1]) else shapes
    return f"({' '.join(ends)})"


def _into(gap: Gap, symbol: str | Wrapper, repeated: bool) -> None:
    if not isinstance(symbol, str):
        for s in symbols(symbol):
            _into(gap, s, True)
        return
    symbol = SLOT if is_text(symbol) else symbol
    gap[symbol] = repeated or symbol in gap


def _either(one: Gap, two: Gap) -> Gap:
    return {s: one.get(s, False) or two.get(s, False) for s in dict.fromkeys([*one, *two])}


def _between(w: Wrapper, low: int, high: int) -> Gap:
    """All of a wrapper from the gap before node low to the gap before node high, as one gap."""
    out: Gap = {}
    for i in range(low, high + 1):
        for symbol, repeated in w[1][i].items():
            _into(out, symbol, repeated)
        if i < high:
            _into(out, *w[0][i])
    return out


def _with_groups(w: Wrapper, other: Wrapper, whole: bool) -> Wrapper:
    """w with single occurrences of the groups of the other side as these groups; all of w only if whole."""
    for shape, group in {_shape(s): s for s, _ in other[0] if not isinstance(s, str)}.items():
        names = [_shape(s) for s, _ in group[0]]
        ended = SLOT not in (names[0], names[-1]) and names[0] != names[-1]
        shapes = [_shape(s) for s, _ in w[0]]
        at = _find(shapes, names[0], 0)
        while at >= 0:
            end = at + len(names)
            if shapes[at:end] != names:
                end = _find(shapes, names[-1], at) + 1 if ended else 0
                if names[0] in shapes[at + 1 : end]:
                    end = 0
            if end and len(names) > 1 and (whole or end - at < len(shapes)):
                w = _with_group(w, at, end, _part(w, at, end), False)
                shapes[at:end] = [shape]
            at = _find(shapes, names[0], at + 1)
    return w


def _find(shapes: list[str], shape: str, at: int) -> int:
    try:
        return shapes.index(shape, at)
    except ValueError:
        return -1


def _with_squares(w: Wrapper, kept: set[int]) -> Wrapper | None:
    """w with squares as groups, of which some have markup that is kept in the alignment and some have markup that is not."""
    if all(i in kept or is_text(s) for i, (s, _) in enumerate(w[0])):
        return None
    shapes = [_shape(s) for s, _ in w[0]]
    places: dict[str, list[int]] = {}
    for i, shape in enumerate(shapes):
        places.setdefault(shape, []).append(i)
    taken = np.zeros(len(shapes), bool)
    found: list[tuple[int, int, Wrapper]] = []

    def take(cuts: list[int], beside: bool = False) -> None:
        low, high = cuts[0], cuts[-1]
        if len(cuts) > 2 and not taken[low:high].any():
            sides = {i in kept for i in range(low, high) if shapes[i] != SLOT}
            if (len(sides) == 2 or beside and False in sides) and _marked(made := _of_squares(w, cuts)):
                found.append((low, high, made))
                taken[low:high] = True

    def stop(low: int, first: str, end: str) -> int:
        """Where the square from low on stops, which begins with first and ends with end; 0 without one."""
        at = places.get(end, [])
        k = bisect(at, low)
        if low >= len(shapes) or shapes[low] != first or k == len(at):
            return 0
        return at[k] + 1 if bisect(places[first], at[k]) == bisect(places[first], low) else 0

    def before(high: int, first: str, end: str) -> int:
        """Where the square that stops at high begins; -1 without one."""
        k = bisect(places.get(first, []), high - 1) - 1
        return places[first][k] if k >= 0 and stop(places[first][k], first, end) == high else -1

    i = 1
    while i < len(shapes):
        first, end = shapes[i], shapes[i - 1]
        cuts = [i]
        if SLOT not in (first, end) and first != end and first[0] != "(" != end[0] and (low := before(i, first, end)) >= 0:
            cuts = [low, i]
            while high := stop(cuts[-1], first, end):
                cuts.append(high)
            take(cuts)
        i = max(i + 1, cuts[-1])
    for i, (s, _) in enumerate(w[0]):  # squares beside a group of their like
        if not isinstance(s, str) and shapes[i].count(" ") == 1:
            first, end = shapes[i][1:-1].split(" ")
            if SLOT not in (first, end) and first != end:
                cuts = [i, i + 1]
                while (low := before(cuts[0], first, end)) >= 0:
                    cuts.insert(0, low)
                while high := stop(cuts[-1], first, end):
                    cuts.append(high)
                take(cuts, beside=True)
    for _, repeats in groupby(_repeats(shapes), lambda r: r[1]):
        if found:
            break
        for start, width, times in repeats:
            take([start + width * i for i in range(times + 1)])
    for low, high, made in sorted(found, key=lambda x: -x[0]):
        w = _with_group(w, low, high, made, True)
    return w if found else None


def _scores(a: list[str], b: list[str]) -> np.ndarray:
    """The best score of all of a with each beginning of b."""
    number: dict[str, int] = {}
    codes = np.array([number.setdefault(x, len(number)) for x in b])
    texts = np.array([is_text(x) for x in b], dtype=np.int64)
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        gain = np.where(codes == number.get(x, -1), 3, texts if is_text(x) else 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + gain))
    return row


def _matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places that are kept: equal symbols before texts that differ, in order."""
    n, m = len(a), len(b)
    low = 0
    while low < min(n, m) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(n, m) - low and a[n - 1 - high] == b[m - 1 - high]:
        high += 1
    head, tail = [(i, i) for i in range(low)], [(n - high + i, m - high + i) for i in range(high)]
    a, b = a[low : n - high], b[low : m - high]
    n, m = len(a), len(b)
    if not n or not m:
        return head + tail
    if n * m > MOST_CELLS:
        if n == 1 or n < m and m > 1:
            return head + [(low + i, low + j) for j, i in _matches(b, a)] + tail
        half = n // 2
        cut = int(np.argmax(_scores(a[:half], b) + _scores(a[half:][::-1], b[::-1])[::-1]))
        first, second = _matches(a[:half], b[:cut]), _matches(a[half:], b[cut:])
        return head + [(low + i, low + j) for i, j in first] + [(low + half + i, low + cut + j) for i, j in second] + tail
    text_a, text_b = [is_text(x) for x in a], [is_text(x) for x in b]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below, x, t = best[i], best[i + 1], a[i], text_a[i]
        for j in range(m - 1, -1, -1):
            gain = 3 if x == b[j] else 1 if t and text_b[j] else 0
            most = below[j] if below[j] >= row[j + 1] else row[j + 1]
            row[j] = gain + below[j + 1] if gain and gain + below[j + 1] >= most else most
    middle = []
    i = j = 0
    while i < n and j < m:
        gain = 3 if a[i] == b[j] else 1 if text_a[i] and text_b[j] else 0
        if gain and best[i][j] == gain + best[i + 1][j + 1]:
            middle.append((low + i, low + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return head + middle + tail


def _names(w: Wrapper) -> list[str]:
    """What nodes are matched by: their symbol, or the shape of a group."""
    return [s if isinstance(s, str) else _shape(s) for s, _ in w[0]]


def align(a: Wrapper, b: Wrapper) -> Wrapper:
    """The wrapper of all that a and b are wrappers of."""
    if a == b:
        return a
    whole = True  # if both sides became one group as a whole, to align these would begin again
    while True:
        grouped = _with_groups(a, b, whole)
        whole = whole and (len(grouped[0]) > 1 or len(a[0]) == 1)
        a, other = grouped, a
        grouped = _with_groups(b, other, whole)
        whole = whole and (len(grouped[0]) > 1 or len(b[0]) == 1)
        b = grouped
        pairs = _matches(_names(a), _names(b))
        folded = _with_squares(a, {i for i, _ in pairs}), _with_squares(b, {j for _, j in pairs})
        if folded == (None, None):
            break
        a, b = folded[0] or a, folded[1] or b
    # groups that share no markup stay apart
    groups = {(i, j): align(a[0][i][0], b[0][j][0]) for i, j in pairs if not isinstance(a[0][i][0], str)}
    pairs = [p for p in pairs if p not in groups or _marked(groups[p])]
    nodes: list[tuple] = []
    gaps: list[Gap] = []
    i = j = 0
    for x, y in [*pairs, (len(a[0]), len(b[0]))]:
        gaps.append(_either(_between(a, i, x), _between(b, j, y)))
        if x < len(a[0]):
            (s, r), (t, q) = a[0][x], b[0][y]
            nodes.append((groups.get((x, y), s if s == t else SLOT), r or q))
        i, j = x + 1, y + 1
    # neighbouring slots with nothing between them are one
    kept, between = nodes[:1], gaps[:1]
    for node, gap in zip(nodes[1:], gaps[1:-1]):
        if node[0] == kept[-1][0] == SLOT and not set(gap) - {SLOT}:
            kept[-1] = (SLOT, True)
        else:
            kept.append(node)
            between.append(gap)
    return kept, [*between, *gaps[len(nodes) : len(nodes) + 1]] if nodes else gaps


def written(w: Wrapper) -> str:
    """A wrapper as text: `x+` repeated, `x?` optional, `x*` both, and a gap of several with a repeat as `(x? y?)*`; the tokens of a gap are sorted."""
    nodes, gaps = w

    def gap_text(gap: Gap) -> str:
        if len(gap) > 1 and any(gap.values()):
            return f"({' '.join(f'{s}?' for s in sorted(gap))})*"
        return " ".join(s + ("*" if r else "?") for s, r in sorted(gap.items()))

    parts = [gap_text(gaps[0])]
    for (symbol, repeated), gap in zip(nodes, gaps[1:]):
        parts += [(symbol if isinstance(symbol, str) else f"({written(symbol)})") + "+" * repeated, gap_text(gap)]
    return " ".join(p for p in parts if p)


def dumped(w: Wrapper) -> str:
    return json.dumps(w, ensure_ascii=False)


def loaded(text: str) -> Wrapper:
    def made(nodes: list, gaps: list) -> Wrapper:
        return [(s if isinstance(s, str) else made(*s), r) for s, r in nodes], gaps

    return made(*json.loads(text))


def template(w: Wrapper) -> list[str]:
    """The literals that all texts of a host share, in order."""
    return [s for s, _ in w[0] if isinstance(s, str) and s[0] == '"']
