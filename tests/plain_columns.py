"""Tables and column lines of one page at a time, word by word: what the jobs over words are held against."""

from collections import Counter

import numpy as np
import pandas as pd

#: The least words, rows and columns of a table; edges agree within X_TOL; so many rows hold numbers; so far up go headings.
MIN_WORDS, MIN_ROWS, MIN_COLS, X_TOL, NUMERIC_SHARE, LOOK_BACK = 10, 3, 2, 8.0, 0.5, 4
#: A gap between cells in characters, and the least one; rows agree within half a word's height, and the least tolerance.
GAP_CHARS, MIN_GAP, ROW_SHARE, MIN_ROW_TOL = 2.2, 5.0, 0.5, 1.5
#: Pages in columns: the least words, bin width, share of rows that may cross a gutter, its least share of the width, the least share of words beside it, where it may lie.
COLUMN_WORDS, BIN, CROSSING, GUTTER, SIDE, MIDDLE = 20, 2.0, 0.15, 0.04, 0.15, (0.2, 0.8)
#: Running text: words a row, and the share of rows that may be all numbers.
PROSE_WORDS, PROSE_NUMERIC = 4.0, 0.5


class Words:
    """Words of a page as arrays, in rows of one baseline, each from left to right."""

    def __init__(self, words: list[dict]):
        get = lambda name: np.array([float(w[name]) for w in words])
        x0, top = get("x0"), get("top")
        text = np.array([w["text"] for w in words], object)
        height, x1 = get("bottom") - top, get("x1")
        self.tolerance = max(MIN_ROW_TOL, float(np.median(height)) * ROW_SHARE)
        inked = np.array([bool(t.strip()) for t in text])
        width = (x1 - x0)[inked] / np.array([len(t) for t in text[inked]] or [1.0])[: inked.sum()]
        self.gap = max(MIN_GAP, (float(np.median(width)) if inked.any() else 3.0) * GAP_CHARS)
        order = np.lexsort((x0, np.round(top, 1)))
        row, base = np.zeros(len(order), np.int64), None
        for k, y in enumerate(top[order].tolist()):
            fresh = base is not None and abs(y - base) > self.tolerance
            row[k] = (row[k - 1] if k else 0) + fresh
            base = y if base is None or fresh else base
        order = order[np.lexsort((x0[order], row))]
        self.row = np.sort(row)
        self.text, self.x0, self.x1, self.top, self.bottom = text[order], x0[order], x1[order], top[order], get("bottom")[order]
        self.numeric = pd.Series(self.text, dtype=object).map(is_number).to_numpy(bool)
        self.bounds = np.concatenate([[0], np.flatnonzero(np.diff(self.row)) + 1, [len(order)]])

    def line(self, at: np.ndarray) -> dict:
        return {"text": " ".join(self.text[at]), "x0": float(self.x0[at].min()), "x1": float(self.x1[at].max()), "top": float(self.top[at].min()), "bottom": float(self.bottom[at].max())}

    def cells(self) -> list[list[dict]]:
        """For each row its cells: words nearer than the gap belong together."""
        out = []
        for a, b in zip(self.bounds, self.bounds[1:]):
            cuts = np.flatnonzero(self.x0[a + 1 : b] - self.x1[a : b - 1] > self.gap) + 1
            out.append([self.line(x) for x in np.split(np.arange(a, b), cuts)])
        return out


def is_number(text: str) -> bool:
    """A number with separators, perhaps in parentheses or a percentage, and nothing else."""
    t = text.strip().removesuffix("%").removesuffix(")").removeprefix("(").removeprefix("-")
    return t[:1].isdecimal() and all(c.isdecimal() or c in ",." or c.isspace() for c in t)


def aligned(a: list[dict], b: list[dict], tolerance: float = X_TOL) -> bool:
    """Whether all but one of the cells, and two at least, share a left or a right edge."""
    if not a or not b:
        return False
    edge = lambda name: np.abs(np.array([c[name] for c in b])[:, None] - np.array([c[name] for c in a])) <= tolerance
    return int((edge("x0") | edge("x1")).any(1).sum()) >= max(2, min(len(a), len(b)) - 1)


def runs(rows: list[list[dict]], min_rows: int = MIN_ROWS, min_cols: int = MIN_COLS, tolerance: float = X_TOL) -> list[tuple[int, int]]:
    """Ranges of successive rows on one grid: islands of rows that line up with the row before."""
    wide = np.array([len(r) >= min_cols for r in rows], bool)
    goes_on = np.array([i > 0 and wide[i] and wide[i - 1] and aligned(rows[i - 1], rows[i], tolerance) for i in range(len(rows))], bool)
    first = np.flatnonzero(wide & ~goes_on)
    last = np.flatnonzero(wide & ~np.append(goes_on[1:], False)) + 1 if len(rows) else first
    return [(int(a), int(b)) for a, b in zip(first, last, strict=True) if b - a >= min_rows]


def headings(rows: list[list[dict]], start: int, taken: set[int], min_cols: int = MIN_COLS, tolerance: float = X_TOL) -> list[int]:
    """Rows above a run that line up with it; narrow ones are stepped over, a taken or misaligned one ends the search."""
    found = []
    for i in range(start - 1, max(-1, start - 1 - LOOK_BACK), -1):
        narrow = len(rows[i]) < min_cols
        if i in taken or not (narrow or aligned(rows[start], rows[i], tolerance)):
            break
        if not narrow:
            found.append(i)
    return found[::-1]


def column_tables(words: list[dict]) -> list[dict]:
    """Tables whose columns are made by white space alone; half of the rows or more hold numbers beyond the first cell."""
    if len(words) < MIN_WORDS:
        return []
    rows = Words(words).cells()
    out, taken = [], set()
    for a, b in runs(rows):
        body = rows[a:b]
        if sum(any(is_number(c["text"]) for c in r[1:]) for r in body) < NUMERIC_SHARE * len(body):
            continue
        head = headings(rows, a, taken)
        taken.update(head, range(a, b))
        table = [rows[i] for i in head] + body
        cells = [c for r in table for c in r]
        usual = Counter(len(r) for r in body).most_common(1)[0][1]
        box = [min(c["x0"] for c in cells), min(c["top"] for c in cells), max(c["x1"] for c in cells), max(c["bottom"] for c in cells)]
        out.append({"bbox": box, "col_x": [c["x0"] for c in table[0]], "rows": [[c["text"] for c in r] for r in table], "source_engine": "column-geometry", "structure_confidence": usual / len(body)})
    return out


def gutter(words: Words) -> float | None:
    """The middle of the widest band near the page's middle that few rows cross, if it parts the words."""
    left, right = float(words.x0.min()), float(words.x1.max())
    span, n_rows = right - left, len(words.bounds) - 1
    if span <= 0:
        return None
    bins = max(1, int(span / BIN))
    place = lambda x: np.clip(((x - left) / span * bins).astype(np.int64), 0, bins - 1)
    ink = np.zeros((n_rows, bins + 1), np.int64)
    np.add.at(ink, (words.row, place(words.x0)), 1)
    np.add.at(ink, (words.row, place(words.x1) + 1), -1)
    blocked = (np.cumsum(ink, 1)[:, :bins] > 0).sum(0) > max(1.0, n_rows * CROSSING)
    at = np.arange(bins)
    free = at - np.maximum.accumulate(np.where(blocked, at, -1))
    lo, hi = (int(bins * s) for s in MIDDLE)
    end = lo + int(free[lo : hi + 1].argmax())
    length = int(free[end])
    if not length or length * BIN < span * GUTTER:
        return None
    middle = left + (end - length / 2 + 0.5) / bins * span
    beside = min((words.x1 <= middle).sum(), (words.x0 > middle).sum())
    return middle if beside >= len(words.text) * SIDE else None


def both_prose(words: Words, middle: float) -> bool:
    """Whether both sides of a gutter carry running text, unlike a table's labels and figures."""
    for side in (words.x1 <= middle, words.x0 > middle):
        rows, n = np.unique(words.row[side], return_counts=True)
        if not len(rows) or n.mean() < PROSE_WORDS:
            return False
        numbers = np.bincount(words.row[side & words.numeric], minlength=int(words.row[-1]) + 1)[rows]
        if (numbers == n).mean() > PROSE_NUMERIC:
            return False
    return True


def column_lines(words: list[dict]) -> list[dict] | None:
    """Lines of a page in two columns, the left before the right between rows that cross the gutter; null if it is not in columns."""
    if len(words) < COLUMN_WORDS:
        return None
    page = Words(words)
    middle = gutter(page)
    if middle is None or not both_prose(page, middle):
        return None
    ids = np.arange(len(page.text))
    crossed = np.isin(page.row, page.row[(page.x0 < middle) & (page.x1 > middle)])
    crossing_rows = np.unique(page.row[crossed])
    block = 2 * np.searchsorted(crossing_rows, page.row) + crossed  # even between crossing rows, odd on them
    side = np.where(crossed, 0, np.where(page.x1 <= middle, 0, np.where(page.x0 > middle, 1, 2)))
    key = np.stack([block, side, page.row])[:, side < 2]
    _, first = np.unique(key, axis=1, return_index=True)
    order = ids[side < 2][np.lexsort(key[::-1])]
    sorted_key = key[:, np.lexsort(key[::-1])]
    cuts = np.flatnonzero((np.diff(sorted_key, axis=1) != 0).any(0)) + 1
    return [page.line(np.sort(x)) for x in np.split(order, cuts)] if len(first) else []
