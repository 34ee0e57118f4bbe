"""SentencePiece encoding by sampled segmentations without replacement, and decoding.

The text's lattice has an edge for every vocabulary piece and, for characters
without a piece, one for their bytes. A piece's weight falls with its rank in
the vocabulary, -ALPHA * log(rank + SHIFT), since the model file ranks pieces by
how early they were merged. The k segmentations are the Gumbel top-k of the
distribution over the lattice's paths: an A-star search over the tree of path
prefixes, whose nodes carry the maximum of the perturbed log-probabilities below
them. The best child keeps its parent's maximum; the maximum over all other
children is one truncated Gumbel of their common mass, so the frontier holds one
entry per unit of text and found path, and paths come out in order of their
perturbed scores. The entry left on top gives the threshold kappa, from which a
segmentation's inclusion log-probability is log(1 - exp(-exp(log_p - kappa))).
All randomness is a counter-based hash of seed, row key, path, unit and step, so
a row's result does not depend on its place.

No piece goes on with a space after another character, so a unit is a run of
spaces with the word after it; runs of spaces are pieces too. The suffixes of
units are the states of an automaton that each worker keeps, up to MAX_STATES;
sampling walks it for all units of a slice of texts at once. Words longer than
UNIT_CHARS are cut where no piece spans the cut, so no edge is lost; what is still
longer gets states of its own.

Null texts count as empty; an empty text has one segmentation of no pieces. Fewer
than k segmentations exist for some short texts: then all are returned. Repeated
rows of one doc_id and text are equal, whatever rows are encoded with them; scores
tie only by equal hashes. An empty table gives no rows. Columns besides doc_id and
text are not read, so their names cannot clash.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Spans, Table, mixed, slices, small_batches, texts, tidy

K, SEED, ALPHA, SHIFT = 2, 17, 2.0, 10.0
UNIT_CHARS, MAX_STATES, BATCH_BYTES = 24, 400_000, 200_000
_BASE = 0x9E6C63D0876A9A47
SPACE = "▁"
_MARK = SPACE.encode()
_GOLD, _SLOT, _PATH, _MASK = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, (1 << 64) - 1


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[dict[str, tuple[int, float]], list[bytes], int]:
    """Pieces with id and weight (not log); the bytes of every id; the longest piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[str, tuple[int, float]] = {}
    out: list[bytes] = []
    rank = 0
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(b"")
        else:
            rank += 1
            pieces[p] = i, (rank + SHIFT) ** -ALPHA
            out.append(p.replace(SPACE, " ").encode())
    return pieces, out, max(map(len, pieces))


@lru_cache(maxsize=4)
def byte_ids(path: str) -> list[int]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


class Lattice:
    """The automaton of unit suffixes: state 0 is the end; edges of a state lie together."""

    def __init__(self, path: str):
        self.pieces, self.bytes, self.longest = vocabulary(path)
        self.of_byte = byte_ids(path)
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.byte_size = np.array([len(x) for x in self.bytes], np.int64)
        self.byte_at = np.cumsum(self.byte_size) - self.byte_size
        self.weigh()
        self.reset()

    def weigh(self) -> None:
        """A hash table of the pieces and their prefixes by a polynomial of their code points: ids and log weights, -inf for mere prefixes, by slot."""
        self.floor = -ALPHA * math.log(len(self.pieces) + SHIFT)
        self.starts = {p[:2] for p in self.pieces if len(p) > 1}
        found: dict[int, tuple[int, float]] = {}
        for p, (piece, weight) in self.pieces.items():
            key = 0
            for i, c in enumerate(p, 1):
                key = (key * _BASE + ord(c) + 1) & _MASK
                if i == len(p):
                    found[key] = piece, math.log(weight)
                else:
                    found.setdefault(key, (0, -math.inf))
        self.prefixes = Table()
        keys = np.array(list(found), np.uint64)
        self.prefixes.store(mixed(keys) | np.uint64(1), np.arange(len(keys)))
        self.of_prefix = tuple(np.array(x) for x in zip(*found.values(), strict=True))

    def reset(self) -> None:
        self.units, self.suffixes = Table(), Table()  # states of units and of their suffixes, by hashes
        self.n_states = 1
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # first character, rest and chars of the states that have no edges yet
        # upto, piece, next by edge; begin, log mass, first, rest, chars by state
        self.arrays = [np.zeros(1 << 12, t) for t in (np.float64, np.int32, np.int32, np.int64, np.float64, np.int32, np.int32, np.int32)]
        self.filled = [0, 0, 0, 2, 1, 1, 1, 1]
        self.extra: list[tuple[int, ...]] = []
        self.extra_of: dict[str, int] = {}

    def states_of(self, units: list[str]) -> np.ndarray:
        """The states of units. Suffixes that are new become states, those of a unit side by side, the shortest first; long units share none."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        end = np.cumsum(size)
        state, key = np.zeros(len(units), np.int64), np.zeros(len(units), np.uint64)
        for i in np.flatnonzero(size > UNIT_CHARS).tolist():
            n = int(size[i])
            ids = np.arange(self.n_states, self.n_states + n)
            self.fresh.append((chars[end[i] - n : end[i]][::-1].astype(np.int32), np.r_[0, ids[:-1]].astype(np.int32), np.arange(1, n + 1, dtype=np.int32)))
            self.n_states += n
            state[i] = ids[-1]
        live = np.flatnonzero((size > 0) & (size <= UNIT_CHARS))
        depth, base = 0, self.n_states
        made: list[tuple[np.ndarray, ...]] = []
        while len(live):
            depth += 1
            first = chars[end[live] - depth]
            key[live] = key[live] * np.uint64(_BASE) + first.astype(np.uint64) + np.uint64(1)
            spread = mixed(key[live] + np.uint64(depth)) | np.uint64(1)
            now = self.suffixes(spread)
            new = np.flatnonzero(now < 0)
            if len(new):
                own, where, back = np.unique(spread[new], return_index=True, return_inverse=True)
                at = new[where]
                made.append((own, live[at], np.full(len(own), depth), first[at].astype(np.int64), state[live[at]]))
                now[new] = self.n_states + back
                self.n_states += len(own)
            state[live] = now
            live = live[size[live] > depth]
        if made:
            keys, owner, chars_of, first, rest = (np.concatenate(x) for x in zip(*made, strict=True))
            order = np.lexsort((chars_of, owner))  # a state's rest comes before it: its owner is no later one
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(base, base + len(order))
            moved = lambda x: np.where(x >= base, place[np.clip(x - base, 0, len(place) - 1)], x)
            self.fresh.append(tuple(x[order].astype(np.int32) for x in (first, moved(rest), chars_of)))
            self.suffixes.store(keys, place)
            state = np.where(size > UNIT_CHARS, state, moved(state))
        return state

    def parts(self, line: str) -> Iterator[str]:
        """``line`` cut wherever no piece spans the cut."""
        begin = reach = 0
        for i in range(len(line)):
            if i and reach <= i:
                yield line[begin:i]
                begin = i
            if line[i : i + 2] in self.starts:
                for end in range(min(len(line), i + self.longest), max(reach, i + 1), -1):
                    if line[i:end] in self.pieces:
                        reach = end
                        break
        if line:
            yield line[begin:]

    def _put(self, k: int, new: np.ndarray) -> None:
        end = self.filled[k] + len(new)
        if end > len(self.arrays[k]):
            wider = np.zeros(end + end // 2, self.arrays[k].dtype)
            wider[: self.filled[k]] = self.arrays[k][: self.filled[k]]
            self.arrays[k] = wider
        self.arrays[k][self.filled[k] : end] = new
        self.filled[k] = end

    def _bytes(self, char: str, raw: bytes) -> int:
        if len(raw) == 1:
            return self.of_byte[raw[0]]
        if char not in self.extra_of:
            self.extra_of[char] = len(self.bytes) + len(self.extra)
            self.extra.append(tuple(self.of_byte[b] for b in raw))
        return self.extra_of[char]

    def tables(self) -> tuple[np.ndarray, ...]:
        """upto (in shares of the state's mass), piece, next and begin, with the edges of all states added so far."""
        if not self.fresh:
            return tuple(self.arrays[:4])
        first, rest, chars = (np.concatenate(x) for x in zip(*self.fresh, strict=True))
        self.fresh.clear()
        self._edges(first, rest, chars)
        return tuple(self.arrays[:4])

    def _edges(self, first: np.ndarray, rest: np.ndarray, depth: np.ndarray) -> None:
        """Edges and log masses of new states; a state's rest always comes before it."""
        n, known = len(first), self.filled[4]
        for k, x in ((5, first), (6, rest), (7, depth), (4, np.zeros(n))):
            self._put(k, x)
        mass, firsts, rests = self.arrays[4:7]
        ids, logs = self.of_prefix
        order = np.argsort(depth, kind="stable")  # rows go by depth, so that masses are there when they are needed
        live, at, key = np.arange(n), known + order, np.zeros(n, np.uint64)
        count = np.zeros(n, np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        for j in range(self.longest):
            key = key * np.uint64(_BASE) + firsts[at].astype(np.uint64) + np.uint64(1)
            at = rests[at].astype(np.int64)
            place = self.prefixes(mixed(key) | np.uint64(1))
            piece = (place >= 0) & (logs[place] > -np.inf)
            row = live[piece]
            found.append((row, count[row], ids[place[piece]], logs[place[piece]], at[piece]))
            count[row] += 1
            if j == 0 and not piece.all():  # characters without a piece
                chars, back = np.unique(firsts[known + order[~piece]], return_inverse=True)
                raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
                spelled = np.array([self._bytes(chr(c), x) for c, x in zip(chars.tolist(), raw, strict=True)])
                row = live[~piece]
                found.append((row, count[row], spelled[back], self.floor * np.array([len(x) for x in raw])[back], at[~piece]))
                count[row] += 1
            keep = (place >= 0) & (at > 0)
            live, key, at = live[keep], key[keep], at[keep]
            if not len(live):
                break
        end = np.cumsum(count)
        begin = end - count
        row, rank, piece, log, to = (np.concatenate(x) for x in zip(*found, strict=True))
        place = end[row] - 1 - rank  # long pieces first: they are the likely ones
        edge_id, edge_to, share = np.empty(end[-1], np.int32), np.empty(end[-1], np.int32), np.empty(end[-1])
        edge_id[place], edge_to[place], share[place] = piece, to, log
        cuts = np.flatnonzero(np.diff(depth[order])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True):
            a, b = begin[lo], end[hi - 1]
            w = share[a:b] + mass[edge_to[a:b]]
            here = begin[lo:hi] - a
            top = np.maximum.reduceat(w, here)
            w = np.exp(w - np.repeat(top, count[lo:hi]))
            total = np.add.reduceat(w, here)
            mass[known + order[lo:hi]] = top + np.log(total)
            share[a:b] = w / np.repeat(total, count[lo:hi])
        some = np.flatnonzero(count > 1)
        for k in range(1, int(count.max())):
            some = some[count[some] > k]
            share[begin[some] + k] += share[begin[some] + k - 1]
        share[end - 1] = 1.0
        own = np.empty(n, np.int64)
        own[order] = np.arange(n)
        degree = count[own]
        upto = np.cumsum(degree)
        take = np.repeat(begin[own] - upto + degree, degree) + np.arange(len(share))
        start = self.filled[0]
        self._put(0, share[take])
        self._put(1, edge_id[take])
        self._put(2, edge_to[take])
        self._put(3, start + upto)

    def walk(self, states: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A path sampled from each state: pieces in order, how many each state got, log-probability of each."""
        upto, piece, to, begin = self.tables()
        n = len(states)
        now, who, chance, logs, steps = states.copy(), np.arange(n), np.ones(n), np.zeros(n), np.zeros(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        step = 0
        while True:
            live = now > 0
            if not live.all():
                now, who = now[live], who[live]
            if not len(now):
                break
            u = uniform(keys[who], step)
            edge = begin[now]
            open_ = np.flatnonzero(upto[edge] < u)
            while len(open_):
                edge[open_] += 1
                open_ = open_[upto[edge[open_]] < u[open_]]
            low = np.where(edge > begin[now], upto[edge - 1], 0.0)
            chance[who] *= upto[edge] - low
            steps[who] += 1
            found.append((who, piece[edge]))
            now = to[edge]
            step += 1
            if step % 16 == 0:  # before the product of so many shares could vanish
                logs[who] += np.log(chance[who])
                chance[who] = 1.0
        first = np.concatenate([[0], np.cumsum(steps)])
        ids = np.empty(first[-1], np.int32)
        for k, (who, got) in enumerate(found):
            ids[first[who] + k] = got
        return ids, steps, logs + np.log(chance)

    def tails(self, state: int, path: list[int]) -> list[float]:
        """Probability of each tail of a path of pieces from a state."""
        upto, piece, to, begin = self.tables()
        shares = []
        for x in path:
            for e in range(begin[state], begin[state + 1]):
                if piece[e] == x:
                    shares.append(float(upto[e] - (upto[e - 1] if e > begin[state] else 0.0)))
                    state = to[e]
                    break
        out = [1.0]
        for p in reversed(shares):
            out.append(out[-1] * p)
        return out[::-1]

    def other(self, state: int, banned: list[list[int]], key: np.ndarray) -> tuple[list[int] | None, float, float]:
        """A path from a state sampled from all but the banned ones, its log-probability, and the mass it was drawn from."""
        upto, piece, to, begin = self.tables()
        ids, log_p, mass, step = [], 0.0, None, 0
        held = [(b, self.tails(state, b)) for b in banned]
        while state > 0:
            edges = range(begin[state], begin[state + 1])
            own = [upto[e] - (upto[e - 1] if e > edges[0] else 0.0) for e in edges]
            rest = [max(0.0, p * (1.0 - sum(t[step + 1] for b, t in held if b[step] == piece[e]))) for e, p in zip(edges, own, strict=True)]
            rest = [x if x > 1e-12 * p else 0.0 for x, p in zip(rest, own, strict=True)]
            total = sum(rest)
            mass = total if mass is None else mass
            if total <= 0.0:
                return None, 0.0, 0.0
            u, k = float(uniform(key, 20_000 + step)[0]) * total, 0
            while k + 1 < len(rest) and (u >= rest[k] or rest[k] == 0.0):
                u -= rest[k]
                k += 1
            while rest[k] == 0.0:
                k -= 1
            e = edges[k]
            held = [x for x in held if x[0][step] == piece[e]]
            ids.append(int(piece[e]))
            log_p += math.log(own[k])
            state = int(to[e])
            step += 1
        return ids, log_p, mass or 0.0

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """Ids with the characters that have no piece as their bytes."""
        n = len(self.bytes)
        if not len(ids) or ids.max() < n:
            return ids
        return np.array([x for i in ids.tolist() for x in ((i,) if i < n else self.extra[i - n])], np.int32)


def uniform(keys: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) by key and step."""
    return ((mixed(keys + np.uint64(_GOLD * (step + 1) & _MASK)) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def truncated(phi: np.ndarray, u: np.ndarray, top: float) -> np.ndarray:
    """Gumbels of location phi, given that they are at most ``top``: -log(exp(-top) + exp(-g)) of free ones g."""
    g = phi - np.log(-np.log(u))
    with np.errstate(invalid="ignore"):
        return np.where(np.isneginf(phi), -np.inf, np.minimum(top, g) - np.log1p(np.exp(-np.abs(top - g))))


def sample_batch(lattice: Lattice, texts_units: list[np.ndarray], keys: list[int], k: int) -> tuple[list[list[tuple[np.ndarray, float, float]]], np.ndarray]:
    """For each text up to k paths (ids, log p, perturbed log p) in descending order, and the threshold kappa.

    All texts advance together: in each round every text pops the top of its
    frontier, and the units after the branches are sampled in one walk.
    """
    m = len(texts_units)
    size = np.array([len(u) for u in texts_units], np.int64)
    bound = np.concatenate([[0], np.cumsum(size)])
    units = np.concatenate([np.zeros(0, np.int64), *texts_units])
    text = np.repeat(np.arange(m), size)
    place = np.arange(len(units)) - bound[text]
    seeds = np.array([x & _MASK for x in keys], np.uint64)
    slot = place.astype(np.uint64) * np.uint64(_SLOT)
    base = lambda path: mixed(seeds + np.uint64(_PATH * (path + 1) & _MASK))
    draw = lambda path: base(path)[text] + slot
    full = np.flatnonzero(size > 0)
    starts = bound[:-1][full]
    edges = list(zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True))
    top = -np.log(-np.log(uniform(base(300), 10_001)))

    def frontier_of(logs: np.ndarray, g: np.ndarray, path: int) -> np.ndarray:
        """At each unit the maximum over the choices not taken there."""
        before = np.empty(len(logs))
        for lo, hi in edges:  # sums of each text alone, so that a row's result does not depend on its neighbours
            before[lo:hi] = np.cumsum(logs[lo:hi])
        before -= logs
        with np.errstate(divide="ignore"):
            rest = np.where(logs > -1e-13, -np.inf, before + np.log(-np.expm1(np.minimum(logs, 0.0))))
        return truncated(rest, uniform(draw(100 + path), 10_002), g[text])

    ids, steps, logs = lattice.walk(units, draw(0))
    first = np.concatenate([[0], np.cumsum(steps)])
    out = [[(ids[first[bound[i]] : first[bound[i + 1]]], 0.0, float(top[i]))] for i in range(m)]
    at = [[first[bound[i] : bound[i + 1] + 1] - first[bound[i]] for i in range(m)]]
    all_logs, frontiers = [logs], [frontier_of(logs, top, 0)]
    total = lambda x: np.array([x[lo:hi].sum() for lo, hi in edges])
    sums = [total(logs)]
    made = [{0: 0} for _ in range(m)]  # round -> place in out
    banned: dict[tuple[int, int, int], tuple[list[list[int]], float]] = {}
    for r in range(1, k):
        if not len(full):
            break
        peaks = np.array([np.maximum.reduceat(f, starts) for f in frontiers])
        source = peaks.argmax(0)
        g = np.full(m, -np.inf)
        g[full] = peaks.max(0)
        branch, ones = np.full(m, -1), [None] * m
        one_log = np.zeros(m)
        origin = np.zeros(m, np.int64)
        origin[full] = source
        for i in full[np.isfinite(g[full])].tolist():
            q = int(origin[i])
            d = int(frontiers[q][bound[i] : bound[i + 1]].argmax())
            a = at[q][i]
            old = out[i][made[i][q]][0]
            own, _ = banned.get((i, q, d), ([old[a[d] : a[d + 1]].tolist()], 0.0))
            key = mixed(np.array([(keys[i] + _PATH * (r + 401) + _SLOT * d) & _MASK], np.uint64))
            other, one_log[i], left = lattice.other(int(units[bound[i] + d]), own, key)
            cell = bound[i] + d
            if other is None:
                frontiers[q][cell] = -np.inf
                continue
            banned[i, q, d] = [*own, other], left
            left -= math.exp(one_log[i])
            before = all_logs[q][bound[i] : cell].sum()
            frontiers[q][cell] = -np.inf if left <= 1e-13 else truncated(np.array([before + math.log(left)]), uniform(key, 10_003), g[i])[0]
            branch[i], ones[i] = d, other
        live = branch >= 0
        tail = live[text] & (place > branch[text])
        tail_ids, tail_steps, tail_logs = lattice.walk(units[tail], draw(r)[tail])
        logs = np.zeros(len(units))
        stack = np.array(all_logs)
        logs = stack[origin[text], np.arange(len(units))]
        logs[tail] = tail_logs
        logs[bound[:-1][live] + branch[live]] = one_log[live]
        f = frontier_of(logs, g, r)
        f[~live[text] | (place <= branch[text])] = -np.inf
        all_logs.append(logs)
        frontiers.append(f)
        sums.append(total(logs))
        row: list[np.ndarray] = []
        ends = np.concatenate([[0], np.cumsum(tail_steps)])
        cursor = 0
        for i in range(m):
            if not live[i]:
                row.append(at[0][i])
                continue
            q, d = int(origin[i]), int(branch[i])
            a, n = at[q][i], int(size[i]) - d - 1
            mine = ends[cursor : cursor + n + 1]
            cursor += n
            one = np.array(ones[i], np.int32)
            row.append(np.concatenate([a[: d + 1], a[d] + len(one) + mine - mine[0]]))
            made[i][r] = len(out[i])
            out[i].append((np.concatenate([out[i][made[i][q]][0][: a[d]], one, tail_ids[mine[0] : mine[-1]]]), 0.0, float(g[i])))
        at.append(row)
    kappa = np.full(m, -np.inf)
    if len(full):
        kappa[full] = np.array([np.maximum.reduceat(f, starts) for f in frontiers]).max(0)
    for i in range(m):
        out[i] = [(out[i][j][0], float(sums[r][i]), out[i][j][2]) for r, j in made[i].items()]
    return out, kappa


def sample_paths(lattice: Lattice, units: np.ndarray, key: int, k: int) -> tuple[list[tuple[np.ndarray, float, float]], float]:
    """The paths and kappa of one text."""
    out, kappa = sample_batch(lattice, [units], [key], k)
    return out[0], float(kappa[0])


_workers: dict[str, Lattice] = {}


def lattice_of(path: str) -> Lattice:
    if path not in _workers:
        _workers[path] = Lattice(path)
    if _workers[path].n_states > MAX_STATES:
        _workers[path].reset()
    return _workers[path]


def states_of_texts(lattice: Lattice, raw: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The states of the units of each text: a text has a space before it, and a unit is a line break, or spaces with what follows up to the next of either.

    Units are told apart by 64-bit hashes of their bytes; only new ones are looked at as text.
    """
    n, data = len(at) - 1, raw.tobytes()
    if _MARK in data:  # the model's own sign for a space
        own = [data[a:b].replace(_MARK, b" ") for a, b in zip(at.tolist(), at[1:].tolist())]
        raw, at = np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in own])])
    bound = at + np.arange(n + 1)
    is_text = np.ones(bound[-1], bool)
    is_text[bound[:-1]] = False
    whole = np.full(bound[-1], 32, np.uint8)
    whole[is_text] = raw
    space, line = whole == 32, whole == 10
    start = line.copy()
    start[1:] |= (space[1:] & ~space[:-1]) | line[:-1]
    start[bound[:-1]] = True
    first = np.flatnonzero(start)
    end = np.append(first[1:], len(whole))[: len(first)]
    key = Spans(whole, fold=False)(first, end) | np.uint64(1)
    state = lattice.units(key)
    several: dict[int, np.ndarray] = {}
    new = np.flatnonzero(state < 0)
    if len(new):
        own, where, back = np.unique(key[new], return_index=True, return_inverse=True)
        data = whole.tobytes()
        words = [data[a:b].decode().replace(" ", SPACE) for a, b in zip(first[new[where]].tolist(), end[new[where]].tolist(), strict=True)]
        long = {i: list(lattice.parts(w)) for i, w in enumerate(words) if len(w) > UNIT_CHARS}
        short = np.array([i for i in range(len(words)) if i not in long], np.int64)
        got = lattice.states_of([words[i] for i in short.tolist()] + [x for parts in long.values() for x in parts])
        lattice.units.store(own[short], got[: len(short)])
        ends = np.cumsum([len(short), *map(len, long.values())])
        of_new = np.empty(len(own), np.int64)
        of_new[short] = got[: len(short)]
        for i, lo, hi in zip(long, ends.tolist(), ends[1:].tolist()):
            several[-1 - i], of_new[i] = got[lo:hi], -1 - i
        state[new] = of_new[back]
    cuts = np.searchsorted(first, bound)
    if several:
        size = np.ones(len(state), np.int64)
        many = np.flatnonzero(state < 0)
        size[many] = [len(several[x]) for x in state[many].tolist()]
        sums = np.concatenate([[0], np.cumsum(size)])
        flat = np.repeat(state, size)
        flat[flat < 0] = np.concatenate([several[x] for x in state[many].tolist()])
        state, cuts = flat, sums[cuts]
    empty = np.diff(at) == 0
    return [state[:0] if e else state[a:b] for e, a, b in zip(empty.tolist(), cuts.tolist(), cuts[1:].tolist())]


def unit_states(lattice: Lattice, text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return states_of_texts(lattice, raw, np.array([0, len(raw)]))[0]


def decode_ids(ids: list[int], table: list[bytes]) -> str:
    """The text of piece ids, without the space before the first word."""
    return b"".join(map(table.__getitem__, ids))[1:].decode(errors="replace")


def spelled_alike(lattice: Lattice, flat: list[np.ndarray], raw: np.ndarray, spans: list[tuple[int, int]]) -> list[bool]:
    """Whether each list of ids spells the bytes of its span, after the space before the first word."""
    ids = np.concatenate([np.zeros(0, np.int32), *flat])
    size = lattice.byte_size[ids]
    end = np.cumsum(size)
    got = lattice.blob[np.repeat(lattice.byte_at[ids] - end + size, size) + np.arange(size.sum())]
    cuts = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum([len(x) for x in flat], dtype=np.int64)])].tolist()
    return [hi == lo if a == b else hi - lo == b - a + 1 and got[lo] == 32 and np.array_equal(got[lo + 1 : hi], raw[a:b]) for (a, b), lo, hi in zip(spans, cuts, cuts[1:])]


def _rows(out: dict[str, list], flat: list[np.ndarray]) -> pa.RecordBatch:
    """The columns of found segmentations with their ids."""
    types = {"doc_id": pa.int64(), "rank": pa.int32(), "n_pieces": pa.int64(), "round_trip": pa.bool_()}
    columns = {c: pa.array(x, types.get(c, pa.float64())) for c, x in out.items()}
    edge = np.concatenate([[0], np.cumsum(out["n_pieces"], dtype=np.int64)])
    columns["ids"] = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *flat])))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _encode(batches: Iterator[pa.RecordBatch], path: str, k: int, seed: int) -> Iterator[pa.RecordBatch]:
    gc.disable()  # no cycles arise here, and the automaton's tables are costly to walk
    for batch in batches:
        raw, at = texts(batch.column("text"))
        doc_ids, keys = batch.column("doc_id").to_pylist(), [x ^ (seed * 0x9E3779B9) for x in batch.column("key").to_pylist()]
        for lo, hi in slices(at, BATCH_BYTES):
            lattice = lattice_of(path)
            mine, own = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            units = states_of_texts(lattice, mine, own)
            found, kappas = sample_batch(lattice, units, keys[lo:hi], k)
            out: dict[str, list] = {c: [] for c in ("doc_id", "rank", "n_pieces", "log_p", "perturbed", "log_inclusion", "round_trip")}
            flat: list[np.ndarray] = []
            spans: list[tuple[int, int]] = []
            for doc_id, a, b, paths, kappa in zip(doc_ids[lo:hi], own.tolist(), own[1:].tolist(), found, kappas.tolist()):
                for rank, (ids, log_p, g) in enumerate(paths):
                    ids = lattice.spelled(ids)
                    x = log_p - kappa  # inclusion: 1 - exp(-exp(x))
                    out["doc_id"].append(doc_id)
                    out["rank"].append(rank)
                    out["n_pieces"].append(len(ids))
                    out["log_p"].append(log_p)
                    out["perturbed"].append(g)
                    out["log_inclusion"].append(x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 30.0)))))
                    flat.append(ids)
                    spans.append((a, b))
            out["round_trip"] = spelled_alike(lattice, flat, mine, spans)
            yield _rows(out, flat)
    lattice_of(path).reset()  # a worker that waits for its next task holds nothing


def encode(docs: DataFrame, path: str, k: int = K, seed: int = SEED) -> DataFrame:
    """A row for each document and sampled segmentation: rank (0 best perturbed), n_pieces, scores, round_trip and ids."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: tidy(_encode(b, path, k, seed)), "doc_id long, rank int, n_pieces long, log_p double, perturbed double, log_inclusion double, round_trip boolean, ids array<int>")


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The columns of ``rows`` with the text of each list of ids as ``out`` (null: null), which must be a new name."""
    if out in rows.columns:
        raise ValueError(f"column {out!r} exists")
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)[1]
        for batch in batches:
            text = [None if x is None else decode_ids(x, table) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], [*batch.schema.names, out])

    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + f", `{out}` string")
