"""SentencePiece sampling without replacement, and decoding.

The pieces come from a SentencePiece model file (a path, read by the driver; nothing is
trained). A text becomes characters with a word mark for each space and one in front; its
lattice has an edge for each piece that matches at a position, and byte pieces where a
character is no piece. Piece scores: 1 / (rank + ``RANK_SHIFT``) of the piece's merge rank,
raised to ``alpha``; the lattice's backward sums turn them into a distribution over
segmentations. No piece crosses from a word to the next mark, so the lattice is a chain of
words and each distinct word's lattice is built once for the slices of a task, as long as those kept have
``MOST_STATES`` states at most.

Sampling is Gumbel top-k without replacement. The perturbed score of a set of segmentations is
the maximum of log probability + Gumbel noise over it; that of all is drawn first, and a set
splits into the part that takes an edge and the rest, with the maximum on the one and a Gumbel
truncated at it on the other. A* keeps the rest-sets ordered by their perturbed maxima,
takes the best, which is exactly the next best segmentation, fixes its edge and walks down.
So the k segmentations are distinct and are the k best of the perturbed scores. The
(k + 1)-th best, kappa, gives the inclusion score: the log probability that a segmentation's
perturbed score exceeds kappa, log(1 - exp(-exp(log_prob - kappa))).

All noise is hashed from (row key, sample, word, step): results do not depend on how rows
are dealt to tasks. A slice's words walk through their lattices together, in numpy.

Defined cases: null and empty text have one empty segmentation (log_prob 0, inclusion 0);
texts with fewer segmentations than ``samples`` yield all of them, with inclusion 0 (sure);
rows with equal keys and texts get equal samples; a null key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import text_slices, utf8_parts
from .words import mix, uniform

SAMPLES = 2
ALPHA = 0.5
RANK_SHIFT = 2.7
SLICE = 200_000
#: States (characters of distinct words) whose lattices a task keeps.
MOST_STATES = 300_000
MARK = 0x2581
_LITERAL = 1 << 24
_U = np.uint64
_PRIME = 0x9FB21C651E98DF25
_PRIME_INV = pow(_PRIME, -1, 1 << 64)

SAMPLE = T.ArrayType(T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("log_prob", T.DoubleType()),
    T.StructField("perturbed", T.DoubleType()), T.StructField("log_inclusion", T.DoubleType()),
    T.StructField("round_trip", T.BooleanType())]))


def default_model() -> str:
    """The BPE model of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Slots:
    """64-bit hashes to numbers, by open addressing over arrays (-1: not there)."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray, bits: int = 18):
        while len(hashes) * 2 > 1 << bits:
            bits += 1
        self.shift = _U(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.zeros(1 << bits, _U)
        self.values = np.full(1 << bits, -1, np.int32)
        for h, v in zip(hashes.tolist(), values.tolist()):
            s = h >> (64 - bits)
            while self.values[s] >= 0:
                s = (s + 1) & self.mask
            self.keys[s], self.values[s] = h, v

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> self.shift).astype(np.int32)
        there = self.values[slot]
        hit = self.keys[slot] == h
        out = np.where(hit, there, np.int32(-1))
        open_ = np.flatnonzero(~hit & (there >= 0))  # another key's place: look further
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            there = self.values[slot]
            hit = self.keys[slot] == h[open_]
            out[open_[hit]] = there[hit]
            more = ~hit & (there >= 0)
            open_, slot = open_[more], slot[more]
        return out


@dataclass
class Pieces:
    """A model's vocabulary, as sent to the tasks."""

    text: list[str]  # of each id; "" for control pieces
    rank: np.ndarray  # merge rank of normal pieces, -1 for others
    byte: np.ndarray  # id of each of the 256 byte pieces

    def index(self, alpha: float) -> "Index":
        return Index(self, alpha)


def load_pieces(path: str | None = None) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
    n = m.get_piece_size()
    normal = [not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i)) for i in range(n)]
    text = [m.id_to_piece(i) if normal[i] else "" for i in range(n)]
    for t in text:
        if chr(MARK) in t.lstrip(chr(MARK)):
            raise ValueError("pieces that hold a word mark after other characters are not supported")
    byte = np.zeros(256, np.int32)
    for i in range(n):
        if m.is_byte(i):
            byte[int(m.id_to_piece(i)[1:-1], 16)] = i
    order = np.array([-m.get_score(i) for i in range(n)])
    return Pieces(text, np.where(normal, order, -1), byte)


class Index:
    """Lookup tables of a vocabulary, built once per Python worker."""

    def __init__(self, p: Pieces, alpha: float):
        self.byte = p.byte
        total = np.log(np.sum(1.0 / (p.rank[p.rank >= 0] + RANK_SHIFT)))
        worst = p.rank.max() + 1.0
        self.score = np.where(p.rank >= 0, -np.log(np.maximum(p.rank, 0) + RANK_SHIFT) - total, 0.0) * alpha
        self.byte_score = alpha * (-np.log(worst + RANK_SHIFT) - total)
        known: dict[str, int] = {}
        for i, t in enumerate(p.text):
            for k in range(1, len(t) + 1):
                known.setdefault(t[:k], -1)
        for i, t in enumerate(p.text):
            if t:
                known[t] = i
        self.longest = max(map(len, known))
        points = np.frombuffer("".join(known).encode("utf-32-le"), np.uint32)
        at = np.zeros(len(known) + 1, np.int64)
        np.cumsum([len(t) for t in known], out=at[1:])
        sums, down = prefix_hash(points)
        # the value is the piece's id + 1, or 0 for what only begins a piece
        self.slots = _Slots(run_hash(sums, down, at[:-1], at[1:]), np.array(list(known.values())) + 1)
        # what each id decodes to, in UTF-8
        data = [t.replace(chr(MARK), " ").encode() for t in p.text]
        for b, i in enumerate(p.byte):
            data[i] = bytes([b])
        self.out = pa.array(data, pa.large_binary())


_KEPT: dict = {}


def _index(sent, alpha: float) -> Index:
    key = (sent.id if hasattr(sent, "id") else id(sent), alpha)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = sent.value.index(alpha)
    return _KEPT[key]


_POWERS = [np.ones(1, _U), np.ones(1, _U)]


def prefix_hash(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(points) + 1
    if len(_POWERS[0]) < n:
        for k, r in enumerate((_PRIME, _PRIME_INV)):
            steps = np.full(n, r, _U)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=_U)
    sums = np.zeros(n, _U)
    np.cumsum((points.astype(_U) + _U(1)) * _POWERS[0][: n - 1], dtype=_U, out=sums[1:])
    return sums, _POWERS[1]


def run_hash(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    h = (sums[end] - sums[start]) * down[start]
    h += (end - start).astype(_U)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[k], begin[k] + 1, ... (size[k] of them) for each k, joined."""
    if not len(size):
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(int(ends[-1])) + np.repeat(begin - ends + size, size)


@dataclass
class Lattice:
    """Lattices of distinct words. A state is a place in a word; edges are sorted by state, long pieces first."""

    first: np.ndarray  # edges of state s: first[s] .. first[s + 1]
    end: np.ndarray  # the state an edge leads to
    log_p: np.ndarray  # log probability of the edge, given its state
    below: np.ndarray  # probability of the state's edges up to and with this one
    id_at: np.ndarray  # ids of edge e: ids[id_at[e]:id_at[e + 1]]
    ids: np.ndarray
    final: np.ndarray  # whether a state ends its word


def build_lattice(points: np.ndarray, at: np.ndarray, ix: Index) -> Lattice:
    """points: characters of the words, joined; word t is points[at[t]:at[t + 1]]. State of place i in word t: at[t] + t + i."""
    n_words, size = len(at) - 1, np.diff(at)
    word = np.repeat(np.arange(n_words, dtype=np.int32), size)
    stop = at[1:].astype(np.int32)[word]  # where the word of each character ends
    sums, down = prefix_hash(points)
    starts, piece = [], []
    alive = np.arange(len(points), dtype=np.int32)
    single = np.zeros(len(points), bool)
    for n in range(1, ix.longest + 1):
        alive = alive[alive + n <= stop[alive]]
        v = ix.slots.find(run_hash(sums, down, alive, alive + n))
        alive, v = alive[v >= 0], v[v >= 0]
        if not len(alive):
            break
        s = alive[v > 0]
        if n == 1:
            single[s] = True
        starts.append(s)
        piece.append(v[v > 0] - 1)
    lone = np.flatnonzero(~single).astype(np.int32)  # characters that are no piece: their UTF-8 bytes
    data = [chr(c & (_LITERAL - 1)).encode("utf-8", "surrogatepass") for c in points[lone].tolist()]
    n_states = len(points) + n_words
    each = np.zeros(len(points), np.int32)
    for s in (lone, *starts):
        each[s] += 1
    state_of = np.arange(len(points), dtype=np.int32) + word
    per_state = np.zeros(n_states, np.int32)
    per_state[state_of] = each
    first = np.zeros(n_states + 1, np.int32)
    np.cumsum(per_state, out=first[1:])
    # edges are put in their places, of each state the longest first, as those mostly are the likeliest
    free = first[state_of]
    n_edges = int(first[-1])
    start, to, one = np.zeros(n_edges, np.int32), np.zeros(n_edges, np.int32), np.zeros(n_edges, np.int32)
    at_lone = free[lone]
    for k, s in enumerate((lone, *starts[::-1])):
        e = free[s]
        start[e], to[e] = s, state_of[s] + np.int32(len(starts) + 1 - k if k else 1)
        if k:
            one[e] = piece[-k]
        free[s] = e + 1
    lengths = np.array([len(d) for d in data], np.int64)
    score = ix.score[one]
    score[at_lone] = lengths * ix.byte_score
    id_at = np.arange(n_edges + 1, dtype=np.int32)
    ids = one
    if len(lone):
        sizes = np.ones(n_edges, np.int64)
        sizes[at_lone] = lengths
        np.cumsum(sizes, out=id_at[1:])
        ids = np.repeat(one, sizes)
        ids[ranges(id_at[at_lone], lengths)] = ix.byte[np.frombuffer(b"".join(data), np.uint8)]
    state = state_of[start]
    # backward sums, place by place from the ends of the words
    left = stop[start] - start
    most = int(size.max()) if n_words else 0
    order = np.argsort(left.astype(np.uint16) if most < 1 << 16 else left, kind="stable")
    total = np.zeros(len(points) + n_words)
    cuts = np.searchsorted(left[order], np.arange(1, most + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            e = order[a:b]
            s = state[e]
            head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            x = score[e] + total[to[e]]
            top = np.maximum.reduceat(x, head)
            each = np.diff(np.append(head, len(x)))
            total[s[head]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, each)), head))
    log_p = np.minimum(score + total[to] - total[state], 0.0)
    p = np.exp(log_p)
    below = np.cumsum(p)
    below -= np.repeat((below - p)[first[:-1][first[1:] > first[:-1]]], np.diff(first)[first[1:] > first[:-1]])
    below[first[1:][first[1:] > first[:-1]] - 1] = 1.0  # rounding must not let a draw pass the last edge
    final = np.zeros(len(points) + n_words, bool)
    final[at[1:] + np.arange(n_words)] = True
    return Lattice(first, to, log_p, below, id_at, ids, final)


class Words:
    """The lattices of the distinct words of a task's slices so far, in one lattice; beyond MOST_STATES states it begins anew."""

    def __init__(self, ix: Index):
        self.ix = ix
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts = np.zeros(0, _U), np.zeros(0, np.int64)
        self.held = {k: (np.zeros(n, t), n) for k, t, n in [("first", np.int32, 1), ("end", np.int32, 0), ("log_p", np.float64, 0), (
            "below", np.float64, 0), ("id_at", np.int32, 1), ("ids", np.int32, 0), ("final", bool, 0)]}

    def _append(self, name: str, values: np.ndarray) -> None:
        kept, n = self.held[name]
        if n + len(values) > len(kept):
            kept = np.concatenate([kept[:n], np.zeros(max(n, len(values)), kept.dtype)])
        kept[n: n + len(values)] = values
        self.held[name] = kept, n + len(values)

    def lattice(self) -> Lattice:
        return Lattice(**{k: kept[:n] for k, (kept, n) in self.held.items()})

    def find(self, points: np.ndarray, at: np.ndarray, size: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The states at which words begin, given their hashes (each once), and where they are in points."""
        if self.held["final"][1] > MOST_STATES:
            self.clear()
        place = np.searchsorted(self.hashes, h)
        new = np.ones(len(h), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(place, len(self.hashes) - 1)] != h
        if new.any():
            at, size = at[new], size[new]
            own = np.append(0, np.cumsum(size))
            made = build_lattice(points[ranges(at, size)], own, self.ix)
            n_states, n_edges, n_ids = (self.held[k][1] for k in ("final", "end", "ids"))
            for k, more in (("first", n_edges), ("id_at", n_ids)):
                self._append(k, getattr(made, k)[1:] + getattr(made, k).dtype.type(more))
            self._append("end", made.end + np.int32(n_states))
            for k in ("log_p", "below", "ids", "final"):
                self._append(k, getattr(made, k))
            self.hashes = np.insert(self.hashes, place[new], h[new])
            self.starts = np.insert(self.starts, place[new], own[:-1] + np.arange(len(at)) + n_states)
        return self.starts[np.searchsorted(self.hashes, h)]


@dataclass
class Slice:
    """Words of a slice of rows. start: state at which each word begins; row_at: the words of row r are row_at[r]:row_at[r + 1]."""

    lattice: Lattice
    start: np.ndarray
    row_at: np.ndarray


def read_slice(texts: list[str | None], words: Words) -> Slice:
    n = len(texts)
    lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    row_at = np.zeros(n + 1, np.int64)
    np.cumsum(lengths, out=row_at[1:])
    points = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    points[points == MARK] |= _LITERAL  # a mark character of the text itself goes by its bytes
    points[points == 0x20] = MARK
    # a word begins at a row's first character and at a mark after another character
    mark = points == MARK
    head = np.zeros(len(points) + 1, bool)
    head[row_at] = True
    head = head[:-1] | (mark & np.concatenate([[False], ~mark[:-1]])) if len(points) else head[:-1]
    at = np.flatnonzero(head)
    sums, down = prefix_hash(points)
    h = run_hash(sums, down, at, np.append(at[1:], len(points)))
    distinct, sample, kind = np.unique(h, return_index=True, return_inverse=True)
    size = np.append(at[1:], len(points)) - at
    start = words.find(points, at[sample], size[sample], distinct)
    return Slice(words.lattice(), start[kind], np.searchsorted(at, row_at))


_SALT = [_U(int(x)) for x in mix(np.arange(7, 12, dtype=_U))]


def _draw(seed: np.ndarray, sample: int, word: np.ndarray, step: np.ndarray | int, salt: int) -> np.ndarray:
    """Uniforms in (0, 1) hashed from row seed, sample, word of the row, and step."""
    at = (word.astype(_U) << _U(24)) + _U(sample) + (_U(step << 8) if isinstance(step, int) else step.astype(_U) << _U(8))
    return uniform(mix((at * _SALT[4] + _SALT[salt]) ^ seed))


def _truncated(log_mass: np.ndarray, limit: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at location log_mass, given that they are below limit."""
    with np.errstate(over="ignore", divide="ignore"):
        x = log_mass - np.log(np.exp(log_mass - limit) - np.log(u))
    return np.minimum(np.where(np.isneginf(log_mass), -np.inf, x), limit)


def walk(lat: Lattice, state: np.ndarray, seed: np.ndarray, word: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """One random path of each word from its state: edges in order of words, and the number of edges of each word."""
    n = len(state)
    count = np.zeros(n, np.int64)
    who, state = np.arange(n, dtype=np.int32), state.astype(np.int32)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    keep = ~lat.final[state] if n else np.zeros(0, bool)
    who, state = who[keep], state[keep]
    while len(who):
        u = _draw(seed[who], sample, word[who], len(steps), 0)
        e = lat.first[state]
        more = np.flatnonzero(u > lat.below[e])
        while len(more):
            e[more] += 1
            more = more[u[more] > lat.below[e[more]]]
        steps.append((who, e))
        count[who] += 1
        state = lat.end[e]
        keep = ~lat.final[state]
        who, state = who[keep], state[keep]
    begin = np.cumsum(count) - count
    edges = np.zeros(int(count.sum()), np.int32)
    for k, (w, e) in enumerate(steps):
        edges[begin[w] + k] = e
    return edges, count


@dataclass
class Path:
    """Segmentation number m of each row: its edges, and for each edge the state's rest-set."""

    edges: np.ndarray
    at: np.ndarray  # the edges of row r: at[r]:at[r + 1] (none for rows that have no m-th)
    word: np.ndarray  # the word (in its row) of each edge
    prefix: np.ndarray  # log probability of the edges before
    rest: np.ndarray  # perturbed maximum of what leaves the path here
    log_prob: np.ndarray
    perturbed: np.ndarray


#: Noise is at most 36.8, as uniforms have 53 bits: a rest-set whose log mass is under FAR stays under FAR + 36.8.
FAR, REACH = -60.0, -60.0 + 36.8


def _rests(lat: Lattice, edges, at, word, fresh, seed, top, sample, k) -> Path:
    """Scores of paths. fresh: the place of each row's first edge that is new; the rest-sets before belong to older paths.

    Rest-sets beyond FAR are worked out only if some row has fewer than k nearer ones above REACH; else none of
    them can be among the k best.
    """
    n, size = len(at) - 1, np.diff(at)
    lp = lat.log_p[edges]
    prefix = np.cumsum(lp) - lp
    zero = prefix[np.minimum(at[:-1], max(len(lp) - 1, 0))] if len(lp) else np.zeros(n)
    prefix -= np.repeat(zero, size)
    log_prob = np.zeros(n)
    full = size > 0
    log_prob[full] = np.add.reduceat(lp, at[:-1][full]) if full.any() else 0.0
    rest = np.full(len(lp), -np.inf)
    near = np.flatnonzero((prefix >= FAR) & (lp < 0.0))
    row = np.searchsorted(at, near, side="right") - 1
    near, row = near[near - at[row] >= fresh[row]], row[near - at[row] >= fresh[row]]
    rest[near] = _rest(lp, prefix, near, row, at, seed, top, sample)
    enough = np.bincount(row[rest[near] > REACH], minlength=n)
    far = np.flatnonzero(full & (enough < k) & (log_prob < FAR))
    if len(far):
        more = ranges(at[far], size[far])
        more = more[(prefix[more] < FAR) & (lp[more] < 0.0)]
        row = np.searchsorted(at, more, side="right") - 1
        more, row = more[more - at[row] >= fresh[row]], row[more - at[row] >= fresh[row]]
        rest[more] = _rest(lp, prefix, more, row, at, seed, top, sample)
    return Path(edges, at, word, prefix, rest, log_prob, top)


def _rest(lp, prefix, x, row, at, seed, top, sample) -> np.ndarray:
    """Perturbed maxima of the rest-sets at edges x."""
    with np.errstate(divide="ignore"):
        mass = prefix[x] + np.log(-np.expm1(lp[x]))
    return _truncated(mass, top[row], _draw(seed[row], sample, x - at[row], 0, 1))


def sample_rows(s: Slice, seed: np.ndarray, k: int) -> tuple[list[Path], np.ndarray, np.ndarray]:
    """The k best segmentations by perturbed score, how many of them each row has, and kappa."""
    lat, n = s.lattice, len(s.row_at) - 1
    words = np.diff(s.row_at)
    row = np.repeat(np.arange(n), words)
    word = np.arange(len(row)) - s.row_at[row]
    edges, count = walk(lat, s.start, seed[row], word, 0)
    at = np.append(0, np.cumsum(count))[s.row_at]
    top = -np.log(-np.log(_draw(seed, 0, np.zeros(n), 0, 2)))
    paths = [_rests(lat, edges, at, np.repeat(word, count), np.zeros(n, np.int64), seed, top, 0, k)]
    have = np.ones(n, np.int64)
    taken: dict[tuple[int, int, int], list[int]] = {}
    kappa = np.full(n, -np.inf)
    for m in range(1, k + 1):
        best = np.full((m, n), -np.inf)
        for i, p in enumerate(paths):
            full = np.flatnonzero(np.diff(p.at))
            if len(full):
                best[i, full] = np.maximum.reduceat(p.rest, p.at[full])
        which, value = best.argmax(axis=0), best.max(axis=0)
        go = np.flatnonzero(value > -np.inf)
        if m == k:
            kappa[go] = value[go]
            break
        # fix another edge where the best rest-set leaves its path
        heads, states, from_word, fresh = [], [], np.zeros(n, np.int64), np.zeros(n, np.int64)
        for r in go.tolist():
            p = paths[which[r]]
            j = int(p.rest[p.at[r]: p.at[r + 1]].argmax())
            x = p.at[r] + j
            e = int(p.edges[x])
            used = taken.setdefault((r, int(which[r]), j), [e])
            st = int(np.searchsorted(lat.first, np.int32(e), side="right")) - 1
            free = [c for c in range(int(lat.first[st]), int(lat.first[st + 1])) if c not in used]
            lp = lat.log_p[free]
            rank = np.array([r], np.int64)
            u = _draw(seed[rank], m, np.full(len(free), 1 << 30), np.arange(len(free)), 3)
            c = free[int(np.argmax(lp - np.log(-np.log(u))))]
            used.append(c)
            left = np.exp(lat.log_p[[f for f in free if f != c]]).sum() if len(free) > 1 else 0.0
            mass = p.prefix[x] + (np.log(left) if left > 0 else -np.inf)
            p.rest[x] = _truncated(np.array([mass]), value[[r]], _draw(seed[rank], m, rank * 0, 0, 2))[0]
            heads.append((r, np.append(p.edges[p.at[r]: x], c), np.append(p.word[p.at[r]: x], p.word[x])))
            states.append(int(lat.end[c]))
            from_word[r] = p.word[x]
            fresh[r] = j + 1
        have[go] += 1
        # walk on: the rest of the word that changed, then all later words of the row
        lengths = np.zeros(n, np.int64)
        lengths[go] = words[go] - from_word[go]
        more = ranges(s.row_at[:-1] + from_word, lengths)
        row_m = np.repeat(np.arange(n), lengths)
        state = s.start[more].copy()
        begin = np.cumsum(lengths) - lengths
        state[begin[go]] = states
        tail, count = walk(lat, state, seed[row_m], more - s.row_at[row_m], m)
        tail_word = np.repeat(more - s.row_at[row_m], count)
        tail_at = np.append(0, np.cumsum(count))[np.append(begin, len(more))]
        parts, part_words, size = [], [], np.zeros(n, np.int64)
        for r, h, w in heads:
            parts += [h, tail[tail_at[r]: tail_at[r + 1]]]
            part_words += [w, tail_word[tail_at[r]: tail_at[r + 1]]]
            size[r] = len(h) + tail_at[r + 1] - tail_at[r]
        none = np.zeros(0, np.int64)
        paths.append(_rests(lat, np.concatenate([none, *parts]), np.append(0, np.cumsum(size)),
                            np.concatenate([none, *part_words]), fresh, seed, value, m, k))
    return paths, have, kappa


def log_inclusion(log_prob: np.ndarray, kappa: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(log_prob - kappa))), 0 where kappa is minus infinity."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        x = log_prob - kappa
        out = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700)))))
    return np.where(np.isneginf(kappa), 0.0, out)


def encode_rows(texts: list[str | None], seed: np.ndarray, ix: Index, k: int, words: Words | None = None) -> pa.Array:
    s = read_slice(texts, words or Words(ix))
    paths, have, kappa = sample_rows(s, seed.astype(np.int64).view(_U), k)
    lat, n = s.lattice, len(texts)
    # sample m of row r goes to place where[m, r] of the output
    at = np.append(0, np.cumsum(have))
    ids, sizes = [], np.zeros(int(at[-1]), np.int64)
    score = np.zeros((3, int(at[-1])))
    order = []
    for m, p in enumerate(paths):
        rows = np.flatnonzero(have > m)
        place = at[rows] + m
        lengths = lat.id_at[p.edges + 1] - lat.id_at[p.edges]
        upto = np.append(0, np.cumsum(lengths))
        which = lat.id_at[p.edges]
        longer = np.flatnonzero(lengths != 1)
        if len(longer):
            each, which = which[longer], np.repeat(which, lengths)
            which[ranges(upto[longer], lengths[longer])] = ranges(each, lengths[longer])
        ids.append(lat.ids[which])
        sizes[place] = (upto[p.at[1:]] - upto[p.at[:-1]])[rows]
        order.append((place, upto[p.at[:-1]][rows]))
        score[0, place], score[1, place] = p.log_prob[rows], p.perturbed[rows]
        score[2, place] = log_inclusion(p.log_prob[rows], kappa[rows])
    flat = np.zeros(int(sizes.sum()), np.int32)
    begin = np.cumsum(sizes) - sizes
    for x, (place, where) in zip(ids, order):
        for a, b, n_ids in zip(begin[place].tolist(), where.tolist(), sizes[place].tolist()):
            flat[a: a + n_ids] = x[b: b + n_ids]
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat, pa.int32()))
    # every sample is decoded again and held against its text
    same = pc.equal(decode_rows(lists, ix), pa.array(texts, pa.string()).fill_null("").take(pa.array(np.repeat(np.arange(n), have))))
    structs = pa.StructArray.from_arrays([lists, *(pa.array(x) for x in score), same],
                                         ["ids", "log_prob", "perturbed", "log_inclusion", "round_trip"])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), structs)


def decode_rows(ids: pa.Array, ix: Index) -> pa.Array:
    """Texts of lists of ids: pieces joined, marks as spaces, the space in front removed, bytes joined to characters."""
    at = np.asarray(ids.offsets, np.int64)
    x = np.asarray(ids.values)[at[0]: at[-1]]
    data = ix.out.take(pa.array(x))
    _, offsets, joined = data.buffers()
    cut = np.frombuffer(offsets, np.int64)[: len(data) + 1][at - at[0]]
    left = np.frombuffer(joined, np.uint8)[: int(cut[-1])] if joined is not None else np.zeros(0, np.uint8)
    lead = np.diff(cut) > 0
    keep = np.ones(len(left), bool)
    keep[cut[:-1][lead]] = False
    left = left[keep]
    cut = np.append(0, np.cumsum(np.diff(cut) - lead))
    if len(left) >= 1 << 31:
        raise ValueError("decoded texts of one slice exceed 2 GB")
    return pa.StringArray.from_buffers(len(ids), pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(left.tobytes()))


def _encode(batches: Iterator[pa.RecordBatch], sent, text_at: int, k: int, alpha: float, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    ix = _index(sent, alpha)
    words = Words(ix)
    for whole in batches:
        for b in text_slices(whole, text_at, SLICE):
            seed = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            found = encode_rows(b.column(text_at).to_pylist(), seed, ix, k, words)
            columns = [c for i, c in enumerate(b.columns[:-1]) if i != text_at] + [found.cast(kind)]
            yield pa.RecordBatch.from_arrays(columns, [n for i, n in enumerate(b.schema.names[:-1]) if i != text_at] + ["samples"])


def encode(docs: DataFrame, pieces: Pieces, keep: list[str], samples: int = SAMPLES, alpha: float = ALPHA,
           key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (without the text) and samples: up to ``samples`` distinct segmentations, best first.

    Of each: ids, log_prob, perturbed, log_inclusion, and round_trip: whether the ids decode to the text.
    """
    df = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("text"),
                     F.xxhash64(F.col(key_col)).alias("seed"))
    schema = T.StructType([df.schema[f"k{i}"] for i in range(len(keep))] + [T.StructField("samples", SAMPLE)])
    sent = docs.sparkSession.sparkContext.broadcast(pieces)
    return df.mapInArrow(partial(_encode, sent=sent, text_at=len(keep), k=samples, alpha=alpha, kind=to_arrow_type(SAMPLE)),
                         schema).toDF(*keep, "samples")


def _decode(batches: Iterator[pa.RecordBatch], sent, step: int = 512) -> Iterator[pa.RecordBatch]:
    ix = _index(sent, ALPHA)
    for whole in batches:
        for first in range(0, whole.num_rows, step):
            b = whole.slice(first, step)
            ids = b.column(b.num_columns - 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], decode_rows(ids.fill_null([]) if ids.null_count else ids, ix)],
                                             [*b.schema.names[:-1], "text"])


def decode(rows: DataFrame, pieces: Pieces, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """The columns ``keep`` and text, decoded from the ids; null ids decode to the empty text."""
    df = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(ids_col).cast("array<int>").alias("ids"))
    sent = rows.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("text", T.StringType())])
    return df.mapInArrow(partial(_decode, sent=sent), schema).toDF(*keep, "text")
