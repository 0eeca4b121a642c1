"""Blocked scorer: every user against every item, k rows per user leave the task (JN-8, EV-14..16, RC-3, RC-9).

Users are dealt into blocks, one block a task; a block's rows come first, then
all items stream past in order of falling norm, chunk by chunk.  A chunk of scores is one
product of matrices (or, for sparse vectors, of the terms that the chunk's items
use), so every pair is scored and none is shuffled.  The items are written once, in their order,
into the shared folder, and each task reads that table; only users and their top k are shuffled.

Items with equal vectors have equal scores with any user (all items without a
vector, for example), so a user's best `k` are among the first `k` unseen ones of each such
class: a block gets no more of a class than `k` and its longest list of seen items.

A single dot is screened in single precision, and the few pairs that can matter are scored again in double.
Of a chunk only the scores that reach a user's k-th are looked at one by one; what a user has seen is checked there.
Scores that are affine in the base scores (or ordered as such) are not computed as matrices at all: a weighted
sum of the base scores finds the few pairs that can reach a k-th score, and only those are scored.

Scores that are scaled per user need the user's smallest and largest raw
score first: `spread` gives them in a pass of its own, as numbers per user.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import written

#: Users of a block at most, users and items of one product.
BLOCK_USERS, TILE_USERS, TILE_ITEMS = 65536, 128, 1024
#: Users of a product that is screened.
SCREENED_USERS = 512
TIE_DIGITS = 9
_NO_ITEM = np.iinfo(np.int64).max
#: Users of one batch of results.
_OUT_USERS = 4096
#: Cost of an entry of a sum over terms, in entries of a product of matrices.
_DENSE = 32
#: Rounding errors of a sum, as a share of its largest terms (many times those of doubles).
_ERROR = 1e-12
#: Products of norms up to which dots are screened in single precision, and what underflows there at most.
_SINGLE_MOST, _SINGLE_LEAST = 1e30, 1e-30
#: Share of a tile's pairs from which on they are all scored in double precision.
_MANY = 1 / 16


@dataclass(frozen=True)
class Base:
    """A base score: `dot` or `cosine` of the array columns `name`, or `sparse` products of `name`_t (terms) and `name`_w.

    A user or item without a vector scores zero.  With `biased` the last two entries of a dot's
    vectors are the user's own part and 1, of an item 1 and its own part, which bounds a score more closely.
    """

    name: str
    kind: str = "dot"
    eps: float = 1e-8
    biased: bool = False

    @property
    def columns(self) -> list[tuple[str, str]]:
        if self.kind == "sparse":
            return [(f"{self.name}_t", "array<int>"), (f"{self.name}_w", "array<double>")]
        return [(self.name, "array<double>")]


class _Scratch:
    """Matrices that are used again tile by tile: fresh ones cost more page faults than the arithmetic in them takes time."""

    def __init__(self):
        self.arrays = {}

    def matrix(self, name, shape: tuple[int, int], dtype=float) -> np.ndarray:
        n = shape[0] * shape[1]
        if name not in self.arrays or self.arrays[name].size < n:
            self.arrays[name] = np.empty(n, dtype)
        return self.arrays[name][:n].reshape(shape)


class _Columns:
    """Sparse vectors of a chunk's items, by the terms that they use."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.full, self.n, self.weights = np.flatnonzero(sizes), len(sizes), weights
        self.starts = (ends - sizes)[self.full]
        names, self.place = np.unique(terms, return_inverse=True)
        self.width = len(names)
        # a term's column; the last entry stands for all terms that no item has
        self.column = np.full(int(names[-1]) + 2 if len(names) else 1, -1, np.int64)
        self.column[names] = np.arange(len(names))
        self.dense = None
        if len(names) * len(self.full) <= _DENSE * len(terms):
            # few terms in all: one product of matrices is cheaper than sums over each item's terms
            whole = np.zeros((len(names), len(sizes)))
            np.add.at(whole, (self.place, np.repeat(np.arange(len(sizes)), sizes)), weights)
            self.dense = whole if 2 * len(self.full) >= len(sizes) else np.ascontiguousarray(whole[:, self.full])

    def scores(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Products with the users of `out`'s rows, whose terms and weights come with their rows."""
        n = len(out)
        if not self.width:
            out[:] = 0.0
            return out
        at = self.column[np.minimum(terms, len(self.column) - 1)]
        met = at >= 0
        profile = np.zeros((n, self.width))
        profile[row[met], at[met]] = weights[met]
        if self.dense is not None and self.dense.shape[1] == self.n:
            return np.matmul(profile, self.dense, out=out)
        out[:] = 0.0
        out[:, self.full] = profile @ self.dense if self.dense is not None else np.add.reduceat(profile[:, self.place] * self.weights, self.starts, axis=1)
        return out


class _Rows:
    """Vectors of users or items as numpy arrays."""

    def __init__(self, rows: pa.Table, bases: list[Base], items: bool = False):
        self.key = rows.column("key").to_numpy()
        self.vectors = {}
        for b in bases:
            lists = rows.column(b.columns[0][0]).combine_chunks()
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            if b.kind == "sparse":
                terms, weights = lists.flatten().to_numpy(), rows.column(b.columns[1][0]).combine_chunks().flatten().to_numpy()
                ends = np.cumsum(sizes)
                self.vectors[b.name] = _Columns(sizes, ends, terms, weights) if items else (sizes, ends, terms, weights)
                continue
            width = int(sizes.max()) if len(sizes) else 0
            matrix, known = np.zeros((len(sizes), width)), sizes == width
            matrix[known] = lists.flatten().to_numpy().reshape(-1, width) if width else 0.0
            self.vectors[b.name] = (matrix, known & (width > 0), np.sqrt((matrix * matrix).sum(axis=1)))

    def __len__(self) -> int:
        return len(self.key)

    def single(self, base: Base) -> np.ndarray:
        """A dot's vectors in single precision."""
        if not hasattr(self, "_single"):
            with np.errstate(over="ignore"):
                self._single = self.vectors[base.name][0].astype(np.float32)
        return self._single

    def reach(self, base: Base, item: bool) -> tuple[np.ndarray, np.ndarray]:
        """(norm, own): a dot is at most the product of both norms plus both sides' own parts."""
        matrix, _, norm = self.vectors[base.name]
        if not base.biased or matrix.shape[1] < 2:
            return norm, np.zeros(len(norm))
        return np.sqrt((matrix[:, :-2] ** 2).sum(axis=1)), matrix[:, -1 if item else -2]


def _sorted_by_key(rows: pa.Table) -> pa.Table:
    return rows.take(pa.array(np.argsort(rows.column("key").to_numpy(), kind="stable")))


def _raw(base: Base, users: _Rows, tile: np.ndarray, items: _Rows, scratch: _Scratch) -> np.ndarray:
    out = scratch.matrix(base.name, (len(tile), len(items)))
    if base.kind == "sparse":
        n, ends, t, w = users.vectors[base.name]
        # a tile of sparse vectors is a run of users
        first, last = ends[tile[0]] - n[tile[0]], ends[tile[-1]]
        return items.vectors[base.name].scores(np.repeat(np.arange(len(tile)), n[tile]), t[first:last], w[first:last], out)
    u, known_u, norm_u = (x[tile] for x in users.vectors[base.name])
    v, known_v, norm_v = items.vectors[base.name]
    if u.shape[1] != v.shape[1]:  # nobody on one side has a vector
        out[:] = 0.0
        return out
    np.matmul(u, v.T, out=out)
    if base.kind == "cosine":
        norms = np.multiply(norm_u[:, None], norm_v, out=scratch.matrix("", out.shape))
        norms += base.eps
        out /= norms
    if not (known_u.all() and known_v.all()):
        out[~known_u] = 0.0
        out[:, ~known_v] = 0.0
    return out


def _screened(base: Base, users: _Rows, tile: np.ndarray, items: _Rows, scratch: _Scratch) -> tuple[np.ndarray, np.ndarray] | None:
    """A dot's scores in single precision and how far off a user's can be; None if that precision cannot hold them."""
    norm_u, norm_v = users.vectors[base.name][2][tile], items.vectors[base.name][2]
    u, v = users.single(base), items.single(base)
    longest = float(norm_v.max()) if len(norm_v) else 0.0
    if u.shape[1] != v.shape[1] or not np.isfinite(longest) or not (norm_u < _SINGLE_MOST / max(longest, 1.0)).all() or longest > _SINGLE_MOST:
        return None
    out = np.matmul(u[tile], v.T, out=scratch.matrix("single", (len(tile), len(items)), np.float32))
    # rounded entries, products and sums, each by half a unit of the last place at most, and twice that
    return out, 2 * (u.shape[1] + 4) * 2.0**-24 * norm_u * longest + _SINGLE_LEAST


class _Allowed:
    """Which items a user may get: not the seen ones, and the first `cap` others in key order if there is a cap."""

    def __init__(self, rows: pa.Table, cap: int | None):
        lists = rows.column("seen").combine_chunks()
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        seen = lists.flatten().to_numpy().astype(np.int64)
        # a pair is one number: users of a block and keys (int) take 31 bits at most
        self.pairs = np.sort(np.repeat(np.arange(len(sizes), dtype=np.int64) << 32, sizes) | seen)
        self.cutoff = None
        if cap is not None:
            ends = np.cumsum(sizes)
            self.cutoff = np.full(len(sizes), cap, np.int64)
            for k, (end, n) in enumerate(zip(ends, sizes, strict=True)):
                for s in np.sort(seen[end - n: end]):
                    if s >= self.cutoff[k]:
                        break
                    self.cutoff[k] += 1

    def refused(self, users: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Of pairs of a user's place and an item's key: whether the user may not get the item."""
        pairs = users.astype(np.int64) << 32 | keys
        at = np.searchsorted(self.pairs, pairs)
        out = np.zeros(len(pairs), bool)
        inside = at < len(self.pairs)
        out[inside] = self.pairs[at[inside]] == pairs[inside]
        return out if self.cutoff is None else out | (keys >= self.cutoff[users])

    def barred(self, users: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of each pair of a user's place and one of the sorted item keys that the user may not get."""
        # users are sorted by place, so each one's seen items are a run of the pairs
        first = np.searchsorted(self.pairs, users.astype(np.int64) << 32)
        sizes = np.searchsorted(self.pairs, (users.astype(np.int64) + 1) << 32) - first
        row = np.repeat(np.arange(len(users)), sizes)
        seen = self.pairs[np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)] & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(keys, seen), len(keys) - 1)
        met = keys[at] == seen
        row, at = row[met], at[met]
        if self.cutoff is not None:
            late = np.nonzero(keys >= self.cutoff[users][:, None])
            row, at = np.concatenate([row, late[0]]), np.concatenate([at, late[1]])
        return row, at


def _tiles(batches, bases: list[Base], cap: int | None, hopeless: Callable | None = None):
    """First the block's users, then (users, tile, barred, raw scores, items) for every tile of users and chunk of items.

    With `hopeless(users, items)`, which marks the users that no item of the chunk matters to, the caller screens the
    pairs: it gets the `_Allowed` for barred, and a function that makes some users' raw scores.
    """
    users, waiting, allowed, scratch = None, [], None, _Scratch()
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        is_item = rows.column("is_item").to_numpy()
        n = int(np.searchsorted(is_item, True))
        if n:
            waiting.append(rows.slice(0, n))
        rows = rows.slice(n)
        if len(rows) and users is None:
            if not waiting:
                return
            head = pa.concat_tables(waiting).combine_chunks()
            users, allowed, waiting = _Rows(head, bases), _Allowed(head, cap), []
            yield users, head, None, None, None
        for a in range(0, len(rows), TILE_ITEMS):
            items = _Rows(_sorted_by_key(rows.slice(a, TILE_ITEMS).combine_chunks()), bases, items=True)
            active = np.arange(len(users))
            if allowed.cutoff is not None and items.key[0] >= allowed.cutoff.max():
                continue
            if hopeless is not None:
                active = active[~hopeless(users, items)]
            step = TILE_USERS if hopeless is None else SCREENED_USERS
            for b in range(0, len(active), step):
                tile = active[b: b + step]
                if hopeless is not None:
                    yield users, tile, allowed, lambda some, items=items: _raw(bases[0], users, some, items, scratch), items
                    continue
                yield users, tile, allowed.barred(tile, items.key), {x.name: _raw(x, users, tile, items, scratch) for x in bases}, items


def _extremes(least: np.ndarray, most: np.ndarray, tile: np.ndarray, score: np.ndarray, barred: tuple) -> np.ndarray:
    """Move the tile's ends of a score outwards by the chunk's scores; returns these with the barred ones at minus infinity."""
    if not score.flags.writeable:
        score = score.copy()
    score[barred] = np.inf
    least[tile] = np.fmin(least[tile], np.fmin.reduce(score, axis=1))
    score[barred] = -np.inf
    most[tile] = np.fmax(most[tile], np.fmax.reduce(score, axis=1))
    return score


def _below(kth: np.ndarray) -> np.ndarray:
    """Scores below it round to less than `kth`."""
    return kth - np.where(np.isneginf(kth), 0.0, 10.0 ** -TIE_DIGITS + _ERROR * np.abs(kth))


def _above(kth: np.ndarray) -> np.ndarray:
    """Scores below it round to `kth` at most."""
    return kth + np.where(np.isneginf(kth), 0.0, 0.4 * 10.0 ** -TIE_DIGITS - _ERROR * np.abs(kth))


def _places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the few true entries, looked for eight at a time."""
    flat = marks.reshape(-1)
    whole = len(flat) // 8 * 8
    eights = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).reshape(-1)
    found = np.concatenate([eights[flat[eights]], whole + np.flatnonzero(flat[whole:])])
    return np.divmod(found, marks.shape[1])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def _least_logit(score: np.ndarray) -> np.ndarray:
    """Logits below it have a smaller probability than `score`."""
    p = score - _ERROR
    inside = np.where((p > 0) & (p < 1), p, 0.5)
    return np.where(p <= 0, -np.inf, np.where(p >= 1, np.inf, np.log(inside) - np.log1p(-inside)))


@dataclass
class _Surrogate:
    """A matrix that orders a tile's scores: a score is const + scale * matrix (of a logistic label its logit), up to `error`."""

    matrix: np.ndarray
    const: np.ndarray
    scale: np.ndarray
    error: np.ndarray
    logistic: bool
    exact: Callable

    def score(self, entries: np.ndarray) -> np.ndarray:
        none = np.isneginf(entries)
        z = np.where(none, -np.inf, self.const + self.scale * np.where(none, 0.0, entries))
        return _logistic(z) if self.logistic else z

    def floor(self, score: np.ndarray) -> np.ndarray:
        """Entries below it have smaller scores."""
        z = (_least_logit(score) if self.logistic else score) - self.const - self.error
        flat = self.scale == 0
        return np.where(flat, np.where(z <= 0, -np.inf, np.inf), z / np.where(flat, 1.0, self.scale))


class _Affine:
    """Scores of a block's users as weighted sums of the base scores, from `linear` at the ends lo and hi of these."""

    def __init__(self, linear: Callable, names: list[str], lo: np.ndarray | None, hi: np.ndarray | None, n: int, logistic):
        self.names, self.logistic = names, logistic
        self.scaled = lo is not None
        ends = (lo, hi) if self.scaled else (np.zeros((n, len(names))), np.ones((n, len(names))))
        low, high = ({b: x[:, j] for j, b in enumerate(names)} for x in ends)
        given = (low, high) if self.scaled else ({}, {})
        # a user without an item has infinite ends and no pair
        with np.errstate(invalid="ignore"):
            start = linear(low, *given)
            self.weights = {label: {} for label in start}
            for b in names:
                width = high[b] - low[b]
                for label, z in linear({**low, b: high[b]}, *given).items():
                    w = np.where(width > 0, (z - start[label]) / np.where(width > 0, width, 1.0), 0.0)
                    if np.any(w != 0):
                        self.weights[label][b] = w
            self.const = {label: z + np.zeros(n) - sum((w * low[b] for b, w in self.weights[label].items()), np.zeros(n)) for label, z in start.items()}
        self.size = {b: np.maximum(np.abs(low[b]), np.abs(high[b])) for b in names}
        self.scratch = _Scratch()

    def surrogate(self, label: str, tile: np.ndarray, raw: dict, size: dict, exact: Callable) -> _Surrogate:
        weights = {b: w[tile] for b, w in self.weights[label].items()}
        const = self.const[label][tile]
        most = np.abs(const)
        for b, w in weights.items():
            most = most + np.abs(w) * (self.size[b][tile] if self.scaled else size[b])
        error = _ERROR * most
        if len(weights) == 1:
            (b, w), = weights.items()
            if (w >= 0).all():
                return _Surrogate(raw[b], const, w, error, label in self.logistic, exact)
        shape = raw[self.names[0]].shape
        matrix = self.scratch.matrix("sum", shape)
        for j, (b, w) in enumerate(weights.items()):
            part = np.multiply(raw[b], w[:, None], out=self.scratch.matrix("part", shape) if j else matrix)
            if j:
                matrix += part
        if not weights:
            matrix[:] = 0.0
        return _Surrogate(matrix, const, np.ones(len(tile)), error, label in self.logistic, exact)


class _Top:
    """Running best `k` (rounded score, then item key) of a block's users."""

    def __init__(self, n: int, k: int):
        self.k, self.scratch = k, _Scratch()
        self.keys, self.scores = np.full((n, k), -np.inf), np.zeros((n, k))
        self.items = np.full((n, k), _NO_ITEM)
        self.least, self.most = np.full(n, np.inf), np.full(n, -np.inf)

    def floor(self, first: int, users=slice(None)) -> np.ndarray:
        """No score below it changes the user's best, of items from the key `first` on."""
        kth = self.keys[users, -1]
        # later keys lose ties
        return np.where(first > self.items[users, -1], _above(kth), _below(kth))

    def add(self, tile: np.ndarray, score: np.ndarray, barred: tuple, keys: np.ndarray, ends: bool = True) -> None:
        if ends:
            score = _extremes(self.least, self.most, tile, score, barred)
        one = np.ones(len(tile))
        self.add_pairs(tile, _Surrogate(score, 0.0 * one, one, 0.0 * one, False, lambda row, at: score[row, at]), barred, keys)

    def add_ends(self, tile: np.ndarray, by: _Surrogate, barred: tuple) -> None:
        """Move the user's ends of the score outwards by the pairs with the least and the largest entries."""
        matrix, row = self.scratch.matrix("ends", by.matrix.shape), np.arange(len(tile))
        matrix[:] = by.matrix
        for end, move, none, reach in ((self.least, np.fmin, np.inf, np.argmin), (self.most, np.fmax, -np.inf, np.argmax)):
            matrix[barred] = none
            at = reach(matrix, axis=1)
            some = matrix[row, at] != none
            users = tile[some]
            end[users] = move(end[users], by.exact(row[some], at[some]))

    def add_pairs(self, tile: np.ndarray, by: _Surrogate, barred: tuple, keys: np.ndarray) -> None:
        """Take the pairs of a tile that belong to the best; only those whose entries reach the floor are scored."""
        kth = self.keys[tile, -1]
        floor = self.floor(keys[0], tile)
        if by.matrix.shape[1] > 2 * self.k and np.isneginf(kth).any():
            # the chunk's own k-th score, as long as a user has no k items
            allowed = by.matrix.copy()
            allowed[barred] = -np.inf
            floor = np.maximum(floor, _below(by.score(np.partition(allowed, -self.k, axis=1)[:, -self.k])))
        reached = np.greater_equal(by.matrix, by.floor(floor)[:, None], out=self.scratch.matrix("reached", by.matrix.shape, bool))
        reached[barred] = False
        row, at = _places(reached)
        if len(row):
            self._take(tile, row, by.exact(row, at), keys[at])

    def add_screened(self, tile: np.ndarray, base: Base, users: _Rows, allowed: _Allowed, raw: Callable, items: _Rows) -> None:
        """Take the pairs of a tile that belong to the best by a single dot: those that can by the product in single precision are scored in double."""
        keys, none = items.key, np.isneginf(self.keys[tile, -1])
        if none.any():
            # a user without k items has no floor yet
            self.add(tile[none], raw(tile[none]), allowed.barred(tile[none], keys), keys, False)
            tile = tile[~none]
        if not len(tile):
            return
        found = _screened(base, users, tile, items, self.scratch)
        if found is not None:
            matrix, error = found
            with np.errstate(over="ignore"):
                floor = np.nextafter((self.floor(keys[0], tile) - error).astype(np.float32), np.float32(-np.inf))
            reached = np.greater_equal(matrix, floor[:, None], out=self.scratch.matrix("reached", matrix.shape, bool))
            row, at = _places(reached)
            if len(row) <= _MANY * matrix.size:
                open_ = ~allowed.refused(tile[row], keys[at])
                row, at = row[open_], at[open_]
                if len(row):
                    u, v = (x.vectors[base.name][0] for x in (users, items))
                    self._take(tile, row, np.einsum("ij,ij->i", u[tile[row]], v[at]), keys[at])
                return
        self.add(tile, raw(tile), allowed.barred(tile, keys), keys, False)

    def _take(self, tile: np.ndarray, row: np.ndarray, value: np.ndarray, item: np.ndarray) -> None:
        """Merge pairs (row of the tile in rising order, score, item in rising order) into the best."""
        kth, key = self.keys[tile, -1], np.round(value, TIE_DIGITS)
        ok = (value > -np.inf) & ((key > kth[row]) | ((key == kth[row]) & (item < self.items[tile[row], -1])))
        row, value, item, key = row[ok], value[ok], item[ok], key[ok]
        if not len(row):
            return
        rows, first, count = np.unique(row, return_index=True, return_counts=True)
        place = np.repeat(np.arange(len(rows)), count), np.arange(len(row)) - np.repeat(first, count)
        shape = len(rows), int(count.max())
        new = np.full(shape, -np.inf), np.zeros(shape), np.full(shape, _NO_ITEM)
        for x, y in zip(new, (key, value, item), strict=True):
            x[place] = y
        if shape[1] > 2 * self.k:
            n = shape[1]
            cut = np.partition(new[0], n - self.k, axis=1)[:, n - self.k, None]
            above, equal = new[0] > cut, new[0] == cut
            # a chunk is in key order, so the first of equal scores are the right ones
            chosen = above | (equal & (np.cumsum(equal, axis=1) <= self.k - above.sum(axis=1, keepdims=True)))
            col = np.nonzero(chosen)[1].reshape(len(rows), self.k)
            new = tuple(np.take_along_axis(x, col, 1) for x in new)
        here = tile[rows]
        keys, scores, ids = (np.concatenate([x[here], y], axis=1) for x, y in zip((self.keys, self.scores, self.items), new, strict=True))
        order = np.lexsort((ids, -keys), axis=1)[:, : self.k]
        self.keys[here], self.scores[here], self.items[here] = (np.take_along_axis(x, order, 1) for x in (keys, scores, ids))


def _dealt(users: DataFrame, items: DataFrame, bases: list[Base], order: Base | None, k: int, run: Callable = iter, schema: str | None = None) -> DataFrame:
    """`run` over the rows of both sides (the rows themselves without it): a task gets a block of users, then all items that can matter to it, by falling reach of `order`."""
    n = users.count()
    cores = users.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, min(cores, -(-n // TILE_USERS)))
    if n > blocks * BLOCK_USERS:
        blocks *= -(-n // (blocks * BLOCK_USERS))
    columns = [c for b in bases for c, _ in b.columns]
    block = (F.col("u") % blocks).cast("int")
    pos = F.lit(0.0)
    if order is not None:
        squares = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, z: a + z * z))
        pos = squares(F.col(order.name))
        if order.biased:
            typical = users.select(F.avg(squares(F.slice(order.name, 1, F.greatest(F.size(order.name) - 2, F.lit(0)))))).first()[0] or 0.0
            pos = F.element_at(order.name, -1) + F.lit(typical) * squares(F.slice(order.name, 1, F.greatest(F.size(order.name) - 2, F.lit(0))))
        pos = -F.coalesce(pos, F.lit(0.0))
    one = users.select(block.alias("block"), F.lit(False).alias("is_item"), F.lit(0.0).alias("pos"), F.col("u").alias("key"), *columns, "seen", "lo", "hi")
    sizes = items.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*columns))).first()
    place = F.lit(0)
    if n and 2 * sizes[1] < sizes[0]:
        # classes of equal vectors: their first items by key are enough
        longest = users.agg(F.max(F.coalesce(F.size("seen"), F.lit(0)))).first()[0]
        w = Window.partitionBy(*columns).orderBy("i")
        items = items.select("i", *columns).withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= k + longest)
        place = F.col("_place")
    listed = items.select(pos.alias("pos"), F.col("i").cast("long").alias("key"), *columns, place.alias("place"))
    files = sorted(written(listed.sort("pos", "key"), "items-in-order").inputFiles())

    def task(batches):
        return run(_and_items(batches, files, k))

    return one.repartitionById(blocks, "block").sortWithinPartitions("key").mapInArrow(task, schema or StructType([StructField(x.name, x.dataType) for x in one.schema]))


def _and_items(batches, files: list[str], k: int):
    """The batches of a block's users, then the items from the written table, of a class no more than the block can need."""
    head, need = None, 0
    for batch in batches:
        if batch.num_rows:
            head = batch
            need = max(need, k + (pc.max(pc.list_value_length(batch.column("seen"))).as_py() or 0))
            yield batch
    if head is None:
        return
    block, schema, waiting, n = head.column("block")[0].as_py(), head.schema, [], 0
    for name in files:
        fs, path = pafs.FileSystem.from_uri(name)
        with fs.open_input_file(path) as f:
            for batch in pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(batch_size=8 * TILE_ITEMS):
                rows = batch.filter(pc.less_equal(batch.column("place"), need))
                given = {"block": pa.repeat(pa.scalar(block, pa.int32()), len(rows)), "is_item": pa.repeat(True, len(rows))}
                got = [rows.column(x.name) if x.name in rows.schema.names else given.get(x.name, None) for x in schema]
                table = pa.Table.from_arrays([pa.nulls(len(rows), x.type) if c is None else c.cast(x.type) for x, c in zip(schema, got, strict=True)], schema=schema)
                waiting.append(table)
                n += len(rows)
                if n >= TILE_ITEMS:
                    yield from pa.concat_tables(waiting).combine_chunks().to_batches()
                    waiting, n = [], 0
    if n:
        yield from pa.concat_tables(waiting).combine_chunks().to_batches()


def _with_seen(users: DataFrame, seen: DataFrame | None) -> DataFrame:
    """`users` with the keys of the items that they have seen; the list is no longer than the catalogue."""
    none = F.lit(None).cast("array<double>")
    users = users.withColumns({"lo": none, "hi": none})
    if seen is None:
        return users.withColumn("seen", F.array().cast("array<int>"))
    lists = seen.groupBy("u").agg(F.collect_set(F.col("i").cast("int")).alias("seen"))
    return users.join(lists, "u", "left")


def spread(users: DataFrame, items: DataFrame, bases: list[Base], seen: DataFrame | None = None, cap: int | None = None) -> DataFrame:
    """(u, lo, hi): smallest and largest raw score of each base over the items that a user may get."""
    return _spread(written(_with_seen(users, seen), "seen"), items, bases, cap)


def _spread(users: DataFrame, items: DataFrame, bases: list[Base], cap: int | None) -> DataFrame:

    def run(batches):
        lo = hi = users = None
        for found, tile, barred, raw, _ in _tiles(batches, bases, cap):
            if raw is None:
                users = found
                lo, hi = np.full((len(bases), len(users)), np.inf), np.full((len(bases), len(users)), -np.inf)
                continue
            for k, b in enumerate(bases):
                _extremes(lo[k], hi[k], tile, raw[b.name], barred)
        if users is not None:
            yield pa.RecordBatch.from_arrays([pa.array(users.key), pa.array(list(lo.T), pa.list_(pa.float64())), pa.array(list(hi.T), pa.list_(pa.float64()))], ["u", "lo", "hi"])

    return _dealt(users, items, bases, None, 1, run, "u long, lo array<double>, hi array<double>")


def top_items(users: DataFrame, items: DataFrame, bases: list[Base], k: int, combine: Callable | None = None, seen: DataFrame | None = None,
              cap: int | None = None, scaled: bool = False, extremes: DataFrame | None = None, linear: Callable | None = None,
              logistic: tuple = (), ends: tuple | None = None) -> DataFrame:
    """(u, label, i, rank, score, least, most): the best `k` items of each user and label, over all items that the user may get.

    `users` holds u (0, 1, ...), `items` i, and both the bases' columns; `seen`
    (u, i) is left out.  `combine(raw, lo, hi)` turns the raw matrices (by name)
    and, with `scaled`, the users' extremes into one matrix per label, entry by entry; without it the
    labels are the bases.  least and most are the user's extremes of the label, for the labels `ends` (all without it; none for a single dot base, of which not all pairs are scored).
    Scores are ranked to 9 digits, equal ones by i.  A single dot base in falling
    order of norms skips the items that cannot reach a user's k-th score.
    `extremes` is a written result of `spread`, if the caller has one.

    `linear`, if given, is as `combine`, but affine in the raw scores of a user; `combine` gives the same, of the labels
    `logistic` the logistic function of it.  It then finds the pairs that can be among the best, and `combine` scores those only.
    """
    plain = combine is None and len(bases) == 1 and bases[0].kind == "dot"
    users = written(_with_seen(users, seen), "seen")
    if scaled:
        if extremes is None:
            extremes = written(_spread(users, items, bases, cap), "spread")
        users = users.drop("lo", "hi").join(extremes, "u", "left")
    names = [b.name for b in bases]

    def wanted(label):
        return not plain if ends is None else label in ends

    def run(batches):
        tops: dict[str, _Top] = {}
        block = lo = hi = affine = None

        def hopeless(users, items):
            """Users whose k-th score no item of the chunk reaches."""
            if not tops:
                return np.zeros(len(users), bool)
            if not hasattr(users, "ends"):
                users.ends = users.reach(bases[0], False)
            (norm, own), (longest, most) = users.ends, (x.max() for x in items.reach(bases[0], True))
            reach = norm * longest + own + most
            reach = reach + _ERROR * (norm * longest + np.abs(own) + abs(most))
            # an item without a vector scores zero
            return np.maximum(reach, 0.0 if bases[0].biased else -np.inf) < tops[names[0]].floor(items.key[0])

        for found, tile, barred, raw, chunk in _tiles(batches, bases, cap, hopeless if plain else None):
            if raw is None:
                block = found
                if scaled:
                    lo, hi = (np.array(tile.column(c).to_pylist(), float).reshape(len(block), -1) for c in ("lo", "hi"))
                if linear is not None:
                    affine = _Affine(linear, names, lo, hi, len(block), logistic)
                continue
            if affine is not None:
                size = {} if scaled else {b: max(x.max(), -x.min()) for b, x in raw.items()}
                for label in affine.weights:
                    if label not in tops:
                        tops[label] = _Top(len(block), k)

                    def exact(row, at, label=label):
                        given = [{n: x[tile[row], j] for j, n in enumerate(names)} for x in (lo, hi)] if scaled else [{}, {}]
                        return combine({n: x[row, at] for n, x in raw.items()}, *given)[label]

                    by = affine.surrogate(label, tile, raw, size, exact)
                    if wanted(label):
                        tops[label].add_ends(tile, by, barred)
                    tops[label].add_pairs(tile, by, barred, chunk.key)
                continue
            if plain:
                if names[0] not in tops:
                    tops[names[0]] = _Top(len(block), k)
                if not wanted(names[0]):
                    tops[names[0]].add_screened(tile, bases[0], block, barred, raw, chunk)
                    continue
                barred, raw = barred.barred(tile, chunk.key), {names[0]: raw(tile)}
            scores = raw
            if combine is not None:
                given = [{n: x[tile, j, None] for j, n in enumerate(names)} for x in (lo, hi)] if scaled else [{}, {}]
                scores = combine(raw, *given)
            for label, score in scores.items():
                if label not in tops:
                    tops[label] = _Top(len(block), k)
                tops[label].add(tile, score, barred, chunk.key, wanted(label))
        for label, top in tops.items():
            for a in range(0, len(block), _OUT_USERS):
                row, place = np.nonzero(top.keys[a: a + _OUT_USERS] > -np.inf)
                row += a
                outer = [pa.array(x[row]) if wanted(label) else pa.nulls(len(row), pa.float64()) for x in (top.least, top.most)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.key[row]), pa.array([label] * len(row), pa.string()), pa.array(top.items[row, place]), pa.array((place + 1).astype(np.int32)),
                     pa.array(top.scores[row, place]), *outer], ["u", "label", "i", "rank", "score", "least", "most"])

    return _dealt(users, items, bases, bases[0] if plain else None, k, run, "u long, label string, i long, rank int, score double, least double, most double")
