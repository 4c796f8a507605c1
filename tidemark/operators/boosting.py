"""Fit-and-score of short series with gradient-boosted regression trees.

The per-task helper of the job in ``forecast.py``: squared loss, histogram splits, best-first growth, a learned side
for missing values. A series is daily rows, so bounded by the calendar. A fit of some thirty rows is nearly all calls,
so ``boosted_cells`` grows the trees of many short series level by level in common arrays. As long as no tree can have
more leaves than allowed, the order of growth does not matter; sums are taken in the same order as for one series, so
the predictions are the same to the last bit.
"""

from __future__ import annotations

import heapq

import numpy as np

MAX_BINS = 255
MAX_LEAVES = 31


def _bin_columns(train: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin numbers of every row by cut points from the training rows; the last bin holds NaN."""
    seen_nan = np.isnan(train).any(axis=0)
    cuts = []
    for j in range(every.shape[1]):
        values = np.unique(train[~np.isnan(train[:, j]), j])
        if len(values) > MAX_BINS:
            values = np.unique(np.percentile(values, np.linspace(0, 100, MAX_BINS), method="midpoint"))
        cuts.append((values[:-1] + values[1:]) / 2)
    missing = max(len(c) for c in cuts) + 1
    bins = np.full(every.shape, missing, dtype=np.int64)
    for j, c in enumerate(cuts):
        present = ~np.isnan(every[:, j])
        bins[present, j] = np.searchsorted(c, every[present, j], side="left")
    return bins, seen_nan, missing


def _best_split(bins: np.ndarray, missing: int, residual: np.ndarray, seen_nan: np.ndarray, min_leaf: int):
    """(gain, feature, bin, missing goes left) of the best split of one node, or None."""
    n, n_features = bins.shape
    if n < 2 * min_leaf:
        return None
    width = missing + 1
    flat = (bins + np.arange(n_features) * width).ravel()
    shape = (n_features, width)
    counts = np.bincount(flat, minlength=n_features * width).reshape(shape)
    sums = np.bincount(flat, weights=np.repeat(residual, n_features), minlength=n_features * width).reshape(shape)
    total = residual.sum()
    best = None
    for missing_left in (False, True):
        left_n = np.cumsum(counts[:, :-1], axis=1)
        left_sum = np.cumsum(sums[:, :-1], axis=1)
        if missing_left:
            if not seen_nan.any():
                break
            left_n = left_n + counts[:, -1:]
            left_sum = left_sum + sums[:, -1:]
        right_n = n - left_n
        allowed = (left_n >= min_leaf) & (right_n >= min_leaf)
        if missing_left:
            allowed &= seen_nan[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_sum**2 / left_n + (total - left_sum) ** 2 / right_n - total**2 / n
        gain = np.where(allowed, gain, -np.inf)
        at = int(np.argmax(gain))
        feature, cut = divmod(at, gain.shape[1])
        if gain[feature, cut] > (best[0] if best else 1e-9):
            go_left = missing_left if seen_nan[feature] else left_n[feature, cut] > right_n[feature, cut]
            best = (float(gain[feature, cut]), feature, cut, bool(go_left))
    return best


def boosted_predictions(
    features: np.ndarray,
    target: np.ndarray,
    is_train: np.ndarray,
    learning_rate: float,
    min_samples_leaf: int,
    max_depth: int | None,
    max_iter: int,
) -> np.ndarray:
    """Predictions for every row of a model fitted on the training rows.

    Rows to score walk down with the training rows, so no tree is kept.
    """
    bins, seen_nan, missing = _bin_columns(features[is_train], features)
    y = np.where(is_train, target, 0.0)
    prediction = np.full(len(y), y[is_train].mean())
    every = np.arange(len(y))
    for _ in range(max_iter):
        residual = y - prediction
        update = np.zeros(len(y))
        heap: list[tuple] = []
        leaves = 1
        order = 0

        def settle(rows: np.ndarray, depth: int) -> None:
            """Queue a node by its gain, or write its value when it cannot be split."""
            nonlocal order
            train = rows[is_train[rows]]
            split = None
            if max_depth is None or depth < max_depth:
                split = _best_split(bins[train], missing, residual[train], seen_nan, min_samples_leaf)
            if split is None:
                update[rows] = residual[train].mean()
            else:
                heapq.heappush(heap, (-split[0], order, rows, depth, split))
                order += 1

        settle(every, 0)
        while heap:
            _, _, rows, depth, (_, feature, cut, missing_left) = heapq.heappop(heap)
            if leaves >= MAX_LEAVES:
                update[rows] = residual[rows[is_train[rows]]].mean()
                continue
            b = bins[rows, feature]
            left = np.where(b == missing, missing_left, b <= cut)
            leaves += 1
            settle(rows[left], depth + 1)
            settle(rows[~left], depth + 1)
        if not update.any():
            break
        prediction = prediction + learning_rate * update
    return prediction


#: Series that grow their trees together.
TOGETHER = 128


def boosted_cells(features: np.ndarray, target: np.ndarray, is_train: np.ndarray, begin: np.ndarray, configs: list[tuple]) -> np.ndarray:
    """``boosted_predictions`` of several cells: cell i is the rows from ``begin[i]`` on, with ``configs[i]``.

    A config is (min_samples_leaf, learning_rate, max_depth, max_iter). Fewer than three training rows give NaN.
    """
    prediction = np.full(len(target), np.nan)
    end = np.append(begin[1:], len(target))
    learned = np.add.reduceat(is_train, begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
    odd = np.maximum.reduceat(np.isinf(features).any(axis=1), begin) if len(begin) else np.zeros(0, bool)
    short = []
    for i in np.flatnonzero(learned >= 3).tolist():
        leaf, rate, depth, rounds = configs[i]
        if learned[i] <= MAX_LEAVES * leaf and learned[i] <= MAX_BINS and not odd[i]:
            short.append(i)
        else:
            rows = slice(begin[i], end[i])
            prediction[rows] = boosted_predictions(features[rows], target[rows], is_train[rows], rate, leaf, depth, rounds)
    short = np.array(short, np.int64)
    short = short[np.argsort(learned[short], kind="stable")]  # alike in size, so that no histogram is mostly empty
    for at in range(0, len(short), TOGETHER):
        some = short[at : at + TOGETHER]
        size = end[some] - begin[some]
        rows = np.repeat(begin[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
        prediction[rows] = _grown_together(
            features[rows], target[rows], is_train[rows], np.repeat(np.arange(len(some)), size), [configs[i] for i in some.tolist()]
        )
    return prediction


def _sums(values: np.ndarray, group: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of each group's values as ``sum`` adds them; a zero in front makes ``reduceat`` begin as it does."""
    padded = np.zeros(len(values) + len(size))
    order = np.argsort(group, kind="stable")
    padded[np.arange(len(values)) + group[order] + 1] = values[order]
    return np.add.reduceat(padded, np.cumsum(size + 1) - size - 1)


def _bin_cells(features: np.ndarray, is_train: np.ndarray, cell: np.ndarray, n_cells: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``_bin_columns`` of every cell; the bin of missing values is the same in all of them."""
    n, width = features.shape
    column = (cell[:, None] * width + np.arange(width)).ravel()
    value = features.ravel()
    present = ~np.isnan(value)
    known = present & np.repeat(is_train, width)
    seen_nan = np.bincount(column, np.repeat(is_train, width) & ~present, n_cells * width).reshape(n_cells, width) > 0
    order = np.lexsort((value[known], column[known]))
    of, v = column[known][order], value[known][order]
    step = (of[1:] == of[:-1]) & (v[1:] != v[:-1])
    cuts, cut_of = ((v[:-1] + v[1:]) / 2)[step], of[1:][step]
    # a value's bin is the number of its column's cuts below it; at equal values the cut sorts last
    every = np.concatenate([value[present], cuts])
    owner = np.concatenate([column[present], cut_of])
    is_cut = np.concatenate([np.zeros(present.sum(), bool), np.ones(len(cuts), bool)])
    order = np.lexsort((is_cut, every, owner))
    below = np.empty(len(every), np.int64)
    below[order] = np.cumsum(is_cut[order])
    of_column = np.bincount(cut_of, minlength=n_cells * width)
    earlier = np.cumsum(of_column) - of_column
    missing = int(of_column.max()) + 1
    bins = np.full(n * width, missing, np.int64)
    bins[present] = below[: present.sum()] - earlier[column[present]]
    return bins.reshape(n, width), seen_nan, missing


def _grown_together(features: np.ndarray, target: np.ndarray, is_train: np.ndarray, cell: np.ndarray, configs: list[tuple]) -> np.ndarray:
    n_cells, n_features = len(configs), features.shape[1]
    min_leaf = np.array([c[0] for c in configs])
    rate = np.array([c[1] for c in configs])[cell]
    max_depth = np.array([np.iinfo(np.int64).max if c[2] is None else c[2] for c in configs])
    max_iter = np.array([c[3] for c in configs])
    bins, seen_nan, missing = _bin_cells(features, is_train, cell, n_cells)
    width = missing + 1
    flat = bins + np.arange(n_features) * width
    y = np.where(is_train, target, 0.0)
    size = np.bincount(cell[is_train], minlength=n_cells)
    prediction = (_sums(y[is_train], cell[is_train], size) / size)[cell]
    busy = np.ones(n_cells, bool)
    for turn in range(int(max_iter.max())):
        busy &= max_iter > turn
        rows = np.flatnonzero(busy[cell])
        if not len(rows):
            break
        residual = y - prediction
        update = np.zeros(len(y))
        of = np.flatnonzero(busy)  # the cell of every open node
        node = (np.cumsum(busy) - 1)[cell[rows]]
        depth = 0
        while len(rows):
            m = len(of)
            learns = is_train[rows]
            train, at = rows[learns], node[learns]
            n = np.bincount(at, minlength=m)
            total = _sums(residual[train], at, n)
            gain, feature, cut, go_left = _best_splits(flat[train], at, residual[train], n, total, seen_nan[of], min_leaf[of], n_features, width)
            splits = (gain > 1e-9) & (depth < max_depth[of])
            done = ~splits[node]
            update[rows[done]] = (total / n)[node[done]]
            rows, node = rows[~done], node[~done]
            b = bins[rows, feature[node]]
            left = np.where(b == missing, go_left[node], b <= cut[node])
            child = 2 * (np.cumsum(splits) - 1)[node] + ~left
            of, node = np.repeat(of[splits], 2), child
            depth += 1
        busy &= np.bincount(cell, update != 0, n_cells) > 0
        prediction = np.where(busy[cell], prediction + rate * update, prediction)
    return prediction


def _best_splits(flat, node, residual, n, total, seen_nan, min_leaf, n_features, width):
    """``_best_split`` of every node: gain (-inf without any), feature, bin and whether missing values go left."""
    m = len(n)
    where = (flat + (node * (n_features * width))[:, None]).ravel()
    shape = (m, n_features, width)
    counts = np.bincount(where, minlength=m * n_features * width).reshape(shape)
    sums = np.bincount(where, weights=np.repeat(residual, n_features), minlength=m * n_features * width).reshape(shape)
    every = np.arange(m)
    square = np.array([t**2 for t in total.tolist()]) / n
    left_n, left_sum = np.cumsum(counts[:, :, :-1], axis=2, dtype=float), np.cumsum(sums[:, :, :-1], axis=2)

    def best(left_n, left_sum, of, also):
        right_n = n[of, None, None] - left_n
        least = min_leaf[of, None, None]
        refused = (left_n < least) | (right_n < least)
        if also is not None:
            refused |= ~also[:, :, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.square(left_sum)
            gain /= left_n
            right = total[of, None, None] - left_sum
            right *= right
            right /= right_n
            gain += right
            gain -= square[of, None, None]
        gain[refused] = -np.inf
        gain = gain.reshape(len(of), -1)
        at = gain.argmax(axis=1)
        feature, cut = np.divmod(at, width - 1)
        some = np.arange(len(of))
        more = left_n[some, feature, cut] > right_n[some, feature, cut]
        return gain[some, at], feature, cut, more

    gain, feature, cut, more = best(left_n, left_sum, every, None)
    gain = np.where(gain > 1e-9, gain, -np.inf)
    go_left = np.where(seen_nan[every, feature], False, more)
    some, those = np.flatnonzero(seen_nan.any(axis=1)), np.flatnonzero(seen_nan.any(axis=0))
    if len(some):
        part = np.ix_(some, those)
        other, f, c, _ = best(left_n[part] + counts[part][:, :, -1:], left_sum[part] + sums[part][:, :, -1:], some, seen_nan[part])
        better = other > np.maximum(gain[some], 1e-9)
        some = some[better]
        gain[some], feature[some], cut[some], go_left[some] = other[better], those[f[better]], c[better], True
    return gain, feature, cut, go_left
