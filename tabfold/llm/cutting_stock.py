"""Cutting-stock column generation over a histogram of lengths.

All numbers are in units of a few tokens.  A pattern says how many pieces of
each length class go into one sequence and how many units of filler (parts of
cut documents) it takes.  The linear program minimises the number of sequences
plus a price for every document that is cut to make filler:

    sum over patterns of a[l] * x + y[l] = count[l]        for each class l
    sum over patterns of f * x - sum over l of l * y[l] = 0   (filler made = used)

New patterns come from a knapsack dynamic program over the dual prices.  The
size of the program depends on the number of classes only, never on how many
documents there are.

Defined cases: classes without documents take no part; no documents give an
empty plan; a class as long as a sequence has patterns of its own; a plan that
is not optimal yet (``GAP``, ``MAX_PIVOTS``) still places every document.
"""

from __future__ import annotations

import numpy as np

CUT_PRICE = 0.05        # sequences that a cut document counts for
GAP = 0.0005            # stop within this share of the optimum
MAX_PIVOTS = 6000       # pivots at most; the program is feasible after each one
KEEP_FILL = 0.98        # a sequence made of left-over documents is kept if it is this full


def price_pattern(worth: np.ndarray) -> tuple[float, dict[int, int]]:
    """The most valuable pattern, by unbounded knapsack: ``worth[u]`` is that of a piece of u units, -inf if there is none."""
    capacity = len(worth) - 1
    back = np.zeros(capacity + 1)           # back[capacity - c]: the best worth of c units
    pick = [0] * (capacity + 1)
    for c in range(1, capacity + 1):
        got = back[capacity - c + 1:] + worth[1:c + 1]      # a last piece of 1, 2, ... c units
        u = int(got.argmax())
        before = back[capacity - c + 1]
        if got[u] > before + 1e-12:
            back[capacity - c], pick[c] = got[u], u + 1
        else:
            back[capacity - c] = before
    items: dict[int, int] = {}
    c = capacity
    while c > 0:
        if u := pick[c]:
            items[u] = items.get(u, 0) + 1
        c -= u or 1
    return float(back[0]), items


def solve(units: list[int], counts: list[int], capacity: int) -> tuple[list[tuple[float, dict[int, int], int]], dict[int, float]]:
    """(copies, {class: pieces}, filler units) of the patterns used, and the cut documents of each class."""
    size, need = np.array(units), np.array(counts, float)
    m = len(size)
    place = {u: l for l, u in enumerate(units)}
    columns: list[tuple] = [("pattern", {l: int(capacity // size[l])}, 0) for l in range(m)] + [("pattern", {}, capacity)]
    basis = list(range(m + 1))
    cost = np.ones(m + 1)
    inverse = np.diag([1.0 / (capacity // u) for u in size] + [1.0 / capacity])
    x = np.concatenate([need / (capacity // size), [0.0]])

    def entries(kind, items, fill) -> np.ndarray:
        a = np.zeros(m + 1)
        for l, k in items.items():
            a[l] = k
        a[m] = fill
        return a

    least_sequences = float(size @ need) / capacity        # no plan needs fewer
    for step in range(MAX_PIVOTS):
        if cost @ x <= least_sequences * (1 + GAP):
            break
        prices = cost @ inverse
        filler = prices[m]
        worth = np.full(capacity + 1, -np.inf)
        worth[size] = np.maximum(prices[:m], 0.0)
        filling = filler > max(worth[1], 0.0)                  # a unit of filler is a piece, too
        worth[1] = filler if filling else worth[1]
        value, items = price_pattern(worth)
        gain_cut = prices[:m] - size * filler - CUT_PRICE
        l = int(gain_cut.argmax())
        if value - 1 <= GAP and gain_cut[l] <= GAP * CUT_PRICE:
            break
        if value - 1 >= gain_cut[l]:
            fill = items.pop(1, 0) if filling else 0
            new = ("pattern", {place[u]: k for u, k in items.items()}, fill)
            price = 1.0
        else:
            new, price = ("cut", {l: 1}, -int(size[l])), CUT_PRICE
        a = inverse @ entries(*new)
        ratio = np.where(a > 1e-9, x / np.where(a > 1e-9, a, 1), np.inf)
        least = ratio.min()
        if not np.isfinite(least):
            break
        r = int(np.argmax(np.where(ratio <= least + 1e-12, a, -np.inf)))
        x -= least * a
        x[r] = least
        x[x < 0] = 0
        row = inverse[r] / a[r]
        inverse -= np.outer(a, row)
        inverse[r] = row
        columns.append(new)
        basis[r], cost[r] = len(columns) - 1, price
        if step % 300 == 299:                                 # wash out rounding errors
            matrix = np.array([entries(*columns[b]) for b in basis]).T
            inverse = np.linalg.inv(matrix)
            x = np.maximum(inverse @ np.concatenate([need, [0.0]]), 0)
    used, cut = [], {}
    for b, v in zip(basis, x):
        kind, items, fill = columns[b]
        if v > 1e-9 and kind == "cut":
            cut[next(iter(items))] = cut.get(next(iter(items)), 0.0) + float(v)
        elif v > 1e-9 and items:
            used.append((float(v), items, fill))
    return used, cut


def round_down(units: list[int], counts: list[int], capacity: int, used: list, cut: dict) -> tuple[list[tuple[int, dict[int, int], int]], dict[int, int]]:
    """Whole copies of patterns, and how many documents of each class are cut into filler.

    Fractions are rounded down, then patterns are taken once more, largest
    fraction first, while their pieces last.  What is left over is less than
    one sequence a pattern; full sequences of it are packed largest first, and
    the rest is cut.
    """
    left = list(counts)
    plan: list[tuple[int, dict[int, int], int]] = []

    def take(copies: int, items: dict[int, int], fill: int) -> None:
        plan.append((copies, items, fill))
        for l, k in items.items():
            left[l] -= copies * k

    for v, items, fill in used:
        copies = min([int(v + 1e-6), *(left[l] // k for l, k in items.items())])
        if copies:
            take(copies, items, fill)
    shred = {}
    for l, v in cut.items():
        if k := min(left[l], int(v + 1e-6)):
            shred[l] = k
            left[l] -= k
    for v, items, fill in sorted(used, key=lambda p: int(p[0] + 1e-6) - p[0]):
        full = sum(units[l] * k for l, k in items.items()) >= KEEP_FILL * capacity
        if full and all(left[l] >= k for l, k in items.items()):
            take(1, items, fill)
    while any(left):
        room, items = capacity, {}
        for l in sorted((l for l in range(len(units)) if left[l]), key=lambda l: -units[l]):
            if k := min(left[l], room // units[l]):
                items[l] = k
                room -= k * units[l]
        if capacity - room < KEEP_FILL * capacity:
            break
        take(1, items, room)
    for l, k in enumerate(left):
        if k:
            shred[l] = shred.get(l, 0) + k
    return plan, shred


def cutting_plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, dict[int, int], int]], dict[int, int]]:
    """``histogram``: class (length in units, 1 to capacity - 1) -> documents.

    Returns patterns (copies, {class: pieces}, filler units) and the number of
    documents of each class that are cut.
    """
    units = sorted(histogram)
    counts = [histogram[u] for u in units]
    if not units:
        return [], {}
    plan, shred = round_down(units, counts, capacity, *solve(units, counts, capacity))
    return ([(n, {units[l]: k for l, k in items.items()}, fill) for n, items, fill in plan],
            {units[l]: k for l, k in shred.items()})
