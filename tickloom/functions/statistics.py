"""p-values from a test statistic and two row counts: plain numbers, no data."""

import numpy as np

# Above this many rows on either side the asymptotic distribution is used.
EXACT_ROWS = 10_000


def ks_p_value(d: float, n: int, m: int, exact_rows: int = EXACT_ROWS) -> float:
    """Two-sided two-sample Kolmogorov-Smirnov p-value."""
    if n == 0 or m == 0:
        return float("nan")
    if max(n, m) <= exact_rows:
        return _ks_exact(d, n, m)
    size = n * m / (n + m)
    x = np.sqrt(size) * d
    if x < 0.2:
        return 1.0
    k = np.arange(1, 101)
    return float(min(1.0, max(0.0, 2.0 * np.sum((-1.0) ** (k - 1) * np.exp(-2.0 * (k * x) ** 2)))))


def _ks_exact(d: float, n: int, m: int) -> float:
    """Share of orderings of n and m rows whose largest gap reaches d.

    Walks all orderings row by row: with i rows of one side and j of the other placed, the
    next row comes from either side with probability proportional to what is left of it.
    ``lost`` adds up the probability of meeting a gap of d or more for the first time, so
    tiny p-values stay exact.
    """
    if n > m:
        n, m = m, n
    limit = np.ceil(d * n * m - 1e-6)
    if limit <= 0:
        return 1.0
    i = np.arange(n + 1)
    alive = np.zeros(n + 1)
    alive[0] = 1.0
    lost = 0.0
    for placed in range(n + m):
        left = n + m - placed
        j = placed - i
        reachable = (j >= 0) & (j <= m)
        alive = np.where(reachable, alive, 0.0)
        from_first = alive * (n - i) / left
        from_second = alive * np.where(reachable, m - j, 0) / left
        alive = from_second
        alive[1:] += from_first[:-1]
        gap = np.abs(i * m - (placed + 1 - i) * n)
        inside = gap < limit
        lost += alive[~inside].sum()
        alive = np.where(inside, alive, 0.0)
    return float(min(1.0, lost))
