"""SQL-text builders for the wide indicator stages.

A stage with hundreds of expressions is handed to ``selectExpr`` as text:
one call that the JVM parses, instead of one Python-to-JVM call per Column
operation (thousands per stage), which made building the plan cost more
than running it on small inputs.
"""

from __future__ import annotations

from . import windows as W

_SPEC = f"PARTITION BY {W.PARTITION} ORDER BY {W.ORDER}"
OVER = f"OVER ({_SPEC})"
RUNNING = f"OVER ({_SPEC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BEFORE = f"OVER ({_SPEC} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_ERA_SPEC = f"PARTITION BY {W.PARTITION}, {W.ERA} ORDER BY market_date"
OVER_ERA = f"OVER ({_ERA_SPEC})"
RUNNING_ERA = f"OVER ({_ERA_SPEC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def trailing(n: int) -> str:
    return f"OVER ({_SPEC} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def num(x: float) -> str:
    """A double literal that parses to exactly ``float(x)``."""
    return f"({float(x)!r}D)"


def q(name: str) -> str:
    return f"`{name}`"


def rnd(e: str, d: int) -> str:
    s = num(10.0 ** d)
    return f"(rint(({e}) * {s}) / {s} + {num(0.0)})"


def div(a: str, b: str) -> str:
    return f"try_divide({a}, {b})"


def pct(cur: str, base: str) -> str:
    return f"(try_divide(({cur}) - ({base}), {base}) * {num(100.0)})"


def lag(c: str, n: int = 1) -> str:
    return f"lag({c}, {n}) {OVER}"


def total(terms: list[str]) -> str:
    """Left-to-right sum, the same association as Python's ``reduce``."""
    out = terms[0]
    for t in terms[1:]:
        out = f"({out} + {t})"
    return out


MEAN_BLOCK = 10


def block_sum(c: str) -> str:
    """Sum of the last ``MEAN_BLOCK`` rows: the building block of the longer means."""
    return f"sum({c}) {trailing(MEAN_BLOCK)}"


def mean_by_blocks(block: str, n: int, running_count: str) -> str:
    """Mean of the last ``n`` rows (a multiple of ``MEAN_BLOCK``) when all of them are present.

    The sum of ``n / MEAN_BLOCK`` block sums read by lag, where a sliding
    ``avg`` frame is summed again for every row.  Only rows of the frame
    enter, so one bad value leaves the result ``n`` rows later.
    """
    blocks = total([f"lag({block}, {k}) {OVER}" if k else block for k in range(n - MEAN_BLOCK, -1, -MEAN_BLOCK)])
    return f"CASE WHEN {full_frame(n, running_count)} THEN {blocks} / {num(float(n))} END"


def full_frame(n: int, running_count: str) -> str:
    """Whether the last ``n`` rows are all present, from a running count: exact in integers, without a frame of its own."""
    return f"{running_count} - coalesce(lag({running_count}, {n}) {OVER}, 0) >= {n}"


MOMENT_BLOCK = 5


def block_moments(c: str, mean: str, squares: str) -> list[str]:
    """Mean and sum of squared deviations of the last ``MOMENT_BLOCK`` rows, as columns ``mean`` and ``squares``."""
    frame = trailing(MOMENT_BLOCK)
    return [f"avg({c}) {frame} AS {mean}", f"var_pop({c}) {frame} * {num(float(MOMENT_BLOCK))} AS {squares}"]


def std_by_blocks(mean: str, squares: str, n: int, running_count: str) -> str:
    """Sample deviation of the last ``n`` rows (a multiple of ``MOMENT_BLOCK``) when all of them are present.

    Moments of blocks read by lag merge into those of the frame: squared
    deviations add up, and each block's mean adds its distance to the mean of
    means.  No frame of ``n`` rows is summed, and nothing cancels.
    """
    at = range(n - MOMENT_BLOCK, -1, -MOMENT_BLOCK)
    means = [f"lag({mean}, {k}) {OVER}" if k else mean for k in at]
    inner = total([f"lag({squares}, {k}) {OVER}" if k else squares for k in at])
    centre = f"({total(means)} / {num(float(len(means)))})"
    between = total([f"(({m} - {centre}) * ({m} - {centre}))" for m in means])
    merged = f"({inner} + {num(float(MOMENT_BLOCK))} * {between})"
    return f"CASE WHEN {full_frame(n, running_count)} THEN sqrt({merged} / {num(float(n - 1))}) END"
