"""Small driver-side Newton optimiser for a handful of parameters.

The objective callback runs one pass that returns the sums for value, gradient
and Hessian; only these few numbers are held on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame


def summed(rows: DataFrame, columns: list[str], sums: Callable[..., np.ndarray], size: int) -> np.ndarray:
    """Sums of ``sums(*columns)``, a vector of ``size`` numbers, over the column batches of all tasks.

    A task adds up its batches and hands one row to the driver, which adds these: one stage without a
    shuffle. The function holds the parameters, so a step of an optimiser compiles nothing.
    """
    names = [f"s{i}" for i in range(size)]

    def run(batches):
        import pyarrow as pa

        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += sums(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names)

    per_task = rows.select(*columns).mapInArrow(run, ", ".join(f"{n} double" for n in names)).collect()
    return np.array([math.fsum(column) for column in zip(*per_task)]) if per_task else np.zeros(size)



def _descent(g: np.ndarray, H: np.ndarray, max_step: float) -> np.ndarray:
    """Newton direction; where the Hessian isn't positive definite, its eigenvalues are taken by size."""
    values, vectors = np.linalg.eigh((H + H.T) / 2)
    size = np.maximum(np.abs(values), 1e-10 * max(1.0, float(np.abs(values).max())))
    step = -vectors @ ((vectors.T @ g) / size)
    longest = float(np.max(np.abs(step)))
    return step * min(1.0, max_step / longest) if longest > 0 else step


def minimize_newton(f_grad_hess, x0, max_iter: int = 200, gtol: float = 1e-9, ftol: float = 1e-12,
                    max_step: float = 2.0):
    """Newton's method with Armijo backtracking on (f, gradient, Hessian). Returns (x, info).

    ``info`` has iterations, evaluations, objective, converged and the Hessian at the end.
    """
    x = np.asarray(x0, dtype=float)
    f, g, H = f_grad_hess(x)
    evals, it, stuck = 1, 0, False
    while it < max_iter and np.all(np.isfinite(g)) and np.max(np.abs(g)) >= gtol and not stuck:
        it += 1
        p = _descent(g, H, max_step)
        step = 1.0
        while True:
            fn, gn, Hn = f_grad_hess(x + step * p)
            evals += 1
            if np.isfinite(fn) and fn <= f + 1e-4 * step * (g @ p):
                break
            step *= 0.5
            if step < 1e-8:
                stuck = True  # no further descent in floating point
                break
        if not stuck:
            stuck = abs(f - fn) <= ftol * max(1.0, abs(f))
            x, f, g, H = x + step * p, fn, gn, Hn
    return x, {"iterations": it, "evaluations": evals, "objective": f, "gradient": g, "hessian": H,
               "converged": bool(np.all(np.isfinite(g)) and np.max(np.abs(g)) < 1e-5)}
