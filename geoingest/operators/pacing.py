"""Folding of a pacing log inside a partition."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# The executors get these functions by value, they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pacing. A backoff status maps the interval x to min(60, 2x), a relaxing one to max(base, x/2). On
# [base, 60] both are clamp(m * x, base, 60), and clamped products stay in that family when chained,
# (m, lo, hi) with lo = f(base) and hi = f(60). So a run of events folds to three numbers, and runs
# can be folded apart and chained afterwards.

RUN_SCHEMA = (
    "first_us long, head double, head_lo double, head_hi double, ok_us long, "
    "tail double, tail_lo double, tail_hi double, last_ok_us long"
)


def _chain(steps: np.ndarray, base: float, top: float) -> tuple[float, float, float]:
    """Fold factors (2 or 0.5), in order, to one clamped product, halving the list each round."""
    m = steps.astype(float)
    lo, hi = np.full(len(m), base), np.full(len(m), top)
    while len(m) > 1:
        odd = None
        if len(m) % 2:
            odd = (m[-1:], lo[-1:], hi[-1:])
            m, lo, hi = m[:-1], lo[:-1], hi[:-1]
        m1, m2 = m[::2], m[1::2]
        lo1, hi1 = np.clip(m2 * lo[::2], lo[1::2], hi[1::2]), np.clip(m2 * hi[::2], lo[1::2], hi[1::2])
        m, lo, hi = np.where(lo1 == hi1, 1.0, m1 * m2), lo1, hi1
        if odd is not None:
            m, lo, hi = (np.concatenate([a, b]) for a, b in zip((m, lo, hi), odd))
    return (float(m[0]), float(lo[0]), float(hi[0])) if len(m) else (1.0, base, top)


def _then(f: tuple, g: tuple) -> tuple:
    lo, hi = (min(max(g[0] * x, g[1]), g[2]) for x in f[1:])
    return (1.0 if lo == hi else f[0] * g[0], lo, hi)


def fold_sorted(
    group: str, base: float, top: float, relax_us: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partition function: rows sorted by source and time in, one folded run per source out."""

    def run(source, us: np.ndarray, slow: np.ndarray) -> dict:
        ok_at = np.flatnonzero(~slow)
        split = int(ok_at[0]) if len(ok_at) else len(us)
        identity = (1.0, base, top)
        head = _chain(np.full(split, 2.0), base, top)
        tail, ok_us, last_ok = identity, None, None
        if len(ok_at):
            ok_us, last_ok = int(us[split]), int(us[ok_at[-1]])
            factor = np.where(slow, 2.0, 1.0)
            relaxed = np.diff(us[ok_at]) > relax_us
            factor[ok_at[1:][relaxed]] = 0.5
            after = factor[split + 1 :]
            tail = _chain(after[after != 1.0], base, top)
        return {
            group: source, "first_us": int(us[0]), "head": head, "ok_us": ok_us,
            "tail": tail, "last_ok_us": last_ok,
        }

    def join(a: dict, b: dict) -> dict:
        """Chain two runs of one source that follow each other."""
        if b["ok_us"] is None:
            key = "tail" if a["ok_us"] is not None else "head"
            return {**a, key: _then(a[key], b["head"])}
        if a["ok_us"] is None:
            return {**b, "first_us": a["first_us"], "head": _then(a["head"], b["head"])}
        middle = _then(a["tail"], b["head"])
        if b["ok_us"] - a["last_ok_us"] > relax_us:
            middle = _then(middle, (0.5, base, top))
        return {**a, "tail": _then(middle, b["tail"]), "last_ok_us": b["last_ok_us"]}

    def rows(runs: list[dict]) -> pa.RecordBatch:
        cols = {group: pa.array([r[group] for r in runs], pa.string())}
        for name in ("first_us", "ok_us", "last_ok_us"):
            cols[name] = pa.array([r[name] for r in runs], pa.int64())
        for name in ("head", "tail"):
            for i, suffix in enumerate(("", "_lo", "_hi")):
                cols[name + suffix] = pa.array([r[name][i] for r in runs], pa.float64())
        order = [group, *[f.split()[0] for f in RUN_SCHEMA.split(", ")]]
        return pa.RecordBatch.from_arrays([cols[c] for c in order], names=order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sources = batch.column(group)
            us = batch.column("_us").to_numpy(zero_copy_only=False)
            slow = batch.column("_slow").to_numpy(zero_copy_only=False)
            codes = sources.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(us)]
            done = []
            for i, j in zip(cuts, cuts[1:]):
                part = run(sources[i].as_py(), us[i:j], slow[i:j])
                if current is None:
                    current = part
                elif current[group] == part[group]:
                    current = join(current, part)
                else:
                    done.append(current)
                    current = part
            if done:
                yield rows(done)
        if current is not None:
            yield rows([current])

    return fold
