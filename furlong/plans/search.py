"""Search for the parameters of a booster: draws by hash, rungs of growing rounds, draws near good trials.

All trials get a few rounds; the best share of them goes on to the next rung, from where its
fit ended. The first half of the trials is drawn evenly; the others are drawn where good
trials of the first half lie closer together than bad ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from threading import Lock
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from furlong import fixed_values as fixed
from furlong.plans.boosting import BoostParams, Fitted, Prepared, fit

#: How a parameter is drawn ("int", "float" or "log") and its ends.
Space = dict[str, tuple[str, float, float]]

SEARCH_SPACES: dict[str, Space] = {"leaves": fixed.LEAF_WISE_SEARCH, "depth": fixed.DEPTH_WISE_SEARCH}
#: What the searched parameters are called here.
NAMES = {
    "num_leaves": "leaves", "min_data_in_leaf": "least_rows", "feature_fraction": "feature_share", "bagging_fraction": "row_share",
    "bagging_freq": "row_every", "lambda_l1": "l1", "lambda_l2": "l2",
    "eta": "rate", "max_depth": "max_depth", "subsample": "row_share", "colsample_bytree": "feature_share",
    "reg_alpha": "l1", "reg_lambda": "l2",
}
HASH_DIGITS = 13  # hexadecimal digits of a hash that make a share, as many as a double holds
GOOD_SHARE = 0.25
CANDIDATES = 24


# -- draws ---------------------------------------------------------------------


def share(*parts: Any) -> float:
    """A number in [0, 1) that the parts decide by their hash."""
    text = ":".join(map(str, parts))
    return int(hashlib.md5(text.encode()).hexdigest()[:HASH_DIGITS], 16) / 16.0**HASH_DIGITS


def share_column(*parts: Column) -> Column:
    """The same as a column."""
    digits = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(16.0**HASH_DIGITS)


def scaled(u: float, kind: str, low: float, high: float) -> int | float:
    """A share of the way from the low to the high end."""
    if kind == "int":
        return min(int(low + math.floor(u * (high - low + 1))), int(high))
    if kind == "log":
        return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
    return low + u * (high - low)


def scaled_column(u: Column, kind: str, low: float, high: float) -> Column:
    if kind == "int":
        return F.least((F.lit(low) + F.floor(u * (high - low + 1))).cast("int"), F.lit(int(high)))
    if kind == "log":
        return F.exp(F.lit(math.log(low)) + u * (math.log(high) - math.log(low)))
    return F.lit(float(low)) + u * (high - low)


def draw(space: Space, trial: int, seed: int = 0) -> dict[str, Any]:
    """The parameters of a trial, drawn evenly."""
    return {name: scaled(share(seed, trial, name), *how) for name, how in space.items()}


def draw_table(trials: DataFrame, space: Space, seed: int = 0) -> DataFrame:
    """``trial`` with a column per parameter; the same draws as ``draw``."""
    columns = {
        name: scaled_column(share_column(F.lit(seed), F.col("trial"), F.lit(name)), *how) for name, how in space.items()
    }
    return trials.select("trial", *[column.alias(name) for name, column in columns.items()])


def boost_params(drawn: dict[str, Any], **given: Any) -> BoostParams:
    """Drawn parameters under the names used here, laid over given ones."""
    named = {NAMES[name]: value for name, value in drawn.items()}
    if "max_depth" in named:  # bounded by its depth: no other bound on the leaves
        named["leaves"] = 1 << named["max_depth"]
    if "subsample" in drawn:
        named["row_every"] = 1
    return BoostParams(**{**given, **named})


def _position(value: float, kind: str, low: float, high: float) -> float:
    """Where a drawn value lies between its ends, from 0 to 1."""
    if kind == "log":
        value, low, high = math.log(value), math.log(low), math.log(high)
    return 0.5 if high == low else (value - low) / (high - low)


def _density(at: float, points: Sequence[float]) -> float:
    """A sum of bells around the points, and an even share in case there are few."""
    width = max(0.05, 1 / (1 + len(points)))
    bells = sum(math.exp(-(((at - p) / width) ** 2) / 2) for p in points) / (width * math.sqrt(2 * math.pi))
    return (bells + 1) / (len(points) + 1)


def guided_draw(space: Space, trial: int, done: Sequence[Trial], seed: int = 0, candidates: int = CANDIDATES) -> dict[str, Any]:
    """Of several even draws the one where good trials are densest against bad ones."""
    ranked = sorted(done, key=lambda t: (-t.auc, t.number))
    cut = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    parts = [
        {name: [_position(t.drawn[name], *how) for t in some] for name, how in space.items()} for some in (ranked[:cut], ranked[cut:])
    ]

    def promise(drawn: dict[str, Any]) -> float:
        places = {name: _position(drawn[name], *how) for name, how in space.items()}
        return sum(math.log(_density(at, parts[0][name]) / _density(at, parts[1][name])) for name, at in places.items())

    drawn = [{name: scaled(share(seed, trial, name, k), *how) for name, how in space.items()} for k in range(candidates)]
    return max(drawn, key=promise)


# -- rungs ---------------------------------------------------------------------


@dataclass
class Trial:
    """A trial: what was drawn, the best AUC so far, and how many rounds were fitted for it."""

    number: int
    drawn: dict[str, Any]
    auc: float = math.nan
    rounds: int = 0
    rung: int = -1
    fitted: Any = field(default=None, repr=False)


def rungs_of(max_rounds: int, least_rounds: int, keep: float) -> list[int]:
    """Rounds of each rung: each as many times more as trials get fewer, the last ``max_rounds``."""
    out = [max_rounds]
    while out[0] * keep >= least_rounds:
        out.insert(0, math.ceil(out[0] * keep))
    return out


def promoted(trials: Sequence[Trial], keep: float) -> list[Trial]:
    """The best share of the trials of a rung, at least one; of equal ones the earlier."""
    return sorted(trials, key=lambda t: (-t.auc, t.number))[: max(1, math.ceil(keep * len(trials)))]


def climb(
    trials: list[Trial],
    rungs: Sequence[int],
    keep: float,
    run: Callable[[Trial, int], Trial],
    drop: Callable[[Trial], None],
    parallelism: int = 2,
) -> list[Trial]:
    """All trials with how far they came. ``run`` takes a trial to so many rounds; ``drop`` is told of those that end.

    A trial is dropped as soon as it can't be promoted any more, so no more trials are held than
    the next rung takes, and those that run.
    """
    done: dict[int, Trial] = {}
    going, lock = list(trials), Lock()
    for level, rounds in enumerate(rungs):
        places = max(1, math.ceil(keep * len(going)))
        finished: list[Trial] = []

        def one(trial: Trial) -> None:
            found = replace(run(trial, rounds), rung=level)
            with lock:
                finished.append(found)
                done[found.number] = found
                late = promoted(finished, 1.0)[places:] if level + 1 < len(rungs) else []
                for other in late:
                    if other.fitted is not None:
                        drop(other)
                        other.fitted = None

        with ThreadPoolExecutor(parallelism) as pool:
            list(pool.map(one, going))
        going = promoted(finished, keep)
    return [done[trial.number] for trial in trials]


def search(
    prepared: Prepared,
    space: Space,
    trials: int = 100,
    max_rounds: int = 300,
    patience: int = 20,
    least_rounds: int = 10,
    keep: float = 1 / 3,
    seed: int = 0,
    parallelism: int = 2,
    **given: Any,
) -> tuple[Fitted, list[Trial]]:
    """The best fit found, and all trials. ``given``: parameters of ``BoostParams`` that are not searched.

    Half of the trials are drawn evenly and climb the rungs, then the other half is drawn by
    what they found. A trial also ends when ``patience`` rounds bring no gain.
    """

    def run(trial: Trial, rounds: int) -> Trial:
        state = trial.fitted.state if trial.fitted is not None else None
        fitted = fit(prepared, boost_params(trial.drawn, **given), rounds, patience, state)
        return replace(trial, auc=fitted.auc, rounds=len(fitted.state.history), fitted=fitted)

    def drop(trial: Trial) -> None:
        trial.fitted.state.drop()

    rungs = rungs_of(max_rounds, least_rounds, keep)
    first = [Trial(i, draw(space, i, seed)) for i in range(max(1, trials // 2))]
    done = climb(first, rungs, keep, run, drop, parallelism)
    rest = [Trial(i, guided_draw(space, i, done, seed)) for i in range(len(first), trials)]
    if rest:
        done += climb(rest, rungs, keep, run, drop, parallelism)
    reached = [trial for trial in done if trial.fitted is not None]
    return promoted(reached, 0.0)[0].fitted, done
