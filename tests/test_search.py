import math

import pytest

from furlong import fixed_values as fixed
from furlong.plans import search
from furlong.plans.search import Trial

SPACE = fixed.LEAF_WISE_SEARCH


def test_draws_lie_in_their_ranges_and_are_the_tables(spark):
    drawn = [search.draw(SPACE, trial) for trial in range(200)]
    for name, (kind, low, high) in SPACE.items():
        values = [d[name] for d in drawn]
        assert all(low <= v <= high for v in values) and len(set(values)) > 5
        if kind == "int":
            assert {int(v) for v in values} == set(values)
        if kind == "log":
            assert sorted(values)[100] < math.sqrt(low * high) * 100 and sorted(values)[100] > math.sqrt(low * high) / 100
    table = search.draw_table(spark.range(200).withColumnRenamed("id", "trial"), SPACE).sort("trial").collect()
    for row, own in zip(table, drawn):
        assert all(row[name] == pytest.approx(own[name], rel=1e-12) for name in SPACE)
    assert search.draw(SPACE, 3, seed=1) != search.draw(SPACE, 3)


def test_names():
    params = search.boost_params(search.draw(SPACE, 1), max_depth=4)
    assert 20 <= params.leaves <= 150 and params.max_depth == 4 and 0 <= params.row_every <= 7
    params = search.boost_params(search.draw(fixed.DEPTH_WISE_SEARCH, 1))
    assert params.leaves == 2**params.max_depth and params.row_every == 1 and 0.001 <= params.rate <= 0.3


def test_rungs():
    assert search.rungs_of(300, 10, 1 / 3) == [12, 34, 100, 300]
    assert search.rungs_of(9, 3, 1 / 3) == [3, 9] and search.rungs_of(5, 10, 0.5) == [5]


def climb_by_hand(curves, rungs, keep):
    """Rounds that each trial gets, by sorting every rung."""
    got, going = {}, sorted(curves)
    for rounds in rungs:
        for t in going:
            got[t] = rounds
        going = sorted(going, key=lambda t: (-curves[t](rounds), t))[: max(1, math.ceil(keep * len(going)))]
    return got


@pytest.mark.parametrize("keep", [1 / 3, 0.5, 0.2])
@pytest.mark.parametrize("parallelism", [1, 3])
def test_promotions(keep, parallelism):
    # curves that cross: a slow starter may be best in the end, but isn't promoted
    curves = {t: (lambda rounds, t=t: round(math.sin(t * 12.9) / 2 + rounds * (t % 5) / 40, 2)) for t in range(27)}
    held, most, resumed = set(), [0], []

    def run(trial, rounds):
        resumed.append((trial.number, trial.rounds, trial.fitted is not None))
        held.add(trial.number)
        most[0] = max(most[0], len(held))
        return Trial(trial.number, trial.drawn, curves[trial.number](rounds), rounds, fitted=trial)

    rungs = [2, 5, 12]
    done = search.climb([Trial(t, {}) for t in curves], rungs, keep, run, lambda trial: held.discard(trial.number), parallelism)
    expected = climb_by_hand(curves, rungs, keep)
    assert {t.number: t.rounds for t in done} == expected
    assert [t.rung for t in done] == [rungs.index(expected[t.number]) for t in done]
    # a trial goes on from where it ended, and no more are held than may be promoted
    assert all(held_before == (rounds > 0) for _, rounds, held_before in resumed)
    if parallelism == 1:
        assert most[0] <= math.ceil(keep * 27) + 1


def test_guided_draws_go_where_good_trials_are():
    space = {"a": ("float", 0.0, 1.0), "b": ("log", 1e-4, 1.0)}
    done = []
    for i in range(60):
        drawn = search.draw(space, i)
        done.append(Trial(i, drawn, auc=-abs(drawn["a"] - 0.8) - abs(math.log10(drawn["b"]) + 1) / 4))
    guided = [search.guided_draw(space, 100 + i, done) for i in range(20)]
    even = [search.draw(space, 100 + i) for i in range(20)]

    def miss(drawn):
        return sum(abs(d["a"] - 0.8) + abs(math.log10(d["b"]) + 1) / 4 for d in drawn) / len(drawn)

    assert miss(guided) < miss(even) / 2
    assert guided == [search.guided_draw(space, 100 + i, done) for i in range(20)]


def test_a_search(spark, sf_dir):
    from furlong.bindings.queries import QUERIES

    rows = QUERIES["hpo_random"](spark, sf_dir).collect()
    assert [r["trial"] for r in rows] == list(range(6)) and all(0.5 < r["auc"] <= 1 for r in rows)
    assert sorted(r["rung"] for r in rows) == [0, 0, 0, 0, 1, 1] and {r["rounds"] for r in rows} == {2, 6}
