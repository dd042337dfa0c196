"""Pages to a stored model, end to end."""

import os
import random

import pytest

from furlong.plans.features import CATEGORIES, codes_name, preprocess
from furlong.plans.boosting import SCORE, score
from furlong.plans.race_result import build_race_cards
from furlong.plans.training import TrainConfig, train_and_publish
from furlong.schemas import PAGE
from furlong.sources import tables
from furlong.sources.pages import page_files
from tests.pages import card_page, result_page, runner, tickets


@pytest.fixture(scope="module")
def page_root(tmp_path_factory):
    """Forty races of six runners; the favourite of the odds mostly wins."""
    root = str(tmp_path_factory.mktemp("pages"))
    rng = random.Random(1)
    for race in range(40):
        date = f"202401{race % 20 + 1:02d}"
        order = list(range(6))
        if rng.random() < 0.2:
            rng.shuffle(order)
        runners = []
        for i in range(6):
            horse = rng.randrange(30)
            values = runner(
                rank="取消" if i == 5 and race % 7 == 0 else str(order.index(i) + 1), horse_number=str(i + 1), frame=str(i + 1),
                horse_name=f"馬{race}_{i}", odds=f"{1.5 + 3 * i}", jockey_name=f"騎{i}", trainer_name=f"師{i}",
                horse_weight_and_diff=f"480({rng.randint(-9, 9):+d})",
            )
            runners.append((values, (f"h{horse:02d}", f"j{i}", f"t{i}")))
        info = {"name": "2歳新馬"} if race == 39 else {}
        winner = str(order[0] + 1)
        page = result_page(runners, info, tickets(("単勝", winner, "230円", "1人気"), ("複勝", winner, "110円", "1人気")))
        folder = f"{root}/race_date={date}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{race:04d}.html", "w") as out:
            out.write(page)
    return root


def test_training_run(spark, page_root, folder):
    config = TrainConfig(
        "20240101", "20240114", "d1", "m1", valid_last_date="20240120", max_rounds=3, patience=2, trials=2, least_rounds=3, model="depth"
    )
    fitted, gain = train_and_publish(spark, config, page_files(spark, page_root), f"{folder}/data", f"{folder}/models")
    assert 0.7 < fitted.auc <= 1
    assert gain.count() == 17

    raw = tables.read_version(spark, f"{folder}/data", "d1", "race_result")
    feature = tables.read_version(spark, f"{folder}/data", "d1", "feature")
    means = tables.read_version(spark, f"{folder}/data", "d1", "weight_diff_avg")
    assert raw.count() == 240
    assert feature.count() == 240 - 6 - raw.filter("rank = '取消' AND race_name <> '2歳新馬'").count()
    assert means.count() == feature.select("horse_id").distinct().count()

    stored, params, metrics = tables.read_booster(spark, f"{folder}/models", "depth", "m1")
    assert metrics == {"auc": fitted.auc, "rounds": fitted.rounds} and "eta" in params and "reg_lambda" in params
    assert stored.sets == ["horse_id_cat", "jockey_id_cat", "trainer_id_cat"] and len(stored.features) == 14

    # a coming race: card page to probabilities, with the stored means
    card = card_page([(runner(horse_number=str(i), horse_name=f"馬{i}", odds=str(1.0 + i), jockey_name=f"騎{i}", trainer_name=f"師{i}"), (f"h0{i}", "j1", "t1")) for i in range(1, 4)])
    cards = build_race_cards(spark.createDataFrame([("20240121", "0001", card)], PAGE)).rows
    codes = {c: tables.read_version(spark, f"{folder}/data", "d1", codes_name(c)) for c in CATEGORIES}
    coming = preprocess(cards, means, codes, mode="predict")["feature"].selectExpr("*", "0 AS rank")
    known = {r["horse_id"]: (r["horse_id_cat"], r["weight_diff_avg"]) for r in feature.collect()}
    assert {r["horse_id"]: (r["horse_id_cat"], r["weight_diff_avg"]) for r in coming.collect()} == {f"h0{i}": known[f"h0{i}"] for i in range(1, 4)}
    scored = score(stored, coming).collect()
    assert len(scored) == 3 and all(0 <= r[SCORE] <= 1 for r in scored)
