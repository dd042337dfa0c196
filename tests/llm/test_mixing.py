from collections import Counter, defaultdict
from fractions import Fraction
import random

import pytest
from pyspark.sql import functions as F

from furlong.llm import mixing
from tests.llm.samples import empty, frame, odd_rows


@pytest.mark.parametrize("seed", range(8))
def test_every_source_stays_within_one_block_of_its_share(seed):
    rnd = random.Random(seed)
    parts = mixing.parts_of({f"s{i}": rnd.random() ** 3 + 1e-4 for i in range(rnd.randrange(1, 30))}, 512)
    plan = mixing.pfair_period(parts)
    assert sum(parts.values()) == 512 and [slot for _, _, slot in plan] == list(range(512))
    done = Counter()
    for source, block, slot in plan:
        assert block == done[source]
        assert block * 512 // parts[source] <= slot < -(-(block + 1) * 512 // parts[source])  # released, not late
        done[source] += 1
        assert all(abs(done[s] - n * (slot + 1) / 512) < 1 for s, n in parts.items())


def test_parts_follow_the_weights():
    assert mixing.parts_of({"a": 3, "b": 1, "c": 0}, 8) == {"a": 6, "b": 2}
    assert mixing.parts_of({"a": 1e9, "b": 1e-9}, 8) == {"a": 7, "b": 1}
    with pytest.raises(ValueError):
        mixing.parts_of({i: 1 for i in range(9)}, 8)


def test_schedule_of_documents(spark):
    rows = [(i, "t", None, None if i % 10 == 0 else f"s{i % 3}", 1, 1, "", "") for i in range(600)]
    options = dict(block_rows=4, period=16, weights={None: 1, "s0": 2, "s1": 1})
    found = mixing.schedule(frame(spark, rows), **options).collect()
    assert len(found) == 600 and {r["slot"] for r in found if r["source"] == "s2"} == {None}
    parts = mixing.parts_of({None: 1, "s0": 2, "s1": 1}, 16)
    taken = defaultdict(set)
    for r in found:
        if r["slot"] is not None:
            taken[r["slot"]].add((r["source"], r["block"]))
        assert 0 <= r["place"] < 4
    assert all(len(blocks) == 1 for blocks in taken.values())
    slots = sorted({r["slot"] for r in found if r["on_target"]})
    assert slots == list(range(len(slots)))  # no slot is empty before the first source ends
    done = Counter()
    for slot in slots:
        done[next(iter(taken[slot]))[0]] += 1
        assert all(abs(done[s] - n * (slot + 1) / 16) < 1 for s, n in parts.items())
    ended = [s for s in parts if done[s] == -(-sum(r["source"] == s for r in found) // 4)]
    assert ended


def test_mix_is_in_order_and_the_same_again(spark):
    rows = odd_rows()
    once, again = (mixing.mix(frame(spark, rows, n), block_rows=2, period=8).collect() for n in (3, 7))
    assert [r["doc_id"] for r in once] == [r["doc_id"] for r in again] and once[0].asDict().keys() == {
        "doc_id", "text", "lang", "source", "n_chars", "id", "rep", "n",
    }
    assert 0 < len(once) <= len(rows)


def test_one_source_keeps_all_and_an_empty_table_none(spark):
    rows = [(i, "t", None, "s", 1, 1, "", "") for i in range(50)] + [(3, "t", None, "s", 1, 1, "", "")]
    assert mixing.mix(frame(spark, rows)).count() == 51
    assert mixing.schedule(empty(spark)).collect() == [] and mixing.mix(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        mixing.schedule(frame(spark, [(i, "t", None, f"s{i}", 1, 1, "", "") for i in range(5)]), period=4)


def brute_slots(weights, blocks):
    """{(source, block): slot}, slot by slot: of the released blocks the one that is due first; equal ones by source."""
    total = sum(map(Fraction, weights.values()))
    share = {s: Fraction(w) / total for s, w in weights.items()}
    done, at, slot = Counter(), {}, 0
    while any(done[s] < blocks[s] for s in share):
        # a source asks for one slot after its last block, then for no more
        ready = [s for s in share if done[s] <= blocks[s] and done[s] / share[s] < slot + 1]
        if ready:
            first = min(ready, key=lambda s: (-(-(done[s] + 1) // share[s]), s is not None, s or ""))
            if done[first] < blocks[first]:
                at[first, done[first]] = slot
            done[first] += 1
        slot += 1
    return at


def brute_mix(spark, rows, weights, block_rows):
    """All rows by slot and place, those without a slot at the end."""
    table = frame(spark, rows, 1)
    keyed = table.select("*", F.xxhash64(F.lit(17), "doc_id"), F.xxhash64(*table.columns)).collect()
    in_order = sorted(keyed, key=lambda r: (r["source"] is not None, r["source"] or "", *r[-2:]))
    seen, sizes = Counter(), Counter(r["source"] for r in in_order)
    slots = brute_slots(weights, {s: -(-sizes[s] // block_rows) for s in weights})
    placed = []
    for r in in_order:
        block, place = divmod(seen[r["source"]], block_rows)
        seen[r["source"]] += 1
        placed.append((slots.get((r["source"], block), float("inf")), place if r["source"] in weights else len(placed), r[:-2]))
    return [tuple(r) for _, _, r in sorted(placed, key=lambda x: x[:2])]


def test_mix_returns_all_rows_by_slot_and_place(spark):
    rows = odd_rows()
    rows += [(None, f"no id {i % 6}", None, ["s0", "s1", None][i % 3], i % 2, None, None, None) for i in range(14)]
    weights = {None: 2, "s0": 3, "s1": 1, "s2": 2}  # s3 has none
    found = mixing.mix(frame(spark, rows), block_rows=2, period=8, weights=weights).collect()
    assert Counter(map(tuple, found)) == Counter(rows)
    assert list(map(tuple, found)) == brute_mix(spark, rows, weights, 2)


@pytest.mark.parametrize("small", [19, 1000, 1900, 2500])
def test_sources_stay_within_one_block_of_the_given_weights(small):
    weights = {"hot": float(small * 500) ** 0.7} | {f"s{i}": 1000.0**0.7 + i / 7 for i in range(small)}
    total = sum(map(Fraction, weights.values()))
    names, share = list(weights), [float(Fraction(w) / total) for w in weights.values()]
    slots, done, after = 12_000, [0] * len(names), 1e-6
    plan = mixing.pfair(list(weights.values()), [slots] * len(names))
    last = {}
    for place, block, slot, on_target in plan:
        if slot == slots:
            break
        assert on_target and block == done[place]
        # furthest behind just before a block is taken, furthest ahead just after
        assert block > share[place] * slot - 1 - after and block + 1 < share[place] * (slot + 1) + 1 + after
        done[place] += 1
        last[place] = slot
    assert sum(done) == slots
    assert all(abs(n - w * slots) < 1 for n, w in zip(done, share))


def test_schedule_holds_the_given_weights_with_more_sources_than_a_period(spark):
    small = 2100  # more than the 2,048 slots that a period had
    rows = [(i, "t", None, "hot" if i < 3000 else f"s{i % small}", 1, 1, "", "") for i in range(3000 + 2 * small)]
    weights = {"hot": 1.0} | {f"s{i}": 1 / 1000 for i in range(small)}
    found = mixing.schedule(frame(spark, rows), block_rows=1, weights=weights).collect()
    assert len(found) == len(rows) and len({r["slot"] for r in found}) == len(rows)
    at = {(r["source"], r["block"]): r["slot"] for r in found}
    total = sum(map(Fraction, weights.values()))
    for (s, block), slot in at.items():
        w = Fraction(weights[s]) / total
        assert block // w <= slot < -(-(block + 1) // w)
    horizon = max(r["slot"] for r in found if r["on_target"]) + 1
    assert horizon > 2048
    hot = sum(r["source"] == "hot" for r in found if r["slot"] < horizon)
    assert abs(hot - horizon * float(1 / total)) < 1


def test_weights_far_apart_leave_every_row_its_own_slot(spark):
    rows = [(i, "t", None, f"s{i % 2}", 1, 1, "", "") for i in range(40)]
    found = mixing.schedule(frame(spark, rows), block_rows=1, weights={"s0": 1.0, "s1": 1e-30}).collect()
    assert len({r["slot"] for r in found}) == 40


def test_mix_keeps_columns_whatever_their_names(spark):
    docs = frame(spark, odd_rows(count=30))
    clashing = docs.selectExpr("*", *[f"{i} AS {name}" for i, name in enumerate(("__slot", "__key", "__tie", "__number", "__0", "__1"))])
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns
    own = [tuple(r)[: len(docs.columns)] for r in mixed.collect()]
    assert {tuple(r)[len(docs.columns) :] for r in mixed.collect()} == {(0, 1, 2, 3, 4, 5)}
    assert sorted(own, key=str) == sorted((tuple(r) for r in docs.collect()), key=str)
