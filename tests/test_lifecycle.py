import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import lifecycle as lc

NOW = "2024-02-01 00:00:00"
T0 = dt.datetime(2023, 1, 1)
SCHEMA = "player string, pet_name string, mood int, food int, is_dead boolean, birth_date timestamp_ntz, death_date timestamp_ntz"


def pets(spark, rows):
    return spark.createDataFrame([(f"p{i}", f"n{i}", m, f, d, T0, None) for i, (f, m, d) in enumerate(rows)], SCHEMA)


def test_status_bands(spark):
    rows = [(-1, -1, False), (0, 0, False), (7, 7, False), (8, 8, False), (15, 15, False), (16, 16, False),
            (4, 20, False), (5, 20, False), (12, 20, False), (13, 20, False), (20, 20, True)]
    got = {r.player: (r.appetite, r.spirits, r.health) for r in lc.pet_status(pets(spark, rows), now=NOW).collect()}
    assert [got[f"p{i}"][0] for i in range(6)] == ["STARVING", "NONE!", "STARVING", "HUNGRY", "HUNGRY", "FULL"]
    assert [got[f"p{i}"][1] for i in range(6)] == ["DEPRESSED", "NONE!", "DEPRESSED", "BORED", "BORED", "HAPPY"]
    assert [got[f"p{i}"][2] for i in range(6, 11)] == ["SICK", "OK", "OK", "GREAT", "DEAD (you monster!)"]


def test_tick_feed_train_goldens(spark):
    df = pets(spark, [(1, 5, False), (2, 5, False), (100, 30, False), (0, 9, True)])
    t = {r.player: (r.food, r.mood, r.is_dead, r.death_date) for r in lc.pet_tick(df, now=NOW).collect()}
    assert t["p0"] == (0, 4, True, dt.datetime(2024, 2, 1)) and t["p1"] == (1, 4, False, None)
    assert t["p2"] == (24, 24, False, None) and t["p3"] == (0, 9, True, None)
    df = pets(spark, [(20, 10, False), (10, 10, False), (10, 20, False), (10, 3, False), (5, 5, True)])
    f = {r.player: (r.food, r.mood, r.accepted, r.reason) for r in lc.pet_feed(df).collect()}
    assert f["p0"][:2] == (24, 10) and f["p1"][:2] == (18, 10)
    assert f["p4"] == (5, 5, False, lc.MSG_DEAD)
    tr = {r.player: (r.food, r.mood) for r in lc.pet_train(df).collect()}
    assert tr["p2"] == (10, 24) and tr["p3"] == (10, 15)


def test_validate_insert_and_update(spark):
    df = pets(spark, [(10, 10, False), (10, 10, True)])
    cand = spark.createDataFrame([("p0", "x", 1), ("p1", "y", 1), ("new", "z", 2), ("new", "w", 1)],
                                 "player string, pet_name string, ord long")
    v = {(r.player, r.pet_name): (r.accepted, r.reason) for r in lc.pet_validate_insert(cand, df, NOW, "ord").collect()}
    assert v[("p0", "x")] == (False, lc.MSG_ONE_PET) and v[("p1", "y")] == (False, lc.MSG_DEAD)
    assert v[("new", "w")] == (True, None) and v[("new", "z")] == (False, lc.MSG_ONE_PET)
    upd = spark.createDataFrame([("p0", None, None, 30), ("p1", None, 1, 1)], "player string, new_player string, mood int, food int")
    u = {r.player: (r.mood, r.food, r.accepted, r.reason) for r in lc.pet_validate_update(df, upd).collect()}
    assert u["p0"] == (24, 24, True, None)  # least(24, NULL) fills up
    assert u["p1"] == (10, 10, False, lc.MSG_DEAD)
    sell = spark.createDataFrame([("p0", "someone", 5, 5)], "player string, new_player string, mood int, food int")
    assert lc.pet_validate_update(df, sell).first().reason == lc.MSG_NO_SELLING


def _fold(actions, food=24, mood=24, dead=False):
    death = None
    for i, a in enumerate(actions):
        if dead:
            continue
        if a == "feed":
            food, mood = min(24, food + 8), min(24, mood)
        elif a == "train":
            food, mood = min(24, food), min(24, mood + 12)
        else:
            food, mood = min(24, food - 1), min(24, mood - 1)
            if food < 1 or mood < 1:
                dead, death = True, i
    return food, mood, dead, death


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["tick", "tick", "tick", "feed", "train"]), min_size=1, max_size=80),
                min_size=1, max_size=6))
def test_replay_equals_sequential_fold(spark, histories):
    rows = []
    for p, acts in enumerate(histories):
        for i, a in enumerate(acts):
            rows.append((f"p{p}", T0 + dt.timedelta(minutes=i), i, a))
    random.Random(1).shuffle(rows)
    ev = spark.createDataFrame(rows, "player string, ts timestamp_ntz, seq long, action string")
    got = {r.player: (r.food, r.mood, r.is_dead, r.death_date) for r in lc.pet_replay(ev, num_partitions=4).collect()}
    for p, acts in enumerate(histories):
        f, m, d, i = _fold(acts)
        assert got[f"p{p}"] == (f, m, d, None if i is None else T0 + dt.timedelta(minutes=i))


def test_replay_hot_player_and_initial_state(spark):
    acts = (["tick"] * 10 + ["feed"]) * 300 + ["tick"] * 40
    rows = [("hot", T0 + dt.timedelta(seconds=i), i, a) for i, a in enumerate(acts)]
    rows += [("p0", T0, 0, "train"), ("p1", T0, 0, "tick")]
    ev = spark.createDataFrame(rows, "player string, ts timestamp_ntz, seq long, action string")
    init = pets(spark, [(100, 3, False), (9, 9, True)])  # p0 overfull, p1 already dead
    got = {r.player: (r.food, r.mood, r.is_dead) for r in lc.pet_replay(ev, initial=init, num_partitions=16).collect()}
    f, m, d, _ = _fold(acts)
    assert got["hot"] == (f, m, d)
    assert got["p0"] == (24, 15, False) and got["p1"] == (9, 9, True)


def test_validate_update_keeps_pets_without_an_update(spark):
    p = pets(spark, [(5, 6, False), (7, 8, False), (1, 2, True)])
    u = spark.createDataFrame([("p0", None, 30, None), ("p2", None, 9, 9)],
                              "player string, new_player string, mood int, food int")
    got = {r.player: (r.food, r.mood, r.accepted, r.reason) for r in lc.pet_validate_update(p, u).collect()}
    assert got == {"p0": (24, 24, True, None), "p1": (7, 8, None, None), "p2": (1, 2, False, lc.MSG_DEAD)}
