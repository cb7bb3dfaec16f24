import datetime as dt
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest

from quarry.operators.lifecycle import MSG_DEAD, MSG_NO_SELLING, MSG_ONE_PET
from quarry.sources import manifest
from quarry.sources import pet_table as pt

NOW = "2024-02-01 00:00:00"
T0 = dt.datetime(2024, 1, 1)


def fresh(spark, rows=()):
    path = tempfile.mkdtemp(prefix="pets-") + "/t"
    pt.start_pet_table(spark.createDataFrame([(p, f"{p}'s", 10, 10, dead, T0, T0 if dead else None) for p, dead in rows], pt.STATE),
                       path, buckets=4)
    return path


def offers(spark, *rows):
    return spark.createDataFrame(list(rows), "player string, pet_name string")


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "player string, new_player string, mood int, food int, at int")


def state(spark, path):
    return {r["player"]: (r["pet_name"], r["mood"], r["food"], r["is_dead"]) for r in pt.read_pets(spark, path).collect()}


def reasons(spark, path, producer):
    return sorted((str(r["player"]), r["accepted"], r["reason"]) for r in pt.read_decisions(spark, path, producer).collect())


def test_inserts_are_checked_and_a_batch_counts_once(spark):
    path = fresh(spark, [("ann", False), ("bob", True)])
    batch = offers(spark, ("ann", "x"), ("bob", "y"), ("cat", "b"), ("cat", "a"), ("dan", "same"), ("dan", "same"), (None, "z"), ("eve", None))
    assert pt.submit_inserts(batch, path, 0, "p", now=NOW) and not pt.submit_inserts(batch, path, 0, "p", now=NOW)
    assert state(spark, path) == {"ann": ("ann's", 10, 10, False), "bob": ("bob's", 10, 10, True),
                                  "cat": ("a", 24, 24, False), "dan": ("same", 24, 24, False)}
    assert reasons(spark, path, "p") == sorted([
        ("None", False, pt.MSG_NO_PLAYER), ("ann", False, MSG_ONE_PET), ("bob", False, MSG_DEAD), ("cat", False, MSG_ONE_PET),
        ("cat", True, None), ("dan", False, MSG_ONE_PET), ("dan", True, None), ("eve", False, pt.MSG_NO_PLAYER)])


def test_updates_each_decided_the_last_accepted_stands(spark):
    path = fresh(spark, [("ann", False), ("bob", True)])
    batch = changes(spark, ("ann", None, 5, 99, 1), ("ann", "ann", 6, None, 2), ("ann", "zoe", 1, 1, 3), ("bob", None, 9, 9, 1), ("who", None, 1, 1, 1))
    assert pt.submit_updates(batch, path, 0, "u", order_col="at")
    assert state(spark, path) == {"ann": ("ann's", 6, 24, False), "bob": ("bob's", 10, 10, True)}
    got = [(r["player"], r["at"], r["accepted"], r["reason"]) for r in pt.read_decisions(spark, path, "u").orderBy("player", "at").collect()]
    assert got == [("ann", 1, True, None), ("ann", 2, True, None), ("ann", 3, False, MSG_NO_SELLING),
                   ("bob", 1, False, MSG_DEAD), ("who", 1, None, None)]


@pytest.mark.parametrize("rival", ["cat", "dan", "other"])
def test_the_second_of_two_writers_of_a_version(spark, monkeypatch, rival):
    """Another batch commits between this one's decision and its commit: same player, same bucket, another bucket."""
    path = fresh(spark, [("ann", False)])
    commit, decided, calls = manifest.commit, pt._decided, []
    raced = []

    def late(*args):
        if not raced:
            raced.append(True)
            assert pt.submit_inserts(offers(spark, (rival, "first")), path, 0, "rival", now=NOW)
        return commit(*args)

    monkeypatch.setattr(pt.manifest, "commit", late)
    monkeypatch.setattr(pt, "_decided", lambda *a: calls.append(1) or decided(*a))
    assert pt.submit_inserts(offers(spark, ("cat", "second")), path, 0, "slow", now=NOW)
    got = state(spark, path)
    assert len(got) == (2 if rival == "cat" else 3) and got["cat"][0] == ("first" if rival == "cat" else "second")
    assert reasons(spark, path, "slow") == [("cat", rival != "cat", MSG_ONE_PET if rival == "cat" else None)]
    bucket = {p: spark.createDataFrame([(p,)], "player string").select(pt._bucket(4)).first()[0] for p in ("cat", rival)}
    assert len(calls) == (3 if bucket["cat"] == bucket[rival] else 2)  # decided anew only if a bucket of its own changed


def test_concurrent_inserts_leave_one_pet(spark):
    path = fresh(spark)
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda n: pt.submit_inserts(offers(spark, ("cat", f"n{n}"), (f"own{n}", "x")), path, 0, f"w{n}", now=NOW), range(3)))
    assert done == [True] * 3 and set(state(spark, path)) == {"cat", "own0", "own1", "own2"}
    answers = [reasons(spark, path, f"w{n}")[0] for n in range(3)]
    assert sorted(a[1] for a in answers) == [False, False, True] and pt.read_pets(spark, path).count() == 4


def test_a_bucket_of_many_files_is_rewritten(spark, monkeypatch):
    monkeypatch.setattr(pt, "MAX_FILES", 2)
    path = fresh(spark, [("ann", False)])
    for n in range(6):
        pt.submit_inserts(offers(spark, (f"p{n}", "x")), path, n, now=NOW)
    assert set(state(spark, path)) == {"ann", *(f"p{n}" for n in range(6))}
    assert max(map(len, manifest.latest(spark, path)[1]["files"].values())) <= 2


def test_empty_batch_and_missing_table(spark):
    path = fresh(spark, [("ann", False)])
    assert pt.submit_inserts(offers(spark), path, 0, now=NOW) and pt.submit_updates(changes(spark), path, 1)
    assert set(state(spark, path)) == {"ann"}
    with pytest.raises(FileExistsError):
        pt.start_pet_table(pt.read_pets(spark, path), path)
    with pytest.raises(FileNotFoundError):
        pt.submit_inserts(offers(spark), path + "-none", 0)
