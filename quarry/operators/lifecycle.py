"""Entity lifecycle: a pet per player with clamped counters, a periodic tick and replay.

State table columns: player, pet_name, mood, food, is_dead, birth_date, death_date.
Every transform returns a new state table (copy-on-write); validations return the
rows with ``accepted`` and ``reason`` instead of raising.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import floor_div, interval_micros, whole_seconds_between

# Limits, increments and messages of the game.
MAX_LEVEL = 24
FEED_AMOUNT = 8
TRAIN_AMOUNT = 12
TICK_AMOUNT = 1
MSG_DEAD = "Your ONLY pet is dead forever. Murderer!"
MSG_ONE_PET = "You can only ever have one pet!"
MSG_NO_SELLING = "You must commit to your pet. No selling!"
HEALTH_DEAD = "DEAD (you monster!)"

STATE_COLUMNS = ["player", "pet_name", "mood", "food", "is_dead", "birth_date", "death_date"]

# Consecutive ticks with no feed or train in between kill any pet within MAX_LEVEL + 1 of them
# (the first tick clamps the counters to at most MAX_LEVEL - 1); later ones act on a dead pet,
# so only this many ticks of a quiet stretch are ever generated (exact, not a cap on results).
TICKS_THAT_MATTER = MAX_LEVEL + 2
# Scheduled ticks sort before log events with the same time.
LOOP_TICK_SEQ = -(1 << 62)
_EPOCH = "1970-01-01 00:00:00"


def _now(now):
    import datetime as _dt

    if now is None:
        return F.localtimestamp()
    if isinstance(now, _dt.datetime):  # wall-clock value, kept zone-free
        now = now.isoformat(sep=" ")
    return F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now


def _clamp(c):
    return F.least(F.lit(MAX_LEVEL), c)


def owner_filter(pets: DataFrame, owner: str) -> DataFrame:
    """Row filter standing in for the per-owner row policy: only ``owner``'s rows."""
    return pets.filter(F.col("player") == F.lit(owner))


def pet_status(pets: DataFrame, now=None, owner: str | None = None) -> DataFrame:
    """Appetite, spirits, health bands and age (whole seconds) of each pet."""
    if owner is not None:
        pets = owner_filter(pets, owner)
    food, mood = F.col("food"), F.col("mood")
    appetite = (F.when(food == 0, "NONE!").when(food < 8, "STARVING").when(food < 16, "HUNGRY")
                .otherwise("FULL"))
    spirits = (F.when(mood == 0, "NONE!").when(mood < 8, "DEPRESSED").when(mood < 16, "BORED")
               .otherwise("HAPPY"))
    health = (F.when(F.col("is_dead"), HEALTH_DEAD).when((food < 5) | (mood < 5), "SICK")
              .when((food < 13) | (mood < 13), "OK").otherwise("GREAT"))
    age = whole_seconds_between(F.coalesce(F.col("death_date"), _now(now)), F.col("birth_date"))
    return pets.select("player", "pet_name", appetite.alias("appetite"), spirits.alias("spirits"),
                       health.alias("health"), age.alias("age"))


def pet_tick(pets: DataFrame, now=None) -> DataFrame:
    """One game-loop step: living pets lose one food and one mood (clamped to the maximum),
    then any living pet with mood < 1 or food < 1 dies at ``now``."""
    alive = ~F.col("is_dead")
    food = F.when(alive, _clamp(F.col("food") - TICK_AMOUNT)).otherwise(F.col("food"))
    mood = F.when(alive, _clamp(F.col("mood") - TICK_AMOUNT)).otherwise(F.col("mood"))
    dies = alive & ((mood < 1) | (food < 1))
    return pets.select(
        "player", "pet_name", mood.alias("mood"), food.alias("food"),
        (F.col("is_dead") | dies).alias("is_dead"), "birth_date",
        F.when(dies, _now(now)).otherwise(F.col("death_date")).alias("death_date"))


def _update(pets: DataFrame, owner: str | None, food_add: int, mood_add: int) -> DataFrame:
    """Apply an update to the owner's row (all rows when owner is None) with the update checks."""
    target = F.lit(True) if owner is None else (F.col("player") == F.lit(owner))
    rejected = target & F.col("is_dead")
    apply = target & ~F.col("is_dead")
    food = F.when(apply, _clamp(F.col("food") + food_add)).otherwise(F.col("food"))
    mood = F.when(apply, _clamp(F.col("mood") + mood_add)).otherwise(F.col("mood"))
    return pets.select(
        "player", "pet_name", mood.alias("mood"), food.alias("food"), "is_dead", "birth_date", "death_date",
        (~rejected).alias("accepted"), F.when(rejected, MSG_DEAD).alias("reason"))


def pet_feed(pets: DataFrame, owner: str | None = None) -> DataFrame:
    """Feed: food + 8 clamped to 24 (mood re-clamped too); dead pets are rejected."""
    return _update(pets, owner, FEED_AMOUNT, 0)


def pet_train(pets: DataFrame, owner: str | None = None) -> DataFrame:
    """Train: mood + 12 clamped to 24 (food re-clamped too); dead pets are rejected."""
    return _update(pets, owner, 0, TRAIN_AMOUNT)


def pet_validate_insert(candidates: DataFrame, pets: DataFrame, now=None, order_col: str | None = None) -> DataFrame:
    """Check new pets (player, pet_name[, order_col]) against the state table.

    A player with a dead pet gets MSG_DEAD, with a living one MSG_ONE_PET; of several
    candidates for one new player the first by ``order_col`` (then pet_name) wins and
    the others get MSG_ONE_PET.  Accepted rows get birth_date = now and default counters.
    The winner per player is an aggregate (combined map-side), not a window, so a
    player with very many candidates stays cheap.
    """
    rank_cols = [order_col, "pet_name"] if order_col else ["pet_name"]
    c = candidates.select("player", "pet_name", *([order_col] if order_col else []))
    rank = F.struct(*[F.col(x) for x in rank_cols])
    first = c.groupBy("player").agg(F.min(rank).alias("_first"))
    existing = pets.select("player", F.col("is_dead").alias("_existing_dead"))
    j = c.join(existing, "player", "left").join(first, "player")
    reason = (F.when(F.col("_existing_dead"), MSG_DEAD)
              .when(F.col("_existing_dead").isNotNull(), MSG_ONE_PET)
              .when(rank != F.col("_first"), MSG_ONE_PET))
    ok = reason.isNull()
    return j.select(
        "player", "pet_name",
        F.when(ok, F.lit(MAX_LEVEL)).alias("mood"), F.when(ok, F.lit(MAX_LEVEL)).alias("food"),
        F.when(ok, F.lit(False)).alias("is_dead"), F.when(ok, _now(now)).alias("birth_date"),
        F.lit(None).cast("timestamp_ntz").alias("death_date"),
        ok.alias("accepted"), reason.alias("reason"))


def pet_create(candidates: DataFrame, pets: DataFrame, now=None, order_col: str | None = None) -> DataFrame:
    """Insert the accepted new pets into the state table (copy-on-write union)."""
    v = pet_validate_insert(candidates, pets, now, order_col).filter("accepted").select(*STATE_COLUMNS)
    return pets.select(*STATE_COLUMNS).unionByName(v)


def pet_validate_update(pets: DataFrame, updates: DataFrame) -> DataFrame:
    """Check updates (player, new_player, mood, food) against the current rows.

    Rejected: old row dead (MSG_DEAD) or owner change (MSG_NO_SELLING).  Accepted rows
    get mood and food clamped to the maximum; a NULL counter becomes the maximum.  Pets
    without an update stay as they are, with ``accepted`` NULL, so the result is a whole
    state table.
    """
    u = updates.select("player", "new_player", F.col("mood").alias("_new_mood"), F.col("food").alias("_new_food"),
                       F.lit(True).alias("_updated"))
    j = pets.join(u, "player", "left")
    reason = F.when(F.col("_updated"), F.when(F.col("is_dead"), MSG_DEAD).when(
        F.col("new_player").isNotNull() & (F.col("new_player") != F.col("player")), MSG_NO_SELLING))
    ok = F.when(F.col("_updated"), reason.isNull())
    return j.select(
        "player", "pet_name",
        F.when(ok, _clamp(F.col("_new_mood"))).otherwise(F.col("mood")).alias("mood"),
        F.when(ok, _clamp(F.col("_new_food"))).otherwise(F.col("food")).alias("food"),
        "is_dead", "birth_date", "death_date", ok.alias("accepted"), reason.alias("reason"))


def _loop_ticks(events: DataFrame, period: int, num_partitions: int | None) -> DataFrame:
    """The game loop's ticks as events: one per period boundary in each gap (previous event,
    event] of a player, at most the ones that can still matter per gap.  The previous event
    comes from the skew-safe ordered scan, so a busy player is not one task."""
    from quarry.plans.scan import lag_columns

    epoch = F.lit(_EPOCH).cast("timestamp_ntz")
    ev = events.select("player", "ts", "seq", F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("_t"))
    lagged = lag_columns(ev, ["player"], ["ts", "seq"], ["_t"], num_partitions)
    k_lo = floor_div(F.col("_prev__t"), period) + 1
    n = F.least(F.greatest(floor_div(F.col("_t"), period) - k_lo + 1, F.lit(0)), F.lit(TICKS_THAT_MATTER))
    ks = (lagged.filter(F.col("_prev__t").isNotNull() & (n > 0))
          .select("player", F.explode(F.sequence(k_lo, k_lo + n - 1)).alias("_k")))
    return ks.select("player", F.timestamp_add("MICROSECOND", F.col("_k") * F.lit(period), epoch).alias("ts"),
                     F.lit(LOOP_TICK_SEQ).alias("seq"), F.lit("tick").alias("action"))


def _tail_ticks(state: DataFrame, period: int, until) -> DataFrame:
    """Apply the loop's ticks after each player's last event up to ``until``, in closed form:
    after the first tick (clamped) both counters fall by one per tick, so the tick that kills
    is ``min(max(1, f1 + 1), max(1, m1 + 1))``."""
    epoch = F.lit(_EPOCH).cast("timestamp_ntz")
    last_k = floor_div(F.timestamp_diff("MICROSECOND", epoch, F.col("_last_ts")), period)
    k = F.greatest(floor_div(F.timestamp_diff("MICROSECOND", epoch, _now(until)), period) - last_k, F.lit(0))
    f1, m1 = _clamp(F.col("food") - TICK_AMOUNT), _clamp(F.col("mood") - TICK_AMOUNT)
    j = F.least(F.greatest(F.lit(1), f1 + 1), F.greatest(F.lit(1), m1 + 1))
    ticking = ~F.col("is_dead") & (k > 0)
    dies = ticking & (k >= j)
    steps = F.when(dies, j).otherwise(k)
    return state.select(
        "player",
        F.when(ticking, f1 - (steps - 1)).otherwise(F.col("food")).cast("int").alias("food"),
        F.when(ticking, m1 - (steps - 1)).otherwise(F.col("mood")).cast("int").alias("mood"),
        (F.col("is_dead") | dies).alias("is_dead"),
        F.when(dies, F.timestamp_add("MICROSECOND", (last_k + j) * F.lit(period), epoch))
         .otherwise(F.col("death_date")).alias("death_date"))


def pet_replay(events: DataFrame, initial: DataFrame | None = None, num_partitions: int | None = None,
               tick_period: str | None = None, until=None) -> DataFrame:
    """Fold an ordered event log (player, ts, seq, action in feed/train/tick) into final state.

    Every event applies ``x -> min(24, x + a)`` to food and mood (a = +8/0/-1 for food,
    0/+12/-1 for mood); these maps compose in closed form:
    ``x_i = A_i + min(x_0, 24 - max_{j<=i} A_j)`` with A the running sum of the deltas.
    So the per-event states need only a running sum and its running peak (a skew-safe
    ordered scan) and no sequential fold.  The pet dies at the first tick leaving food
    or mood below 1; later events do nothing.  The final state per player is an
    aggregate (``min_by`` / ``max_by``), combined map-side.

    Without ``initial`` every player starts with a fresh pet (24, 24, alive).  With it,
    its rows give the starting counters and players without events keep their row (a NULL
    player is a player of its own).

    ``tick_period`` (e.g. '1 hour') adds the game loop: a tick at every multiple of the
    period after a player's first event (before log events at the same time), and with
    ``until`` also the loop's ticks after its last event up to that time.
    """
    period = None
    if tick_period is not None:
        period = interval_micros(events.sparkSession, tick_period)
        events = events.select("player", "ts", "seq", "action").unionByName(
            _loop_ticks(events, period, num_partitions))
    from quarry.plans.scan import running_sum_and_peak

    act = F.col("action")
    ev = events.select(
        "player", "ts", "seq",
        F.when(act == "feed", FEED_AMOUNT).when(act == "tick", -TICK_AMOUNT).otherwise(0).alias("_df"),
        F.when(act == "train", TRAIN_AMOUNT).when(act == "tick", -TICK_AMOUNT).otherwise(0).alias("_dm"),
        (act == "tick").alias("_tick"))
    if initial is not None:
        init = initial.select("player", F.col("food").alias("_f0"), F.col("mood").alias("_m0"),
                              F.col("is_dead").alias("_dead0"))
        init = init.withColumnRenamed("player", "_p0")
        ev = ev.join(init, ev["player"].eqNullSafe(init["_p0"]), "left").drop("_p0")
    else:
        ev = ev.select("*", F.lit(MAX_LEVEL).alias("_f0"), F.lit(MAX_LEVEL).alias("_m0"), F.lit(False).alias("_dead0"))
    s = running_sum_and_peak(ev, ["player"], ["ts", "seq"], ["_df", "_dm"], num_partitions, with_order=True)
    f0 = F.coalesce(F.col("_f0"), F.lit(MAX_LEVEL))
    m0 = F.coalesce(F.col("_m0"), F.lit(MAX_LEVEL))
    food = F.col("_sum__df") + F.least(f0, F.lit(MAX_LEVEL) - F.col("_peak__df"))
    mood = F.col("_sum__dm") + F.least(m0, F.lit(MAX_LEVEL) - F.col("_peak__dm"))
    s = s.select("player", "ts", "_order", F.coalesce(F.col("_dead0"), F.lit(False)).alias("_dead0"),
                 f0.alias("_f0"), m0.alias("_m0"), food.alias("_food"), mood.alias("_mood"), "_tick")
    dies = F.col("_tick") & ((F.col("_food") < 1) | (F.col("_mood") < 1))
    # one long follows (ts, seq) within a player: primitive min_by / max_by hash-aggregate
    # (map-side combined) instead of sorting every event as struct orderings would
    at_death = F.when(dies, F.col("_order"))
    agg = s.groupBy("player").agg(
        F.min(at_death).alias("_death_order"),
        F.min_by("_food", at_death).alias("_death_food"), F.min_by("_mood", at_death).alias("_death_mood"),
        F.min_by("ts", at_death).alias("_death_ts"),
        F.max_by("_food", "_order").alias("_last_food"), F.max_by("_mood", "_order").alias("_last_mood"),
        F.first("_dead0").alias("_dead0"), F.first("_f0").alias("_f0"), F.first("_m0").alias("_m0"),
        F.max("ts").alias("_last_ts"))
    dead0 = F.col("_dead0")
    died = F.col("_death_order").isNotNull()
    out = agg.select(
        "player",
        F.when(dead0, F.col("_f0")).when(died, F.col("_death_food")).otherwise(F.col("_last_food")).cast("int").alias("food"),
        F.when(dead0, F.col("_m0")).when(died, F.col("_death_mood")).otherwise(F.col("_last_mood")).cast("int").alias("mood"),
        (dead0 | died).alias("is_dead"),
        F.when(~dead0 & died, F.col("_death_ts")).alias("death_date"), "_last_ts")
    out = _tail_ticks(out, period, until) if period is not None and until is not None else out.drop("_last_ts")
    if initial is not None:
        done = out.select(F.col("player").alias("_p1"))
        keep = initial.select("player", "food", "mood", "is_dead", "death_date")
        keep = keep.join(done, keep["player"].eqNullSafe(done["_p1"]), "left_anti")
        died = initial.select(F.col("player").alias("_p1"), F.col("death_date").alias("_dd0"))
        out = out.join(died, out["player"].eqNullSafe(died["_p1"]), "left").select(
            "player", "food", "mood", "is_dead", F.coalesce("death_date", "_dd0").alias("death_date"))
        out = out.unionByName(keep)
    return out
