"""Full training as a job: fit, judge on held-out readings, take the model if it is no worse, go back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession, functions as F

from aerolens.operators.derive import with_aqi_bucket, with_derived_features
from aerolens.operators.filters import training_gate
from aerolens.operators.model import held_out_figures, model_features, score_aqi, train_aqi_model
from aerolens.plans.monitor import COLUMNS, FULL, Profile
from aerolens.plans.store import Store
from aerolens.session import materialized, scratch_removed

#: First digits of a reading's digest that hold it out, three of sixteen.
HELD_OUT_DIGITS = ("0", "1", "2")


def is_held_out() -> Column:
    """Whether a reading is held out. It follows from its id alone, so no version ever trains on it."""
    return F.substring(F.md5(F.coalesce(F.col("record_id").cast("string"), F.lit(""))), 1, 1).isin(*HELD_OUT_DIGITS)


def train_full_model(
    spark: SparkSession,
    store: Store,
    *,
    version: int,
    minutes: int,
    as_of: dt.datetime | None = None,
    profile: Profile = FULL,
    max_iter: int = 25,
) -> dict | None:
    """Train the full model of a profile on the trailing window and register it; returns its entry.

    The model is taken if its log loss on the held-out readings of the window is not above that of the model in use
    on the same readings, or if there is none in use. Without held-out readings nothing can be compared, and a
    model in use stays. ``None`` and no entry if the window has fewer rows to train on than the profile asks for.

    ``version`` numbers must rise, rollbacks included. Training a version again replaces it: its entry goes first, so
    an entry never names a model that is not saved whole.
    """
    as_of = as_of or store.latest()
    if as_of is None:
        return None
    with scratch_removed(spark):
        window = store.readings(minutes, as_of, COLUMNS)
        rows = training_gate(with_derived_features(with_aqi_bucket(window)), require=profile.require)
        rows = materialized(rows.withColumn("held_out", is_held_out()), "training")
        counts = rows.agg(F.expr("count_if(not held_out) as train"), F.expr("count_if(held_out) as held")).first()
        if counts["train"] < profile.min_train:
            return None
        model = train_aqi_model(rows.where("not held_out"), profile.training, max_iter=max_iter)
        if model is None:
            return None
        store.unregister_model(profile.name, version)
        store.save_full_model(model, profile.name, version)

        def judged(candidate) -> dict:
            needed = ["record_id", "station_id", "ts", "aqi_bucket", *model_features(candidate)]
            held = rows.where("held_out").select(*dict.fromkeys(needed))
            return held_out_figures(score_aqi(held, candidate, keep=("aqi_bucket",))).first().asDict()

        own = judged(model)
        rival = store.chosen_version(profile.name, before=version)
        rival_loss = None if rival is None else judged(store.full_model_version(profile.name, rival))["log_loss"]
        taken = rival is None or (rival_loss is not None and own["log_loss"] <= rival_loss)
        entry = {
            "version": version, "recorded_at": _utc(as_of), "train_rows": counts["train"], "held_out_rows": own["rows"],
            "correct": own["correct"], "log_loss": own["log_loss"], "rival": rival, "rival_log_loss": rival_loss,
            "action": "taken" if taken else "left", "chosen": version if taken else rival,
        }
        store.register_model(entry, profile.name, version)
    return entry


def roll_back(store: Store, to: int, *, version: int, as_of: dt.datetime, profile: Profile = FULL) -> None:
    """Use an earlier version from now on; recorded as an entry of its own under a new number."""
    known = {row["version"] for row in _trained(store, profile).collect()}
    if to not in known:
        raise ValueError(f"version {to} of {profile.name} was never trained")
    if version in known:
        raise ValueError(f"version {version} of {profile.name} is a trained model; give a new number")
    entry = {"version": version, "recorded_at": _utc(as_of), "action": "rolled back", "chosen": to}
    store.register_model(entry, profile.name, version)


def _trained(store: Store, profile: Profile):
    """Versions that were trained: one row a run."""
    return store.model_registry().where((F.col("source") == profile.name) & F.col("action").isin("taken", "left")).select("version")


def _utc(time: dt.datetime) -> dt.datetime:
    """A naive UTC time with its zone, so that it does not depend on the Python process's."""
    return time if time.tzinfo else time.replace(tzinfo=dt.timezone.utc)
