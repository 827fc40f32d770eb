"""Model queries of the catalogue train, tune and promote with the full presets, default trials and floors."""

import inspect

import pytest

import __spark_entry__ as entry
from toolpulse.operators.experiments import EXPERIMENTS
from toolpulse.plans.catalogue import models as Q


class Called(Exception):
    pass


def record(monkeypatch, module, name):
    """The call of a function is its error: no model is fitted."""
    signature = inspect.signature(getattr(module, name))

    def stop(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        raise Called(name, dict(bound.arguments))

    monkeypatch.setattr(module, name, stop)


@pytest.fixture
def calls(spark, monkeypatch):
    monkeypatch.setattr(Q, "_trained", {})
    for module, name in ((Q.MM, "train_model"), (Q.MM, "tune_model"), (Q.jobs, "retrain")):
        record(monkeypatch, module, name)

    def call(query):
        with pytest.raises(Called) as stopped:
            entry.queries()[query](spark, "/root/testdata/sf0.001")
        return stopped.value.args

    return call


def test_training_is_full(calls):
    for number, name in enumerate(EXPERIMENTS, 3):
        called, given = calls(f"m{number}_{name}")
        assert called == "train_model" and given["preset"] == "full" and not given["overrides"]


def test_search_and_retrain_are_full(calls):
    for query in ("m17_parameter_search", "m19_train_with_best"):
        called, given = calls(query)
        assert called == "tune_model" and given["preset"] == "full" and given["n_trials"] == 30 and given["limits"] is None
    called, given = calls("e3_retrain_and_promote")
    assert called == "retrain" and given["preset"] == "full" and given["min_f1"] is None


def test_promotion_keeps_its_floor(spark, monkeypatch):
    floors = []
    monkeypatch.setattr(Q, "_trained", {})
    monkeypatch.setattr(Q, "trained", lambda *a: None)
    monkeypatch.setattr(Q.MM, "register_model", lambda *a: "1")
    monkeypatch.setattr(Q.Registry, "promote", lambda self, name, min_f1=None, auto=False: floors.append(min_f1))
    Q.registry(spark, "sf")
    assert floors == [None, None]
