"""The searches of the catalogue run at the settings of their operators."""

import inspect
import threading

import pytest

import catalog
from shelfwise.operators import classify, recommend, selection


class Called(Exception):
    """Ends a query where it calls its operator."""


def settings(monkeypatch, module, name, query):
    """All arguments, defaults too, with which ``query`` calls an operator."""
    original = getattr(module, name)

    def record(*args, **kwargs):
        bound = inspect.signature(original).bind(*args, **kwargs)
        bound.apply_defaults()
        raise Called(bound.arguments)

    monkeypatch.setattr(module, name, record)
    with pytest.raises(Called) as caught:
        query(None, None)
    return caught.value.args[0]


@pytest.fixture
def labelled(spark):
    """Encoded rows on whose two features the label rests, the first more."""
    rows = [(i, float(i % 7), float(i % 5), 1.0 + i % 2, int(2 * (i % 7) + i % 5 > 7)) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, TARGET int")
    names = ["a", "b", "c"]
    return classify.class_weights(classify.fit_encoder(df, ["id"], names).vectors(df)).cache(), names


@pytest.fixture
def lines(monkeypatch):
    monkeypatch.setattr(catalog, "encoded_lines", lambda *_: (None, ["a", "b"]))


def test_best_subset_fits_to_the_end_and_searches_every_size(monkeypatch, lines, labelled):
    found = settings(monkeypatch, selection, "best_subset", catalog.best_subset)
    assert found["make"](labelled[0]).getMaxIter() == 100
    assert found["k"] == 1


def test_candidates_of_a_step_are_fitted_side_by_side(monkeypatch, labelled):
    df, names = labelled
    barrier, fit_score = threading.Barrier(3), selection._fit_score

    def fit(make, train, test, indices, metric):
        if len(indices) == 2:
            barrier.wait(timeout=60)
        return fit_score(make, train, test, indices, metric)

    monkeypatch.setattr(selection, "_fit_score", fit)
    steps = selection.best_subset(df, names, ["id"], classify.logistic, 2).collect()
    assert [sorted(r.features) for r in steps] == [["a", "b", "c"], ["a", "b"]]


def test_elimination_runs_three_folds_and_fits_to_the_end(monkeypatch, lines, labelled):
    found = settings(monkeypatch, selection, "rfe_cv", catalog.rfe_cv)
    assert found["make"](labelled[0]).getMaxIter() == 100
    assert found["folds"] == 3


def test_folds_are_worked_through_side_by_side(monkeypatch, labelled):
    df, names = labelled
    barrier, eliminate = threading.Barrier(3), selection._eliminate

    def steps(make, train, test, *rest):
        if test is not None:
            barrier.wait(timeout=60)
        return eliminate(make, train, test, *rest)

    monkeypatch.setattr(selection, "_eliminate", steps)
    rows = {r.features: r for r in selection.rfe_cv(df, names, ["id"], classify.logistic).collect()}
    assert rows["a"].selected and rows["b"].selected


def test_classifier_search_runs_twenty_trials(monkeypatch):
    monkeypatch.setattr(catalog, "line_splits", lambda *_: classify.Splits(None, None, None, None))
    found = settings(monkeypatch, classify, "tune_classifier", catalog.tune_classifier)
    assert found["trials"] == 20 and found["space"] is None


def test_als_search_runs_25_trials_over_the_whole_space(monkeypatch):
    monkeypatch.setattr(catalog, "basket_view", lambda *_: None)
    monkeypatch.setattr(recommend, "als_input", lambda *_: recommend.AlsInput(None, None, None, None))
    found = settings(monkeypatch, recommend, "tune_als", catalog.als_tune)
    assert found["trials"] == 25 and found["space"] == recommend.ALS_SPACE
