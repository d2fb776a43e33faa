"""The registered model queries run with all features of the fixture and the operators' own settings."""

from unittest.mock import MagicMock

import pytest

from giniflow.plans import catalog_models as catalog
from giniflow.sources.fixture import FIXTURE_SPEC


class Called(Exception):
    pass


def stop(*args, **kwargs):
    raise Called(args, kwargs)


@pytest.mark.parametrize("name, module, function", [
    ("model_pool_gini", catalog.stages, "fit_on_pools"), ("feature_importance", catalog.stages, "fit_on_pools"),
    ("preselection", catalog.stages, "preselect"), ("permutation_importance", catalog.importance, "permutation_importance")])
def test_default_settings_and_all_features(spark, monkeypatch, name, module, function):
    monkeypatch.setattr(catalog, "pools", lambda *a: MagicMock())
    monkeypatch.setattr(catalog.models, "fit", lambda *a: MagicMock())
    monkeypatch.setattr(module, function, stop)
    with pytest.raises(Called) as call:
        getattr(catalog, f"q_{name}")(spark, "")
    args, kwargs = call.value.args
    assert sorted(catalog.SPEC.features) == sorted(FIXTURE_SPEC.features)
    if name == "permutation_importance":
        assert sorted(args[1]) == sorted(FIXTURE_SPEC.features) and len(args) == 5 and set(kwargs) <= {"seed"}
    else:
        assert catalog.SPEC in args and not any(isinstance(a, dict) for a in args) and not kwargs
