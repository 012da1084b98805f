"""The registered model keys fit as many rounds as the reference."""

from clinical_cohort.plans import reg_models


def test_gbt_key_has_all_rounds(monkeypatch):
    seen = {}
    monkeypatch.setattr(reg_models, "_ml_inputs", lambda spark, sf: (None, []))
    monkeypatch.setattr(reg_models, "_split", lambda X, name: X)
    monkeypatch.setattr(reg_models.ML, "gbt_select", lambda *a, max_iter=500, **b: seen.update(rounds=max_iter))
    reg_models.q_fs_gbt(None, None)
    assert seen == {"rounds": 500}
