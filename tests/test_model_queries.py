"""The registered model queries run the operator's own setting."""

from conftest import SF_SMALL
from shelfcast.plans import model as M
from shelfcast.plans import queries as Q


def test_model_queries_train_all_rounds(spark, monkeypatch):
    trees = {}
    for name in ("train_model", "train_serving_model"):
        def spy(*a, _name=name, _train=getattr(M, name), **k):
            out = _train(*a, **k)
            trees[_name] = out.stages[-1].getNumTrees
            return out

        monkeypatch.setattr(M, name, spy)
    assert Q.q_model_rmse(spark, SF_SMALL).first()["beats_naive"]
    Q.q_model_scored_responses(spark, SF_SMALL)
    assert trees == {"train_model": M.NUM_ROUNDS, "train_serving_model": M.NUM_ROUNDS} and M.NUM_ROUNDS == 100
