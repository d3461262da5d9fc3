"""Queries over a whole flow fit their models with all iterations."""

import pytest

from chorus.operators.topic_model import LdaSettings
from chorus.plans import catalog


class Reached(Exception):
    pass


@pytest.mark.parametrize("name", ["review_topics_run", "linguistic_lda"])
def test_all_iterations(spark, sf_dir, monkeypatch, name):
    def taken(*args, **named):
        raise Reached([x for x in [*args, *named.values()] if isinstance(x, LdaSettings)])

    monkeypatch.setattr(catalog, "topic_tables", taken)
    monkeypatch.setattr(catalog.review_topics, "run", taken)
    with pytest.raises(Reached) as found:
        getattr(catalog, name)(spark, sf_dir)
    assert all(s.max_iter == LdaSettings().max_iter for s in found.value.args[0])
