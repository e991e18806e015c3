import numpy as np
import pytest

from basketry.llm import toxicity


@pytest.mark.parametrize("words,threats", [({"kill": 1.0}, {}), ({}, {"kill": 1.0})])
def test_a_stem_that_is_a_word_too(words, threats):
    model = toxicity.Model({"kill": 2.0}, words, threats, np.zeros(2 * len(toxicity.READINGS)), 0.0)
    found = toxicity.Matcher(model)
    assert found.features("they were killing it")[-1] == 1
    assert found.features("they kill it")[-1] == 1 and found.features("a skill")[-1] == 0
