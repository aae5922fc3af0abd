"""Disguised words of the toxicity features."""

import numpy as np

from pageloom.llm.toxicity import featurizer


def test_disguised_first_and_last_letters():
    features = featurizer({"stupid": 2.0, "asshole": 2.0, "nazi": 2.0})
    for text, odd in (("$tupid", 1), ("@sshole,", 1), ("naz!", 1), ("!nsult", 0), ("stupid!", 0), ("plain. words, \"here\"!", 0)):
        assert np.isclose(features(text)[7], np.log1p(odd)), text


def test_distinct_words_of_long_texts():
    features = featurizer({"stupid": 2.0, "asshole": 2.0, "nazi": 2.0})
    assert features("stupid " * 300 + "asshole nazi")[2] == 3
