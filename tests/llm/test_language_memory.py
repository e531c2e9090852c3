"""Texts of an Arrow batch become Python strings a group at a time, with the
same languages and scores."""

import numpy as np
import pyarrow as pa

from tidecast.llm import langid


def test_arrow_texts_step_in_groups(monkeypatch):
    en, fr = "the house and the garden of my old friend", "la maison et le jardin de mon vieil ami"
    model = langid.fit([en * 3, fr * 3], ["en", "fr"])
    texts = [en, None, fr, "", "12 34", fr + " " + en, en * 9]
    want = langid.Tagger(model).predict(texts)
    monkeypatch.setattr(langid, "STEP_CHARS", 100)
    tagger, seen = langid.Tagger(model), []
    monkeypatch.setattr(tagger, "marginals", lambda some, of=tagger.marginals: seen.append(len(some)) or of(some))
    got = tagger.predict(pa.array(texts))
    assert max(seen) < len(texts) and sum(seen) == len(texts)
    assert got[0] == want[0] == ["en", "und", "fr", "und", "und", got[0][5], "en"]
    assert np.allclose(got[1], want[1]) and (got[2] == want[2]).all()
