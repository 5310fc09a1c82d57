"""Disclosing terms are marked wherever they stand, not only near the entity."""

from __future__ import annotations

import pytest
from test_pii import spans

from bazaar.llm import pii


@pytest.mark.parametrize("size", [pii.TERM_BYTES, 10])
def test_every_occurrence_of_a_term(documents, prose, monkeypatch, size):
    monkeypatch.setattr(pii, "TERM_BYTES", size)
    mail = "zoe@example.org"
    texts = [f"write to {mail} Quellburg Ostïa {prose(40, i)} quellburg" for i in range(6)]
    texts += ["QUELLBURG alone, İx Ostïa", "a quellburg@x.org and none"] + [prose(300, f"b{i}") + " write to" for i in range(40)]
    got = spans(pii.find_personal_data(documents(texts)))
    for i, text in enumerate(texts):
        want = sorted(
            (action, at, at + len(word))
            for action, word in (("generalised", "quellburg"), ("removed", "ostïa"))
            for at in range(len(text))
            if text[at : at + len(word)].lower() == word and text[at + len(word) :][:1] != "@"
        )
        assert [s for s in got[i] if s[0] not in pii.KINDS] == want, text
    assert [s[0] for s in got[6]] == ["generalised", "removed"] and [s[0] for s in got[7]] == ["email"]
    clean = {r.doc_id: r.text for r in pii.sanitise_texts(documents(texts)).collect()}
    assert not any("quellburg" in t.lower() or "Ostïa" in t for t in clean.values())
